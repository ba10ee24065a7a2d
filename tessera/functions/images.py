"""Image validity checks (U2): walks over the containers, in built-in functions.

=====  =====================================================================
png    header chunk first and legal, the checksum of every chunk, data chunks,
       the empty end chunk
jpeg   segments to the start of scan, then the end marker
gif    blocks and sub-blocks to the trailer
webp   chunks that fill the stated RIFF size, image data among them
bmp    a known header and as many bytes as its sizes ask for
=====  =====================================================================

Bytes after the end do no harm.  Pixels are not decoded (there is no image
codec here): a check passes what a reader that verifies without decoding passes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import sql_of

# File signatures (hex) of the formats we recognise.
PNG_MAGIC = "89504E470D0A1A0A"
JPEG_MAGIC = "FFD8FF"
JPEG_TRAILER = "FFD9"
JPEG_SCAN = "FFDA"
GIF87_MAGIC = "474946383761"
GIF89_MAGIC = "474946383961"
GIF_TRAILER = "3B"
BMP_MAGIC = "424D"
RIFF_MAGIC = "52494646"
WEBP_TAG = "57454250"
# chunk names
PNG_HEADER, PNG_DATA, PNG_END = "49484452", "49444154", "49454E44"
WEBP_IMAGES = ("56503820", "5650384C", "414E4D46")  # lossy, lossless, animation frame
# legal bit depths of each PNG color type, as hex of the two bytes (depth, type)
PNG_DEPTHS = ("0100", "0200", "0400", "0800", "1000", "0802", "1002", "0103", "0203", "0403", "0803", "0804", "1004", "0806", "1006")
BMP_HEADERS = (12, 40, 52, 56, 64, 108, 124)


def _bound_sql(b: str, sql) -> str:
    """``sql`` of a lambda variable that holds ``b``: each read of a binary column
    copies it whole, a lambda variable is read in place."""
    return f"get(transform(array({b}), _b -> {sql('_b')}), 0)"


def _byte_sql(b: str, at: str) -> str:
    """Byte ``at`` (from 0) as a number; null beyond the end."""
    return f"cast(conv(hex(substring({b}, {at} + 1, 1)), 16, 10) as int)"


def _walk_sql(b: str, at: str, step: str, least: int = 1) -> str:
    """The last ``struct<at, mode>`` of a walk over the bytes: ``step`` gives the
    state after ``_s``; modes from ``_OVER`` on end the walk.  Two nested loops of
    sqrt(steps) turns, for there may be as many steps as bytes (of ``least`` bytes
    each) but are few."""
    turns = f"sequence(1, 1 + cast(ceil(sqrt(length({b}) / {least})) as int))"
    step = f"CASE WHEN _s.mode >= {_OVER} THEN _s WHEN _s.at >= length({b}) THEN {_state_sql('_s.at', _CUT)} ELSE {step} END"
    inner = f"aggregate({turns}, _t, (_s, _j) -> {step})"
    return f"aggregate({turns}, {_state_sql(at, 0)}, (_t, _i) -> IF(_t.mode >= {_OVER}, _t, {inner}))"


def _state_sql(at: str, mode: int | str) -> str:
    return f"named_struct('at', cast(coalesce({at}, 0) as int), 'mode', cast({mode} as int))"


_OVER, _FOUND, _CUT, _BAD_CRC, _BAD_HEADER, _NO_DATA = 2, 2, 3, 4, 5, 6
_FLAWS = {_CUT: "truncated", _BAD_CRC: "bad_crc", _BAD_HEADER: "bad_header", _NO_DATA: "no_image_data"}  # modes after _FOUND


def _flaw_sql(state: str) -> str:
    """Null for a walk that found the end, else what is wrong (modes below
    ``_OVER``: the bytes ended first)."""
    flaws = ", ".join(["'truncated'"] * _OVER + ["NULL"] + [f"'{_FLAWS[m]}'" for m in sorted(_FLAWS)])
    return f"get(array({flaws}), greatest({state}.mode, 0))"


def _number_sql(b: str, at: str, n: int, little: bool = False) -> str:
    """``n`` bytes from ``at`` (from 0) as an unsigned number; null beyond the end."""
    digits = f"hex(substring({b}, cast({at} as int) + 1, {n}))"
    if little:
        digits = "concat(" + ", ".join(f"substring({digits}, {2 * k - 1}, 2)" for k in range(n, 0, -1)) + ")"
    # fewer bytes than asked for are no number
    return f"IF(length({b}) >= {at} + {n}, cast(conv({digits}, 16, 10) as bigint), NULL)"


def _png_flaw_sql(b: str) -> str:
    """Walks the chunks; the mode is 0 at first, 1 after the header, -1 after data."""
    chunk = (f"named_struct('n', {_number_sql(b, '_s.at', 4)}, 'kind', hex(substring({b}, _s.at + 5, 4)))")
    whole = f"_c.n IS NOT NULL AND _s.at + 12L + _c.n <= length({b})"
    crc = f"crc32(substring({b}, _s.at + 5, cast(_c.n as int) + 4)) = {_number_sql(b, '_s.at + 8 + _c.n', 4)}"
    header = (f"_c.kind = '{PNG_HEADER}' AND _c.n = 13 AND {_number_sql(b, '_s.at + 8', 4)} BETWEEN 1 AND 2147483647 "
              f"AND {_number_sql(b, '_s.at + 12', 4)} BETWEEN 1 AND 2147483647 "
              f"AND hex(substring({b}, _s.at + 17, 2)) IN {PNG_DEPTHS} AND hex(substring({b}, _s.at + 19, 3)) IN ('000000', '000001')")
    after = f"CASE WHEN _c.kind = '{PNG_DATA}' THEN -1 WHEN _s.mode = 0 THEN 1 ELSE _s.mode END"
    step = (f"get(transform(array({chunk}), _c -> CASE WHEN NOT ({whole}) THEN {_state_sql('_s.at', _CUT)} "
            f"WHEN NOT ({crc}) THEN {_state_sql('_s.at', _BAD_CRC)} "
            f"WHEN _s.mode = 0 AND NOT ({header}) THEN {_state_sql('_s.at', _BAD_HEADER)} "
            f"WHEN _c.kind = '{PNG_END}' THEN {_state_sql('_s.at', f'IF(_s.mode = -1, {_FOUND}, {_NO_DATA})')} "
            f"ELSE {_state_sql('_s.at + 12 + _c.n', after)} END), 0)")
    return _flaw_sql(_walk_sql(b, "8", step, 12))


def _webp_flaw_sql(b: str) -> str:
    """Walks the chunks of the stated size; the mode is 1 once image data is there."""
    end = f"8 + {_number_sql(b, '4', 4, little=True)}"
    chunk = (f"named_struct('n', coalesce({_number_sql(b, '_s.at + 4', 4, little=True)}, length({b})), "
             f"'mode', IF(hex(substring({b}, _s.at + 1, 4)) IN {WEBP_IMAGES}, 1, _s.mode))")
    # fewer than eight bytes after a chunk hold no other
    step = (f"get(transform(array({chunk}), _c -> CASE WHEN _s.at + 8 + _c.n > _e THEN {_state_sql('_s.at', _CUT)} "
            f"WHEN _s.at + 8 + _c.n + _c.n % 2 > _e - 8 THEN {_state_sql('_s.at', f'IF(_c.mode = 1, {_FOUND}, {_NO_DATA})')} "
            f"ELSE {_state_sql('_s.at + 8 + _c.n + _c.n % 2', '_c.mode')} END), 0)")
    walked = f"IF(coalesce(_e, 0) NOT BETWEEN 20 AND length({b}), 'truncated', {_flaw_sql(_walk_sql(b, '12', step, 8))})"
    return f"get(transform(array({end}), _e -> {walked}), 0)"


def _bmp_flaw_sql(b: str) -> str:
    def le(at: int, n: int) -> str:
        return _number_sql(b, str(at), n, little=True)

    def bound(name: str, value: str, then: str) -> str:
        return f"get(transform(array({value}), {name} -> {then}), 0)"

    fields = (f"IF(_n = 12, named_struct('w', {le(18, 2)}, 'h', {le(20, 2)}, 'bits', {le(24, 2)}, 'packed', 0L, 'size', 0L, 'from', {le(10, 4)}), "
              f"named_struct('w', {le(18, 4)}, 'h', {le(22, 4)}, 'bits', {le(28, 2)}, 'packed', {le(30, 4)}, 'size', {le(34, 4)}, 'from', {le(10, 4)}))")
    # rows of whole 32-bit units; a height beyond 2**31 counts downwards
    rows = "ceil(cast(_f.w as decimal(20)) * _f.bits / 32) * 4 * IF(_f.h >= 2147483648, 4294967296 - _f.h, _f.h)"
    flaw = (f"CASE WHEN _n NOT IN {BMP_HEADERS} THEN 'bad_header' WHEN _f.size IS NULL THEN 'truncated' "
            f"WHEN _f.w = 0 OR _f.w >= 2147483648 OR _f.h = 0 OR _f.bits NOT IN (1, 2, 4, 8, 16, 24, 32) OR _f.from < 14 + _n THEN 'bad_header' "
            f"WHEN _f.from + IF(_f.packed IN (0, 3, 6), {rows}, _f.size) > length({b}) THEN 'truncated' END")
    return bound("_n", le(14, 4), f"IF(_n IS NULL, 'truncated', {bound('_f', fields, flaw)})")


def _gif_end_sql(b: str) -> str:
    """Walks blocks (mode 0) and their sub-blocks (mode 1) to the trailer."""
    def table(flags: str) -> str:  # bytes of a color table
        return f"IF({_byte_sql(b, flags)} >= 128, 3 * shiftleft(2, {_byte_sql(b, flags)} & 7), 0)"

    step = (f"CASE WHEN _s.mode = 1 THEN {_state_sql('_s.at + 1 + ' + _byte_sql(b, '_s.at'), 'IF(' + _byte_sql(b, '_s.at') + ' = 0, 0, 1)')} "
            f"ELSE CASE hex(substring({b}, _s.at + 1, 1)) WHEN '{GIF_TRAILER}' THEN {_state_sql('_s.at', _FOUND)} "
            f"WHEN '21' THEN {_state_sql('_s.at + 2', 1)} "
            f"WHEN '2C' THEN {_state_sql('_s.at + 11 + coalesce(' + table('_s.at + 9') + ', 0)', 1)} "
            f"ELSE {_state_sql('_s.at + 1', 0)} END END")
    # what is too short for a screen descriptor has no blocks to walk
    return (f"IF(length({b}) < 14, substring({b}, -1, 1) = X'{GIF_TRAILER}', "
            f"{_walk_sql(b, '13 + ' + table('10'), step)}.mode = {_FOUND})")


def _jpeg_end_sql(b: str) -> str:
    """Walks segments, with the thumbnails in them, to the start of scan; scan
    data never hold the end marker.  Without any scan it has to be near the end."""
    marker = f"hex(substring({b}, _s.at + 1, 2))"
    size = f"256 * {_byte_sql(b, '_s.at + 2')} + {_byte_sql(b, '_s.at + 3')}"
    step = (f"CASE WHEN {marker} = '{JPEG_SCAN}' THEN {_state_sql('_s.at', _FOUND)} "
            f"WHEN NOT startswith({marker}, 'FF') OR {marker} IN ('FFFF', 'FF00') THEN {_state_sql('_s.at + 1', 0)} "
            f"WHEN {marker} = 'FF01' OR {marker} BETWEEN 'FFD0' AND 'FFD9' THEN {_state_sql('_s.at + 2', 0)} "
            f"ELSE {_state_sql(f'_s.at + 2 + coalesce({size}, length({b}))', 0)} END")
    return (f"IF(contains({b}, X'{JPEG_SCAN}'), "
            f"get(transform(array({_walk_sql(b, '2', step)}), _w -> _w.mode = {_FOUND} AND contains(substring({b}, _w.at + 1), X'{JPEG_TRAILER}')), 0), "
            f"contains(substring({b}, greatest(1, length({b}) - 15)), X'{JPEG_TRAILER}'))")


def signature_sql(b: str) -> str:
    """``struct<absent, nbytes, head, flaw>`` of bytes ``b``: the first 12 bytes
    as hex, and what is wrong with a container of a known format.  Computing it
    once lets a lambda test the bytes through field reads (lambdas get no
    common-subexpression elimination)."""
    def ends(sql) -> str:
        return f"IF({_bound_sql(b, sql)}, NULL, 'truncated')"

    return (f"named_struct('absent', {b} IS NULL, 'nbytes', length({b}), 'head', hex(substring({b}, 1, 12)), 'flaw', "
            f"CASE WHEN substring({b}, 1, 8) = X'{PNG_MAGIC}' THEN {_bound_sql(b, _png_flaw_sql)} "
            f"WHEN substring({b}, 1, 3) = X'{JPEG_MAGIC}' THEN {ends(_jpeg_end_sql)} "
            f"WHEN substring({b}, 1, 6) IN (X'{GIF87_MAGIC}', X'{GIF89_MAGIC}') THEN {ends(_gif_end_sql)} "
            f"WHEN substring({b}, 1, 4) = X'{RIFF_MAGIC}' THEN {_bound_sql(b, _webp_flaw_sql)} "
            f"WHEN substring({b}, 1, 2) = X'{BMP_MAGIC}' THEN {_bound_sql(b, _bmp_flaw_sql)} END)")


def format_sql(sig: str) -> str:
    head = f"{sig}.head"
    return (
        f"CASE WHEN startswith({head}, '{PNG_MAGIC}') THEN 'png' "
        f"WHEN startswith({head}, '{JPEG_MAGIC}') THEN 'jpeg' "
        f"WHEN startswith({head}, '{GIF87_MAGIC}') OR startswith({head}, '{GIF89_MAGIC}') THEN 'gif' "
        f"WHEN startswith({head}, '{RIFF_MAGIC}') AND substring({head}, 17, 8) = '{WEBP_TAG}' THEN 'webp' "
        # bytes 6 to 9 of a bitmap's header are reserved and zero
        f"WHEN startswith({head}, '{BMP_MAGIC}') AND substring({head}, 13, 8) = '00000000' THEN 'bmp' END"
    )


def problem_sql(sig: str) -> str:
    """Null when the signature passes the check, else a reason."""
    return (f"CASE WHEN {sig}.absent THEN 'missing' WHEN {sig}.nbytes = 0 THEN 'empty' "
            f"WHEN ({format_sql(sig)}) IS NULL THEN 'unknown_format' ELSE {sig}.flaw END")


def image_signature(content: Column | str) -> Column:
    return F.expr(signature_sql(sql_of(content)))


def _of_signature(content: Column | str, sql) -> Column:
    """``sql`` of the signature, which is computed (and written) once."""
    return F.expr(f"get(transform(array({signature_sql(sql_of(content))}), _g -> {sql('_g')}), 0)")


def image_format(content: Column | str) -> Column:
    return _of_signature(content, format_sql)


def image_problem(content: Column | str) -> Column:
    """Null when the bytes pass the check, else a reason string."""
    return _of_signature(content, problem_sql)
