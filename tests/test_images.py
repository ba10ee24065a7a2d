"""Image checks: the walks over PNG, JPEG, GIF, WebP and BMP containers."""

import random
import struct

import pictures as P
from pyspark.sql import functions as F

from tessera.functions.images import image_format, image_problem


def _checked(spark, files):
    df = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, b in enumerate(files)], "id long, c binary")
    return [(r.fmt, r.p) for r in df.select("id", image_format(F.col("c")).alias("fmt"), image_problem(F.col("c")).alias("p")).orderBy("id").collect()]


def test_formats(spark):
    files = [P.png(), P.png(b"note" * 99), b"\xff\xd8\xff\xe0xx\xff\xd9", b"GIF89a;", P.webp(), P.bmp(), b"", None, b"text", b"RIFFxxxxWAVEdata"]
    assert _checked(spark, files) == [("png", None), ("png", None), ("jpeg", None), ("gif", None), ("webp", None), ("bmp", None),
                                      (None, "empty"), (None, "missing"), (None, "unknown_format"), (None, "unknown_format")]


def test_png_chunks(spark):
    """Equal to a plain reader on cut, altered and reordered files."""
    whole = P.png(b"some note \xff\x00" * 9, 5, 3)
    rnd = random.Random(2)
    files = [whole[:n] for n in range(8, len(whole) + 1)] + [whole + b"trailing"]
    for _ in range(80):
        changed = bytearray(whole)
        changed[rnd.randrange(8, len(whole))] ^= 1 << rnd.randrange(8)
        files.append(bytes(changed))
    sig, ihdr, idat, iend = whole[:8], whole[8:33], P.chunk(b"IDAT", b"zz"), P.chunk(b"IEND", b"")
    files += [sig + idat + ihdr + iend, sig + ihdr + iend, sig + ihdr + idat, sig + ihdr + idat + idat + iend + ihdr, sig + P.chunk(b"IHDR", b"short") + idat + iend]
    assert [p for _, p in _checked(spark, files)] == [P.png_problem(b) for b in files]
    odd = [struct.pack(">IIBBBBB", *f) for f in ((0, 1, 8, 0, 0, 0, 0), (1, 2**31, 8, 0, 0, 0, 0), (1, 1, 3, 0, 0, 0, 0), (1, 1, 4, 2, 0, 0, 0), (1, 1, 8, 0, 1, 0, 0), (1, 1, 8, 0, 0, 0, 2))]
    assert {p for _, p in _checked(spark, [sig + P.chunk(b"IHDR", h) + idat + iend for h in odd])} == {"bad_header"}


def test_webp_chunks(spark):
    for n in (100, 101):
        whole = P.webp(n)
        assert _checked(spark, [whole, whole + b"more", whole[:-1] if n % 2 else whole]) == [("webp", None)] * 2 + [("webp", "truncated" if n % 2 else None)]
        assert {p for _, p in _checked(spark, [whole[:k] for k in range(12, len(whole) - 1, 7)])} == {"truncated"}
    assert _checked(spark, [P.webp(10, (b"VP8X", b"EXIF"))]) == [("webp", "no_image_data")]
    assert _checked(spark, [P.webp(10, (k,)) for k in (b"VP8 ", b"VP8L", b"ANMF")]) == [("webp", None)] * 3
    grown = bytearray(P.webp(50, (b"VP8L",)))
    grown[16] += 9  # the chunk says more than the file
    assert _checked(spark, [bytes(grown)]) == [("webp", "truncated")]


def test_bmp_sizes(spark):
    whole = [P.bmp(w, h, bits, header) for w, h, bits, header in ((7, 5, 24, 40), (7, -5, 24, 40), (9, 3, 1, 40), (33, 2, 8, 12), (4, 4, 32, 124), (1, 1, 16, 108))]
    assert {x for x in _checked(spark, whole)} == {("bmp", None)}
    assert {p for _, p in _checked(spark, [b[:-1] for b in whole] + [whole[0][:n] for n in range(14, len(whole[0]), 9)])} == {"truncated"}
    assert {p for _, p in _checked(spark, [P.bmp(0, 5), P.bmp(5, 0), P.bmp(bits=5), P.bmp(header=48)])} == {"bad_header"}
    packed = bytearray(P.bmp())
    packed[30] = 1  # run-length data of the stated size
    assert _checked(spark, [bytes(packed), bytes(packed)[:-1]]) == [("bmp", None), ("bmp", "truncated")]


def test_large_image(spark):
    big = P.png(P.noise(3_000_000))
    assert _checked(spark, [big, big[:-20]]) == [("png", None), ("png", "truncated")]


def _gif(frames=3):
    rng = random.Random(7)
    out = b"GIF89a" + struct.pack("<HHBBB", 64, 64, 0x91, 0, 0) + rng.randbytes(12) + b"\x21\xff\x0bNETSCAPE2.0\x03\x01\x00\x00\x00"
    for k in range(frames):
        local = rng.randbytes(24) if k else b""
        out += b"\x21\xf9\x04\x00\x0a\x00\x00\x00" + b"\x2c" + struct.pack("<HHHHB", 0, 0, 64, 64, 0x82 if k else 0) + local + b"\x08"
        for n in (255, 255, 255, 40):  # with trailer bytes, and 003B, inside the data
            out += bytes([n]) + (b"\x00\x3b" * 4 + rng.randbytes(n))[:n]
        out += b"\x00"
    return out + b"\x3b"


def _jpeg(scans=2):
    rng = random.Random(8)
    data = lambda n: rng.randbytes(n).replace(b"\xff", b"\xff\x00")
    segment = lambda marker, body: b"\xff" + bytes([marker]) + struct.pack(">H", len(body) + 2) + body
    thumbnail = b"\xff\xd8" + segment(0xDB, bytes(65)) + segment(0xDA, bytes(10)) + data(300) + b"\xff\xd9"
    out = b"\xff\xd8" + segment(0xE1, b"Exif\x00\x00" + thumbnail) + segment(0xDB, bytes(65)) + b"\xff" + segment(0xC0, bytes(15))
    for _ in range(scans):
        out += segment(0xC4, bytes(30)) + segment(0xDA, bytes(10)) + data(900) + b"\xff\xd0" + data(50)
    return out + b"\xff\xd9"


def test_cut_gif_and_jpeg_with_thumbnail(spark):
    rows = []
    for name, whole in (("gif", _gif()), ("jpeg", _jpeg())):
        rows += [(name, True, whole), (name, True, whole + b"\x00" * 5000), (name, True, whole + b"more \xff\xda;")]
        rows += [(name, False, whole[:n]) for n in range(20, len(whole) - 1, 37)] + [(name, False, whole[:-1])]
    assert _checked(spark, [b for _, _, b in rows]) == [(name, None if ok else "truncated") for name, ok, _ in rows]
