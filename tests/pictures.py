"""Small whole images of every format, and a plain check of PNG files."""

import random
import struct
import zlib


def chunk(kind, data):
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)


def png(note=b"", width=1, height=1):
    raw = zlib.compress((b"\x00" + b"\x00" * width) * height)
    text = chunk(b"tEXt", b"Comment\x00" + note) if note else b""
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + text + chunk(b"IDAT", raw) + chunk(b"IEND", b"")


def note(data):
    """The text that :func:`png` was given."""
    return bytes(data).split(b"Comment\x00")[1].split(b"IDAT")[0][:-8]


def webp(n=101, kinds=(b"VP8X", b"ICCP", b"VP8 ")):
    body = b"".join(k + struct.pack("<I", n + i) + bytes(n + i) + b"\x00" * ((n + i) % 2) for i, k in enumerate(kinds))
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"WEBP" + body


def bmp(width=7, height=-5, bits=24, header=40):
    row = (width * bits + 31) // 32 * 4
    data = bytes(row * abs(height))
    if header == 12:
        info = struct.pack("<IHHHH", 12, width, abs(height), 1, bits)
    else:
        info = struct.pack("<IiiHHIIiiII", header, width, height, 1, bits, 0, len(data), 0, 0, 0, 0) + bytes(header - 40)
    return b"BM" + struct.pack("<IHHI", 14 + len(info) + len(data), 0, 0, 14 + len(info)) + info + data


def png_problem(data):
    """Header first, the checksum of every chunk, data, the end chunk."""
    pos, seen = 8, []
    while True:
        if pos + 12 > len(data):
            return "truncated"
        (n,) = struct.unpack(">I", data[pos:pos + 4])
        kind = data[pos + 4:pos + 8]
        if pos + 12 + n > len(data):
            return "truncated"
        if zlib.crc32(data[pos + 4:pos + 8 + n]) & 0xFFFFFFFF != struct.unpack(">I", data[pos + 8 + n:pos + 12 + n])[0]:
            return "bad_crc"
        if not seen and (kind != b"IHDR" or n != 13):
            return "bad_header"
        seen.append(kind)
        pos += 12 + n
        if kind == b"IEND":
            return None if b"IDAT" in seen else "no_image_data"


def noise(n, seed=1):
    return random.Random(seed).randbytes(n)
