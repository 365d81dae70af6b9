"""ZIP packages as byte ranges: a writer of stored members and a reader of directories (inside tasks).

The writer gives pieces that end in a line feed, so that Spark's text writer, which
puts one behind every value, writes packages byte for byte. The last line feed is the
package's comment. The reader never reads a member it is not asked for: it finds the
end record, the ZIP64 records if they are there, walks the central directory in
bounded reads and looks up where a stored member's bytes begin.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

# Record layouts and signatures of the ZIP format.
LOCAL, LOCAL_SIGN = struct.Struct("<4s5H3I2H"), b"PK\x03\x04"
CENTRAL, CENTRAL_SIGN = struct.Struct("<4s6H3I5H2I"), b"PK\x01\x02"
END, END_SIGN = struct.Struct("<4s4H2IH"), b"PK\x05\x06"
END64, END64_SIGN = struct.Struct("<4sQ2H2I4Q"), b"PK\x06\x06"
LOCATOR, LOCATOR_SIGN = struct.Struct("<4sIQI"), b"PK\x06\x07"
MOST16, MOST32, MOST_COMMENT = 0xFFFF, 0xFFFFFFFF, 0xFFFF
STORED, UTF8_NAMES, ZIP64_EXTRA = 0, 0x800, 1
DATE_1980 = 0x21

READ = 1 << 20  # bytes of a directory read at once


class BadPackage(ValueError):
    """The bytes are no ZIP package, or a part of it is missing."""


@dataclass
class Member:
    name: str
    method: int
    encrypted: bool
    crc32: int
    length: int
    header_at: int


class Writer:
    """Collects stored members and gives the bytes of the package piece by piece.

    ``zip64_from``: offsets, lengths and numbers from this value on stand in ZIP64
    records (the format needs them from 2**32 - 1, and from 65535 for the number).
    """

    def __init__(self, zip64_from: int = MOST32):
        self.at = 0
        self.entries: list[tuple[bytes, int, int, int]] = []
        self.wide = zip64_from

    def member(self, name: str, data: bytes) -> bytes:
        """Local header and bytes of one stored member."""
        raw, crc = name.encode("utf-8"), zlib.crc32(data)
        self.entries.append((raw, crc, len(data), self.at))
        if len(data) >= self.wide:
            extra = struct.pack("<2H2Q", ZIP64_EXTRA, 16, len(data), len(data))
            sizes, version = (MOST32, MOST32), 45
        else:
            extra, sizes, version = b"", (len(data), len(data)), 20
        head = LOCAL.pack(LOCAL_SIGN, version, UTF8_NAMES, STORED, 0, DATE_1980, crc, *sizes, len(raw), len(extra))
        piece = head + raw + extra + data
        self.at += len(piece)
        return piece

    def end(self) -> bytes:
        """Central directory and end records; the comment is one line feed."""
        out, start = [], self.at
        for raw, crc, length, header_at in self.entries:
            wide = [v for v in (length, length, header_at) if v >= self.wide]
            extra = struct.pack(f"<2H{len(wide)}Q", ZIP64_EXTRA, 8 * len(wide), *wide) if wide else b""
            length, header_at = (MOST32 if v >= self.wide else v for v in (length, header_at))
            version = 45 if wide else 20
            out.append(
                CENTRAL.pack(
                    CENTRAL_SIGN, version, version, UTF8_NAMES, STORED, 0, DATE_1980, crc, length, length,
                    len(raw), len(extra), 0, 0, 0, 0, header_at,
                )
                + raw + extra
            )
        directory = b"".join(out)
        n, size = len(self.entries), len(directory)
        if n >= min(self.wide, MOST16) or max(size, start) >= self.wide:
            out.append(END64.pack(END64_SIGN, END64.size - 12, 45, 45, 0, 0, n, n, size, start))
            out.append(LOCATOR.pack(LOCATOR_SIGN, 0, start + size, 1))
            n, size, start = MOST16, MOST32, MOST32
        out.append(END.pack(END_SIGN, 0, 0, n, n, size, start, 1) + b"\n")
        return b"".join(out)


def read_at(f, at: int, length: int) -> bytes:
    """Exactly these bytes of an open file."""
    if at < 0:
        raise BadPackage(f"offset {at} lies before the file")
    f.seek(at)
    data = f.read(length)
    if len(data) != length:
        raise BadPackage(f"{length} bytes at {at} wanted, {len(data)} there")
    return data


def _directory(f, size: int) -> tuple[int, int, int, int]:
    """(entries, directory size, directory's place, bytes before the package) from the end records."""
    tail_at = max(0, size - END.size - MOST_COMMENT)
    tail = read_at(f, tail_at, size - tail_at)
    at = len(tail) - END.size
    while (at := tail.rfind(END_SIGN, 0, at + 4)) >= 0:
        if at + END.size <= len(tail):
            _, disk, first, _, n, length, start, comment = END.unpack_from(tail, at)
            if at + END.size + comment == len(tail):
                break
        at -= 1
    if at < 0:
        raise BadPackage("no end record")
    end_at = tail_at + at
    if MOST16 in (n, disk, first) or MOST32 in (length, start):
        mark = read_at(f, end_at - LOCATOR.size, LOCATOR.size) if end_at >= LOCATOR.size else b""
        if mark[:4] == LOCATOR_SIGN:
            _, _, at64, _ = LOCATOR.unpack(mark)
            # Bytes before the package shift all offsets; the record then lies right before its locator.
            for place in (at64, end_at - LOCATOR.size - END64.size):
                if 0 <= place <= end_at - END64.size:
                    record = read_at(f, place, END64.size)
                    if record[:4] == END64_SIGN:
                        _, _, _, _, disk, first, _, n, length, start = END64.unpack(record)
                        end_at = place
                        break
            else:
                raise BadPackage("no ZIP64 end record")
    if disk or first:
        raise BadPackage("a package of several files")
    before = end_at - length - start
    if before < 0:
        raise BadPackage("the directory does not fit before its end record")
    return n, length, start + before, before


def members(f, size: int) -> Iterator[Member]:
    """The members the central directory names, in its order; bounded reads."""
    n, length, at, before = _directory(f, size)
    held, left, seen = b"", length, 0
    while seen < n:
        if len(held) < CENTRAL.size + 3 * MOST16 and left:
            step = min(left, max(READ, 4 * MOST16))
            held += read_at(f, at, step)
            at, left = at + step, left - step
        if len(held) < CENTRAL.size or held[:4] != CENTRAL_SIGN:
            raise BadPackage(f"directory entry {seen} of {n} is broken")
        fields = CENTRAL.unpack_from(held)
        flags, method, crc, packed, plain = fields[3], fields[4], fields[7], fields[8], fields[9]
        n_name, n_extra, n_comment, header_at = fields[10], fields[11], fields[12], fields[16]
        name = held[CENTRAL.size : CENTRAL.size + n_name]
        extra = held[CENTRAL.size + n_name : CENTRAL.size + n_name + n_extra]
        held = held[CENTRAL.size + n_name + n_extra + n_comment :]
        while len(extra) >= 4:
            kind, step = struct.unpack_from("<2H", extra)
            if kind == ZIP64_EXTRA:
                # Only values that did not fit their field are there, in this order.
                wide = iter(struct.unpack_from(f"<{step // 8}Q", extra, 4))
                try:
                    plain = next(wide) if plain == MOST32 else plain
                    packed = next(wide) if packed == MOST32 else packed
                    header_at = next(wide) if header_at == MOST32 else header_at
                except StopIteration:
                    raise BadPackage(f"ZIP64 values of entry {seen} are missing") from None
            extra = extra[4 + step :]
        text = name.decode("utf-8" if flags & UTF8_NAMES else "cp437", "replace")
        yield Member(text, method, bool(flags & 1), crc, packed, header_at + before)
        seen += 1


def data_at(f, member: Member) -> int:
    """Where a member's bytes begin: behind its own header, whose fields may differ from the directory's."""
    head = LOCAL.unpack(read_at(f, member.header_at, LOCAL.size))
    if head[0] != LOCAL_SIGN:
        raise BadPackage(f"no header of {member.name} at {member.header_at}")
    return member.header_at + LOCAL.size + head[9] + head[10]
