"""ZIP packages read by ranges: central directory, ZIP64 directory, stored members; and a writer of stored members.

A reader is a function (offset, length) -> bytes over the package plus its
size, so members are located, and parts of them read, without extracting
anything. Fixed values: the signatures and field widths of the ZIP format.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass

Ranges = Callable[[int, int], bytes]

# Record signatures, fixed parts, and the marks "look in the ZIP64 fields".
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
LOCAL_FIELDS, CENTRAL_FIELDS = struct.Struct("<4s5H3L2H"), struct.Struct("<4s6H3L5H2L")
END_FIELDS, END64_FIELDS, LOCATOR_FIELDS = struct.Struct("<4s4H2LH"), struct.Struct("<4sQ2H2L4Q"), struct.Struct("<4sLQL")
FULL16, FULL32, ZIP64_EXTRA = 0xFFFF, 0xFFFFFFFF, 0x0001
UTF8_NAME, ENCRYPTED, STORED, DEFLATED = 0x800, 0x1, 0, 8
LONGEST_COMMENT = 0xFFFF
DOS_DATE = 0x21  # 1980-01-01, so that equal members give equal packages


class PackageError(ValueError):
    """A package that cannot be read by ranges, or is damaged."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    crc: int
    packed: int
    size: int
    header: int  # offset of the local header


def in_memory(content: bytes) -> tuple[Ranges, int]:
    view = memoryview(content)
    return (lambda offset, n: bytes(view[offset:offset + n])), len(view)


def of_file(fd: int) -> tuple[Ranges, int]:
    """Ranges of an open file descriptor (a mounted store)."""
    return (lambda offset, n: os.pread(fd, n, offset)), os.fstat(fd).st_size


def _exact(read: Ranges, offset: int, n: int) -> bytes:
    got = read(offset, n) if offset >= 0 else b""
    if len(got) != n:
        raise PackageError(f"package ends inside a range: {n} bytes at {offset}, {len(got)} there")
    return got


def _end(read: Ranges, size: int) -> tuple[int, tuple]:
    """(offset, fields) of the end record: the last one whose comment reaches exactly to the end."""
    start = max(0, size - END_FIELDS.size - LONGEST_COMMENT)
    tail = _exact(read, start, size - start)
    at = tail.rfind(END)
    while at >= 0:
        if at + END_FIELDS.size <= len(tail):
            fields = END_FIELDS.unpack_from(tail, at)
            if at + END_FIELDS.size + fields[7] == len(tail):
                return start + at, fields
        at = tail.rfind(END, 0, at)
    raise PackageError("no end of central directory: not a ZIP package")


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Replace the values that say so by those of the ZIP64 extra field, which holds just these, in this order."""
    at = 0
    while FULL32 in values and at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            field, used, out = extra[at + 4:at + 4 + n], 0, []
            for v in values:
                if v == FULL32:
                    if used + 8 > len(field):
                        raise PackageError("ZIP64 field too short")
                    v, used = struct.unpack_from("<Q", field, used)[0], used + 8
                out.append(v)
            return out
        at += 4 + n
    return values


def directory(read: Ranges, size: int) -> dict[str, Member]:
    """Members by name, from the central directory (ZIP64 where there is one); bytes before the package are allowed."""
    end, (_, disk, start_disk, _, count, length, offset, _) = _end(read, size)
    if disk not in (0, FULL16) or start_disk not in (0, FULL16):
        raise PackageError("package of several parts")
    after = end  # what the directory reaches to
    if end >= LOCATOR_FIELDS.size:
        signature, _, where, _ = LOCATOR_FIELDS.unpack(_exact(read, end - LOCATOR_FIELDS.size, LOCATOR_FIELDS.size))
        if signature == LOCATOR:
            where = _end64(read, where, end - LOCATOR_FIELDS.size)
            _, _, _, _, _, _, _, count, length, offset = END64_FIELDS.unpack(_exact(read, where, END64_FIELDS.size))
            after = where
    before = after - length - offset  # bytes put before the package
    if before < 0:
        raise PackageError("central directory out of place")
    raw, at, members = _exact(read, after - length, length), 0, {}
    for _ in range(count):
        if raw[at:at + 4] != CENTRAL or at + CENTRAL_FIELDS.size > len(raw):
            raise PackageError("damaged central directory")
        _, _, _, flags, method, _, _, crc, packed, unpacked, n_name, n_extra, n_comment, _, _, _, header = CENTRAL_FIELDS.unpack_from(raw, at)
        at += CENTRAL_FIELDS.size
        name = raw[at:at + n_name].decode("utf-8" if flags & UTF8_NAME else "cp437")
        unpacked, packed, header = _wide(raw[at + n_name:at + n_name + n_extra], [unpacked, packed, header])
        members[name] = Member(name, method, flags, crc, packed, unpacked, header + before)
        at += n_name + n_extra + n_comment
    return members


def _end64(read: Ranges, declared: int, latest: int) -> int:
    """Offset of the ZIP64 end record: where declared, or right before its locator if bytes were put before the package."""
    for where in (declared, latest - END64_FIELDS.size):
        if 0 <= where <= latest - END64_FIELDS.size and read(where, 4) == END64:
            return where
    raise PackageError("ZIP64 end record not found")


def place(read: Ranges, member: Member) -> int:
    """Offset of a member's first byte: the local header has lengths of its own."""
    head = _exact(read, member.header, LOCAL_FIELDS.size)
    fields = LOCAL_FIELDS.unpack(head)
    if fields[0] != LOCAL:
        raise PackageError(f"no local header for {member.name}")
    return member.header + LOCAL_FIELDS.size + fields[9] + fields[10]


def stored_at(read: Ranges, member: Member) -> int:
    """As ``place``, for a member that can be read by ranges: stored and not encrypted."""
    if member.method != STORED or member.flags & ENCRYPTED:
        raise PackageError(f"{member.name} is not stored plainly: its records cannot be read by ranges")
    return place(read, member)


def whole(read: Ranges, member: Member) -> bytes:
    """All of a small member (an index), stored or deflated, checked against its sum."""
    if member.flags & ENCRYPTED or member.method not in (STORED, DEFLATED):
        raise PackageError(f"{member.name}: neither stored nor deflated")
    raw = _exact(read, place(read, member), member.packed)
    content = raw if member.method == STORED else zlib.decompress(raw, -zlib.MAX_WBITS)
    if len(content) != member.size or zlib.crc32(content) != member.crc:
        raise PackageError(f"{member.name} is damaged")
    return content


def pack(members: Iterable[tuple[str, bytes]], comment: bytes = b"", zip64: bool = True) -> bytes:
    """A package of stored members. ``zip64``: sizes, places and the directory in ZIP64 fields; they are used in any
    case where a value does not fit the narrow ones."""
    out, central, count = bytearray(), bytearray(), 0
    for name, content in members:
        raw, crc, n, at = name.encode(), zlib.crc32(content), len(content), len(out)
        wide = zip64 or n >= FULL32 or at >= FULL32
        size, where = (FULL32, FULL32) if wide else (n, at)
        version = 45 if wide else 20
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, n, n) if wide else b""
        out += LOCAL_FIELDS.pack(LOCAL, version, UTF8_NAME, STORED, 0, DOS_DATE, crc, size, size, len(raw), len(extra)) + raw + extra + content
        extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, n, n, at) if wide else b""
        central += CENTRAL_FIELDS.pack(CENTRAL, version, version, UTF8_NAME, STORED, 0, DOS_DATE, crc, size, size, len(raw), len(extra), 0, 0, 0, 0,
                                       where) + raw + extra
        count += 1
    start, length = len(out), len(central)
    out += central
    wide = zip64 or count >= FULL16 or start >= FULL32 or length >= FULL32
    if wide:
        end64 = len(out)
        out += END64_FIELDS.pack(END64, END64_FIELDS.size - 12, 45, 45, 0, 0, count, count, length, start)
        out += LOCATOR_FIELDS.pack(LOCATOR, 0, end64, 1)
    entries, length, start = (FULL16, FULL32, FULL32) if wide else (count, length, start)
    out += END_FIELDS.pack(END, 0, 0, entries, entries, length, start, len(comment)) + comment
    return bytes(out)
