"""Thrift's compact protocol, as far as Parquet footers need it: structs to trees and back.

A struct is a dict from field number to (type, value), in the order of the
bytes.  A list or set is a pair (type of its elements, values).  Numbers are
ints, text is bytes.  What is read and not understood is kept, so that writing
a tree gives back every field.
"""

from __future__ import annotations

import struct

#: Fixed by the protocol: wire types.
TRUE, FALSE, BYTE, I16, I32, I64, DOUBLE, BINARY, LIST, SET, MAP, STRUCT = range(1, 13)


class Truncated(ValueError):
    """The bytes end within a value, or can't be one."""


class Reader:
    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def byte(self) -> int:
        if self.at >= len(self.raw):
            raise Truncated("the metadata end within a value")
        self.at += 1
        return self.raw[self.at - 1]

    def varint(self) -> int:
        out = shift = 0
        while True:
            b = self.byte()
            out |= (b & 0x7F) << shift
            if b < 0x80:
                return out
            shift += 7
            if shift > 63:
                raise Truncated("a number is too long")

    def number(self) -> int:
        n = self.varint()
        return n >> 1 ^ -(n & 1)

    def take(self, n: int) -> bytes:
        if n > len(self.raw) - self.at:
            raise Truncated("the metadata end within a value")
        self.at += n
        return self.raw[self.at - n : self.at]

    def value(self, kind: int):
        if kind in (TRUE, FALSE):
            return kind == TRUE
        if kind == BYTE:
            return self.byte()
        if kind in (I16, I32, I64):
            return self.number()
        if kind == DOUBLE:
            return struct.unpack("<d", self.take(8))[0]
        if kind == BINARY:
            return self.take(self.varint())
        if kind in (LIST, SET):
            head = self.byte()
            n, inner = head >> 4, head & 15
            if n == 15:
                n = self.varint()
            if inner in (TRUE, FALSE):  # within lists a flag takes a byte of its own
                return inner, [self.byte() == TRUE for _ in range(n)]
            return inner, [self.value(inner) for _ in range(n)]
        if kind == STRUCT:
            return self.struct()
        if kind == MAP:
            n = self.varint()
            kinds = self.byte() if n else 0
            return kinds, [(self.value(kinds >> 4), self.value(kinds & 15)) for _ in range(n)]
        raise Truncated(f"there is no type {kind}")

    def struct(self) -> dict[int, tuple[int, object]]:
        out: dict[int, tuple[int, object]] = {}
        field = 0
        while head := self.byte():
            kind, step = head & 15, head >> 4
            field = field + step if step else self.number()
            out[field] = (kind, self.value(kind))
        return out


def read(raw: bytes) -> dict[int, tuple[int, object]]:
    return Reader(raw).struct()


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def number(n: int) -> bytes:
    return varint((n << 1 ^ n >> 63) & (1 << 64) - 1)


def write_value(kind: int, value) -> bytes:
    if kind in (TRUE, FALSE):
        return b""
    if kind == BYTE:
        return bytes([value & 255])
    if kind in (I16, I32, I64):
        return number(value)
    if kind == DOUBLE:
        return struct.pack("<d", value)
    if kind == BINARY:
        return varint(len(value)) + value
    if kind in (LIST, SET):
        inner, values = value
        head = bytes([len(values) << 4 | inner]) if len(values) < 15 else bytes([0xF0 | inner]) + varint(len(values))
        return head + b"".join(bytes([TRUE if v else FALSE]) if inner in (TRUE, FALSE) else write_value(inner, v) for v in values)
    if kind == STRUCT:
        return write(value)
    kinds, pairs = value
    return varint(len(pairs)) + (bytes([kinds]) if pairs else b"") + b"".join(write_value(kinds >> 4, k) + write_value(kinds & 15, v) for k, v in pairs)


def write(tree: dict[int, tuple[int, object]]) -> bytes:
    out, last = [], 0
    for field, (kind, value) in sorted(tree.items()):
        if kind in (TRUE, FALSE):
            kind = TRUE if value else FALSE
        step = field - last
        out.append(bytes([step << 4 | kind]) if 0 < step < 16 else bytes([kind]) + number(field))
        out.append(write_value(kind, value))
        last = field
    return b"".join(out) + b"\0"


def get(tree: dict, field: int, default=None):
    """A field's value, or ``default`` where it is absent."""
    return tree[field][1] if field in tree else default
