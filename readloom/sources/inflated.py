"""Gzip read from its start, a slice at a time."""

from __future__ import annotations

import zlib

#: Packed bytes that are inflated at once.
SLICE = 1 << 16


class Inflated:
    """Reads a sequence of gzip members as one run of bytes, a slice of the packed bytes at a time."""

    def __init__(self, file):
        self.file, self.held, self.used, self.member = file, bytearray(), 0, zlib.decompressobj(31)

    def more(self) -> bool:
        """Inflates the next slice; what is left of a slice when a member ends starts the next member."""
        left = self.file.read(SLICE)
        if not left:
            return False
        self.held += self.member.decompress(left)
        while self.member.eof:
            rest = self.member.unused_data
            self.member = zlib.decompressobj(31)
            if not rest:
                break
            self.held += self.member.decompress(rest)
        return True

    def read(self, n: int) -> bytes:
        if self.used > SLICE << 4:
            del self.held[: self.used]
            self.used = 0
        while len(self.held) - self.used < n and self.more():
            pass
        out = bytes(self.held[self.used : self.used + n])
        self.used += len(out)
        return out
