"""Blocked gzip: members that tell their packed size, so that reading can start anywhere."""

from __future__ import annotations

import struct
import zlib

#: Fixed values of the format: a member's first bytes, most bytes packed into a member, and the member that ends a file.
MAGIC, MOST = b"\x1f\x8b\x08\x04", 0xFF00
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Bytes that are read at once, and blocks that must follow one another where a search finds one.
PIECE, CHAIN = 1 << 20, 4


def pack(raw: bytes, level: int = 6) -> bytes:
    """One block."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    data = packer.compress(raw) + packer.flush()
    return MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(data) + 25) + data + struct.pack("<II", zlib.crc32(raw), len(raw))


def block_at(raw: bytes | bytearray, at: int) -> tuple[int, int] | None:
    """(bytes of the block, where its packed data starts), if a block starts there and its head is whole."""
    if raw[at : at + 4] != MAGIC or len(raw) < at + 12:
        return None
    extra = struct.unpack_from("<H", raw, at + 10)[0]
    field, end = at + 12, at + 12 + extra
    while field + 4 <= min(end, len(raw)):
        size = struct.unpack_from("<H", raw, field + 2)[0]
        if raw[field : field + 2] == b"BC" and size == 2 and field + 6 <= len(raw):
            return struct.unpack_from("<H", raw, field + 4)[0] + 1, 12 + extra
        field += 4 + size
    return None


def is_blocked(file) -> bool:
    return block_at(file.read_at(64, 0), 0) is not None


def first_block(file, size: int, start: int) -> int:
    """Where the first block at or behind ``start`` begins; the file's size if there is none.

    Packed data may look like a block's head, so CHAIN blocks must follow one
    another, or all up to the file's end.
    """
    if start <= 0:
        return 0
    raw = file.read_at(min(size - start, (CHAIN + 2) << 16), start) if start < size else b""
    at = raw.find(MAGIC)
    while at >= 0:
        place, chain = at, 0
        while chain < CHAIN and (told := block_at(raw, place)):
            place, chain = place + told[0], chain + 1
        if chain == CHAIN or chain and start + place == size:
            return start + at
        at = raw.find(MAGIC, at + 1)
    return size


class Stream:
    """The inflated bytes from a block on. A place is the block's start in the file, shifted by 16 bits, plus the place in the block."""

    def __init__(self, file, size: int, block: int, within: int = 0):
        self.file, self.size, self.next, self.packed, self.taken = file, size, block, b"", 0
        self.held, self.used, self.blocks = bytearray(), 0, []
        if within:
            self.skip(within)

    def more(self) -> bool:
        """Inflates one more block."""
        told = block_at(self.packed, self.taken)
        while told is None or told[0] > len(self.packed) - self.taken:
            left = self.packed[self.taken :]
            got = self.file.read_at(min(PIECE, self.size - self.next - len(left)), self.next + len(left))
            if not got:
                if left:
                    raise ValueError("the file ends within a block")
                return False
            self.packed, self.taken = left + got, 0
            told = block_at(self.packed, 0)
            if told is None and len(self.packed) >= 1 << 16:
                raise ValueError(f"no block at {self.next}")
        size, data = told
        self.blocks.append((len(self.held), self.next))
        self.held += zlib.decompress(self.packed[self.taken + data : self.taken + size - 8], -15)
        self.taken, self.next = self.taken + size, self.next + size
        return True

    def there(self, n: int) -> bool:
        """Whether ``n`` more bytes follow; makes them ready."""
        while len(self.held) - self.used < n:
            if not self.more():
                return False
        return True

    def held_of_block(self) -> int:
        """How many bytes of the next byte's block follow; more than none but at the file's end."""
        self.there(1)
        return next((at for at, _ in self.blocks if at > self.used), len(self.held)) - self.used

    def read(self, n: int) -> bytes:
        self.there(n)
        out = bytes(self.held[self.used : self.used + n])
        self.skip(len(out))
        return out

    def skip(self, n: int) -> None:
        self.there(n)
        self.used += n
        if self.used > PIECE:
            while len(self.blocks) > 1 and self.blocks[1][0] <= self.used:
                self.blocks.pop(0)
            cut = self.blocks[0][0]
            del self.held[:cut]
            self.used, self.blocks = self.used - cut, [(at - cut, block) for at, block in self.blocks]

    def place(self) -> int:
        """Of the next byte; behind the last one, the file's size shifted."""
        if not self.there(1):
            return self.size << 16
        start, block = next((at, block) for at, block in reversed(self.blocks) if at <= self.used)
        return block << 16 | self.used - start


class Writer:
    """Packs what is put into blocks; a piece starts a new block if it does not fit and is no longer than one."""

    def __init__(self, out):
        self.out, self.held, self.at = out, bytearray(), 0

    def put(self, raw: bytes) -> tuple[int, int]:
        """The places where it starts and ends."""
        if self.held and len(self.held) + len(raw) > MOST:
            self.flush()
        start = self.at << 16 | len(self.held)
        self.held += raw
        while len(self.held) > MOST:
            self.flush()
        return start, self.at << 16 | len(self.held)

    def flush(self) -> None:
        if self.held:
            block = pack(bytes(self.held[:MOST]))
            del self.held[:MOST]
            self.out.write(block)
            self.at += len(block)
