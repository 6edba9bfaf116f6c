"""BAM records as SAM fields and back, and where they lie in the binning index."""

from __future__ import annotations

import re
import struct
from typing import NamedTuple

#: Fixed values of the format: letters of alignment operations, of bases by number, struct codes of tag types, and the bases of the reference that operations cover.
OPERATIONS, BASES, COVERING = "MIDNSHP=X", "=ACMGRSVTWYHKDBN", "MDN=X"
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
#: Least and greatest whole number of each tag type, the shortest ones first.
WHOLE = (("c", -(1 << 7), (1 << 7) - 1), ("C", 0, (1 << 8) - 1), ("s", -(1 << 15), (1 << 15) - 1), ("S", 0, (1 << 16) - 1), ("i", -(1 << 31), (1 << 31) - 1), ("I", 0, (1 << 32) - 1))
HEAD = struct.Struct("<iiBBHHHiiii")
DIGITS = "0123456789abcdef"
TO_BASES = str.maketrans(DIGITS, BASES)
SHOWN, SCORED = bytes(min(i + 33, 255) for i in range(256)), bytes(max(i - 33, 0) for i in range(256))
CIGAR = re.compile(r"(\d+)([MIDNSHP=X])")
#: Fixed values of the index: bits of its smallest bin and window, and levels of bins above it.
WINDOW, LEVELS = 14, 5


class Digits(dict):
    """Hexadecimal digits of bases; what the format has no number for is an N."""

    def __missing__(self, key: int) -> str:
        return DIGITS[BASES.index("N")]


TO_DIGITS = Digits({ord(c): DIGITS[i] for i, b in enumerate(BASES) for c in (b, b.lower())})


class Head(NamedTuple):
    """Text of a BAM file's header, its contigs' names and sizes, and the place of the first record (inflated bytes before it)."""

    text: str
    names: list[str]
    sizes: list[int]
    length: int


def head_of(read) -> Head:
    """``read(n)`` gives the next n bytes of a file from its start."""
    if read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    number = lambda: struct.unpack("<i", read(4))[0]
    size = number()
    text, names, sizes, length = read(size).rstrip(b"\0").decode(), [], [], 12 + size
    for _ in range(number()):
        n = number()
        names.append(read(n)[:-1].decode())
        sizes.append(number())
        length += 8 + n
    return Head(text, names, sizes, length)


def head_bytes(text: str, names: list[str], sizes: list[int]) -> bytes:
    raw = text.encode()
    out = b"BAM\1" + struct.pack("<i", len(raw)) + raw + struct.pack("<i", len(names))
    for name, size in zip(names, sizes, strict=True):
        out += struct.pack("<i", len(name.encode()) + 1) + name.encode() + b"\0" + struct.pack("<i", size)
    return out


def tags_of(raw: bytes) -> list[str]:
    out, at = [], 0
    while at < len(raw):
        name, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(0, at)
            out.append(f"{name}:{kind}:{raw[at:end].decode()}")
            at = end + 1
        elif kind == "A":
            out.append(f"{name}:A:{chr(raw[at])}")
            at += 1
        elif kind == "B":
            inner, n = chr(raw[at]), struct.unpack_from("<i", raw, at + 1)[0]
            values = struct.unpack_from(f"<{n}{NUMBERS[inner]}", raw, at + 5)
            out.append(f"{name}:B:{inner}," + ",".join(f"{v:g}" if inner == "f" else str(v) for v in values))
            at += 5 + n * struct.calcsize(NUMBERS[inner])
        else:
            (value,) = struct.unpack_from(f"<{NUMBERS[kind]}", raw, at)
            out.append(f"{name}:f:{value:g}" if kind == "f" else f"{name}:i:{value}")
            at += struct.calcsize(NUMBERS[kind])
    return out


def tag_bytes(tag: str) -> bytes:
    name, kind, value = tag.split(":", 2)
    if kind == "i":
        letter = next(k for k, low, high in WHOLE if low <= int(value) <= high)
        packed = letter.encode() + struct.pack(f"<{NUMBERS[letter]}", int(value))
    elif kind == "f":
        packed = b"f" + struct.pack("<f", float(value))
    elif kind == "B":
        inner, *items = value.split(",")
        packed = b"B" + inner.encode() + struct.pack(f"<i{len(items)}{NUMBERS[inner]}", len(items), *(float(x) if inner == "f" else int(x) for x in items))
    else:
        packed = kind.encode() + value.encode() + (b"" if kind == "A" else b"\0")
    return name.encode() + packed


def record(raw: bytes, names: list[str]) -> tuple:
    """The fields of a record without its leading size."""
    ref, pos, name_size, mapq, _, cigar_size, flag, seq_size, next_ref, next_pos, tlen = HEAD.unpack_from(raw)
    at = 32 + name_size
    name = raw[32 : at - 1].decode()
    cigar = "".join(f"{r >> 4}{OPERATIONS[r & 15]}" for r in struct.unpack_from(f"<{cigar_size}I", raw, at)) or "*"
    at += 4 * cigar_size
    end = at + (seq_size + 1) // 2
    seq = raw[at:end].hex().translate(TO_BASES)[:seq_size] or "*"
    qual = raw[end : end + seq_size]
    shown = "*" if not qual or qual[0] == 255 else qual.translate(SHOWN).decode("latin-1")
    where = lambda i: names[i] if i >= 0 else "*"
    near = "=" if next_ref == ref and ref >= 0 else where(next_ref)
    return name, flag, where(ref), pos + 1, mapq, cigar, near, next_pos + 1, tlen, seq, shown, tags_of(raw[end + seq_size :])


def span_of(cigar: str) -> int:
    """Reference bases that an alignment covers."""
    return sum(int(n) for n, op in CIGAR.findall(cigar) if op in COVERING)


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds [start, end)."""
    for level in range(LEVELS, -1, -1):
        shift = WINDOW + 3 * (LEVELS - level)
        if start >> shift == (end - 1) >> shift:
            return ((1 << 3 * level) - 1) // 7 + (start >> shift)
    return 0


def bins_over(start: int, end: int) -> list[int]:
    """All bins that may hold what overlaps [start, end)."""
    out = []
    for level in range(LEVELS + 1):
        shift, first = WINDOW + 3 * (LEVELS - level), ((1 << 3 * level) - 1) // 7
        out += range(first + (start >> shift), first + ((end - 1) >> shift) + 1)
    return out


def record_bytes(row: dict, ref_of: dict[str, int]) -> tuple[bytes, int, int, int]:
    """(the record with its size, contig's number or -1, start, end) of SAM fields."""
    ref = ref_of.get(row["rname"], -1)
    if ref < 0 and row["rname"] not in ("*", None):
        raise ValueError(f"the header has no contig {row['rname']}")
    cigar, seq, qual = row["cigar"] or "*", "" if row["seq"] in ("*", None) else row["seq"], row["qual"] or "*"
    runs = [int(n) << 4 | OPERATIONS.index(op) for n, op in CIGAR.findall(cigar)]
    if len(runs) > 65535 or "".join(f"{r >> 4}{OPERATIONS[r & 15]}" for r in runs) != cigar.replace("*", ""):
        raise ValueError(f"not a CIGAR that a record holds: {cigar[:80]}")
    if qual != "*" and len(qual) != len(seq):
        raise ValueError(f"{row['qname']}: sequence and qualities differ in length")
    start = row["pos"] - 1
    end = start + max(1, span_of(cigar))
    near = ref if row["rnext"] == "=" else ref_of.get(row["rnext"], -1)
    name = row["qname"].encode()
    if len(name) > 254:
        raise ValueError(f"name is too long: {row['qname'][:80]}")
    body = HEAD.pack(ref, start, len(name) + 1, row["mapq"], bin_of(max(start, 0), max(end, 1)) if start >= 0 else 4680, len(runs), row["flag"], len(seq), near, row["pnext"] - 1, row["tlen"])
    body += name + b"\0" + struct.pack(f"<{len(runs)}I", *runs) + bytes.fromhex(seq.translate(TO_DIGITS) + "0" * (len(seq) % 2))
    body += b"\xff" * len(seq) if qual == "*" else qual.encode("latin-1").translate(SCORED)
    body += b"".join(map(tag_bytes, row["tags"] or []))
    return struct.pack("<i", len(body)) + body, ref, start, end


def size_if_record(raw: bytes | bytearray, at: int, sizes: list[int]) -> int | None:
    """Bytes of the record that may start there, with its size; None if none does. ``raw`` must have 36 bytes from there."""
    size, ref, pos, name_size, _, _, cigar_size, _, seq_size, next_ref, next_pos, _ = struct.unpack_from("<iiiBBHHHiiii", raw, at)
    least = 32 + name_size + 4 * cigar_size + (seq_size + 1) // 2 + seq_size
    if seq_size < 0 or name_size < 1 or size < least:
        return None
    for r, p in ((ref, pos), (next_ref, next_pos)):
        if not -1 <= r < len(sizes) or p < -1 or r >= 0 and p > sizes[r]:
            return None
    end = at + 35 + name_size
    if end < len(raw) and (raw[end] or any(not 32 < b < 127 for b in raw[at + 36 : end])):
        return None
    return size + 4
