"""The binning index of a sorted BAM file, gathered by the tasks that write its parts."""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

from readloom.sources.bam_records import WINDOW, Head, bin_of, bins_over
from readloom.sources.storage import located

#: Longest contig that the index can tell places of.
LONGEST = 1 << 29


def parsed_region(region: str, head: Head) -> tuple[int, int, int]:
    """(contig's number, start, end) of ``contig``, ``contig:first`` or ``contig:first-last``."""
    name, first, last = region, None, None
    if region not in head.names and (told := re.fullmatch(r"(.+):([\d,]+)(?:-([\d,]+))?", region)):
        name, first, last = told.groups()
    if name not in head.names:
        raise ValueError(f"no contig of this name: {region}")
    ref = head.names.index(name)
    start = int(first.replace(",", "")) - 1 if first else 0
    return ref, max(start, 0), int(last.replace(",", "")) if last else max(head.sizes[ref], start + 1)


@dataclass
class PartIndex:
    """Chunks of places by contig and bin, the first place in each window, records without a contig, and the part's packed bytes."""

    bins: dict = field(default_factory=dict)
    windows: dict = field(default_factory=dict)
    unplaced: int = 0
    bytes: int = 0

    def add(self, ref: int, start: int, end: int, first: int, last: int) -> None:
        if ref < 0:
            self.unplaced += 1
            return
        if end > LONGEST:
            raise ValueError("the index ends at position 2^29")
        start = max(start, 0)
        add_chunk(self.bins.setdefault(ref, {}).setdefault(bin_of(start, max(end, start + 1)), []), first, last)
        windows = self.windows.setdefault(ref, {})
        for w in range(start >> WINDOW, ((max(end, start + 1) - 1) >> WINDOW) + 1):
            windows.setdefault(w, first)


def add_chunk(chunks: list[tuple[int, int]], first: int, last: int) -> None:
    """Chunks that share a block, or touch, become one."""
    if chunks and first >> 16 <= chunks[-1][1] >> 16:
        chunks[-1] = (chunks[-1][0], max(last, chunks[-1][1]))
    else:
        chunks.append((first, last))


class Index:
    """bins and windows of each contig."""

    def __init__(self, bins: list[dict[int, list[tuple[int, int]]]], windows: list[list[int]], unplaced: int = 0):
        self.bins, self.windows, self.unplaced = bins, windows, unplaced

    @classmethod
    def joined(cls, parts: Iterable[PartIndex], before: int, contigs: int) -> Index:
        """Of parts that follow one another behind ``before`` packed bytes."""
        bins: list[dict] = [defaultdict(list) for _ in range(contigs)]
        first: list[dict[int, int]] = [{} for _ in range(contigs)]
        unplaced = 0
        for part in parts:
            shift = before << 16
            for ref, own in part.bins.items():
                for b, chunks in own.items():
                    for a, z in chunks:
                        add_chunk(bins[ref][b], a + shift, z + shift)
            for ref, own in part.windows.items():
                for w, place in own.items():
                    first[ref].setdefault(w, place + shift)
            unplaced += part.unplaced
            before += part.bytes
        windows = []
        for own in first:
            filled, last = [], 0
            for w in range(max(own, default=-1) + 1):
                last = own.get(w, last)
                filled.append(last)
            windows.append(filled)
        return cls(bins, windows, unplaced)

    @classmethod
    def of_file(cls, path: str) -> Index:
        system, own = located(path)
        with system.open_input_stream(own, compression=None) as file:
            raw = file.read()
        if raw[:4] != b"BAI\1":
            raise ValueError(f"not an index: {path}")
        at = 4

        def numbers(kind: str, n: int = 1) -> tuple:
            nonlocal at
            out = struct.unpack_from(f"<{n}{kind}", raw, at)
            at += struct.calcsize(f"<{n}{kind}")
            return out

        bins, windows = [], []
        for _ in range(numbers("i")[0]):
            own_bins = {}
            for _ in range(numbers("i")[0]):
                b, n = numbers("I")[0], numbers("i")[0]
                places = numbers("Q", 2 * n)
                own_bins[b] = list(zip(places[::2], places[1::2], strict=True))
            bins.append(own_bins)
            windows.append(list(numbers("Q", numbers("i")[0])))
        return cls(bins, windows, numbers("Q")[0] if at + 8 <= len(raw) else 0)

    def to_file(self, path: str) -> None:
        system, own = located(path)
        with system.open_output_stream(own, compression=None) as out:
            out.write(b"BAI\1" + struct.pack("<i", len(self.bins)))
            for bins, windows in zip(self.bins, self.windows, strict=True):
                out.write(struct.pack("<i", len(bins)))
                for b, chunks in sorted(bins.items()):
                    out.write(struct.pack(f"<Ii{2 * len(chunks)}Q", b, len(chunks), *(x for c in chunks for x in c)))
                out.write(struct.pack(f"<i{len(windows)}Q", len(windows), *windows))
            out.write(struct.pack("<Q", self.unplaced))

    def places(self, ref: int, start: int, end: int) -> list[tuple[int, int]]:
        """Chunks that may hold records over [start, end), joined where they touch."""
        end = min(end, LONGEST)
        windows = self.windows[ref]
        least = windows[min(start >> WINDOW, len(windows) - 1)] if windows else 0
        own = self.bins[ref]
        found = sorted(c for b in bins_over(start, end) for c in own.get(b, []) if c[1] > least)
        out: list[tuple[int, int]] = []
        for first, last in found:
            add_chunk(out, max(first, least), last)
        return out
