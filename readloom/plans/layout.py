"""Barcode layouts: where random bases, the sample index and the replicate code stand at each end of a read.

A layout names each base of an end: N random, X sample index, R or Y replicate
code. R stands for A or G and Y for C or T in replicate A, the other way round
in replicate B. Layouts are compiled on the driver, so plans hold literals only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

#: The named layouts (left end, right end).
PRESETS = {
    "iclip": ("NNNXXXXNN", ""),
    "uvclap": ("NNNXXXXXNN", "YRRYN"),
    "flash": ("", "NNRRNXXXXXXNN"),
    "flash_v1": ("", "NNYYNXXXXXXNN"),
}
#: The bases of a code letter in replicate A, and its partner in B.
CODE_BASES = {"R": "AG", "Y": "CT"}
PARTNER = {"R": "Y", "Y": "R"}


@dataclass(frozen=True)
class Span:
    """Bases [start, end)."""

    start: int
    end: int

    @property
    def size(self) -> int:
        return self.end - self.start


@dataclass(frozen=True)
class Side:
    """One end of a read."""

    pattern: str = ""
    random: tuple[int, ...] = ()
    index: Span | None = None
    code: Span | None = None

    @property
    def size(self) -> int:
        return len(self.pattern)

    @property
    def trimmed(self) -> int:
        """Bases that are cut off at this end; an end without random bases is left as it is."""
        return self.size if self.random else 0

    def code_pattern(self, replicate: str) -> str:
        """Regular expression of the replicate's codes."""
        letters = self.pattern[self.code.start : self.code.end] if self.code else ""
        return "^" + "".join(f"[{CODE_BASES[c if replicate == 'A' else PARTNER[c]]}]" for c in letters) + "$"

    def codes(self, replicate: str) -> list[str]:
        letters = self.pattern[self.code.start : self.code.end] if self.code else ""
        return ["".join(p) for p in product(*(CODE_BASES[c if replicate == "A" else PARTNER[c]] for c in letters))]

    def random_runs(self) -> list[Span]:
        """Neighbouring random bases as one span."""
        runs: list[Span] = []
        for i in self.random:
            if runs and runs[-1].end == i:
                runs[-1] = Span(runs[-1].start, i + 1)
            else:
                runs.append(Span(i, i + 1))
        return runs


def compile_side(pattern: str) -> Side:
    pattern = pattern.upper()
    if not re.fullmatch("[NXRY]*", pattern):
        raise ValueError(f"a layout holds N, X, R and Y only: {pattern!r}")

    def only_run(letters: str) -> Span | None:
        runs = [m.span() for m in re.finditer(f"[{letters}]+", pattern)]
        if len(runs) > 1:
            raise ValueError(f"{letters} must stand together in {pattern!r}")
        return Span(*runs[0]) if runs else None

    return Side(pattern, tuple(i for i, c in enumerate(pattern) if c == "N"), only_run("X"), only_run("RY"))


@dataclass(frozen=True)
class Layout:
    left: Side
    right: Side

    @property
    def indexed(self) -> tuple[str, Span]:
        """The end that holds the sample index, the left one first."""
        side = "left" if self.left.index else "right"
        return side, getattr(self, side).index

    @property
    def coded(self) -> tuple[str, Side] | None:
        """The end that holds the replicate code, the left one first."""
        for name in ("left", "right"):
            if getattr(self, name).code:
                return name, getattr(self, name)
        return None

    @property
    def umi_size(self) -> int:
        return len(self.left.random) + len(self.right.random) + (self.coded[1].code.size if self.coded else 0)


def compile_layout(left: str = "", right: str = "") -> Layout:
    if not left and not right:
        raise ValueError("a layout needs at least one end")
    layout = Layout(compile_side(left), compile_side(right))
    if not (layout.left.index or layout.right.index):
        raise ValueError("a layout needs a sample index (X)")
    return layout


def parse_layout(text: str) -> Layout:
    """A preset's name, or ``L=...,R=...`` with one end or both."""
    name = text.strip().lower()
    if name in PRESETS:
        return compile_layout(*PRESETS[name])
    ends = dict.fromkeys("lr", "")
    for part in name.split(","):
        m = re.fullmatch(r"\s*([lr])\s*=\s*([nxry]+)\s*", part)
        if not m:
            raise ValueError(f"neither a preset nor L=...,R=...: {text!r}")
        ends[m[1]] = m[2]
    return compile_layout(ends["l"], ends["r"])
