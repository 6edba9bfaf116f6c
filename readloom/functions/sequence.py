"""Column functions on reads, headers and alignments; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from readloom.plans.layout import Side, Span


def part(seq: Column, span: Span) -> Column:
    """Bases [start, end) of a read."""
    return F.substring(seq, span.start + 1, span.size)


def revcomp(seq: Column) -> Column:
    """Reverse complement; signs other than A, C, G and T stay."""
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def revcomp_head(seq: Column, n: int) -> Column:
    """The first n bases of the reverse complement, without turning the whole read."""
    return revcomp(F.right(seq, F.lit(n)))


def trim(text: Column, first: int, last: int) -> Column:
    """Without ``first`` signs at the start and ``last`` at the end; empty if nothing is left."""
    return F.substring(text, F.lit(first + 1), F.greatest(F.length(text) - (first + last), F.lit(0)))


def random_bases(seq: Column, side: Side) -> list[Column]:
    return [part(seq, run) for run in side.random_runs()]


def joined(parts: list[Column]) -> Column:
    return F.concat(*parts) if parts else F.lit("")


def tagged_name(name: Column, umi: Column) -> Column:
    """The random barcode after a colon behind the first word; words after the second are joined to it."""
    words = F.split(name, " ")
    return F.concat(F.element_at(words, 1), F.lit(":"), umi, F.lit(" "), F.array_join(F.slice(words, F.lit(2), F.size(words)), ""))


def umi_of_name(name: Column) -> Column:
    """What follows the last colon of the name's first word."""
    return F.element_at(F.split(F.element_at(F.split(name, " "), 1), ":"), -1)


def umi_of_header(name: Column) -> Column:
    """Field 7 (from 0) of the header's first word, or null."""
    return F.get(F.split(F.element_at(F.split(name, " "), 1), ":"), F.lit(7))


def first_word(text: Column) -> Column:
    return F.element_at(F.split(text, " "), 1)


def phred_sum(qual: Column) -> Column:
    """Sum of Phred+33 scores; signs out of 33 to 74 are an error."""
    signs = F.split(qual, "")
    total = F.aggregate(F.filter(signs, lambda c: c != ""), F.lit(0), lambda a, c: a + F.ascii(c) - 33)
    bad = F.concat(F.lit("quality signs must lie between ! and J: "), qual)
    return F.when(qual.rlike("^[!-J]*$"), total).otherwise(F.raise_error(bad).cast("int"))


def hamming(a: Column, b: Column, size: int | None = None) -> Column:
    """Places where two texts of one length differ; ``size`` unrolls a known length. Other lengths are an error."""
    if size is not None:
        differ = sum(((F.substring(a, i, 1) != F.substring(b, i, 1)).cast("int") for i in range(1, size + 1)), F.lit(0))
    else:
        pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
        differ = F.aggregate(pairs, F.lit(0), lambda s, x: s + x)
    said = F.concat_ws(" ", F.lit("texts of unequal length:"), a, b)
    return F.when(F.length(a) == F.length(b), differ).otherwise(F.when(a.isNotNull() & b.isNotNull(), F.raise_error(said).cast("int")))


def reference_span(cigar: Column) -> Column:
    """Reference bases that an alignment covers."""
    runs = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), 1)
    return F.aggregate(runs, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))


def anchor(strand: Column, start: Column, end: Column) -> Column:
    """The place where a read begins on its strand."""
    return F.when(strand == "+", start).otherwise(end)


def percent(part_of: Column, whole: Column) -> Column:
    """Rounded hundredths, 0 of nothing."""
    return F.when(whole > 0, F.round(100 * part_of / whole)).otherwise(F.lit(0.0)).cast("double")
