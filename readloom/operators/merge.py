"""Unions and joins between the results of aligners, replicates and read classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.sequence import revcomp


def merge_aligners(*alignments: DataFrame) -> DataFrame:
    """All alignments of all aligners, as often as they come."""
    return reduce(DataFrame.unionByName, alignments)


def unmapped(reads: DataFrame, aligned: DataFrame) -> DataFrame:
    """Reads without an alignment, which a second aligner gets."""
    return reads.join(aligned.select("name").distinct(), "name", "left_anti")


def mapping_input(merged: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """What is mapped: merged reads and, unless left out, the forward reads of pairs."""
    columns = ("sample", "replicate", "name", "seq", "qual")
    out = merged.filter("outcome = 'assigned'").select(*columns, F.lit("merged").alias("read_class"))
    if pairs is None:
        return out
    forward = pairs.filter("outcome = 'assigned'").select("sample", "replicate", F.col("name_f").alias("name"), F.col("seq_f").alias("seq"), F.col("qual_f").alias("qual"), F.lit("pair").alias("read_class"))
    return out.unionByName(forward)


def place_of(reads: DataFrame) -> list[str]:
    """The columns that tell a read's place: its file's number, if there are several files, and its number in the file."""
    return [c for c in ("file_no", "rec_idx") if c in reads.columns]


def pair_up(forward: DataFrame, reverse: DataFrame) -> DataFrame:
    """Mates by their place in two files, or in two lists of files; the longer file's rest is left out."""
    place = [c for c in place_of(forward) if c in reverse.columns]
    f = forward.select(*place, F.col("name").alias("name_f"), F.col("seq").alias("seq_f"), F.col("qual").alias("qual_f"))
    r = reverse.select(*place, F.col("name").alias("name_r"), F.col("seq").alias("seq_r"), F.col("qual").alias("qual_r"))
    return f.join(r, place)


def merge_mates(pairs: DataFrame, *, min_overlap: int = 12, min_insert: int = 30) -> tuple[DataFrame, DataFrame]:
    """Merged reads, and the pairs left over.

    The end of the forward read and the start of the turned reverse read must be
    equal over ``min_overlap`` bases or more; the longest such overlap counts, and
    the merged read has ``min_insert`` bases at least. Where both reads say a base,
    the forward read's quality stays. No shuffle; the overlap is the leftmost
    match of one pattern, and what is used often is bound once.
    """

    def bound(rows: DataFrame, **columns: object) -> DataFrame:
        """Adds columns behind a generator, which the optimizer does not write into each of their uses."""
        return rows.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))

    turned = bound(pairs, other=revcomp(F.col("seq_r")), other_qual=F.reverse("qual_r"))
    shared = F.regexp_extract(F.concat("seq_f", F.lit("|"), "other"), rf"([^|]{{{min_overlap},}}+)\|\1", 1)
    told = bound(turned, overlap=F.length(shared))
    size = F.length("seq_f") + F.length("other") - F.col("overlap")
    merges = F.coalesce((F.col("overlap") > 0) & (size >= min_insert), F.lit(False))
    rest = F.col("overlap") + 1
    merged = told.filter(merges).select(
        *place_of(pairs),
        F.col("name_f").alias("name"),
        F.concat("seq_f", F.substring(F.col("other"), rest, F.length("other"))).alias("seq"),
        F.concat("qual_f", F.substring(F.col("other_qual"), rest, F.length("other"))).alias("qual"),
    )
    return merged, told.filter(~merges).select(*pairs.columns)
