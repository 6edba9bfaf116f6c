"""Removal of duplicates: reads by sequence and barcode, alignments by place and barcode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.sequence import anchor, hamming, percent, phred_sum, umi_of_header, umi_of_name
from readloom.operators.merge import place_of

#: Order in which alignments are compared; the name compares as a line whose colons are spaces.
ORDER = ("start_pos", "end_pos", "umi", "mapq", "strand", "line_key")
#: Bases of a bin; bins of one chromosome are windows of their own, joined at their borders.
BIN = 10_000
#: Alignments beyond which a bin is cut further, and how many bins are (those beyond hold less than one part of so many).
HOT, HOT_BINS = 100_000, 10_000
#: Letters of the barcode that tell the cuts of a place in such a bin.
CUT = 2


def best_reads(reads: DataFrame, *, with_umi: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """The read with the greatest Phred sum for each sequence and barcode, the first one of equals.

    First by the file's number, if the reads have one, then by the number in the
    file. One aggregate with map-side combination; the reference to the read
    travels in the maximum, so no second pass is needed.
    """
    place = place_of(reads)
    umi = F.coalesce(umi_of_header(F.col("name")), F.lit("")) if with_umi else F.lit("")
    scored = reads.withColumns({"umi": umi, "phred": phred_sum(F.col("qual"))})
    best = F.max(F.struct("phred", *((-F.col(c)).alias(c) for c in place), "name", "qual"))
    kept = scored.groupBy(*by, "seq", "umi").agg(best.alias("best"))
    return kept.select(*by, *((-F.col(f"best.{c}")).alias(c) for c in place), "best.name", "seq", "best.qual", "umi", "best.phred")


def read_stats(reads: DataFrame, kept: DataFrame) -> DataFrame:
    """n_total, n_kept, n_removed and percent_removed."""
    both = reads.select(F.lit(0).alias("kept")).union(kept.select(F.lit(1)))
    sums = both.agg(F.count_if(F.col("kept") == 0).alias("n_total"), F.count_if(F.col("kept") == 1).alias("n_kept"))
    removed = F.col("n_total") - F.col("n_kept")
    return sums.select("n_total", "n_kept", removed.alias("n_removed"), percent(removed, F.col("n_total")).alias("percent_removed"))


def best_documents(docs: DataFrame) -> DataFrame:
    """The same for texts: the longest count wins, then the first id."""
    best = F.max(F.struct("n_chars", (-F.col("doc_id")).alias("order")))
    return docs.groupBy(F.sha1("text").alias("digest")).agg(best.alias("best"), F.count("*").alias("n_copies")).select("digest", (-F.col("best.order")).alias("doc_id"), "best.n_chars", "n_copies")


def keyed(bed: DataFrame) -> DataFrame:
    return bed.withColumns({"umi": umi_of_name(F.col("name")), "line_key": F.translate("name", ":", " ")})


def checked_strand(strand: Column) -> Column:
    return F.when(strand.isin("+", "-"), strand).otherwise(F.raise_error(F.concat(F.lit("no such strand: "), F.coalesce(strand, F.lit("null")))).cast("string"))


def same_keys(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equal in all columns, two nulls included."""
    out = F.lit(True)
    for c in columns:
        out = out & left[c].eqNullSafe(right[c])
    return out


def following(cuts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``by``, chrom, bin, after (the first row of what follows each cut of a chromosome) and final (a file's last cut, if the file has several rows).

    ``cuts``: ``by``, chrom, bin (start_bin, s, e, u), first, there. What follows is
    looked for within one place and end, then within one place, one bin and the
    chromosome, each time among the firsts of the next finer level. So no window
    has more rows than there are barcode letters, ends of a place, places of
    a bin, or bins of a chromosome, however many cuts there are in all.
    """
    group, parts = [*by, "chrom"], ["start_bin", "s", "e", "u"]
    apart = cuts.select(*group, *(F.col(f"bin.{p}").alias(p) for p in parts), "first", "there")
    level, found = apart, []
    for n in range(len(parts) - 1, -1, -1):
        level = level.groupBy(*group, *parts[: n + 1]).agg(F.min("first").alias("first"), F.sum("there").alias("there")) if found else level
        found.append(level.withColumn(f"after_{n}", F.lead("first").over(Window.partitionBy(*group, *parts[:n]).orderBy(parts[n]))).drop("first", "there"))
    out = found[0]
    for n, coarser in zip(range(len(parts) - 2, -1, -1), found[1:], strict=True):
        keys = [*group, *parts[: n + 1]]
        out = out.join(coarser, same_keys(out, coarser, keys), "left").select(*(out[c] for c in out.columns), f"after_{n}")
    ends = level.groupBy(*by).agg(F.max("chrom").alias("last_chrom"), F.sum("there").alias("all_there")).withColumn("whole", F.lit(1))
    out = out.withColumns({"whole": F.lit(1), "after": F.coalesce(*(f"after_{n}" for n in range(len(parts) - 1, -1, -1)))})
    joined = out.join(ends, same_keys(out, ends, [*by, "whole"]), "left").select(*(out[c] for c in out.columns), "last_chrom", "all_there")
    final = F.col("after").isNull() & F.col("chrom").eqNullSafe(F.col("last_chrom")) & (F.col("all_there") > 1)
    return joined.select(*group, F.struct(*parts).alias("bin"), "after", final.alias("final"))


def flagged(bed: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row for alignments of equal place, barcode, mapq and strand: n, row (the last one's columns), is_duplicate, is_last.

    In ORDER an alignment is a duplicate if the next one has the same strand and
    anchor and a barcode of at most one mismatch. So all alignments that differ
    in their name only are duplicates but the last: they are combined before
    the shuffle, and is_duplicate tells of the last one. is_last marks the last
    alignment of a file with two or more.

    ``bed``: chrom, start_pos, end_pos, name, mapq, strand; ``by`` names files
    or samples. A chromosome is cut into bins by start, a bin with a pile-up of
    reads by place and barcode too, and the last row of a bin is compared with
    the first of the next bin that has rows (see ``following``), so neither a deep
    chromosome nor one locus is one task's window.
    """
    group = [*by, "chrom"]
    equal = [*group, *ORDER[:-1]]
    start_bin = F.floor(F.col("start_pos") / BIN).alias("start_bin")
    counts = bed.select(*group, start_bin).groupBy(*group, "start_bin").agg(F.count("*").alias("n")).filter(F.col("n") > HOT)
    hot = F.broadcast(counts.orderBy(F.desc("n")).limit(HOT_BINS).drop("n").withColumn("hot", F.lit(True)))
    combined = keyed(bed.withColumn("strand", checked_strand(F.col("strand")))).groupBy(*equal).agg(F.max(F.struct("line_key", *bed.columns)).alias("row"), F.count("*").alias("n")).withColumn("start_bin", start_bin)
    marked = combined.join(hot, same_keys(combined, hot, [*group, "start_bin"]), "left").select(*(combined[c] for c in combined.columns), "hot")
    inner = lambda column: F.when(F.col("hot"), column)
    cut = F.struct("start_bin", inner(F.col("start_pos")).alias("s"), inner(F.col("end_pos")).alias("e"), inner(F.left("umi", F.lit(CUT))).alias("u"))
    rows = marked.withColumn("bin", cut).drop("start_bin", "hot")

    order = list(ORDER[:-1])
    cuts = rows.groupBy(*group, "bin").agg(F.min(F.struct(*order)).alias("first"), F.sum("n").alias("there"))
    borders = following(cuts, by)
    inside = Window.partitionBy(*group, "bin").orderBy(*order)
    led = rows.withColumn("within", F.lead(F.struct(*order)).over(inside))
    joined = led.join(borders, same_keys(led, borders, [*group, "bin"]), "left").select(*(led[c] for c in led.columns), "after", "final")
    told = joined.withColumn("next", F.coalesce("within", "after"))
    same = (F.col("strand") == F.col("next.strand")) & (anchor(F.col("strand"), F.col("start_pos"), F.col("end_pos")) == anchor(F.col("next.strand"), F.col("next.start_pos"), F.col("next.end_pos")))
    near = F.when(same, hamming(F.col("umi"), F.col("next.umi")) <= 1).otherwise(False)
    last = F.col("final") & F.col("within").isNull()
    return told.select(*by, "mapq", "n", "row", F.coalesce(near, F.lit(False)).alias("is_duplicate"), F.coalesce(last, F.lit(False)).alias("is_last"))


def survives(min_mapq: int, strict: bool) -> Column:
    kept = ~F.col("is_duplicate") & (F.col("mapq") >= min_mapq)
    return kept & ~F.col("is_last") if strict else kept


def dedup_alignments(bed: DataFrame, *, min_mapq: int = 10, strict: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """Alignments that are no duplicate and, after that test, have ``min_mapq``.

    With ``strict`` the last alignment of each file in order is never kept (if
    the file has more than one), without it is.
    """
    return flagged(bed, by).filter(survives(min_mapq, strict)).select(*(F.col("row")[c].alias(c) for c in bed.columns))


def alignment_stats(bed: DataFrame, *, min_mapq: int = 10, strict: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """n_total, n_kept, n_duplicates, n_low_quality and the percentages kept and removed, for each file, in one pass."""
    total, zero = F.coalesce(F.sum("n"), F.lit(0)), F.lit(0)
    duplicates = F.coalesce(F.sum(F.col("n") - F.when(F.col("is_duplicate"), 0).otherwise(1)), zero)
    counts = flagged(bed, by).groupBy(*by).agg(total.alias("n_total"), F.count_if(survives(min_mapq, strict)).alias("n_kept"), duplicates.alias("n_duplicates"), F.count_if(~F.col("is_duplicate") & (F.col("mapq") < min_mapq)).alias("n_low_quality"))
    return counts.select(*by, "n_total", "n_kept", "n_duplicates", "n_low_quality", percent(F.col("n_kept"), F.col("n_total")).alias("percent_kept"), percent(F.col("n_total") - F.col("n_kept"), F.col("n_total")).alias("percent_removed"))


def keep_by_name(sam: DataFrame, kept: DataFrame) -> DataFrame:
    """Alignment lines whose read name was kept, in their own file if both tell files, each line once."""
    keys = ["qname", *(["file"] if "file" in sam.columns and "file" in kept.columns else [])]
    names = kept.withColumn("qname", F.col("name")).select(*keys).distinct()
    return sam.join(names, keys, "left_semi").distinct()
