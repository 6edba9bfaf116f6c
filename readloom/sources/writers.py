"""Sinks: FASTQ by sample, BED, bedGraph, SAM text and lists of indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.operators.merge import place_of
from readloom.sources.fastq_sink import FastqFiles


def rendered(name: Column, seq: Column, qual: Column) -> Column:
    """The four lines of a FASTQ record."""
    return F.concat_ws("\n", name, seq, F.lit("+"), qual)


def mates(reads: DataFrame) -> DataFrame:
    """sample, replicate, mate, the read's place and value: assigned reads as FASTQ text, pairs as two rows and merged reads as one."""
    kept = reads.filter("outcome = 'assigned'").withColumn("replicate", F.coalesce("replicate", F.lit("none")))
    place = place_of(reads)
    if "seq" in reads.columns:
        return kept.select("sample", "replicate", F.lit("merged").alias("mate"), *place, rendered(F.col("name"), F.col("seq"), F.col("qual")).alias("value"))
    both = F.array(
        F.struct(F.lit("R1").alias("mate"), rendered(F.col("name_f"), F.col("seq_f"), F.col("qual_f")).alias("value")),
        F.struct(F.lit("R2").alias("mate"), rendered(F.col("name_r"), F.col("seq_r"), F.col("qual_r")).alias("value")),
    )
    return kept.select("sample", "replicate", *place, F.explode(both).alias("m")).select("sample", "replicate", "m.mate", *place, "m.value")


def file_name(gzip: bool) -> Column:
    """Fixed form of the names: replicate A or B in front, R1 or R2 of pairs behind."""
    front = F.when(F.col("replicate") == "none", "").otherwise(F.concat("replicate", F.lit("_")))
    back = F.when(F.col("mate") == "merged", "").otherwise(F.concat(F.lit("_"), "mate"))
    return F.concat(front, "sample", back, F.lit(".fastq.gz" if gzip else ".fastq"))


def write_fastq(reads: DataFrame, path: str, *, gzip: bool = True) -> None:
    """One file for each sample, replicate and mate, its reads in order of their place, so mates have the same line.

    Ranges of places are packed by a task each, in blocks if gzip, which read in
    ranges again; the commit joins them.
    """
    spark, place = reads.sparkSession, place_of(reads)
    spark.dataSource.register(FastqFiles)
    laid = mates(reads).withColumn("file_name", file_name(gzip)).repartitionByRange(*place).sortWithinPartitions("file_name", *place)
    laid.select("file_name", "value").write.format(FastqFiles.name()).option("path", path).option("gzip", str(gzip).lower()).mode("append").save()


def write_reads(reads: DataFrame, path: str, *, gzip: bool = False) -> None:
    """Reads (name, seq, qual) as FASTQ text, for what an aligner left or what deduplication kept."""
    reads.select(rendered(F.col("name"), F.col("seq"), F.col("qual")).alias("value")).write.mode("overwrite").option("compression", "gzip" if gzip else "none").text(path)


def write_bed(bed: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    columns = [*by, "chrom", "start_pos", "end_pos", "name", "mapq", "strand"]
    bed.select(*columns).sortWithinPartitions(*by, "chrom", "start_pos").write.mode("overwrite").partitionBy(*by).csv(path, sep="\t")


def write_bedgraph(runs: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Sorted runs in a folder for each group and strand."""
    keys = [*by, "strand"]
    laid = runs.repartition(*keys, "chrom").sortWithinPartitions(*keys, "chrom", "start_pos")
    laid.select(*keys, "chrom", "start_pos", "end_pos", "depth").write.mode("overwrite").partitionBy(*keys).csv(path, sep="\t")


def write_sam(header: DataFrame, sam: DataFrame, path: str, *, by_file: bool = False) -> None:
    """The header and the lines by chromosome, in the header's order, and position; parts follow each other in order.

    With ``by_file`` each file of ``sam`` and ``header`` gets a folder of its own.
    """
    keys = ["file"] if by_file else []
    order = header.filter(F.col("line").startswith("@SQ")).select(*keys, "line_no", F.regexp_extract("line", r"\tSN:([^\t]+)", 1).alias("rname"))
    placed = sam.join(order, [*keys, "rname"], "left").select(*keys, F.coalesce("line_no", F.lit(1 << 40)).alias("contig"), "pos", "line")
    top = header.select(*keys, F.lit(-1).cast("long").alias("contig"), F.col("line_no").alias("pos"), "line")
    laid = placed.unionByName(top).orderBy(*keys, "contig", "pos", "line").select(*keys, "line")
    (laid.write.partitionBy(*keys) if by_file else laid.write).mode("overwrite").text(path)


def write_bad_barcodes(counts: DataFrame, path: str) -> None:
    counts.orderBy("n_reads", "index_code").write.mode("overwrite").csv(path, sep="\t")
