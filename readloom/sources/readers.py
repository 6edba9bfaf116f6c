"""Sources: FASTQ, sample sheets, SAM, BED, bedGraph and chromosome sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.functions.sequence import first_word, reference_span
from readloom.operators.merge import pair_up
from readloom.sources.fastq import split_pairs, split_reads
from readloom.sources.storage import can_open
from readloom.sources.text_records import framed, numbered_lines

FASTQ_NAMES = (".fastq", ".fastq.gz", ".fq", ".fq.gz")
BED_SCHEMA = "chrom string, start_pos long, end_pos long, name string, mapq int, strand string"
BEDGRAPH_SCHEMA = "chrom string, start_pos long, end_pos long, depth long"
#: The columns of a SAM line.
SAM_COLUMNS = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
SAM_NUMBERS = {"flag": "int", "pos": "bigint", "mapq": "int", "pnext": "bigint", "tlen": "bigint"}


def check_fastq_name(path: str) -> None:
    if not (path.lower().endswith(FASTQ_NAMES) or "*" in path or "." not in path.rsplit("/", 1)[-1]):
        raise ValueError(f"not a FASTQ file name: {path}")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """file, file_no (in order of names, from 1), rec_idx, name (with its @), seq, qual; gzip by the file's content.

    Files are read in ranges of whole records without a shuffle. Where only Spark
    can open a path, its text reader takes over, whose lines meet by a shuffle.
    """
    check_fastq_name(path)
    if can_open(path):
        return split_reads(spark, path)
    records = framed(numbered_lines(spark, path), 4, {0: "name", 1: "seq", 3: "qual"})
    return records.select("file", "file_no", "rec_idx", *(F.trim(c).alias(c) for c in ("name", "seq", "qual")))


def read_pairs(spark: SparkSession, forward: str, reverse: str) -> DataFrame:
    """Mates by their place in two files, or in two lists of files: file_no, rec_idx and the name, seq and qual of both."""
    for path in (forward, reverse):
        check_fastq_name(path)
    if can_open(forward) and can_open(reverse):
        return split_pairs(spark, forward, reverse)
    return pair_up(read_fastq(spark, forward), read_fastq(spark, reverse))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """ord, sample, barcode of a FASTA sheet with two lines for each sample."""
    records = framed(numbered_lines(spark, path), 2, {0: "sample", 1: "barcode"})
    return records.select(F.col("rec_idx").cast("int").alias("ord"), F.trim(F.regexp_replace("sample", "^>", "")).alias("sample"), F.upper(F.trim("barcode")).alias("barcode"))


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """chrom (the name's first word), seq of FASTA files with lines of any length.

    Lines get their contig by the last name in front of them; the names' places, one for
    each contig, are the driver's. A contig's lines meet in one row, since a row is what pieces are cut from.
    """
    lines = numbered_lines(spark, path)
    names = lines.filter(F.col("value").startswith(">")).select("file_no", F.col("line_no").alias("name_line"), first_word(F.substring("value", F.lit(2), F.length("value"))).alias("chrom"))
    after = F.coalesce(F.lead("name_line").over(Window.partitionBy("file_no").orderBy("name_line")), F.lit(1 << 62))
    spans = names.withColumn("next_line", after)
    inside = (lines["file_no"] == spans["file_no"]) & (F.col("line_no") > F.col("name_line")) & (F.col("line_no") < F.col("next_line"))
    met = lines.join(spans, inside).groupBy("chrom").agg(F.sort_array(F.collect_list(F.struct("line_no", F.trim("value").alias("value")))).alias("all"))
    return met.select("chrom", F.array_join(F.col("all")["value"], "").alias("seq"))


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The columns of alignment lines, tags as an array, the line itself and its file's name."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file")).filter(~F.col("value").startswith("@") & (F.col("value") != ""))
    fields = F.split("value", "\t")
    columns = [F.get(fields, F.lit(i)).cast(SAM_NUMBERS.get(c, "string")).alias(c) for i, c in enumerate(SAM_COLUMNS)]
    return lines.select(*columns, F.slice(fields, F.lit(12), F.greatest(F.size(fields) - 11, F.lit(0))).alias("tags"), F.col("value").alias("line"), "file")


def read_sam_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """line_no, line, file of the headers; only their lines, which no alignment looks like, are put in order."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    place = F.row_number().over(Window.partitionBy("file").orderBy("block", "at"))
    return lines.filter(F.col("value").startswith("@")).select((place - 1).cast("long").alias("line_no"), F.col("value").alias("line"), "file")


def sam_to_bed(sam: DataFrame) -> DataFrame:
    """Mapped alignments as BED, with their file if ``sam`` tells it; names and chromosomes are cut at their first space."""
    start = F.col("pos") - 1
    return sam.filter(F.col("flag").bitwiseAND(4) == 0).select(
        first_word(F.col("rname")).alias("chrom"),
        start.alias("start_pos"),
        (start + reference_span(F.col("cigar"))).alias("end_pos"),
        first_word(F.col("qname")).alias("name"),
        "mapq",
        F.when(F.col("flag").bitwiseAND(16) == 0, "+").otherwise("-").alias("strand"),
        *(["file"] if "file" in sam.columns else []),
    )


def tab_separated(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schema)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return tab_separated(spark, path, BED_SCHEMA)


def read_bedgraph(spark: SparkSession, path: str) -> DataFrame:
    return tab_separated(spark, path, BEDGRAPH_SCHEMA)


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return tab_separated(spark, path, "chrom string, size long")
