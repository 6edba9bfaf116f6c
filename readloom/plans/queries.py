"""The registered queries of the sequencing operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions import sequence as S
from readloom.operators import coverage as C
from readloom.operators import dedup as D
from readloom.operators import demux as X
from readloom.operators import merge as M
from readloom.operators.adapters import trim_adapter
from readloom.operators.align import align_reads
from readloom.operators.overlap import merge_mates_by_score
from readloom.operators.zoom import pyramid
from readloom.plans.layout import parse_layout
from readloom.plans.views import view, with_views
from readloom.sources.bam import read_bam, write_bam
from readloom.sources.bigwig import read_bigwig, write_bigwig
from readloom.sources.readers import read_pairs
from readloom.sources.storage import shared_folder
from readloom.sources.writers import write_fastq

FLASH = parse_layout("flash")
UVCLAP = parse_layout("uvclap")
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, *views: str) -> Callable[[Query], Query]:
    """Registers a query under its function's name with the SQL over the views that checks it."""

    def add(made: Query) -> Query:
        QUERIES[made.__name__] = made
        ORACLES[made.__name__] = with_views(sql, *views) if views else sql
        return made

    return add


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.demux_pairs(view(spark, sf_dir, "v_pairs"), view(spark, sf_dir, "v_samples"), FLASH)


def merged(spark: SparkSession, sf_dir: str, *, strict: bool = True) -> DataFrame:
    return X.demux_merged(view(spark, sf_dir, "v_merged"), view(spark, sf_dir, "v_samples"), FLASH, strict=strict)


def bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_bed")


#: Nearest sample of every index, by comparing all of them.
NEAREST = """--more near as (select index_code, s.sample, hamming(index_code, s.barcode) as d from (select distinct index_code from probed) p cross join v_samples s),
    least as (select index_code, min(d) as d from near group by index_code),
    found as (select n.index_code, any_value(n.sample) as hit from near n join least l on n.index_code = l.index_code and n.d = l.d where n.d <= 1 group by n.index_code having count(*) = 1),
    told as (select p.*, hit, case when regexp_matches(code, '^[AG][AG]$') then 'A' when regexp_matches(code, '^[CT][CT]$') then 'B' end as replicate from probed p left join found f on p.index_code = f.index_code),
    demux as (select *, case when replicate is null then 'alien' when hit is null then 'bad_barcode' else 'assigned' end as outcome,
        case when replicate is not null then hit end as sample from told)
"""
PROBED_PAIRS = """probed as (select *, substr(seq_r, 6, 6) as index_code, substr(seq_r, 3, 2) as code,
    substr(seq_r, 1, 2) || substr(seq_r, 5, 1) || substr(seq_r, 12, 2) || substr(seq_r, 3, 2) as umi from v_pairs), """
REVERSED = "reverse(translate(seq, 'ACGT', 'TGCA'))"
PROBED_MERGED = f"""probed as (select *, substr({REVERSED}, 6, 6) as index_code, substr({REVERSED}, 3, 2) as code,
    substr({REVERSED}, 1, 2) || substr({REVERSED}, 5, 1) || substr({REVERSED}, 12, 2) || substr(seq, 3, 2) as umi from v_merged), """


def demux_sql(select: str, probed: str = PROBED_PAIRS) -> str:
    return NEAREST.replace("--more ", "--more " + probed) + select


NAME = "split_part({0}, ' ', 1) || ':' || umi || ' ' || split_part({0}, ' ', 2)"


@query(demux_sql("select s.sample, r.replicate, count(d.sample) as n_reads from v_samples s cross join (values ('A'), ('B')) r(replicate) left join demux d on d.outcome = 'assigned' and d.sample = s.sample and d.replicate = r.replicate group by 1, 2"), "v_samples", "v_pairs")
def demux_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads per sample and replicate."""
    return X.sample_counts(pairs(spark, sf_dir), view(spark, sf_dir, "v_samples"), FLASH)


@query(
    demux_sql(f"select rec_idx, sample, replicate, outcome, index_code, umi, {NAME.format('name_f')} as name_f, {NAME.format('name_r')} as name_r, substr(seq_f, 1, 51) as seq_f, substr(qual_f, 1, 51) as qual_f, substr(seq_r, 14) as seq_r, substr(qual_r, 14) as qual_r from demux"),
    "v_samples",
    "v_pairs",
)
def demux_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair with its outcome, trimmed and renamed."""
    return pairs(spark, sf_dir).select("rec_idx", "sample", "replicate", "outcome", "index_code", "umi", "name_f", "name_r", "seq_f", "qual_f", "seq_r", "qual_r")


@query(demux_sql(f"select rec_idx, sample, replicate, outcome, umi, {NAME.format('name')} as name, substr(seq, 1, 51) as seq, substr(qual, 1, 51) as qual from demux", PROBED_MERGED), "v_samples", "v_merged")
def demux_merged_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir).select("rec_idx", "sample", "replicate", "outcome", "umi", "name", "seq", "qual")


@query(demux_sql("select rec_idx, umi, outcome from demux", PROBED_MERGED.replace("substr(seq, 3, 2)", f"substr({REVERSED}, 3, 2)")), "v_samples", "v_merged")
def demux_merged_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged reads whose barcode ends with the code that told the replicate."""
    return merged(spark, sf_dir, strict=False).select("rec_idx", "umi", "outcome")


@query(demux_sql("select count(*) as n_total, count(*) filter (outcome = 'assigned') as n_assigned, count(*) filter (outcome = 'bad_barcode') as n_bad_barcode, count(*) filter (outcome = 'alien') as n_alien, cast(0 as bigint) as n_too_short from demux"), "v_samples", "v_pairs")
def demux_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.outcome_counts(pairs(spark, sf_dir))


@query(demux_sql("select index_code, count(*) as n_reads from demux where outcome = 'bad_barcode' group by 1"), "v_samples", "v_pairs")
def bad_barcode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.bad_barcodes(pairs(spark, sf_dir)).orderBy("n_reads", "index_code")


@query("select outcome, coalesce(read_class, 'both') as read_class, count(*) as n_reads from (select 'pair' as read_class, outcome from (" + with_views(demux_sql("select outcome from demux"), "v_samples", "v_pairs") + ") union all select 'merged', outcome from (" + with_views(demux_sql("select outcome from demux", PROBED_MERGED), "v_samples", "v_merged") + ")) group by grouping sets ((outcome, read_class), (outcome))")
def demux_class_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of merged reads, of pairs and of both."""
    return X.class_totals(merged(spark, sf_dir), pairs(spark, sf_dir))


@query("select rec_idx, substr(seq_f, 1, 3) || substr(seq_f, 9, 2) || substr(seq_r, 5, 1) || substr(seq_r, 1, 4) as umi, substr(seq_f, 4, 5) as index_code from v_pairs", "v_pairs")
def umi_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random barcode and index of the two-ended layout."""
    f, r = F.col("seq_f"), F.col("seq_r")
    umi = S.joined([*S.random_bases(f, UVCLAP.left), *S.random_bases(r, UVCLAP.right), S.part(r, UVCLAP.right.code)])
    return view(spark, sf_dir, "v_pairs").select("rec_idx", umi.alias("umi"), S.part(f, UVCLAP.left.index).alias("index_code"))


@query("select rec_idx, substr(seq_f, 11, 64 - 15) as seq_f, substr(seq_r, 6, 64 - 15) as seq_r from v_pairs", "v_pairs")
def trim_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, r = UVCLAP.left.trimmed, UVCLAP.right.trimmed  # noqa: E741
    return view(spark, sf_dir, "v_pairs").select("rec_idx", S.trim(F.col("seq_f"), l, r).alias("seq_f"), S.trim(F.col("seq_r"), r, l).alias("seq_r"))


@query("select rec_idx, reverse(translate(seq_f, 'ACGT', 'TGCA')) as seq from v_pairs", "v_pairs")
def revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_pairs").select("rec_idx", S.revcomp(F.col("seq_f")).alias("seq"))


@query("select a.sample as sample_a, b.sample as sample_b, hamming(a.barcode, b.barcode) as distance from v_samples a join v_samples b on a.ord < b.ord", "v_samples")
def hamming_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between all samples' barcodes."""
    s = view(spark, sf_dir, "v_samples")
    a, b = (s.select(F.col("ord").alias(f"ord_{k}"), F.col("sample").alias(f"sample_{k}"), F.col("barcode").alias(f"barcode_{k}")) for k in "ab")
    return a.join(b, F.col("ord_a") < F.col("ord_b")).select("sample_a", "sample_b", S.hamming(F.col("barcode_a"), F.col("barcode_b"), 6).cast("long").alias("distance"))


@query("select rec_idx, cast(list_sum(list_transform(string_split(qual_f, ''), lambda c: ascii(c) - 33)) as bigint) as phred from v_pairs", "v_pairs")
def phred_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_pairs").select("rec_idx", S.phred_sum(F.col("qual_f")).cast("long").alias("phred"))


BEST = """--more scored as (select *, split_part(split_part(name, ' ', 1), ':', 8) as umi, cast(list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) as bigint) as phred from v_fq),
    ranked as (select *, row_number() over (partition by seq, {by} order by phred desc, rec_idx) as place from scored)
"""


@query(BEST.format(by="umi") + "select rec_idx, name, seq, qual, umi, phred from ranked where place = 1", "v_fq")
def fastq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.best_reads(view(spark, sf_dir, "v_fq")).withColumn("phred", F.col("phred").cast("long"))


@query(BEST.format(by="''") + "select rec_idx, name, seq, qual, phred from ranked where place = 1", "v_fq")
def fastq_dedup_noumi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.best_reads(view(spark, sf_dir, "v_fq"), with_umi=False).withColumn("phred", F.col("phred").cast("long")).drop("umi")


@query(BEST.format(by="umi") + "select count(*) as n_total, count(*) filter (place = 1) as n_kept, count(*) filter (place > 1) as n_removed, cast(round(100.0 * count(*) filter (place > 1) / count(*)) as double) as percent_removed from ranked", "v_fq")
def fastq_dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = view(spark, sf_dir, "v_fq")
    return D.read_stats(reads, D.best_reads(reads))


@query("select sha1(text) as digest, arg_max(doc_id, (n_chars, -doc_id)) as doc_id, max(n_chars) as n_chars, count(*) as n_copies from documents group by 1")
def doc_dedup_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return D.best_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


FLAGGED = """--more keyed as (select *, split_part(name, ':', 8) as umi, translate(name, ':', ' ') as line_key from v_bed),
    led as (select *, lead(umi) over w as u2, lead(strand) over w as s2, lead(start_pos) over w as p2, lead(end_pos) over w as e2, lead(chrom) over w as c2,
        row_number() over w as place, count(*) over () as n from keyed window w as (order by chrom, start_pos, end_pos, umi, mapq, strand, line_key)),
    flagged as (select *, coalesce(c2 = chrom and s2 = strand and case when strand = '+' then start_pos = p2 else end_pos = e2 end and hamming(umi, u2) <= 1, false) as is_duplicate from led),
    kept as (select * from flagged where not is_duplicate and mapq >= 10 and place < n)
"""
BED = "chrom, start_pos, end_pos, name, mapq, strand"


@query(FLAGGED + f"select {BED} from kept", "v_bed")
def bam_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dedup_alignments(bed(spark, sf_dir)).select(*BED.split(", "))


@query(FLAGGED + f"select {BED} from flagged where not is_duplicate and mapq >= 10", "v_bed")
def bam_dedup_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the last alignment of the file."""
    return D.dedup_alignments(bed(spark, sf_dir), strict=False).select(*BED.split(", "))


@query(FLAGGED.replace("over w", "over (partition by sample order by chrom, start_pos, end_pos, umi, mapq, strand, line_key)").replace("count(*) over ()", "count(*) over (partition by sample)").replace(" from keyed window w as (order by chrom, start_pos, end_pos, umi, mapq, strand, line_key)", " from keyed") + f"select sample, {BED} from kept", "v_bed")
def bam_dedup_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of a run in one job."""
    return D.dedup_alignments(bed(spark, sf_dir), by=("sample",)).select("sample", *BED.split(", "))


@query(
    FLAGGED + "select count(*) as n_total, (select count(*) from kept) as n_kept, count(*) filter (is_duplicate) as n_duplicates, count(*) filter (not is_duplicate and mapq < 10) as n_low_quality, cast(round(100.0 * (select count(*) from kept) / count(*)) as double) as percent_kept, cast(round(100.0 * (count(*) - (select count(*) from kept)) / count(*)) as double) as percent_removed from flagged",
    "v_bed",
)
def bam_dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.alignment_stats(bed(spark, sf_dir))


@query(FLAGGED + "select distinct name as qname, mapq, case when strand = '-' then 16 else 0 end as flag from v_bed where name in (select name from kept)", "v_bed")
def bam_dedup_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment lines of the kept names."""
    b = bed(spark, sf_dir)
    sam = b.select(F.col("name").alias("qname"), "mapq", F.when(F.col("strand") == "-", 16).otherwise(0).alias("flag"))
    return D.keep_by_name(sam, D.dedup_alignments(b))


@query(f"select {BED} from v_bed where mapq >= 10", "v_bed")
def mapq_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bed(spark, sf_dir).filter("mapq >= 10").select(*BED.split(", "))


@query(FLAGGED + f"select {BED} from flagged where place <= 10", "v_bed")
def bed_sort_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten alignments in order, a report."""
    return D.keyed(bed(spark, sf_dir)).orderBy("chrom", *D.ORDER).limit(10).select(*BED.split(", "))


SITES = "select sample, replicate, chrom, case when strand = '+' then start_pos - 1 else end_pos end as start_pos, case when strand = '+' then start_pos else end_pos + 1 end as end_pos, name, mapq, strand from v_bed"


@query(f"--more sites as ({SITES}) select {BED} from sites where start_pos > 0", "v_bed")
def xlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.crosslinks(bed(spark, sf_dir)).select(*BED.split(", "))


def coverage_sql(by: str, source: str = "v_bed") -> str:
    return f"""steps as (select {by}chrom, strand, pos, sum(d) as d from (select {by}chrom, strand, start_pos as pos, 1 as d from {source} union all select {by}chrom, strand, end_pos, -1 from {source}) group by all having sum(d) <> 0),
    swept as (select {by}chrom, strand, pos as start_pos, lead(pos) over w as end_pos, cast(sum(d) over w as bigint) as depth from steps window w as (partition by {by}chrom, strand order by pos))
    select {by}chrom, strand, start_pos, end_pos, depth from swept where depth > 0"""


@query("--more " + coverage_sql("sample, replicate, "), "v_bed")
def coverage_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.coverage(bed(spark, sf_dir), ("sample", "replicate"))


@query(f"--more sites as (select * from ({SITES}) where start_pos > 0), " + coverage_sql("sample, replicate, ", "sites"), "v_bed")
def coverage_xlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.coverage(C.crosslinks(bed(spark, sf_dir)), ("sample", "replicate"))


@query("--more " + coverage_sql("sample, "), "v_bed")
def coverage_replicates_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.merged_coverage(bed(spark, sf_dir), ("sample",), "replicate")[1]


@query(f"select {BED}, 'first' as aligner from v_bed where mapq >= 10 union all select {BED}, 'second' from v_bed where mapq < 10 or mapq > 30", "v_bed")
def merge_aligners(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bed(spark, sf_dir).select(*BED.split(", "))
    return M.merge_aligners(b.filter("mapq >= 10").withColumn("aligner", F.lit("first")), b.filter("mapq < 10 or mapq > 30").withColumn("aligner", F.lit("second")))


@query("select rec_idx, name from v_fq where name not in (select name from v_fq where rec_idx % 3 = 0)", "v_fq")
def fallback_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that a first aligner left."""
    reads = view(spark, sf_dir, "v_fq")
    return M.unmapped(reads, reads.filter("rec_idx % 3 = 0")).select("rec_idx", "name")


@query("select a.rec_idx, a.name as name_f, b.name as name_r from v_fq a join v_fq b on a.rec_idx = b.rec_idx where b.rec_idx % 2 = 0", "v_fq")
def mate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mates by their place in two files."""
    reads = view(spark, sf_dir, "v_fq")
    return M.pair_up(reads, reads.filter("rec_idx % 2 = 0")).select("rec_idx", "name_f", "name_r")


@query("select cast(a.rec_idx % 3 as int) as file_no, cast((a.rec_idx - a.rec_idx % 3) / 3 as bigint) as rec_idx, a.name as name_f, b.name as name_r from v_fq a join v_fq b on a.rec_idx = b.rec_idx where b.rec_idx % 2 = 0", "v_fq")
def mate_pairs_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mates by their place in two lists of three files."""
    reads = view(spark, sf_dir, "v_fq").withColumns({"file_no": (F.col("rec_idx") % 3).cast("int"), "rec_idx": F.floor(F.col("rec_idx") / 3)})
    return M.pair_up(reads, reads.filter("(rec_idx * 3 + file_no) % 2 = 0")).select("file_no", "rec_idx", "name_f", "name_r")


COVERED = "covered as (select rname as chrom, '+' as strand, pos - 1 as start_pos, pos - 1 + covered as end_pos from v_sam where flag = 0), "


def coverage_of_sam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of the forward strand."""
    forward = view(spark, sf_dir, "v_sam").filter("flag = 0")
    return C.coverage(forward.select(F.col("rname").alias("chrom"), F.lit("+").alias("strand"), (F.col("pos") - 1).alias("start_pos"), (F.col("pos") - 1 + F.col("covered")).alias("end_pos")))


def zoom_sql(level: int, size: int) -> str:
    return f"""select {level} as level, chrom, bin * {size} as start_pos, (bin + 1) * {size} as end_pos, sum(b) :: bigint as valid, min(depth) as least, max(depth) as most, sum(b * depth) :: bigint as total, sum(b * depth * depth) :: bigint as squares
        from (select chrom, depth, bin, least(end_pos, (bin + 1) * {size}) - greatest(start_pos, bin * {size}) as b from (select *, unnest(range(start_pos // {size}, (end_pos - 1) // {size} + 1)) as bin from runs)) group by chrom, bin"""


@query("--more " + COVERED + coverage_sql("", "covered").replace("select chrom, strand, start_pos, end_pos, depth from swept where depth > 0", ", runs as (select * from swept where depth > 0) ") + " union all ".join(zoom_sql(i + 1, 700 * 4**i) for i in range(4)), "v_sam")
def coverage_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of coverage in bins of four sizes."""
    return pyramid(coverage_of_sam(spark, sf_dir), size=700, levels=4)


@query("--more " + COVERED + coverage_sql("", "covered").replace("select chrom, strand, start_pos, end_pos, depth from", "select chrom, start_pos, end_pos, depth :: double as value from"), "v_sam")
def bigwig_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage written as a bigWig file and read again by its index."""
    path = f"{shared_folder(spark)}/plus.bw"
    sizes = spark.createDataFrame([(f"chr{i}", 1_000_000) for i in range(3)], "chrom string, size long")
    write_bigwig(coverage_of_sam(spark, sf_dir), sizes, path)
    return read_bigwig(spark, path)


@query(
    demux_sql(f"""select dense_rank() over (order by replicate || '_' || sample || '_R1.fastq.gz') :: int as file_no, row_number() over (partition by sample, replicate order by rec_idx) - 1 as rec_idx,
        {NAME.format('name_f')} as name_f, substr(seq_f, 1, 51) as seq_f, substr(qual_f, 1, 51) as qual_f, {NAME.format('name_r')} as name_r, substr(seq_r, 14) as seq_r, substr(qual_r, 14) as qual_r from demux where outcome = 'assigned'"""),
    "v_samples",
    "v_pairs",
)
def fastq_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs written to a file for each sample, replicate and mate, and read again mate by mate."""
    folder = shared_folder(spark)
    write_fastq(pairs(spark, sf_dir), folder)
    return read_pairs(spark, f"{folder}/*_R1.fastq.gz", f"{folder}/*_R2.fastq.gz")


@query("select rec_idx, cast(covered as bigint) as span from v_sam", "v_sam")
def cigar_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference bases of alignments."""
    return view(spark, sf_dir, "v_sam").select("rec_idx", F.coalesce(S.reference_span(F.col("cigar")), F.lit(0)).cast("long").alias("span"))


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_sam").withColumn("tags", F.array("tag"))


def written_bam(spark: SparkSession, sf_dir: str) -> str:
    """The alignments as a sorted, indexed BAM file in the shared folder."""
    path = f"{shared_folder(spark)}/sorted.bam"
    header = spark.createDataFrame([(0, "@HD\tVN:1.6\tSO:coordinate"), *((i + 1, f"@SQ\tSN:chr{i}\tLN:1000000") for i in (0, 1, 2))], "line_no long, line string")
    write_bam(header, alignments(spark, sf_dir), path)
    return path


SAM = "qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, tag"


@query(f"select {SAM} from v_sam", "v_sam")
def bam_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments written as BAM and read again in ranges."""
    return read_bam(spark, written_bam(spark, sf_dir), range_bytes=1 << 20).withColumn("tag", F.col("tags")[0]).select(*SAM.split(", "))


@query(f"select {SAM} from v_sam where rname = 'chr1' and pos <= 350000 and pos - 1 + covered > 299999", "v_sam")
def bam_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments over a region, by the index."""
    return read_bam(spark, written_bam(spark, sf_dir), region="chr1:300,000-350,000").withColumn("tag", F.col("tags")[0]).select(*SAM.split(", "))


@query("select rec_idx, split_part(split_part(name, ' ', 1), ':', 8) as header_umi, split_part(name, ' ', 1) || ':ACG ' || split_part(name, ' ', 2) as tagged from v_fq", "v_fq")
def header_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = view(spark, sf_dir, "v_fq")
    return reads.select("rec_idx", S.umi_of_header(F.col("name")).alias("header_umi"), S.tagged_name(F.col("name"), F.lit("ACG")).alias("tagged"))


@query(demux_sql("select sample, replicate, read_class, count(*) as n_reads from (select sample, replicate, 'pair' as read_class from demux where outcome = 'assigned' union all select sample, replicate, 'merged' from (" + with_views(demux_sql("select * from demux", PROBED_MERGED), "v_samples", "v_merged") + ") where outcome = 'assigned') group by all"), "v_samples", "v_pairs")
def mapping_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is mapped, by sample, replicate and read class."""
    reads = M.mapping_input(merged(spark, sf_dir), pairs(spark, sf_dir))
    return reads.groupBy("sample", "replicate", "read_class").agg(F.count("*").alias("n_reads"))


@query(
    """--more cut as (select rec_idx, name_f, substr(seq_f, 1, 40) as seq_f, substr(qual_f, 1, 40) as qual_f, substr(seq_f, 17 + rec_idx % 20) as other, substr(qual_f, 17 + rec_idx % 20) as other_qual from v_pairs),
    sizes as (select unnest(range(12, 41)) as n),
    fits as (select rec_idx, max(n) as overlap from cut join sizes on n <= least(length(seq_f), length(other)) and right(seq_f, n::int) = left(other, n::int) group by rec_idx)
    select c.rec_idx, name_f as name, seq_f || substr(other, overlap + 1) as seq, qual_f || substr(other_qual, overlap + 1) as qual from cut c join fits f on c.rec_idx = f.rec_idx where length(seq_f) + length(other) - overlap >= 30""",
    "v_pairs",
)
def mate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mates that overlap, merged."""
    p = view(spark, sf_dir, "v_pairs")
    other = F.expr("substring(seq_f, int(17 + rec_idx % 20))")
    qual = F.expr("substring(qual_f, int(17 + rec_idx % 20))")
    cut = p.select("rec_idx", "name_f", F.substring("seq_f", 1, 40).alias("seq_f"), F.substring("qual_f", 1, 40).alias("qual_f"), S.revcomp(other).alias("seq_r"), F.reverse(qual).alias("qual_r"))
    return M.merge_mates(cut)[0]


OVERLAPS = """--more cut as (select rec_idx, name_f, substr(seq_f, 1, 40) as a, substr(qual_f, 1, 40) as qa,
        substr(substr(seq_f, 17 + rec_idx % 20), 1, rec_idx % 11) || 'A' || substr(substr(seq_f, 17 + rec_idx % 20), rec_idx % 11 + 2) as b, substr(qual_r, 17 + rec_idx % 20) as qb from v_pairs),
    sizes as (select unnest(range(12, 41)) as n),
    sites as (select c.*, n, i, a[length(a) - n + i] as x, b[i] as y, ascii(qa[length(a) - n + i]) - 33 as p, ascii(qb[i]) - 33 as q
        from cut c join sizes on n <= least(length(a), length(b)) cross join unnest(range(1, n + 1)) u(i)),
    scored as (select rec_idx, n, sum(case when 'N' in (x, y) then 0 when x = y then least(p, q) else -least(p, q) end) as score, count(*) filter (x <> y and 'N' not in (x, y)) as wrong from sites group by rec_idx, n),
    best as (select rec_idx, arg_max(n, (score, n)) as n, arg_max(wrong, (score, n)) as wrong from scored where score > 0 and wrong <= 0.1 * n group by rec_idx),
    said as (select s.rec_idx, string_agg(case when x = 'N' then y when y = 'N' then x when p >= q then x else y end, '' order by i) as seq,
            string_agg(chr(33 + (case when x = y then least(p + q, 41) when x = 'N' then q when y = 'N' then p else greatest(abs(p - q), 2) end) :: int), '' order by i) as qual
        from sites s join best b on s.rec_idx = b.rec_idx and s.n = b.n group by s.rec_idx),
    merged as (select c.rec_idx, name_f as name, substr(a, 1, length(a) - n) || s.seq || substr(b, n + 1) as seq, substr(qa, 1, length(a) - n) || s.qual || substr(qb, n + 1) as qual, n :: int as overlap, wrong :: int as mismatches
        from cut c join best on best.rec_idx = c.rec_idx join said s on s.rec_idx = c.rec_idx)
"""


@query(OVERLAPS + "select * from merged where length(seq) >= 30", "v_pairs")
def mate_merge_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mates merged at their best overlap, mismatches included."""
    p = view(spark, sf_dir, "v_pairs")
    other = F.expr("substring(seq_f, int(17 + rec_idx % 20))")
    at = (F.col("rec_idx") % 11).cast("int")
    changed = F.concat(F.substring(other, F.lit(1), at), F.lit("A"), F.substring(other, at + 2, F.lit(64)))
    qual = F.expr("substring(qual_r, int(17 + rec_idx % 20))")
    cut = p.select("rec_idx", "name_f", F.substring("seq_f", 1, 40).alias("seq_f"), F.substring("qual_f", 1, 40).alias("qual_f"), S.revcomp(changed).alias("seq_r"), F.reverse(qual).alias("qual_r"))
    return merge_mates_by_score(cut)[0]


@query(
    """--more wide as (select rec_idx, substr(seq_f, 1, 13) as index_code from v_pairs),
    sheet as (select sample, substr(translate(md5(sample), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 13) as barcode from v_samples),
    near as (select index_code, sample, hamming(index_code, barcode) as d from (select distinct index_code from wide) cross join sheet),
    least as (select index_code, min(d) as d from near where d <= 5 group by index_code),
    found as (select n.index_code, any_value(n.sample) as sample from near n join least l on n.index_code = l.index_code and n.d = l.d group by n.index_code having count(*) = 1)
    select rec_idx, w.index_code, sample from wide w left join found f on f.index_code = w.index_code""",
    "v_samples",
    "v_pairs",
)
def demux_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest samples within five mismatches of thirteen bases."""
    sheet = view(spark, sf_dir, "v_samples").select("sample", F.translate(F.md5("sample"), "0123456789abcdef", "ACGTACGTACGTACGT").substr(1, 13).alias("barcode"))
    reads = view(spark, sf_dir, "v_pairs").select("rec_idx", F.substring("seq_f", 1, 13).alias("index_code"))
    return X.with_sample(reads, sheet, 5)


ADAPTER = "AGATCGGAAGAGC"


@query(
    f"""--more made as (select rec_idx, substr(substr(seq_f, 1, 20 + rec_idx % 30) || substr('{ADAPTER}', 1, rec_idx % 13) || substr('ACGTN', 1 + rec_idx % 5, 1) || substr('{ADAPTER}', rec_idx % 13 + 2) || seq_r, 1, 50) as seq, substr(qual_f, 1, 50) as qual from v_pairs),
    sites as (select rec_idx, place, seq, least(13, 50 - place) as n from made cross join unnest(range(0, 50)) t(place)),
    compared as (select rec_idx, place, n, len(list_filter(range(1, n + 1), lambda i: seq[place + i] <> '{ADAPTER}'[i])) as wrong from sites),
    best as (select rec_idx, arg_max(place, (n - 2 * wrong, -place)) as place, arg_max(wrong, (n - 2 * wrong, -place)) as wrong from compared where n >= 3 and wrong <= 0.1 * n and n - 2 * wrong > -1 group by rec_idx)
    select m.rec_idx, substr(seq, 1, coalesce(place, 50) :: int) as seq, substr(qual, 1, coalesce(place, 50) :: int) as qual, coalesce(wrong, -1) :: int as adapter_mismatches from made m left join best b on b.rec_idx = m.rec_idx""",
    "v_pairs",
)
def adapter_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that run into an adapter with a changed base, and reads that don't."""
    n = F.col("rec_idx")
    part = lambda text, start, size: F.substring(text, start.cast("int"), size.cast("int"))
    ran = F.concat(part(F.col("seq_f"), F.lit(1), 20 + n % 30), part(F.lit(ADAPTER), F.lit(1), n % 13), part(F.lit("ACGTN"), 1 + n % 5, F.lit(1)), part(F.lit(ADAPTER), n % 13 + 2, F.lit(13)), F.col("seq_r"))
    made = view(spark, sf_dir, "v_pairs").select("rec_idx", F.substring(ran, 1, 50).alias("seq"), F.substring("qual_f", 1, 50).alias("qual"))
    return trim_adapter(made, ADAPTER).withColumn("adapter_mismatches", F.coalesce("adapter_mismatches", F.lit(-1)))


PLANTED = """select p_partkey as rec_idx, chrom, 1 + (p_partkey * 7) % 196 as pos, cast((p_partkey % 2) * 16 as int) as flag,
        substr(seq, cast(1 + (p_partkey * 7) % 196 as int), cast(p_partkey % 60 as int)) || 'A' || substr(seq, cast(2 + (p_partkey * 7) % 196 + p_partkey % 60 as int), cast(59 - p_partkey % 60 as int)) as there,
        case when substr(seq, cast(1 + (p_partkey * 7) % 196 + p_partkey % 60 as int), 1) = 'A' then 0 else 1 end as wrong
        from part join v_contigs on number = 1 + p_partkey % 10"""


@query(f"--more planted as ({PLANTED}) select 'r' || rec_idx as qname, flag, chrom as rname, pos, '60M' as cigar, there as seq, 'NM:i:' || wrong as tag from planted", "v_contigs")
def align_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of known places, half of them turned, with a changed base."""
    contigs = view(spark, sf_dir, "v_contigs")
    planted = spark.sql(PLANTED.replace("from part join v_contigs", "from {part} join {contigs}"), part=spark.read.parquet(f"{sf_dir}/part.parquet"), contigs=contigs)
    reads = planted.select(F.concat(F.lit("@r"), "rec_idx").alias("name"), F.when(F.col("flag") == 0, F.col("there")).otherwise(S.revcomp(F.col("there"))).alias("seq"), F.repeat(F.lit("I"), F.lit(60)).alias("qual"))
    return align_reads(reads, contigs).withColumn("tag", F.col("tags")[0]).select("qname", "flag", "rname", "pos", "cigar", "seq", "tag")
