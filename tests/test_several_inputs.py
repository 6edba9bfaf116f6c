"""Several files, inputs that change in place, pile-ups at one locus, and what one file's size must not slow down."""

import gzip
import io
import struct
import time

from pyspark.sql import functions as F

from readloom.operators import dedup
from readloom.operators.merge import pair_up
from readloom.plans.run import DemuxRun, main, run_demux
from readloom.sources.bigwig import read_bigwig
from readloom.sources.inflated import Inflated
from readloom.sources.readers import read_fastq


def fastq(path, names, seq="ACGTACGTACGTACGTACGTACGT"):
    path.write_text("".join(f"@{n}\n{seq}\n+\n{'I' * len(seq)}\n" for n in names))


def test_mates_of_two_files(spark, tmp_path):
    for lane in (1, 2):
        for mate in ("R1", "R2"):
            fastq(tmp_path / f"lane{lane}_{mate}.fastq", [f"{lane}:{i}" for i in range(3)])
    pairs = pair_up(*(read_fastq(spark, str(tmp_path / f"*_{mate}.fastq")) for mate in ("R1", "R2")))
    rows = pairs.collect()
    assert len(rows) == 6 and all(r.name_f == r.name_r for r in rows)
    best = dedup.best_reads(read_fastq(spark, str(tmp_path / "*_R1.fastq")), with_umi=False).collect()
    assert [(r.file_no, r.rec_idx, r.name) for r in best] == [(1, 0, "@1:0")]


def test_changed_sheet_is_a_new_input(spark, tmp_path):
    for mate in ("f", "r"):
        fastq(tmp_path / f"{mate}.fastq", ["a", "b"])
    sheet = tmp_path / "samples.fa"
    run = DemuxRun(str(tmp_path / "f.fastq"), str(tmp_path / "r.fastq"), str(sheet), str(tmp_path / "out"))
    for names in (("one", "two"), ("uno", "dos")):
        sheet.write_text(f">{names[0]}\nCGTACG\n>{names[1]}\nTTTTTT\n")
        assert {r["sample"] for r in run_demux(spark, run)["pairs_counts"].collect()} == set(names)
        written = spark.read.parquet(str(tmp_path / "out" / "pairs"))
        assert {r[0] for r in written.filter("sample is not null").select("sample").distinct().collect()} <= set(names)


def alignments(spark, n, umis):
    letters = F.translate(F.lpad(F.conv((F.col("id") % umis).cast("string"), 10, 4), 6, "0"), "0123", "ACGT")
    return spark.range(n).select(F.lit("c").alias("chrom"), F.lit(5).cast("long").alias("start_pos"), F.lit(30).cast("long").alias("end_pos"), F.concat(F.lit("r:"), F.col("id").cast("string"), F.lit(":"), letters).alias("name"), F.lit(20).alias("mapq"), F.lit("+").alias("strand"))


def test_pile_up_uses_several_tasks(spark, monkeypatch):
    bed = alignments(spark, 100_000, 4096)
    whole = sorted(r.name for r in dedup.dedup_alignments(bed).collect())
    monkeypatch.setattr(dedup, "HOT", 1000)
    assert sorted(r.name for r in dedup.dedup_alignments(bed).collect()) == whole
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        used = dedup.flagged(bed).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert used > 1
    stats = dedup.alignment_stats(bed).first()
    assert stats.n_total == 100_000 and stats.n_kept == len(whole) and stats.n_total - stats.n_duplicates == len(whole) + 1


def test_borders_of_hot_bins_are_scanned_by_levels(spark, monkeypatch):
    letters = F.translate(F.lpad(F.conv((F.col("id") % 199).cast("string"), 10, 4), 4, "0"), "0123", "ACGT")
    start = (F.col("id") * 7919 % 30_000).cast("long")
    bed = spark.range(6000).select(
        F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("chrom"),
        F.when(F.col("id") % 3 == 0, start % 12).otherwise(start).alias("start_pos"),
        (F.when(F.col("id") % 3 == 0, start % 12).otherwise(start) + 20 + F.col("id") % 4).alias("end_pos"),
        F.concat(F.lit("r:"), F.col("id").cast("string"), F.lit(":"), letters).alias("name"),
        (F.col("id") % 40).cast("int").alias("mapq"),
        F.when(F.col("id") % 5 < 3, "+").otherwise("-").alias("strand"),
        (F.col("id") % 2).alias("lane"),
    )
    told = lambda by: sorted(map(tuple, dedup.dedup_alignments(bed, by=by).select("chrom", "start_pos", "name").collect()))
    whole = [told(()), told(("lane",))]
    monkeypatch.setattr(dedup, "HOT", 100)
    assert [told(()), told(("lane",))] == whole
    plan = dedup.flagged(bed)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and not [w for w in windows if "], [], [" in w or "windowspecdefinition(bin" in w]


def test_inflating_takes_time_in_proportion():
    member = gzip.compress(struct.pack("<i", 7) * 5000)
    took = []
    for times in (2000, 8000):
        began = time.perf_counter()
        source, n = Inflated(io.BytesIO(member * times)), 0
        while len(source.read(20_000)) == 20_000:
            n += 1
        took.append(time.perf_counter() - began)
        assert n == times
    assert took[1] < 12 * took[0]


SAM = "@HD\tVN:1.6\n@SQ\tSN:c2\tLN:900\n@SQ\tSN:c1\tLN:900\n"


def sam_line(name, pos, flag=0, chrom="c1"):
    return f"{name}\t{flag}\t{chrom}\t{pos}\t30\t20M\t*\t0\t0\t{'A' * 20}\t{'I' * 20}\n"


def test_commands(spark, tmp_path):
    for n in (1, 2):
        lines = [sam_line(f"x:{n}{i}:ACGT", 10 + 40 * (i // 2)) for i in range(6)] + [sam_line("u:1:AAAA", 0, 4, "*")]
        (tmp_path / f"{n}.sam").write_text(SAM + "".join(lines))
    paths = [str(tmp_path / f"{n}.sam") for n in (1, 2)]
    main(["dedup-sam", "-i", *paths, "-o", str(tmp_path / "clean"), "--keep-last", "-k", str(tmp_path / "bed")], spark)
    for n in (1, 2):
        lines = [r.value for r in spark.read.text(str(tmp_path / "clean" / f"file={n}.sam")).collect()]
        assert sum(x.startswith("@") for x in lines) == 3 and sorted(x.split("\t")[0] for x in lines if x[0] != "@") == [f"x:{n}{i}:ACGT" for i in (1, 3, 5)]
    (tmp_path / "sizes").write_text("c2\t900\nc1\t900\n")
    main(["tracks", "-a", f"s/A/first={paths[0]}", f"s/B/first={paths[1]}", "-o", str(tmp_path / "tracks"), "-mr", "--keep-last", "-g", str(tmp_path / "sizes")], spark)
    assert sorted(p.name for p in (tmp_path / "tracks" / "bigwig" / "reads").iterdir()) == ["s_A_plus_coverage.bw", "s_B_plus_coverage.bw"]
    wig = read_bigwig(spark, str(tmp_path / "tracks" / "bigwig" / "reads_merged" / "s_plus_coverage.bw"))
    assert [tuple(r) for r in wig.orderBy("start_pos").collect()] == [("c1", s, s + 20, 2.0) for s in (9, 49, 89)]
    sites = spark.read.csv(str(tmp_path / "tracks" / "bed" / "xlinks"), sep="\t")
    assert sorted(int(r._c1) for r in sites.collect()) == [8, 8, 48, 48, 88, 88]
    merged = spark.read.parquet(str(tmp_path / "tracks" / "coverage_reads_merged"))
    assert {(r.start_pos, r.depth) for r in merged.collect()} == {(9, 2), (49, 2), (89, 2)}
    fastq(tmp_path / "all.fastq", ["x:10:ACGT 1:N", "u:1:AAAA 1:N", "y 1:N"])
    main(["unmapped", "-f", str(tmp_path / "all.fastq"), "-a", *paths, "-o", str(tmp_path / "rest"), "--plain"], spark)
    rest = [r.value for r in spark.read.text(str(tmp_path / "rest")).collect()]
    assert sorted(x for x in rest if x[0] == "@") == ["@u:1:AAAA 1:N", "@y 1:N"]
