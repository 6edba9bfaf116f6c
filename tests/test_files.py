import gzip
import time

from pyspark.sql import functions as F

from readloom.operators import demux as X
from readloom.plans import run as R
from readloom.plans.layout import parse_layout
from readloom.sources import readers, writers
from readloom.streaming.demux_stream import count_stream, demux_stream, write_stream


def fastq(rows):
    return "".join(f"{n}\n{s}\n+\n{q}\n" for n, s, q in rows)


def made_reads(n):
    return [(f"@r{i}:x {i % 2}:N", "ACGTN"[i % 5] * 3 + "ACAC" + "GT" + "ACGTACGTAC", "I@+#!" [i % 5] * 19) for i in range(n)]


def test_fastq_round_trip_over_splits(spark, tmp_path):
    rows = made_reads(3000)
    (tmp_path / "a.fastq").write_text(fastq(rows) + "@cut\nACG\n")
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(fastq(rows[:70]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        plain = readers.read_fastq(spark, str(tmp_path / "a.fastq"))
        assert [tuple(r)[3:] for r in plain.orderBy("rec_idx").collect()] == rows
        assert [r.rec_idx for r in plain.orderBy("rec_idx").collect()] == list(range(3000))
        assert [tuple(r)[3:] for r in readers.read_fastq(spark, str(tmp_path / "b.fastq.gz")).orderBy("rec_idx").collect()] == rows[:70]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def sheet(tmp_path):
    (tmp_path / "samples.fa").write_text(">one\nACAC\n>two\nGGTT\n")
    return str(tmp_path / "samples.fa")


def test_demux_run_resumes(spark, tmp_path):
    rows = made_reads(200)
    for name in ("f", "r"):
        (tmp_path / f"{name}.fastq").write_text(fastq(rows))
    out = str(tmp_path / "out")
    args = ["demux", "-f", str(tmp_path / "f.fastq"), "-r", str(tmp_path / "r.fastq"), "-b", sheet(tmp_path), "-o", out, "-ub", "iclip", "--plain"]
    R.main(args, spark)
    first = (tmp_path / "out/pairs/_SUCCESS").stat().st_mtime_ns
    pairs = spark.read.parquet(f"{out}/pairs")
    assert pairs.count() == 200 and pairs.filter("outcome = 'assigned'").select("sample").distinct().collect()[0][0] == "one"
    text = spark.read.text(f"{out}/barcode_sorted/one_R1.fastq")
    assert text.count() == 4 * pairs.filter("outcome = 'assigned'").count()
    time.sleep(0.01)
    R.main(args, spark)
    assert (tmp_path / "out/pairs/_SUCCESS").stat().st_mtime_ns == first
    R.main([*args, "-hm", "0"], spark)
    assert (tmp_path / "out/pairs/_SUCCESS").stat().st_mtime_ns != first


def test_mates_are_merged_first(spark, tmp_path):
    insert = "ACG" + "ACAC" + "TG" + "GATTACAGATTACCAGGTTCCA"
    turned = insert[::-1].translate(str.maketrans("ACGT", "TGCA"))
    for name, seq in (("f", insert), ("r", turned)):
        (tmp_path / f"{name}.fastq").write_text(fastq([("@a b", seq, "I" * len(seq)), ("@c d", "A" * 20, "I" * 20)]))
    args = ["demux", "-f", str(tmp_path / "f.fastq"), "-r", str(tmp_path / "r.fastq"), "-b", sheet(tmp_path), "-o", str(tmp_path / "out"), "-ub", "iclip", "-bm"]
    R.main(args, spark)
    merged = spark.read.parquet(str(tmp_path / "out/merged")).collect()
    assert [(r.sample, r.seq, r.name) for r in merged] == [("one", insert[9:], "@a:ACGTG b")]
    assert spark.read.parquet(str(tmp_path / "out/pairs")).count() == 1


SAM = """@HD\tVN:1.0
@SQ\tSN:chr2\tLN:900
@SQ\tSN:chr1\tLN:900
r1:AAA x\t0\tchr1\t101\t20\t20M\t*\t0\t0\tA\tI\tNM:i:0
r2:AAC\t0\tchr1\t101\t20\t21M\t*\t0\t0\tA\tI
r3:GGG\t16\tchr2\t51\t30\t5M10N5M\t*\t0\t0\tA\tI
r4:GGG\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI
r5:TTT\t0\tchr2\t301\t30\t10M\t*\t0\t0\tA\tI
"""


def test_sam_to_tracks(spark, tmp_path):
    path = str(tmp_path / "a.sam")
    (tmp_path / "a.sam").write_text(SAM)
    bed = readers.sam_to_bed(readers.read_sam(spark, path))
    assert sorted((r.chrom, r.start_pos, r.end_pos, r.name, r.strand) for r in bed.collect())[0] == ("chr1", 100, 120, "r1:AAA", "+")
    assert bed.count() == 4
    R.main(["dedup-sam", "-i", path, "-o", str(tmp_path / "kept"), "-k", str(tmp_path / "kept_bed"), "--keep-last"], spark)
    lines = [r.value for r in spark.read.text(str(tmp_path / "kept")).collect()]
    assert lines[:3] == SAM.split("\n")[:3] and [x.split("\t")[0] for x in lines[3:]] == ["r3:GGG", "r5:TTT", "r2:AAC"]
    assert readers.read_bed(spark, str(tmp_path / "kept_bed")).count() == 3
    run = R.TrackRun(str(tmp_path / "tracks"), {("s", "A", "one"): path, ("s", "B", "one"): path}, strict=False, merge_replicates=True)
    found = R.run_tracks(spark, run)
    assert found["dedup"].count() == 6
    assert {r.depth for r in found["reads_merged"].collect()} == {2} and {r.depth for r in found["reads"].collect()} == {1}
    graph = readers.read_bedgraph(spark, str(tmp_path / "tracks/bedgraph/reads/sample=s/replicate=A/strand=+"))
    assert graph.filter("depth = 1").count() == 2


def test_stream_is_the_batch(spark, tmp_path):
    samples = readers.read_samples(spark, sheet(tmp_path)).select("sample", "barcode")
    rows = [(i, n, s, q, n, s, q) for i, (n, s, q) in enumerate(made_reads(50))]
    pairs = spark.createDataFrame(rows, "rec_idx long, name_f string, seq_f string, qual_f string, name_r string, seq_r string, qual_r string")
    pairs.write.parquet(str(tmp_path / "in"))
    layout = parse_layout("iclip")
    write_stream(demux_stream(spark, str(tmp_path / "in"), samples, layout), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    want = {(r.rec_idx, r.outcome, r.umi) for r in X.demux_pairs(pairs, samples, layout).collect()}
    assert {(r.rec_idx, r.outcome, r.umi) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want
    count_stream(demux_stream(spark, str(tmp_path / "in"), samples, layout), "seen").awaitTermination(120)
    assert spark.table("seen").agg(F.sum("count")).first()[0] == 50


def test_writers_list_and_sizes(spark, tmp_path):
    counts = spark.createDataFrame([("AC", 2), ("GG", 1)], "index_code string, n_reads long")
    writers.write_bad_barcodes(counts, str(tmp_path / "bad"))
    assert spark.read.csv(str(tmp_path / "bad"), sep="\t").count() == 2
    (tmp_path / "c.sizes").write_text("chr1\t10\n")
    assert readers.read_chrom_sizes(spark, str(tmp_path / "c.sizes")).first().size == 10


def test_files_by_sample_have_the_reads_in_order(spark, tmp_path):
    rows = [(i, ["one", "two"][i % 2], [None, "A", "B"][i % 3], "assigned" if i % 5 else "alien", f"@f{i}", "AC", "II", f"@r{i}", "GT", "##") for i in range(500)]
    pairs = spark.createDataFrame(rows, "rec_idx long, sample string, replicate string, outcome string, name_f string, seq_f string, qual_f string, name_r string, seq_r string, qual_r string").repartition(7)
    merged = pairs.select("rec_idx", "sample", "replicate", "outcome", F.col("name_f").alias("name"), F.col("seq_f").alias("seq"), F.col("qual_f").alias("qual"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_fastq(pairs, str(tmp_path / "out"), gzip=False)
        writers.write_fastq(merged, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = [f"{r}{s}" for r in ("", "A_", "B_") for s in ("one", "two")]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted([f"{n}_{m}.fastq" for n in names for m in ("R1", "R2")] + [f"{n}.fastq.gz" for n in names])
    for replicate, prefix in ((None, ""), ("A", "A_"), ("B", "B_")):
        own = [r for r in rows if r[1] == "two" and r[2] == replicate and r[3] == "assigned"]
        assert (tmp_path / "out" / f"{prefix}two_R1.fastq").read_text() == fastq([r[4:7] for r in own])
        assert (tmp_path / "out" / f"{prefix}two_R2.fastq").read_text() == fastq([r[7:10] for r in own])
        assert gzip.open(tmp_path / "out" / f"{prefix}two.fastq.gz", "rt").read() == fastq([r[4:7] for r in own])
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
