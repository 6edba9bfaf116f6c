import random

import pytest
from pyspark.sql import functions as F

from readloom.plans.run import main
from readloom.sources import bgzf
from readloom.sources.bam import COLUMNS, SCHEMA, BamReader, read_bam, read_bam_header, with_lines, write_bam
from readloom.sources.bam_index import Index
from readloom.sources.bam_records import bin_of, bins_over, span_of

HEADER = ["@HD\tVN:1.6\tSO:coordinate", "@SQ\tSN:chrB\tLN:5000000", "@SQ\tSN:chrA\tLN:600000000", "@PG\tID:x"]
CONTIGS = ["chrB", "chrA"]


def header(spark):
    return spark.createDataFrame(list(enumerate(HEADER)), "line_no long, line string")


def made(n, seed=1, longest=60, far=200_000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = rng.randint(1, longest)
        seq = "".join(rng.choices("ACGTN", k=size))
        qual = "*" if i % 7 == 0 else "".join(chr(33 + rng.randint(0, 60)) for _ in range(size))
        tags = [["NM:i:-3", "XA:A:q", "MD:Z:a b"], ["XB:B:c,-1,2", "XF:f:1.5"], [], ["NM:i:4000000000", "XH:H:1AE3"]][i % 4]
        if i % 11 == 0:
            rows.append((f"r{i}", 4, "*", 0, 0, "*", "*", 0, 0, seq, qual, tags))
        else:
            cigar = f"{size}M" if i % 3 else f"{size}M{rng.randint(1, 40_000)}N5D"
            rows.append((f"r{i}", rng.choice([0, 16]), rng.choice(CONTIGS), rng.randint(1, far), i % 60, cigar, rng.choice(["=", "*", "chrA"]), rng.randint(0, 99), -i, seq, qual, tags))
    return [(*r[:6], "=" if r[6] == r[2] != "*" else "*" if r[2] == "*" and r[6] == "=" else r[6], *r[7:]) for r in rows]


def in_order(rows):
    return sorted(rows, key=lambda r: (CONTIGS.index(r[2]) if r[2] in CONTIGS else 9, r[3], r[0], r[1]))


def told(df):
    return [(*r[:11], list(r[11])) for r in df.select(*COLUMNS).collect()]


def written(spark, rows, path, parts=4):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_bam(header(spark), spark.createDataFrame(rows, SCHEMA).repartition(parts), str(path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return str(path)


@pytest.mark.parametrize(("longest", "n", "range_bytes"), [(60, 6000, 20_000), (60, 6000, 1), (70_000, 60, 30_000), (200_000, 20, 20_000)])
def test_ranges_read_what_was_written_in_order(spark, tmp_path, longest, n, range_bytes):
    rows = made(n, longest=longest)
    path = written(spark, rows, tmp_path / "a.bam")
    if range_bytes == 1:
        range_bytes = 700
    bam = read_bam(spark, path, range_bytes=range_bytes)
    size = (tmp_path / "a.bam").stat().st_size
    assert bam.rdd.getNumPartitions() == -(-size // range_bytes) > 3
    assert told(bam) == in_order(rows)
    assert told(read_bam(spark, path)) == in_order(rows)
    assert [r.line for r in read_bam_header(spark, path).collect()] == HEADER
    assert not list(tmp_path.glob("*.parts-*"))


def test_a_region_reads_only_blocks_that_may_hold_it(spark, tmp_path):
    rows = made(30_000, far=4_900_000)
    path = written(spark, rows, tmp_path / "a.bam")
    size = (tmp_path / "a.bam").stat().st_size
    for region, (contig, first, last) in {"chrB:1,000,000-1,020,000": ("chrB", 1_000_000, 1_020_000), "chrA:4899990": ("chrA", 4_899_990, 1 << 40), "chrB": ("chrB", 1, 1 << 40), "chrA:5": ("chrA", 5, 1 << 40), "chrB:4999999-5000000": ("chrB", 4_999_999, 5_000_000)}.items():
        want = [r for r in in_order(rows) if r[2] == contig and r[3] <= last and r[3] - 1 + max(1, span_of(r[5])) > first - 1]
        assert told(read_bam(spark, path, region=region)) == want
    parts = BamReader({"path": path, "region": "chrB:1,000,000-1,020,000"}).partitions()
    assert sum((p.last >> 16) - (p.first >> 16) + (1 << 16) for p in parts) < size / 3
    with pytest.raises(ValueError, match="no contig"):
        BamReader({"path": path, "region": "chrZ:1-2"}).partitions()


def test_the_index_of_parts_is_that_of_one_part(spark, tmp_path):
    rows = made(3000)
    one, many = (Index.of_file(written(spark, rows, tmp_path / f"{n}.bam", parts=n) + ".bai") for n in (1, 5))
    assert one.unplaced == many.unplaced == sum(r[2] == "*" for r in rows)
    assert [set(b) for b in one.bins] == [set(b) for b in many.bins]
    assert [len(w) for w in one.windows] == [len(w) for w in many.windows]


def test_empty_and_headers_only(spark, tmp_path):
    path = written(spark, spark.createDataFrame([], SCHEMA).collect(), tmp_path / "a.bam")
    assert read_bam(spark, path).count() == 0 and read_bam(spark, path, region="chrA").count() == 0
    assert (tmp_path / "a.bam").read_bytes().endswith(bgzf.END)


def test_bins_hold_what_they_should():
    rng = random.Random(3)
    for _ in range(3000):
        start = rng.randrange(1 << 29)
        end = min(1 << 29, start + rng.choice([1, 50, 20_000, 3_000_000]))
        at = rng.randrange(max(0, start - 40_000), end + 40_000)
        over = max(at, start) < min(at + 1000, end)
        assert bin_of(start, end) in bins_over(start, end)
        assert not over or bin_of(start, end) in bins_over(at, at + 1000)
    assert (bin_of(0, 1), bin_of(0, 1 << 29), bin_of(1 << 14, (1 << 14) + 5)) == (4681, 0, 4682)


def test_what_a_record_cannot_hold_is_said(spark, tmp_path):
    good = ("r", 0, "chrA", 1, 0, "3M", "*", 0, 0, "ACG", "III", [])
    for i, value, message in ((2, "chrX", "no contig"), (5, "3Q", "CIGAR"), (10, "II", "differ"), (0, "n" * 300, "too long")):
        row = (*good[:i], value, *good[i + 1 :])
        with pytest.raises(Exception, match=message):
            written(spark, [row], tmp_path / "bad.bam")
    assert not list(tmp_path.iterdir())


def test_several_bam_files_are_cleaned_in_one_job(spark, tmp_path):
    for name, seed in (("one", 5), ("two", 6)):
        written(spark, made(500, seed=seed), tmp_path / f"{name}.bam")
    both = read_bam(spark, str(tmp_path / "*.bam"))
    assert {r.file: r["count"] for r in both.groupBy("file").count().collect()} == {"one.bam": 500, "two.bam": 500}
    out = tmp_path / "kept"
    main(["dedup-sam", "-i", str(tmp_path / "one.bam"), str(tmp_path / "two.bam"), "-o", str(out), "--bam"], spark)
    kept = read_bam(spark, str(out / "one.bam"))
    alone = tmp_path / "alone.bam"
    main(["dedup-sam", "-i", str(tmp_path / "one.bam"), "-o", str(alone), "--bam"], spark)
    assert 0 < kept.count() < 500
    assert [r.line for r in with_lines(kept).collect()] == [r.line for r in with_lines(read_bam(spark, str(alone))).collect()]
    assert (out / "two.bam.bai").exists()
    with pytest.raises(ValueError, match="would be overwritten"):
        main(["dedup-sam", "-i", str(alone), "-o", str(alone), "--bam"], spark)
    assert kept.filter(F.col("flag") == 4).count() == 0
