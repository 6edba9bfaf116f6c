import random
import struct

import pytest
from pyspark.sql import functions as F

from readloom.operators.zoom import pyramid
from readloom.sources.bigwig import BigWigReader, bigwig_bins, read_bigwig, write_bigwig

RUNS = "chrom string, start_pos long, end_pos long, depth long"


def made(n, contigs, far, seed=1):
    rng = random.Random(seed)
    out = []
    for c in contigs:
        at = 0
        for _ in range(n):
            start = at + rng.choice([0, 1, 50])
            at = start + rng.choice([1, 3, 40, 900])
            if at <= far:
                out.append((c, start, at, rng.randint(1, 900)))
    return out


def sizes(spark, contigs, far):
    return spark.createDataFrame([(c, far) for c in contigs], "chrom string, size long")


def told(df):
    return [tuple(r) for r in df.collect()]


def plain_bins(runs, size, far):
    found = {}
    for c, s, e, d in runs:
        for p in range(s // size, (e - 1) // size + 1):
            b = min(e, (p + 1) * size) - max(s, p * size)
            v = found.setdefault((c, p), [0, d, d, 0, 0])
            found[c, p] = [v[0] + b, min(v[1], d), max(v[2], d), v[3] + b * d, v[4] + b * d * d]
    return sorted((c, p * size, min(far, (p + 1) * size), *v) for (c, p), v in found.items())


def test_levels_are_summed_from_one_another(spark):
    runs = made(300, ["x", "y"], 10**9)
    df = spark.createDataFrame(runs, RUNS)
    got = pyramid(df, size=64, levels=3, times=4)
    for level, size in ((1, 64), (2, 256), (3, 1024)):
        assert sorted(told(got.filter(F.col("level") == level).drop("level"))) == plain_bins(runs, size, 1 << 60)


def test_files_read_back(spark, tmp_path):
    contigs = [f"c{i}" for i in range(5)]
    runs = made(3000, contigs[:4], 400_000)
    path = str(tmp_path / "a.bw")
    write_bigwig(spark.createDataFrame(runs, RUNS).repartition(6), sizes(spark, contigs, 400_000), path)
    assert told(read_bigwig(spark, path)) == [(*r[:3], float(r[3])) for r in runs]
    for region, (c, s, e) in {"c1:1,001-2000": ("c1", 1000, 2000), "c3:390000-400000": ("c3", 389_999, 400_000), "c4:1-10": ("c4", 0, 10)}.items():
        assert told(read_bigwig(spark, path, region=region)) == [(*r[:3], float(r[3])) for r in runs if r[0] == c and r[1] < e and r[2] > s]
    levels = bigwig_bins(path)
    assert len(levels) > 2 and all(b == 4 * a for a, b in zip(levels, levels[1:], strict=False))
    as_float = lambda x: struct.unpack("<f", struct.pack("<f", x))[0]
    for size in levels:
        want = [(*r[:4], *map(as_float, r[4:])) for r in plain_bins(runs, size, 400_000)]
        assert told(read_bigwig(spark, path, bins=size)) == want
    with pytest.raises(Exception, match="bins of the file"):
        read_bigwig(spark, path, bins=7).count()
    assert [p.name for p in tmp_path.iterdir()] == ["a.bw"]


def test_trees_of_several_levels_and_regions_that_read_little(spark, tmp_path):
    contigs = [f"contig{i:04d}" for i in range(700)]
    n = 320_000
    df = spark.range(n).select(F.lit("contig0350").alias("chrom"), (F.col("id") * 3).alias("start_pos"), (F.col("id") * 3 + 2).alias("end_pos"), (F.col("id") % 90 + 1).alias("depth"))
    path = str(tmp_path / "a.bw")
    write_bigwig(df, sizes(spark, contigs, 3 * n), path)
    reader = BigWigReader({"path": path})
    assert reader.layout.names == contigs and set(reader.layout.sizes) == {3 * n}
    assert sum(len(p.places) for p in reader.partitions()) > 256
    few = BigWigReader({"path": path, "region": "contig0350:600,001-600,100"})
    assert sum(len(p.places) for p in few.partitions()) <= 2
    assert told(read_bigwig(spark, path, region="contig0350:600,001-600,004")) == [("contig0350", 600_000, 600_002, 200_000 % 90 + 1.0), ("contig0350", 600_003, 600_005, 200_001 % 90 + 1.0)]
    assert read_bigwig(spark, path).agg(F.count("*"), F.sum("value")).first() == (n, float(sum(i % 90 + 1 for i in range(n))))
    raw = (tmp_path / "a.bw").read_bytes()
    assert raw[:4] == raw[-4:] == struct.pack("<I", 0x888FFC26)
    covered, least, most, total, squares = struct.unpack_from("<Qdddd", raw, struct.unpack_from("<Q", raw, 44)[0])
    assert (covered, least, most) == (2 * n, 1.0, 90.0)
    assert (total, squares) == (2.0 * sum(i % 90 + 1 for i in range(n)), 2.0 * sum((i % 90 + 1) ** 2 for i in range(n)))


def test_no_coverage_and_coverage_beyond_a_contig(spark, tmp_path):
    empty = spark.createDataFrame([], RUNS)
    write_bigwig(empty, sizes(spark, ["a"], 10), str(tmp_path / "a.bw"))
    assert read_bigwig(spark, str(tmp_path / "a.bw")).collect() == []
    for row in (("a", 5, 11, 1), ("b", 1, 2, 1)):
        with pytest.raises(Exception, match="not within a contig"):
            write_bigwig(spark.createDataFrame([row], RUNS), sizes(spark, ["a"], 10), str(tmp_path / "b.bw"))
