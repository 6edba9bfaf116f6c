import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from readloom.operators import coverage as C
from readloom.operators import dedup as D
from readloom.operators import demux as X
from readloom.operators.merge import mapping_input, unmapped
from readloom.plans.layout import parse_layout

BED = "chrom string, start_pos long, end_pos long, name string, mapq int, strand string"


def bed(spark, rows):
    return spark.createDataFrame(rows, BED)


def test_neighbourhood_is_the_unique_nearest_sample(spark):
    rng = random.Random(1)
    samples = [(f"s{i}", "".join(rng.choice("ACGT") for _ in range(4))) for i in range(6)]
    samples = list({b: (s, b) for s, b in samples}.values())
    codes = spark.createDataFrame([("".join(x),) for x in product("ACGTN.", repeat=4)], "index_key string")
    for most in (0, 1, 2, 4):
        sheet = spark.createDataFrame(samples, "sample string, barcode string")
        got = {r[0]: r[1] for r in X.nearest_by_pieces(codes, sheet, most).collect()}
        assert most > 2 or got == {r[0]: r[1] for r in X.small_neighbourhood(sheet, most).collect()}
        for index in map("".join, product("ACGTN", repeat=4)):
            near = sorted((sum(a != b for a, b in zip(index, code, strict=True)), s) for s, code in samples)
            lone = near[0][0] <= most and (len(near) == 1 or near[1][0] > near[0][0])
            assert got.get(index) == (near[0][1] if lone else None)


def test_five_mismatches_on_thirteen_bases(spark):
    rng = random.Random(2)
    text = lambda: "".join(rng.choices("ACGT", k=13))
    samples = [(f"s{i}", text()) for i in range(40)]
    changed = lambda code, n: "".join(rng.choice("ACGTN") if i in places else c for places in [rng.sample(range(13), n)] for i, c in enumerate(code))
    codes = [changed(rng.choice(samples)[1], rng.randint(0, 8)) for _ in range(600)] + [text() for _ in range(200)] + ["ACG", "", "A" * 20, None]
    reads = spark.createDataFrame(list(enumerate(codes)), "n int, index_code string")
    got = {r.n: r.sample for r in X.with_sample(reads, spark.createDataFrame(samples, "sample string, barcode string"), 5).collect()}
    assert len(got) == len(codes)
    for n, code in enumerate(codes):
        near = sorted((sum(a != b for a, b in zip(code or "", own, strict=False)), s) for s, own in samples) if len(code or "") == 13 else [(9, "")] * 2
        assert got[n] == (near[0][1] if near[0][0] <= 5 and near[0][0] < near[1][0] else None)


def test_demux_edges(spark):
    samples = spark.createDataFrame([("one", "AAAA"), ("two", "AATT")], "sample string, barcode string")
    layout = parse_layout("L=NXXXXRN")
    rows = ["GAAATACCC", "GAAACACCC", "GAAATNCCC", "AAA", "GAaAAACTT"]
    reads = spark.createDataFrame([(i, "@n x", s, "I" * len(s)) for i, s in enumerate(rows)], "rec_idx long, name string, seq string, qual string")
    got = {r.rec_idx: r for r in X.demux_merged(reads, samples, layout).collect()}
    assert [got[i].outcome for i in range(5)] == ["bad_barcode", "assigned", "alien", "too_short", "assigned"]
    assert (got[1].sample, got[1].replicate, got[4].sample) == ("one", "A", "one")
    assert all(len(r.seq) == len(r.qual) for r in got.values() if r.outcome == "assigned")


def test_long_sheets_are_left_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(X, "DRIVER_ROWS", 3)
    sheet = spark.createDataFrame([("one", "AAAA"), ("two", "CCCC")], "sample string, barcode string")
    assert X.small_neighbourhood(sheet, 1) is None
    reads = spark.createDataFrame([("ACAA",)], "index_code string")
    assert X.with_sample(reads, sheet, 1).first().sample == "one"


def test_samples_are_checked(spark):
    for rows in ([("a", "AC"), ("b", "AC")], [("a", "AC"), ("b", "ACG")]):
        with pytest.raises(ValueError):
            X.check_samples(spark.createDataFrame(rows, "sample string, barcode string"))


def test_read_dedup_ties(spark):
    rows = [(5, "@a:1:2:3:4:5:6:AC x", "ACGT", "IIII"), (2, "@b:1:2:3:4:5:6:AC x", "ACGT", "IIII"), (1, "@c:1:2:3:4:5:6:AC x", "ACGT", "III!"), (0, "@d", "ACGT", "!!!!")]
    reads = spark.createDataFrame(rows, "rec_idx long, name string, seq string, qual string")
    kept = D.best_reads(reads)
    assert sorted(r.rec_idx for r in kept.collect()) == [0, 2]
    assert tuple(D.read_stats(reads, kept).first()) == (4, 2, 2, 50.0)
    assert D.best_reads(kept.select("rec_idx", "name", "seq", "qual")).count() == 2


def test_alignment_dedup_fixtures(spark):
    plus = [("c", 100, 120, "r1:AAA", 20, "+"), ("c", 100, 121, "r2:AAC", 20, "+"), ("c", 300, 320, "r3:GGG", 20, "+")]
    assert [r.name for r in D.dedup_alignments(bed(spark, plus)).collect()] == ["r2:AAC"]
    minus = [("c", 100, 150, "r1:AAA", 20, "-"), ("c", 105, 150, "r2:AAA", 20, "-"), ("c", 300, 320, "r3:GGG", 20, "-")]
    assert [r.name for r in D.dedup_alignments(bed(spark, minus)).collect()] == ["r2:AAA"]
    low = [("c", 100, 120, "r1:AAA", 30, "+"), ("c", 100, 120, "r2:AAC", 5, "+"), ("c", 300, 320, "r3:GGG", 20, "+")]
    assert D.dedup_alignments(bed(spark, low)).count() == 0
    mixed = [("c", 100, 120, "r1:AAA", 20, "+"), ("c", 100, 120, "r2:AAA", 20, "-"), ("c", 100, 120, "r3:AAA", 21, "+")]
    assert D.dedup_alignments(bed(spark, mixed), strict=False).count() == 3
    assert D.dedup_alignments(bed(spark, mixed[:1])).count() == 1
    with pytest.raises(Exception, match="no such strand"):
        D.dedup_alignments(bed(spark, [("c", 1, 2, "r:A", 20, "."), ("c", 1, 3, "r:A", 20, ".")])).collect()


def simulated(rows, strict):
    """One pass over the sorted rows, as a plain loop."""
    order = sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3].split(":")[-1], r[4], r[5], r[3].replace(":", " ")))
    kept = []
    for i, r in enumerate(order):
        n = order[i + 1] if i + 1 < len(order) else None
        if n is None and strict and len(order) > 1:
            continue
        same = n and n[0] == r[0] and n[5] == r[5] and (r[1] == n[1] if r[5] == "+" else r[2] == n[2])
        if not (same and sum(a != b for a, b in zip(r[3].split(":")[-1], n[3].split(":")[-1], strict=True)) <= 1) and r[4] >= 10:
            kept.append(r)
    return sorted(kept)


@pytest.mark.parametrize("strict", [True, False])
def test_alignment_dedup_is_the_sequential_one(spark, strict, monkeypatch):
    monkeypatch.setattr(D, "BIN", 7)
    rng = random.Random(3)
    rows = [(f"c{rng.randrange(3)}", s := rng.randrange(60), s + rng.randrange(1, 12), f"r:{i}:" + "".join(rng.choice("AC") for _ in range(3)), rng.randrange(30), rng.choice("+-")) for i in range(1500)]
    assert sorted(map(tuple, D.dedup_alignments(bed(spark, rows), strict=strict).collect())) == simulated(rows, strict)


def test_coverage_is_the_count_by_base(spark, monkeypatch):
    monkeypatch.setattr(C, "BIN", 16)
    rng = random.Random(4)
    rows = [(f"c{rng.randrange(2)}", s := rng.randrange(200), s + rng.randrange(1, 30), "r", 9, rng.choice("+-")) for _ in range(300)]
    depth = {}
    for chrom, a, b, _, _, strand in rows:
        for at in range(a, b):
            depth[chrom, strand, at] = depth.get((chrom, strand, at), 0) + 1
    runs = C.coverage(bed(spark, rows)).collect()
    got = {(r.chrom, r.strand, at): r.depth for r in runs for at in range(r.start_pos, r.end_pos)}
    assert got == depth
    ends = {(r.chrom, r.strand, r.end_pos): r.depth for r in runs}
    assert all(ends.get((r.chrom, r.strand, r.start_pos)) != r.depth for r in runs)


def test_coverage_fixtures_and_crosslinks(spark):
    def runs(*spans):
        return sorted((r.start_pos, r.end_pos, r.depth) for r in C.coverage(bed(spark, [("c", a, b, "r", 9, "+") for a, b in spans])).collect())

    assert runs((0, 10), (5, 15)) == [(0, 5, 1), (5, 10, 2), (10, 15, 1)]
    assert runs((0, 5), (5, 10)) == [(0, 10, 1)]
    sites = C.crosslinks(bed(spark, [("c", 1, 9, "a", 9, "+"), ("c", 2, 9, "b", 9, "+"), ("c", 40, 50, "d", 9, "-")]))
    assert sorted((r.start_pos, r.end_pos) for r in sites.collect()) == [(1, 2), (50, 51)]
    sizes = spark.createDataFrame([("c", 50)], "chrom string, size long")
    assert C.within_chromosomes(sites, sizes).count() == 1


def test_unmapped_and_mapping_input(spark):
    reads = spark.createDataFrame([("a",), ("b",)], "name string")
    assert [r.name for r in unmapped(reads, reads.filter("name = 'a'")).collect()] == ["b"]
    merged = spark.createDataFrame([("s", "A", "n", "AC", "II", "assigned")], "sample string, replicate string, name string, seq string, qual string, outcome string")
    assert mapping_input(merged).count() == 1


def test_empty_tables(spark):
    none = bed(spark, [])
    for df in (D.dedup_alignments(none), C.coverage(none), C.crosslinks(none), D.alignment_stats(none)):
        df.collect()
    assert D.alignment_stats(none).first()["percent_kept"] == 0.0
    assert F is not None
