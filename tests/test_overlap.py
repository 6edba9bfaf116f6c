import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from readloom.functions.sequence import revcomp
from readloom.operators.merge import merge_mates
from readloom.operators.overlap import best_overlaps, consensus, merge_mates_by_score
from readloom.plans.run import main


def plain(a, qa, b, qb, least, rate):
    """Every overlap, position by position."""
    best = (0, 0, 0)
    for n in range(max(1, least), min(len(a), len(b)) + 1):
        score = wrong = 0
        for x, y, p, q in zip(a[len(a) - n :], b[:n], qa[len(a) - n :], qb[:n], strict=True):
            if 78 not in (x, y):
                score += min(p, q) - 33 if x == y else 33 - min(p, q)
                wrong += x != y
        if wrong <= rate * n and score > 0 and score >= best[2]:
            best = (n, wrong, score)
    return best


BASES, SIGNS = st.text("ACGTN", max_size=30), "!#+5?IJ"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(BASES, BASES, st.randoms(use_true_random=False)), min_size=1, max_size=6), st.integers(1, 8), st.sampled_from([0.0, 0.1, 0.5]))
def test_best_overlaps_are_those_of_every_position(pairs, least, rate):
    rows = [(a.encode(), "".join(r.choices(SIGNS, k=len(a))).encode(), b.encode(), "".join(r.choices(SIGNS, k=len(b))).encode()) for a, b, r in pairs]
    got = best_overlaps(*map(list, zip(*rows, strict=True)), least, rate)
    assert list(zip(*(x.tolist() for x in got), strict=True)) == [plain(*row, least, rate) for row in rows]


def test_consensus_takes_the_better_base():
    assert consensus(b"AACGN", b"I5I#!", b"CGTTT", b"III+I", 3) == ("AACGTTT", "I5JJI+I")
    seq, qual = consensus(b"ACGT", b"5555", b"CTTA", b"!I5#", 3)
    assert seq == "ACTTA" and qual == "5" + "5" + "5" + chr(33 + 40) + "#"
    assert consensus(b"AN", b"I!", b"NG", b"!5", 2) == ("AG", "I5")


def pairs(spark, rows):
    df = spark.createDataFrame(rows, "rec_idx long, seq_f string, qual_f string, s string, q string")
    return df.select("rec_idx", F.lit("@n").alias("name_f"), "seq_f", "qual_f", F.lit("@n").alias("name_r"), revcomp(F.col("s")).alias("seq_r"), F.reverse("q").alias("qual_r"))


def test_exact_overlaps_are_a_special_case(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        whole = "".join(rng.choices("ACGT", k=80))
        cut, start = rng.randint(20, 80), rng.randint(0, 60)
        rows.append((i, whole[:cut], "I" * cut, whole[start:], "I" * (80 - start)))
    df = pairs(spark, [*rows, (900, None, None, "ACGT", "IIII"), (901, "", "", "", "")])
    want, rest = merge_mates(df, min_overlap=8)
    got, left = merge_mates_by_score(df, min_overlap=8, max_mismatch_rate=0)
    assert sorted((r.rec_idx, r.seq) for r in got.collect()) == sorted((r.rec_idx, r.seq) for r in want.collect())
    assert {900, 901} < {r.rec_idx for r in left.collect()} == {r.rec_idx for r in rest.collect()}


def test_a_wrong_base_of_low_quality_does_not_matter(spark):
    whole = "ACGTTGCAAGCTTACGGATCCATGCATTACGGCATCGATTACAGG"
    wrong = whole[15:20] + "A" + whole[21:]
    df = pairs(spark, [(1, whole[:35], "I" * 35, wrong, "I" * 5 + "#" + "I" * (len(wrong) - 6))])
    assert merge_mates(df)[0].filter(F.length("seq") == len(whole)).count() == 0
    row = merge_mates_by_score(df)[0].first()
    assert (row.seq, row.overlap, row.mismatches) == (whole, 20, 1)
    assert row.qual == "I" * 15 + "J" * 5 + chr(33 + 38) + "J" * 14 + "I" * 10
    assert merge_mates_by_score(df, max_mismatch_rate=0.04)[0].filter("mismatches > 0").count() == 0
    assert merge_mates_by_score(df, min_insert=46)[0].count() == 0


@pytest.mark.parametrize(("rate", "n"), [("0.1", 1), ("0", 0)])
def test_command_merges_with_mismatches(spark, tmp_path, rate, n):
    insert = "ACG" + "ACAC" + "TG" + "GATTACAGATTACCAGGTTCCA"
    turned = (insert[:20] + "T" + insert[21:])[::-1].translate(str.maketrans("ACGT", "TGCA"))
    for name, seq in (("f", insert), ("r", turned)):
        (tmp_path / f"{name}.fastq").write_text(f"@a b\n{seq}\n+\n{'I' * len(seq)}\n")
    (tmp_path / "samples.fa").write_text(">one\nACAC\n>two\nGGTT\n")
    args = ["demux", "-f", str(tmp_path / "f.fastq"), "-r", str(tmp_path / "r.fastq"), "-b", str(tmp_path / "samples.fa"), "-o", str(tmp_path / "out"), "-ub", "iclip", "-bm", "-mm", rate]
    main(args, spark)
    assert spark.read.parquet(str(tmp_path / "out/merged")).count() == n
