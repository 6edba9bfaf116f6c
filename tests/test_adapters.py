import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from readloom.operators.adapters import adapter_places, trim_adapter
from readloom.plans.run import main


def plain(read, adapter, least, rate):
    best = (-1, len(read), 0)
    for at in range(len(read)):
        pairs = list(zip(read[at:], adapter, strict=False))
        wrong = sum(x != y != "N" for x, y in pairs)
        score = len(pairs) - 2 * wrong
        if len(pairs) >= max(1, least) and wrong <= rate * len(pairs) and score > best[0]:
            best = (score, at, wrong)
    return best[1:]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ACN", max_size=25), min_size=1, max_size=8), st.text("ACN", min_size=1, max_size=8), st.integers(0, 5), st.sampled_from([0.0, 0.1, 0.3]))
def test_places_are_those_of_every_position(reads, adapter, least, rate):
    got = adapter_places([r.encode() for r in reads], adapter.encode(), least, rate)
    assert list(zip(*(x.tolist() for x in got), strict=True)) == [plain(r, adapter, least, rate) for r in reads]


def test_reads_are_cut_at_the_adapter(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("CT", k=30)) + "AGATCGGAAGAGC" + "".join(rng.choices("CT", k=9))) for i in range(50)]
    rows += [(100, "CTCTCTAGAT"), (101, "CTCTCTCTCT"), (102, ""), (103, None), (104, "AGATCGGAAGAGC"), (105, "CTCTCTCTAG")]
    reads = spark.createDataFrame([(i, s, None if s is None else "I" * len(s)) for i, s in rows], "rec_idx int, seq string, qual string")
    got = {r.rec_idx: r for r in trim_adapter(reads, "agatcggaagagc").collect()}
    assert all(got[i].seq == s[:30] and got[i].qual == "I" * 30 and got[i].adapter_mismatches == 0 for i, s in rows[:50])
    assert [(got[i].seq, got[i].adapter_mismatches) for i in range(100, 106)] == [("CTCTCT", 0), ("CTCTCTCTCT", None), ("", None), (None, None), ("", 0), ("CTCTCTCTAG", None)]
    for adapter in ("", "AXG"):
        with pytest.raises(ValueError, match="not an adapter"):
            trim_adapter(reads, adapter)


def test_command_trims_both_mates(spark, tmp_path):
    for name, seq in (("f", "ACG" + "ACAC" + "TG" + "GATTACAGATTACC" + "AGATCGGAAG"), ("r", "GGTTCCAATTGG" + "TTTTTCCC")):
        (tmp_path / f"{name}.fastq").write_text(f"@a b\n{seq}\n+\n{'I' * len(seq)}\n")
    (tmp_path / "samples.fa").write_text(">one\nACAC\n>two\nGGTT\n")
    main(["demux", "-f", str(tmp_path / "f.fastq"), "-r", str(tmp_path / "r.fastq"), "-b", str(tmp_path / "samples.fa"), "-o", str(tmp_path / "out"), "-ub", "iclip", "-a1", "AGATCGGAAGAGC", "-a2", "TTTTTCCCG"], spark)
    row = spark.read.parquet(str(tmp_path / "out/pairs")).first()
    assert (row.seq_f, row.seq_r) == ("GATTACAGATTACC", "GGT")
