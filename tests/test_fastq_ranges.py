import gzip
import io
import random

import pytest

from readloom.operators.merge import pair_up
from readloom.sources import bgzf
from readloom.sources.fastq import counted, found_files, split_pairs, split_reads
from readloom.sources.readers import read_fastq, read_pairs


def made(n, seed=1, longest=120):
    """Reads whose qualities look like names and plus lines."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.randint(1, longest)
        out.append((f"@r{i} {rng.randint(1, 9)}:N", "".join(rng.choices("ACGTN", k=size)), rng.choice("@+I!") + "".join(rng.choices("@+IF#", k=size - 1))))
    return out


def text(rows, end="\n"):
    return end.join(x for n, s, q in rows for x in (n, s, "+", q))


def blocked(raw):
    out = io.BytesIO()
    writer = bgzf.Writer(out)
    for i in range(0, len(raw), 3000):
        writer.put(raw[i : i + 3000])
        writer.flush()
    return out.getvalue() + bgzf.END


def told(df):
    return [(r.rec_idx, r.name, r.seq, r.qual) for r in df.collect()]


@pytest.mark.parametrize("end", ["", "\n", "\n\n", "\n@cut\nACGT\n+", "\n@cut\nACG"])
@pytest.mark.parametrize("kind", ["plain", "dos", "blocked"])
def test_ranges_begin_at_records(spark, tmp_path, kind, end):
    rows = made(400)
    raw = (text(rows, "\r\n" if kind == "dos" else "\n") + end).encode()
    path = tmp_path / ("a.fastq.gz" if kind == "blocked" else "a.fastq")
    path.write_bytes(blocked(raw) if kind == "blocked" else raw)
    for size in (300, 5000, 1 << 20):
        df = split_reads(spark, str(path), size)
        assert told(df) == [(i, *r) for i, r in enumerate(rows)]
        assert size > 5000 or df.rdd.getNumPartitions() > 3


def test_empty_and_tiny_files(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("")
    (tmp_path / "b.fastq").write_text("@only\nAC\n+\n@@")
    assert [(r.file_no, r.rec_idx, r.seq, r.qual) for r in read_fastq(spark, str(tmp_path / "*.fastq")).collect()] == [(2, 0, "AC", "@@")]
    assert read_fastq(spark, str(tmp_path / "a.fastq")).collect() == []


@pytest.mark.parametrize("kinds", [("plain", "plain"), ("blocked", "plain"), ("gzip", "plain"), ("plain", "gzip")])
def test_mates_of_ranges(spark, tmp_path, kinds):
    pack = {"plain": lambda b: b, "gzip": gzip.compress, "blocked": blocked}
    names = []
    for lane, n in ((1, 700), (2, 300)):
        for mate, kind, extra in (("R1", kinds[0], 40 * (lane == 1)), ("R2", kinds[1], 25 * (lane == 2))):
            rows = made(n + extra, seed=lane * 10 + int(mate[1]), longest=60 if mate == "R1" else 150)
            path = tmp_path / f"lane{lane}_{mate}.fastq{'' if kind == 'plain' else '.gz'}"
            path.write_bytes(pack[kind](text(rows).encode()))
            names.append((lane, mate, rows))
    by = {(lane, mate): rows for lane, mate, rows in names}
    want = [(lane, i, *f, *r) for lane, n in ((1, 700), (2, 300)) for i, (f, r) in enumerate(zip(by[lane, "R1"][:n], by[lane, "R2"][:n], strict=True))]
    paths = [str(tmp_path / f"*_{m}.fastq*") for m in ("R1", "R2")]
    for size in (4000, 1 << 20):
        assert [tuple(r) for r in split_pairs(spark, *paths, size).collect()] == want
    joined = pair_up(read_fastq(spark, paths[0]), read_fastq(spark, paths[1]))
    assert sorted(tuple(r) for r in joined.collect()) == want


def test_reading_and_pairing_has_no_exchange(spark, tmp_path):
    for mate in "fr":
        (tmp_path / f"{mate}.fastq").write_text(text(made(500)))
    plan = read_pairs(spark, str(tmp_path / "f.fastq"), str(tmp_path / "r.fastq"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "BatchScan" in plan


def test_places_are_noted_within_ranges(spark, tmp_path):
    rows = made(60_000)
    (tmp_path / "a.fastq").write_text(text(rows))
    (tmp_path / "b.fastq").write_text(text(rows[::-1]))
    found = counted(spark, found_files(str(tmp_path / "a.fastq")), 4 << 20)[1]
    raw = (tmp_path / "a.fastq").read_bytes()
    assert sum(len(p.marks) - 1 for p in found) > 5
    for n, place in (m for p in found for m in p.marks):
        assert raw[place : place + 60].startswith(rows[n][0].encode() + b"\n")
    pairs = split_pairs(spark, str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq"), 4 << 20).select("rec_idx", "name_f", "name_r").collect()
    assert [tuple(r) for r in pairs] == [(i, rows[i][0], rows[-1 - i][0]) for i in range(60_000)]


def test_what_is_no_fastq_fails(spark, tmp_path):
    (tmp_path / "a.fastq").write_text(text(made(100)) + "\nodd line\n" + text(made(100)))
    with pytest.raises(Exception, match="do not meet"):
        split_reads(spark, str(tmp_path / "a.fastq"), 2000).count()
    with pytest.raises(ValueError, match="not a FASTQ"):
        read_fastq(spark, str(tmp_path / "a.txt"))
