import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from readloom.operators import align
from readloom.operators.align import Shape, align_reads, aligned, minimizers
from readloom.plans.run import main
from readloom.sources.bam import read_bam
from readloom.sources.readers import sam_to_bed


def turned(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def text(rng, n):
    return "".join(rng.choices("ACGT", k=n))


def test_minimizers_are_the_same_on_both_strands():
    rng = random.Random(1)
    for n in (5, 15, 16, 40, 300):
        s = text(rng, n)
        one, other = (minimizers(x.encode(), 11, 4) for x in (s, turned(s)))
        assert sorted(one[0].tolist()) == sorted(other[0].tolist())
        assert {(h, n - 11 - p, not t) for h, p, t in zip(*map(list, other), strict=True)} == {(h, p, t) for h, p, t in zip(*map(list, one), strict=True)}
    assert not len(minimizers(b"ACGTNACGTNACGTNACGT", 6, 3)[0])
    s = text(rng, 100)
    kept = minimizers((s[:40] + "N" + s[41:]).encode(), 11, 4)[1]
    assert all(p + 11 <= 40 or p > 40 for p in kept)


def plain_score(read, window, shape):
    """Greatest score of the whole read anywhere in the window, cell by cell."""
    row = [0] * (len(window) + 1)
    for a in read:
        now = [row[0] + shape.gap]
        for j, b in enumerate(window):
            now.append(max(row[j] + (shape.match if a == b != "N" else shape.mismatch), row[j + 1] + shape.gap, now[-1] + shape.gap))
        row = now
    return max(row)


def score_of(read, window, found, shape):
    """Score of an alignment by its CIGAR."""
    _, j, cigar, wrong = found
    i = total = seen = 0
    number = ""
    for c in cigar:
        if c.isdigit():
            number += c
            continue
        for _ in range(int(number)):
            if c == "M":
                same = read[i] == window[j] != "N"
                total, seen, i, j = total + (shape.match if same else shape.mismatch), seen + (not same), i + 1, j + 1
            else:
                total, seen, i, j = total + shape.gap, seen + 1, i + (c == "I"), j + (c == "D")
        number = ""
    assert i == len(read) and seen == wrong
    return total


def test_alignments_have_the_greatest_score():
    rng, shape = random.Random(2), Shape()
    pairs = []
    for _ in range(150):
        window = "".join(rng.choices("ACGTN", weights=[9, 9, 9, 9, 1], k=50))
        at = rng.randint(0, 20)
        read = list(window[at : at + 28])
        for _ in range(rng.randint(0, 4)):
            read[rng.randrange(len(read))] = rng.choice(["", "A", "C", "GT"])
        pairs.append((("".join(read) + text(rng, 30))[:26], window))
    got = aligned([a.encode() for a, _ in pairs], [b.encode() for _, b in pairs], shape)
    for (a, b), found in zip(pairs, got, strict=True):
        assert found[0] == plain_score(a, b, shape) == score_of(a, b, found, shape)


def planted(rng, contigs, n, size=80):
    rows = []
    for i in range(n):
        chrom = rng.choice(list(contigs))
        at = rng.randrange(len(contigs[chrom]) - size)
        seq, cigar = contigs[chrom][at : at + size], f"{size}M"
        if i % 4 == 1:
            seq = seq[:30] + "ACGT"["CGTA".index(seq[30])] + seq[31:]
        if i % 4 == 2:
            seq, cigar = seq[:40] + seq[43:], f"40M3D{size - 43}M"
        if i % 4 == 3:
            seq, cigar = seq[:40] + text(rng, 2) + seq[40:], f"40M2I{size - 40}M"
        flag = rng.choice([0, 16])
        rows.append((i, f"@q{i}:x 1:N", turned(seq) if flag else seq, chrom, at, flag, cigar, seq))
    return rows


def test_planted_reads_are_found(spark, monkeypatch):
    monkeypatch.setattr(align, "PIECE", 3000)
    rng = random.Random(3)
    contigs = {"c1": text(rng, 20_000), "c2": text(rng, 9_001).lower(), "tiny": text(rng, 90)}
    upper = {k: v.upper() for k, v in contigs.items()}
    rows = planted(rng, {"c1": upper["c1"], "c2": upper["c2"]}, 400)
    extra = [(900, "@none", text(rng, 80)), (901, "@null", None), (902, "@empty", ""), (903, "@edge", upper["c1"][:60]), (904, "@last", turned(upper["c1"][-60:])), (905, "@long", text(rng, 2000)), (906, "@tiny", upper["tiny"])]
    reads = spark.createDataFrame([(r[1], r[2]) for r in rows] + [r[1:] for r in extra] + [rows[0][1:3]] * 5, "name string, seq string").withColumn("qual", F.when(F.col("seq").isNotNull(), F.concat(F.lit("!"), F.repeat(F.lit("I"), F.length("seq") - 1))))
    got = align_reads(reads, spark.createDataFrame(list(contigs.items()), "chrom string, seq string")).collect()
    assert len(got) == 412
    by = {r.qname: r for r in got}
    for i, _, _, chrom, at, flag, cigar, seq in rows:
        r = by[f"q{i}:x"]
        assert (r.rname, r.flag, r.seq) == (chrom, flag, seq) and r.mapq == 60
        assert abs(r.pos - 1 - at) <= 3 and r.qual == ("I" * (len(seq) - 1) + "!" if flag else "!" + "I" * (len(seq) - 1))
        wrong = int(r.tags[0].split(":")[2])
        assert wrong <= (0, 1, 3, 2)[i % 4]
        if i % 4 < 2:
            assert (r.pos - 1, r.cigar) == (at, cigar)
    assert {by[n].flag for n in ("none", "null", "empty", "long")} == {4}
    assert (by["edge"].pos, by["edge"].flag, by["last"].pos, by["last"].flag) == (1, 0, 20_000 - 59, 16)
    assert (by["tiny"].rname, by["tiny"].pos, by["tiny"].cigar) == ("tiny", 1, "90M")
    assert sum(r.qname == "q0:x" for r in got) == 6


def test_seeds_are_dealt_by_bases(spark, monkeypatch):
    """One small file of many contigs is not one task's, and what its seeds are counted in grows with it."""
    monkeypatch.setattr(align, "TASK_BASES", 2_000)
    rng = random.Random(5)
    contigs = spark.createDataFrame([(f"c{i}", "".join(rng.choices("ACGT", k=500))) for i in range(40)], "chrom string, seq string").coalesce(1)
    first = contigs.first()
    reads = spark.createDataFrame([("@a", first.seq[100:160], "I" * 60)], "name string, seq string, qual string")
    found = align_reads(reads, contigs)
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        found.explain()
    assert [(r.rname, r.pos, r.cigar) for r in found.collect()] == [(first.chrom, 101, "60M")]
    assert re.search(r"hashpartitioning\(chrom#\d+, piece#\d+, 11\)", said.getvalue())
    assert re.search(r"hashpartitioning\(seed#\d+L, 11\)", said.getvalue())
    assert not re.search(r"BroadcastHashJoin \[(seed|chrom)#", said.getvalue())


def test_repeats_have_low_quality_and_the_first_place(spark):
    rng = random.Random(4)
    unit = text(rng, 100)
    contigs = spark.createDataFrame([("b", text(rng, 50) + unit + text(rng, 70)), ("a", text(rng, 200) + unit), ("c", turned(unit))], "chrom string, seq string")
    reads = spark.createDataFrame([("@x", unit, "I" * 100)], "name string, seq string, qual string")
    row = align_reads(reads, contigs).first()
    assert (row.rname, row.pos, row.flag, row.mapq) == ("a", 201, 0, 0)
    assert align_reads(reads, contigs, shape=Shape(most_places=2)).first().flag == 4
    assert align_reads(reads.limit(0), contigs).count() == 0 and align_reads(reads, contigs.limit(0)).first().flag == 4


def test_command_aligns_to_bam(spark, tmp_path):
    rng = random.Random(5)
    contigs = {"c1": text(rng, 3000), "c2": text(rng, 2000)}
    (tmp_path / "ref.fa").write_text("".join(f">{n} of the test\n" + "\n".join(s[i : i + 60] for i in range(0, len(s), 60)) + "\n" for n, s in contigs.items()))
    rows = planted(rng, contigs, 60)
    (tmp_path / "r.fastq").write_text("".join(f"{r[1]}\n{r[2]}\n+\n{'I' * len(r[2])}\n" for r in rows))
    main(["align", "-f", str(tmp_path / "r.fastq"), "-x", str(tmp_path / "ref.fa"), "-o", str(tmp_path / "out.bam")], spark)
    bam = read_bam(spark, str(tmp_path / "out.bam"))
    assert {(r.qname, r.rname, r.flag) for r in bam.collect()} == {(f"q{r[0]}:x", r[3], r[5]) for r in rows}
    assert sam_to_bed(read_bam(spark, str(tmp_path / "out.bam"), region="c2:1-2000")).count() == sum(r[3] == "c2" for r in rows)
    with pytest.raises(ValueError, match="would be overwritten"):
        main(["align", "-f", str(tmp_path / "r.fastq"), "-x", str(tmp_path / "ref.fa"), "-o", str(tmp_path / "ref.fa")], spark)
