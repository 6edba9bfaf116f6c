import gzip
import struct

from pyspark.sql import functions as F

from readloom.functions.sequence import revcomp
from readloom.operators.merge import merge_mates
from readloom.plans.run import main
from readloom.sources.bam import read_bam, read_bam_header, with_lines
from readloom.sources.bam_records import BASES, OPERATIONS
from readloom.sources.readers import read_sam, sam_to_bed

LINES = [
    "r1:AAC\t0\tchr2\t101\t20\t5M2I3M\t*\t0\t0\tACGTNACGTA\tIIIIIIIIII\tNM:i:300\tXA:A:q\tMD:Z:ten\tXF:f:0.5\tXB:B:s,1,-2",
    "r2\t16\tchr1\t51\t30\t3M10N2M\tchr2\t7\t-9\tACGTA\t*",
    "r3\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*",
]


def packed(line, names):
    f = line.split("\t")
    runs, n = [], ""
    for c in f[5].replace("*", ""):
        if c.isdigit():
            n += c
        else:
            runs.append(int(n) << 4 | OPERATIONS.index(c))
            n = ""
    seq = "" if f[9] == "*" else f[9]
    codes = [BASES.index(c) for c in seq] + [0] * (len(seq) % 2)
    ref = lambda x: names.index(x) if x in names else -1
    out = struct.pack("<iiBBHHHiiii", ref(f[2]), int(f[3]) - 1, len(f[0]) + 1, int(f[4]), 0, len(runs), int(f[1]), len(seq), ref(f[6]), int(f[7]) - 1, int(f[8]))
    out += f[0].encode() + b"\0" + struct.pack(f"<{len(runs)}I", *runs) + bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True))
    out += b"\xff" * len(seq) if f[10] == "*" else bytes(ord(c) - 33 for c in f[10])
    for tag in f[11:]:
        name, kind, value = tag.split(":", 2)
        out += name.encode()
        if kind == "i":
            out += b"S" + struct.pack("<H", int(value))
        elif kind == "A":
            out += b"A" + value.encode()
        elif kind == "Z":
            out += b"Z" + value.encode() + b"\0"
        elif kind == "f":
            out += b"f" + struct.pack("<f", float(value))
        else:
            numbers = list(map(int, value.split(",")[1:]))
            out += b"Bs" + struct.pack(f"<i{len(numbers)}h", len(numbers), *numbers)
    return struct.pack("<i", len(out)) + out


def test_bam_is_its_sam(spark, tmp_path):
    names = ["chr2", "chr1"]
    raw = b"BAM\1" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", 2)
    for n in names:
        raw += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 900)
    raw += b"".join(packed(x, names) for x in LINES * 3000)
    (tmp_path / "a.bam").write_bytes(b"".join(gzip.compress(raw[i : i + 60_000]) for i in range(0, len(raw), 60_000)) + gzip.compress(b""))
    (tmp_path / "a.sam").write_text("\n".join(LINES * 3000) + "\n")
    bam, sam = read_bam(spark, str(tmp_path / "a.bam")).drop("file"), read_sam(spark, str(tmp_path / "a.sam")).drop("line", "file")
    assert bam.columns == sam.columns and bam.count() == 9000
    assert bam.distinct().exceptAll(sam.distinct()).count() == 0
    assert sam_to_bed(bam).distinct().count() == 2
    assert [r.line for r in read_bam_header(spark, str(tmp_path / "a.bam")).collect()] == ["@HD"]
    assert {r.line for r in with_lines(bam).select("line").distinct().collect()} == set(LINES)
    main(["dedup-sam", "-i", str(tmp_path / "a.bam"), "-o", str(tmp_path / "kept"), "--keep-last"], spark)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "kept")).collect()) == sorted(["@HD", *LINES[:2]])


def test_mates_merge_at_their_overlap(spark):
    whole = "ACGTTGCAAGCTTACGGATCCATGCATTACGGCATCGATTACAGG"
    rows = [(1, whole[:30], whole[15:]), (2, whole[:20], whole[25:]), (3, whole, whole), (4, whole[:30], whole[20:])]
    pairs = spark.createDataFrame(rows, "rec_idx long, seq_f string, s string")
    pairs = pairs.select("rec_idx", F.lit("@n").alias("name_f"), "seq_f", F.repeat(F.lit("I"), F.length("seq_f")).alias("qual_f"), F.lit("@n").alias("name_r"), revcomp(F.col("s")).alias("seq_r"), F.repeat(F.lit("5"), F.length("s")).alias("qual_r"))
    merged, rest = merge_mates(pairs, min_overlap=12, min_insert=30)
    got = {r.rec_idx: (r.seq, r.qual) for r in merged.collect()}
    assert got == {1: (whole, "I" * 30 + "5" * 15), 3: (whole, "I" * 45)}
    assert sorted(r.rec_idx for r in rest.collect()) == [2, 4]
    assert merge_mates(pairs, min_overlap=10)[0].count() == 3
    assert merge_mates(pairs, min_overlap=12, min_insert=46)[0].count() == 0
