"""Demultiplexing: reads to samples by nearest index, and to replicates by code."""

from __future__ import annotations

from itertools import combinations, product
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.sequence import hamming, joined, part, random_bases, revcomp_head, tagged_name, trim
from readloom.plans.layout import Layout

#: Signs an index is made of; any other is taken as a dot.
LETTERS = "ACGTN."
#: Rows of a table of pieces that are broadcast at most, and of a neighbourhood that is made on the driver and broadcast.
BROADCAST_ROWS, DRIVER_ROWS = 200_000, 50_000


def pieces(text: Column, parts: int) -> Column:
    """(part, piece) of a text that is cut into parts of about one length."""
    bound = lambda i: F.floor(F.lit(i) * F.length(text) / parts).cast("int")
    cut = lambda i: F.substring(text, bound(i) + 1, bound(i + 1) - bound(i))
    return F.array(*(F.struct(F.lit(i).alias("part"), cut(i).alias("piece")) for i in range(parts)))


def nearest_by_pieces(codes: DataFrame, samples: DataFrame, max_mismatch: int) -> DataFrame:
    """index_key, sample of every index that has a barcode within ``max_mismatch``: the only nearest one's sample, else null.

    Of ``max_mismatch`` + 1 pieces of an index, one at least is the same in any barcode
    within that distance. So indexes and barcodes meet by equal pieces and are then compared
    in whole; the work doesn't grow with what lies around a barcode.
    """
    parts = max_mismatch + 1
    cut = lambda df, text, kept: df.select(*kept, F.length(text).alias("size"), F.explode(pieces(F.col(text), parts)).alias("p")).select(*kept, "size", "p.part", "p.piece")
    sheet = cut(samples, "barcode", ("sample", "barcode"))
    sheet = F.broadcast(sheet) if samples.count() * parts <= BROADCAST_ROWS else sheet
    met = cut(codes.select("index_key").distinct(), "index_key", ("index_key",)).join(sheet, ["size", "part", "piece"]).select("index_key", "sample", "barcode").distinct()
    near = met.withColumn("d", hamming(F.col("barcode"), F.col("index_key"))).filter(F.col("d") <= max_mismatch)
    by_distance = near.groupBy("index_key", "d").agg(F.count("*").alias("n"), F.min("sample").alias("sample"))
    nearest = by_distance.groupBy("index_key").agg(F.min(F.struct("d", "n", "sample")).alias("best"))
    return nearest.select("index_key", F.when(F.col("best.n") == 1, F.col("best.sample")).alias("sample"))


def small_neighbourhood(samples: DataFrame, max_mismatch: int) -> DataFrame | None:
    """The same table as local rows, which saves its jobs, if the sample sheet is short enough for that."""
    sheet = samples.select("sample", "barcode").limit(DRIVER_ROWS + 1).collect()
    longest = max((len(r["barcode"]) for r in sheet), default=0)
    if len(sheet) * sum(comb(longest, d) * (len(LETTERS) - 1) ** d for d in range(max_mismatch + 1)) > DRIVER_ROWS:
        return None
    nearest: dict[str, tuple[int, str | None]] = {}
    for r in sheet:
        for d in range(max_mismatch + 1):
            for places in combinations(range(len(r["barcode"])), d):
                for letters in product(LETTERS, repeat=d):
                    key = list(r["barcode"])
                    for at, letter in zip(places, letters, strict=True):
                        key[at] = letter
                    if sum(a != b for a, b in zip(key, r["barcode"], strict=True)) == d:
                        text = "".join(key)
                        best = nearest.get(text, (d + 1, None))
                        if d <= best[0]:
                            nearest[text] = (d, r["sample"] if d < best[0] else None)
    return samples.sparkSession.createDataFrame([(k, s) for k, (_, s) in nearest.items()], "index_key string, sample string")


def check_samples(samples: DataFrame) -> None:
    """Barcodes must differ and have one length."""
    total, distinct, sizes = samples.agg(F.count("*"), F.countDistinct("barcode"), F.countDistinct(F.length("barcode"))).first()
    if total != distinct or sizes > 1:
        raise ValueError("sample barcodes must be unique and of one length")


def with_sample(reads: DataFrame, samples: DataFrame, max_mismatch: int) -> DataFrame:
    """Adds the sample whose barcode is the only nearest one to ``index_code`` within ``max_mismatch``, else null.

    An equi-join, so each read is probed once however many samples there are. The
    table has all indexes around the barcodes if these are few, and is broadcast;
    otherwise the reads' own distinct indexes, and Spark chooses by its size.
    """
    keyed = reads.withColumn("index_key", F.regexp_replace("index_code", "[^ACGTN]", "."))
    table = small_neighbourhood(samples, max_mismatch)
    table = nearest_by_pieces(keyed, samples, max_mismatch) if table is None else F.broadcast(table)
    return keyed.join(table, "index_key", "left").drop("index_key")


def replicate_of(code: Column | None, layout: Layout) -> tuple[Column, Column]:
    """(replicate, whether the code is of neither replicate)."""
    if code is None:
        return F.lit(None).cast("string"), F.lit(False)
    side = layout.coded[1]
    a, b = code.rlike(side.code_pattern("A")), code.rlike(side.code_pattern("B"))
    return F.when(a, "A").when(b, "B"), ~(a | b)


def classified(reads: DataFrame, samples: DataFrame, layout: Layout, max_mismatch: int, code: Column | None, short: Column) -> DataFrame:
    """Adds replicate, sample and outcome: assigned, alien (foreign code), bad_barcode or too_short."""
    replicate, alien = replicate_of(code, layout)
    marked = reads.withColumns({"replicate": replicate, "alien": alien, "too_short": short})
    found = with_sample(marked, samples, max_mismatch)
    outcome = F.when(F.col("too_short"), "too_short").when(F.col("alien"), "alien").when(F.col("sample").isNull(), "bad_barcode").otherwise("assigned")
    named = found.withColumn("outcome", outcome)
    return named.withColumn("sample", F.when(F.col("outcome") == "assigned", F.col("sample"))).drop("alien", "too_short")


def demux_pairs(pairs: DataFrame, samples: DataFrame, layout: Layout, max_mismatch: int = 1) -> DataFrame:
    """Read pairs (rec_idx, name_f, seq_f, qual_f, name_r, seq_r, qual_r) with sample, replicate, outcome and umi, trimmed and renamed.

    The random barcode is the left end's random bases of the forward read, the
    right end's of the reverse read, then the replicate code. One projection and
    one broadcast join; nothing is shuffled.
    """
    ends = {"left": F.col("seq_f"), "right": F.col("seq_r")}
    where, span = layout.indexed
    code = part(ends[layout.coded[0]], layout.coded[1].code) if layout.coded else None
    umi = joined([*random_bases(ends["left"], layout.left), *random_bases(ends["right"], layout.right), *([code] if code is not None else [])])
    short = (F.length("seq_f") < layout.left.size) | (F.length("seq_r") < layout.right.size)
    probed = pairs.withColumns({"index_code": part(ends[where], span), "umi": umi})
    l, r = layout.left.trimmed, layout.right.trimmed  # noqa: E741
    cut = {"seq_f": trim(F.col("seq_f"), l, r), "qual_f": trim(F.col("qual_f"), l, r), "seq_r": trim(F.col("seq_r"), r, l), "qual_r": trim(F.col("qual_r"), r, l)}
    names = {"name_f": tagged_name(F.col("name_f"), F.col("umi")), "name_r": tagged_name(F.col("name_r"), F.col("umi"))}
    return classified(probed, samples, layout, max_mismatch, code, short).withColumns(cut | names)


def demux_merged(reads: DataFrame, samples: DataFrame, layout: Layout, max_mismatch: int = 1, *, strict: bool = True) -> DataFrame:
    """As demux_pairs for merged reads (rec_idx, name, seq, qual); the right end is read on the reverse complement.

    With ``strict`` the barcode ends with the bases at the right code's place of
    the forward strand, though the replicate is told from the other strand;
    without, with the code itself.
    """
    seq = F.col("seq")
    ends = {"left": seq, "right": revcomp_head(seq, max(layout.right.size, 1))}
    where, span = layout.indexed
    code = told = None
    if layout.coded:
        name, side = layout.coded
        code = part(ends[name], side.code)
        told = part(seq, side.code) if strict else code
    umi = joined([*random_bases(ends["left"], layout.left), *random_bases(ends["right"], layout.right), *([told] if told is not None else [])])
    short = F.length("seq") < F.greatest(F.lit(layout.left.size), F.lit(layout.right.size))
    probed = reads.withColumns({"index_code": part(ends[where], span), "umi": umi})
    l, r = layout.left.trimmed, layout.right.trimmed  # noqa: E741
    cut = {"seq": trim(seq, l, r), "qual": trim(F.col("qual"), l, r), "name": tagged_name(F.col("name"), F.col("umi"))}
    return classified(probed, samples, layout, max_mismatch, code, short).withColumns(cut)


def outcome_counts(reads: DataFrame) -> DataFrame:
    """n_total, n_assigned, n_bad_barcode, n_alien, n_too_short."""
    kinds = ("assigned", "bad_barcode", "alien", "too_short")
    return reads.agg(F.count("*").alias("n_total"), *(F.count_if(F.col("outcome") == k).alias(f"n_{k}") for k in kinds))


def sample_counts(reads: DataFrame, samples: DataFrame, layout: Layout) -> DataFrame:
    """Assigned reads for each sample and replicate, none included."""
    counts = reads.filter("outcome = 'assigned'").groupBy("sample", "replicate").agg(F.count("*").alias("n_reads"))
    replicates = ["A", "B"] if layout.coded else [None]
    every = samples.select("sample", F.explode(F.array(*(F.lit(r).cast("string") for r in replicates))).alias("replicate"))
    c = counts.withColumnsRenamed({"sample": "s", "replicate": "r"})
    return every.join(c, (every["sample"] == c["s"]) & every["replicate"].eqNullSafe(c["r"]), "left").select("sample", "replicate", F.coalesce("n_reads", F.lit(0)).alias("n_reads"))


def bad_barcodes(reads: DataFrame) -> DataFrame:
    """index_code, n_reads of reads without a sample."""
    return reads.filter("outcome = 'bad_barcode'").groupBy("index_code").agg(F.count("*").alias("n_reads"))


def class_totals(merged: DataFrame, pairs: DataFrame) -> DataFrame:
    """Reads by outcome for merged reads, for pairs and for both."""
    both = merged.select(F.lit("merged").alias("read_class"), "outcome").union(pairs.select(F.lit("pair"), "outcome"))
    counts = both.rollup("outcome", "read_class").agg(F.count("*").alias("n_reads"))
    return counts.filter("outcome is not null").select("outcome", F.coalesce("read_class", F.lit("both")).alias("read_class"), "n_reads")
