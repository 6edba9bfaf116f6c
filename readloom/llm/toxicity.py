"""Operator 4: toxicity by class-conditional Kneser-Ney models of the letters of words.

Words of labelled training texts give letter n-grams for each class; both classes
back off to one Kneser-Ney model of the counts of both. A word's ratio of
likelihoods needs one table of n-grams and one of contexts, because the shared
backoff cancels where an n-gram is new. Toxic texts consist of ordinary words for
the most part, so their model is a mixture of both classes' words. A text's value
is its log-likelihood under that mixture less that under the ordinary class,
divided by its number of words, and is calibrated on rows kept apart.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.arrow import by_bytes, rows
from readloom.llm.contamination import FOLD
from readloom.llm.jaccard_join import FEW
from readloom.llm.scratch import Scratch
from readloom.llm.shingles import PLACES, mix
from readloom.llm.tokens import arrow_type

#: Words whose ratio one Python worker remembers; beyond it only the first half stays, which has the common ones.
REMEMBERED = 300_000
#: Greatest logarithm of a word's ratio, so that its exponent is a finite number.
LARGEST = 30.0
#: Slope and intercept if the rows kept apart don't have both labels.
UNLEARNT = (20.0, -2.0)


class Shape(NamedTuple):
    """Parameters: length of n-grams, discounts of the shared model and of the classes, share of toxic words in a toxic text, labelled rows and bytes learnt from at most, about."""

    letters: int = 6
    discount: float = 0.75
    class_discount: float = 1.0
    share: float = 0.01
    labelled_rows: int = 8000
    labelled_bytes: int = 128 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(FOLD).split()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n0, n1: in how many texts of each class a word occurs. ``docs``: label, text."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_bytes(rows(batches), 1 << 22):
            counts = Counter(), Counter()
            for label, text in run:
                counts[label].update(set(words_of(text)))
            every = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in every], pa.string()), *(pa.array([c[w] for w in every], pa.int64()) for c in counts)], names=["word", "n0", "n1"])

    return docs.select("label", "text").mapInArrow(counted, "word string, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit(words: DataFrame, scratch: Scratch, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """(n-gram, ratio) and (context, ratio): logarithms of toxic over ordinary probability."""
    d, own_d, most = shape.discount, shape.class_discount, shape.letters
    spelt = scratch.keep(words.select(F.concat(F.lit(" "), "word", F.lit(" ")).alias("s"), "n0", "n1"))
    placed = spelt.withColumn("i", F.explode(F.sequence(F.lit(2), F.length("s"))))
    start = F.greatest(F.lit(1), F.col("i") - (most - 1))
    grams = scratch.keep(placed.select(F.substring("s", start, F.col("i") - start + 1).alias("g"), "n0", "n1").groupBy("g").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    context = F.expr("substring(g, 1, length(g) - 1)")
    taken = [F.sum(F.least(F.col(f"n{c}"), F.lit(own_d))).alias(f"l{c}") for c in (0, 1)]
    sums = [F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), *taken, F.count("*").alias("k")]
    contexts = scratch.keep(grams.groupBy(context.alias("h")).agg(*sums))

    # Continuation counts of both classes together: n-grams of one length more that end with an n-gram, and words that start with it.
    low: dict[int, DataFrame] = {}
    longer = grams.filter(F.length("g") == most).select("g")
    for m in range(most - 1, 0, -1):
        ended = longer.select(F.expr("substring(g, 2)").alias("g")).union(grams.filter(F.length("g") == m).select("g"))
        low[m] = scratch.keep(ended.groupBy("g").agg(F.count("*").alias("n")))
        longer = low[m].select("g")
    letters = max(1, low[1].count())
    shared = None
    for m, own in sorted(low.items()):
        totals = own.groupBy(context.alias("h")).agg(F.sum("n").alias("t"), F.count("*").alias("k"))
        joined = own.withColumn("h", context).join(totals, "h")
        below = F.lit(1.0 / (letters + 1))
        if shared is not None:
            joined = joined.withColumn("rest", F.expr("substring(g, 2)")).join(shared.select(F.col("g").alias("rest"), F.col("p").alias("q")), "rest")
            below = F.col("q")
        here = scratch.keep(joined.select("g", (F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("t") + d * F.col("k") / F.col("t") * below).alias("p")))
        shared = here
        every = here if m == 1 else every.union(here)
    backed = grams.withColumn("h", context).withColumn("rest", F.expr("substring(g, 2)")).join(contexts, "h").join(every.select(F.col("g").alias("rest"), "p"), "rest")
    n, t = F.col("n0") + F.col("n1"), F.col("t0") + F.col("t1")
    pooled = F.greatest(n - d, F.lit(0.0)) / t + d * F.col("k") / t * F.col("p")

    def left_over(c: int) -> Column:
        return F.when(F.col(f"t{c}") > 0, F.col(f"l{c}") / F.col(f"t{c}")).otherwise(1.0)

    def likelihood(c: int) -> Column:
        own = F.greatest(F.col(f"n{c}") - own_d, F.lit(0.0)) / F.col(f"t{c}")
        return F.when(F.col(f"t{c}") > 0, own).otherwise(0.0) + left_over(c) * pooled

    return backed.select("g", F.log(likelihood(1) / likelihood(0)).alias("ratio")), contexts.select("h", F.log(left_over(1) / left_over(0)).alias("ratio"))


def ends(texts: list[str], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each letter of spelt words but the first: hash of the n-gram that ends there, of its context, and the word."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.asarray([len(t) for t in texts], np.int64)
    word = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    total = np.zeros(len(codes), np.uint64)
    context = np.zeros(len(codes), np.uint64)
    for back in range(most):
        there = np.flatnonzero(place >= back)
        term = (codes[there - back] + np.uint64(1)) * PLACES[back]
        total[there] += term
        if back:
            context[there] += term
    inner = place > 0
    return mix(total[inner]), mix(context[inner]), word[inner]


class Ratios:
    """What each word adds to a text's value, from the two tables; new words are looked up a whole batch at once."""

    def __init__(self, grams: tuple[list[str], np.ndarray], contexts: tuple[list[str], np.ndarray], shape: Shape):
        self.most, self.share, self.known = shape.letters, shape.share, {}
        # A context is looked up with a letter after it, which its hash leaves out.
        self.tables = []
        for which, (texts, values) in enumerate((grams, ([c + " " for c in contexts[0]], contexts[1]))):
            keys = self.last(texts, which)
            order = np.argsort(keys)
            self.tables.append((keys[order], np.asarray(values, np.float64)[order]))

    def last(self, texts: list[str], which: int) -> np.ndarray:
        if not texts:
            return np.zeros(0, np.uint64)
        hashes = ends(texts, self.most)
        return hashes[which][np.cumsum([len(t) - 1 for t in texts]) - 1]

    def learn(self, words: list[bytes]) -> None:
        gram, context, word = ends([f" {w.decode('utf-8', 'replace')} " for w in words], self.most)
        value = np.zeros(len(gram))
        open_ = np.ones(len(gram), bool)
        for (keys, values), asked in zip(self.tables, (gram, context), strict=True):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                hit = open_ & (keys[at] == asked)
                value[hit] = values[at[hit]]
                open_ &= ~hit
        ratios = np.clip(np.bincount(word, weights=value, minlength=len(words)), -LARGEST, LARGEST)
        self.known.update(zip(words, np.log1p(self.share * np.expm1(ratios)).tolist(), strict=True))

    def __call__(self, texts: list[bytes]) -> list[float]:
        """Log-likelihood ratio of each text for each of its words; 0 without words."""
        split = [words_of(t) for t in texts]
        new = list(set().union(*split).difference(self.known))
        if new:
            self.learn(new)
        out = []
        for words in split:
            out.append(sum(map(self.known.__getitem__, words)) / len(words) if words else 0.0)
        if len(self.known) > REMEMBERED:
            self.known = dict(islice(self.known.items(), REMEMBERED // 2))
        return out


def calibrated(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps with a small ridge on scaled values; UNLEARNT without both labels."""
    if len(set(labels.tolist())) < 2:
        return UNLEARNT
    scale = values.std() or 1.0
    x = np.stack([values / scale, np.ones_like(values)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (labels - p) - 1e-3 * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def within(rows: DataFrame, most: int) -> DataFrame:
    """Rows whose texts have about ``most`` bytes, chosen by a hash of the id; all if they have no more."""
    there = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if there <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64("id", F.lit("bytes")), F.lit(1 << 20)) < int(most / there * (1 << 20)))


def score_toxicity(docs: DataFrame, labels: DataFrame, held: Column, *, shape: Shape = Shape(), least: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``id_col``, held_out, score (0 to 1) and predicted (1 if score >= ``least``) of every row.

    ``labels``: ``id_col`` and ``label_col`` (1: toxic, 0: not; null is no
    label). Rows where ``held`` is true are never learnt from; a null counts as
    false. About ``shape.labelled_rows`` labelled rows, and of these about
    ``shape.labelled_bytes`` of text, are learnt from at most,
    chosen by a hash of the id; a fifth of them is kept apart for calibration.
    Only texts are inputs of a score: a null or empty one gets the score of a
    text whose words tell nothing. Without labels of both classes every score is 0.
    Repeated rows give repeated results, an id labelled twice is toxic if one
    label is; null ids stay null and have no label; empty tables are fine.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held, F.lit(False)).alias("held"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    share = min(1.0, shape.labelled_rows / max(1, known.count()))
    hashed = F.pmod(F.xxhash64("id", F.lit("labelled")), F.lit(1 << 20))
    chosen = scratch.keep(known.filter(hashed < int(share * (1 << 20))))
    few = F.broadcast(chosen) if chosen.count() <= FEW else chosen
    learnt = within(scratch.keep(narrow.filter(~F.col("held")).join(few, "id").select("id", "label", "text", (F.pmod(F.xxhash64("id", F.lit("apart")), F.lit(5)) == 0).alias("apart"))), shape.labelled_bytes)

    grams, contexts = fit(word_counts(learnt.filter(~F.col("apart"))), scratch, shape)
    tables = [(t.iloc[:, 0].tolist(), t["ratio"].to_numpy(np.float64)) for t in (grams.toPandas(), contexts.toPandas())]
    model = spark.sparkContext.broadcast(tables)
    both = learnt.filter(~F.col("apart")).select("label").distinct().count() == 2

    def valued(kind: str, id_type: pa.DataType):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ratios = Ratios(*model.value, shape)
            for part in by_bytes(rows(batches), 1 << 20):
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in part], id_type), pa.array(ratios([t for _, t in part]), pa.float64())], names=["id", "value"])

        return lambda df: df.mapInArrow(run, f"id {kind}, value double")

    apart = valued("int", pa.int32())(learnt.filter("apart").select("label", "text")).toPandas()
    slope, middle = calibrated(apart["value"].to_numpy(np.float64), apart["id"].to_numpy(np.float64))
    id_type = narrow.schema["id"].dataType.simpleString()
    judged = narrow.withColumn("key", F.struct("id", "held"))
    key = judged.schema["key"].dataType
    out = valued(key.simpleString(), arrow_type(judged, "key"))(judged.select("key", "text"))
    curve = 1 / (1 + F.exp(-(slope * F.col("value") + middle))) if both else F.lit(0.0)
    scored = out.select(F.col("id.id").cast(id_type).alias(id_col), F.col("id.held").alias("held_out"), curve.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))
