"""Operator 13: how far the sources of a language lie from each other, in terms.

Terms become numbers, dealt to blocks, and each group of a language and a source
an array of (number, count) for each block, sorted by number. For every unordered
pair of a language's groups and each block, a task co-groups the two arrays. A
galloping intersection prices the terms that both have; those that one has, and
those that none has, are priced by what the other group gives a term without
occurrences. Each term is priced both ways.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.arrow import as_bytes
from readloom.llm.scratch import Scratch

#: A run of letters; in UTF-8 every byte of a sign beyond ASCII counts as one.
TERM, BETWEEN = re.compile(rb"[A-Za-z\x80-\xff]+"), re.compile(rb"[^A-Za-z\x80-\xff]")
#: Probabilities are in parts of so many.
UNIT = 1_000_000_000
#: Terms of a block, on average; distinct terms a task sums before it hands them on; bytes of a text that are taken at once.
BLOCK_TERMS, HELD, SLICE = 32_768, 400_000, 1 << 20
#: Terms that are looked up together by one gallop.
STRIDE = 64

COUNTED = "lang string, source string, term string, n long, holders long"


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of terms and documents that have them, summed by group over what a task reads, HELD terms at a time."""
    held: dict[tuple, dict[bytes, list[int]]] = defaultdict(dict)
    size = 0

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            counts, n = np.asarray(list(terms.values()), np.int64).reshape(-1, 2), len(terms)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(list(terms), pa.binary()).cast(pa.string()), pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["lang", "source", "term", "n", "holders"])

    for batch in batches:
        for text, lang, source in zip(as_bytes(batch["text"]), batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True):
            own, terms = occurrences(text), held[lang, source]
            size -= len(terms)
            for term, n in own.items():
                both = terms.get(term)
                if both:
                    both[0] += n
                    both[1] += 1
                else:
                    terms[term] = [n, 1]
            size += len(terms)
            if size >= HELD:
                yield from told()
                held.clear()
                size = 0
    yield from told()


def occurrences(text: bytes) -> Counter:
    """How often a text has each term; a long text is taken in slices that end behind a term."""
    own: Counter = Counter()
    at = 0
    while at < len(text):
        last = BETWEEN.search(text, at + SLICE)
        end = last.end() if last else len(text)
        own.update(TERM.findall(text[at:end].lower()))
        at = end
    return own


def chances(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / total), three digits at a time, so that no product overflows."""
    rest = counts.astype(np.int64) + 1
    out = rest // total
    rest = rest % total
    for _ in range(3):
        rest *= 1000
        out = 1000 * out + rest // total
        rest %= total
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def gallop(few: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of what two sorted arrays of distinct numbers share: in ``few``, in ``many``.

    The search for a stride's last number doubles its step from where the stride
    before it ended; the stride is then looked up below that place.
    """
    places, low = np.empty(len(few), np.int64), 0
    for at in range(0, len(few), STRIDE):
        own, step = few[at : at + STRIDE], STRIDE
        while low + step < len(many) and many[low + step] < own[-1]:
            step *= 2
        places[at : at + STRIDE] = low + np.searchsorted(many[low : low + step + 1], own)
        low = int(places[min(at + STRIDE, len(few)) - 1])
    there = places < len(many)
    there[there] = many[places[there]] == few[there]
    return np.flatnonzero(there), places[there]


def both_ways(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], total_a: int, total_b: int) -> tuple[int, int, int]:
    """Prices of one block: the first group's against the second's, the other way, and how many terms either has."""
    turned = len(a[0]) > len(b[0])
    few, many = (b, a) if turned else (a, b)
    x, y = gallop(few[0], many[0])
    in_a, in_b = (y, x) if turned else (x, y)
    p, q = chances(a[1], total_a), chances(b[1], total_b)
    none_a, none_b = chances(np.zeros(1, np.int64), total_a), chances(np.zeros(1, np.int64), total_b)
    only_a, only_b = np.delete(p, in_a), np.delete(q, in_b)
    there = sum(int(price(*s).sum()) for s in ((p[in_a], q[in_b]), (only_a, none_b), (none_a, only_b)))
    back = sum(int(price(*s).sum()) for s in ((q[in_b], p[in_a]), (none_b, only_a), (only_b, none_a)))
    return there, back, len(p) + len(q) - len(in_a)


PRICED = "lang string, a string, b string, there long, back long, held long"


def priced(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block of one pair; a side without terms there has no row."""

    def arrays(side: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        if not side.num_rows:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return side["numbers"][0].values.to_numpy(), side["counts"][0].values.to_numpy()

    right = right.rename_columns(left.column_names)
    row = (left if left.num_rows else right).select(["lang", "a", "b", "total_a", "total_b"]).slice(0, 1).to_pylist()[0]
    there, back, held = both_ways(arrays(left), arrays(right), row["total_a"], row["total_b"])
    return pa.Table.from_pylist([{"lang": row["lang"], "a": row["a"], "b": row["b"], "there": there, "back": back, "held": held}], schema=pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("there", pa.int64()), ("back", pa.int64()), ("held", pa.int64())]))


def chance(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / total), exact."""
    return 1 + divided(F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), total.cast("decimal(20,0)"))


def divided(a: Column, b: Column) -> Column:
    """Whole part of a quotient of numbers that are not negative."""
    return F.call_function("div", a, b)


def source_divergence(docs: DataFrame, *, least_holders: int = 3, most_terms: int = 200, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, part, item, value and rank: what sets each source of a language apart.

    A null language, source or text is an empty one. A language keeps the terms
    (runs of ASCII letters, in lower case, and of signs beyond ASCII) that
    ``least_holders`` of its documents have. Chances of terms, prices and ranks
    are those of the contract in whole numbers: part ``pair`` has the price of
    every other source of the language, ``term`` the ``most_terms`` dearest terms
    that a group uses more than its language does. Ranks count from 1, equal
    prices go by the item's UTF-8. Groups without text or terms are priced too; a
    repeated row counts again; other columns are not read; an empty table gives
    an empty result.

    Counts are summed in tasks and meet by language and term. Arrays of a group
    are cut at blocks of about BLOCK_TERMS terms, so a pair's task holds two short
    arrays however many terms a source has; each array goes to all other sources
    of its language, as many as the result has rows for.
    """
    scratch = Scratch(docs.sparkSession)
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias
    narrow = docs.select(clean(text_col)("text"), clean(lang_col)("lang"), clean(source_col)("source"))
    counts = narrow.mapInArrow(counted, COUNTED).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("holders").alias("holders"))
    one = Window.partitionBy("lang", "term")
    met = counts.withColumns({"lang_n": F.sum("n").over(one), "lang_holders": F.sum("holders").over(one), "leads": F.row_number().over(one.orderBy("source")) == 1})
    terms = scratch.keep(met.filter(F.col("lang_holders") >= least_holders).drop("holders", "lang_holders"))

    own = terms.groupBy("lang", "source").agg(F.sum("n").alias("own_n"), F.count_if("leads").alias("led"))
    whole = own.groupBy("lang").agg(F.sum("own_n").alias("lang_n"), F.sum("led").alias("v"))
    number = lambda c: F.coalesce(c, F.lit(0))
    groups = narrow.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(whole, "lang", "left")
    sized = scratch.keep(groups.select("lang", "source", number("v").alias("v"), (number("own_n") + number("v")).alias("total"), (number("lang_n") + number("v")).alias("lang_total")))

    apart = divided((F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    shares = terms.join(sized, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), chance(F.col("n"), F.col("total")).alias("p"), chance(F.col("lang_n"), F.col("lang_total")).alias("q"))
    dear = ranked(shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", apart.alias("value"))).filter(F.col("rank") <= most_terms)
    return dear.unionByName(ranked(pair_prices(terms, sized, scratch)))


def ranked(priced_items: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return priced_items.withColumn("rank", F.row_number().over(order))


def pair_prices(terms: DataFrame, sized: DataFrame, scratch: Scratch) -> DataFrame:
    """lang, source, part, item and value of both directions of all pairs of a language's sources."""
    most = sized.agg(F.max("v")).first()[0] or 0
    block = F.pmod(F.xxhash64("lang", "term"), F.lit(max(1, -(-most // BLOCK_TERMS)))).cast("int")
    numbered = terms.select("lang", "source", "n", block.alias("block"), F.dense_rank().over(Window.partitionBy("lang", block).orderBy("term")).alias("number"))
    entries = numbered.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("number", "n"))).alias("e"))
    arrays = scratch.keep(entries.select("lang", "source", "block", F.col("e.number").alias("numbers"), F.col("e.n").alias("counts")))

    first = sized.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "v")
    second = sized.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = scratch.keep(first.join(second, "lang").filter("a < b"))
    sides = [pairs.join(arrays.withColumnRenamed("source", side), ["lang", side]).select("lang", "a", "b", "block", "total_a", "total_b", "numbers", "counts") for side in ("a", "b")]
    keys = ("lang", "a", "b", "block")
    other = sides[1].toDF(*(f"{c}_there" for c in sides[1].columns))
    sums = sides[0].groupBy(*keys).cogroup(other.groupBy(*(f"{c}_there" for c in keys))).applyInArrow(priced, PRICED).groupBy("lang", "a", "b").agg(*(F.sum(c).alias(c) for c in ("there", "back", "held")))

    none = lambda total: chance(F.lit(0), total)
    zero = F.lit(0)
    said = pairs.join(sums, ["lang", "a", "b"], "left").filter("v > 0").withColumns({"p": none(F.col("total_a")), "q": none(F.col("total_b")), "absent": F.col("v") - F.coalesce("held", zero)})
    apart = lambda p, q: divided((F.col(p) - F.col(q)) * (F.col(p) - F.col(q)), F.col(q)) * F.col("absent")
    both = said.select("lang", "a", "b", (F.coalesce("there", zero) + apart("p", "q")).alias("there"), (F.coalesce("back", zero) + apart("q", "p")).alias("back"))
    both = both.unionByName(pairs.filter("v = 0").select("lang", "a", "b", zero.cast("long").alias("there"), zero.cast("long").alias("back")))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("there").alias("value")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("back").alias("value"))))
    return both.select("lang", ways.alias("way")).select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "way.value")
