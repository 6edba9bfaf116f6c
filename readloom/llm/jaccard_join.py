"""Operator 8: exact Jaccard self-join of word shingles, by R-trees of count vectors.

Equal sets become one class. The classes are dealt to a forest of R-trees by the
shingles of their prefix, of which two sets that link share several; a class that
shares fewer with all others together leaves. A class is a point of its trees: its shingles hashed into groups and counted. The sum of coordinate minima
bounds what two sets share, and every pair that is verified comes from a search of
a tree by that bound. First only one class of each block and size asks, the one
that shares most with all others; all it may link to in any of its blocks are one
tree. It has then met its blocks and leaves them, and blocks whose other classes
are thereby connected are settled. In the rest every class asks for those it isn't
connected with. Those pairs can be as many as the square of a group of texts that are
alike but hardly link, so they never leave their task: it first tells only which classes found
any, then it compares their whole sets and tells the links that connect them, fewer
than its classes. That, and not a cap, keeps groups of thousands of near copies from
growing with their square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from readloom.llm.arrow import as_bytes, by_bytes, rows
from readloom.llm.components import connected
from readloom.llm.rtree import CountTree, as_counts, folded, groups_for, packed_counts
from readloom.llm.scratch import Scratch
from readloom.llm.shingles import cut_by, shingle_sets

#: Rows in the sample that tells frequent shingles, which come last in the order of prefixes.
SAMPLE = 10_000
#: Frequent shingles that are told, and in how many sampled rows one occurs at least.
FREQUENT, FREQUENT_ROWS = 1 << 16, 2
#: One shingle in so many makes prefixes longer, so that linked sets share more than one shingle of them.
SPARE = 20
#: Classes of a block that one tree holds, about; larger blocks are dealt to several trees.
PART = 512
#: Ids, or hashes of blocks, that are broadcast at most; more are joined by a shuffle.
FEW = 1_000_000
#: Beyond FEW keys, those of more than HOT rows are broadcast, but never more than HOT_KEYS.
HOT, HOT_KEYS = 256, 100_000


def lowered(text: bytes) -> list[bytes]:
    return text.lower().split()


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted hashes of shingles in FREQUENT_ROWS or more of a bounded sample; only the order of prefixes depends on it."""
    rows_there = docs.count()
    if not rows_there:
        return np.zeros(0, np.uint64)
    keep = min(1.0, SAMPLE / rows_there)
    sample = docs.filter(F.pmod(F.xxhash64("id", F.lit("frequent")), F.lit(1 << 20)) < int(keep * (1 << 20)))

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_bytes(rows(batches), 1 << 20):
            flat, _ = shingle_sets([lowered(t) for _, t in run], width)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=["token"])

    counts = sample.mapInArrow(hashes, "token long").groupBy("token").count().filter(F.col("count") >= FREQUENT_ROWS)
    most = counts.orderBy(F.desc("count"), "token").limit(FREQUENT).toPandas()
    return np.sort(most["token"].to_numpy(np.int64).view(np.uint64))


def least_common(n):
    """How many prefix shingles two linked sets share, of which the smaller has n: prefixes of n - ceil(percent * n) + k hold k of them, in any fixed order."""
    return 1 + n // SPARE


def points_of(flat: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Packed counts by group of each set, the sets in a row."""
    groups = groups_for(sizes)
    bases = np.cumsum(groups) - groups
    counts = np.bincount(np.repeat(bases, sizes) + ((flat >> np.uint64(17)).astype(np.int64) & (np.repeat(groups, sizes) - 1)), minlength=int(groups.sum()))
    return list(map(packed_counts, cut_by(counts, groups)))


def features(docs: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """id, n, two hashes of the set, the rare and the frequent shingles of its prefix and its counts by group."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_bytes(rows(batches), 1 << 20):
            flat, sizes = shingle_sets([lowered(t) for _, t in run], width)
            text, starts = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
            first, second = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
            full = np.flatnonzero(sizes)
            if len(full):
                first[full] = np.bitwise_xor.reduceat(flat * np.uint64(0x9E3779B97F4A7C15), starts[full])
                second[full] = np.add.reduceat((flat ^ (flat >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93), starts[full])
            common = frequent[np.minimum(np.searchsorted(frequent, flat), len(frequent) - 1)] == flat if len(frequent) else np.zeros(len(flat), bool)
            before = np.cumsum(~common) - ~common  # rare ones so far
            rare_before = before - np.append(before, 0)[starts][text]
            rare = np.bincount(text[~common], minlength=len(sizes))
            place = np.where(common, rare[text] + (np.arange(len(flat)) - starts[text]) - rare_before, rare_before)
            length = np.where(sizes > 0, np.minimum(sizes, sizes + (percent * sizes) // -100 + least_common(sizes)), 0)
            taken = place < length[text]
            own = []
            for chosen in (taken & ~common, taken & common):
                ends = np.cumsum(np.bincount(text[chosen], minlength=len(sizes)))
                own.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat[chosen].view(np.int64))))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in run], pa.int64()), pa.array(sizes), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), *own, pa.array(points_of(flat, sizes), pa.binary())], names=["id", "n", "f1", "f2", "rare", "frequent", "counts"])

    return docs.mapInArrow(made, "id long, n long, f1 long, f2 long, rare array<long>, frequent array<long>, counts binary")


class Members(NamedTuple):
    """The rows of one tree; sides as in ``candidates``. ``sets`` only where whole sets are compared."""

    side: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray
    comps: np.ndarray
    points: list[np.ndarray]
    sets: list[np.ndarray]

    def answers(self, percent: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each row that asks the rows it finds: in the tree, within the bound and, by what ``comps`` says at that time, not connected with it."""
        groups = np.asarray([len(p) for p in self.points])
        trees: dict[tuple[int, int], tuple[np.ndarray, CountTree | None]] = {}

        def tree(own: int, use: int) -> tuple[np.ndarray, CountTree | None]:
            """The points with ``own`` groups, folded to ``use``."""
            if (own, use) not in trees:
                inside = np.flatnonzero((groups == own) & (self.side != 1))
                stacked = folded(np.stack([self.points[i] for i in inside]), use) if len(inside) else None
                trees[own, use] = inside, CountTree(stacked, self.sizes[inside], percent) if len(inside) else None
            return trees[own, use]

        for i in np.flatnonzero(self.side != 0):
            for own in {groups[i] // 2, groups[i], groups[i] * 2}:
                use = min(own, groups[i])
                inside, found_by = tree(own, use)
                if found_by is None:
                    continue
                found = inside[found_by.search(folded(self.points[i], use), self.sizes[i])]
                found = found[self.comps[found] != self.comps[i]]
                found = found[(self.side[found] == 0) | (self.ids[found] < self.ids[i])]
                if len(found):
                    yield i, found


def by_tree(members: DataFrame, told: Callable[[Members], Iterator[np.ndarray]], names: list[str]) -> DataFrame:
    """Distinct rows of the columns ``names`` that ``told`` makes of each tree. ``members``: block, part and more; the rows of a block and part are one tree and lie together."""

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            block, part = table["block"].to_numpy(), table["part"].to_numpy()
            columns = [table[c].to_numpy() for c in ("side", "id", "n", "component")]
            columns[3] = columns[3].copy()
            sets: list[np.ndarray] = []
            if "shingles" in table.column_names:
                sets = [np.frombuffer(s, np.uint64) for s in as_bytes(table["shingles"].combine_chunks())]
                points = list(map(as_counts, points_of(np.concatenate(sets), columns[2])))
            else:
                points = list(map(as_counts, as_bytes(table["counts"].combine_chunks())))
            cut = np.flatnonzero((np.diff(block) != 0) | (np.diff(part) != 0)) + 1
            found = []
            for s, e in zip([0, *cut], [*cut, len(block)], strict=True):
                found += told(Members(*(c[s:e] for c in (*columns, points, sets))))
            if found:
                own = np.unique(np.concatenate(found, 1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in own], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            last = (batch["block"][-1], batch["part"][-1])
            if (held[0]["block"][0], held[0]["part"][0]) == last:
                continue
            table = pa.concat_tables(held)
            block, part = table["block"].to_numpy(), table["part"].to_numpy()
            open_from = np.flatnonzero((block != block[-1]) | (part != part[-1]))[-1] + 1
            yield from done(table.slice(0, open_from))
            held = [table.slice(open_from)]
        if held:
            yield from done(pa.concat_tables(held))

    laid = members.repartition("block", "part").sortWithinPartitions("block", "part")
    return laid.mapInArrow(searched, ", ".join(f"{n} long" for n in names)).distinct()


def candidates(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of classes that a tree search finds: of one tree, not connected yet and within the bound.

    ``members``: block, part, side (0: in the tree, 1: only asks, 2: both), id, n, component, counts.
    """

    def pairs(tree: Members) -> Iterator[np.ndarray]:
        for i, found in tree.answers(percent):
            yield np.stack([np.minimum(tree.ids[i], tree.ids[found]), np.maximum(tree.ids[i], tree.ids[found])])

    return by_tree(members, pairs, ["a", "b"])


def with_candidates(members: DataFrame, percent: int) -> DataFrame:
    """The ids of ``candidates``' pairs, without the pairs."""

    def ids(tree: Members) -> Iterator[np.ndarray]:
        any_found = np.zeros(len(tree.ids), bool)
        for i, found in tree.answers(percent):
            any_found[i] = any_found[found] = True
        if any_found.any():
            yield np.unique(tree.ids[any_found])[None]

    return by_tree(members, ids, ["id"])


def connecting(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all that links of one tree connect: in each tree fewer than its classes. ``members`` has shingles in the place of counts."""

    def links(tree: Members) -> Iterator[np.ndarray]:
        for i, found in tree.answers(percent):
            for j in found:
                one, other = tree.comps[i], tree.comps[j]
                if one != other and link(tree.sets[i], tree.sets[j], percent):
                    tree.comps[tree.comps == other] = one
                    yield np.sort(tree.ids[[i, j]])[:, None]

    return by_tree(members, links, ["a", "b"])


def occurring_again(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """id, n, block: the prefix shingles that another class has, too.

    A rare shingle was in less than FREQUENT_ROWS of SAMPLE rows, so its rows meet in one
    task, in one shuffle at any size of the input. Those of frequent ones, FREQUENT
    at most, don't meet: they are counted before the shuffle and the counts are broadcast.
    """
    rare, frequent = (classes.select("id", "n", F.explode(k).alias("block")) for k in ("rare", "frequent"))
    sized = rare.withColumn("size", F.count("*").over(Window.partitionBy("block"))).filter("size > 1")
    counts = scratch.keep(frequent.groupBy("block").agg(F.count("*").alias("size")).filter("size > 1").select("block"))
    return sized.select("id", "n", "block").unionByName(frequent.join(F.broadcast(counts), "block").select("id", "n", "block"))


def with_keys(rows: DataFrame, keys: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with the written table ``keys`` (``by``, size and more); rows of one key meet in one task only if they are few.

    ``size`` is how many rows a key has. A long table is joined by a shuffle, but its largest keys are broadcast.
    """
    there, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if there <= FEW:
        return rows.join(F.broadcast(keys), by, how)
    limit = max(HOT, total // HOT_KEYS)  # so that no more than HOT_KEYS are larger
    hot = F.broadcast(keys.filter(F.col("size") > limit))
    cold = rows.join(hot.select(*by), by, "left_anti").join(keys.filter(F.col("size") <= limit), by, how)
    return rows.join(hot, by).unionByName(cold)  # with "left", a row of a hot key has been joined in the first part


def band_of(n: Column, percent: int) -> Column:
    """Sets that link lie in one band of sizes or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.lit(-np.log(percent / 100))).cast("int")


def with_pivots(banded: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of ``banded`` with ``near``, the classes that ask for them, and ``asks``, whether they are such a class.

    ``banded``: block, size, id, n, band, weight. In each block one class of each
    band asks for those of its own and the two neighbouring bands, in which all
    that may link to it are. A text that was copied with changes is nearer to the
    copies than they are to each other, so the class with the greatest weight asks.
    """
    first = banded.groupBy("block", "band").agg(F.max(F.struct("weight", "id", "n")).alias("pivot"), F.first("size").alias("size"))
    pivots = first.groupBy("block").agg(F.collect_list(F.struct("band", "pivot.id", "pivot.n")).alias("pivots"), F.first("size").alias("size"))
    rows = with_keys(banded.drop("size"), scratch.keep(pivots), ["block"])
    near = F.filter("pivots", lambda p: (F.abs(p["band"] - F.col("band")) <= 1) & (p["id"] != F.col("id")))
    asks = F.exists("pivots", lambda p: (p["id"] == F.col("id")) & (p["n"] == F.col("n")))
    return rows.select("block", "id", "n", "band", near.alias("near"), asks.alias("asks"))


def asked_by_pivots(found: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of trees: one tree for each asking class, of the classes near it in any of its blocks, and the class itself as the only one that asks.

    A large tree is dealt to several, all of which are asked.
    """
    met = scratch.keep(found.select("id", "n", F.explode("near").alias("pivot")).select(F.col("pivot.id").alias("block"), F.col("pivot.n").alias("asking"), "id", "n").distinct())
    trees = scratch.keep(met.groupBy("block", "asking").agg(F.count("*").alias("size")))
    parts = F.ceil(F.col("size") / PART).cast("long")
    dealt = with_keys(met, trees, ["block", "asking"])
    held = dealt.select("block", F.pmod(F.xxhash64("id"), parts).alias("part"), F.lit(0).alias("side"), "id", "n", F.col("id").alias("component"))
    asking = trees.select("block", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.lit(1).alias("side"), F.col("block").alias("id"), F.col("asking").alias("n"), F.col("block").alias("component"))
    return held.unionByName(asking)


def left_over(found: DataFrame, joined: DataFrame, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Classes with their components that did not ask, by block, and the blocks (block, size) in which some of them are still to be compared.

    A class that asked has met all of its block that may link to it. Blocks with the same classes left are one.
    """
    rows = found.filter(~F.col("asks")).join(joined, "id", "left").select("block", "id", "n", F.coalesce("component", "id").alias("component"))
    rows = scratch.keep(rows)
    sums = rows.groupBy("block").agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"), F.sum(F.xxhash64("id", "n").cast("decimal(38,0)")).alias("same"))
    mixed = sums.filter((F.col("low") < F.col("high")) & ((F.col("size") > 2) | (percent * F.col("most") <= 100 * F.col("least"))))
    return rows, scratch.keep(mixed.groupBy("size", "same").agg(F.min("block").alias("block")).select("block", "size"))


def asked_by_all(labelled: DataFrame, sizes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Members of the blocks ``sizes`` (block, size), each of which asks for classes of other components.

    A block of more than PART classes is dealt by band and, where a component
    has more than PART classes of a band, by component. Two parts meet as one tree and those that
    ask it, unless their bands lie apart or both have the same single component:
    a group of near copies meets the few classes that are not connected with it, not itself.
    """
    rows = with_keys(labelled, sizes, ["block"]).withColumn("band", band_of(F.col("n"), percent))
    small = rows.filter(F.col("size") <= PART).select("block", F.lit(0).cast("long").alias("part"), F.lit(2).alias("side"), "id", "n", "component")
    if not sizes.filter(F.col("size") > PART).limit(1).count():
        return small
    large = rows.filter(F.col("size") > PART)
    counts = large.groupBy("block", "band", "component").agg(F.count("*").alias("own"))
    pure = scratch.keep(counts.filter(F.col("own") > PART).select("block", "band", "component", F.col("component").cast("string").alias("group")))
    grouped = large.join(short_list(pure), ["block", "band", "component"], "left").fillna("", "group")
    key = ["block", "band", "group"]
    runs = scratch.keep(grouped.groupBy(*key).agg(F.ceil(F.count("*") / PART).cast("int").alias("cuts")))
    cut = runs.select(*key, F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    numbered = cut.withColumn("number", F.row_number().over(Window.partitionBy("block").orderBy("band", "group", "cut")))
    low, high = (numbered.select("block", F.struct("band", "group", "cut", "number").alias(k)) for k in ("low", "high"))
    near = F.abs(F.col("low.band") - F.col("high.band")) <= 1
    alone = (F.col("low.group") == F.col("high.group")) & (F.col("low.group") != "")
    met = low.join(high, "block").filter((F.col("low.number") <= F.col("high.number")) & near & ~alone)
    one = F.col("low.number") == F.col("high.number")
    side = lambda k, n: F.struct(F.col(f"{k}.band").alias("band"), F.col(f"{k}.group").alias("group"), F.col(f"{k}.cut").alias("cut"), n.alias("side"))
    first, second = side("low", F.when(one, 2).otherwise(0)), side("high", F.lit(1))
    sides = met.select("block", (F.col("low.number").cast("long") * (1 << 31) + F.col("high.number")).alias("part"), F.explode(F.when(one, F.array(first)).otherwise(F.array(first, second))).alias("s"))
    sides = sides.select("block", "part", "s.*")
    placed = grouped.join(short_list(runs), key).withColumn("cut", F.pmod(F.xxhash64("id"), "cuts").cast("int"))
    return small.unionByName(placed.join(sides, [*key, "cut"]).select("block", "part", "side", "id", "n", "component"))


def short_list(keys: DataFrame) -> DataFrame:
    """A written table, marked for broadcasting if it is short enough."""
    return F.broadcast(keys) if keys.count() <= FEW else keys


def link(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def whole_sets(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """id, n, shingles of the rows of ``docs`` that the written table ``ids`` has."""

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_bytes(rows(batches), 1 << 20):
            found = cut_by(*shingle_sets([lowered(t) for _, t in run], width))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in run], pa.int64()), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["id", "n", "shingles"])

    return docs.join(short_list(ids), "id", "left_semi").mapInArrow(sets, "id long, n long, shingles binary")


def verified(pairs: DataFrame, docs: DataFrame, scratch: Scratch, width: int, percent: int, once: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The pairs (a, b) whose whole sets link; ``once`` removes what repeated rows repeat."""
    ids = scratch.keep(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())

    def overlap(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs_of_sets = zip(as_bytes(batch["sa"]), as_bytes(batch["sb"]), strict=True)
            keep = [link(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in pairs_of_sets]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    there = scratch.keep(once(whole_sets(ids, docs, width)))
    sa, sb = (there.select(F.col("id").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab")
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInArrow(overlap, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles and component_id of every row: the smallest id that links reach.

    Words are split at ASCII white space, A-Z lower-cased; two rows link when
    100 * shared >= percent * all distinct shingles. Fewer words than ``width``
    are one shingle. A null or empty text has no shingle and links with nothing,
    its component is its own id. Repeated rows give repeated results and share
    a component; an id is one node even if its rows differ. A null id is no
    node: its component is that of its class, or null. An empty table gives an
    empty result; other columns are not read. ``id_col`` must be of an integer
    type (a TypeError otherwise). No link between different texts is lost: the
    order of prefixes comes from a sample, but any order gives the same links.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be of an integer type")
    scratch = Scratch(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    made = scratch.keep(features(narrow, width, percent, frequent_shingles(narrow, width)))
    sets = scratch.keep(made.select("id", "n", "f1", "f2"))
    key = ["f1", "f2", "n"]
    named = made.filter((F.col("n") > 0) & F.col("id").isNotNull())
    firsts = scratch.keep(sets.filter((F.col("n") > 0) & F.col("id").isNotNull()).groupBy(*key).agg(F.min("id").alias("first"), F.count("*").alias("size")))
    copied = scratch.keep(firsts.filter("size > 1"))
    copies = with_keys(sets, copied, key).filter("id <> first")
    classes = named.join(short_list(scratch.keep(copies.select("id", *key).distinct())), ["id", *key], "left_anti")
    once = (lambda df: df.distinct()) if sets.groupBy("id").count().filter("id is not null and count > 1").limit(1).count() else lambda df: df

    met_again = scratch.keep(occurring_again(classes, scratch))
    smallest = F.ceil(F.col("n") * percent / 100).cast("long")  # of the sets that may link
    able = met_again.groupBy("id", "n").agg(F.count("*").alias("met")).filter(F.col("met") >= 1 + F.floor(smallest / SPARE)).select("id", "n")
    members = scratch.keep(once(met_again.join(short_list(scratch.keep(able)), ["id", "n"], "left_semi")))
    # Blocks with the same classes are one.
    alike = members.groupBy("block").agg(F.count("*").alias("size"), F.sum(F.xxhash64("id", "n").cast("decimal(38,0)")).alias("same"))
    blocks = alike.groupBy("size", "same").agg(F.min("block").alias("block"), F.count("*").alias("alike")).filter("size > 1")
    blocks = scratch.keep(blocks.select("block", "size", (F.col("size") * F.col("alike")).alias("weight")))
    weighed = scratch.keep(with_keys(members, blocks, ["block"]))
    weights = weighed.groupBy("id").agg(F.sum("weight").alias("weight"))
    banded = scratch.keep(weighed.drop("weight").join(weights, "id").withColumn("band", band_of(F.col("n"), percent)))
    points = scratch.keep(once(classes.join(short_list(scratch.keep(weights.select("id"))), "id", "left_semi").select("id", "n", "counts")))

    found = scratch.keep(with_pivots(banded, scratch))
    met = scratch.keep(candidates(asked_by_pivots(found, scratch).join(points, ["id", "n"]), percent))
    links = scratch.keep(verified(met, narrow, scratch, width, percent, once))
    joined = connected(links, scratch)

    labelled, mixed = left_over(found, joined, percent, scratch)
    asked = scratch.keep(asked_by_all(labelled, mixed, percent, scratch))
    some = scratch.keep(with_candidates(asked.join(points, ["id", "n"]), percent))
    more = connecting(asked.join(once(whole_sets(some, narrow, width)), ["id", "n"]), percent)
    whole = connected(links.union(more), scratch)

    # Only classes with copies, or that another class reaches, have something to tell their rows.
    moved = firsts.withColumnRenamed("first", "id").join(whole, "id", "left").select(*key, "size", F.coalesce("component", "id").alias("component"), (F.col("size") > 1).alias("more"), "id")
    moved = scratch.keep(moved.filter("more or component <> id").select(*key, "size", "component"))
    out = with_keys(sets, moved, key, "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
