"""Operator 11: vectors as product codes, by k-means with norm-of-sum bounds.

Vectors of whole numbers are cut into parts, and each part position has a codebook.
A part keeps its entry and, for each group of entries, a lower bound on the distance
to those of the group that are not its own, with the round the bound was measured
in. All codebooks of the rounds are kept, so a bound is lowered by how far a group's
entries lie now from where they lay in that round: the norm of the sum of their
moves, which is at most the sum of the moves' norms. Only groups whose lowered bound
doesn't exceed the distance to the own entry are measured again, in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch

#: Components are multiplied by SCALE; beyond MOST their squares don't fit into 64 bits.
SCALE, MOST = 256, 1 << 27
#: Bounds are stored as 16-bit floats, rounded down; this share of a distance is left for what rounding does.
GREATEST, SLACK = 65504.0, 1e-9

STATE = "id {id}, label {label}, v array<long>, codes binary, bounds binary, stamps binary"


class Shape(NamedTuple):
    """Parameters: parts of a vector, entries of a codebook (256 at most), rounds, and groups of entries that share a bound."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    groups: int = 4


def grouped(book: np.ndarray, groups: int) -> list[np.ndarray]:
    """Indexes of the entries in groups of neighbours: halves at the median of the widest component, ascending within a group."""
    found = [np.arange(len(book))]
    while len(found) < groups and max(map(len, found)) > 1:
        found.sort(key=len)
        own = found.pop()
        widest = int(np.ptp(book[own], axis=0).argmax()) if book.shape[1] else 0
        order = own[np.argsort(book[own, widest], kind="stable")] if book.shape[1] else own
        found += [order[: len(own) // 2], order[len(own) // 2 :]]
    return [np.sort(g) for g in found]


def moved(books: list[np.ndarray], members: list[np.ndarray]) -> np.ndarray:
    """For each group and past round the longest way that an entry lies from where it lay then."""
    ways = np.stack([np.sqrt(((books[-1] - then) ** 2).sum(1).astype(float)) for then in books])
    return np.stack([ways[:, g].max(axis=1) for g in members])


def rounded_down(x: np.ndarray) -> np.ndarray:
    low = np.minimum(x, GREATEST).astype(np.float16)
    return np.where(low > x, np.nextafter(low, np.float16(-np.inf)), low)


def assigned(x: np.ndarray, books: list[np.ndarray], members: list[np.ndarray], codes: np.ndarray, bounds: np.ndarray, stamps: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entries, squared distances, how many distances were measured); ``bounds`` and ``stamps`` are brought up to date in place.

    ``books``: the codebook of each round so far, the present one last. ``codes``:
    entries of the round before. Of entries at one distance the lower index is the nearest.
    """
    book, now = books[-1], len(books) - 1
    best, code = ((x - book[codes]) ** 2).sum(1), codes.astype(np.int64)
    own, measured = np.sqrt(best.astype(float)), len(x)
    low = bounds - moved(books, members)[np.arange(len(members)), stamps]
    near = low <= own[:, None] * (1 + SLACK) + SLACK
    seen = []
    for g, entries in enumerate(members):
        rows = np.flatnonzero(near[:, g])
        d = ((x[rows, None] - book[entries][None]) ** 2).sum(2)
        measured += d.size
        least = d.argmin(axis=1)
        found, value = entries[least], d[np.arange(len(rows)), least]
        better = (value < best[rows]) | ((value == best[rows]) & (found < code[rows]))
        best[rows[better]], code[rows[better]] = value[better], found[better]
        seen.append((rows, d))
    for g, (entries, (rows, d)) in enumerate(zip(members, seen, strict=True)):
        others = np.where(entries[None] == code[rows, None], np.inf, d).min(axis=1)
        bounds[rows, g], stamps[rows, g] = rounded_down(np.sqrt(others)), now
        left = np.flatnonzero(~near[:, g] & (code != codes) & np.isin(codes, entries))
        bounds[left, g], stamps[left, g] = rounded_down(np.maximum(np.minimum(low[left, g], own[left]), 0)), now
    return code, best, measured


def rows_of(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """Vectors of a batch as rows, parts and components."""
    flat = batch["v"].flatten().to_numpy(zero_copy_only=False)
    sizes = set(np.diff(batch["v"].offsets.to_numpy()).tolist())
    if len(sizes) > 1 or sizes.pop() % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}")
    return flat.reshape(len(batch), parts, -1)


def told(column: pa.Array, n: int, kind: type) -> np.ndarray:
    """One array from a column of packed numbers; it may be written to."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1).copy()


def packed(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in x], pa.binary())


def one_round(vectors: DataFrame, history: list[np.ndarray], members: list[list[np.ndarray]], shape: Shape, last: bool) -> DataFrame:
    """Assigns all parts to ``history[-1]``: the rows with their state, or at last with code and error."""
    kinds = dict(vectors.dtypes)
    groups = max(map(len, members))
    schema = "id {id}, label {label}, code string, error long" if last else STATE

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            x = rows_of(batch, shape.parts)
            first = "codes" not in batch.schema.names
            codes = np.zeros((n, shape.parts), np.uint8) if first else told(batch["codes"], n, np.uint8)
            bounds = np.zeros((n, shape.parts, groups), np.float16) if first else told(batch["bounds"], n, np.float16).reshape(n, shape.parts, groups)
            stamps = np.zeros((n, shape.parts, groups), np.uint8) if first else told(batch["stamps"], n, np.uint8).reshape(n, shape.parts, groups)
            error = np.zeros(n, np.int64)
            for part, own in enumerate(members):
                k = len(own)
                codes[:, part], squares, _ = assigned(x[:, part], [h[part] for h in history], own, codes[:, part].astype(np.int64), bounds[:, part, :k], stamps[:, part, :k])
                error += squares
            if last:
                yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], pa.array([row.tobytes().hex() for row in codes]), pa.array(error)], names=["id", "label", "code", "error"])
            else:
                yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], batch["v"], packed(codes), packed(bounds), packed(stamps)], names=["id", "label", "v", "codes", "bounds", "stamps"])

    return vectors.mapInArrow(run, schema.format(**kinds))


def entry_sums(state: DataFrame, history: list[np.ndarray], shape: Shape) -> dict[tuple, tuple]:
    """(part, entry, component) to (sum, count) of the parts assigned to each entry; tasks hand on their sums only."""
    size = history[0].shape

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(size, np.int64), np.zeros(size[:2], np.int64)
        for batch in batches:
            if len(batch):
                x, codes = rows_of(batch, shape.parts), told(batch["codes"], len(batch), np.uint8)
                for part in range(size[0]):
                    np.add.at(sums[part], codes[:, part], x[:, part])
                    counts[part] += np.bincount(codes[:, part], minlength=size[1])
        at = np.argwhere(np.broadcast_to(counts[:, :, None] > 0, size))
        columns = [*(pa.array(at[:, i].astype(np.int32)) for i in range(3)), pa.array(sums[tuple(at.T)]), pa.array(counts[tuple(at[:, :2].T)])]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "component", "total", "n"])

    rows = state.select("v", "codes").mapInArrow(summed, "part int, entry int, component int, total long, n long")
    met = rows.groupBy("part", "entry", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    return {(r["part"], r["entry"], r["component"]): (int(r["total"]), r["n"]) for r in met.collect()}


def seeds(vectors: DataFrame, wanted: int) -> list[list[int]]:
    """The vectors of the smallest ids, ascending; of rows with one id the least vector counts, a null id is none."""
    ids: list = []
    while len(ids) < wanted:
        rest = vectors.filter(F.col("id") > ids[-1]) if ids else vectors.filter(F.col("id").isNotNull())
        more = sorted({r[0] for r in rest.select("id").orderBy("id").limit(wanted).collect()})
        if not more:
            break
        ids = (ids + more)[:wanted]
    found = {r["id"]: r["v"] for r in vectors.filter(F.col("id").isin(ids)).groupBy("id").agg(F.min("v").alias("v")).collect()} if ids else {}
    return [found[i] for i in ids]


def compress_vectors(vectors: DataFrame, *, shape: Shape = Shape(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(``id_col``, ``label_col``, code, error of every kept row; the codebooks by part, entry and component).

    Components become floor(SCALE * x). Rows whose vector is null, empty or holds
    null or non-finite components are dropped. Vectors must have one length, a
    multiple of ``shape.parts``, and components below MOST, or the job fails
    and says so. The codebooks start as the vectors of the smallest ids (see
    ``seeds``; with fewer ids, or none, there are fewer entries, but one of zeros at
    least); rows with a null id are coded like others. Repeated rows are coded each for itself and
    weigh as often as they come. An empty table gives an empty result. Other
    columns are not read.

    Every round is one pass over the rows and one sum for each component of an
    entry, so the driver holds codebooks only. A row's state is its numbers and,
    for each part, one byte and three more for each group of entries.
    """
    scratch = Scratch(vectors.sparkSession)
    real = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    numbers = F.transform("v", lambda x: F.floor(SCALE * x.cast("double")))
    fits = F.forall(numbers, lambda x: F.abs(x) < MOST)
    checked = F.when(fits, numbers).otherwise(F.raise_error(F.lit(f"components must be below {MOST // SCALE}")).cast("array<long>"))
    there = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    kept = there.filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", real)).withColumn("v", checked)

    first = seeds(kept, shape.entries)
    if any(len(v) != len(first[0]) or len(v) % shape.parts for v in first):
        raise ValueError(f"vectors must have one length, a multiple of {shape.parts}")
    books = np.asarray(first or [[0] * shape.parts], np.int64)
    books = books.reshape(len(books), shape.parts, -1).transpose(1, 0, 2)
    members = [grouped(book, shape.groups) for book in books]
    history, state = [books], kept
    for _ in range(shape.rounds):
        state = scratch.keep(one_round(state, history, members, shape, last=False))
        met = entry_sums(state, history, shape)
        after = history[-1].copy()
        for place, (total, n) in met.items():
            after[place] = total // n
        history.append(after)
    coded = one_round(state, history, members, shape, last=True)
    return scratch.keep(coded).withColumnsRenamed({"id": id_col, "label": label_col}), history[-1]


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """Adds label_error: the error summed over the rows of a label, of those without one together."""
    sums = Scratch(coded.sparkSession).keep(coded.groupBy(F.col(label_col).alias("of_label")).agg(F.sum("error").alias("label_error")))
    return coded.join(sums, coded[label_col].eqNullSafe(sums["of_label"])).drop("of_label")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and component."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
