"""Operator 9: benchmark items inside documents, by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set. All items of a partition
keep the same number k of their smallest shingle hashes, so many that a text
holding the asked share of an item holds one of them. Documents look their
shingles up among these hashes, and an item that is met is verified against the
whole document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.arrow import as_bytes, by_bytes, rows
from readloom.llm.scratch import Scratch
from readloom.llm.shingles import hashed_words, rolled
from readloom.llm.tokens import arrow_type

#: Item shingles that one block of the benchmark holds, about; each block is one pass over the documents.
BLOCK_SHINGLES = 4_000_000
#: A-Z to a-z, and ASCII punctuation to a space.
FOLD = bytes(32 if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def folded(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def least(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def sketch_size(n: int, percent: int) -> int:
    """k of the partition of sets with 2^i to 2^(i+1) - 1 shingles: a text without k of them cannot hold the share."""
    top = (1 << n.bit_length()) - 1
    return top - least(top, percent) + 1


class Items:
    """One block of the benchmark: the sets of its items and the sketch table of each shingle width."""

    def __init__(self, ids: list, widths: list[int], sets: list[np.ndarray], percent: int):
        self.ids, self.sets, self.percent = ids, sets, percent
        self.tables = {}
        for width in set(widths):
            own = [i for i, w in enumerate(widths) if w == width]
            sketches = [sets[i][: sketch_size(len(sets[i]), percent)] for i in own]
            hashes = np.concatenate(sketches)
            item = np.repeat(own, [len(s) for s in sketches])
            order = np.argsort(hashes, kind="stable")
            self.tables[width] = hashes[order], item[order]

    def search(self, texts: list[list[bytes]]) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) of items that a text holds to the asked share."""
        words, starts = hashed_words(texts)
        for width, (hashes, item) in self.tables.items():
            runs = rolled(words, width)
            if not len(runs):
                continue
            at = np.minimum(np.searchsorted(hashes, runs), len(hashes) - 1)
            hits = np.flatnonzero(hashes[at] == runs)
            text = np.searchsorted(starts, hits, "right") - 1
            inside = hits + width <= starts[text + 1]
            hits, text = hits[inside], text[inside]
            for t in np.unique(text):
                own = np.unique(runs[starts[t] : starts[t + 1] - width + 1])
                met = np.unique(runs[hits[text == t]])
                low, high = np.searchsorted(hashes, met, "left"), np.searchsorted(hashes, met, "right")
                for i in np.unique(np.concatenate([item[a:b] for a, b in zip(low, high, strict=True)])):
                    shared = int(np.isin(self.sets[i], own, assume_unique=True).sum())
                    if shared >= least(len(self.sets[i]), self.percent):
                        yield int(t), int(i), shared


def contained_items(docs: DataFrame, benchmark: DataFrame, *, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``id_col``, ``item_col``, n_item_shingles, n_shared: items of which a document holds ``percent`` percent or more.

    Texts are folded (A-Z to lower case, ASCII punctuation to spaces) and cut
    into runs of ``width`` words; an item with fewer words is one run of its
    own length. Items without a word, null texts included, match nothing;
    neither does a document without enough words. Repeated rows on either side
    give repeated results, null ids stay null, empty tables give none, other columns are not
    read. The benchmark is taken in blocks of bounded size, each broadcast
    for one pass over all documents; no item or document is left out.
    """
    scratch = Scratch(docs.sparkSession)
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    item_type = arrow_type(items, "item")

    def item_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_bytes(rows(batches), 1 << 20):
            out = []
            for i, text in run:
                hashes, _ = hashed_words([folded(text)])
                if len(hashes):
                    w = min(width, len(hashes))
                    out.append((i, w, np.unique(rolled(hashes, w))))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], item_type), pa.array([x[1] for x in out], pa.int32()), pa.array([len(x[2]) for x in out], pa.int64()), pa.array([x[2].tobytes() for x in out], pa.binary())], names=["item", "width", "n", "hashes"])

    kind = items.schema["item"].dataType.simpleString()
    kept = scratch.keep(items.mapInArrow(item_sets, f"item {kind}, width int, n long, hashes binary"))
    blocks = max(1, -(-(kept.agg(F.sum("n")).first()[0] or 0) // BLOCK_SHINGLES))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = arrow_type(narrow, "id")
    schema = f"id {narrow.schema['id'].dataType.simpleString()}, item {kind}, n_item_shingles long, n_shared long"

    def matches(block) -> DataFrame:
        def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, widths, sets = block.value
            here = Items(ids, widths, [np.frombuffer(s, np.uint64) for s in sets], percent)
            for run in by_bytes(rows(batches), 1 << 20):
                hits = [(run[t][0], here.ids[i], len(here.sets[i]), n) for t, i, n in here.search([folded(text) for _, text in run])]
                columns = list(zip(*hits, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (id_type, item_type, pa.int64(), pa.int64()), strict=True)], names=["id", "item", "n_item_shingles", "n_shared"])

        return narrow.mapInArrow(found, schema)

    out = None
    for i in range(blocks):
        own = kept.filter(F.pmod(F.xxhash64("item", "hashes"), F.lit(blocks)) == i).toPandas()
        block = docs.sparkSession.sparkContext.broadcast((own["item"].tolist(), own["width"].tolist(), own["hashes"].tolist()))
        out = matches(block) if out is None else out.union(matches(block))
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_item_shingles", "n_shared")
