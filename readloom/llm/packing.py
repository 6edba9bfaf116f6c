"""Operator 2: cost-balanced packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.arrow import by_bytes, rows, small_batches
from readloom.llm.tokens import REMEMBERED, CutEncoder, arrow_type, packed_ids

#: Tokens that one group of sequences holds; a task packs its rows group after group.
GROUP_TOKENS = 1 << 22
#: Cost of a document of n tokens in a sequence: LINEAR * n + QUADRATIC * n * n (attention stays inside a document).
LINEAR, QUADRATIC = 1.0, 1.0 / 2048


def pack_lengths(lengths: list[int], capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece.

    Whole multiples of ``capacity`` become full sequences of their own. The rest
    goes, by descending cost, to the cheapest sequence with room for it; the
    sequences are as few as the tokens allow, so what finds no room as a whole is
    cut into the largest gaps, and a group has fewer than ``capacity`` free places.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    items: list[tuple[int, int, int]] = []
    sequence = 0
    for doc, n in enumerate(lengths):
        full = n - n % capacity
        for start in range(0, full, capacity):
            pieces.append((doc, start, capacity, sequence, 0))
            sequence += 1
        if n > full:
            items.append((n - full, doc, full))
    items.sort(key=lambda x: (-x[0], x[1]))
    count = -(-sum(x[0] for x in items) // capacity)
    used = [0] * count
    cheapest = [(0.0, s) for s in range(count)]
    heapify(cheapest)
    full_up: list[tuple[int, float, int]] = []  # too full for the present length; the roomiest first
    homeless: list[tuple[int, int, int]] = []
    for n, doc, start in items:
        while full_up and -full_up[0][0] >= n:
            _, cost, s = heappop(full_up)
            heappush(cheapest, (cost, s))
        while cheapest:
            cost, s = heappop(cheapest)
            if capacity - used[s] >= n:
                pieces.append((doc, start, n, sequence + s, used[s]))
                used[s] += n
                if used[s] < capacity:
                    heappush(cheapest, (cost + linear * n + quadratic * n * n, s))
                break
            heappush(full_up, (used[s] - capacity, cost, s))
        else:
            homeless.append((n, doc, start))
    gaps = sorted(((capacity - u, s) for s, u in enumerate(used) if u < capacity), key=lambda x: (x[0], -x[1]))
    for n, doc, start in homeless:
        while n:
            room, s = gaps.pop()
            take = min(room, n)
            pieces.append((doc, start, take, sequence + s, used[s]))
            used[s] += take
            n, start = n - take, start + take
            if take < room:
                gaps.append((room - take, s))
    return pieces


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", group_tokens: int = GROUP_TOKENS, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens.

    Each task packs what it reads, in groups of about ``group_tokens`` tokens, so
    nothing is shuffled and memory does not grow with the table; a worker
    remembers ``remembered`` distinct words, which takes memory for speed. A null or empty
    text is one piece with the end id alone; repeated rows are packed as often
    as they come; a null id stays null; other columns are not read; an empty
    table gives no rows. sequence_id is unique: task number and a counter.
    """

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CutEncoder(tokenizer, lengths=False, remembered=remembered)
        end = packed_ids([end_id])
        first = TaskContext.get().partitionId() << 32
        group: list[tuple[object, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal first
            pieces = pack_lengths([len(b) // 4 for _, b in group], capacity)
            doc, start, length, seq, offset = np.asarray(pieces, np.int64).reshape(-1, 5).T
            crc = [zlib.crc32(memoryview(group[d][1])[4 * a : 4 * (a + n)]) for d, a, n, _, _ in pieces]
            fill = np.bincount(seq, weights=length).astype(np.int64)
            arrays = [pa.array([group[d][0] for d in doc], id_type), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array([len(group[d][1]) // 4 for d in doc], pa.int64()), pa.array(seq + first), pa.array(offset), pa.array(fill[seq])]
            first += len(fill)
            return pa.RecordBatch.from_arrays(arrays, names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"])

        for run in by_bytes(rows(batches), 1 << 20):
            ids, texts = zip(*run, strict=True)
            for doc_id, cuts in zip(ids, encoder(list(texts)), strict=True):
                group.append((doc_id, b"".join([*cuts, end])))
                size += len(group[-1][1]) // 4
                if size >= group_tokens:
                    yield flush()
                    group, size = [], 0
        if group:
            yield flush()

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = arrow_type(narrow, "id")
    kind = narrow.schema["id"].dataType.simpleString()
    out = narrow.mapInArrow(packed, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long")
    return out.withColumnRenamed("id", id_col)
