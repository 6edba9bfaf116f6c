"""Fixtures and plain versions that the operators are compared with."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
CLASHING = "id string, n_tokens int, held string, label string, lang int, word int, block int, key int, row int, value int, n int, counts int, range int, base int, spans int, kept int"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def documents(spark, texts, extra=True):
    """doc_id, text and a column for each name that an operator uses inside; texts is a list, or id to text."""
    rows = list(texts.items()) if isinstance(texts, dict) else list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if not extra:
        return df
    return df.selectExpr("doc_id", "text", *(f"cast(7 as {kind}) as {name}" for name, kind in (c.split() for c in CLASHING.split(", "))))


def words(text, lower=False):
    raw = (text or "").encode()
    return WORD.findall(raw.lower() if lower else raw)


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def shingles(text, width=5):
    w = words(text, lower=True)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def components(texts, percent=80):
    """Smallest id that links reach, by counting all shared shingles."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders, parent = defaultdict(list), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sorted(sets):
        both = Counter(j for s in sets[i] for j in holders[s])
        for j, n in both.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def sf_texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
