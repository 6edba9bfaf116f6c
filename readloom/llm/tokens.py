"""Operator 6: token counts of whole texts, by a public tokenizer.

Texts are cut at safe boundaries (places where no token can reach across), the
distinct cuts of a byte-balanced batch are encoded once, and only lengths leave
the Arrow function.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.arrow import by_bytes, rows, small_batches

#: Distinct cuts that one Python worker remembers, unless told otherwise; beyond it only the first half stays, which has the common ones.
REMEMBERED = 800_000
#: Before a single space between two visible characters; for tokenizers that keep white space.
BEFORE_SPACE = re.compile(rb"(?<=[!-~])(?= [!-~])")
#: Pieces of a text that keeps its white space, in bytes, at least.
PIECE = 1 << 16


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


@lru_cache(maxsize=4)
def load_encoder(path: str, lengths: bool) -> Callable[[list[str]], list]:
    """Batch encoder of one file, giving lengths or packed ids: tokenizers for .json, sentencepiece for .model."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: list(map(len if lengths else packed_ids, model.encode(texts, num_threads=1)))
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()

    def singly(texts: list[str]) -> list:
        found = model.encode_batch_fast(texts, add_special_tokens=False)
        return list(map(len, found)) if lengths else [packed_ids(e.ids) for e in found]

    suffix = description(path)["model"].get("end_of_word_suffix")
    return joined(model, suffix, singly, lengths) if suffix and drops_space(path) else singly


#: Words that are encoded as one text.
JOINED = 200


def joined(model, suffix: str, singly: Callable[[list[str]], list], lengths: bool) -> Callable[[list[str]], list]:
    """Encodes words of letters many at a time, and finds where each ends by the tokens that end a word."""
    vocabulary = model.get_vocab(with_added_tokens=False)
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def encode(texts: list[str]) -> list:
        words = [t for t in texts if t.isalpha()]
        runs = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        known: dict[str, object] = {}
        for run, found in zip(runs, model.encode_batch_fast(list(map(" ".join, runs)), add_special_tokens=False), strict=True):
            ids = np.asarray(found.ids, "<u4")
            stops = np.flatnonzero(ends[ids]) + 1
            if len(stops) != len(run) or stops[-1] != len(ids):
                known.update(zip(run, singly(run), strict=True))
            elif lengths:
                known.update(zip(run, np.diff(stops, prepend=0).tolist(), strict=True))
            else:
                packed, stops = ids.tobytes(), (4 * stops).tolist()
                known.update((w, packed[a:b]) for w, a, b in zip(run, [0, *stops[:-1]], stops, strict=True))
        rest = [t for t in texts if t not in known]
        known.update(zip(rest, singly(rest), strict=True))
        return [known[t] for t in texts]

    return encode


@lru_cache(maxsize=4)
def memory(path: str, lengths: bool) -> dict[bytes, object]:
    """What this Python worker remembers of distinct cuts, from one task to the next."""
    return {}


#: ASCII signs, but those of special tokens; a run of them between a letter or digit and white space shares no token with the word.
SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "<|>")


@lru_cache(maxsize=4)
def description(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def drops_space(path: str) -> bool:
    """Whether the tokenizer treats white space as a separator that yields no token."""
    if path.endswith(".model"):
        return False
    parts = description(path).get("pre_tokenizer") or {}
    split = [p for p in parts.get("pretokenizers", []) if p.get("type") == "Split"]
    return any(p.get("behavior") == "Removed" and "\\s" in str(p.get("pattern")) for p in split)


def lowers(path: str) -> bool:
    """Whether the tokenizer takes A-Z as a-z, but in its special tokens."""
    if path.endswith(".model"):
        return False
    parts = description(path).get("normalizer") or {}
    return any(p.get("type") == "Lowercase" for p in parts.get("normalizers", [parts]))


class CutEncoder:
    """Encodes texts by their cuts and remembers the length, or the packed ids, of each distinct cut."""

    def __init__(self, path: str, *, lengths: bool, remembered: int = REMEMBERED):
        self.encode, self.known = load_encoder(path, lengths), memory(path, lengths)
        self.remembered = remembered
        self.whole, self.lowers, self.prefixes = not drops_space(path), lowers(path), path.endswith(".model")

    def cuts(self, text: bytes) -> list[bytes]:
        """Runs between ASCII white space if it is dropped, otherwise pieces of at least PIECE bytes.

        A library that puts a space before each text gets the pieces without theirs.
        """
        if not self.whole:
            return text.lower().split() if self.lowers and b"<" not in text else text.split()
        if len(text) <= PIECE:
            return [text] if text else []
        out, start = [], 0
        for m in BEFORE_SPACE.finditer(text):
            if m.start() - start >= PIECE:
                out.append(text[start : m.start()])
                start = m.start() + self.prefixes
        return [*out, text[start:]]

    def __call__(self, texts: list[bytes]) -> list[list]:
        """What is kept of every text's cuts, in order."""
        split = [self.cuts(t) for t in texts]
        known = self.known
        if new := set().union(*split).difference(known):
            self.learn(new)
        out = [list(map(known.__getitem__, cuts)) for cuts in split]
        if self.whole:
            known.clear()
        elif len(known) > self.remembered:
            first = dict(islice(known.items(), self.remembered // 2))
            known.clear()
            known.update(first)
        return out

    def learn(self, new: set[bytes]) -> None:
        """Encodes new cuts; a word and the signs that end it are cut once more, so that each is encoded once."""
        stems = {c: self.stem(c) for c in new} if not self.whole else {}
        parts = {c[: len(s)] for c, s in stems.items()} | {c[len(s) :] for c, s in stems.items()} | new.difference(stems)
        asked = list(parts.difference(self.known, (b"",)))
        if asked:
            self.known.update(zip(asked, self.encode([c.decode("utf-8", "replace") for c in asked]), strict=True))
        for cut, stem in stems.items():
            if len(stem) < len(cut):
                self.known[cut] = self.known[stem] + self.known[cut[len(stem) :]]

    @staticmethod
    def stem(cut: bytes) -> bytes:
        """The cut without the signs at its end, if a letter or digit of ASCII precedes them."""
        stem = cut.rstrip(SIGNS)
        return stem if stem and stem[-1] < 128 and stem[-1:].isalnum() else cut


def count_tokens(docs: DataFrame, tokenizer: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """``id_col``, n_bytes (UTF-8), n_tokens and over_limit of each row; no shuffle.

    A null or empty text has 0 bytes and 0 tokens; repeated rows give repeated
    results; a null id stays null; other columns of ``docs`` are not read. An
    empty table gives an empty result. Memory is bounded by one batch, by the
    longest text and by REMEMBERED distinct cuts.
    """

    def lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CutEncoder(tokenizer, lengths=True)
        for run in by_bytes(rows(batches), batch_bytes):
            ids, texts = zip(*run, strict=True)
            counts = [sum(c) for c in encoder(list(texts))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = arrow_type(narrow, "id")
    counted = narrow.mapInArrow(lengths, f"id {narrow.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
