"""Operator 10: line-first cleaning, then document rules on what is lost and what repeats."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.arrow import by_bytes, rows, small_batches
from readloom.llm.tokens import arrow_type

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
#: Signs that prose does not use within words.
MARKUP = b"#*$%&|<>{}~^=\\"
#: Between the entries of a menu or a table row.
SEPARATORS = re.compile(r" (?:\||»|›|·|•|/|::|>) ")
#: The same sentence sign twice or more.
RUN_OF_MARKS = re.compile(r"[!?.,;]{2,}(?=\s|$)")
BOILERPLATE = re.compile(
    r"all rights reserved|cookies? (?:policy|settings)|accept (?:all )?cookies|privacy policy|terms of (?:use|service)|enable javascript|"
    r"click here|read more|sign (?:in|up) (?:to|now|here)|log ?in to|subscribe to|our newsletter|share this|skip to (?:main )?content|"
    r"licensed under|spdx-license-identifier|permission is hereby granted|copyright (?:\(c\)|©)|powered by",
    re.IGNORECASE,
)


class Limits(NamedTuple):
    """Parameters of the rules; shares are in hundredths."""

    window: int = 8
    least_words: int = 20
    repeated: int = 30
    lost: int = 30
    markup: int = 10
    separators: int = 3
    shouted_words: int = 4
    notice_words: int = 20
    notice_bytes: int = 200


def is_notice(line: str, n_words: int, visible: int, limits: Limits) -> bool:
    """Whether a line with a phrase of boilerplate is short or mostly such phrases; a paragraph that mentions one is neither."""
    if not BOILERPLATE.search(line):
        return False
    if n_words <= limits.notice_words and visible <= limits.notice_bytes:
        return True
    return 2 * sum(len(m[0].encode().translate(None, SPACE)) for m in BOILERPLATE.finditer(line)) >= visible


def line_fault(line: str, earlier: set[str], limits: Limits) -> str | None:
    """The first rule that a line with a word breaks."""
    words = line.split()
    raw = line.encode()
    visible = len(raw.translate(None, SPACE))
    marks = len(raw) - len(raw.translate(None, MARKUP))
    if marks >= limits.separators and len(SEPARATORS.findall(line)) * 4 >= max(4 * limits.separators, len(words)):
        return "navigation"
    if marks * 100 > limits.markup * visible or not any(map(str.isalnum, line)):
        return "punctuation"
    if len(words) >= limits.shouted_words and (line.isupper() or 2 * len(RUN_OF_MARKS.findall(line)) > len(words)):
        return "punctuation"
    if is_notice(line, len(words), visible, limits):
        return "boilerplate"
    if line in earlier or 2 * sum(map(str.__eq__, words, words[1:])) > max(len(words), limits.shouted_words):
        return "repeated"
    return None


def repeated_words(words: list[bytes], window: int) -> int:
    """Words that lie in a window of words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    runs = list(zip(*(words[i : i + n] for i in range(window)), strict=True))
    first: dict[tuple, int] = {}
    if len(set(runs)) == n:
        return 0
    hit = bytearray(n)
    for i, run in enumerate(runs):
        if (j := first.setdefault(run, i)) != i:
            hit[i] = hit[j] = 1
    covered, reach = 0, 0
    for i in range(n):
        if hit[i]:
            covered += i + window - max(i, reach)
            reach = i + window
    return covered


def clean(text: str, limits: Limits) -> tuple[str, dict[str, int], int, int, int]:
    """Cleaned text, lines that fell by rule, visible bytes, those lost, and lines equal to an earlier one.

    The first line of boilerplate, such as a licence, is no loss if it is short
    and at most ``limits.lost`` percent of the visible text.
    """
    kept, faults = [], {"punctuation": 0, "navigation": 0, "boilerplate": 0, "repeated": 0}
    seen: set[str] = set()
    there = lost = again = spared = 0
    for line in text.split("\n"):
        size = len(line.encode().translate(None, SPACE))
        if not size:
            kept.append(line)
            continue
        there += size
        fault = line_fault(line, seen, limits)
        again += line in seen
        seen.add(line)
        if fault:
            faults[fault] += 1
            if fault == "boilerplate" and faults[fault] == 1 and size <= limits.notice_bytes:
                spared = size
            else:
                lost += size
        else:
            kept.append(line)
    if 100 * spared > limits.lost * there:
        lost += spared
    return "\n".join(kept), faults, there, lost, again


OUT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, clean_text string, n_punctuation long, n_navigation long, n_boilerplate long, n_repeated long, lost_percent double"


def quality_rules(docs: DataFrame, *, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verdict, statistics and cleaned text of every row; no shuffle.

    Lines that break the punctuation, navigation, boilerplate or repetition rule
    go; a document is kept if it passes the base limits and loses no more than
    ``limits.lost`` percent of its visible text, one short line of boilerplate
    aside that is no more than that either. A null or empty text has no words, fails the base limits and cleans to an empty text. Repeated rows give
    repeated results; a null id stays null; other columns are not read; an empty
    table gives an empty result. A task holds one batch or the longest text.
    """

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_bytes(rows(batches), 1 << 20):
            out = []
            for _, raw in run:
                words = raw.split()
                text = raw.decode("utf-8", "replace")
                cleaned, faults, there, lost, again = clean(text, limits)
                repeats = repeated_words(words, limits.window)
                failed = len(words) < limits.least_words or 100 * repeats > limits.repeated * len(words)
                spaces = len(raw) - len(raw.translate(None, SPACE))
                out.append((len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)), again, repeats, failed, not failed and 100 * lost <= limits.lost * there, cleaned, *faults.values(), 100 * lost / there if there else 0.0))
            arrays = [pa.array([i for i, _ in run], id_type), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["id", *(c.split()[0] for c in OUT.split(", "))]
    kinds = [{"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in OUT.split(", ")]
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = arrow_type(narrow, "id")
    return narrow.mapInArrow(judged, f"id {narrow.schema['id'].dataType.simpleString()}, {OUT}").withColumnRenamed("id", id_col)
