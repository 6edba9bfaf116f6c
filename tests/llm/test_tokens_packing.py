import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from readloom.llm.packing import pack, pack_lengths
from readloom.llm.queries import QUERIES, TOKENIZER
from readloom.llm.tokens import CutEncoder, count_tokens

from .helpers import SF, documents, sf_texts

TEXTS = [None, "", " \n\t", "One two, three.", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>", "É́ \u0085 \u2003 a\x1cb \U0001f600", "a" * 30_000, "the the&&& It's " * 4000, "One two, three."]


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(TOKENIZER)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_counts_are_those_of_whole_texts(spark, whole):
    got = {r.doc_id: r for r in count_tokens(documents(spark, TEXTS), TOKENIZER, batch_bytes=4096).collect()}
    assert {i: (r.n_bytes, r.n_tokens, r.over_limit) for i, r in got.items()} == {i: (len((t or "").encode()), n := len(whole(t)), n > 2048) for i, t in enumerate(TEXTS)}
    assert count_tokens(documents(spark, TEXTS).limit(0), TOKENIZER).count() == 0


def test_random_texts(whole):
    rng = random.Random(5)
    signs = [*"abÀ.,'s!é<|>\u0301 \n \x1c9&-", "<|endoftext|>", "'re", "<|STARTOFTEXT|>", "x.", ". "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    for lengths in (True, False):
        got = CutEncoder(TOKENIZER, lengths=lengths)([t.encode() for t in texts])
        for text, cuts in zip(texts, got, strict=True):
            assert (sum(cuts) == len(whole(text))) if lengths else (b"".join(cuts) == np.asarray(whole(text), "<u4").tobytes())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_tokenizers_that_keep_spaces(spark, name):
    path = public_tokenizers.path(name)
    text = "some  words here and \n more, of them " * 6000
    if name.endswith(".json"):
        want = len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    else:
        import sentencepiece

        want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
    assert count_tokens(documents(spark, [text]), path).first().n_tokens == want


def test_query_counts(spark, whole):
    texts = sf_texts(spark)
    assert {r.doc_id: r.n_tokens for r in QUERIES["op6_token_counts"](spark, SF).collect()} == {i: len(whole(t)) for i, t in texts.items()}


def check_pieces(rows, texts, whole, capacity=2048):
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for i, text in texts.items():
        ids, at = [*whole(text), 1], 0
        for r in sorted(docs.pop(i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert not docs
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(r.length for r in rows), len(sequences) * capacity


def test_pack_edges(spark, whole):
    unique = dict(enumerate(TEXTS))
    check_pieces(pack(documents(spark, TEXTS), TOKENIZER).collect(), unique, whole)
    check_pieces(pack(documents(spark, TEXTS), TOKENIZER, group_tokens=3000).collect(), unique, whole)
    assert pack(documents(spark, TEXTS).limit(0), TOKENIZER).count() == 0
    twice = documents(spark, ["a b"]).union(documents(spark, ["a b"]))
    assert [r.length for r in pack(twice, TOKENIZER).collect()] == [3, 3]


def test_query_packs_everything_with_little_padding(spark, whole):
    used, room = check_pieces(QUERIES["op2_packing"](spark, SF).collect(), sf_texts(spark), whole)
    assert used > 0.98 * room


def test_costs_are_balanced():
    rng = random.Random(2)
    lengths = [rng.randint(1, 900) for _ in range(3000)]
    pieces = pack_lengths(lengths, 2048)
    cost, fill = defaultdict(float), defaultdict(int)
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 2048
        fill[s] += n
    assert len(fill) == -(-sum(lengths) // 2048)
    mean = sum(cost.values()) / len(cost)
    assert max(cost.values()) < 1.05 * mean and len(pieces) < 1.25 * len(lengths)
