"""Encoding, decoding and counting against the libraries."""

import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemill.llm import bpe, token_counts
from tidemill.llm.bpe_rounds import MergeTable
from tidemill.llm.registry import QUERIES


def odd_texts() -> list[str | None]:
    rnd = random.Random(1)
    some = lambda: chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0x80, 0x3000), rnd.randrange(0x3000, 0xD800), rnd.randrange(0x10000, 0x20000), 32, 10]))
    texts = ["", None, "<|startoftext|>Hi<|endoftext|>x", "<|startoftext", "aaaaaaa" * 200, "it's WE'LL'd ΑΣΣ ς İ \x1c\x1d a\x85b　c﻿ ½²３", "日本語" * 300]
    texts += ["▁▁ a  b\n\n c   ", " ", "\n", "   ", "\t x\r\n", "é ́a", "<s></s><unk>", "a\x00b", "x" * 5000, "ab" * 3000]
    return texts + ["".join(some() for _ in range(rnd.randrange(1, 60))) for _ in range(500)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def test_encode_and_decode_odd(library):
    own, texts = bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY)), odd_texts()
    ids, counts = own.encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        mine, at = ids[at : at + n].tolist(), at + n
        theirs = library.encode(text or "", add_special_tokens=False).ids
        assert mine == theirs, text
        assert own.decode(mine) == library.decode(theirs, skip_special_tokens=False)


def test_every_code_point(library):
    own = bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY))
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    ids, counts = own.encode(texts)
    theirs = library.encode_batch(texts, add_special_tokens=False)
    assert counts.tolist() == [len(e.ids) for e in theirs]
    assert ids.tolist() == [i for e in theirs for i in e.ids]


def test_plain_range(library):
    own = bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY))
    texts = [f"A{chr(c)}b {chr(c)}" for c in range(ord(bpe.PLAIN))]
    assert own.encode(texts)[0].tolist() == [i for e in library.encode_batch(texts, add_special_tokens=False) for i in e.ids]


def test_forgets_without_changing(monkeypatch):
    path, texts = public_tokenizers.path(bpe.VOCABULARY), odd_texts()
    whole = bpe.Encoder(path).encode(texts)[0].tolist()
    monkeypatch.setattr(bpe.Encoder, "KEPT", 10)
    small = bpe.Encoder(path)
    assert [i for t in texts for i in small.encode([t])[0].tolist()] == whole


def test_counts_odd():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.VOCABULARY))
    own, texts = token_counts.Counter(public_tokenizers.path(token_counts.VOCABULARY)), odd_texts()
    assert own.count(texts) == [len(model.encode(t or "")) for t in texts]


def test_whole_tokens_are_proven():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.VOCABULARY))
    own = token_counts.Counter(public_tokenizers.path(token_counts.VOCABULARY))
    assert len(own.whole) > 30_000
    for string in sorted(own.whole)[::50]:
        if string.startswith(b" ") and string.strip(b" "):
            assert len(model.encode(string[1:].decode())) == 1


def test_both_merge_orders():
    table = MergeTable([0, 2, 0], [1, 0, 2], [0, 1, 2], [2, 3, 4])
    slow = MergeTable([0, 2, 0], [1, 0, 2], [0, 1, 2], [2, 3, 4])
    slow.monotone = False
    words, lengths = [0, 1, 0, 1, 0, 0, 1, 1, 5], [5, 3, 1]
    assert table.monotone
    assert [a.tolist() for a in table.merge(words, lengths)] == [a.tolist() for a in slow.merge(words, lengths)]
    assert [a.tolist() for a in MergeTable([], [], [], []).merge([3, 4], [2])] == [[3, 4], [2]]
    assert [a.tolist() for a in table.merge([], [])] == [[], []]


def test_queries(spark, sf, docs, library):
    import hashlib

    root, _ = sf
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.VOCABULARY))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    coded = {r["doc_id"]: r for r in QUERIES["op2_bpe"](spark, root).collect()}
    counted = {r["doc_id"]: r for r in QUERIES["op9_token_counts"](spark, root).collect()}
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert tuple(coded[d]) == (d, len(ids), sha(" ".join(map(str, ids))), sha(text))
        n = len(model.encode(t or ""))
        assert tuple(counted[d]) == (d, len((t or "").encode()), n, n > 4096)


def test_keeps_columns_and_rows(spark, table):
    rows = table([(1, "a"), (1, "a"), (None, None)])
    back = bpe.decode(bpe.encode(rows))
    assert back.columns == [*rows.columns, "ids", "decoded"] and back.count() == 3
    assert token_counts.count_tokens(table([])).count() == 0
    assert bpe.decode(bpe.encode(table([]))).count() == 0
