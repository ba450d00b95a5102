"""Operator 2: BPE encoding and decoding by batched numpy merge rounds."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemill.llm.bpe_rounds import MergeTable
from tidemill.llm.common import ragged, refuse, table, text_runs

VOCABULARY = "word_bpe_49k.json"
#: Below this code point, Python and the library agree on letters, case and normal forms (tested on each).
PLAIN = chr(0x500)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Encoder:
    """Texts to ids and back. Keeps the ids of pieces between ASCII spaces it has seen, up to a bound."""

    KEPT = 250_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = dict(spec["model"]["vocab"]), spec["model"]["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *self.added.items()]:
            self.tokens[i] = token
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.table = MergeTable(
            [vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], range(len(pairs)), [vocab[a + b] for a, b in pairs]
        )
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters])
        self.last = np.array([vocab[c + end] for c in letters])
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")")
        self.words = regex.compile(r"[\n\r]|'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer[0]
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.starts, self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def split(self, text: str) -> list[str]:
        """Pre-tokens of any text: special strings as they stand, and the library's own pre-tokens between them.

        Outside the plain range the outcome hangs on the version of Unicode.
        """
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))]
        return out

    def lines(self, pieces: list[str]) -> list[str]:
        """Pre-tokens of the pieces, a line break after each piece.

        In the plain range: NFC, lower case letter by letter (no rule for a
        final sigma), then the vocabulary's pattern.
        """
        easy = [p.isascii() or max(p) < PLAIN for p in pieces]
        text = "".join(p + "\n" if ok and "<|" not in p else "\r" for p, ok in zip(pieces, easy))
        tokens = self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        if "\r" in text:
            hard = (self.split(p) for p, ok in zip(pieces, easy) if not ok or "<|" in p)
            tokens = [t for token in tokens for t in ([*next(hard), "\n"] if token == "\r" else (token,))]
        return tokens

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each word has."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(w) for w in raw])
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        return self.table.merge(symbols, lengths)

    def learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces; white space always parts tokens, so a piece stands alone."""
        tokens = self.lines([p.decode() for p in pieces])
        code: dict[str, int] = {}
        at = np.fromiter((code.setdefault(t, len(code)) for t in tokens), np.int64, len(tokens))
        words = [w for w in code if w != "\n" and w not in self.added]
        merged, counts = self.merge_words(words)
        fixed = [code[w] for w in self.added if w in code]
        length, start = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        mine = np.array([code[w] for w in words], np.int64)
        length[mine], start[mine] = counts, np.cumsum(counts) - counts
        length[fixed], start[fixed] = 1, len(merged) + np.arange(len(fixed))
        merged = np.r_[merged, [self.added[w] for w in self.added if w in code]].astype(np.int32)
        upto = np.cumsum(length[at])[at == code["\n"]]
        runs = np.diff(np.r_[0, upto])
        self.place.update(zip(pieces, range(len(self.place), len(self.place) + len(pieces))))
        self.starts = np.r_[self.starts, len(self.flat) + upto - runs]
        self.lengths = np.r_[self.lengths, runs]
        self.flat = np.r_[self.flat, merged[ragged(start[at], length[at])]]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has. A null is an empty text."""
        pieces = [(t or "").encode().split() for t in texts]
        if len(self.place) > self.KEPT:
            self.forget()
        new = set().union(*pieces).difference(self.place)
        if new:
            self.learn(sorted(new))
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(pieces)), np.int64, sum(map(len, pieces)))
        ids = self.flat[ragged(self.starts[at], self.lengths[at])]
        each = np.r_[0, np.cumsum(self.lengths[at])]
        upto = np.cumsum([len(mine) for mine in pieces])
        return ids, np.diff(np.r_[0, each[upto]])

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, as the library does for a vocabulary without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """Add the token ids of each text as an array of int.

    The whole text is encoded; a null text is an empty one and has no tokens.
    Every row is kept as it is, repeated ones too; ``ids`` is refused if it is taken.
    """
    refuse([ids], docs.columns)
    path = path or public_tokenizers.path(VOCABULARY)
    schema = T.StructType([*docs.schema, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_runs(whole, text):
                flat, counts = encoder(path).encode(batch[text].to_pylist())
                arrays = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, arrays], [*batch.schema.names, ids])
        encoder(path).forget()  # the worker may serve another job next

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the text that the ids stand for; null ids give an empty text."""
    refuse([text], docs.columns)
    path = path or public_tokenizers.path(VOCABULARY)
    schema = T.StructType([*docs.schema, T.StructField(text, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [encoder(path).decode(x or []) for x in part[ids].to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, text])
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document, and the ids if asked for."""
    coded = decode(encode(docs.select("doc_id", "text"), path=path).drop("text"), path=path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        *(["ids"] if keep_ids else []),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
