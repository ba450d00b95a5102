"""Operator 9: token counts with a whole-token shortcut."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.bpe_rounds import MergeTable
from tidemill.llm.common import refuse, table, text_runs

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
MARK = "▁"


class Counter:
    """Counts tokens of a piece vocabulary with byte fallback.

    A text gets a space in front, and spaces are marks. No vocabulary string has
    a mark after another character, and none of more than one character has a
    line break (both checked on loading), so no merge crosses the pre-tokens
    below and each is counted alone. ``whole`` holds the vocabulary strings
    proven, by merging each alone, to end as one token. A pre-token found there
    counts 1; only others are merged. Characters outside the vocabulary count
    their UTF-8 bytes.
    """

    KEPT = 250_000
    PARTS = re.compile(rb" *[^ \n]+| +|\n")

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = {
            model.id_to_piece(i): -model.get_score(i)
            for i in range(size)
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))
        }
        long = [p for p in plain if len(p) > 1]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in long):
            raise ValueError("a vocabulary string crosses the bounds of pre-tokens")
        symbols = {s: i for i, s in enumerate(dict.fromkeys([*plain, *"".join(plain)]))}
        code = np.arange(0x110000)
        self.chars = -1 - (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        for s, i in symbols.items():
            if len(s) == 1:
                self.chars[ord(s)] = i
        self.piece = np.array([s in plain for s in symbols] + [False])
        self.bytes = np.array([len(s.encode()) for s in symbols])
        splits = [(p[:i], p[i:], p) for p in long for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols]
        self.table = MergeTable(
            [symbols[a] for a, _, _ in splits], [symbols[b] for _, b, _ in splits],
            [round(plain[p]) for _, _, p in splits], [symbols[p] for _, _, p in splits],
        )
        strings = [p.replace(MARK, " ").encode() for p in plain]
        self.whole = {s for s, n in zip(strings, self.merge(strings)) if n == 1}
        self.seen: dict[bytes, int] = {}

    def merge(self, parts: list[bytes]) -> list[int]:
        """Tokens of each pre-token, by merge rounds."""
        if not parts:
            return []
        texts = [p.decode() for p in parts]
        points = np.frombuffer("".join(texts).replace(" ", MARK).encode("utf-32-le"), np.uint32)
        merged, counts = self.table.merge(self.chars[points], np.array([len(t) for t in texts]))
        known = np.maximum(merged, 0)
        tokens = np.where(merged < 0, -1 - merged, np.where(self.piece[known], 1, self.bytes[known]))
        return np.add.reduceat(tokens, np.cumsum(counts) - counts).tolist()

    def count(self, texts: list[str | None]) -> list[int]:
        found = [self.PARTS.findall(b" " + t.encode().replace(MARK.encode(), b" ")) if t else [] for t in texts]
        if len(self.seen) > self.KEPT:
            self.seen = {}
        new = list(set().union(*found).difference(self.whole).difference(self.seen))
        self.seen.update(zip(new, self.merge(new)))
        whole, seen = self.whole, self.seen
        return [sum([1 if p in whole else seen[p] for p in mine]) for mine in found]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, text: str = "text", name: str = "n_tokens", path: str | None = None) -> DataFrame:
    """Add the number of tokens of each whole text; a null text is empty and has none.

    Every row is kept as it is, repeated ones too; ``name`` is refused if it is taken.
    """
    refuse([name], docs.columns)
    path = path or public_tokenizers.path(VOCABULARY)
    schema = T.StructType([*docs.schema, T.StructField(name, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_runs(whole, text):
                counts = pa.array(counter(path).count(batch[text].to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*batch.schema.names, name])
        counter(path).seen.clear()  # the worker may serve another job next

    return docs.mapInArrow(run, schema)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return count_tokens(size).drop("text").withColumn("over_limit", F.col("n_tokens") > LIMIT)
