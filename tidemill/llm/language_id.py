"""Operator 3: language identification by nearest clustered centroids.

A text becomes counts of its byte 2-, 3- and 4-grams (lower case, letters only),
hashed into ``SLOTS`` slots, weighted by 1 + log(count) and inverse document
frequency, at length 1. Every language has ``CLUSTERS`` centroids, from spherical
k-means over a bounded sample of its labelled texts; document frequencies are
counted over all labelled texts. A text gets the language of the centroid with
the highest cosine. It is rejected if that is below what texts of its length in
that language have: ``SLACK`` times the median of pieces of that length, which are cut
from the language's own sample; so there is a cut at every length, however long the texts are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import refuse, table, text_runs

SLOTS = 1 << 13
SIZES = (2, 3, 4)
CLUSTERS = 4
#: Labelled texts a language's centroids are fitted on, at most, chosen by a hash.
SAMPLE = 2_000
BANDS = 24
#: Sampled texts a language that pieces are cut from, at most, and pieces of a band that make a cut, at least.
CUT_TEXTS, BAND_PIECES = 300, 5
SLACK = 0.4
UNKNOWN = "und"
_CHUNK = 1 << 20
#: ASCII that is no letter becomes a space; other bytes stay.
_LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def grams(text: str) -> np.ndarray:
    """Counts of a text's byte n-grams by slot."""
    raw = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    flat = np.frombuffer(raw, np.uint8)
    counts = np.zeros(SLOTS, np.float32)
    for a in range(0, len(flat), _CHUNK):
        for n in SIZES:
            part = flat[a : a + _CHUNK + n - 1].astype(np.uint32)
            size = len(part) - n + 1
            if size <= 0:
                continue
            code = part[:size].copy()
            for i in range(1, n):
                code <<= np.uint32(8)
                code |= part[i : size + i]
            code = (code + np.uint32(n)) * np.uint32(2654435761)
            counts += np.bincount(code >> np.uint32(32 - 13), minlength=SLOTS).astype(np.float32)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as unit vectors."""
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def band(counts: np.ndarray) -> np.ndarray:
    """Band of a text's length, by powers of two of its n-grams."""
    return np.minimum(np.log2(counts.sum(axis=1) + 1).astype(np.int64), BANDS - 1)


def cluster(x: np.ndarray, k: int = CLUSTERS, turns: int = 12) -> np.ndarray:
    """Spherical k-means. Starts from the row nearest the mean, then from the row farthest from all so far."""
    start = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(start) < min(k, len(x)):
        start.append(int(np.argmin((x @ x[start].T).max(axis=1))))
    centres = x[start]
    for _ in range(turns):
        near = np.argmax(x @ centres.T, axis=1)
        sums = np.stack([x[near == i].sum(axis=0) if (near == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


@dataclass
class Model:
    """Languages (sorted), inverse document frequencies, centroids with their language, and cuts by language and band."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    cuts: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1), and whether the text is rejected."""
        langs, score, out = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not self.languages:
            out[known] = False
            return langs, score, out
        for a in range(0, len(known), 128):
            rows = known[a : a + 128]
            counts = np.stack([grams(texts[i]) for i in rows])
            cosine = weighted(counts, self.idf) @ self.centroids.T
            best = np.stack([cosine[:, self.owner == l].max(axis=1) for l in range(len(self.languages))], axis=1)
            lang = np.argmax(best, axis=1)
            top = best[np.arange(len(rows)), lang]
            for i, l in zip(rows, lang.tolist()):
                langs[i] = self.languages[l]
            score[rows] = np.clip(top, 0, 1)
            out[rows] = top < self.cuts[lang, band(counts)]
        return langs, score, out


def _cuts(texts: list[str], idf: np.ndarray, centroids: np.ndarray) -> list[float]:
    """Cut of each band of lengths, from pieces of that length out of the middles of the texts; NaN where too few are as long."""
    out = []
    for b in range(BANDS):
        size = max(1, round(2 ** (b + 0.5) / len(SIZES)))  # about one n-gram of each size a character
        middles = [(t, (len(t) - size) // 2) for t in texts if len(t) >= size]
        pieces = [t[a : a + size] for t, a in middles if any(map(str.isalpha, t[a : a + size]))]
        found = [float((weighted(grams(p)[None], idf) @ centroids.T).max()) for p in pieces]
        out.append(SLACK * float(np.median(found)) if len(found) >= BAND_PIECES else np.nan)
    return out


def _filled(cuts: np.ndarray) -> np.ndarray:
    """Cuts by language and band, where NaN becomes the other languages' median in the band, or else the nearest band's."""
    for b in range(cuts.shape[1]):
        known = cuts[:, b][~np.isnan(cuts[:, b])]
        if len(known):
            cuts[:, b] = np.where(np.isnan(cuts[:, b]), np.median(known), cuts[:, b])
    full = np.flatnonzero(~np.isnan(cuts[0])) if len(cuts) else []
    if not len(full):
        return np.zeros_like(cuts)
    return cuts[:, [int(full[np.argmin(abs(full - b))]) for b in range(cuts.shape[1])]]


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows with a text and a language; rows without either are left out.

    Collected are SLOTS counts, and per language its centroids and cuts.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SLOTS, np.int64), 0
        for whole in batches:
            for t in whole[text].to_pylist():
                total += grams(t) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[0, np.arange(1, SLOTS + 1)]), pa.array(np.r_[n, total])], ["slot", "n"])

    counted = rows.select(text).mapInArrow(frequencies, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(SLOTS + 1)
    for r in counted:
        df[r["slot"]] = r["n"]
    idf = np.log((1 + df[0]) / (1 + df[1:])).astype(np.float32) + 1

    # The sample is chosen on hashes; texts of other rows don't move. Rows are ranked only among
    # the low hashes of which twice as many as needed are expected, however many rows a language has.
    order = F.xxhash64(key, text)
    sizes = rows.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    share = sizes.select("lang", (2.0 * SAMPLE / F.col("n")).alias("share"))
    hashed = rows.select(F.col(lang).alias("lang"), order.alias("h"))
    low = hashed.join(F.broadcast(share), "lang").where((F.col("h") / float(1 << 64) + 0.5) < F.col("share"))
    ranked = low.withColumn("rn", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    last = {r["lang"]: r["h"] for r in ranked.where(F.col("rn") <= SAMPLE).groupBy("lang").agg(F.max("h").alias("h")).collect()}
    if not last:
        return Model([], idf, np.zeros((0, SLOTS), np.float32), np.zeros(0, np.int64), np.zeros((0, BANDS)))
    bound = F.create_map(*[F.lit(x) for pair in sorted(last.items()) for x in pair])
    sample = rows.where(order <= F.try_element_at(bound, F.col(lang))).select(F.col(lang).alias("lang"), order.alias("h"), F.col(text).alias("text"))

    def centres(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "text"])
        x = np.empty((len(frame), SLOTS), np.float32)
        for a in range(0, len(frame), 128):  # so that the sample is held once, as weights
            counts = np.stack([grams(t) for t in frame["text"].iloc[a : a + 128]])
            x[a : a + 128] = weighted(counts, idf)
        found = cluster(x)
        cuts = _cuts(frame["text"].iloc[:CUT_TEXTS].tolist(), idf, found)
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "centroids": [found.ravel().tolist()], "cuts": [cuts]})

    fitted = sample.groupBy("lang").applyInPandas(centres, "lang string, centroids array<float>, cuts array<double>").collect()
    fitted = sorted(fitted, key=lambda r: r["lang"])
    blocks = [np.array(r["centroids"], np.float32).reshape(-1, SLOTS) for r in fitted]
    owner = np.repeat(np.arange(len(blocks)), [len(b) for b in blocks])
    return Model([r["lang"] for r in fitted], idf, np.concatenate(blocks), owner, _filled(np.array([r["cuts"] for r in fitted], float)))


_ADDED = {"lang_pred": (T.StringType(), pa.string()), "score": (T.DoubleType(), pa.float64()), "rejected": (T.BooleanType(), pa.bool_())}


def predict(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str, str] = tuple(_ADDED)) -> DataFrame:
    """Add language, score (cosine, 0 to 1) and whether the text is rejected; names that are taken are refused.

    A text that is null or has no letter is `und`, with score 0, and rejected. If
    nothing was learned, every text is `und` with score 0, and only those without
    a letter are rejected. Of equal cosines the first language in
    the alphabet wins. Every row is kept, repeated ones too.
    """
    refuse(names, docs.columns)
    kinds = list(_ADDED.values())
    schema = T.StructType([*docs.schema, *[T.StructField(n, k, False) for n, (k, _) in zip(names, kinds)]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_runs(whole, text):
                added = shared.value.predict(batch[text].to_pylist())
                columns = [pa.array(v, k) for v, (_, k) in zip(added, kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    found = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")
