"""Text operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.scale import attach, literal_rows
from tidemill.session import discard, materialise, shuffles_dropped

# The token rule of this package: runs of letters and digits, or one other visible character.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


#: Text bytes of a partition whose tokens are worked on, at most.
PLACED_BYTES = 128 << 20


def placed(df: DataFrame, key: str, text: str, *cols: str) -> DataFrame:
    """Spread documents by key before their tokens are exploded.

    Whole texts are shuffled once; counting or regrouping per document then needs
    no shuffle of its many tokens, and long inputs are not stuck in one split. The
    stated width keeps AQE from merging partitions: texts are small before their
    tokens are made, and the work is in the tokens. It is the session's, or follows
    the bytes of text where these need more.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(key, text, *cols).repartition(max(width, ceil(size / PLACED_BYTES)), key)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly by size, so that few large splits feed all cores; Spark chooses the number."""
    return df.hint("rebalance")


def tokenize(df: DataFrame, key: str, text: str, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """(key, tokens): lower-cased tokens of the whole text, in order."""
    return df.select(key, F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), F.lit(0)).alias("tokens"))


def words(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, tokens): the text cut at white space."""
    return df.select(key, F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "").alias("tokens"))


def token_counts(tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """(token, n) over the corpus; combined map-side, so frequent words do not pile up."""
    return each_token(tokens, col).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def each_token(tokens: DataFrame, col: str = "tokens", *keep: str) -> DataFrame:
    """One row per token. The outer form keeps the optimizer from testing the array
    for emptiness, that is tokenising a second time, ahead of the shuffle."""
    return tokens.select(*keep, F.explode_outer(col).alias("token")).where(F.col("token").isNotNull())


def build_vocab(counts: DataFrame, max_vocab: int = 30_000, min_freq: int = 1, specials: Sequence[str] = ("_unk_", "_pad_")) -> DataFrame:
    """(id, token, n): specials first, then tokens by falling frequency.

    Tokens must occur more than ``min_freq`` times; ties go by token. The result
    has at most ``max_vocab`` + specials rows, so numbering it in one task is safe.
    """
    spark = counts.sparkSession
    top = counts.orderBy(F.desc("n"), F.col("token")).limit(max_vocab).where(F.col("n") > min_freq)
    w = Window.orderBy(F.desc("n"), F.col("token"))
    ids = top.withColumn("id", (F.row_number().over(w) + (len(specials) - 1)).cast("bigint")).select("id", "token", "n")
    head = literal_rows(spark, [(i, s, 0) for i, s in enumerate(specials)], "id bigint, token string, n bigint")
    return head.unionByName(ids)


def to_ids(tokens: DataFrame, key: str, vocab: DataFrame, unk: int = 0, eos: int | None = None) -> DataFrame:
    """(key, ids): token ids in order, unknown tokens as ``unk``.

    The vocabulary is bounded by its own size limit and is broadcast. With
    documents ``placed`` by key, the explode and the regroup run in one stage.
    """
    exploded = tokens.select(key, F.posexplode_outer("tokens").alias("_pos", "_token"))
    table = vocab.select(F.col("token").alias("_token"), F.col("id").alias("_id"))
    coded = exploded.join(F.broadcast(table), "_token", "left")
    item = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("_id", F.lit(unk)).alias("_id")))
    ids = F.transform(F.sort_array(F.collect_list(item)), lambda s: s["_id"])
    if eos is not None:
        ids = F.concat(ids, F.array(F.lit(eos).cast("bigint")))
    return coded.groupBy(key).agg(ids.alias("ids"))


def remap(vocab_a: DataFrame, vocab_b: DataFrame) -> DataFrame:
    """(id, token, old_id) for every token of ``a``; old_id -1 where ``b`` lacks it."""
    old = vocab_b.select("token", F.col("id").alias("old_id"))
    return vocab_a.join(old, "token", "left").select("id", "token", F.coalesce("old_id", F.lit(-1)).alias("old_id"))


def char_vocab(df: DataFrame, text: str) -> DataFrame:
    """(id, ch, n): distinct characters in order; the alphabet is small by nature."""
    chars = df.select(F.explode(F.filter(F.split(F.col(text), ""), lambda c: c != "")).alias("ch"))
    counts = chars.groupBy("ch").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("id", F.row_number().over(Window.orderBy("ch")).cast("bigint"))


def _with_grams(tokens: DataFrame, hi: int) -> tuple[DataFrame, list[str]]:
    """The rows with a column per length up to ``hi`` that holds a text's n-grams, and these columns' names.

    Each length is built from the one before by adding the next word.
    """
    df, names = tokens, ["tokens"]
    for n in range(2, hi + 1):
        rest = F.greatest(F.size("tokens") - (n - 1), F.lit(0))
        longer = F.zip_with(
            F.slice(F.col(names[-1]), F.lit(1), rest), F.slice(F.col("tokens"), F.lit(n), rest),
            lambda head, word: F.concat(head, F.lit(" "), word),
        )
        names.append(f"_g{n}")
        df = df.withColumn(names[-1], longer)
    return df, names


def gram_lists(tokens: DataFrame, key: str, lo: int = 1, hi: int = 1, *keep: str) -> DataFrame:
    """(key, terms): all n-grams of ``lo`` to ``hi`` words of a text, joined by a blank; and the columns to keep."""
    df, names = _with_grams(tokens, hi)
    out = names[lo - 1 :]
    return df.select(key, *keep, (F.concat(*out) if len(out) > 1 else F.col(out[0])).alias("terms"))


def grams(tokens: DataFrame, key: str, lo: int = 1, hi: int = 1) -> DataFrame:
    """(key, term): one row per n-gram."""
    lists = gram_lists(tokens, key, lo, hi)
    return lists.select(key, F.explode_outer("terms").alias("term")).where(F.col("term").isNotNull())


def term_counts(
    tokens: DataFrame, key: str, lo: int = 1, hi: int = 1, binary: bool = False, vocab: DataFrame | None = None
) -> DataFrame:
    """(key, term, n): n-gram counts per document, optionally of the terms of ``vocab`` only.

    ``vocab`` (column ``term``) is bounded by its max_features; it is broadcast and
    thins the n-grams before they are counted.
    """
    all_grams = grams(tokens, key, lo, hi)
    if vocab is not None:
        all_grams = all_grams.join(F.broadcast(vocab.select("term")), "term", "left_semi")
    counts = all_grams.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("n", F.lit(1).cast("bigint")) if binary else counts


def corpus_terms(tokens: DataFrame, key: str, lo: int = 1, hi: int = 1) -> DataFrame:
    """(term, total, df): occurrences and documents per n-gram; one row of ``tokens`` per document.

    The n-grams of a text are sorted within its row, where a term that differs from
    the one before it counts a document. That spares grouping by (key, term), whose
    groups are nearly as many as the n-grams.
    """
    ordered = gram_lists(tokens, key, lo, hi).select(F.sort_array("terms").alias("terms"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.col("terms"))
    marked = F.arrays_zip(F.col("terms").alias("term"), F.slice(before, F.lit(1), F.size("terms")).alias("before"))
    each = ordered.select(F.explode_outer(marked).alias("t")).where(F.col("t.term").isNotNull())
    new = F.when(~F.col("t.term").eqNullSafe(F.col("t.before")), 1).otherwise(0).cast("bigint")
    return each.groupBy(F.col("t.term").alias("term")).agg(F.count(F.lit(1)).alias("total"), F.sum(new).alias("df"))


#: N-grams of a table that are all counted at once, at most; of larger tables, a length at a time.
AT_ONCE = 20_000_000


def frequent_terms(tokens: DataFrame, key: str, lo: int = 1, hi: int = 1, max_features: int = 100_000, by: str = "total") -> DataFrame:
    """The terms of ``top_terms(corpus_terms(...))``, without counting all n-grams of a large table.

    A term comes no more often, and in no more texts, than its parts: the n-grams without its last and
    without its first word. So lengths are counted one after the other, and once ``max_features`` terms are known, only those
    n-grams are shuffled both of whose parts come at least as often as the last of these. Each length's
    shuffle goes before the next. No term is lost, and those that are kept are counted in full. Parts are broadcast; where more than
    twice ``max_features`` tie for the last place, all n-grams of the next length are counted. So are all lengths at once
    where a word holds a blank, as a term then does not tell its parts.
    """
    words = F.size("tokens")
    size = sum((F.greatest(words - (n - 1), F.lit(0)) for n in range(lo, hi + 1)), F.lit(0))
    size, blank = tokens.agg(F.sum(size.cast("bigint")), F.max(F.exists("tokens", lambda w: w.contains(" ")))).first()
    if (size or 0) <= AT_ONCE or blank or lo == hi:
        return top_terms(corpus_terms(tokens, key, lo, hi), max_features, by)
    found, parts, least = [], None, 0
    with shuffles_dropped(tokens.sparkSession):
        texts = materialise(tokens.select(key, "tokens"))
        for n in range(lo, hi + 1):
            counted = materialise(_of_length(texts, key, n, parts).where(F.col(by) >= least))
            found.append(counted)
            # Of a total of all n-grams, different values are at most the root of twice that many.
            sizes = _all(found).where(F.col(by) >= least).groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()
            left = max_features
            for value, many in sorted(((r[by], r["n"]) for r in sizes), reverse=True):
                left -= many
                if left <= 0:
                    least = value
                    break
            parts = counted.where(F.col(by) >= least).select("term") if left <= 0 else None
            if parts is not None and parts.count() > 2 * max_features:
                parts = None
        top = materialise(top_terms(_all(found).where(F.col(by) >= least), max_features, by))
        discard(texts, *found)
    return top


def _all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _of_length(texts: DataFrame, key: str, n: int, parts: DataFrame | None) -> DataFrame:
    """``corpus_terms`` of the n-grams of ``n`` words; of those only whose parts are among ``parts``, if these are given."""
    if parts is None:
        return corpus_terms(texts, key, n, n)
    df, names = _with_grams(texts, n)
    m, shorter = F.size(names[-1]), F.col(names[-2])
    terms = F.arrays_zip(F.col(names[-1]).alias("term"), F.slice(shorter, F.lit(1), m).alias("head"), F.slice(shorter, F.lit(2), m).alias("tail"))
    ordered = df.select(F.sort_array(terms).alias("terms"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.col("terms.term"))
    marked = F.arrays_zip(F.col("terms").alias("t"), F.slice(before, F.lit(1), F.size("terms")).alias("before"))
    each = ordered.select(F.explode_outer(marked).alias("m")).where(F.col("m.t.term").isNotNull())
    new = F.when(~F.col("m.t.term").eqNullSafe(F.col("m.before")), 1).otherwise(0).cast("bigint")
    each = each.select("m.t.*", new.alias("new"))
    for end in ("head", "tail"):
        each = each.join(F.broadcast(parts.withColumnRenamed("term", end)), end, "left_semi")
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("total"), F.sum("new").alias("df"))


def top_terms(terms: DataFrame, max_features: int, by: str = "total") -> DataFrame:
    """(term, total, df) of the most frequent terms; ties go by term."""
    return terms.orderBy(F.desc(by), F.col("term")).limit(max_features)


def nb_prior(labels: DataFrame, label: str) -> DataFrame:
    """One row: documents per class (n1, n0) and the log of their ratio (b)."""
    y = F.col(label) == 1
    docs = labels.agg(F.sum(y.cast("double")).alias("n1"), F.sum((~y).cast("double")).alias("n0"))
    return docs.withColumn("b", F.log(F.try_divide("n1", "n0")))


def nb_ratio(counts: DataFrame, labels: DataFrame, key: str, label: str, by_documents: bool = True) -> DataFrame:
    """(term, r, df): log-count ratio per term with add-one smoothing.

    The denominator is documents + 1 per class, or the class's total of smoothed
    counts. ``df`` is the number of documents that hold the term. Counts that have the label
    already are not joined to the labels.
    """
    y = F.col(label) == 1
    known = counts if label in counts.columns else counts.join(labels.select(key, label), key)
    per = known.groupBy("term").agg(
        F.sum(F.when(y, F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(~y, F.col("n")).otherwise(0)).alias("q"),
        F.count(F.lit(1)).alias("df"),
    )
    if by_documents:
        both = per.join(F.broadcast(nb_prior(labels, label)))
        r = F.log(((F.col("p") + 1) / (F.col("n1") + 1)) / ((F.col("q") + 1) / (F.col("n0") + 1)))
    else:
        totals = per.agg(F.sum(F.col("p") + 1).alias("sp"), F.sum(F.col("q") + 1).alias("sq"))
        both = per.join(F.broadcast(totals))
        r = F.log(((F.col("p") + 1) / F.col("sp")) / ((F.col("q") + 1) / F.col("sq")))
    return both.select("term", r.alias("r"), "df")


def nb_score(counts: DataFrame, model: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    """(key, score, predicted): sum of n * r plus b; positive means class 1.

    Frequent terms are handled by ``attach``; unknown terms add nothing.
    """
    uses = counts.groupBy("term").agg(F.count(F.lit(1)).alias("_n")).join(model.select("term", "r"), "term")
    scored = attach(counts, uses, ["term"], "_n")
    sums = scored.groupBy(key).agg(F.sum(F.col("n") * F.coalesce("r", F.lit(0.0))).alias("_s"))
    both = sums.join(F.broadcast(prior.select("b")))
    return both.select(key, (F.col("_s") + F.col("b")).alias("score"), (F.col("_s") + F.col("b") > 0).alias("predicted"))


def tfidf(tokens: DataFrame, key: str, lo: int = 1, hi: int = 1, max_features: int = 100_000) -> DataFrame:
    """(key, term, weight): n * (ln((1 + N) / (1 + df)) + 1), scaled to unit length.

    ``tokens`` has one row per document and is placed by key. The term table is
    bounded by ``max_features``; it is written once, broadcast, and thins the
    n-grams before they are counted again.
    """
    n_docs = tokens.agg(F.count(F.lit(1)).alias("n_docs"))
    terms = frequent_terms(tokens, key, lo, hi, max_features).join(F.broadcast(n_docs))
    idf = materialise(terms.select("term", (F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1).alias("idf")))
    hits = grams(tokens, key, lo, hi).join(F.broadcast(idf), "term")
    raw = hits.groupBy(key, "term").agg((F.count(F.lit(1)) * F.first("idf")).alias("w"))
    one_document = Window.partitionBy(key)  # bounded by the terms of a single text
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(one_document))
    return raw.select(key, "term", (F.col("w") / length).alias("weight"))


def length_buckets(tokens: DataFrame, key: str, width: int) -> DataFrame:
    """(key, n_tokens, bucket): documents of similar length share a bucket."""
    n = F.size("tokens")
    return tokens.select(key, n.alias("n_tokens"), F.floor(n / width).cast("bigint").alias("bucket"))


def hash_split(df: DataFrame, key: str, rate: float, seed: int = 42, out: str = "is_valid") -> DataFrame:
    """Repeatable random split: a row is held out by the hash of its key."""
    slot = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000))
    return df.withColumn(out, slot < int(rate * 1_000_000))


def md5_split(df: DataFrame, key: str, rate: float, out: str = "is_valid") -> DataFrame:
    """Like ``hash_split`` with a hash other engines share."""
    slot = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(out, slot < int(rate * 2**32))
