"""Operator 13: collocation mining by sorted occurrence relations (SETM).

The texts are dealt into blocks of about ``BLOCK_BYTES`` of text, as they are read.
The relation of level k has the place and the phrase of every occurrence of k words
in a piece, sorted by block and place; each piece's end takes a place of its own, so
that neighbours in a piece are neighbours in the numbering. It is kept as a written
table with one row of arrays per block. Going from level k to k + 1:

1. Merge-join and group-count: a block's relation is joined with itself at the next
   place; how often each pair comes is summed over all blocks. Pairs that come often
   enough are the phrases of the next level, which are numbered and written. Both ends
   of a frequent phrase are frequent, so nothing is lost.
2. Semi-join: the numbers go back to the blocks that have the phrase, and only
   occurrences of numbered phrases are written as the next relation.

Counts of phrases are exact: words are compared as strings, phrases by the
numbers of the two phrases they are made of.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemill.llm.common import shuffles_dropped, table, text_runs
from tidemill.operators.scale import top_per_key
from tidemill.session import discard, materialise

LEAST = 100
LONGEST = 5
TOP = 2000
#: Text bytes of a block.
BLOCK_BYTES = 1 << 19
#: Frequent phrases are broadcast to the groups up to this many (a few dozen bytes each); more take a shuffle join.
BROADCAST_PHRASES = 500_000

_ZSTD = pa.Codec("zstd", compression_level=3)
_END = b"."
_TABLE = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
#: Steps from place to place, and which of the block's phrases is at each. Arrays are packed: Spark only carries them.
_RELATION = [("block", pa.int64()), ("steps", pa.binary()), ("members", pa.binary())]
_WORDS = pa.schema([*_RELATION, ("langs", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())), ("words", pa.binary())])
_PHRASES = pa.schema([*_RELATION, ("ids", pa.binary())])
#: How often a block has a phrase, which has a number there.
_GROUP = [("block", pa.int64()), ("member", pa.int32()), ("n", pa.int64())]
_WORD_GROUPS = pa.schema([*_GROUP, ("lang", pa.string()), ("word", pa.string())])
_PAIR_GROUPS = pa.schema([*_GROUP, ("head", pa.int64()), ("tail", pa.int64())])


class _Numbers(dict):
    """A number for each word of one language, from a counter that languages share."""

    def __init__(self, words: list[bytes]):
        self.words = words

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        return n


def _packed(values: np.ndarray | bytes, kind: type = np.int32) -> bytes:
    """Compressed bytes, with their number in front; of an array, all lowest bytes come first, then the next ones."""
    if isinstance(values, bytes):
        data = values
    else:
        data = np.ascontiguousarray(values, kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def _bytes(cell: bytes) -> bytes:
    return _ZSTD.decompress(cell[8:], int.from_bytes(cell[:8], "little"), asbytes=True)


def _array(cell: bytes, kind: type = np.int32) -> np.ndarray:
    planes = np.frombuffer(_bytes(cell), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _row(schema: pa.Schema, block: int, places: np.ndarray, members: np.ndarray, *more) -> pa.RecordBatch:
    """A block's relation."""
    cells = [block, _packed(np.diff(places, prepend=0)), _packed(members), *more]
    return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, schema)], schema=schema)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The occurrences of single words, block by block, with the words that each block has of each language."""
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    for whole in batches:
        for batch in text_runs(whole, "text", BLOCK_BYTES):
            words, places, found = [], [], []
            by_lang: dict[str, _Numbers] = {}
            at = 0
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                tokens = text.encode().lower().translate(_TABLE).replace(b".", b" . ").split()
                numbers = by_lang.setdefault(lang, _Numbers(words))
                mine = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
                inside = np.flatnonzero(mine != numbers.get(_END, -1))
                places.append(inside + at)
                found.append(mine[inside])
                at += len(tokens) + 1
            for numbers in by_lang.values():
                numbers.pop(_END, None)
            order = np.fromiter((n for numbers in by_lang.values() for n in numbers.values()), np.int64)
            member = np.empty(len(words), np.int64)
            member[order] = np.arange(len(order))
            vocabulary = b"\n".join([w for numbers in by_lang.values() for w in numbers])
            yield _row(
                _WORDS, block, np.concatenate(places), member[np.concatenate(found)],
                list(by_lang), [len(numbers) for numbers in by_lang.values()], _packed(vocabulary),
            )
            block += 1


def _word_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            size = sum(row["sizes"])
            if not size:
                continue
            words = pa.array(_bytes(row["words"]).decode().split("\n"), pa.string())
            langs = pa.array(np.repeat(np.array(row["langs"], object), row["sizes"]), pa.string())
            counts = np.bincount(_array(row["members"]), minlength=size)
            own = [pa.array(x) for x in (np.full(size, row["block"]), np.arange(size, dtype=np.int32), counts)]
            yield pa.RecordBatch.from_arrays([*own, langs, words], schema=_WORD_GROUPS)


def _joined(steps: bytes, members: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A relation merge-joined with itself at the next place: the places of all pairs, which
    distinct pair is at each, how often that comes, and its two phrases' numbers in the block."""
    places, member = np.cumsum(_array(steps), dtype=np.int64), _array(members).astype(np.int64)
    at = np.flatnonzero(np.diff(places) == 1)
    size = int(member.max(initial=0)) + 1
    pairs, joined, counts = np.unique(member[at] * size + member[at + 1], return_inverse=True, return_counts=True)
    return places[at], joined, counts, *np.divmod(pairs, size)


def _pair_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            _, _, counts, head, tail = _joined(row["steps"], row["members"])
            ids, own = _array(row["ids"], np.int64), np.full(len(counts), row["block"])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own, np.arange(len(counts), dtype=np.int32), counts, ids[head], ids[tail])], schema=_PAIR_GROUPS)


def _kept(words: bool):
    """Semi-join of a block's occurrences, of words or of pairs, with its frequent ones."""

    def keep(key: tuple[pa.Scalar, ...], relation: pa.Table, frequent: pa.Table) -> pa.Table:
        if not len(relation) or not len(frequent):
            return _PHRASES.empty_table()
        steps, members = relation["steps"][0].as_py(), relation["members"][0].as_py()
        if words:
            places, member = np.cumsum(_array(steps), dtype=np.int64), _array(members)
        else:
            places, member = _joined(steps, members)[:2]
        order = np.argsort(np.asarray(frequent["member"]))
        place = np.full(int(member.max()) + 1, -1, np.int64)
        place[np.asarray(frequent["member"])[order]] = np.arange(len(order))
        left = np.flatnonzero(place[member] >= 0)
        ids = _packed(np.asarray(frequent["id"])[order], np.int64)
        return pa.Table.from_batches([_row(_PHRASES, key[0].as_py(), places[left], place[member[left]], ids)])

    return keep


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that come at least ``least`` times in a language, and the
    number of words of each language.

    The first has lang, words (array), heads and tails: how often the first 1, 2, ... and the
    last 1, 2, ... words of the phrase come; the last of both is the phrase's own count.
    Repeated rows count each; null and empty texts have no words; a null language is ``und``.
    """
    spark = docs.sparkSession
    plain = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    with shuffles_dropped(spark):
        now = materialise(plain.mapInArrow(_words, from_arrow_schema(_WORDS)))
        groups, by = now.mapInArrow(_word_groups, from_arrow_schema(_WORD_GROUPS)), ["lang", "word"]
        counts = materialise(groups.groupBy(*by).agg(F.sum("n").alias("n")))
        totals = materialise(counts.groupBy("lang").agg(F.sum("n").alias("total")))
        known, levels = materialise(counts.where(F.col("n") >= least).withColumn("id", F.monotonically_increasing_id())), []
        discard(counts)
        while True:
            if by == ["lang", "word"]:
                found = known.select("id", "lang", F.array("word").alias("words"), F.array("n").alias("heads"), F.array("n").alias("tails"))
            else:
                a, b = levels[-1].alias("a"), levels[-1].alias("b")
                both = known.alias("k").join(a, F.col("k.head") == F.col("a.id")).join(b, F.col("k.tail") == F.col("b.id"))
                found = both.select(
                    "k.id", "a.lang", F.concat("a.words", F.slice("b.words", -1, 1)).alias("words"),
                    F.concat("a.heads", F.array("k.n")).alias("heads"), F.concat("b.tails", F.array("k.n")).alias("tails"),
                )
            levels.append(materialise(found))
            few = known.count()
            if len(levels) == longest or not few:
                break
            asked = known.select(*by, "id")
            back = groups.join(F.broadcast(asked) if few <= BROADCAST_PHRASES else asked, by).select(F.col("block").alias("to"), "member", "id")
            relations = now.select("block", "steps", "members").groupBy("block")
            after = materialise(relations.cogroup(back.groupBy("to")).applyInArrow(_kept(words=by == ["lang", "word"]), from_arrow_schema(_PHRASES)))
            discard(now, known)
            now = after
            groups, by = now.mapInArrow(_pair_groups, from_arrow_schema(_PAIR_GROUPS)), ["head", "tail"]
            sums = groups.groupBy(*by).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
            known = materialise(sums.withColumn("id", F.monotonically_increasing_id()))
        discard(now, known)
        every = levels[0]
        for level in levels[1:]:
            every = every.unionByName(level)
        out = materialise(every.drop("id"))
        discard(*levels)
    return out, totals


def score(a: str, n: str, left: str, right: str) -> Column:
    """1000 a n / (left right), rounded down; the products are exact beyond 64 bits."""
    wide = lambda c: f"cast({c} as decimal(18,0))"
    return F.expr(f"cast(1000 * {wide(a)} * {wide(n)} div ({wide(left)} * {wide(right)}) as bigint)")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, share: int = 100
) -> DataFrame:
    """lang, phrase, a (how often it comes), l, r, n and score of each phrase of two or more words.

    Words are runs of characters other than space and tab in pieces, which end at
    ``. , ; : ! ?`` and line ends; A to Z are lower-cased. The score is 1000 a n / (l r),
    rounded down, for the phrase's weakest cut into a first part that comes l and a rest
    that comes r times, n being the language's words. A phrase inside a longer one that
    comes at least ``share`` per cent as often is left out; as the ones between come no less
    often than the longer one, it is enough to look at phrases of one word more.
    """
    found, totals = frequent_phrases(docs, text, lang, least, longest)
    size = F.size("words")
    phrases = found.where(size > 1).withColumn("a", F.element_at("heads", -1))
    longer = phrases.where(size > 2).select("lang", "a", F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("words"))
    longer = longer.groupBy("lang", "words").agg(F.max("a").alias("around"))
    kept = phrases.join(longer, ["lang", "words"], "left").where(F.col("around").isNull() | (100 * F.col("around") < share * F.col("a")))
    cuts = F.transform(
        F.sequence(F.lit(1), size - 1),
        lambda k: F.struct(F.element_at("heads", k).alias("l"), F.element_at("tails", size - k).alias("r"), k.alias("k")),
    )
    each = kept.join(totals.withColumnRenamed("total", "n"), "lang").select("lang", F.array_join("words", " ").alias("phrase"), "a", "n", F.inline(cuts))
    scored = each.withColumn("score", score("a", "n", "l", "r"))
    least_cut = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return scored.groupBy("lang", "phrase", "a", "n").agg(least_cut).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of each language."""
    scored = collocations(table(spark, sf_dir, "documents"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    top = top_per_key(scored, ["lang"], order, TOP)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))


SQL = r"""
with pieces as (select coalesce(lang, 'und') as lang, doc_id, unnest(ps) as piece, unnest(range(len(ps))) as pi from (
         select lang, doc_id, regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]') as ps from documents where text is not null)),
     lists as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as k from pieces),
     totals as (select lang, sum(len(k)) as n from lists group by 1),
     phrases as (select lang, k[i:i+m-1] as w, count(*) as f from (
         select lang, k, m, unnest(range(1, len(k) - m + 2)) as i from lists, range(1, 6) t(m)) group by 1, 2),
     frequent as (select * from phrases where f >= 100),
     candidates as (select lang, w, f, row_number() over () as id from frequent where len(w) > 1),
     inside as (select lang, w[i:j] as w, max(f) as f from (
         select lang, w, f, i, unnest(range(i + 1, least(i + len(w) - 1, len(w) + 1))) as j from (
             select lang, w, f, unnest(range(1, len(w))) as i from candidates)) where j - i + 1 < len(w) group by 1, 2),
     kept as (select c.* from candidates c left join inside i on c.lang = i.lang and c.w = i.w where i.f is null or 100 * i.f < 100 * c.f),
     cuts as (select lang, id, w, f, unnest(range(1, len(w))) as k from kept),
     scored as (select c.lang, id, c.w, c.f as a, k, x.f as l, y.f as r, t.n, (1000::hugeint * c.f * t.n) // (x.f::hugeint * y.f) as score
         from cuts c join totals t using (lang)
         join frequent x on x.lang = c.lang and x.w = c.w[1:k] join frequent y on y.lang = c.lang and y.w = c.w[k+1:len(c.w)]),
     best as (select * from scored qualify row_number() over (partition by id order by score, k) = 1),
     named as (select lang, array_to_string(w, ' ') as phrase, a, l, r, n, score from best)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
       a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from named qualify rank <= 2000"""
