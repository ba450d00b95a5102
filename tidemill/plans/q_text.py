"""Queries for text, vector and box operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import strings
from tidemill.functions import vectors as V
from tidemill.operators import boxes as B
from tidemill.operators import approximate as X
from tidemill.operators import nearest as N
from tidemill.operators import text as T
from tidemill.operators.aggregates import argmax_group
from tidemill.plans.registry import query
from tidemill.session import materialise, scratch_dir

TOK = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+|[^\p{L}\p{N}\s]')"
WS = r"list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"


def doc_tokens(t):
    return T.tokenize(T.placed(t.documents, "doc_id", "text"), "doc_id", "text")


@query(
    "text_markers",
    """select doc_id, md5(chr(10) || 'xbos xfld 1 ' || source || ' xfld 2 ' || text) as marked_md5 from documents""",
)
def text_markers(t):
    return t.documents.select("doc_id", F.md5(strings.marked(F.col("source"), F.col("text"))).alias("marked_md5"))


@query("tokenize", f"select doc_id, len(k) as n_tokens, md5(array_to_string(k, ' ')) as tokens_md5 from (select doc_id, {TOK} as k from documents)")
def tokenize(t):
    k = T.tokenize(T.spread(t.documents.select("doc_id", "text")), "doc_id", "text")
    return k.select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.concat_ws(" ", "tokens")).alias("tokens_md5"))


def _vocab_cte(table: str, name: str = "", limit: int = 30000) -> str:
    return f"""c{name} as (select token, count(*) as n from (select unnest({TOK}) as token from {table}) group by 1),
        top{name} as (select * from (select * from c{name} order by n desc, token limit {limit}) where n > 1),
        v{name} as (select row_number() over (order by n desc, token) + 1 as id, token, n from top{name}
              union all select 0, '_unk_', 0 union all select 1, '_pad_', 0)"""


@query("build_vocab", f"with {_vocab_cte('documents')} select id, token, n from v")
def build_vocab(t):
    return T.build_vocab(T.token_counts(doc_tokens(t)))


@query(
    "tok2id",
    f"""with {_vocab_cte('documents')},
        x as (select doc_id, unnest(k) as token, unnest(range(len(k))) as pos from (select doc_id, {TOK} as k from documents)),
        j as (select doc_id, pos, coalesce(id, 0) as id from x left join v on x.token = v.token)
        select doc_id, count(*) + 1 as n_ids, md5(string_agg(id::varchar, ' ' order by pos) || ' 1') as ids_md5 from j group by 1""",
)
def tok2id(t):
    k = doc_tokens(t)
    ids = T.to_ids(k, "doc_id", T.build_vocab(T.token_counts(k)), unk=0, eos=1)
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.md5(F.concat_ws(" ", F.col("ids").cast("array<string>"))).alias("ids_md5"))


@query(
    "vocab_remap",
    f"""with {_vocab_cte('documents', 'd')}, {_vocab_cte('benchmark', 'b')},
        m as (select avg(embedding[1]::double) as x from embeddings)
        select vb.id, vb.token, coalesce(vd.id, -1) as old_id, round(coalesce(e.embedding[1]::double, m.x), 6) as x
        from vb cross join m left join vd on vb.token = vd.token left join embeddings e on e.vec_id = coalesce(vd.id, -1)""",
)
def vocab_remap(t):
    docs = T.build_vocab(T.token_counts(doc_tokens(t)))
    bench = T.build_vocab(T.token_counts(T.tokenize(t.benchmark, "item_id", "text")))
    rows = N.remap_vectors(T.remap(bench, docs), t.embeddings)
    return rows.select("id", "token", "old_id", F.round(F.col("embedding")[0], 6).alias("x"))


@query(
    "char_vocab",
    """with c as (select unnest(string_split(text, '')) as ch from benchmark)
       select hex(ch) as ch, n, row_number() over (order by hex(ch)) as id from (select ch, count(*) as n from c group by 1)""",
)
def char_vocab(t):
    return T.char_vocab(t.benchmark, "text").withColumn("ch", F.hex(F.col("ch").cast("binary")))


@query(
    "term_counts",
    f"""with x as (select doc_id, unnest({TOK}) as term from documents) select doc_id, count(*) as n_terms, max(n) as top_n,
        sum(n)::bigint as total from (select doc_id, term, count(*) as n from x group by 1, 2) group by 1""",
)
def term_counts(t):
    c = T.term_counts(doc_tokens(t), "doc_id")
    return c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.max("n").alias("top_n"), F.sum("n").alias("total"))


def _grams_sql(hi: int, tokens: str) -> str:
    parts = [
        f"select doc_id, array_to_string(k[i:i+{n - 1}], ' ') as term from (select doc_id, k, unnest(range(1, len(k) - {n - 2})) as i from k)"
        for n in range(1, hi + 1)
    ]
    return f"k as (select doc_id, {tokens} as k from documents), g as ({' union all '.join(parts)})"


@query(
    "ngram_counts",
    f"with {_grams_sql(3, TOK)} select term, count(*) as total, count(distinct doc_id) as df from g group by 1 order by total desc, term limit 5000",
)
def ngram_counts(t):
    return T.top_terms(T.corpus_terms(doc_tokens(t), "doc_id", 1, 3), 5000)


_NB = f"""x as (select doc_id, unnest({TOK}) as term from documents),
    c as (select doc_id, term, __N__ as n from x group by 1, 2),
    d as (select count(*) filter (where quality = 1)::double as n1, count(*) filter (where quality = 0)::double as n0 from labels),
    pq as (select term, sum(case when quality = 1 then n else 0 end) as p, sum(case when quality = 0 then n else 0 end) as q
           from c join labels using (doc_id) group by 1)"""


@query(
    "nb_ratio",
    f"with {_NB.replace('__N__', '1')} select term, round(ln(((p + 1) / (n1 + 1)) / ((q + 1) / (n0 + 1))), 6) as r, round(ln(n1 / n0), 6) as b from pq, d",
)
def nb_ratio(t):
    counts = T.term_counts(doc_tokens(t), "doc_id", binary=True)
    both = T.nb_ratio(counts, t.labels, "doc_id", "quality").join(F.broadcast(T.nb_prior(t.labels, "quality")))
    return both.select("term", F.round("r", 6).alias("r"), F.round("b", 6).alias("b"))


@query(
    "nb_ratio_tokens",
    f"""with {_NB.replace('__N__', 'count(*)')}, s as (select sum(p + 1)::double as sp, sum(q + 1)::double as sq from pq)
        select term, round(ln(((p + 1) / sp) / ((q + 1) / sq)), 6) as r from pq, s""",
)
def nb_ratio_tokens(t):
    counts = T.term_counts(doc_tokens(t), "doc_id")
    return T.nb_ratio(counts, t.labels, "doc_id", "quality", by_documents=False).select("term", F.round("r", 6).alias("r"))


@query(
    "nb_score",
    f"""with {_NB.replace('__N__', 'count(*)')}, m as (select term, ln(((p + 1) / (n1 + 1)) / ((q + 1) / (n0 + 1))) as r from pq, d)
        select doc_id, round(sum(n * coalesce(r, 0)) + (select ln(n1 / n0) from d), 4) as score,
               sum(n * coalesce(r, 0)) + (select ln(n1 / n0) from d) > 0 as predicted
        from c left join m using (term) group by 1""",
)
def nb_score(t):
    counts = materialise(T.term_counts(doc_tokens(t), "doc_id"))  # feeds the model and the scores
    model = T.nb_ratio(counts, t.labels, "doc_id", "quality")
    scored = T.nb_score(counts, model, T.nb_prior(t.labels, "quality"), "doc_id")
    return scored.withColumn("score", F.round("score", 4))


@query(
    "tfidf",
    f"""with {_grams_sql(5, WS)}, c as (select doc_id, term, count(*) as n from g group by 1, 2),
        s as (select term, sum(n) as total, count(*) as df from c group by 1 order by total desc, term limit 100000),
        w as (select doc_id, term, n * (ln((1.0 + (select count(*) from documents)) / (1.0 + df)) + 1) as w from c join s using (term)),
        l as (select doc_id, sqrt(sum(w * w)) as len from w group by 1)
        select doc_id, count(*) as n_terms, round(sum(w / len), 5) as total, round(max(w / len), 6) as top from w join l using (doc_id) group by 1""",
)
def tfidf(t):
    w = T.tfidf(T.words(T.placed(t.documents, "doc_id", "text"), "doc_id", "text"), "doc_id", 1, 5)
    return w.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.round(F.sum("weight"), 5).alias("total"), F.round(F.max("weight"), 6).alias("top")
    )


@query(
    "len_filter",
    f"select conv_id, turn, len({TOK}) as n_tokens from conversations where len({TOK}) < 30",
)
def len_filter(t):
    tok = T.tokenize(t.conversations.withColumn("k", F.struct("conv_id", "turn")), "k", "text")
    return tok.where(F.size("tokens") < 30).select("k.conv_id", "k.turn", F.size("tokens").alias("n_tokens"))


@query(
    "compose_text",
    "select page_id, md5('<url> ' || url || ' <html> ' || html) as text_md5 from pages",
)
def compose_text(t):
    return t.pages.select("page_id", F.md5(strings.composed(url=F.col("url"), html=F.col("html"))).alias("text_md5"))


@query(
    "hash_split",
    "select doc_id, ('0x' || substring(md5(doc_id::varchar), 1, 8))::bigint < 429496729 as is_valid from documents",
)
def hash_split(t):
    return T.md5_split(t.documents.select("doc_id"), "doc_id", 0.1)


@query(
    "length_buckets",
    f"select doc_id, len({TOK}) as n_tokens, len({TOK}) // 100 as bucket from documents",
)
def length_buckets(t):
    texts = T.spread(t.documents.select("doc_id", "text"))
    return T.length_buckets(T.tokenize(texts, "doc_id", "text"), "doc_id", 100)


@query(
    "perplexity",
    f"""with c as (select token, count(*) as n from (select unnest({TOK}) as token from documents) group by 1)
        select round(exp(sum(n * -ln(n / t)) / max(t)), 6) as perplexity from c, (select sum(n)::double as t from c)""",
)
def perplexity(t):
    c = T.token_counts(doc_tokens(t))
    both = c.join(F.broadcast(c.agg(F.sum("n").alias("total"))))
    loss = F.sum(F.col("n") * -F.log(F.col("n") / F.col("total"))) / F.max("total")
    return both.agg(F.round(F.exp(loss), 6).alias("perplexity"))


@query(
    "token_budget",
    f"""with w as (select doc_id, len({WS}) as n_tokens from documents),
        r as (select *, sum(n_tokens) over (order by doc_id) as run from w)
        select doc_id, n_tokens, run::bigint as run from r where run - n_tokens <= 100000""",
)
def token_budget(t):
    from tidemill.sources.files import token_budget as cut

    return cut(t.documents, "text", "doc_id", 100_000).select("doc_id", "n_tokens", "run")


# ---- vectors -------------------------------------------------------------------


@query(
    "normalize_rows",
    """select vec_id, round(embedding[1]::double / n, 6) as x1, round(embedding[64]::double / n, 6) as x64
       from (select *, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as n from embeddings)""",
)
def normalize_rows(t):
    unit = t.embeddings.select("vec_id", V.l2_normalise(V.doubles(F.col("embedding"))).alias("u"))
    return unit.select("vec_id", F.round(F.col("u")[0], 6).alias("x1"), F.round(F.col("u")[63], 6).alias("x64"))


_D = "list_cosine_similarity(a.embedding::double[], b.embedding::double[])"


@query(
    "cosine_sim",
    f"""with f as (select label, arg_min(embedding, vec_id) as embedding from embeddings group by 1)
        select a.vec_id, round({_D}, 6) as similarity from embeddings a join f b on a.label = b.label""",
)
def cosine_sim(t):
    from tidemill.operators.scale import with_group_stats

    e = t.embeddings.withColumn("v", V.doubles(F.col("embedding"))).drop("embedding")
    both = with_group_stats(e, ["label"], _first=F.min_by("v", "vec_id"))
    return both.select("vec_id", F.round(V.cosine(F.col("v"), F.col("_first")), 6).alias("similarity"))


@query(
    "analogy",
    """with e as (select vec_id, embedding::double[] as v from embeddings),
            q as (select (select v from e where vec_id = 1) as a, (select v from e where vec_id = 2) as b, (select v from e where vec_id = 3) as c),
            s as (select vec_id, list_cosine_similarity(list_transform(list_zip(b, a), lambda z: z[1] - z[2]),
                         list_transform(list_zip(v, c), lambda z: z[1] - z[2])) as sim from e, q where vec_id not in (1, 2, 3))
       select vec_id, round(sim, 6) as similarity from s order by round(sim, 9) desc, vec_id limit 1""",
)
def analogy(t):
    return N.analogy(t.embeddings, 1, 2, 3).withColumn("similarity", F.round("similarity", 6))


_AXIS = """e as (select vec_id, label, embedding::double[] as v from embeddings),
    g as (select list_transform(list_zip((select v from e where vec_id = 0), (select v from e where vec_id = 1)), lambda z: z[1] - z[2]) as g),
    p as (select vec_id, label, v, g, list_dot_product(v, g) / list_dot_product(g, g) as k from e, g)"""


def _axis(t):
    v = V.doubles(F.col("embedding"))
    ends = t.embeddings.where(F.col("vec_id").isin(0, 1)).agg(
        V.minus(F.max_by(v, -F.col("vec_id")), F.max_by(v, "vec_id")).alias("g")
    )
    return t.embeddings.select("vec_id", "label", v.alias("v")).join(F.broadcast(ends))


@query(
    "neutralize",
    f"with {_AXIS} select vec_id, round(v[1] - k * g[1], 6) as x1, round(v[64] - k * g[64], 6) as x64 from p",
)
def neutralize(t):
    n = _axis(t).select("vec_id", V.neutralise(F.col("v"), F.col("g")).alias("n"))
    return n.select("vec_id", F.round(F.col("n")[0], 6).alias("x1"), F.round(F.col("n")[63], 6).alias("x64"))


@query(
    "equalize",
    f"""with {_AXIS}, w as (select label, arg_min(vec_id, vec_id) as i1, arg_max(vec_id, vec_id) as i2 from e group by 1),
        j as (select w.label, a.v as v1, b.v as v2, a.g, a.k as k1, b.k as k2 from w join p a on a.vec_id = i1 join p b on b.vec_id = i2),
        m as (select *, (k1 + k2) / 2 as km, list_transform(list_zip(v1, v2, g), lambda z: (z[1] + z[2]) / 2 - (k1 + k2) / 2 * z[3]) as off from j),
        s as (select *, sqrt(abs(1 - list_dot_product(off, off))) as size,
              list_transform(list_zip(v1, off, g), lambda z: z[1] - z[2] - km * z[3]) as d1,
              list_transform(list_zip(v2, off, g), lambda z: z[1] - z[2] - km * z[3]) as d2 from m)
        select label, round(size * (k1 - km) * g[1] / sqrt(list_dot_product(d1, d1)) + off[1], 6) as x1,
               round(size * (k2 - km) * g[1] / sqrt(list_dot_product(d2, d2)) + off[1], 6) as x2 from s""",
)
def equalize(t):
    pairs = _axis(t).groupBy("label").agg(F.min_by("v", "vec_id").alias("a"), F.max_by("v", "vec_id").alias("b"), F.first("g").alias("g"))
    both = V.equalise(pairs, "a", "b", "g", "e1", "e2")
    return both.select("label", F.round(F.col("e1")[0], 6).alias("x1"), F.round(F.col("e2")[0], 6).alias("x2"))


@query(
    "sentence_vec",
    f"""with {_vocab_cte('benchmark')},
        x as (select item_id, unnest({TOK}) as token from benchmark),
        j as (select item_id, embedding from x join v on x.token = v.token join embeddings e on e.vec_id = v.id)
        select item_id, round(avg(embedding[1]::double), 6) as x1, round(avg(embedding[64]::double), 6) as x64 from j group by 1""",
)
def sentence_vec(t):
    tokens = T.tokenize(t.benchmark, "item_id", "text")
    vocab = T.build_vocab(T.token_counts(tokens))
    known = vocab.join(t.embeddings.withColumnRenamed("vec_id", "id"), "id").select("token", "embedding")
    s = N.sentence_vectors(tokens, "item_id", known)
    return s.select("item_id", F.round(F.col("sentence_vec")[0], 6).alias("x1"), F.round(F.col("sentence_vec")[63], 6).alias("x64"))


def _knn_sql(dist: str, k: int) -> str:
    return f"""with d as (select a.vec_id as query_id, b.vec_id as base_id, {dist} as d from embeddings a, embeddings b where a.vec_id <> b.vec_id),
        r as (select *, row_number() over (partition by query_id order by round(d, 9), base_id) as rn from d)
        select query_id, base_id, round(d, 6) as distance from r where rn <= {k}"""


@query("knn_cosine", _knn_sql(f"1 - {_D}", 10))
def knn_cosine(t):
    return N.knn(t.embeddings, t.embeddings, 10, "cosine", exclude_self=True).withColumn("distance", F.round("distance", 6))


_L2 = "list_distance(a.embedding::double[], b.embedding::double[])"


@query("knn_l2", _knn_sql(_L2, 5))
def knn_l2(t):
    return N.knn(t.embeddings, t.embeddings, 5, "l2", exclude_self=True).withColumn("distance", F.round("distance", 6))


@query(
    "knn_approx",
    """select count(*) filter (where vec_id % 10 = 0) as n_queries, count(*) as n_base, 10 * count(*) filter (where vec_id % 10 = 0) as n_found,
              true as found_nine_tenths from embeddings""",
)
def knn_approx(t):
    """Search in a stored index, with as many probes as a trial asks for, held against exact search."""
    base, asked = t.embeddings, t.embeddings.where("vec_id % 10 = 0")
    index = X.build_index(base, scratch_dir(t.spark, "index"), "cosine")
    found = materialise(X.search(index, asked, 10, X.choose_probes(index, base, asked, 10)))
    good = X.recall(found, N.knn(asked, base, 10, "cosine")) >= 0.9
    sizes = base.agg(F.count_if(F.col("vec_id") % 10 == 0).alias("n_queries"), F.count(F.lit(1)).alias("n_base"))
    return sizes.join(found.agg(F.count(F.lit(1)).alias("n_found"))).withColumn("found_nine_tenths", F.lit(good))


@query(
    "knn_mean_query",
    """with q as (select label, list_transform(list_zip(arg_min(embedding, vec_id), arg_max(embedding, vec_id)),
                         lambda z: (z[1]::double + z[2]::double) / 2) as v from embeddings group by 1),
            d as (select q.label::bigint as query_id, vec_id as base_id, 1 - list_cosine_similarity(v, embedding::double[]) as d from q, embeddings),
            r as (select *, row_number() over (partition by query_id order by round(d, 9), base_id) as rn from d)
       select query_id, base_id, round(d, 6) as distance from r where rn <= 3""",
)
def knn_mean_query(t):
    v = V.doubles(F.col("embedding"))
    ends = t.embeddings.groupBy("label").agg(F.min_by(v, "vec_id").alias("a"), F.max_by(v, "vec_id").alias("b"))
    q = ends.select(F.col("label").alias("vec_id"), V.scale(V.add(F.col("a"), F.col("b")), F.lit(0.5)).alias("embedding"))
    return N.knn(q, t.embeddings, 3, "cosine").withColumn("distance", F.round("distance", 6))


_ID = "f as (select label, arg_min(embedding, vec_id) as embedding from embeddings group by 1)"


def _identities(t):
    return t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))


@query(
    "verify_vec",
    f"""with {_ID}, c as (select vec_id, embedding, cast((label + vec_id % 2) % 10 as int) as label from embeddings)
        select a.vec_id, a.label, round({_L2}, 6) as distance, {_L2} < 1.2 as accepted from c a join f b on a.label = b.label""",
)
def verify_vec(t):
    claims = t.embeddings.withColumn("label", ((F.col("label") + F.col("vec_id") % 2) % 10).cast("int"))
    v = N.verify(claims, _identities(t), "label", limit=1.2)
    return v.select("vec_id", "label", F.round("distance", 6).alias("distance"), "accepted")


@query(
    "identify_vec",
    f"""with {_ID}, d as (select a.vec_id as query_id, b.label, {_L2} as d from embeddings a, f b),
        r as (select *, row_number() over (partition by query_id order by round(d, 9), label) as rn from d)
        select query_id, coalesce(case when round(d, 9) <= 1.2 then label end, -1) as identity, round(d, 6) as distance from r where rn = 1""",
)
def identify_vec(t):
    known = _identities(t).withColumnRenamed("label", "vec_id")
    got = N.identify(t.embeddings, known, 1.2)
    return got.select("query_id", F.coalesce("identity", F.lit(-1)).alias("identity"), F.round("distance", 6).alias("distance"))


# ---- boxes ----------------------------------------------------------------------

_ROW = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_BOXES = f"""b as (select {_ROW}, round(l_discount * 100, 4) as x1, round(l_tax * 100, 4) as y1,
    round(l_discount * 100 + l_quantity, 4) as x2, round(l_tax * 100 + l_linenumber * 5, 4) as y2 from lineitem)"""


def _boxes(t, *more):
    box = B.corners(F.col("l_linenumber") * 5.0, F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[c.alias(n) for n, c in box.items()], *more)


@query("box_corners", f"with {_BOXES} select {_ROW}, {', '.join(f'round({c}, 4) as {c}' for c in B.BOX)} from b")
def box_corners(t):
    return _boxes(t).withColumns({c: F.round(c, 4) for c in B.BOX})


@query(
    "box_iou",
    f"""with {_BOXES}, m as (select *, row_number() over (partition by l_orderkey order by round((x2 - x1) * (y2 - y1), 6) desc, l_partkey desc) as rn from b),
        j as (select b.*, greatest(least(b.x2, m.x2) - greatest(b.x1, m.x1), 0) * greatest(least(b.y2, m.y2) - greatest(b.y1, m.y1), 0) as i,
              (b.x2 - b.x1) * (b.y2 - b.y1) + (m.x2 - m.x1) * (m.y2 - m.y1) as s from b join m on b.l_orderkey = m.l_orderkey and m.rn = 1)
        select {_ROW}, round(i / (s - i), 6) as iou from j""",
)
def box_iou(t):
    boxes = _boxes(t).withColumns({c: F.round(c, 4) for c in B.BOX})
    df = B.overlap_with_largest(boxes, "l_orderkey", "l_partkey")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("iou", 6).alias("iou"))


@query(
    "box_filter",
    """with s as (select vec_id, list_transform(range(1, 6), lambda i: abs(embedding[i]::double) * abs(embedding[64]::double)) as s from embeddings)
       select vec_id, list_position(s, list_max(s)) - 1 as class, round(list_max(s), 8) as score from s where list_max(s) >= 0.02""",
)
def box_filter(t):
    v = V.doubles(F.col("embedding"))
    probs = F.transform(F.slice(v, 1, 5), F.abs)
    got = B.box_filter(t.embeddings.select("vec_id", "embedding"), F.abs(v[63]), probs, 0.02)
    return got.select("vec_id", "class", F.round("score", 8).alias("score"))


_IOU = """greatest(least(k.x2, o.x2) - greatest(k.x1, o.x1), 0) * greatest(least(k.y2, o.y2) - greatest(k.y1, o.y1), 0)
    / ((k.x2 - k.x1) * (k.y2 - k.y1) + (o.x2 - o.x1) * (o.y2 - o.y1)
       - greatest(least(k.x2, o.x2) - greatest(k.x1, o.x1), 0) * greatest(least(k.y2, o.y2) - greatest(k.y1, o.y1), 0)) > 0.5"""


@query(
    "box_nms",
    f"""with recursive o as (select l_orderkey, l_partkey * 10 + l_linenumber as box_id, l_extendedprice / 105000 as score, round(l_discount * 100, 4) as x1,
            round(l_tax * 100, 4) as y1, round(l_discount * 100 + l_quantity, 4) as x2, round(l_tax * 100 + l_linenumber * 5, 4) as y2,
            row_number() over (partition by l_orderkey order by l_extendedprice / 105000 desc, l_partkey * 10 + l_linenumber) as rn,
            count(*) over (partition by l_orderkey) as n from lineitem),
        w as (select l_orderkey, rn, n, [struct_pack(box_id := box_id, score := score, x1 := x1, y1 := y1, x2 := x2, y2 := y2)] as kept from o where rn = 1
              union all
              select o.l_orderkey, o.rn, o.n, case when len(w.kept) >= 10 or len(list_filter(w.kept, lambda k: {_IOU})) > 0 then w.kept
                  else list_append(w.kept, struct_pack(box_id := o.box_id, score := o.score, x1 := o.x1, y1 := o.y1, x2 := o.x2, y2 := o.y2)) end
              from w join o on o.l_orderkey = w.l_orderkey and o.rn = w.rn + 1)
        select l_orderkey, k.box_id, round(k.score, 8) as score, k.x1, k.y1, k.x2, k.y2 from (select l_orderkey, unnest(kept) as k from w where rn = n)""",
)
def box_nms(t):
    box_id = F.col("l_partkey") * 10 + F.col("l_linenumber")
    boxes = _boxes(t, box_id.alias("box_id"), (F.col("l_extendedprice") / 105000).alias("score"))
    kept = B.nms(boxes.withColumns({c: F.round(c, 4) for c in B.BOX}), "l_orderkey", "box_id")
    return kept.withColumn("score", F.round("score", 8))


@query(
    "largest_box",
    f"""with {_BOXES}, m as (select *, row_number() over (partition by l_orderkey order by round((x2 - x1) * (y2 - y1), 6) desc, l_partkey desc) as rn from b)
        select l_orderkey, l_partkey, round((x2 - x1) * (y2 - y1), 4) as area from m where rn = 1""",
)
def largest_box(t):
    boxes = _boxes(t).withColumn("area", F.round(B.area(B.cols()), 6))
    best = argmax_group(boxes, "l_orderkey", [F.col("area"), F.col("l_partkey")], ["l_partkey", "area"])
    return best.withColumn("area", F.round("area", 4))
