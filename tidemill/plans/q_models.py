"""Queries for tabular modelling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.functions import dates, maths
from tidemill.operators import modelling as M
from tidemill.operators import text as T
from tidemill.operators.joins import join_on
from tidemill.plans.q_analytics import ROW_ID, SQL_ROW_ID, scored_labels
from tidemill.plans.q_text import TOK, doc_tokens
from tidemill.plans.registry import query
from tidemill.session import discard, materialise, shuffles_dropped

_CUT = "timestamp '1999-01-01 00:00:00'"


def _sides(df, col="l_shipdate"):
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return df.where(F.col(col) < cut), df.where(F.col(col) >= cut)


@query(
    "cat_codes",
    f"""with c as (select p, dense_rank() over (order by p) - 1 as code from
                   (select distinct l_partkey as p from lineitem where l_shipdate < timestamp '1996-01-01 00:00:00'))
        select {SQL_ROW_ID}, coalesce(code, -1) as code from lineitem left join c on l_partkey = p""",
)
def cat_codes(t):
    train = t.lineitem.where(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return M.apply_codes(t.lineitem.select(*ROW_ID), "l_partkey", M.fit_codes(train, "l_partkey"), "code")


@query(
    "cat_order",
    """select o_orderkey, coalesce(list_position(['5-LOW', '3-MEDIUM', '2-HIGH', '1-URGENT'], o_orderpriority) - 1, -1) as code from orders""",
)
def cat_order(t):
    codes = M.fit_codes(t.orders, "o_orderpriority", ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT"])
    return M.apply_codes(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", codes, "code").drop("o_orderpriority")


@query(
    "impute_median",
    """with c as (select c_custkey, case when c_acctbal >= 0 then c_acctbal end as b from customer)
       select c_custkey, round(coalesce(b, (select median(b) from c)), 4) as balance, b is null as balance_na from c""",
)
def impute_median(t):
    c = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    return M.impute(c, M.fit_medians(c, ["balance"])).withColumn("balance", F.round("balance", 4))


@query(
    "one_hot",
    f"""select {SQL_ROW_ID}, {', '.join(f"(l_returnflag = '{v}')::int as l_returnflag_{v}" for v in 'ANR')},
        {', '.join(f"(l_linestatus = '{v}')::int as l_linestatus_{v}" for v in 'FO')} from lineitem""",
)
def one_hot(t):
    """Columns of few values become indicators; the part key has too many."""
    few = M.small_categories(t.lineitem, ["l_returnflag", "l_linestatus", "l_partkey"], 7)
    return M.one_hot(t.lineitem, few).select(*ROW_ID, *[f"{c}_{v}" for c, vs in few.items() for v in vs])


_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    "pick_cats",
    " union all ".join(
        f"select '{c}' as \"column\", count(distinct {c}) as n_distinct, count(distinct {c}) < count(*) / 50.0 as is_category from lineitem"
        for c in _COLS
    ),
)
def pick_cats(t):
    return M.category_columns(t.lineitem)


#: What part names are made of in the test tables, for the SQL twin; the query learns the words itself.
_WORDS = "anvil blue bolt cold gear gizmo hot large new old plate red ring rod small widget".split()


@query(
    "multi_hot",
    "select p_partkey, " + ", ".join(f"list_contains(string_split(p_name, ' '), '{w}')::int as tag_{w}" for w in _WORDS) + " from part",
)
def multi_hot(t):
    return M.multi_hot(t.part, "p_partkey", "p_name", M.tag_list(t.part, "p_name"))


@query("dense_ids", "select o_custkey, dense_rank() over (order by o_custkey) - 1 as user_id from (select distinct o_custkey from orders)")
def dense_ids(t):
    return M.dense_ids(t.orders, "o_custkey", "user_id")


@query(
    "strat_split",
    """with r as (select doc_id, quality, row_number() over (partition by quality order by md5(doc_id::varchar), doc_id) as rn,
                         count(*) over (partition by quality) as n from labels)
       select doc_id, quality, rn <= floor(n * 0.2) as is_valid from r""",
)
def strat_split(t):
    return M.stratified_split(t.labels.select("doc_id", "quality"), "quality", "doc_id", 0.2)


_S = "(select quality, toxic, n_chars / 20000.0 as p from labels join documents using (doc_id))"


@query(
    "log_loss",
    f"""select round(avg(-(quality * ln(q) + (1 - quality) * ln(1 - q))), 8) as loss
        from (select quality, least(greatest(p, 1e-15), 1 - 1e-15) as q from {_S})""",
)
def log_loss(t):
    return scored_labels(t).agg(F.round(maths.log_loss(F.col("quality"), F.col("p")), 8).alias("loss"))


@query(
    "metrics_reg",
    """with s as (select l_quantity as y, l_extendedprice / 2000 as p from lineitem)
       select round(sqrt(avg((y - p) ** 2)), 6) as rmse, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) as r2,
              round(sqrt(avg(((y - p) / y) ** 2)), 6) as rmspe from s""",
)
def metrics_reg(t):
    m = M.metrics_regression(t.lineitem.select(F.col("l_quantity").alias("y"), (F.col("l_extendedprice") / 2000).alias("p")), "y", "p")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query(
    "metrics_clf",
    f"""with s as (select quality as y, (p > 0.1)::int as h from {_S}), a as (select avg((y = h)::int) as acc,
        sum((y = 1 and h = 1)::int)::double as tp, sum(h) as hits, sum(y) as yes from s)
        select round(acc, 8) as accuracy, round(tp / hits, 8) as precision, round(tp / yes, 8) as recall,
               round(2 * tp / (hits + yes), 8) as f1 from a""",
)
def metrics_clf(t):
    s = scored_labels(t).withColumn("h", (F.col("p") > 0.1).cast("int"))
    m = M.metrics_classification(s, "quality", "h")
    return m.select(*[F.round(c, 8).alias(c) for c in m.columns])


# Thresholds of the F-beta sweep.
_GRID = [0.17, 0.18, 0.19, 0.2, 0.21, 0.22, 0.23, 0.24]


@query(
    "fbeta_sweep",
    f"""with s as (select unnest({_GRID}) as th, quality as y, p from {_S})
        select th::double as threshold, round(5 * sum((p > th and y = 1)::int) / (4 * sum(y) + sum((p > th)::int)), 8) as fbeta from s group by 1""",
)
def fbeta_sweep(t):
    return M.fbeta_sweep(scored_labels(t), "quality", "p", 2.0, _GRID).withColumn("fbeta", F.round("fbeta", 8))


@query("soft_kappa", f"select round(-2 * sum(quality * p) / (sum(quality * quality) + sum(p * p)), 8) as soft_kappa from {_S}")
def soft_kappa(t):
    return M.soft_kappa(scored_labels(t), "quality", "p").select(F.round("soft_kappa", 8).alias("soft_kappa"))


@query(
    "ensemble_mean",
    """select l_orderkey, round(avg(p), 8) as probability from (select l_orderkey, 1 - l_discount as p from lineitem
       union all select l_orderkey, 1 - l_tax from lineitem) group by 1""",
)
def ensemble_mean(t):
    frames = [t.lineitem.select("l_orderkey", F.log(1 - F.col(c)).alias("logp")) for c in ("l_discount", "l_tax")]
    return M.ensemble_mean(frames, "l_orderkey", "logp").withColumn("probability", F.round("probability", 8))


@query(
    "line_fit",
    """with f as (select regr_slope(l_extendedprice, l_quantity) as a, regr_intercept(l_extendedprice, l_quantity) as b from lineitem)
       select round(a, 4) as slope, round(b, 3) as intercept, round(avg((l_extendedprice - a * l_quantity - b) ** 2) / 1000, 2) as mse
       from lineitem, f group by a, b""",
)
def line_fit(t):
    f = M.line_fit(t.lineitem, "l_quantity", "l_extendedprice")
    return f.select(F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round(F.col("mse") / 1000, 2).alias("mse"))


_RATINGS = "(select o_custkey as u, l_partkey as i, avg(l_quantity) as r from orders join lineitem on o_orderkey = l_orderkey group by 1, 2)"


def _ratings(t):
    o, l = t.orders.select("o_orderkey", "o_custkey"), t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    r = join_on(o, l, [("o_orderkey", "l_orderkey")])
    return r.groupBy(F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i")).agg(F.avg("l_quantity").alias("r"))


@query(
    "bias_model",
    f"""with r as (select *, r - avg(r) over () as e, avg(r) over () as m from {_RATINGS}),
        a as (select *, avg(e) over (partition by u) as bu from r), b as (select *, avg(e - bu) over (partition by i) as bi from a)
        select u, i, round(least(greatest(m + bu + bi, 1), 50), 5) as predicted from b""",
)
def bias_model(t):
    p = M.bias_model(_ratings(t), "u", "i", "r", 1.0, 50.0)
    return p.select("u", "i", F.round("predicted", 5).alias("predicted"))


@query(
    "item_bias_rank",
    f"""with r as (select i, r - (select avg(r) from {_RATINGS}) as e from {_RATINGS})
        select i, round(avg(e), 6) as bias from r group by 1 order by round(avg(e), 6) desc, i limit 15""",
)
def item_bias_rank(t):
    r = _ratings(t)
    b = r.join(F.broadcast(r.agg(F.avg("r").alias("m")))).groupBy("i").agg(F.round(F.avg(F.col("r") - F.col("m")), 6).alias("bias"))
    return b.orderBy(F.desc("bias"), F.col("i")).limit(15)


# ---- fitted models: no SQL twin, checked against a baseline in the tests ----------

_X = ["price", "l_quantity", "l_discount", "l_tax", "l_linenumber", "ship_month"]


def _price_rows(t):
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    df = t.lineitem.withColumns(
        {"ship_month": F.month("l_shipdate"), "price": F.col("l_extendedprice") / 1000, "y": charge / 1000}
    )
    return _sides(df.select("l_shipdate", "l_returnflag", "y", *_X))


@query("rf_fit")
def rf_fit(t):
    train, valid = _price_rows(t)
    model = M.fit_forest(M.features(train, _X), "y", trees=10)
    return M.metrics_regression(model.transform(M.features(valid, _X)), "y", "prediction")


@query("rf_clf")
def rf_clf(t):
    train, valid = _price_rows(t)
    flag = (F.col("l_quantity") * 2 + F.col("l_linenumber") > 50).cast("double")
    model = M.fit_forest_classifier(M.features(train.withColumn("big", flag), _X), "big", trees=10)
    return M.metrics_classification(model.transform(M.features(valid.withColumn("big", flag), _X)), "big", "prediction")


@query("feat_importance")
def feat_importance(t):
    train, _ = _price_rows(t)
    return M.importances(train, M.fit_forest(M.features(train, _X), "y", trees=10), _X, 0.005)


@query("drop_col")
def drop_col(t):
    train, valid = _price_rows(t)
    return M.drop_column_importance(materialise(M.dealt(train)), materialise(M.dealt(valid)), "y", _X)


@query("tree_spread")
def tree_spread(t):
    train, valid = _price_rows(t)
    model = M.fit_forest(M.features(train, _X), "y", trees=10)
    return M.tree_spread(M.features(valid, _X), model, "l_returnflag")


@query("pdp")
def pdp(t):
    train, valid = _price_rows(t)
    model = M.fit_forest(M.features(train, _X), "y", trees=10)
    return M.partial_dependence(valid, model, _X, {"l_quantity": [1, 10, 20, 30, 40, 50], "l_discount": [0.0, 0.05, 0.1]})


@query("pdp_one")
def pdp_one(t):
    train, valid = _price_rows(t)
    model = M.fit_forest(M.features(train, _X), "y", trees=10)
    return M.partial_dependence(valid, model, _X, {"ship_month": list(range(1, 13))})


@query("pdp_group")
def pdp_group(t):
    train, valid = _price_rows(t)
    flags = M.small_categories(train, ["l_returnflag"], 7)
    group = [f"l_returnflag_{v}" for v in flags["l_returnflag"]]
    model = M.fit_forest(M.features(M.one_hot(train, flags), [*_X, *group]), "y", trees=10)
    return M.group_dependence(M.one_hot(valid, flags), model, [*_X, *group], group)


@query("pdp_curves")
def pdp_curves(t):
    train, valid = _price_rows(t)
    model = M.fit_forest(M.features(train, _X), "y", trees=10)
    keyed = valid.withColumn("row", F.monotonically_increasing_id())
    return M.dependence_curves(materialise(keyed), model, "row", _X, "l_quantity", [1.0, 10.0, 20.0, 30.0, 40.0, 50.0])


@query("adversarial")
def adversarial(t):
    train, valid = _price_rows(t)
    return M.adversarial_columns(train, valid, _X)


@query("lasso")
def lasso(t):
    train, _ = _price_rows(t)
    return M.coefficients(train, M.fit_lasso(M.features(train, _X), "y"), _X)


def _numbered_ratings(t):
    """Ratings with users and items numbered from 0, as the factorisation needs them."""
    r = materialise(_ratings(t))
    users, items = M.dense_ids(r, "u", "user"), M.dense_ids(r, "i", "item")
    return r.join(users, "u").join(items, "i").select("u", "i", F.col("user").cast("int"), F.col("item").cast("int"), F.col("r").cast("float"))


@query("als_fit")
def als_fit(t):
    r = materialise(T.hash_split(_numbered_ratings(t).withColumn("pair", F.struct("u", "i")), "pair", 0.2))
    model = M.fit_als(r.where("not is_valid"), "user", "item", "r")
    scored = M.clipped(model.transform(r.where("is_valid")), "prediction", 1.0, 50.0)
    return M.metrics_regression(scored, "r", "prediction").select("rmse")


@query("item_pca")
def item_pca(t):
    r = materialise(_numbered_ratings(t))
    c = M.item_components(M.fit_als(r, "user", "item", "r"), 3)
    known = r.select("i", "item").distinct()
    named = c.join(known, c["id"] == known["item"]).select(F.col("i").alias("id"), "components")
    return named.select("id", *[F.col("components")[j].alias(f"pc{j + 1}") for j in range(3)])


#: Terms of the text classifiers at most.
_TERMS = 800_000


def _term_sets(t, hi):
    """N-gram lists of the labelled documents with label and side, the vocabulary of the training side, and
    the written tokens that the lists are made of as they are read."""
    labels = T.md5_split(t.labels.select("doc_id", F.col("quality").cast("double").alias("y")), "doc_id", 0.25)
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("y")).alias("_copy")
    tokens = doc_tokens(t).join(labels.select("doc_id"), "doc_id")
    with shuffles_dropped(t.spark):
        kept = materialise(tokens.join(labels.select("*", copy), "doc_id"))
        seen = kept.where("not is_valid and _copy = 1").select("doc_id", "tokens")
        vocab = materialise(M.numbered_terms(T.frequent_terms(seen, "doc_id", 1, hi, _TERMS, "df")))
    return T.gram_lists(kept, "doc_id", 1, hi, "y", "is_valid"), vocab, kept


def text_scored(t):
    """All rows scored by logistic regression on 0/1 word n-grams, fitted to the training rows."""
    lists, vocab, kept = _term_sets(t, 3)
    rows = M.term_vectors(lists, vocab, "doc_id", binary=True)
    discard(kept, vocab)
    return M.fit_logistic(rows.where("not is_valid"), "y", 0.1).transform(rows)


@query("text_logreg")
def text_logreg(t):
    return M.metrics_classification(text_scored(t).where("is_valid"), "y", "prediction")


def nb_scored(t):
    """All rows scored by trigrams weighted by their log-count ratio; the weights fitted to the
    training rows are pulled towards their mean size."""
    lists, vocab, kept = _term_sets(t, 3)
    train = lists.where("not is_valid")
    sides = train.select("doc_id", "y")
    # Counts of documents that come once have their label with them.
    label = ["y"] if sides.count() == sides.select("doc_id").distinct().count() else []
    held = train.select("doc_id", *label, F.explode(F.array_distinct("terms")).alias("term"), F.lit(1).cast("bigint").alias("n"))
    ratio = T.nb_ratio(M.among(held, vocab.select("term")), sides, "doc_id", "y")
    with shuffles_dropped(t.spark):
        weighted = materialise(vocab.join(ratio.select("term", "r"), "term", "left"))
    rows = M.term_vectors(lists, weighted, "doc_id", True, "r")
    discard(kept, vocab, weighted)
    model = M.fit_logistic(rows.where("not is_valid"), "y", 0.1)
    return M.interpolated_scores(rows, model, 0.25, "pulled").drop("prediction").withColumnRenamed("pulled", "prediction")


@query("nb_logreg")
def nb_logreg(t):
    return M.metrics_classification(nb_scored(t).where("is_valid"), "y", "prediction")


@query("session_clf")
def session_clf(t):
    from pyspark.ml.functions import vector_to_array

    e = t.events.select(
        F.concat_ws(" ", "event_type", F.get_json_object("props", "$.k")).alias("sites"),
        F.hour("ts").alias("hour"), (dates.daypart(F.hour("ts")) == "morning").cast("int").alias("morning"),
        (F.col("value") > 50).cast("double").alias("y"), "ts",
    )
    cut = F.lit("2024-01-24").cast("timestamp_ntz")
    model = M.text_time_classifier("sites", ["hour", "morning"], "y").fit(e.where(F.col("ts") < cut))
    scored = model.transform(e.where(F.col("ts") >= cut)).withColumn("p", vector_to_array("probability")[1])
    return scored.agg(maths.log_loss(F.col("y"), F.col("p")).alias("loss"), F.count(F.lit(1)).alias("n"))


@query(
    "vocab_pos",
    f"""with x as (select doc_id, unnest({TOK}) as token from documents)
        select token, count(*) as n, count(distinct doc_id) as docs from x group by 1 order by n desc, token limit 1000""",
)
def vocab_pos(t):
    return T.top_terms(T.corpus_terms(doc_tokens(t), "doc_id"), 1000).select(
        F.col("term").alias("token"), F.col("total").alias("n"), F.col("df").alias("docs")
    )
