"""Tabular modelling: encoders, metrics and Spark ML fits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IDF, PCA, CountVectorizer, NGram, Normalizer, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemill.operators.aggregates import percentiles, value_counts
from tidemill.operators.scale import attach, literal_rows, ranked, with_group_stats
from tidemill.session import checkpoint_dir, materialise, shuffles_dropped

# ---- encoders ------------------------------------------------------------------


def fit_codes(train: DataFrame, col: str, order: Sequence[str] | None = None) -> DataFrame:
    """(category, code, _n) learned on training rows, codes from 0.

    In the stated order, or sorted by value through a distributed numbering.
    """
    counts = train.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("category")).agg(F.count(F.lit(1)).alias("_n"))
    if order is None:
        return ranked(counts, [F.col("category")], "code").withColumn("code", F.col("code") - 1)
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col("category")) - 1
    return counts.withColumn("code", place.cast("bigint")).where(F.col("code") >= 0)


def apply_codes(df: DataFrame, col: str, codes: DataFrame, out: str | None = None, unseen: int = -1) -> DataFrame:
    """Learned code per row; categories that training did not hold get ``unseen``."""
    table = codes.select(F.col("category").alias(col), F.col("code").alias("_code"), "_n")
    coded = attach(df, table, [col], "_n").drop("_n")
    return coded.withColumn(out or f"{col}_code", F.coalesce("_code", F.lit(unseen))).drop("_code")


def fit_medians(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact medians of a few columns; a handful of numbers, kept to be reused."""
    got = percentiles(value_counts(train, cols), {"median": 0.5}, ["column"]).collect()
    return {r["column"]: r["median"] for r in got}


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Fill nulls with the learned medians and flag them in ``<col>_na``."""
    flags = {f"{c}_na": F.col(c).isNull() for c in medians}
    return df.withColumns(flags).fillna(dict(medians))


def small_categories(df: DataFrame, cols: Sequence[str], max_n_cat: int) -> dict[str, list]:
    """Sorted values of those columns that have at most ``max_n_cat``, learned from the rows.

    Counted map-side; at most ``max_n_cat`` values of each column reach the driver.
    """
    found = {}
    for c in cols:
        values = [r[0] for r in df.where(F.col(c).isNotNull()).select(c).distinct().limit(max_n_cat + 1).collect()]
        if len(values) <= max_n_cat:
            found[c] = sorted(values)
    return found


def one_hot(df: DataFrame, values: Mapping[str, Sequence]) -> DataFrame:
    """0/1 column per column and learned value; a null or unknown value has only zeros."""
    return df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c, vs in values.items() for v in vs})


def category_columns(df: DataFrame, share: float = 1 / 50) -> DataFrame:
    """(column, n_distinct, is_category): few distinct values against the row count.

    Each column is counted for itself, so its scan reads that column alone and its values are
    combined map-side before the shuffle, in their own type. Nulls are no value.
    """
    counts = [
        df.agg(F.lit(c).alias("column"), F.count_distinct(F.col(c)).alias("n_distinct"), F.count(F.lit(1)).alias("_rows"))
        for c in df.columns
    ]
    every = reduce(DataFrame.unionByName, counts)
    return every.select("column", "n_distinct", (F.col("n_distinct") < F.col("_rows") * share).alias("is_category"))


def tag_list(df: DataFrame, tags: str, sep: str = " ", most: int = 1_000) -> list[str]:
    """All tags of a column in order. A table has a column for each, so more than ``most`` are refused."""
    words = df.select(F.explode(F.split(F.col(tags), sep)).alias("tag")).where(F.col("tag") != "").distinct()
    found = [r["tag"] for r in words.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} tags; use sparse term vectors")
    return sorted(found)


def multi_hot(df: DataFrame, key: str, tags: str, values: Sequence[str], sep: str = " ") -> DataFrame:
    """Separated tags to one 0/1 column per learned tag; a null has only zeros."""
    words = F.coalesce(F.split(F.col(tags), sep), F.array())
    return df.select(key, *[F.array_contains(words, v).cast("int").alias(f"tag_{v}") for v in values])


def dense_ids(df: DataFrame, col: str, out: str) -> DataFrame:
    """(value, dense id from 0) of a key column; works for any number of keys."""
    values = df.select(col).distinct()
    return ranked(values, [F.col(col)], out).withColumn(out, F.col(out) - 1)


def stratified_split(df: DataFrame, label: str, key: str, rate: float, out: str = "is_valid") -> DataFrame:
    """Hold out the same share of every label: the first rows of each by key hash.

    Rows are numbered with a distributed scan, since one label may hold most rows.
    """
    hashed = df.withColumn("_h", F.md5(F.col(key).cast("string")))
    sized = with_group_stats(hashed, [label], _size=F.count(F.lit(1)))
    pos = ranked(sized, [F.col("_h"), F.col(key)], "_pos", [label])
    return pos.withColumn(out, F.col("_pos") <= F.floor(F.col("_size") * F.lit(rate))).drop("_h", "_size", "_pos")


# ---- metrics -------------------------------------------------------------------


def metrics_regression(df: DataFrame, y: str, p: str) -> DataFrame:
    """RMSE, R² and root mean squared percentage error (over y other than 0) in one pass."""
    e = F.col(y) - F.col(p)
    return df.agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"),
        F.sqrt(F.avg(F.try_divide(e, F.col(y)) ** 2)).alias("rmspe"),
    )


def metrics_classification(df: DataFrame, y: str, p: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of 0/1 columns in one pass; a measure
    without any row to count is null."""
    yes, hit = F.col(y) == 1, F.col(p) == 1
    tp = F.sum((yes & hit).cast("double"))
    hits, real = F.sum(hit.cast("double")), F.sum(yes.cast("double"))
    return df.agg(
        F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"),
        F.try_divide(tp, hits).alias("precision"),
        F.try_divide(tp, real).alias("recall"),
        F.try_divide(2 * tp, hits + real).alias("f1"),
    )


def fbeta_sweep(df: DataFrame, y: str, score: str, beta: float, grid: Sequence[float]) -> DataFrame:
    """(threshold, fbeta) over a grid: one aggregate per threshold, a single pass."""
    yes = F.sum((F.col(y) == 1).cast("double"))
    b2 = beta * beta
    aggs = []
    for i, th in enumerate(grid):
        hit = F.col(score) > th
        tp = F.sum((hit & (F.col(y) == 1)).cast("double"))
        aggs.append(F.try_divide((1 + b2) * tp, b2 * yes + F.sum(hit.cast("double"))).alias(f"f{i}"))
    entries = ", ".join(f"{th}D, f{i}" for i, th in enumerate(grid))
    return df.agg(*aggs).selectExpr(f"stack({len(grid)}, {entries}) as (threshold, fbeta)")


def soft_kappa(df: DataFrame, y: str, p: str) -> DataFrame:
    """Loss -2 * sum(y p) / (sum(y²) + sum(p²))."""
    a, b = F.col(y), F.col(p)
    return df.agg(F.try_divide(-2 * F.sum(a * b), F.sum(a * a) + F.sum(b * b)).alias("soft_kappa"))


def ensemble_mean(frames: Sequence[DataFrame], key: str, logp: str) -> DataFrame:
    """Mean probability per key of several scorers that emit log probabilities."""
    joined = frames[0]
    for f in frames[1:]:
        joined = joined.unionByName(f)
    return joined.groupBy(key).agg(F.avg(F.exp(logp)).alias("probability"))


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept with the mean squared error, one pass."""
    got = df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("_r2"), F.var_pop(y).alias("_v"),
    )
    return got.select("slope", "intercept", (F.col("_v") * (1 - F.col("_r2"))).alias("mse"))


def bias_model(ratings: DataFrame, user: str, item: str, rating: str, lo: float, hi: float) -> DataFrame:
    """Rating by overall mean + user bias + item bias, clipped to the rating range.

    The user bias is the mean residual; the item bias the mean of what is left.
    """
    mean = ratings.agg(F.avg(rating).alias("_m"))
    r = ratings.join(F.broadcast(mean)).withColumn("_e", F.col(rating) - F.col("_m"))
    r = with_group_stats(r, [user], _bu=F.avg("_e")).withColumn("_e2", F.col("_e") - F.col("_bu"))
    r = with_group_stats(r, [item], _bi=F.avg("_e2"))
    raw = F.col("_m") + F.col("_bu") + F.col("_bi")
    out = r.withColumn("predicted", F.least(F.greatest(raw, F.lit(lo)), F.lit(hi)))
    return out.drop("_m", "_e", "_bu", "_e2", "_bi")


# ---- fitted models ---------------------------------------------------------------


def features(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df.drop(out))


#: Rows of a task when rows are dealt anew for a forest.
FOREST_ROWS = 200_000


def dealt(df: DataFrame) -> DataFrame:
    """The rows in tasks of about ``FOREST_ROWS``, if now a task has over twice as many and clearly more than a core's share.

    A forest passes all rows once a level. A well packed file is a few splits, which would be
    all the tasks that do this, however many cores there are. Rows that are spread well stay where they are.
    """
    sizes = df.groupBy(F.spark_partition_id().alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    rows, most = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if (most or 0) <= max(2 * FOREST_ROWS, 1.5 * (rows or 0) / df.sparkSession.sparkContext.defaultParallelism):
        return df
    return df.repartition(ceil(rows / FOREST_ROWS))


def fit_forest(train: DataFrame, label: str, trees: int = 20, min_leaf: int = 3, share: str = "onethird", rows: float = 0.7, depth: int = 8, seed: int = 42):
    """Random forest regression; rows are sampled per tree by ``rows``."""
    return RandomForestRegressor(
        labelCol=label, numTrees=trees, minInstancesPerNode=min_leaf, featureSubsetStrategy=share,
        subsamplingRate=rows, maxDepth=depth, seed=seed,
    ).fit(dealt(train))


def fit_forest_classifier(train: DataFrame, label: str, trees: int = 20, min_leaf: int = 3, depth: int = 8, seed: int = 42):
    return RandomForestClassifier(labelCol=label, numTrees=trees, minInstancesPerNode=min_leaf, maxDepth=depth, seed=seed).fit(dealt(train))


def importances(df: DataFrame, model, cols: Sequence[str], least: float = 0.0) -> DataFrame:
    """(feature, importance) above ``least``, largest first."""
    rows = [(c, float(v)) for c, v in zip(cols, model.featureImportances.toArray(), strict=True)]
    return literal_rows(df.sparkSession, rows, "feature string, importance double").where(F.col("importance") > least)


def drop_column_importance(train: DataFrame, valid: DataFrame, label: str, cols: Sequence[str], **kw) -> DataFrame:
    """(feature, loss): what the holdout R² loses when a column is left out."""

    def score(names: Sequence[str]) -> float:
        model = fit_forest(features(train, names).select("features", label), label, **kw)
        scored = model.transform(features(valid, names))
        return metrics_regression(scored, label, "prediction").first()["r2"]

    full = score(cols)
    rows = [(c, full - score([x for x in cols if x != c])) for c in cols]
    return literal_rows(train.sparkSession, rows, "feature string, loss double")


def tree_spread(df: DataFrame, model, group: str) -> DataFrame:
    """Mean prediction and its deviation across the trees, averaged per group."""
    names = []
    for i, tree in enumerate(model.trees):
        names.append(f"_t{i}")
        df = tree.setPredictionCol(names[-1]).transform(df)
    each = F.array(*names)
    mean = F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / len(names)
    scored = df.select(group, each.alias("_e"), mean.alias("_m"))
    var = F.aggregate(F.transform("_e", lambda x: (x - F.col("_m")) ** 2), F.lit(0.0), lambda a, x: a + x) / len(names)
    return scored.select(group, "_m", F.sqrt(var).alias("_s")).groupBy(group).agg(
        F.avg("_m").alias("mean"), F.avg("_s").alias("spread"), F.count(F.lit(1)).alias("n")
    )


def partial_dependence(df: DataFrame, model, cols: Sequence[str], grid: Mapping[str, Sequence[float]]) -> DataFrame:
    """Mean prediction with the grid columns set to every grid point.

    The grid is a short literal list exploded on each row; one or two columns.
    """
    for c, points in grid.items():
        df = df.drop(c).withColumn(c, F.explode(F.array(*[F.lit(float(p)) for p in points])))
    scored = model.transform(features(df, cols))
    return scored.groupBy(*grid).agg(F.avg("prediction").alias("mean_prediction"))


def group_dependence(df: DataFrame, model, cols: Sequence[str], group: Sequence[str]) -> DataFrame:
    """(column, mean_prediction) for a one-hot group: each of its columns set to 1 in turn, the others to 0.

    The group is a short list of columns, exploded on each row.
    """
    picked = df.withColumn("column", F.explode(F.array(*[F.lit(c) for c in group])))
    picked = picked.withColumns({c: (F.col("column") == c).cast("double") for c in group})
    scored = model.transform(features(picked, cols))
    return scored.groupBy("column").agg(F.avg("prediction").alias("mean_prediction"))


def dependence_curves(df: DataFrame, model, key: str, cols: Sequence[str], column: str, points: Sequence[float], clusters: int = 3, seed: int = 42) -> DataFrame:
    """Cluster the per-row dependence curves: (cluster, n, curve)."""
    from pyspark.ml.clustering import KMeans

    grid = df.drop(column).withColumn(column, F.explode(F.array(*[F.lit(float(p)) for p in points])))
    scored = model.transform(features(grid, cols)).select(key, column, "prediction")
    at = {p: F.max(F.when(F.col(column) == p, F.col("prediction"))) for p in points}
    curves = scored.groupBy(key).agg(F.array(*[at[p] for p in points]).alias("curve"))
    centred = curves.withColumn("shape", F.transform("curve", lambda x: x - F.col("curve")[0]))
    got = KMeans(k=clusters, seed=seed, featuresCol="v").fit(v := centred.withColumn("v", array_to_vector("shape"))).transform(v)
    means = F.array(*[F.avg(F.col("curve")[i]) for i in range(len(points))])
    return got.groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n"), means.alias("curve"))


def adversarial_columns(train: DataFrame, valid: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """Columns that tell training from validation rows: importances of a classifier."""
    both = train.select(*cols).withColumn("_valid", F.lit(0.0)).unionByName(valid.select(*cols).withColumn("_valid", F.lit(1.0)))
    model = fit_forest_classifier(features(both, cols).select("features", "_valid"), "_valid", **kw)
    return importances(train, model, cols)


def fit_lasso(train: DataFrame, label: str, penalties: Sequence[float] = (0.001, 0.01, 0.1, 1.0), folds: int = 3, seed: int = 42):
    """Lasso with the penalty chosen by cross-validation."""
    lr = LinearRegression(labelCol=label, elasticNetParam=1.0)
    grid = ParamGridBuilder().addGrid(lr.regParam, list(penalties)).build()
    judge = RegressionEvaluator(labelCol=label, metricName="rmse")
    return CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=seed).fit(train).bestModel


def coefficients(df: DataFrame, model, cols: Sequence[str], least: float = 0.01) -> DataFrame:
    """(feature, coefficient) with absolute value of at least ``least``."""
    rows = [(c, float(v)) for c, v in zip(cols, model.coefficients.toArray(), strict=True) if abs(v) >= least]
    return literal_rows(df.sparkSession, rows, "feature string, coefficient double")


#: Ratings of a block of users or of items, about. A task of a factorisation holds one block, and the
#: factors of the other side that its ratings name.
ALS_RATINGS = 1_000_000


#: Iterations between two checkpoints of a factorisation of small rank, at most, and the rank that is checkpointed in each.
ALS_APART, ALS_WIDE = 4, 50


def als_blocks(n: int) -> int:
    """Blocks of a factorisation of ``n`` ratings: Spark's own number, or more where blocks would be larger than ``ALS_RATINGS``."""
    return max(10, ceil(n / ALS_RATINGS))


def fit_als(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 50, iterations: int = 5, reg: float = 0.1, seed: int = 42):
    """Factors by alternating least squares.

    Upon a checkpoint of the item factors Spark deletes the shuffle files before it; the disk holds about the
    messages of one iteration at rank ``ALS_WIDE`` instead of all of them. A checkpoint works the
    factors out twice, so those of a small rank are made up to ``ALS_APART`` iterations apart. Blocks follow the number
    of ratings, so what a task holds does not grow with it.
    """
    checkpoint_dir(ratings.sparkSession)
    blocks = als_blocks(ratings.count())
    return ALS(
        userCol=user, itemCol=item, ratingCol=rating, rank=rank, maxIter=iterations, regParam=reg, numUserBlocks=blocks, numItemBlocks=blocks,
        coldStartStrategy="drop", seed=seed, checkpointInterval=min(ALS_APART, max(1, ALS_WIDE // rank)),
    ).fit(ratings)


def clipped(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return df.withColumn(col, F.least(F.greatest(F.col(col).cast("double"), F.lit(lo)), F.lit(hi)))


def item_components(model, k: int = 3) -> DataFrame:
    """(id, components): principal components of the item factors."""
    f = model.itemFactors.select("id", array_to_vector("features").alias("features"))
    return PCA(k=k, inputCol="features", outputCol="pca").fit(f).transform(f).select("id", vector_to_array("pca").alias("components"))


def numbered_terms(terms: DataFrame) -> DataFrame:
    """The vocabulary with dense numbers from 0 (``index``), by a distributed numbering in order of the terms."""
    return ranked(terms, [F.col("term")], "index").withColumn("index", (F.col("index") - 1).cast("int"))


#: Terms of a vocabulary that is sent to all tasks, at most (some 100 bytes each).
SENT_TERMS = 1_000_000


def among(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """The rows whose term is in the vocabulary, whose terms are all different, with its columns. Up to ``SENT_TERMS`` terms go
    to the rows; a larger vocabulary is joined by term, where rows of frequent ones are spread by ``df``, if it has that."""
    with shuffles_dropped(vocab.sparkSession):
        small = vocab.count() <= SENT_TERMS
    if small:
        return counts.join(F.broadcast(vocab), "term")
    if "df" not in vocab.columns:
        return counts.join(vocab, "term")
    marked = vocab.withColumn("_known", F.lit(True))
    return attach(counts, marked, ["term"], "df").where("_known").drop("_known")


def term_vectors(lists: DataFrame, vocab: DataFrame, key: str, binary: bool = False, weight: str | None = None) -> DataFrame:
    """Sparse ``features`` per document from its array of ``terms``: counts (or 0/1) of the vocabulary
    (term, index, df), times a weight per term if it has that column; and ``total``, their sum.

    The vocabulary goes to the terms, or above ``SENT_TERMS`` both meet by term: only a document's own terms
    come together. For 0/1, copies go as they come together. Vectors are put together as Spark stores them, written, and read back as vectors.
    """
    if binary:
        counts = lists.select(key, F.explode(F.array_distinct("terms")).alias("term"))
    else:
        counts = lists.select(key, F.explode("terms").alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).cast("double").alias("_c"))
    known = among(counts, vocab.select("term", "index", "df", *([weight] if weight else [])))
    value = (F.lit(1.0) if binary else F.col("_c")) * (F.coalesce(weight, F.lit(0.0)) if weight else F.lit(1.0))
    gather = F.collect_set if binary else F.collect_list
    own = known.groupBy(key).agg(F.sort_array(gather(F.struct("index", value.alias("value")))).alias("_t"))
    size = vocab.agg(F.count(F.lit(1)).cast("int").alias("_size"))
    found = F.coalesce("_t", F.array().cast("array<struct<index:int,value:double>>"))
    packed = F.struct(F.lit(0).cast("tinyint").alias("type"), F.col("_size").alias("size"), found["index"].alias("indices"), found["value"].alias("values"))
    total = F.aggregate(found["value"], F.lit(0.0), lambda x, y: x + y)
    rows = lists.drop("terms").join(own, key, "left").join(F.broadcast(size))
    with shuffles_dropped(lists.sparkSession):
        written = materialise(rows.select(*[c for c in lists.columns if c != "terms"], packed.alias("features"), total.alias("total")))
    fields = [StructField("features", VectorUDT()) if f.name == "features" else f for f in written.schema.fields]
    return lists.sparkSession.read.schema(StructType(fields)).parquet(written._written)


def fit_logistic(train: DataFrame, label: str, c: float, intercept: bool = True, iterations: int = 50):
    """Logistic regression with the penalty given as C, as regParam = 1 / (C n)."""
    n = train.count()
    return LogisticRegression(
        labelCol=label, regParam=1.0 / (c * max(n, 1)), fitIntercept=intercept, maxIter=iterations, standardization=False
    ).fit(train)


def interpolated_scores(rows: DataFrame, model, beta: float, out: str = "prediction") -> DataFrame:
    """0/1 predictions with the model's weights pulled towards their mean size: (1 - beta) * mean|w| + beta * w.

    Both parts of a row's score follow from the model's own and from the ``total`` of its vector.
    The score itself is in a column named after ``out``.
    """
    size = float(abs(model.coefficients.toArray()).mean())
    own = vector_to_array("rawPrediction")[1] - F.lit(model.intercept)
    score = (1 - beta) * size * F.col("total") + beta * own + F.lit(model.intercept)
    return model.transform(rows).withColumn(f"{out}_score", score).withColumn(out, (F.col(f"{out}_score") > 0).cast("double"))


def text_time_classifier(text: str, times: Sequence[str], label: str, hi: int = 5, max_features: int = 100_000) -> Pipeline:
    """TF-IDF of 1- to ``hi``-grams and time features side by side, joined into one classifier."""
    grams = [NGram(n=n, inputCol="_words", outputCol=f"_g{n}") for n in range(1, hi + 1)]
    every = ", ".join(f"_g{n}" for n in range(1, hi + 1))
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"\s+"),
            *grams,
            SQLTransformer(statement=f"SELECT *, concat({every}) AS _terms FROM __THIS__"),
            CountVectorizer(inputCol="_terms", outputCol="_counts", vocabSize=max_features),
            IDF(inputCol="_counts", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol="_text"),
            VectorAssembler(inputCols=list(times), outputCol="_times"),
            VectorAssembler(inputCols=["_text", "_times"], outputCol="features"),
            LogisticRegression(labelCol=label, maxIter=30),
        ]
    )
