"""Ratings by biases and latent factors together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import vectors as V
from tidemill.operators.modelling import fit_als
from tidemill.operators.scale import attach
from tidemill.session import discard, materialise, shuffles_dropped


@dataclass
class BiasFactors:
    """rating = mean + user bias + item bias + user factors . item factors, within [lo, hi].

    ``users`` and ``items`` hold a bias, factors (``_p``, ``_q``; null if there are none) and the
    number of ratings both come from. A user or item that was not rated in training has neither.
    """

    user: str
    item: str
    mean: float
    lo: float
    hi: float
    users: DataFrame
    items: DataFrame

    def parts(self, rows: DataFrame) -> DataFrame:
        """The rows with ``_bu``, ``_bi`` and ``_f``, the three parts that add up to the mean."""
        out = attach(attach(rows, self.users, [self.user], "_n").drop("_n"), self.items, [self.item], "_n").drop("_n")
        product = F.when(F.col("_p").isNotNull() & F.col("_q").isNotNull(), V.dot(V.doubles(F.col("_p")), V.doubles(F.col("_q"))))
        return out.fillna(0.0, ["_bu", "_bi"]).withColumn("_f", F.coalesce(product, F.lit(0.0))).drop("_p", "_q")

    def predict(self, rows: DataFrame, out: str = "predicted") -> DataFrame:
        raw = F.lit(self.mean) + F.col("_bu") + F.col("_bi") + F.col("_f")
        return self.parts(rows).withColumn(out, F.least(F.greatest(raw, F.lit(self.lo)), F.lit(self.hi))).drop("_bu", "_bi", "_f")


def _biases(rows: DataFrame, key: str, residual: Column, penalty: float, name: str) -> DataFrame:
    """Mean residual per key, pulled towards 0 as if ``penalty`` more ratings had none."""
    n = F.count(F.lit(1))
    return rows.groupBy(key).agg((F.sum(residual) / (n + penalty)).alias(name), n.alias("_n"))


def fit_bias_factors(
    ratings: DataFrame, user: str, item: str, rating: str, lo: float, hi: float, rank: int = 10, rounds: int = 3,
    bias_penalty: float = 5.0, penalty: float = 0.1, iterations: int = 8, seed: int = 42,
) -> BiasFactors:
    """Alternate between the biases, given the factors, and the factors, given the biases.

    Each side is fitted to what the other one leaves of the ratings. ``rank`` 0 leaves
    the factors out. Users and items are integers, as the factorisation needs them.
    Every round's residuals are written once, and the rows with their user's bias; the round before is
    deleted, as are shuffle files. What the last round leaves is not worked out, as nothing is fitted to it.
    """
    with shuffles_dropped(ratings.sparkSession):
        plain = ratings.select(user, item, F.col(rating).cast("double").alias("_y"))
        mean = plain.agg(F.avg("_y")).first()[0]
        model, now = None, materialise(plain.where(F.col("_y").isNotNull()).withColumns({"_bi": F.lit(0.0), "_f": F.lit(0.0)}))
        for turn in range(rounds):
            left = F.col("_y") - F.lit(mean) - F.col("_f")
            users = materialise(_biases(now, user, left - F.col("_bi"), bias_penalty, "_bu"))
            with_user = materialise(attach(now.drop("_bi"), users, [user], "_n").drop("_n"))
            items = materialise(_biases(with_user, item, left - F.col("_bu"), bias_penalty, "_bi"))
            own = [users.withColumn("_p", F.lit(None).cast("array<float>")), items.withColumn("_q", F.lit(None).cast("array<float>"))]
            if rank:
                both = attach(with_user, items, [item], "_n").drop("_n")
                residuals = materialise(both.select(user, item, (F.col("_y") - F.lit(mean) - F.col("_bu") - F.col("_bi")).cast("float").alias("_r")))
                fit = fit_als(residuals, user, item, "_r", rank, iterations, penalty, seed)
                named = lambda f, key, out: f.select(F.col("id").alias(key), F.col("features").alias(out))
                own = [users.join(named(fit.userFactors, user, "_p"), user, "left"), items.join(named(fit.itemFactors, item, "_q"), item, "left")]
                discard(residuals)
            before, model = model, BiasFactors(user, item, mean, lo, hi, materialise(own[0]), materialise(own[1]))
            discard(with_user, users, items, *((before.users, before.items) if before else ()))
            if turn < rounds - 1:
                after = materialise(model.parts(now.drop("_bi", "_f")).select(user, item, "_y", "_bi", "_f"))
                discard(now)
                now = after
        discard(now)
    return model


def choose_bias_factors(
    ratings: DataFrame, user: str, item: str, rating: str, lo: float, hi: float,
    grid: Sequence[tuple[int, float, float]], share: float = 0.2, **kw,
) -> tuple[BiasFactors, tuple[int, float, float]]:
    """The model fitted to all ratings with the best (rank, bias penalty, penalty) of the grid.

    The choice is made on a ``share`` of the ratings that is held out by a hash of user and item.
    """
    slot = F.pmod(F.xxhash64(user, item), F.lit(1_000_000))
    split = materialise(ratings.select(user, item, rating, (slot < int(share * 1_000_000)).alias("_held")))
    losses = []
    for rank, bias_penalty, penalty in grid:
        model = fit_bias_factors(split.where("not _held"), user, item, rating, lo, hi, rank, bias_penalty=bias_penalty, penalty=penalty, **kw)
        losses.append((rmse(model.predict(split.where("_held")), rating, "predicted"), rank, bias_penalty, penalty))
        discard(model.users, model.items)
    _, rank, bias_penalty, penalty = min(losses)
    model = fit_bias_factors(split, user, item, rating, lo, hi, rank, bias_penalty=bias_penalty, penalty=penalty, **kw)
    discard(split)
    return model, (rank, bias_penalty, penalty)


def rmse(rows: DataFrame, y: str, p: str) -> float:
    return rows.agg(F.sqrt(F.avg((F.col(y) - F.col(p)) ** 2))).first()[0]
