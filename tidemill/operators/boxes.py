"""Boxes: corners, overlap, detection filter, non-max suppression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.vectors import let
from tidemill.operators.scale import attach
from tidemill.session import materialise

BOX = ("x1", "y1", "x2", "y2")


def corners(h: Column, w: Column, x: Column, y: Column) -> dict[str, Column]:
    """(height, width, x, y) to corner columns, floored at zero."""
    zero = F.lit(0.0)
    return {
        "x1": F.greatest(x, zero), "y1": F.greatest(y, zero),
        "x2": F.greatest(x + w, zero), "y2": F.greatest(y + h, zero),
    }


def area(b: dict[str, Column]) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])


def cols(prefix: str = "") -> dict[str, Column]:
    return {c: F.col(prefix + c) for c in BOX}


def iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection over union of two boxes."""
    zero = F.lit(0.0)
    w = F.greatest(F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]), zero)
    h = F.greatest(F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]), zero)
    inter = w * h
    return inter / F.nullif(area(a) + area(b) - inter, zero)


def overlap_with_largest(df: DataFrame, image: str, tie: str) -> DataFrame:
    """Each box with its overlap to the largest box of its image."""
    best = df.groupBy(image).agg(
        F.max_by(F.struct(*BOX), F.struct(area(cols()), F.col(tie))).alias("_m"), F.count(F.lit(1)).alias("_n")
    )
    both = attach(df, best, [image], "_n")
    return both.withColumn("iou", iou(cols(), cols("_m."))).drop("_m", "_n")


def box_filter(df: DataFrame, conf: Column, probs: Column, limit: float) -> DataFrame:
    """Best class per box: score = confidence * probability, kept from ``limit`` on."""
    scores = let(conf, lambda c: F.transform(probs, lambda p: c * p))
    best = df.withColumn("_s", scores).withColumn("score", F.array_max("_s"))
    return best.withColumn("class", F.array_position("_s", F.col("score")) - 1).where(F.col("score") >= limit).drop("_s")


#: Boxes of an image that are worked through in one row; images of more go round by round.
ROW_BOXES = 1_000


def nms(df: DataFrame, image: str, box_id: str, score: str = "score", max_boxes: int = 10, limit: float = 0.5) -> DataFrame:
    """Greedy non-max suppression per image: best scores first, ties by box id.

    The boxes of an image with up to ``ROW_BOXES`` are shuffled once and gathered in a row, where they
    are passed in order. Of fuller images, rows / ``ROW_BOXES`` at most, none is gathered in one
    task: round by round the best remaining box of each is kept (one map-side combined aggregate),
    and boxes that overlap it by more than ``limit`` leave. There are at most ``max_boxes`` rounds,
    each written once, which keeps the plan short. Boxes without an image are handled like those of
    a full one; their best is kept.
    """
    names = [image, box_id, score, *BOX]
    # Boxes may share an id; a row number, fixed by the first write, tells them apart.
    every = materialise(df.select(*names, F.monotonically_increasing_id().alias("_row")))
    full = materialise(every.groupBy(image).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > ROW_BOXES).select(image))
    in_rows = every.drop("_row").where(F.col(image).isNotNull()).join(F.broadcast(full), image, "left_anti")
    kept = [_nms_in_rows(in_rows, image, box_id, score, max_boxes, limit)]

    pick = F.max_by(F.struct("_row", box_id, score, *BOX), F.struct(F.col(score), -F.col(box_id), F.struct(*BOX), "_row"))
    left = every.where(F.col(image).isNull()).unionByName(every.join(F.broadcast(full), image, "left_semi").select(*every.columns))
    left = materialise(left)
    for _ in range(max_boxes):
        if left.isEmpty():
            break
        best = left.groupBy(image).agg(pick.alias("_b"), F.count(F.lit(1)).alias("_n"))
        kept.append(best.select(image, "_b.*"))
        both = attach(left, best, [image], "_n")
        apart = F.coalesce(iou(cols(), cols("_b.")), F.lit(0.0)) <= limit
        left = materialise(both.where((F.col("_row") != F.col("_b._row")) & apart).select(*names, "_row"))
    return reduce(DataFrame.unionByName, [k.select(*names) for k in kept])


def _nms_in_rows(df: DataFrame, image: str, box_id: str, score: str, max_boxes: int, limit: float) -> DataFrame:
    """The boxes kept of images of few boxes: one shuffle, then a pass over each image's sorted boxes."""
    box = F.struct(F.col(score).alias("s"), (-F.col(box_id)).alias("_i"), F.struct(*BOX).alias("b"), F.col(box_id).alias("i"))
    corner = lambda k: {c: k["b"][c] for c in BOX}
    overlaps = lambda k, o: F.coalesce(iou(corner(o), corner(k)), F.lit(0.0)) > limit

    def next_box(taken: Column, o: Column) -> Column:
        out = (F.size(taken) >= max_boxes) | F.exists(taken, lambda k: overlaps(k, o))
        return F.when(out, taken).otherwise(F.concat(taken, F.array(o)))

    # Gathered behind the shuffle: a list per image and task ahead of it would combine little.
    lists = df.repartition(image).groupBy(image).agg(F.sort_array(F.collect_list(box), asc=False).alias("_o"))
    rest = F.slice("_o", F.lit(2), F.size("_o"))
    taken = lists.select(image, F.explode(F.aggregate(rest, F.slice("_o", 1, 1), next_box)).alias("_k"))
    return taken.select(image, F.col("_k.i").alias(box_id), F.col("_k.s").alias(score), *[F.col(f"_k.b.{c}").alias(c) for c in BOX])
