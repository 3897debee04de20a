"""Metrics as aggregations: partial sums by class or group, then arithmetic. 0/0 gives NaN where the metric is undefined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NAN = float("nan")


def ratio(a: Column, b: Column) -> Column:
    """a / b, NaN for 0 / 0, infinity for x / 0."""
    return F.when(b != 0, a / F.nullif(b, F.lit(0))).when(a == 0, F.lit(NAN)).otherwise(F.lit(float("inf")))


def class_areas(pixels: DataFrame, prediction: str, label: str, classes: int, ignore: int | None = 255, by: Sequence[str] = ()) -> DataFrame:
    """Per class (all of 0..classes-1): intersect, predicted, labelled and union area. Ignored labels are left out first."""
    kept = pixels.where(F.col(label) != ignore) if ignore is not None else pixels
    sides = kept.select(*by, F.explode(F.array(
        F.struct(F.col(prediction).cast("int").alias("cls"), F.lit(1).alias("p"), F.lit(0).alias("l"), (F.col(prediction) == F.col(label)).cast("int").alias("i")),
        F.struct(F.col(label).cast("int").alias("cls"), F.lit(0).alias("p"), F.lit(1).alias("l"), F.lit(0).alias("i")),
    )).alias("s")).select(*by, "s.*")
    summed = sides.where((F.col("cls") >= 0) & (F.col("cls") < classes)).groupBy(*by, "cls").agg(F.sum("i").alias("intersect"), F.sum("p").alias("predicted"), F.sum("l").alias("labelled"))
    every = pixels.sparkSession.range(classes).select(F.col("id").cast("int").alias("cls"))  # one row for each class
    groups = kept.select(*by).distinct().crossJoin(F.broadcast(every)) if by else every
    out = groups.join(summed, [*by, "cls"], "left").na.fill(0, ["intersect", "predicted", "labelled"])
    return out.withColumn("union", F.col("predicted") + F.col("labelled") - F.col("intersect"))


def class_metrics(areas: DataFrame, beta: float = 1.0, nan_to: float | None = None) -> DataFrame:
    """IoU, accuracy, dice, precision, recall and F-score by class."""
    i, p, l, u = (F.col(c) for c in ("intersect", "predicted", "labelled", "union"))
    precision, recall = ratio(i, p), ratio(i, l)
    score = ratio((1 + beta**2) * precision * recall, beta**2 * precision + recall)
    metrics = {"iou": ratio(i, u), "acc": ratio(i, l), "dice": ratio(2 * i, p + l), "precision": precision, "recall": recall, "fscore": score}
    if nan_to is not None:
        metrics = {k: F.when(F.isnan(v), nan_to).otherwise(v) for k, v in metrics.items()}
    return areas.withColumns(metrics)


def nan_mean(value: Column) -> Column:
    """Mean over what is neither NULL nor NaN; NaN if there is nothing."""
    return F.coalesce(F.avg(F.when(~F.isnan(value), value)), F.lit(NAN))


def summary(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean over classes in percent, rounded half-even to two places, then as shares again; and the overall accuracy."""
    return metrics.agg(ratio(F.sum("intersect"), F.sum("labelled")).alias("all_acc"), *[(F.bround(nan_mean(F.col(n)) * 100, 2) / 100).alias(f"mean_{n}") for n in names])


def confusion(pixels: DataFrame, prediction: str, label: str) -> DataFrame:
    return pixels.groupBy(label, prediction).agg(F.count("*").alias("n"))


def precision_at(values: DataFrame, value: str, thresholds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Mean, and shares of rows strictly above each threshold."""
    return values.groupBy(*by).agg(F.avg(value).alias("mean"), *[(F.count_if(F.col(value) > t) / F.count("*")).alias(f"ap{round(100 * t)}") for t in thresholds])


def depth_metrics(df: DataFrame, prediction: str, target: str, by: Sequence[str] = ()) -> DataFrame:
    """d1, d2, d3, abs_rel, sq_rel, rmse, rmse_log, log10 and silog over positive pairs."""
    p, t = F.col(prediction), F.col(target)
    off = F.greatest(t / p, p / t)
    ln = F.ln(p) - F.ln(t)
    return df.where((p > 0) & (t > 0)).groupBy(*by).agg(
        *[(F.count_if(off < 1.25**k) / F.count("*")).alias(f"d{k}") for k in (1, 2, 3)],
        F.avg(F.abs(p - t) / t).alias("abs_rel"), F.avg((p - t) ** 2 / t).alias("sq_rel"), F.sqrt(F.avg((p - t) ** 2)).alias("rmse"),
        F.sqrt(F.avg(ln * ln)).alias("rmse_log"), F.avg(F.abs(F.log10(p) - F.log10(t))).alias("log10"), F.sqrt(F.avg(ln * ln) - 0.5 * F.avg(ln) ** 2).alias("silog"),
    )


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str, ties: Sequence[str]) -> DataFrame:
    """The first value, in ascending order, at which the cumulative weight reaches half of the whole."""
    order = Window.partitionBy(*keys).orderBy(value, *ties).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumns({"_upto": F.sum(weight).over(order), "_all": F.sum(weight).over(Window.partitionBy(*keys))})
    return out.where(2 * F.col("_upto") >= F.col("_all")).groupBy(*keys).agg(F.min(value).alias("weighted_median"))


def trimmed_weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, ties: Sequence[str], within: float = 0.25) -> DataFrame:
    """Weighted mean of the values within a share of the weighted median; the median itself if there are none."""
    medians = weighted_median(df, keys, value, weight, ties)
    near = F.abs(F.col(value) - F.col("weighted_median")) <= within * F.col("weighted_median")
    joined = df.join(medians, list(keys))
    return joined.groupBy(*keys).agg(F.max("weighted_median").alias("weighted_median"), F.try_divide(F.sum(F.when(near, F.col(value) * F.col(weight))), F.sum(F.when(near, F.col(weight)))).alias("_m")).select(
        *keys, "weighted_median", F.coalesce("_m", "weighted_median").alias("trimmed_mean")
    )


def majority_label(df: DataFrame, keys: Sequence[str], label: str, ignored: int = 0) -> DataFrame:
    """Most frequent label but the ignored one (ties: the smallest); NULL if there is none."""
    counts = df.groupBy(*keys, label).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.max_by(F.when(F.col(label) != ignored, F.col(label)), F.when(F.col(label) != ignored, F.struct(F.col("_n"), -F.col(label)))).alias("majority"))


def auc(errors: DataFrame, error: str, by: Sequence[str], most: float, step: float) -> DataFrame:
    """Area under the accuracy-threshold curve over 0..most (trapezoids of width `step`), as a share of `most`.

    For each row the thresholds it meets form a suffix, so its contribution to the trapezoid sum is closed: no threshold join.
    """
    n = round(most / step)
    first = F.ceil(F.col(error) / step - 1e-9)
    own = F.when(first <= n, (n - first) + F.when(first > 0, 0.5).otherwise(0.0)).otherwise(0.0)
    return errors.groupBy(*by).agg((F.sum(own) / F.count("*") / n).alias("auc"))


def scored_j(frames: DataFrame, keys: Sequence[str], frame: str, intersect: str, union: str, in_truth: str, seen: str) -> DataFrame:
    """Mean J in percent by object: frames from its first sighting on, an empty union counts 1, objects never in the truth go."""
    w = Window.partitionBy(*keys).orderBy(frame).rowsBetween(Window.unboundedPreceding, 0)
    ever = F.max(F.col(in_truth).cast("int")).over(Window.partitionBy(*keys))
    out = frames.withColumns({"_on": F.max(F.col(seen).cast("int")).over(w), "_ever": ever}).where("_on = 1 and _ever = 1")
    return out.groupBy(*keys).agg((100 * F.avg(F.when(F.col(union) == 0, 1.0).otherwise(F.col(intersect) / F.nullif(F.col(union), F.lit(0))))).alias("j"), F.count("*").alias("frames"))


def latent_stats(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Per dimension the mean of the assets' means and sqrt(E[x^2] - E[x]^2), every asset with equal weight."""
    per = df.select(key, F.posexplode(vector).alias("dim", "x")).groupBy(key, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"), F.avg(F.col("x").cast("double") ** 2).alias("q"))
    return per.groupBy("dim").agg(F.avg("m").alias("mean"), F.sqrt(F.greatest(F.avg("q") - F.avg("m") ** 2, F.lit(0.0))).alias("std"))


def first_in_voxel(points: DataFrame, by: Sequence[str], x: str, y: str, z: str, index: str, size: float) -> DataFrame:
    """Voxel downsampling: of each cell the point that comes first."""
    cell = [F.floor(F.col(c) / size).alias(f"_{c}") for c in (x, y, z)]
    keyed = points.select("*", *cell)
    return keyed.groupBy(*by, f"_{x}", f"_{y}", f"_{z}").agg(F.min_by(F.struct(*points.columns), index).alias("_p")).select("_p.*")


def occluded_miou(values: DataFrame, intersect: str, union: str, by: Sequence[str] = (), least: float = 1e-6) -> DataFrame:
    """Mean IoU, and its mean over the values that are at least `least` (NaN if there are none)."""
    iou = F.col(intersect) / (F.col(union) + F.lit(1e-6))
    return values.groupBy(*by).agg(F.avg(iou).alias("miou"), F.coalesce(F.avg(F.when(iou >= least, iou)), F.lit(NAN)).alias("miou_occ"))


def depth_rmse(pixels: DataFrame, rendered: str, observed: str, inside: Column, by: Sequence[str] = ()) -> DataFrame:
    """RMSE over the pixels inside both masks, and the same by the median observed depth; infinity if there are none."""
    d, o, inf = F.when(inside, F.col(rendered) - F.col(observed)), F.when(inside, F.col(observed)), F.lit(float("inf"))
    rmse = F.sqrt(F.avg(d * d))
    return pixels.groupBy(*by).agg(F.coalesce(rmse, inf).alias("rmse"), F.coalesce(rmse / F.greatest(F.median(o), F.lit(1e-6)), inf).alias("rmse_norm"))


def point_errors(points: DataFrame, predicted: Sequence[str], truth: Sequence[str], diameter: str, by: Sequence[str] = (), eps: float = 1e-6) -> DataFrame:
    """Relative error and share within a quarter: of depth (the last coordinate), of points, and of points by a local diameter."""
    norm = lambda c: F.sqrt(sum((x * x for x in c[1:]), c[0] * c[0]))
    p, t = [F.col(c) for c in predicted], [F.col(c) for c in truth]
    err, size_p, size_t, size = norm([a - b for a, b in zip(p, t)]), norm(p), norm(t), F.col(diameter)
    share = lambda c: F.avg(c.cast("double"))
    z, w = p[-1], t[-1]
    return points.groupBy(*by).agg(
        F.avg(F.abs(z - w) / (w + eps)).alias("rel_depth"), share(F.greatest(ratio(w, z), ratio(z, w)) < 1.25).alias("delta1_depth"), F.avg(err / (size_t + eps)).alias("rel_point"),
        share(err < 0.25 * F.least(size_t, size_p)).alias("delta1_point"), F.avg(ratio(err, size)).alias("rel_local"), share(err < 0.25 * size).alias("delta1_local"),
    )
