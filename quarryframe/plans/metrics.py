"""Queries for evaluation, geometry, vectors and masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryframe.functions import geometry as geo
from quarryframe.operators import evaluation as ev
from quarryframe.operators import masks, runs
from quarryframe.session import table

from .registry import query
from .series import FRAMES, frames

_PIXELS = "SELECT l_orderkey, CAST(l_linenumber % 5 AS INT) AS pred, CASE WHEN l_quantity > 48 THEN 255 ELSE CAST((l_linenumber + CAST(l_quantity > 25 AS INT)) % 4 AS INT) END AS label FROM lineitem"


def _pixels(spark, d) -> DataFrame:
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    return table(spark, d, "lineitem").select("l_orderkey", (n % 5).alias("pred"), F.when(q > 48, 255).otherwise((n + (q > 25).cast("int")) % 4).alias("label"))


_AREAS = f"""WITH px AS ({_PIXELS}), k AS (SELECT * FROM px WHERE label <> 255), c AS (SELECT CAST(unnest(range(0, 6)) AS INT) AS cls),
a AS (SELECT cls, (SELECT count(*) FROM k WHERE pred = cls AND label = cls) AS i, (SELECT count(*) FROM k WHERE pred = cls) AS p, (SELECT count(*) FROM k WHERE label = cls) AS l FROM c)"""


@query(
    "class_iou_dice_f", "A7 A8 A9",
    _AREAS + """ SELECT cls, i AS intersect, p AS predicted, l AS labelled, p + l - i AS "union", CASE WHEN p + l - i = 0 THEN -1 ELSE round(i / (p + l - i), 6) END AS iou, CASE WHEN l = 0 THEN CASE WHEN i = 0 THEN -1 END ELSE round(i / l, 6) END AS acc,
    CASE WHEN p + l = 0 THEN -1 ELSE round(2 * i / (p + l), 6) END AS dice, CASE WHEN p = 0 THEN -1 ELSE round(i / p, 6) END AS "precision", CASE WHEN l = 0 THEN -1 ELSE round(i / l, 6) END AS recall,
    CASE WHEN p = 0 OR l = 0 OR i = 0 THEN -1 ELSE round(2 * (i / p) * (i / l) / (i / p + i / l), 6) END AS fscore FROM a""",
)
def class_iou_dice_f(spark, d):
    m = ev.class_metrics(ev.class_areas(_pixels(spark, d), "pred", "label", 6), nan_to=-1.0)
    return m.withColumns({c: F.round(c, 6) for c in ("iou", "acc", "dice", "precision", "recall", "fscore")})


@query("segmentation_summary", "A10", _AREAS + " SELECT round(sum(i) / sum(l), 6) AS all_acc, round_even(avg(CASE WHEN p + l - i > 0 THEN i / (p + l - i) END) * 100, 2) / 100 AS mean_iou, round_even(avg(CASE WHEN l > 0 THEN i / l END) * 100, 2) / 100 AS mean_acc FROM a")
def segmentation_summary(spark, d):
    m = ev.class_metrics(ev.class_areas(_pixels(spark, d), "pred", "label", 6))
    return ev.summary(m, ["iou", "acc"]).withColumn("all_acc", F.round("all_acc", 6))


@query("confusion_matrix", "A11", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2")
def confusion_matrix(spark, d):
    return ev.confusion(table(spark, d, "labels"), "toxic", "quality")


@query("depth_metrics", "A17", "WITH r AS (SELECT l_returnflag, l_extendedprice / 1000 AS t, l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 AS p FROM lineitem), o AS (SELECT *, greatest(t / p, p / t) AS off, ln(p) - ln(t) AS g FROM r WHERE p > 0 AND t > 0) SELECT l_returnflag, round(count(*) FILTER (off < 1.05) / count(*), 6) AS close, round(count(*) FILTER (off < 1.25) / count(*), 6) AS d1, round(count(*) FILTER (off < pow(1.25, 2)) / count(*), 6) AS d2, round(count(*) FILTER (off < pow(1.25, 3)) / count(*), 6) AS d3, round(avg(abs(p - t) / t), 6) AS abs_rel, round(avg(pow(p - t, 2) / t), 6) AS sq_rel, round(sqrt(avg(pow(p - t, 2))), 6) AS rmse, round(sqrt(avg(g * g)), 6) AS rmse_log, round(avg(abs(log10(p) - log10(t))), 6) AS log10, round(sqrt(avg(g * g) - 0.5 * pow(avg(g), 2)), 6) AS silog FROM o GROUP BY 1")
def depth_metrics(spark, d):
    l = table(spark, d, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / 1000).alias("t"), (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 1000).alias("p"))
    out = ev.depth_metrics(l, "p", "t", ["l_returnflag"])
    off = F.greatest(F.col("t") / F.col("p"), F.col("p") / F.col("t"))
    near = l.groupBy("l_returnflag").agg((F.count_if(off < 1.05) / F.count("*")).alias("close"))
    names = ["close", "d1", "d2", "d3", "abs_rel", "sq_rel", "rmse", "rmse_log", "log10", "silog"]
    return out.join(near, "l_returnflag").select("l_returnflag", *[F.round(c, 6).alias(c) for c in names])


@query("depth_rmse", "A25", "WITH r AS (SELECT l_returnflag, l_extendedprice * (1 - l_discount) / 1000 AS p, l_extendedprice / 1000 AS t FROM lineitem WHERE l_quantity > 25 AND l_linenumber < 5) SELECT l_returnflag, round(sqrt(avg(pow(p - t, 2))), 6) AS rmse, round(sqrt(avg(pow(p - t, 2))) / greatest(median(t), 1e-6), 6) AS rmse_norm FROM r GROUP BY 1")
def depth_rmse(spark, d):
    price = F.col("l_extendedprice")
    l = table(spark, d, "lineitem").select("l_returnflag", (price * (1 - F.col("l_discount")) / 1000).alias("p"), (price / 1000).alias("t"), (F.col("l_quantity") > 25).alias("a"), (F.col("l_linenumber") < 5).alias("b"))
    return ev.depth_rmse(l, "p", "t", F.col("a") & F.col("b"), ["l_returnflag"]).select("l_returnflag", F.round("rmse", 6).alias("rmse"), F.round("rmse_norm", 6).alias("rmse_norm"))


_BOXES = "SELECT p_partkey, p_size AS x, p_size % 7 AS y, p_size + 4 AS w, p_size % 9 + 3 AS h, p_size + p_partkey % 5 AS x2, p_size % 7 + p_partkey % 3 AS y2, p_size + 6 AS w2, p_size % 9 + 2 AS h2 FROM part"
_IOU = "SELECT *, greatest(least(x + w, x2 + w2) - greatest(x, x2), 0) * greatest(least(y + h, y2 + h2) - greatest(y, y2), 0) AS common FROM b"


def _boxes(spark, d) -> DataFrame:
    s, k = F.col("p_size"), F.col("p_partkey")
    b = table(spark, d, "part").select("p_partkey", s.alias("x"), (s % 7).alias("y"), (s + 4).alias("w"), (s % 9 + 3).alias("h"), (s + k % 5).alias("x2"), (s % 7 + k % 3).alias("y2"), (s + 6).alias("w2"), (s % 9 + 2).alias("h2"))
    return b.withColumn("iou", geo.box_iou(*[F.col(c).cast("double") for c in ("x", "y", "w", "h", "x2", "y2", "w2", "h2")]))


@query("box_iou", "M8 M9", f"WITH b AS ({_BOXES}), c AS ({_IOU}) SELECT p_partkey, round(common / (w * h + w2 * h2 - common), 6) AS iou, greatest(x - greatest(w // 10, 1), 0) AS x0, least(x + w + greatest(w // 10, 1), 50) AS x1 FROM c")
def box_iou(spark, d):
    box = geo.padded_box(F.col("x"), F.col("y"), F.col("w"), F.col("h"), 0.1, F.lit(50), F.lit(50))
    return _boxes(spark, d).withColumn("box", box).select("p_partkey", F.round("iou", 6).alias("iou"), F.col("box.x0").cast("int").alias("x0"), F.col("box.x1").cast("int").alias("x1"))


@query("ap_at_iou", "A15", f"WITH b AS ({_BOXES}), c AS ({_IOU}), i AS (SELECT common / (w * h + w2 * h2 - common) AS iou, x % 3 AS g FROM c) SELECT g, round(avg(iou), 6) AS mean, round(count(*) FILTER (iou > 0.25) / count(*), 6) AS ap25, round(count(*) FILTER (iou > 0.5) / count(*), 6) AS ap50, round(count(*) FILTER (iou > 0.75) / count(*), 6) AS ap75 FROM i GROUP BY g")
def ap_at_iou(spark, d):
    out = ev.precision_at(_boxes(spark, d).withColumn("g", F.col("x") % 3), "iou", [0.25, 0.5, 0.75], ["g"])
    return out.select("g", *[F.round(c, 6).alias(c) for c in ("mean", "ap25", "ap50", "ap75")])


@query("occluded_miou", "A16", f"WITH b AS ({_BOXES}), c AS ({_IOU}), i AS (SELECT x % 3 AS g, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE common END / (w * h + w2 * h2 - common + 1e-6) AS v FROM c) SELECT g, round(avg(v), 6) AS miou, round(avg(v) FILTER (v >= 1e-6), 6) AS miou_occ FROM i GROUP BY g")
def occluded_miou(spark, d):
    """Of every fourth object nothing that is hidden was found."""
    b, both = _boxes(spark, d), F.col("w") * F.col("h") + F.col("w2") * F.col("h2")
    common = F.greatest(F.least(F.col("x") + F.col("w"), F.col("x2") + F.col("w2")) - F.greatest("x", "x2"), F.lit(0)) * F.greatest(F.least(F.col("y") + F.col("h"), F.col("y2") + F.col("h2")) - F.greatest("y", "y2"), F.lit(0))
    i = b.select((F.col("x") % 3).alias("g"), F.when(F.col("p_partkey") % 4 == 0, 0).otherwise(common).alias("common"), (both - common).alias("union"))
    return ev.occluded_miou(i, "common", "union", ["g"]).select("g", F.round("miou", 6).alias("miou"), F.round("miou_occ", 6).alias("miou_occ"))


@query(
    "point_errors", "A18",
    """WITH e AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), p AS (SELECT label, v[1] AS x, v[2] AS y, v[3] + 2 AS z, v[1] + v[4] AS a, v[2] + v[5] AS b, v[3] + 2 + v[6] AS c, 0.5 + abs(v[7]) AS s FROM e),
    n AS (SELECT *, sqrt((a - x) * (a - x) + (b - y) * (b - y) + (c - z) * (c - z)) AS e, sqrt(x * x + y * y + z * z) AS t, sqrt(a * a + b * b + c * c) AS p FROM p)
    SELECT label, round(avg(abs(c - z) / (z + 1e-6)), 5) AS rel_depth, round(avg(CAST(greatest(z / c, c / z) < 1.25 AS INT)), 5) AS delta1_depth, round(avg(e / (t + 1e-6)), 5) AS rel_point,
    round(avg(CAST(e < 0.25 * least(t, p) AS INT)), 5) AS delta1_point, round(avg(e / s), 5) AS rel_local, round(avg(CAST(e < 0.25 * s AS INT)), 5) AS delta1_local FROM n GROUP BY label""",
)
def point_errors(spark, d):
    v = [F.col("embedding")[i].cast("double") for i in range(7)]
    p = table(spark, d, "embeddings").select("label", v[0].alias("x"), v[1].alias("y"), (v[2] + 2).alias("z"), (v[0] + v[3]).alias("a"), (v[1] + v[4]).alias("b"), (v[2] + 2 + v[5]).alias("c"), (F.abs(v[6]) + 0.5).alias("s"))
    out = ev.point_errors(p, ["a", "b", "c"], ["x", "y", "z"], "s", ["label"])
    return out.select("label", *[F.round(c, 5).alias(c) for c in out.columns[1:]])


@query("add_auc", "A19", "WITH e AS (SELECT l_returnflag AS k, l_discount AS e FROM lineitem), n AS (SELECT k, count(*) AS n FROM e GROUP BY 1), t AS (SELECT i FROM range(0, 101) t(i)), a AS (SELECT n.k, t.i, (SELECT count(*) FROM e WHERE e.k = n.k AND e.e <= t.i * 0.001 + 1e-12) / n.n AS acc FROM n, t), b AS (SELECT k, i, acc, lag(acc) OVER (PARTITION BY k ORDER BY i) AS p FROM a) SELECT k, round(sum((acc + p) / 2) / 100, 6) AS auc FROM b WHERE p IS NOT NULL GROUP BY k")
def add_auc(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("k"), F.col("l_discount").alias("e"))
    return ev.auc(e, "e", ["k"], 0.1, 0.001).withColumn("auc", F.round("auc", 6))


@query("latent_stats", "A20", "WITH u AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) SELECT CAST(dim AS INT) AS dim, round(avg(x), 5) AS mean, round(sqrt(greatest(avg(x * x) - pow(avg(x), 2), 0)), 5) AS std FROM u GROUP BY dim")
def latent_stats(spark, d):
    return ev.latent_stats(table(spark, d, "embeddings"), "vec_id", "embedding").select("dim", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"))


@query("cosine_topk", "J19 G13 O3", "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), p AS (SELECT a.vec_id AS q, b.vec_id AS k, 1 - list_cosine_similarity(a.v, b.v) AS dist FROM e a, e b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(dist, 9), k) AS rank FROM p WHERE abs(dist) > 1e-12) SELECT q, k, rank, round(dist, 5) AS dist FROM r WHERE rank <= 5")
def cosine_topk(spark, d):
    """Stated queries (ids divisible by 20) in blocks against all rows: exact, one pass over the vectors for each block of 1,000."""
    from quarryframe.operators.vectors import nearest_vectors

    e = table(spark, d, "embeddings")
    return nearest_vectors(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", 5).select("q", "k", "rank", F.round("dist", 5).alias("dist"))


@query("voxel_dedup", "A26 G10", "WITH p AS (SELECT vec_id, embedding[1] AS x, embedding[2] AS y, embedding[3] AS z FROM embeddings) SELECT min(vec_id) AS vec_id FROM p GROUP BY floor(CAST(x AS DOUBLE) / 0.05), floor(CAST(y AS DOUBLE) / 0.05), floor(CAST(z AS DOUBLE) / 0.05)")
def voxel_dedup(spark, d):
    p = table(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")])
    return ev.first_in_voxel(p, [], "x", "y", "z", "vec_id", 0.05).select("vec_id")


@query("backproject", "G1 R9", "SELECT vec_id, round((CAST(embedding[1] AS DOUBLE) * 400 + 300 - 320) * z / 500, 6) AS x, round((CAST(embedding[2] AS DOUBLE) * 400 + 200 - 240) * z / 480, 6) AS y, round(z, 6) AS z FROM (SELECT *, CAST(embedding[3] AS DOUBLE) + 2 AS z FROM embeddings) WHERE z > 0")
def backproject(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("abc")])
    p = geo.back_project(F.col("a") * 400 + 300, F.col("b") * 400 + 200, F.col("c") + 2, F.lit(500.0), F.lit(480.0), F.lit(320.0), F.lit(240.0))
    return e.withColumn("p", p).where("p is not null").select("vec_id", *[F.round(f"p.{c}", 6).alias(c) for c in "xyz"])


@query("rigid_round_trip", "G3 G4 G6", "SELECT vec_id, round(CAST(embedding[5] AS DOUBLE), 4) AS x, round(CAST(embedding[6] AS DOUBLE), 4) AS y, round(CAST(embedding[7] AS DOUBLE), 4) AS z FROM embeddings")
def rigid_round_trip(spark, d):
    """A point through a pose and back through its inverse."""
    e = table(spark, d, "embeddings")
    v = [F.col("embedding")[i].cast("double") for i in range(8)]
    r = geo.quaternion_to_matrix(v[0] + 2, v[1], v[2], v[3])
    pose = F.array(r[0], r[1], r[2], F.lit(0.5), r[3], r[4], r[5], F.lit(-1.0), r[6], r[7], r[8], F.lit(2.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    out = e.select("vec_id", "embedding", pose.alias("m")).withColumn("p", geo.transform_point(F.col("m"), v[4], v[5], v[6]))
    back = geo.transform_point(geo.rigid_inverse(F.col("m")), F.col("p.x"), F.col("p.y"), F.col("p.z"))
    return out.withColumn("b", back).select("vec_id", *[(F.round(f"b.{c}", 4) + 0.0).alias(c) for c in "xyz"])


@query("means", "G8 G7", "SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS weighted, round(sum(l_quantity) / sum(l_quantity / l_extendedprice), 4) AS harmonic, round(exp(sum(l_quantity * ln(l_extendedprice)) / sum(l_quantity)), 4) AS geometric, round(regr_slope(l_extendedprice, l_quantity), 4) AS scale, round(regr_intercept(l_extendedprice, l_quantity), 3) AS shift FROM lineitem GROUP BY 1")
def means(spark, d):
    x, w = F.col("l_extendedprice"), F.col("l_quantity")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.sum(x * w) / F.sum(w), 4).alias("weighted"), F.round(F.sum(w) / F.sum(w / x), 4).alias("harmonic"), F.round(F.exp(F.sum(w * F.ln(x)) / F.sum(w)), 4).alias("geometric"),
        F.round(F.regr_slope(x, w), 4).alias("scale"), F.round(F.regr_intercept(x, w), 3).alias("shift"),
    )


def _run_masks(spark, d, least: int) -> DataFrame:
    """Run-length masks of the clips: frames are pixels of a mask of 10 rows, on where the value is over `least`."""
    f = frames(spark, d).select("clip", "frame", (F.col("value") > least).alias("on"))
    seg = runs.run_segments(f, ["clip"], "frame", "on")
    counts = F.transform(F.sort_array(F.collect_list(F.struct("first_at", "on", "length"))), lambda x: x["length"])
    first = F.min_by("on", "first_at")
    return seg.groupBy("clip").agg(F.when(first, F.concat(F.array(F.lit(0).cast("long")), counts)).otherwise(counts).alias("counts"))


@query("rle_area_iou", "M1 M3 M5 M6 U5", f"WITH f AS ({FRAMES}), c AS (SELECT clip, count(*) FILTER (value > 25 AND value > 35) AS i, count(*) FILTER (value > 25) AS a, count(*) FILTER (value > 35 OR value < 3) AS b, count(*) FILTER (value > 25 AND (value > 35 OR value < 3)) AS ab FROM f GROUP BY clip) SELECT clip, a AS area, round(CASE WHEN i > 0 THEN i / a ELSE 0 END, 6) AS iou FROM c")
def rle_area_iou(spark, d):
    low, high = _run_masks(spark, d, 25), _run_masks(spark, d, 35)
    common = masks.intersections(masks.runs(low, ["clip"]), masks.runs(high, ["clip"]), ["clip"], 16)
    joined = low.withColumn("a", masks.area(F.col("counts"))).join(high.select("clip", masks.area(F.col("counts")).alias("b")), "clip").join(common, "clip", "left")
    return joined.select("clip", F.col("a").alias("area"), F.round(masks.iou(F.coalesce("common", F.lit(0)), F.col("a"), F.col("b")), 6).alias("iou"))


@query("rle_bounding_box", "M7", f"WITH f AS ({FRAMES}) SELECT clip, min(frame // 10) AS x0, min(frame % 10) AS y0, max(frame // 10) AS x1, max(frame % 10) AS y1 FROM f WHERE value > 25 GROUP BY clip")
def rle_bounding_box(spark, d):
    r = masks.runs(_run_masks(spark, d, 25), ["clip"])
    return masks.bounding_box(r, ["clip"], F.lit(10))


@query("stability_score", "M14", "SELECT vec_id, round(len(list_filter(embedding, lambda x: x > 0.05)) / nullif(len(list_filter(embedding, lambda x: x > -0.05)), 0), 6) AS stability FROM embeddings")
def stability_score(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(masks.stability(F.col("embedding").cast("array<double>"), 0.0, 0.05), 6).alias("stability"))


@query("smallest_id_wins", "D-4 D-5", f"WITH f AS ({FRAMES}), o AS (SELECT clip, frame // 4 AS px, CASE WHEN value > 50 THEN 1 WHEN value > 25 THEN 2 WHEN value > 10 THEN 3 END AS obj FROM f) SELECT clip, px, min(obj) AS label FROM o WHERE obj IS NOT NULL GROUP BY 1, 2")
def smallest_id_wins(spark, d):
    v = F.col("value")
    o = frames(spark, d).select("clip", F.floor(F.col("frame") / 4).alias("px"), F.when(v > 50, 1).when(v > 25, 2).when(v > 10, 3).alias("obj")).where("obj is not null")
    return o.groupBy("clip", "px").agg(F.min("obj").alias("label"))


@query("mask_morphology", "M2 M10 M11 M12 M13 M15 S12 A13", None)
def mask_morphology(spark, d):
    """Run-length masks of each clip decoded, opened, and measured: components, boundary length, boundary F against the raw mask."""
    import pandas as pd

    rows = _run_masks(spark, d, 18).withColumn("counts", F.col("counts").cast("array<int>"))

    def run(batches):
        for batch in batches:
            out = []
            for clip, counts in zip(batch["clip"], batch["counts"]):
                n = int(sum(counts))
                dense = masks.decode([*counts, -n % 10] if len(counts) % 2 == 0 else [*counts[:-1], counts[-1] + -n % 10], 10, -(-n // 10))
                kept = masks.opened(dense, masks.disk(1))
                out.append((clip, int(dense.sum()), int(kept.sum()), masks.components(dense)[1], int(masks.boundary(dense).sum()), masks.boundary_f(kept, dense)))
            yield pd.DataFrame(out, columns=["clip", "area", "opened_area", "n_components", "boundary_pixels", "boundary_f"])

    return rows.mapInPandas(run, "clip long, area long, opened_area long, n_components long, boundary_pixels long, boundary_f double")


@query(
    "chamfer_distance", "A27 J18",
    """WITH e AS (SELECT label, vec_id, CAST(embedding[1:3] AS DOUBLE[]) AS p FROM embeddings), d AS (SELECT a.label, a.vec_id AS i, b.vec_id AS j, list_distance(a.p, b.p) AS d FROM e a JOIN e b ON b.label = a.label + 1),
    x AS (SELECT label, avg(d) AS m FROM (SELECT label, i, min(d) AS d FROM d GROUP BY 1, 2) GROUP BY 1), y AS (SELECT label, avg(d) AS m FROM (SELECT label, j, min(d) AS d FROM d GROUP BY 1, 2) GROUP BY 1)
    SELECT l.label, coalesce(round(x.m + y.m, 6), CAST('infinity' AS DOUBLE)) AS chamfer FROM (SELECT label FROM e UNION SELECT label - 1 FROM e) l LEFT JOIN x USING (label) LEFT JOIN y USING (label)""",
)
def chamfer_distance(spark, d):
    """Chamfer distance between the points (three vector dimensions) of neighbouring labels."""
    import numpy as np
    import pandas as pd

    from quarryframe.operators.stateful import chamfer

    e = table(spark, d, "embeddings").select("label", F.slice("embedding", 1, 3).cast("array<double>").alias("p"))
    both = e.select("label", "p", F.lit(0).alias("side")).unionByName(e.select((F.col("label") - 1).alias("label"), "p", F.lit(1).alias("side")))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        a, b = (np.array(group.loc[group["side"] == s, "p"].tolist()).reshape(-1, 3) for s in (0, 1))
        return pd.DataFrame({"label": [group["label"].iloc[0]], "chamfer": [round(chamfer(a, b), 6)]})

    return both.groupBy("label").applyInPandas(run, "label int, chamfer double")


@query("pose_clusters", "S4", None)
def pose_clusters(spark, d):
    import numpy as np
    import pandas as pd

    from quarryframe.operators.stateful import cluster_poses

    e = table(spark, d, "embeddings").select("label", "vec_id", F.slice("embedding", 1, 4).cast("array<double>").alias("p"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        poses = []
        for p in group["p"]:
            pose = np.eye(4)
            a = float(p[3]) * 3
            pose[:2, :2], pose[:3, 3] = [[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]], p[:3]
            poses.append(pose)
        ids = group["vec_id"].to_numpy()
        return pd.DataFrame({"label": group["label"].iloc[0], "vec_id": ids, "founder": ids[cluster_poses(poses, 40.0, 0.3)]})

    return e.groupBy("label").applyInPandas(run, "label int, vec_id long, founder long")


def _objects(spark, d) -> DataFrame:
    """Points of objects of 64 vectors each."""
    return table(spark, d, "embeddings").select(F.expr("vec_id div 64").alias("object"), "vec_id", F.slice("embedding", 1, 4).cast("array<double>").alias("p"))


@query("point_spans", "A28", None)
def point_spans(spark, d):
    """Hull diameter, span along the first principal axis and visible diameter of each object."""
    import numpy as np
    import pandas as pd

    from quarryframe.operators.stateful import hull_diameter, pca_span, visible_diameter

    def run(group: pd.DataFrame) -> pd.DataFrame:
        p = np.array(group["p"].tolist())[:, :3]
        return pd.DataFrame({"object": [group["object"].iloc[0]], "hull": [hull_diameter(p)], "span": [pca_span(p)], "visible": [visible_diameter(p)]})

    return _objects(spark, d).groupBy("object").applyInPandas(run, "object long, hull double, span double, visible double")


@query("scene_normalisation", "S9", None)
def scene_normalisation(spark, d):
    """Translation and scale that bring each object's biggest cluster of points into the unit box."""
    import numpy as np
    import pandas as pd

    from quarryframe.operators.stateful import scene_normalisation

    def run(group: pd.DataFrame) -> pd.DataFrame:
        p = np.array(group.sort_values("vec_id")["p"].tolist())[:, :3]
        move, scale, keep = scene_normalisation(p)
        return pd.DataFrame([(group["object"].iloc[0], *move, scale, int(keep.sum()))], columns=["object", "x", "y", "z", "scale", "kept"])

    return _objects(spark, d).groupBy("object").applyInPandas(run, "object long, x double, y double, z double, scale double, kept long")


@query("pose_errors", "A19", None)
def pose_errors(spark, d):
    """ADD and ADD-S of each object's points under a pose that is turned by its first point's fourth value and shifted."""
    import numpy as np
    import pandas as pd

    from quarryframe.operators.stateful import add_error, adds_error

    def run(group: pd.DataFrame) -> pd.DataFrame:
        p = np.array(group.sort_values("vec_id")["p"].tolist())
        pose, a = np.eye(4), p[0, 3]
        pose[:2, :2], pose[:3, 3] = [[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]], 0.01
        return pd.DataFrame({"object": [group["object"].iloc[0]], "add": [add_error(pose, np.eye(4), p[:, :3])], "adds": [adds_error(pose, np.eye(4), p[:, :3])]})

    return _objects(spark, d).groupBy("object").applyInPandas(run, "object long, add double, adds double")


@query("depth_boundary_f1", "A18", None)
def depth_boundary_f1(spark, d):
    """Depth edges of each clip (frames as pixels of rows of 10) against those of the same depths cut to whole numbers."""
    import numpy as np
    import pandas as pd

    from quarryframe.operators.stateful import depth_boundary_f1

    def run(clip: pd.DataFrame) -> pd.DataFrame:
        z = clip.sort_values("frame")["value"].to_numpy(float)
        z = np.pad(z, (0, -len(z) % 10)).reshape(-1, 10)
        return pd.DataFrame({"clip": [clip["clip"].iloc[0]], "f1": [depth_boundary_f1(np.floor(z), z, np.floor(z) > 0)]})

    return frames(spark, d).select("clip", "frame", "value").groupBy("clip").applyInPandas(run, "clip long, f1 double")


@query("bounding_window_rank", "O5 W7", f"WITH f AS ({FRAMES}), c AS (SELECT clip, frame, value, row_number() OVER (PARTITION BY clip ORDER BY value DESC, frame) AS r FROM f) SELECT clip, frame, r AS rank FROM c WHERE r <= 5")
def bounding_window_rank(spark, d):
    from quarryframe.operators.selection import top_k

    return top_k(frames(spark, d), ["clip"], [F.desc("value"), F.col("frame")], 5).select("clip", "frame", F.col("rank").cast("long").alias("rank"))


@query(
    "tile_aspect", "M19 M17",
    """WITH g AS (SELECT w, h, w / h AS r FROM (SELECT unnest(range(1, 7)) AS w) a, (SELECT unnest(range(1, 7)) AS h) b WHERE w * h <= 6), p AS (SELECT p_partkey, p_size * 20000 AS area, (p_size + 4) / (p_size % 9 + 3) AS a FROM part),
    s AS (SELECT p_partkey, area, w, h, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(a - r), w * h, w) AS k, rank() OVER (PARTITION BY p_partkey ORDER BY abs(a - r)) AS tie, r FROM p, g), f AS (SELECT * FROM s WHERE k = 1),
    b AS (SELECT s.p_partkey, max(s.w * s.h) AS m FROM s JOIN f ON s.p_partkey = f.p_partkey AND s.tie = 1 AND s.area > 0.5 * 448 * 448 * s.w * s.h GROUP BY 1)
    SELECT f.p_partkey, CAST(f.w AS INT) AS cols, CAST(f.h AS INT) AS n_rows, CAST(coalesce(b.m, f.w * f.h) AS INT) AS tiles_by_area FROM f LEFT JOIN b USING (p_partkey)""",
)
def tile_aspect(spark, d):
    a = (F.col("p_size") + 4) / (F.col("p_size") % 9 + 3)
    p = table(spark, d, "part").select("p_partkey", geo.closest_tiling(a, 6).alias("g"), geo.closest_tiling(a, 6, F.col("p_size") * 20000).alias("b"))
    return p.select("p_partkey", F.col("g.w").alias("cols"), F.col("g.h").alias("n_rows"), (F.col("b.w") * F.col("b.h")).alias("tiles_by_area"))


@query(
    "crop_boxes", "P22",
    """WITH i AS (SELECT p_partkey, p_size * 13 + 40 AS w, p_size * 7 + 30 AS h FROM part), o AS (SELECT *, CAST(floor(least(w, h) * CAST(0.34133 AS DOUBLE) * 1.0) AS BIGINT) AS ov FROM i),
    c AS (SELECT *, CAST(ceil((ov + w) / 2) AS BIGINT) AS cw, CAST(ceil((ov + h) / 2) AS BIGINT) AS ch FROM o)
    SELECT p_partkey, 0 AS layer, CAST(0 AS BIGINT) AS x0, CAST(0 AS BIGINT) AS y0, CAST(w AS BIGINT) AS x1, CAST(h AS BIGINT) AS y1 FROM c
    UNION ALL SELECT p_partkey, 1, (cw - ov) * a, (ch - ov) * b, least((cw - ov) * a + cw, w), least((ch - ov) * b + ch, h) FROM c, range(0, 2) s(a), range(0, 2) t(b)""",
)
def crop_boxes(spark, d):
    box = geo.crop_boxes(F.col("p_size") * 13 + 40, F.col("p_size") * 7 + 30, 1, 0.34133)
    return table(spark, d, "part").select("p_partkey", F.inline(box))


@query("point_grid", "P22", "SELECT i // 4 AS r, i % 4 AS c, (i % 4 + 0.5) / 4 AS x, (i // 4 + 0.5) / 4 AS y FROM range(0, 16) t(i)")
def point_grid(spark, d):
    g = spark.range(1).select(F.posexplode(geo.point_grid(4)).alias("i", "p"))
    return g.select(F.floor(F.col("i") / 4).alias("r"), (F.col("i") % 4).cast("long").alias("c"), "p.x", "p.y")


@query("sphere_views", "P21", "WITH q AS (SELECT i, i / 24.0::DOUBLE AS u, list_sum([((i // CAST(pow(2, k) AS BIGINT)) % 2) / pow(2, k + 1) FOR k IN range(0, 10)]) AS v FROM range(0, 24) t(i)) SELECT i, round(v * 2 * pi(), 6) AS yaw, round(acos(greatest(1 - 2 * CASE WHEN u < 0.25 THEN 2 * u ELSE u * (2 / 3.0::DOUBLE) + 1 / 3.0::DOUBLE END, -1)) - pi() / 2, 6) AS pitch FROM q")
def sphere_views(spark, d):
    s = spark.range(24).select(F.col("id").alias("i"), geo.hammersley_sphere(F.col("id"), 24).alias("s"))
    return s.select("i", F.round("s.yaw", 6).alias("yaw"), F.round("s.pitch", 6).alias("pitch"))
