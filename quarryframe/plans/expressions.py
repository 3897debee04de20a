"""Queries for gates, camera and score formulas, nested values and label subsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryframe.functions import geometry as geo
from quarryframe.functions import nested
from quarryframe.functions import text as tx
from quarryframe.operators import manifest, masks
from quarryframe.session import table

from .registry import query


@query("gate_or_all", "F2", "SELECT 'some' AS gate, count(*) AS kept FROM orders WHERE o_totalprice < 50000 UNION ALL SELECT 'none', count(*) FROM orders")
def gate_or_all(spark, d):
    """A gate that nothing passes is switched off."""
    o = table(spark, d, "orders")
    some, none = (manifest.gate_or_all(o, F.col("o_totalprice") < most) for most in (50000, 0))
    return some.select(F.lit("some").alias("gate")).unionAll(none.select(F.lit("none").alias("gate"))).groupBy("gate").agg(F.count("*").alias("kept"))


_FLAGS = [f"(CAST(l_quantity AS INT) * {k + 3} + l_linenumber) % 23 - 1" for k in range(8)]


@query("all_flags_done", "F3", f"SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING bool_and({' AND '.join(f'({x}) <> -1' for x in _FLAGS)})")
def all_flags_done(spark, d):
    """Clips of which every row has all eight flags."""
    l = table(spark, d, "lineitem").select("l_orderkey", *[F.expr(x).alias(f"flag{k}") for k, x in enumerate(_FLAGS)])
    return manifest.finished(l, ["l_orderkey"], [f"flag{k}" for k in range(8)])


@query(
    "camera_formulas", "G5 G6 R9",
    """WITH c AS (SELECT p_partkey, p_size * 40 AS w, p_size * 30 + 7 AS h, p_size / 40 + 0.2 AS fov FROM part), f AS (SELECT *, 1.2 * greatest(w, h) AS focal FROM c)
    SELECT p_partkey, round(focal, 6) AS focal, round(w / (2 * tan(fov / 2)), 6) AS from_fov, round(2 * atan(w / (2 * focal)), 6) AS fov, round(0.3 * focal / 2.5 + w / 2, 6) AS u, round(-0.7 * focal / 2.5 + h / 2, 6) AS v FROM f""",
)
def camera_formulas(spark, d):
    w, h, fov = F.col("p_size") * 40, F.col("p_size") * 30 + 7, F.col("p_size") / 40 + 0.2
    focal = geo.heuristic_focal(w, h)
    at = geo.project(F.struct(F.lit(0.3).alias("x"), F.lit(-0.7).alias("y"), F.lit(2.5).alias("z")), focal, focal, w / 2, h / 2)
    named = {"focal": focal, "from_fov": geo.focal_from_fov(fov, w), "fov": geo.fov_from_focal(focal, w), "u": at["u"], "v": at["v"]}
    return table(spark, d, "part").select("p_partkey", *[F.round(c, 6).alias(n) for n, c in named.items()])


_SILHOUETTE = "SELECT l_orderkey, l_linenumber, l_partkey % 50 AS a, l_suppkey % 40 AS b, least(l_partkey % 50, l_suppkey % 40) // 2 AS c, l_discount AS r, l_tax AS t FROM lineitem"
_SCORES = f"SELECT l_orderkey, l_linenumber, c / greatest(a + b - c, 1) AS iou, (a - c) / greatest(a, 1) AS overflow, (b - c) / greatest(b, 1) AS underfill, r, t FROM ({_SILHOUETTE})"


@query("silhouette_scores", "M6 G9", f"SELECT l_orderkey, l_linenumber, round(iou, 6) AS iou, round(overflow, 6) AS overflow, round(underfill, 6) AS underfill, round(iou - 0.7 * underfill - 0.3 * overflow - 0.5 * r - t - 0.3 * (r * 40 / 10 + t), 6) AS score FROM ({_SCORES})")
def silhouette_scores(spark, d):
    a, b = F.col("l_partkey") % 50, F.col("l_suppkey") % 40
    l = table(spark, d, "lineitem").withColumn("m", masks.silhouette_metrics(F.floor(F.least(a, b) / 2), a, b))
    score = geo.tracking_score(F.col("m.iou"), F.col("m.underfill"), F.col("m.overflow"), F.col("l_discount"), F.col("l_tax"), F.col("l_discount") * 40, F.col("l_tax"))
    return l.select("l_orderkey", "l_linenumber", *[F.round(f"m.{n}", 6).alias(n) for n in ("iou", "overflow", "underfill")], F.round(score, 6).alias("score"))


_CELL = "CAST(floor((least(greatest({x}, -0.5 + 1e-6), 0.5 - 1e-6) + 0.5) * 64) AS INT)"


@query("voxel_cells", "G10", f"SELECT i, j, count(*) AS n FROM (SELECT {_CELL.format(x='CAST(embedding[1] AS DOUBLE) * 2')} AS i, {_CELL.format(x='CAST(embedding[2] AS DOUBLE) * 2')} AS j FROM embeddings) GROUP BY i, j")
def voxel_cells(spark, d):
    e = table(spark, d, "embeddings").select(*[geo.voxel_grid(F.col("embedding")[k].cast("double") * 2).alias(n) for k, n in enumerate("ij")])
    return e.groupBy("i", "j").agg(F.count("*").alias("n"))


@query(
    "replace_and_prefix", "P17",
    """WITH n AS (SELECT c_nationkey, min(c_name) AS a, max(c_name) AS b FROM customer GROUP BY 1)
    SELECT c_nationkey, replace(replace(a, 'Customer', 'Clip'), '#0', '_') AS renamed, CAST(len(list_filter(range(1, least(length(a), length(b)) + 1), lambda i: a[1:i] = b[1:i])) AS INT) AS shared FROM n""",
)
def replace_and_prefix(spark, d):
    """The smallest and the largest string of a group share what all of them share."""
    n = table(spark, d, "customer").groupBy("c_nationkey").agg(F.min("c_name").alias("a"), F.max("c_name").alias("b"))
    return n.select("c_nationkey", tx.replace_all(F.col("a"), {"Customer": "Clip", "#0": "_"}).alias("renamed"), tx.common_prefix_length(F.array("a", "b")).cast("int").alias("shared"))


_BOX = "SELECT l_orderkey, l_linenumber, l_partkey % 100 AS x0, l_suppkey % 100 AS y0, l_partkey % 100 + 60 AS x1, l_suppkey % 100 + 50 AS y1 FROM lineitem"
_NEAR = " OR ".join(f"(abs({v} - {crop}) <= 20 AND abs({v} - {image}) > 20)" for v, crop, image in (("x0", 40, 0), ("y0", 30, 0), ("x1", 140, 640), ("y1", 130, 480)))


@query("crop_edges", "M9", f"SELECT l_orderkey, l_linenumber, {_NEAR} AS near FROM ({_BOX})")
def crop_edges(spark, d):
    x, y = F.col("l_partkey") % 100, F.col("l_suppkey") % 100
    box = lambda *v: dict(zip(("x0", "y0", "x1", "y1"), map(F.lit, v)))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", geo.near_crop_edge(x, y, x + 60, y + 50, box(40, 30, 140, 130), box(0, 0, 640, 480)).alias("near"))


@query("class_subset", "P14", "SELECT l_orderkey, l_linenumber, CAST(CASE l_linenumber WHEN 4 THEN 0 WHEN 2 THEN 1 WHEN 7 THEN 2 ELSE -1 END AS INT) AS label FROM lineitem")
def class_subset(spark, d):
    names = ["hand", "cup", "pan", "lid", "bowl", "jar", "pot", "fork"]
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tx.class_subset(F.col("l_linenumber"), names, ["bowl", "pan", "fork"]).alias("label"))


@query(
    "nested_averages", "P16",
    """WITH v AS (SELECT 'size/' || p_brand AS key, CAST(p_size AS DOUBLE) AS x FROM part UNION ALL SELECT 'price/all', CASE WHEN p_size > 40 THEN NULL ELSE p_retailprice END FROM part UNION ALL SELECT 'price/none', NULL FROM part)
    SELECT key, round(avg(x), 4) AS mean FROM v GROUP BY key""",
)
def nested_averages(spark, d):
    """Through the flat form and back, then averaged by flat key."""
    price = F.when(F.col("p_size") > 40, F.lit(float("nan"))).otherwise(F.col("p_retailprice"))
    m = F.create_map(F.lit("size"), F.create_map("p_brand", F.col("p_size").cast("double")), F.lit("price"), F.create_map(F.lit("all"), price, F.lit("none"), F.lit(None).cast("double")))
    flat = table(spark, d, "part").select(nested.flattened(m).alias("flat"))
    again = flat.select(nested.flattened(nested.unflattened(F.col("flat"))).alias("flat"))
    return nested.key_averages(again, "flat").select("key", F.round("mean", 4).alias("mean"))


@query(
    "forward_wins", "U4",
    """WITH f AS (SELECT l_orderkey AS k, l_linenumber % 3 AS obj, max(l_quantity) AS v FROM lineitem WHERE l_linenumber <= 3 AND l_quantity > 20 GROUP BY 1, 2), b AS (SELECT l_orderkey AS k, l_linenumber % 3 AS obj, min(l_quantity) AS v FROM lineitem GROUP BY 1, 2)
    SELECT b.k, b.obj, coalesce(f.v, b.v) AS v FROM b LEFT JOIN f ON b.k = f.k AND b.obj = f.obj""",
)
def forward_wins(spark, d):
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") % 3).alias("obj"), "l_quantity", "l_linenumber")
    forward = l.where("l_linenumber <= 3 and l_quantity > 20").groupBy("k", "obj").agg(F.max("l_quantity").alias("v"))
    return manifest.first_wins(forward, l.groupBy("k", "obj").agg(F.min("l_quantity").alias("v")), ["k", "obj"])


@query("mask_track_areas", "A4", "SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT) + l_partkey % 7) AS BIGINT) AS total_area, count(*) AS track_length, CAST(max(CAST(l_quantity AS BIGINT) + l_partkey % 7) AS BIGINT) AS largest FROM lineitem GROUP BY 1")
def mask_track_areas(spark, d):
    """Areas of run-length masks, summed by track."""
    counts = F.array(F.col("l_linenumber").cast("long"), F.col("l_quantity").cast("long"), F.lit(5).cast("long"), (F.col("l_partkey") % 7).cast("long"))
    m = table(spark, d, "lineitem").select("l_orderkey", masks.area(counts).alias("area"))
    return m.groupBy("l_orderkey").agg(F.sum("area").alias("total_area"), F.count("*").alias("track_length"), F.max("area").alias("largest"))
