"""Remaining joins, aggregates and batch functions over the driver's tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarryframe.operators import images, manifest, masks, selection, stateful
from quarryframe.session import table

from .metrics import _run_masks
from .registry import query
from .series import FRAMES, frames


@query("annotated_assets", "J7", "SELECT p.page_id, d.doc_id, d.source FROM pages p JOIN documents d ON p.page_id = d.doc_id WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def annotated_assets(spark, d):
    p, docs = table(spark, d, "pages"), table(spark, d, "documents").select("doc_id", "source")
    good = docs.join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")
    return p.join(good, p.page_id == good.doc_id).select("page_id", "doc_id", "source")


@query("clean_frame_lookup", "J8 T11", f"WITH f AS ({FRAMES}) SELECT a.clip, a.frame, a.event_id FROM f a WHERE a.event_type = 'click' AND EXISTS (SELECT 1 FROM f b WHERE b.clip = a.clip AND b.frame = a.frame + 1 AND b.value > 20)")
def clean_frame_lookup(spark, d):
    f = frames(spark, d)
    clean = f.where("value > 20").select("clip", (F.col("frame") - 1).alias("frame"))
    return f.where("event_type = 'click'").join(clean, ["clip", "frame"], "left_semi").select("clip", "frame", "event_id")


@query("length_sync", "J10", f"WITH f AS ({FRAMES}), a AS (SELECT clip, event_id, row_number() OVER (PARTITION BY clip ORDER BY frame) AS k FROM f WHERE event_type = 'click'), b AS (SELECT clip, event_id, row_number() OVER (PARTITION BY clip ORDER BY frame) AS k FROM f WHERE event_type = 'view') SELECT a.clip, a.k AS at, a.event_id AS a_id, b.event_id AS b_id FROM a JOIN b ON a.clip = b.clip AND a.k = b.k")
def length_sync(spark, d):
    f = frames(spark, d)
    at = F.row_number().over(Window.partitionBy("clip").orderBy("frame")).cast("long").alias("at")
    a, b = (f.where(F.col("event_type") == t).select("clip", at, F.col("event_id").alias(f"{s}_id")) for t, s in (("click", "a"), ("view", "b")))
    return a.join(b, ["clip", "at"])


@query("work_units", "A1 A4", "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY 1")
def work_units(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("numeric_stem_order", "R8 O1", "SELECT stem, row_number() OVER (ORDER BY CAST(stem AS INT)) AS rank FROM (SELECT CAST(n_nationkey AS VARCHAR) AS stem FROM nation)")
def numeric_stem_order(spark, d):
    stems = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("stem"), F.col("n_nationkey").cast("int").alias("number"))
    return manifest.with_global_rank(stems, ["number"]).select("stem", (F.col("rank") + 1).alias("rank"))


@query(
    "mixture", "U7",
    "WITH h AS (SELECT c_custkey, c_mktsegment, md5(c_custkey || ':1') AS h FROM customer) SELECT c_custkey, c_mktsegment FROM h WHERE CAST('0x' || substr(h, 1, 8) AS BIGINT) % 10000 < CASE c_mktsegment WHEN 'BUILDING' THEN 5000 WHEN 'MACHINERY' THEN 2500 ELSE 1000 END",
)
def mixture(spark, d):
    """Rows drawn from three sources by fixed shares, by a seeded hash."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    share = F.when(F.col("c_mktsegment") == "BUILDING", 0.5).when(F.col("c_mktsegment") == "MACHINERY", 0.25).otherwise(0.1)
    ticket = F.conv(F.substring(F.md5(F.concat_ws(":", "c_custkey", F.lit("1"))), 1, 8), 16, 10).cast("long") % 10_000
    return c.where(ticket < share * 10_000)


def _dense(counts, rows: int = 10) -> np.ndarray:
    counts = [int(x) for x in counts]
    missing = -sum(counts) % rows
    if missing:
        counts = [*counts, missing] if len(counts) % 2 == 0 else [*counts[:-1], counts[-1] + missing]
    return masks.decode(counts, rows, sum(counts) // rows)


@query("mask_points", "M20 N2 M16 D-9 D-10 M4", None)
def mask_points(spark, d):
    """Seeded points on and around each clip's mask; its compressed run lengths; a padded and cut round trip."""
    rows = _run_masks(spark, d, 30).withColumn("counts", F.col("counts").cast("array<int>"))

    def run(batches):
        for batch in batches:
            out = []
            for clip, counts in zip(batch["clip"], batch["counts"]):
                m = _dense(counts)
                square, box = images.pad_square(m.astype(np.uint8))
                same = bool((images.cut_square(square, box) == m).all())
                on, off = images.sample_points(m, 4, 42, int(clip)), images.negative_points(m, np.zeros_like(m), (3, 1, 0), (0, 2), 3, 42, int(clip))
                out.append((clip, on.ravel().tolist(), off.ravel().tolist(), masks.to_compressed(masks.encode(m)), int(images.dilated_foreground(m).sum()), same))
            yield pd.DataFrame(out, columns=["clip", "points", "negatives", "compressed", "dilated", "round_trip"])

    return rows.mapInPandas(run, "clip long, points array<long>, negatives array<long>, compressed string, dilated long, round_trip boolean")


@query("depth_filters", "G12 N6", None)
def depth_filters(spark, d):
    """Depth erosion and bilateral smoothing of an 8 x 8 depth map made of each vector."""
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            out = []
            for key, v in zip(batch["vec_id"], batch["v"]):
                depth = np.asarray(v).reshape(8, -1) + 1
                out.append((key, int((images.eroded_depth(depth, 1, 0.2, 0.6) > 0).sum()), float(images.bilateral_depth(depth, 1, 0.3).mean())))
            yield pd.DataFrame(out, columns=["vec_id", "kept", "mean_depth"])

    return rows.mapInPandas(run, "vec_id long, kept long, mean_depth double")


@query("scale_search", "S10 S11", None)
def scale_search(spark, d):
    """Per label the scale between two halves of its vectors that minimises a log-quadratic loss."""
    rows = table(spark, d, "embeddings").select("label", "vec_id", F.slice("embedding", 1, 3).cast("array<double>").alias("p"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        p = np.array(group.sort_values("vec_id")["p"].tolist())
        half = len(p) // 2
        ratio = stateful.frame_scale(p[:half], p[half:]) if half > 2 else 1.0
        return pd.DataFrame({"label": [group["label"].iloc[0]], "scale": [stateful.best_scale(lambda s: (np.log(s) - np.log(ratio)) ** 2, 0.2, 5.0)]})

    return rows.groupBy("label").applyInPandas(run, "label int, scale double")


@query("training_clips", "N3", None)
def training_clips(spark, d):
    """Eight neighbouring frames of each clip, seeded by the clip, backwards for half of them."""
    n = frames(spark, d).groupBy("clip").agg(F.count("*").alias("n")).where("n >= 8")

    def run(batches):
        for batch in batches:
            yield pd.DataFrame([(c, images.contiguous_frames(int(k), 8, 0.5, int(c))) for c, k in zip(batch["clip"], batch["n"])], columns=["clip", "frames"])

    return n.mapInPandas(run, "clip long, frames array<long>")


@query(
    "resumable_sample", "N5",
    "WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY md5('12|' || c_custkey)) - 1 AS pos, count(*) OVER () AS n FROM customer), p AS (SELECT c_custkey, pos + n * k AS pos, n FROM r, range(0, 2) t(k)) SELECT c_custkey, pos % 7 AS worker, pos // 7 AS step FROM p WHERE pos < ceil(n / 7) * 7 AND pos // 7 >= 3",
)
def resumable_sample(spark, d):
    return selection.resumable_sample(table(spark, d, "customer"), "c_custkey", 7, seed=10, epoch=2, done=3)


@query("top_assets", "O6 W7", "SELECT p_brand, p_partkey, rank FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) WHERE rank <= 3")
def top_assets(spark, d):
    return selection.top_k(table(spark, d, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 3).select("p_brand", "p_partkey", F.col("rank").cast("long").alias("rank"))
