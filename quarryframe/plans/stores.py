"""Sources and sinks over the driver's tables: what is written is read back, what is parsed was built from rows."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quarryframe.functions import geometry
from quarryframe.operators import images, masks
from quarryframe.session import shared_path, table
from quarryframe.sources import files, models

from .registry import query
from .series import FRAMES, frames


@query(
    "mask_archives",
    "R4 R5",
    "SELECT user_id AS clip, frame, label, area FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame FROM events), LATERAL (VALUES (1, event_id % 6), (2, event_id % 4)) v(label, area) WHERE area > 0",
)
def mask_archives(spark, d):
    """Archives of 2 x 5 label masks, every second clip as one stack and the others by frame number, parsed to run lengths."""

    def pack(clip: pd.DataFrame) -> pd.DataFrame:
        clip = clip.sort_values("frame")
        stack = np.zeros((len(clip), 2, 5), np.uint8)
        for i, e in enumerate(clip["event_id"]):
            stack[i, 0, : e % 6], stack[i, 1, : e % 4] = 1, 2
        out, key = io.BytesIO(), int(clip["clip"].iloc[0])
        np.savez_compressed(out, **({"masks": stack} if key % 2 else {str(f): m for f, m in zip(clip["frame"], stack)}))
        return pd.DataFrame([(f"{key}.npz", out.getvalue())], columns=["path", "content"])

    archives = frames(spark, d).select("clip", "frame", "event_id").groupBy("clip").applyInPandas(pack, "path string, content binary")
    return files.decode_archives(archives).select(F.split_part("path", F.lit("."), F.lit(1)).cast("long").alias("clip"), "frame", "label", masks.area(F.col("counts")).alias("area"))


@query("mask_store", "K3 K7 K1", "SELECT p_size % 5 AS bucket, count(*) AS n, CAST(sum(CASE WHEN p_size % 5 = 2 THEN 2 * p_size ELSE p_size END) AS BIGINT) AS area FROM part GROUP BY 1")
def mask_store(spark, d):
    """A store of run lengths by bucket; then one bucket is written again, and the others stay as they were."""
    path = shared_path(spark)
    rows = table(spark, d, "part").select((F.col("p_size") % 5).alias("bucket"), "p_partkey", F.array(F.lit(7), F.col("p_size")).alias("counts"))
    files.write_masks(rows, path, "bucket")
    files.write_masks(rows.where("bucket = 2").withColumn("counts", F.transform("counts", lambda x: 2 * x)), path, "bucket")
    return spark.read.parquet(path).groupBy("bucket").agg(F.count("*").alias("n"), F.sum(masks.area(F.col("counts"))).alias("area"))


@query("append_log", "K2", "SELECT 'F' AS stage, count(*) AS n, min(o_orderkey) AS first_key FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'O', count(*), min(o_orderkey) FROM orders WHERE o_orderstatus = 'O'")
def append_log(spark, d):
    path, orders = shared_path(spark), table(spark, d, "orders")
    for status in ("F", "O"):
        files.append_records(orders.where(F.col("o_orderstatus") == status).select(F.col("o_orderstatus").alias("stage"), "o_orderkey"), path)
    return spark.read.parquet(path).groupBy("stage").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query("versioned_manifest", "K4", "SELECT s_suppkey, s_name, s_nationkey * 2 + 1 AS derived FROM supplier")
def versioned_manifest(spark, d):
    """A derived column is added by a new version that is made from the one before."""
    root = shared_path(spark)
    files.write_version(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), root, 0)
    files.write_version(files.read_version(spark, root, 0).withColumn("derived", F.col("s_nationkey") * 2 + 1).drop("s_nationkey"), root, 1)
    return files.read_version(spark, root, 1)


@query(
    "pose_records",
    "K5",
    "SELECT p_partkey, concat_ws(chr(10), printf('1.000000 0.000000 0.000000 %.6f', CAST(p_size AS DOUBLE)), printf('0.000000 1.000000 0.000000 %.6f', p_size / 2), '0.000000 0.000000 1.000000 -0.250000', '0.000000 0.000000 0.000000 1.000000') AS pose FROM part",
)
def pose_records(spark, d):
    size = F.col("p_size").cast("double")
    zero, one = F.lit(0.0), F.lit(1.0)
    pose = F.array(one, zero, zero, size, zero, one, zero, size / 2, zero, zero, one, F.lit(-0.25), zero, zero, zero, one)
    path = shared_path(spark)
    table(spark, d, "part").select("p_partkey", files.pose_lines(pose).alias("pose")).write.parquet(path)
    return spark.read.parquet(path)


@query("scene_cameras", "R11 R10", "SELECT CAST(p_partkey AS INT) AS frame, lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS name, 500.0 + p_size AS fx, CASE WHEN p_size * 0.1 * p_size < 0.001 OR p_size * 0.1 * p_size > 100 THEN 0 ELSE round(p_size * 0.1 * p_size, 6) END AS depth FROM part")
def scene_cameras(spark, d):
    """Camera JSON of scenes of up to 64 frames, written and read as whole files; depth of a raw reading is scaled and cleaned."""
    size = F.col("p_size").cast("double")
    camera = F.struct(F.array(500 + size, F.lit(0.0), F.lit(320.0)).alias("cam_K"), (size * 0.1).alias("depth_scale"))
    scenes = table(spark, d, "part").groupBy(F.expr("p_partkey div 64").alias("scene")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("p_partkey").cast("string"), camera)))).alias("value"))
    depth = F.round(F.col("depth_scale") * (F.get("cam_K", F.lit(0)) - 500), 6)
    return files.scene_cameras(scenes).select("frame", "name", F.get("cam_K", F.lit(0)).alias("fx"), geometry.clean_depth(depth, 100.0, far_is_valid=True).alias("depth"))


def _masklet_rows(f):
    """Masklet JSON of annotated frames (every fourth); an object without a mask in a frame gets an empty one."""
    rle = lambda o: F.struct(F.array(F.lit(4), F.lit(5)).alias("size"), F.when((F.col("event_id") + o) % 3 != 0, F.lit(masks.to_compressed([2, o + 1, 17 - o]))).alias("counts"))
    annotated = f.select("clip", F.struct("frame", F.array(rle(1), rle(2)).alias("m")).alias("a")).groupBy("clip").agg(F.sort_array(F.collect_list("a")).alias("a"))
    text = F.to_json(F.struct(F.col("clip").cast("string").alias("video_id"), F.array(F.lit(1), F.lit(2)).alias("masklet_id"), F.transform("a", lambda x: x["m"]).alias("masklet")))
    found = files.masklets(annotated.select(text.alias("value")), 4)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(counts=[masks.from_compressed(c) for c in batch["counts"]])

    present = found.where("counts is not null").select("video_id", "frame", "object_id", "counts").mapInPandas(decode, "video_id string, frame int, object_id int, counts array<int>")
    planned = f.select(F.col("clip").cast("string").alias("video_id"), (F.col("frame") * 4).cast("int").alias("frame"))
    clips = planned.select("video_id").distinct().select("video_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("object_id"))
    return files.with_missing_masks(planned, clips, present, "video_id", "frame", "object_id", F.lit(20)).select("video_id", F.col("frame").cast("long").alias("frame"), "object_id", masks.area(F.col("counts")).alias("area"))


@query(
    "masklet_rows",
    "R12",
    f"WITH a AS ({FRAMES}) SELECT CAST(clip AS VARCHAR) AS video_id, 4 * frame AS frame, o AS object_id, CASE WHEN (event_id + o) % 3 = 0 THEN 0 ELSE o + 1 END AS area FROM a, (VALUES (1), (2)) v(o)",
)
def masklet_rows(spark, d):
    return _masklet_rows(frames(spark, d))


@query("amodal_rows", "R19", "SELECT s_nationkey AS video_id, s_suppkey AS frame, s_suppkey * 10 AS track_id, 6 AS area, s_suppkey + 0.5 AS x, s_suppkey % 7 + 4.0 AS amodal_w FROM supplier")
def amodal_rows(spark, d):
    """Amodal annotation JSON, in texts of a video's frames of one thousand; an annotation of an unlisted image is left out."""
    key = F.col("s_suppkey")
    image = F.struct(key.alias("id"), F.col("s_nationkey").cast("long").alias("video_id"), key.alias("frame_index"))
    mark = lambda at: F.struct(
        at.alias("image_id"), (key * 10).alias("track_id"), F.struct(F.array(F.lit(4), F.lit(5)).alias("size"), F.lit(masks.to_compressed([3, 6, 11])).alias("counts")).alias("segmentation"),
        F.array(key + 0.5, F.lit(1.0), F.lit(2.0), F.lit(3.0)).alias("bbox"), F.array(key + 0.5, F.lit(1.0), key % 7 + F.lit(4.0), F.lit(3.0)).alias("amodal_bbox"),
    )
    rows = table(spark, d, "supplier").groupBy("s_nationkey", F.expr("s_suppkey div 1000")).agg(F.collect_list(image).alias("images"), F.flatten(F.collect_list(F.array(mark(key), mark(-key - 1)))).alias("annotations"))

    def area(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(area=[sum(masks.from_compressed(c)[1::2]) for c in batch["counts"]]).drop(columns="counts")

    found = files.amodal_annotations(rows.select(F.to_json(F.struct("images", "annotations")).alias("value")))
    flat = found.select("video_id", "frame", "track_id", F.get("box", F.lit(0)).alias("x"), F.get("amodal_box", F.lit(2)).alias("amodal_w"), "counts")
    return flat.mapInPandas(area, "video_id long, frame long, track_id long, x double, amodal_w double, area long")


@query("decode_fallback", "R7", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 3 THEN NULL ELSE s_suppkey * 2 END AS frames, CASE WHEN s_suppkey % 4 = 3 THEN NULL ELSE s_suppkey % 4 END AS level, s_suppkey % 4 = 3 AS failed FROM supplier")
def decode_fallback(spark, d):
    """Three decoders in turn, as for videos: a number, a JSON object, a prefixed number; a row that none reads has its error."""
    key = F.col("s_suppkey")
    content = F.when(key % 4 == 0, (key * 2).cast("string")).when(key % 4 == 1, F.to_json(F.struct((key * 2).alias("frames")))).when(key % 4 == 2, F.concat(F.lit("remux:"), (key * 2).cast("string"))).otherwise("broken")
    decoders = [lambda r: {"frames": int(r["content"])}, lambda r: {"frames": json.loads(r["content"])["frames"]}, lambda r: {"frames": int(r["content"].removeprefix("remux:"))}]
    out = models.for_each_row(table(spark, d, "supplier").select("s_suppkey", content.alias("content")), "s_suppkey", models.first_that_works(decoders), "frames long, level long")
    return out.select("s_suppkey", "frames", "level", F.col("error").isNotNull().alias("failed"))


@query("mask_overlay", "M18", "SELECT p_partkey, 4 * (p_size + 100) + 6 * p_size AS blended, 2 AS crop_h, 2 AS crop_w FROM part")
def mask_overlay(spark, d):
    """A flat 2 x 5 image, half blended with a colour 200 brighter on a 2 x 2 mask: sum of its red pixels, and the crop's size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = np.zeros((2, 5), dtype=bool)
        mask[:, 1:3] = True
        for batch in batches:
            rows = []
            for key, size in zip(batch["p_partkey"], batch["p_size"]):
                image = np.full((2, 5, 3), size, np.uint8)
                crop = images.masked_crop(image, mask)
                rows.append((key, int(images.overlay(image, mask, (size + 200, 0, 0))[..., 0].sum()), *crop.shape[:2]))
            yield pd.DataFrame(rows, columns=["p_partkey", "blended", "crop_h", "crop_w"])

    return table(spark, d, "part").select("p_partkey", "p_size").mapInPandas(run, "p_partkey long, blended long, crop_h int, crop_w int")
