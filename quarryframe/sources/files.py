"""File sources and sinks: listings, array archives, nested annotations. Paths go through Spark's readers, so any store works."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryframe.operators.masks import encode

CLIPS = "video_id string, narration_id string, start_frame int, stop_frame int, start_timestamp string, stop_timestamp string"
CLIP_META = "start_frame int, stop_frame int, pad int, fps double, width int, height int"
MASKS = "path string, frame long, label int, h int, w int, counts array<int>"


def list_files(spark: SparkSession, root: str, extensions: list[str]) -> DataFrame:
    """All files below `root` with one of the extensions (any case): path, stem; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin([e.lower().lstrip(".") for e in extensions])).withColumn("stem", F.regexp_replace(name, r"\.[^.]+$", ""))


def latest_by_stem(files: DataFrame) -> DataFrame:
    """One path for each stem: the last in path order."""
    return files.groupBy("stem").agg(F.max("path").alias("path"))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_file(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file on any store that Spark knows. It is written under another name and then renamed, so readers see all of it or none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target, part = hadoop.Path(path), hadoop.Path(f"{path}.part")
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = store.create(part, True)
    out.write(bytearray(content))
    out.close()
    store.delete(target, False)
    store.rename(part, target)


def cached_listing(spark: SparkSession, root: str, extensions: list[str], cache: str, refresh: bool = False) -> DataFrame:
    """The listing kept at `cache`; the folder itself is read only where there is none yet, or on refresh. A kept listing wins over
    what has changed on disk since."""
    if refresh or not path_exists(spark, cache):
        list_files(spark, root, extensions).write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)


def labelled_images(spark: SparkSession, root: str, suffix: str, label_suffix: str, split: str | None = None) -> DataFrame:
    """(image, label) names: one for each line of a split file, in its order, or for each file below `root` that ends in `suffix`, sorted."""
    if split is not None:
        name = F.trim("value")
        return spark.read.text(split).select(F.concat(name, F.lit(suffix)).alias("image"), F.concat(name, F.lit(label_suffix)).alias("label"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.regexp_replace("path", "^[a-z0-9]+:/+", "/").alias("path"))
    below = F.col("path").substr(F.instr("path", root.rstrip("/")) + len(root.rstrip("/")) + 1, F.length("path"))
    found = files.select(below.alias("image")).where(F.endswith("image", F.lit(suffix)))
    return found.select("image", F.replace("image", F.lit(suffix), F.lit(label_suffix)).alias("label")).orderBy("image")


def write_statistics(statistics: DataFrame, path: str) -> None:
    """Aggregates (a few rows) as JSON lines in one file."""
    statistics.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest of clips; quotes inside a field are doubled."""
    return spark.read.schema(CLIPS).option("header", True).option("escape", '"').csv(path)


def read_clip_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLIP_META).option("multiLine", True).json(path)


def stage_records(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """All shard CSVs of a stage; unreadable files and rows are skipped."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "DROPMALFORMED").option("ignoreCorruptFiles", "true").csv(pattern)


def archive_arrays(content: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Frames of an .npz archive. All-numeric keys: one array each, by number; one key: a stack along its first axis; else an error."""
    with np.load(io.BytesIO(content), allow_pickle=False) as archive:
        keys = list(archive.files)
        if keys and all(k.isdigit() for k in keys):
            yield from ((int(k), archive[k]) for k in sorted(keys, key=int))
        elif len(keys) == 1:
            stack = archive[keys[0]]
            if stack.ndim != 3:
                raise ValueError("a stack of masks must have three dimensions")
            yield from enumerate(stack)
        else:
            raise ValueError(f"neither numeric keys nor a single one: {keys[:5]}")


def read_masks(spark: SparkSession, path: str) -> DataFrame:
    """All .npz mask archives below `path` as run-length rows."""
    return decode_archives(spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", "true").load(path))


def decode_archives(files: DataFrame) -> DataFrame:
    """Mask archives (path, content) as run-length rows: one for each frame and non-zero label. A broken archive fails its rows,
    not the job: it gives one row with a null frame."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, content in zip(batch["path"], batch["content"]):
                rows = []
                try:
                    for frame, array in archive_arrays(content):
                        rows += [(where, frame, int(v), *array.shape, encode(array == v)) for v in np.unique(array) if v]
                except (ValueError, zipfile.BadZipFile, OSError):
                    rows = [(where, None, None, None, None, None)]
                yield pd.DataFrame(rows, columns=["path", "frame", "label", "h", "w", "counts"]).astype({"frame": "Int64", "label": "Int32", "h": "Int32", "w": "Int32"})

    return files.select("path", "content").mapInPandas(run, MASKS)


def write_masks(masks: DataFrame, path: str, partition: str) -> None:
    """Run-length rows as Parquet, one folder for each clip; only the folders of clips in `masks` are replaced."""
    masks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(partition).parquet(path)


def append_records(records: DataFrame, path: str) -> None:
    records.write.mode("append").parquet(path)


def read_scene_cameras(spark: SparkSession, path: str) -> DataFrame:
    """Per-scene camera JSON {frame: {cam_K, depth_scale}} -> frame, frame name of six digits, cam_K, depth_scale."""
    return scene_cameras(spark.read.text(path, wholetext=True))


def scene_cameras(texts: DataFrame) -> DataFrame:
    """`read_scene_cameras` for texts that are columns already (value)."""
    camera = T.StructType([T.StructField("cam_K", T.ArrayType(T.DoubleType())), T.StructField("depth_scale", T.DoubleType())])
    frames = texts.select(F.explode(F.from_json("value", T.MapType(T.StringType(), camera))).alias("frame", "c"))
    return frames.select(F.col("frame").cast("int").alias("frame"), F.lpad("frame", 6, "0").alias("name"), "c.cam_K", "c.depth_scale")


def read_scene_poses(spark: SparkSession, path: str) -> DataFrame:
    pose = T.StructType([T.StructField("obj_id", T.IntegerType()), T.StructField("cam_R_m2c", T.ArrayType(T.DoubleType())), T.StructField("cam_t_m2c", T.ArrayType(T.DoubleType()))])
    text = spark.read.text(path, wholetext=True)
    frames = text.select(F.explode(F.from_json("value", T.MapType(T.StringType(), T.ArrayType(pose)))).alias("frame", "p"))
    return frames.select(F.col("frame").cast("int").alias("frame"), F.inline("p"))


def read_masklets(spark: SparkSession, path: str, every: int = 1) -> DataFrame:
    """Nested masklet JSON files -> one row for each annotated frame (every n-th) and object."""
    return masklets(spark.read.text(path, wholetext=True), every)


def masklets(texts: DataFrame, every: int = 1) -> DataFrame:
    """Masklet JSON texts (value) -> video_id, frame, object_id, size, counts; an object without an id has its place as id."""
    rle = T.StructType([T.StructField("size", T.ArrayType(T.IntegerType())), T.StructField("counts", T.StringType())])
    schema = T.StructType([T.StructField("video_id", T.StringType()), T.StructField("masklet_id", T.ArrayType(T.IntegerType())), T.StructField("masklet", T.ArrayType(T.ArrayType(rle)))])
    raw = texts.select(F.from_json("value", schema).alias("j")).select("j.*")
    frames = raw.select("video_id", "masklet_id", F.posexplode("masklet").alias("annotation", "objects"))
    return frames.select("video_id", (F.col("annotation") * every).alias("frame"), F.posexplode("objects").alias("at", "m"), "masklet_id").select(
        "video_id", "frame", F.coalesce(F.get("masklet_id", F.col("at")), F.col("at")).alias("object_id"), "m.size", "m.counts"
    )


def with_missing_masks(frames: DataFrame, objects: DataFrame, masks: DataFrame, clip: str, frame: str, object_id: str, pixels: Column) -> DataFrame:
    """A row for every frame of a clip and object of the clip: where there is no mask, an empty one of `pixels` (counts: one run)."""
    planned = frames.select(clip, frame).join(objects.select(clip, object_id), clip)
    return planned.join(masks, [clip, frame, object_id], "left").withColumn("counts", F.coalesce("counts", F.array(pixels.cast("int"))))


def amodal_annotations(texts: DataFrame) -> DataFrame:
    """Annotation JSON texts (value) -> one row for each annotation whose image is listed: video_id, frame, track_id, size, counts,
    box and amodal_box (x, y, w, h). Of images with one id in a text the last counts; equal texts give their rows each.

    Images and annotations of a text become rows that meet by the text's digest and the image's id, so neither a text's list of
    images nor its search is repeated for each annotation.
    """
    image = "struct<video_id: bigint, frame_index: bigint>"
    annotation = "struct<image_id: bigint, track_id: bigint, segmentation: struct<size: array<int>, counts: string>, bbox: array<double>, amodal_bbox: array<double>>"
    raw = texts.select(F.sha2("value", 256).alias("text"), F.from_json("value", f"images array<{image.replace('<', '<id: bigint, ', 1)}>, annotations array<{annotation}>").alias("j"))
    listed = F.transform("j.images", lambda x: F.struct(x["id"].alias("id"), F.struct(x["video_id"], x["frame_index"]).cast(image).alias("i"), F.lit(None).cast(annotation).alias("a")))
    marked = F.transform("j.annotations", lambda x: F.struct(x["image_id"].alias("id"), F.lit(None).cast(image).alias("i"), x.alias("a")))
    some = lambda rows: F.coalesce(rows, F.array().cast(f"array<struct<id: bigint, i: {image}, a: {annotation}>>"))
    rows = raw.select("text", F.posexplode(F.concat(some(listed), some(marked))).alias("at", "e")).select("text", "at", "e.*").where("id is not null")
    last = F.max(F.when(F.col("i").isNotNull(), F.struct("at", "i"))).over(Window.partitionBy("text", "id"))
    rows = rows.withColumn("i", last["i"]).where("i is not null and a is not null")
    return rows.select("i.video_id", F.col("i.frame_index").alias("frame"), "a.track_id", "a.segmentation.size", "a.segmentation.counts", F.col("a.bbox").alias("box"), F.col("a.amodal_bbox").alias("amodal_box"))


def write_version(manifest: DataFrame, root: str, version: int) -> None:
    """A new version of a manifest in a folder of its own: readers of the versions before are not disturbed."""
    manifest.write.mode("overwrite").parquet(f"{root.rstrip('/')}/version={version}")


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/version={version}")


def pose_lines(pose: Column) -> Column:
    """A flat 4 x 4 pose as text: four lines of four numbers of six decimals."""
    row = lambda i: F.array_join(F.transform(F.slice(pose, F.lit(4) * i + 1, F.lit(4)), lambda x: F.format_string("%.6f", x.cast("double"))), " ")
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), row), "\n")


def read_train_log(spark: SparkSession, path: str) -> DataFrame:
    """json-lines log -> (epoch, metric, values in line order); lines without an epoch are left out."""
    raw = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.from_json("value", "map<string,string>").alias("m")).where("m['epoch'] is not null")
    cells = raw.select("line", F.col("m")["epoch"].cast("int").alias("epoch"), F.explode("m").alias("metric", "value")).where("metric <> 'epoch'")
    return cells.groupBy("epoch", "metric").agg(F.transform(F.sort_array(F.collect_list(F.struct("line", F.col("value").try_cast("double").alias("v")))), lambda x: x["v"]).alias("values"))


def allow_and_deny(names: DataFrame, key: str, allowed: DataFrame | None, denied: list[DataFrame]) -> DataFrame:
    """Names on the allow list (if there is one) and on no deny list, sorted."""
    out = names.join(allowed, key, "left_semi") if allowed is not None else names
    for deny in denied:
        out = out.join(deny, key, "left_anti")
    return out.orderBy(key)
