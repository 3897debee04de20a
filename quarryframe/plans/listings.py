"""Sources that read files: listings, CSV manifests, logs, shard records and statistics. Small files are made from rows of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryframe.operators import manifest
from quarryframe.session import shared_path, table
from quarryframe.sources import files, plugins

from .registry import query


def _below(column, folder: str):
    return F.element_at(F.split(column, f"/{folder}/"), -1)


def _nations(spark, d) -> list[tuple[int, int]]:
    return [(r.n_nationkey, r.n_regionkey) for r in table(spark, d, "nation").select("n_nationkey", "n_regionkey").collect()]  # 25 rows


@query(
    "video_listing", "R1",
    "WITH f AS (SELECT 'v' || n_nationkey % 9 AS stem, n_regionkey || '/' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '/v' || n_nationkey % 9 AS place, CASE n_nationkey % 4 WHEN 0 THEN 'MP4' WHEN 3 THEN 'txt' ELSE 'mp4' END AS ext FROM nation) SELECT stem, max(place || '.' || ext) AS path FROM f WHERE ext <> 'txt' GROUP BY stem",
)
def video_listing(spark, d):
    """Videos below a folder, with extensions in any case; of those with one stem the last in path order."""
    root = f"{shared_path(spark)}/videos"
    for n, region in _nations(spark, d):
        files.write_file(spark, f"{root}/{region}/{n:02}/v{n % 9}.{('MP4', 'mp4', 'mp4', 'txt')[n % 4]}", b"video")
    return files.latest_by_stem(files.list_files(spark, root, ["mp4"])).select("stem", _below("path", "videos").alias("path"))


@query(
    "cached_listing", "R2",
    "SELECT 'kept' AS listing, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '/action.mp4' AS path FROM nation WHERE n_nationkey < 20 UNION ALL SELECT 'fresh', lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '/action.mp4' FROM nation",
)
def cached_listing(spark, d):
    """A kept listing does not see folders that came later; a refresh does."""
    store = shared_path(spark)
    root, nations = f"{store}/clips", sorted(_nations(spark, d))
    for n, _ in nations[:20]:
        files.write_file(spark, f"{root}/{n:02}/action.mp4", b"video")
    files.cached_listing(spark, root, ["mp4"], f"{store}/list")
    for n, _ in nations[20:]:
        files.write_file(spark, f"{root}/{n:02}/action.mp4", b"video")
    kept, fresh = files.cached_listing(spark, root, ["mp4"], f"{store}/list"), files.cached_listing(spark, root, ["mp4"], f"{store}/fresh")
    return kept.select(F.lit("kept").alias("listing"), "path").unionByName(fresh.select(F.lit("fresh").alias("listing"), "path")).select("listing", _below("path", "clips").alias("path"))


@query(
    "csv_manifest", "R3 P2",
    "SELECT 'P' || o_custkey AS video_id, 'n, \"' || o_orderkey || '\"' AS narration_id, CAST(o_orderkey % 1000 AS INT) AS start_frame, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 1000 + 30 AS INT) END AS stop_frame, CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_orderkey % 50 + 0.5 END AS duration_s FROM orders",
)
def csv_manifest(spark, d):
    """A manifest of clips as CSV with a header: quoted fields, empty numbers, elapsed times that can't be parsed."""
    key, path = F.col("o_orderkey"), shared_path(spark)
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("P"), "o_custkey").alias("video_id"), F.concat(F.lit('n, "'), key, F.lit('"')).alias("narration_id"), (key % 1000).alias("start_frame"), F.when(key % 7 != 0, key % 1000 + 30).alias("stop_frame"),
        F.lit("00:10:00").alias("start_timestamp"), F.when(key % 5 == 0, F.lit("later")).otherwise(F.format_string("00:10:%02d.5", key % 50)).alias("stop_timestamp"),
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    clips = files.read_manifest(spark, path)
    return clips.select("video_id", "narration_id", "start_frame", "stop_frame", manifest.duration_seconds(F.col("start_timestamp"), F.col("stop_timestamp")).alias("duration_s"))


@query("train_log", "R16 A30", "SELECT CAST(user_id AS INT) AS epoch, 'loss' AS metric, list(round(value, 4) ORDER BY ts, event_id) AS series FROM events WHERE event_id % 5 <> 0 GROUP BY 1 UNION ALL SELECT CAST(user_id AS INT), 'step', list(CAST(event_id AS DOUBLE) ORDER BY ts, event_id) FROM events WHERE event_id % 5 <> 0 GROUP BY 1")
def train_log(spark, d):
    """Log of JSON lines, an epoch's lines in one file and in order; lines without an epoch are notes."""
    path, e = shared_path(spark), table(spark, d, "events")
    line = F.when(F.col("event_id") % 5 == 0, F.to_json(F.struct(F.col("event_type").alias("note")))).otherwise(F.to_json(F.struct(F.col("user_id").alias("epoch"), F.round("value", 4).alias("loss"), F.col("event_id").alias("step"))))
    e.repartition("user_id").sortWithinPartitions("user_id", "ts", "event_id").select(line.alias("value")).write.text(path)
    return files.read_train_log(spark, path).withColumnRenamed("values", "series")


@query("shard_records", "U1 J6", "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 3 <> 2 THEN s_suppkey * 2 ELSE s_nationkey END AS s_nationkey FROM supplier")
def shard_records(spark, d):
    """Records of two shards beside a broken archive and a malformed row, folded into the manifest."""
    root, s = shared_path(spark), table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    for shard in range(2):
        s.where(F.col("s_suppkey") % 3 == shard).select("s_suppkey", (F.col("s_suppkey") * 2).cast("int").alias("s_nationkey")).write.option("header", True).csv(f"{root}/shard_{shard}")
    files.write_file(spark, f"{root}/shard_2/part.csv.gz", b"no archive")
    files.write_file(spark, f"{root}/shard_3/part.csv", b"s_suppkey,s_nationkey\n1,none\n")
    records = files.stage_records(spark, f"{root}/shard_*", "s_suppkey long, s_nationkey int")
    return manifest.merge_stage_records(s, [records], "s_suppkey")


@query("split_listing", "R15", "SELECT 'split' AS listing, 'n' || n_nationkey || '.jpg' AS image, 'n' || n_nationkey || '_gt.png' AS label FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'all', n_regionkey || '/n' || n_nationkey || '.jpg', n_regionkey || '/n' || n_nationkey || '_gt.png' FROM nation WHERE n_nationkey % 3 <> 0")
def split_listing(spark, d):
    """Images and their labels by a split file, and by the suffix of all files below a folder."""
    store = shared_path(spark)
    nations = _nations(spark, d)
    for n, region in nations:
        files.write_file(spark, f"{store}/images/{region}/n{n}.{'jpg' if n % 3 else 'bmp'}", b"image")
    files.write_file(spark, f"{store}/split.txt", "".join(f" n{n}\n" for n, region in nations if region == 1).encode())
    split, whole = (files.labelled_images(spark, f"{store}/images", ".jpg", "_gt.png", s) for s in (f"{store}/split.txt", None))
    return split.select(F.lit("split").alias("listing"), "image", "label").unionByName(whole.select(F.lit("all").alias("listing"), "image", "label"))


@query("statistics_file", "K10 A22", "SELECT source, count(*) AS total, count(*) FILTER (n_chars >= 200) AS long_enough, count(*) FILTER (n_chars >= 200 AND lang = 'en') AS english FROM documents GROUP BY source")
def statistics_file(spark, d):
    path = shared_path(spark)
    files.write_statistics(manifest.stage_counts(table(spark, d, "documents"), {"long_enough": F.col("n_chars") >= 200, "english": F.col("lang") == "en"}, ["source"]), path)
    return spark.read.schema("source string, total long, long_enough long, english long").json(path)


@query("source_plugin", "R17 J5 2.13", "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 5 <> 0 THEN 'raw/' || s_suppkey || '.glb' END AS local_path, s_suppkey % 5 = 0 AS failed FROM supplier WHERE s_suppkey % 2 = 1")
def source_plugin(spark, d):
    """Assets of one variant of a source: metadata from its CSV, each asset fetched (every fifth fails), paths joined back."""
    root, s = shared_path(spark), table(spark, d, "supplier").select("s_suppkey", "s_name")
    for i, variant in enumerate(("even", "odd")):
        s.where(F.col("s_suppkey") % 2 == i).write.option("header", True).csv(f"{root}/{variant}")

    def fetch(row):
        if row["s_suppkey"] % 5 == 0:
            raise OSError("not reachable")
        return {"local_path": f"raw/{row['s_suppkey']}.glb"}

    plugins.register("suppliers", plugins.Source({v: f"{root}/{v}" for v in ("even", "odd")}, "s_suppkey long, s_name string", fetch))
    source = plugins.by_name("suppliers")
    metadata = source.metadata(spark, "odd")
    return metadata.join(source.download(metadata, "s_suppkey"), "s_suppkey", "left").select("s_suppkey", "s_name", "local_path", F.col("error").isNotNull().alias("failed"))
