"""Queries over manifests: orders, customers, line items, documents and their stage records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryframe.functions import text as tx
from quarryframe.operators import evaluation, intervals, manifest, selection
from quarryframe.session import require_columns, table

from .registry import query

_HORNER = " ".join(["((((CAST('0x' || substr(h, 1, 8) AS BIGINT) % {n}) * (4294967296 % {n}) + CAST('0x' || substr(h, 9, 8) AS BIGINT)) % {n} * (4294967296 % {n}) + CAST('0x' || substr(h, 17, 8) AS BIGINT)) % {n} * (4294967296 % {n}) + CAST('0x' || substr(h, 25, 8) AS BIGINT)) % {n}"])


@query("clip_gate_semi", "F1 J1 J3 P1", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 5000)")
def clip_gate_semi(spark, d):
    o = require_columns(table(spark, d, "orders"), "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    c = table(spark, d, "customer").where("c_mktsegment = 'BUILDING' and c_acctbal < 5000")
    return o.where("o_orderstatus = 'O'").join(c, o.o_custkey == c.c_custkey, "left_semi").select("o_orderkey", "o_custkey", "o_totalprice")


@query("missing_anti", "J2 F5 K6", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def missing_anti(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", "c_name")


@query("manifest_inner", "J1 J9 J16", "SELECT o_orderkey, c_name, n_name, o_orderkey - first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + 1 AS rel_id FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def manifest_inner(spark, d):
    o, c, n = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.select("o_orderkey", "c_name", "n_name", (F.col("o_orderkey") - F.min("o_orderkey").over(Window.partitionBy("o_custkey")) + 1).alias("rel_id"))


@query("manifest_update", "J4 J5 J6 A.9 U2", "SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN d.lang ELSE 'q' || l.quality END AS lang, d.source, CASE WHEN l.quality IS NOT NULL THEN coalesce(CASE WHEN toxic = 0 THEN NULL ELSE n_chars + 1 END, n_chars) ELSE n_chars END AS n_chars FROM documents d LEFT JOIN labels l USING (doc_id)")
def manifest_update(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), table(spark, d, "labels")
    up = labels.join(docs.select("doc_id", F.col("n_chars").alias("n")), "doc_id").select(
        "doc_id", F.concat(F.lit("q"), F.col("quality")).alias("lang"), F.when(F.col("toxic") != 0, F.col("n") + 1).alias("n_chars"), F.lit("x").alias("unknown")
    )
    return manifest.merge_stage_records(docs, [up], "doc_id")


@query("strict_equality_check", "J15 J17 U3", "SELECT 'left_only' AS side, count(*) AS n FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'right_only', count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents) UNION ALL SELECT 'both', count(*) FROM (SELECT doc_id FROM labels INTERSECT SELECT doc_id FROM documents)")
def strict_equality_check(spark, d):
    a, b = table(spark, d, "documents").select("doc_id", F.lit(1).alias("l")), table(spark, d, "labels").select("doc_id", F.lit(1).alias("r"))
    j = a.join(b, "doc_id", "full_outer")
    side = F.when(F.col("r").isNull(), "left_only").when(F.col("l").isNull(), "right_only").otherwise("both")
    sides = spark.createDataFrame([("left_only",), ("right_only",), ("both",)], "side string")
    return sides.join(j.groupBy(side.alias("side")).agg(F.count("*").alias("n")), "side", "left").na.fill(0, ["n"])


@query("stage_counts", "F8 A22 A21", "SELECT source, count(*) AS total, count(*) FILTER (n_chars >= 200) AS long_enough, count(*) FILTER (n_chars >= 200 AND lang = 'en') AS english, count(*) FILTER (n_chars >= 200 AND lang = 'en' AND n_chars <= 5000) AS short_enough FROM documents GROUP BY source")
def stage_counts(spark, d):
    return manifest.stage_counts(table(spark, d, "documents"), {"long_enough": F.col("n_chars") >= 200, "english": F.col("lang") == "en", "short_enough": F.col("n_chars") <= 5000}, ["source"])


@query("manifest_statistics", "A21", "SELECT count(*) AS n_rows, count(n_chars) AS with_chars, CAST(sum(n_chars) AS BIGINT) AS chars, count(DISTINCT source) AS sources, count(*) FILTER (lang = 'en') AS english FROM documents")
def manifest_statistics(spark, d):
    return table(spark, d, "documents").agg(F.count("*").alias("n_rows"), F.count("n_chars").alias("with_chars"), F.sum("n_chars").alias("chars"), F.count_distinct("source").alias("sources"), F.count_if(F.col("lang") == "en").alias("english"))


@query("work_queue", "F9", "SELECT doc_id, source FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, -1) = -1 AND n_chars > 500 AND lang IN ('en', 'de')")
def work_queue(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return manifest.work_queue(j, F.coalesce("quality", F.lit(-1)) != -1, [F.col("n_chars") > 500, F.col("lang").isin("en", "de")]).select("doc_id", "source")


@query("gate_unless_empty", "D4", "SELECT count(*) AS kept FROM orders WHERE o_totalprice < 50000")
def gate_unless_empty(spark, d):
    """An empty allow-set means that nothing passes."""
    o = table(spark, d, "orders")
    return o.join(o.where("o_totalprice < 50000").select("o_orderkey"), "o_orderkey", "left_semi").agg(F.count("*").alias("kept"))


@query("incremental_skip", "K6", "SELECT p.l_orderkey, p.l_linenumber FROM lineitem p WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND NOT EXISTS (SELECT 1 FROM orders w WHERE w.o_orderkey = p.l_orderkey AND abs(w.o_totalprice - p.l_extendedprice) <= 100000)")
def incremental_skip(spark, d):
    p = table(spark, d, "lineitem").where("l_shipdate >= timestamp '1998-01-01'").select(F.col("l_orderkey").alias("key"), "l_linenumber", F.col("l_extendedprice").alias("price"))
    w = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    return manifest.not_yet_written(p, w, "key", {"price": 100000.0}).select(F.col("key").alias("l_orderkey"), "l_linenumber")


@query("md5_shard", "P7", f"WITH h AS (SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) AS h FROM customer) SELECT c_custkey, {_HORNER.format(n=3)} AS shard3, {_HORNER.format(n=64)} AS shard64, {_HORNER.format(n=1000)} AS shard1000 FROM h")
def md5_shard(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", *[manifest.md5_shard(k, n).alias(f"shard{n}") for n in (3, 64, 1000)])


@query("rank_split", "P8 D-11", "WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS rank, count(*) OVER () AS n FROM customer) SELECT c_custkey, rank, (SELECT count(*) FROM range(1, 8) t(r) WHERE n * r // 7 <= rank) AS part FROM r")
def rank_split(spark, d):
    c = manifest.with_global_rank(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], "rank", 8)
    n = c.agg(F.count("*").alias("n"))
    return c.join(F.broadcast(n)).select("c_custkey", F.col("rank").cast("long").alias("rank"), manifest.rank_split(F.col("rank"), F.col("n"), 7).cast("long").alias("part"))


@query("slice", "P9 O1", "SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS r FROM customer) WHERE r >= 100 AND r < 250")
def slice_(spark, d):
    return manifest.with_global_rank(table(spark, d, "customer").select("c_name", "c_custkey"), ["c_name", "c_custkey"], "r", 8).where("r >= 100 and r < 250").select("c_custkey")


@query("durations", "P2 T1", "SELECT o_orderkey, greatest(coalesce(epoch(o_orderdate) % 86400 - o_orderkey % 86400, 0), 0) AS duration_s FROM orders")
def durations(spark, d):
    o = table(spark, d, "orders")
    clock = lambda s: F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    return o.select("o_orderkey", manifest.duration_seconds(clock(F.col("o_orderkey") % 86400), clock(F.unix_timestamp("o_orderdate") % 86400)).alias("duration_s"))


@query("frame_windows", "P3 P4", "WITH f AS (SELECT l_orderkey, l_linenumber, CAST(least(greatest(round_even(l_quantity * 29.97, 0), 0), 1200) AS BIGINT) AS a, CAST(least(greatest(round_even((l_quantity + l_discount * 10) * 29.97, 0), 0), 1200) AS BIGINT) AS b FROM lineitem) SELECT l_orderkey, l_linenumber, greatest(a - 5, 0) AS a, least(b + 5, 1200) AS b FROM f WHERE least(b + 5, 1200) > greatest(a - 5, 0)")
def frame_windows(spark, d):
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", manifest.seconds_to_frame(F.col("l_quantity"), 29.97, 1200).alias("a"), manifest.seconds_to_frame(F.col("l_quantity") + F.col("l_discount") * 10, 29.97, 1200).alias("b"))
    return manifest.pad_window(l, "a", "b", 5, 1200)


@query("name_parts", "P5 P6 P17", "SELECT s_suppkey, split_part(p, '/', 3) AS seq, split_part(o, '+', 1) AS oid, CASE WHEN strpos(o, '+') > 0 THEN substr(o, strpos(o, '+') + 1) END AS label, CASE WHEN s_suppkey % 3 = 0 THEN 1000000000 ELSE s_suppkey END AS ord FROM (SELECT s_suppkey, 'data/clips/' || s_name || '/action.mp4' AS p, s_suppkey || '+' || s_name || '+x' AS o FROM supplier)")
def name_parts(spark, d):
    s = table(spark, d, "supplier")
    path, o = F.concat(F.lit("data/clips/"), F.col("s_name"), F.lit("/action.mp4")), F.concat(F.col("s_suppkey"), F.lit("+"), F.col("s_name"), F.lit("+x"))
    name = F.when(F.col("s_suppkey") % 3 == 0, F.lit("mesh")).otherwise(F.concat(F.lit("object_"), F.col("s_suppkey")))
    return s.select("s_suppkey", tx.parent_name(path).alias("seq"), tx.object_id(o).alias("oid"), tx.object_label(o).alias("label"), tx.object_order(name).alias("ord"))


@query(
    "yes_no_parse", "P18 F4",
    """WITH t AS (SELECT doc_id, lower(trim(coalesce(text, ''))) AS t, text FROM documents)
    SELECT doc_id, CASE WHEN starts_with(t, 'yes') THEN 'yes' WHEN starts_with(t, 'no') THEN 'no' WHEN strpos(t, 'yes') > 0 AND strpos(t, 'no') = 0 THEN 'yes' WHEN strpos(t, 'no') > 0 AND strpos(t, 'yes') = 0 THEN 'no'
    WHEN strpos(t, 'yes') > 0 AND strpos(t, 'yes') < strpos(t, 'no') THEN 'yes' ELSE 'no' END AS verdict, contains(lower('no' || chr(10) || coalesce(text, '')), 'yes') AS passes FROM t""",
)
def yes_no_parse(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", tx.parse_yes_no(F.col("text")).alias("verdict"), tx.verdict_passes(F.lit("no"), F.coalesce("text", F.lit(""))).alias("passes"))


@query(
    "visibility_parse", "P19",
    """WITH t AS (SELECT doc_id, lower(trim(coalesce(text, ''))) AS t FROM documents)
    SELECT doc_id, CASE WHEN contains(t, 'partial') THEN 'partial' WHEN contains(t, 'yes') THEN 'yes' WHEN contains(t, 'no') OR starts_with(t, 'n') THEN 'no' WHEN starts_with(t, 'y') THEN 'yes' WHEN starts_with(t, 'p') THEN 'partial' ELSE 'no' END AS visibility FROM t""",
)
def visibility_parse(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.parse_visibility(F.col("text")).alias("visibility"))


@query("label_remap", "P12 P13 P14 D-7", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 5 THEN l_linenumber ELSE 0 END AS handobj1, CASE WHEN l_linenumber >= 3 THEN l_linenumber - 2 ELSE 0 END AS obj2, CASE WHEN l_linenumber IN (1, 2) THEN 3 ELSE l_linenumber END AS cascaded, CASE WHEN l_linenumber % 4 = 0 THEN 255 ELSE l_linenumber % 4 - 1 END AS zero_reduced FROM lineitem")
def label_remap(spark, d):
    n = F.col("l_linenumber")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tx.remap_label(n, "handobj1").alias("handobj1"), tx.remap_label(n, "obj2").alias("obj2"), tx.cascading_remap(n, {1: 2, 2: 3}).alias("cascaded"), tx.reduce_zero_label(n % 4).alias("zero_reduced"))


@query("size_buckets", "P15", "SELECT CASE WHEN l_extendedprice < 1024 THEN 'small' WHEN l_extendedprice < 9216 THEN 'medium' ELSE 'large' END AS bucket, count(*) AS n FROM lineitem GROUP BY 1")
def size_buckets(spark, d):
    return table(spark, d, "lineitem").groupBy(tx.size_bucket(F.col("l_extendedprice")).alias("bucket")).agg(F.count("*").alias("n"))


@query("content_hash", "P20 G14", "SELECT page_id, sha256(html) AS digest, coalesce(TRY_CAST(regexp_extract(url, '([0-9]+)', 1) AS DOUBLE), -1) AS number FROM pages")
def content_hash(spark, d):
    return table(spark, d, "pages").select("page_id", tx.content_hash(F.encode("html", "UTF-8")).alias("digest"), tx.safe_double(F.regexp_extract("url", "([0-9]+)", 1), -1.0).alias("number"))


@query("iqr_topk", "F7 O2 W7", "WITH q AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b, count(*) AS n FROM lineitem GROUP BY 1), k AS (SELECT l.*, row_number() OVER (PARTITION BY l.l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem l JOIN q USING (l_suppkey) WHERE n < 3 OR l_extendedprice <= b + 1.5 * (b - a)) SELECT l_suppkey, l_orderkey, l_linenumber, round(l_extendedprice, 2) AS price, rank FROM k WHERE rank <= 10")
def iqr_topk(spark, d):
    l = selection.upper_iqr_fence(table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"), ["l_suppkey"], "l_extendedprice")
    top = selection.top_k(l, ["l_suppkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 10)
    return top.select("l_suppkey", "l_orderkey", "l_linenumber", F.round("l_extendedprice", 2).alias("price"), F.col("rank").cast("long").alias("rank"))


@query("enough_clean", "F6", "SELECT l_suppkey, count(*) AS total, count(*) FILTER (l_returnflag = 'A') AS clean FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag = 'A') >= greatest(3, count(*) // 5)")
def enough_clean(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("total"), F.count_if(F.col("l_returnflag") == "A").alias("clean"))
    return g.where(F.col("clean") >= F.greatest(F.lit(3), F.floor(F.col("total") / 5)))


@query("quality_filters", "F10 F11", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.02 AND l_tax >= 0.03 AND l_quantity > 0 AND l_quantity / 50.0 < 0.9")
def quality_filters(spark, d):
    return table(spark, d, "lineitem").where("l_discount > 0.02 and l_tax >= 0.03 and l_quantity > 0 and l_quantity / 50.0 < 0.9").select("l_orderkey", "l_linenumber")


@query("bucket_metrics_rollup", "K9 A14", "SELECT CASE WHEN grouping(lang) = 1 THEN 'all' ELSE lang END AS lang, CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, count(*) AS n, round(avg(quality), 6) AS quality FROM documents JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((), (lang, source))")
def bucket_metrics_rollup(spark, d):
    table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").createOrReplaceTempView("_quality_rows")
    return spark.sql("""SELECT CASE WHEN grouping(lang) = 1 THEN 'all' ELSE lang END AS lang, CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source,
        count(*) AS n, round(avg(quality), 6) AS quality FROM _quality_rows GROUP BY GROUPING SETS ((), (lang, source))""")


@query("merge_ship_ranges", "A3", "WITH r AS (SELECT l_suppkey, CAST(date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) - 1 AS a, CAST(date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) + 2 AS b FROM lineitem), m AS (SELECT *, max(b) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r), i AS (SELECT *, sum(CASE WHEN a <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY a, b) AS island FROM m) SELECT l_suppkey, min(a) AS a, max(b) AS b, count(*) AS ranges FROM i GROUP BY l_suppkey, island")
def merge_ship_ranges(spark, d):
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date")).cast("long")
    return intervals.merge_ranges(table(spark, d, "lineitem").select("l_suppkey", (day - 1).alias("a"), (day + 2).alias("b")), ["l_suppkey"], "a", "b")


@query("weighted_median_trimmed", "A24 S11 A.8", "WITH c AS (SELECT l_suppkey, l_extendedprice AS v, l_quantity AS w, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS u, sum(l_quantity) OVER (PARTITION BY l_suppkey) AS t FROM lineitem), m AS (SELECT l_suppkey, min(v) AS med FROM c WHERE 2 * u >= t GROUP BY 1) SELECT c.l_suppkey, round(max(med), 4) AS weighted_median, round(coalesce(sum(v * w) FILTER (abs(v - med) <= 0.25 * med) / sum(w) FILTER (abs(v - med) <= 0.25 * med), max(med)), 4) AS trimmed_mean FROM c JOIN m USING (l_suppkey) GROUP BY 1")
def weighted_median_trimmed(spark, d):
    l = table(spark, d, "lineitem").select("l_suppkey", F.col("l_extendedprice").alias("v"), F.col("l_quantity").alias("w"), "l_orderkey", "l_linenumber")
    out = evaluation.trimmed_weighted_mean(l, ["l_suppkey"], "v", "w", ["l_orderkey", "l_linenumber"])
    return out.select("l_suppkey", F.round("weighted_median", 4).alias("weighted_median"), F.round("trimmed_mean", 4).alias("trimmed_mean"))


@query("concat_repeat_index", "U6", "SELECT 'a' || s_suppkey AS item, 0 AS dataset, s_suppkey AS at, s_suppkey - 1 + r * (SELECT count(*) FROM supplier) AS global_at FROM supplier, range(0, 3) t(r) UNION ALL SELECT 'b' || n_nationkey, 1, n_nationkey, 3 * (SELECT count(*) FROM supplier) + n_nationkey FROM nation")
def concat_repeat_index(spark, d):
    s, n = table(spark, d, "supplier").select(F.concat(F.lit("a"), F.col("s_suppkey")).alias("item"), F.lit(0).alias("dataset"), F.col("s_suppkey").alias("at")), table(spark, d, "nation").select(F.concat(F.lit("b"), F.col("n_nationkey")).alias("item"), F.lit(1).alias("dataset"), F.col("n_nationkey").cast("long").alias("at"))
    size = s.agg(F.count("*").alias("n"))
    a = s.join(F.broadcast(size)).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(2)))).select("item", "dataset", "at", (F.col("at") - 1 + F.col("r") * F.col("n")).alias("global_at"))
    return a.unionByName(n.join(F.broadcast(size)).select("item", "dataset", "at", (3 * F.col("n") + F.col("at")).alias("global_at")))


@query("split_by_fraction", "D-8", "WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS k, count(*) OVER () AS n FROM customer) SELECT CASE WHEN k < floor(n * 0.7) THEN 'train' WHEN k < floor(n * 0.7) + floor(n * 0.2) THEN 'test' ELSE 'val' END AS split, count(*) AS n FROM r GROUP BY 1")
def split_by_fraction(spark, d):
    c = manifest.with_global_rank(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], "k", 8)
    n = c.agg(F.count("*").alias("n"))
    return c.join(F.broadcast(n)).groupBy(selection.split_label(F.col("k"), F.col("n"), {"train": 0.7, "test": 0.2}, "val").alias("split")).agg(F.count("*").alias("n"))


@query("seeded_sample", "N1 O6", "SELECT c_custkey, c_name FROM customer ORDER BY md5('7|' || c_custkey), c_custkey LIMIT 50")
def seeded_sample(spark, d):
    return selection.hash_sample(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_custkey"], 50, 7)


@query("distinct_labels", "A23 U8", "SELECT l_orderkey, count(DISTINCT CASE WHEN l_linenumber <= 2 THEN l_linenumber END) AS hands, count(DISTINCT CASE WHEN l_linenumber > 2 THEN l_linenumber END) AS objects FROM lineitem GROUP BY 1")
def distinct_labels(spark, d):
    n = F.col("l_linenumber")
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct(F.when(n <= 2, n)).alias("hands"), F.count_distinct(F.when(n > 2, n)).alias("objects"))


@query("label_sanity", "D-6", "SELECT p_partkey, p_size FROM part WHERE p_size < 0 OR p_size > 40 OR p_retailprice IS NULL")
def label_sanity(spark, d):
    """Offenders go to a quarantine table; nothing is deleted."""
    return table(spark, d, "part").where("p_size < 0 or p_size > 40 or p_retailprice is null").select("p_partkey", "p_size")


@query("tile_grid", "D-1 D-2 P22", "WITH t AS (SELECT p_partkey, p_size * 20 AS w FROM part), s AS (SELECT p_partkey, w, unnest(range(0, CAST(greatest(ceil((w - 256) / 192.0), 0) AS BIGINT) + 1)) AS i FROM t) SELECT DISTINCT p_partkey, CAST(greatest(least(i * 192, w - 256), 0) AS BIGINT) AS x0 FROM s")
def tile_grid(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.explode(selection.tile_starts(F.col("p_size") * 20, 256, 64)).alias("x0"))
    return p.select("p_partkey", F.col("x0").cast("long").alias("x0"))


@query("overlap_average", "D-3", "WITH t AS (SELECT p_partkey, p_size AS w, unnest(range(0, CAST(greatest(ceil((p_size - 16) / 12.0), 0) AS BIGINT) + 1)) AS i FROM part), s AS (SELECT DISTINCT p_partkey, w, greatest(least(i * 12, w - 16), 0) AS x0 FROM t), px AS (SELECT p_partkey, x0, unnest(range(x0, least(x0 + 16, w))) AS x FROM s) SELECT p_partkey, x, count(*) AS covers, round(sum(x0 + 1) / count(*), 6) AS mean_score FROM px GROUP BY 1, 2")
def overlap_average(spark, d):
    s = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("long").alias("w"), F.explode(selection.tile_starts(F.col("p_size"), 16, 4)).alias("x0")).withColumn("x0", F.col("x0").cast("long"))
    px = s.where("w > 0").select("p_partkey", "x0", F.explode(F.sequence("x0", F.least(F.col("x0") + 16, F.col("w")) - 1)).alias("x"))
    return px.groupBy("p_partkey", "x").agg(F.count("*").alias("covers"), F.round(F.sum(F.col("x0") + 1) / F.count("*"), 6).alias("mean_score"))


@query(
    "balanced_groups", "S7",
    """WITH RECURSIVE i AS (SELECT c_nationkey, count(*) AS load, row_number() OVER (ORDER BY count(*) DESC, c_nationkey) AS k FROM customer GROUP BY 1),
    r AS (SELECT CAST(0 AS BIGINT) AS k, CAST([0, 0, 0, 0] AS BIGINT[]) AS sums, CAST(0 AS BIGINT) AS g, CAST(0 AS INT) AS c_nationkey, CAST(0 AS BIGINT) AS load
    UNION ALL SELECT i.k, [CASE WHEN j = list_position(sums, list_min(sums)) THEN sums[j] + i.load ELSE sums[j] END FOR j IN range(1, 5)], list_position(sums, list_min(sums)) - 1, i.c_nationkey, i.load FROM r JOIN i ON i.k = r.k + 1)
    SELECT CAST(g AS INT) AS grp, c_nationkey, load FROM r WHERE k > 0""",
)
def balanced_groups(spark, d) -> DataFrame:
    """Loads of the nations' customers over 4 groups: a list of 25 loads, so the greedy part runs where the list is."""
    from quarryframe.operators.stateful import balanced_groups as lpt

    loads = table(spark, d, "customer").groupBy("c_nationkey").count().groupBy(F.lit(0).alias("all")).agg(F.sort_array(F.collect_list(F.struct("c_nationkey", F.col("count").alias("load")))).alias("loads"))

    def run(batches):
        import pandas as pd

        for batch in batches:
            for loads_ in batch["loads"]:
                groups = lpt([x["load"] for x in loads_], 4)
                yield pd.DataFrame([(g, loads_[i]["c_nationkey"], loads_[i]["load"]) for g, members in enumerate(groups) for i in members], columns=["grp", "c_nationkey", "load"])

    return loads.mapInPandas(run, "grp int, c_nationkey int, load long")


@query("allow_deny", "R13", "SELECT c_name FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AND c_mktsegment <> 'BUILDING'")
def allow_deny(spark, d):
    from quarryframe.sources.files import allow_and_deny

    c = table(spark, d, "customer")
    allowed = c.join(table(spark, d, "nation").where("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_name")
    return allow_and_deny(c.select("c_name"), "c_name", allowed, [c.where("c_mktsegment = 'BUILDING'").select("c_name")])


@query("flag_table", "T18", "SELECT o_orderkey, 'priced' AS stage, o_totalprice > 100000 AS done FROM orders UNION ALL SELECT o_orderkey, 'urgent', o_orderpriority LIKE '1%' FROM orders")
def flag_table(spark, d):
    wide = table(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") > 100000).alias("latent_priced"), F.col("o_orderpriority").like("1%").alias("latent_urgent"))
    return manifest.flag_table(wide, "o_orderkey", "latent_")


@query("radical_inverse", "P21", "SELECT c_custkey, round(list_sum([((c_custkey // CAST(pow(2, i) AS BIGINT)) % 2) / pow(2, i + 1) FOR i IN range(0, 40)]), 9) AS r2, round(list_sum([((c_custkey // CAST(pow(3, i) AS BIGINT)) % 3) / pow(3, i + 1) FOR i IN range(0, 20)]), 9) AS r3 FROM customer")
def radical_inverse(spark, d):
    from quarryframe.functions.geometry import radical_inverse as ri

    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", F.round(ri(2, k), 9).alias("r2"), F.round(ri(3, k, 20), 9).alias("r3"))
