"""Queries over the event stream seen as frame series: clip = user, frame = order in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryframe.operators import evaluation, intervals, runs, selection
from quarryframe.session import table
from quarryframe.streaming import sessions

from .registry import query

FRAMES = "SELECT user_id AS clip, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, event_id, ts, event_type, value, props FROM events"


def frames(spark, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.col("user_id").alias("clip"), (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long") - 1).alias("frame"), "event_id", "ts", "event_type", "value", "props")


def _clean_sql(source: str, column: str) -> str:
    """DuckDB text that cleans one boolean column of `source` (clip, frame, n, ...)."""
    return f"""
    {column}_1 AS (SELECT *, CASE WHEN lag({column}) OVER w IS NOT DISTINCT FROM {column} AND frame > 0 THEN 0 ELSE 1 END AS ch FROM {source} WINDOW w AS (PARTITION BY clip ORDER BY frame)),
    {column}_2 AS (SELECT *, sum(ch) OVER (PARTITION BY clip ORDER BY frame) AS run FROM {column}_1),
    {column}_3 AS (SELECT * REPLACE ({column} OR count(*) OVER (PARTITION BY clip, run) < lim AS {column}) FROM {column}_2),
    {column}_4 AS (SELECT * EXCLUDE (ch, run), CASE WHEN lag({column}) OVER w IS NOT DISTINCT FROM {column} AND frame > 0 THEN 0 ELSE 1 END AS ch FROM {column}_3 WINDOW w AS (PARTITION BY clip ORDER BY frame)),
    {column}_5 AS (SELECT *, sum(ch) OVER (PARTITION BY clip ORDER BY frame) AS run FROM {column}_4),
    {column}_c AS (SELECT * EXCLUDE (ch, run) REPLACE ({column} AND count(*) OVER (PARTITION BY clip, run) >= lim AS {column}) FROM {column}_5)"""


_LRB = f"f AS ({FRAMES}), s AS (SELECT clip, frame, value > 12 AS l, value > 30 AS r, event_type = 'click' AND value > 5 AS b, greatest(1, CAST(round_even(count(*) OVER (PARTITION BY clip) * 0.1, 0) AS INT)) AS lim FROM f)"


@query(
    "presence_flags", "F12 W1 W2 A2 T2",
    f"""WITH {_LRB}, {_clean_sql('s', 'l')}, {_clean_sql('l_c', 'r')}, {_clean_sql('r_c', 'b')}
    SELECT clip, CAST(bool_and(l) AS INT) AS left_hand_presence, CAST(bool_and(r) AS INT) AS right_hand_presence, CAST(bool_and(l AND r) AS INT) AS both_hands_presence,
    CAST(bool_and(NOT (l OR r)) AS INT) AS no_hands_presence, CAST(bool_and(NOT (l OR r OR b)) AS INT) AS no_object_presence, CAST(bool_and(l) AS INT) AS left_object_presence,
    CAST(bool_and(r) AS INT) AS right_object_presence, CAST(bool_and(b) AS INT) AS twohands_object_presence FROM b_c GROUP BY clip""",
)
def presence_flags(spark, d):
    f = frames(spark, d)
    return runs.presence_flags(f, "clip", ["frame"], F.col("value") > 12, F.col("value") > 30, (F.col("event_type") == "click") & (F.col("value") > 5))


@query("clean_series", "W2 A.1", f"WITH {_LRB}, {_clean_sql('s', 'l')} SELECT clip, count(*) AS n, CAST(sum(CAST(l AS INT)) AS BIGINT) AS kept FROM l_c GROUP BY clip")
def clean_series(spark, d):
    f = frames(spark, d).select("clip", "frame", (F.col("value") > 12).alias("l")).withColumn("n", F.count("*").over(Window.partitionBy("clip")))
    return runs.clean_runs(f, ["clip"], ["frame"], "l", runs.short_run_limit(F.col("n"))).groupBy("clip").agg(F.count("*").alias("n"), F.count_if("l").alias("kept"))


@query(
    "run_lengths", "W1",
    f"""WITH f AS ({FRAMES}), a AS (SELECT clip, frame, value > 25 AS hi FROM f), b AS (SELECT *, CASE WHEN frame > 0 AND lag(hi) OVER w = hi THEN 0 ELSE 1 END AS ch FROM a WINDOW w AS (PARTITION BY clip ORDER BY frame)),
    c AS (SELECT *, sum(ch) OVER (PARTITION BY clip ORDER BY frame) AS run_id FROM b)
    SELECT clip, CAST(run_id AS BIGINT) AS run_id, any_value(hi) AS hi, min(frame) AS first_at, max(frame) AS last_at, count(*) AS length FROM c GROUP BY clip, run_id""",
)
def run_lengths(spark, d):
    return runs.run_segments(frames(spark, d).select("clip", "frame", (F.col("value") > 25).alias("hi")), ["clip"], "frame", "hi")


@query(
    "local_median_cap", "W3 F13",
    f"""WITH f AS ({FRAMES}), a AS (SELECT clip, frame, CAST(floor(value) AS BIGINT) AS area FROM f),
    b AS (SELECT *, quantile_cont(area, 0.5) OVER (PARTITION BY clip ORDER BY frame RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS m FROM a)
    SELECT clip, frame, area, round(CAST(m AS DOUBLE), 6) AS local_median FROM b WHERE area <= 2 * floor(m)""",
)
def local_median_cap(spark, d):
    f = frames(spark, d).select("clip", "frame", F.floor("value").cast("long").alias("area"))
    return runs.local_median_cap(f, ["clip"], "frame", "area", 5, 2).withColumn("local_median", F.round("local_median", 6))


@query(
    "temporal_consensus", "W4",
    f"""WITH f AS ({FRAMES}), a AS (SELECT clip, frame, CAST(value > 20 AS INT) AS on_ FROM f)
    SELECT clip, frame, sum(on_) OVER w >= greatest(1, ceil(count(*) OVER w * CAST(0.2 AS DOUBLE))) AS consensus FROM a WINDOW w AS (PARTITION BY clip ORDER BY frame ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING)""",
)
def temporal_consensus(spark, d):
    f = frames(spark, d).select("clip", "frame", (F.col("value") > 20).alias("on"))
    return runs.temporal_consensus(f, ["clip"], ["frame"], "on", 20, 0.2).select("clip", "frame", "consensus")


@query(
    "center_consensus", "W5",
    f"""WITH f AS ({FRAMES}), c AS (SELECT clip, CAST(floor(max(frame) / 2) AS BIGINT) AS center FROM f GROUP BY clip)
    SELECT f.clip, count(*) AS present, CAST(sum(CAST(value > 20 AS INT)) AS BIGINT) AS votes, sum(CAST(value > 20 AS INT)) >= greatest(1, ceil(count(*) * CAST(0.8 AS DOUBLE))) AS consensus
    FROM f JOIN c USING (clip) WHERE abs(frame - center) <= 10 GROUP BY f.clip""",
)
def center_consensus(spark, d):
    f = frames(spark, d)
    c = f.groupBy("clip").agg(F.floor(F.max("frame") / 2).alias("center"))
    near = f.join(c, "clip").where(F.abs(F.col("frame") - F.col("center")) <= 10)
    on = F.count_if(F.col("value") > 20)
    return near.groupBy("clip").agg(F.count("*").alias("present"), on.alias("votes"), (on >= F.greatest(F.lit(1), F.ceil(F.count("*") * 0.8))).alias("consensus"))


@query(
    "forward_fill", "W8",
    f"WITH f AS ({FRAMES}) SELECT clip, frame, round(last_value(CASE WHEN value > 20 THEN value END IGNORE NULLS) OVER (PARTITION BY clip ORDER BY frame ROWS UNBOUNDED PRECEDING), 6) AS filled FROM f",
)
def forward_fill(spark, d):
    f = frames(spark, d).withColumn("good", F.when(F.col("value") > 20, F.col("value")))
    return runs.forward_fill(f, ["clip"], ["frame"], "good", "filled").select("clip", "frame", F.round("filled", 6).alias("filled"))


@query(
    "visibility_spans", "W9 A29",
    f"""WITH f AS ({FRAMES}), a AS (SELECT clip, frame, value > 20 AS v, lag(value > 20) OVER (PARTITION BY clip ORDER BY frame) AS p FROM f)
    SELECT clip, min(CASE WHEN v THEN frame END) AS first_visible, max(CASE WHEN v THEN frame END) AS last_visible, CAST(sum(CAST(v AS INT)) AS BIGINT) AS visible_rows, CAST(coalesce(sum(CAST(p <> v AS INT)), 0) AS BIGINT) AS visibility_changes FROM a GROUP BY clip""",
)
def visibility_spans(spark, d):
    return runs.visibility_spans(frames(spark, d).select("clip", "frame", (F.col("value") > 20).alias("v")), ["clip"], "frame", "v")


@query(
    "processing_windows", "W10",
    f"""WITH f AS ({FRAMES}), n AS (SELECT clip, count(*) AS n FROM f GROUP BY clip), w AS (SELECT clip, n, unnest(range(0, CAST(greatest(ceil((n - 24) / 16.0), 0) AS BIGINT) + 1)) AS wid FROM n),
    m AS (SELECT w.clip, wid, frame FROM w JOIN f ON f.clip = w.clip AND frame >= wid * 16 AND (frame < wid * 16 + 24 OR wid = greatest(ceil((n - 24) / 16.0), 0)))
    SELECT clip, CAST(wid AS BIGINT) AS win, min(frame) AS first_frame, max(frame) AS last_frame, count(*) AS n_frames FROM m GROUP BY clip, wid""",
)
def processing_windows(spark, d):
    f = frames(spark, d).withColumn("n", F.count("*").over(Window.partitionBy("clip")))
    wins = f.select("clip", "frame", F.explode(runs.overlapping_windows(F.col("frame"), F.col("n"), 24, 8)).alias("win")).withColumn("win", F.col("win").cast("long"))
    return wins.groupBy("clip", "win").agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), F.count("*").alias("n_frames"))


@query(
    "pose_delta", "W6 G2 G9",
    f"WITH f AS ({FRAMES}), a AS (SELECT clip, frame, value, lag(value) OVER (PARTITION BY clip ORDER BY frame) AS p FROM f) SELECT clip, frame, round(degrees(acos(least(greatest(cos(radians(value - p)), -1.0), 1.0))), 4) AS turn FROM a WHERE p IS NOT NULL",
)
def pose_delta(spark, d):
    from quarryframe.functions.geometry import rotation_angle_deg

    def about_z(deg):
        c, s, o, i = F.cos(F.radians(deg)), F.sin(F.radians(deg)), F.lit(0.0), F.lit(1.0)
        return F.array(c, -s, o, s, c, o, o, o, i)

    f = frames(spark, d).withColumn("before", F.lag("value").over(Window.partitionBy("clip").orderBy("frame"))).where("before is not null")
    return f.select("clip", "frame", F.round(rotation_angle_deg(about_z(F.col("value")), about_z(F.col("before"))), 4).alias("turn"))


@query(
    "nearest_clean_frame", "J13 J14",
    f"""WITH f AS ({FRAMES}), l AS (SELECT clip, frame FROM f WHERE value <= 8), r AS (SELECT clip, frame AS clean FROM f WHERE value > 60),
    j AS (SELECT l.clip, l.frame, clean, row_number() OVER (PARTITION BY l.clip, l.frame ORDER BY abs(clean - l.frame), clean) AS rn FROM l LEFT JOIN r ON l.clip = r.clip AND abs(clean - l.frame) <= 8)
    SELECT clip, frame, clean FROM j WHERE rn = 1""",
)
def nearest_clean_frame(spark, d):
    f = frames(spark, d)
    return intervals.nearest_join(f.where("value <= 8").select("clip", "frame"), f.where("value > 60").select("clip", F.col("frame").alias("clean")), ["clip"], ["frame"], "frame", "clean", 8)


@query("band_pairs", "J12", f"WITH f AS ({FRAMES}), h AS (SELECT clip, frame FROM f WHERE value > 40) SELECT a.clip, a.frame AS a_frame, b.frame AS b_frame FROM h a JOIN h b ON a.clip = b.clip AND abs(a.frame - b.frame) <= 5 AND a.frame < b.frame")
def band_pairs(spark, d):
    h = frames(spark, d).where("value > 40")
    return intervals.band_join(h.select("clip", F.col("frame").alias("a_frame")), h.select("clip", F.col("frame").alias("b_frame")), ["clip"], "a_frame", "b_frame", 5).where("a_frame < b_frame")


@query(
    "stabbing", "J20",
    f"""WITH f AS ({FRAMES}), r AS (SELECT clip, frame AS a, frame + CAST(floor(value) AS BIGINT) % 20 AS b, event_id AS rid FROM f WHERE event_type = 'purchase')
    SELECT r.rid, count(*) AS hits, min(f.frame) AS first_frame, max(f.frame) AS last_frame FROM r JOIN f ON f.clip = r.clip AND f.frame >= a AND f.frame < b GROUP BY r.rid""",
)
def stabbing(spark, d):
    f = frames(spark, d)
    r = f.where("event_type = 'purchase'").select("clip", F.col("frame").cast("long").alias("a"), (F.col("frame") + F.floor("value") % 20).alias("b"), F.col("event_id").alias("rid"))
    return intervals.stab(f.select("clip", "frame"), r, ["clip"], "frame", "a", "b", 16).groupBy("rid").agg(F.count("*").alias("hits"), F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"))


@query(
    "merge_frame_ranges", "A3",
    f"""WITH f AS ({FRAMES}), r AS (SELECT clip, greatest(frame - 3, 0) AS a, frame + 4 AS b FROM f WHERE value > 45),
    m AS (SELECT *, max(b) OVER (PARTITION BY clip ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
    i AS (SELECT *, sum(CASE WHEN a <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY clip ORDER BY a, b) AS island FROM m)
    SELECT clip, min(a) AS a, max(b) AS b, count(*) AS ranges FROM i GROUP BY clip, island""",
)
def merge_frame_ranges(spark, d):
    r = frames(spark, d).where("value > 45").select("clip", F.greatest(F.col("frame") - 3, F.lit(0)).alias("a"), (F.col("frame") + 4).alias("b"))
    return intervals.merge_ranges(r, ["clip"], "a", "b")


@query(
    "written_clips", "S6",
    f"""WITH f AS ({FRAMES}), m AS (SELECT clip, max(frame) AS mx FROM f GROUP BY clip), s AS (SELECT f.clip, event_id AS seg, frame AS a, least(frame + 3 + event_id % 30, mx) AS b FROM f JOIN m USING (clip) WHERE event_type = 'purchase' AND frame < mx),
    i AS (SELECT clip, frame, value > 20 AS ok, row_number() OVER (PARTITION BY clip ORDER BY frame) AS pos FROM f WHERE EXISTS (SELECT 1 FROM s WHERE s.clip = f.clip AND f.frame >= a AND f.frame < b)),
    q AS (SELECT *, pos - coalesce(max(CASE WHEN ok THEN pos END) OVER (PARTITION BY clip ORDER BY frame), 0) AS bad, max(pos) OVER (PARTITION BY clip) AS last FROM i)
    SELECT s.clip, seg, a, min(x.pos) - o.pos + 1 AS written FROM s JOIN q o ON o.clip = s.clip AND o.frame = a AND o.ok JOIN q x ON x.clip = s.clip AND x.pos >= o.pos AND (x.ok AND x.frame >= b - 1 OR NOT x.ok AND x.bad % 3 = 0 OR x.pos = x.last)
    GROUP BY s.clip, seg, a, o.pos""",
)
def written_clips(spark, d):
    f = frames(spark, d).select("clip", "frame", "event_id", "event_type", (F.col("value") > 20).alias("ok"), F.max("frame").over(Window.partitionBy("clip")).alias("mx"))
    s = f.where("event_type = 'purchase' and frame < mx").select("clip", F.col("event_id").alias("seg"), F.col("frame").alias("a"), F.least(F.col("frame") + 3 + F.col("event_id") % 30, "mx").alias("b"))
    return intervals.written_clips(f, s, "clip", "frame", "ok", "seg", "a", "b", 3).withColumn("written", F.col("written").cast("long"))


@query("linspace_pick", "P10", f"WITH f AS ({FRAMES}), n AS (SELECT clip, count(*) AS n FROM f GROUP BY clip), i AS (SELECT clip, n, unnest(range(0, 8)) AS i FROM n) SELECT clip, i AS pick, CAST(floor(i * (n - 1) / 7.0) AS BIGINT) AS frame FROM i")
def linspace_pick(spark, d):
    n = frames(spark, d).groupBy("clip").agg(F.count("*").alias("n"))
    return n.select("clip", F.posexplode(selection.linspace_floor(F.col("n"), 8)).alias("pick", "frame")).select("clip", F.col("pick").cast("long").alias("pick"), F.col("frame").cast("long").alias("frame"))


@query("linspace_candidates", "P11 N1", f"WITH f AS ({FRAMES}), n AS (SELECT clip, count(*) AS n FROM f WHERE value > 40 GROUP BY clip) SELECT DISTINCT clip, CAST(round_even(i * (n - 1) / 4.0, 0) AS BIGINT) AS at FROM (SELECT clip, n, unnest(CASE WHEN n <= 5 THEN [] ELSE range(0, 5) END) AS i FROM n) UNION SELECT clip, unnest(range(0, n)) AS at FROM n WHERE n <= 5")
def linspace_candidates(spark, d):
    n = frames(spark, d).where("value > 40").groupBy("clip").agg(F.count("*").alias("n"))
    return n.select("clip", F.explode(selection.linspace_round(F.col("n"), 5)).alias("at")).withColumn("at", F.col("at").cast("long"))


@query("subsampled_frames", "R14", f"WITH f AS ({FRAMES}) SELECT clip, frame, event_id FROM f WHERE frame % 4 = 0 AND frame < 40")
def subsampled_frames(spark, d):
    return selection.every_nth(frames(spark, d), ["clip"], ["frame"], 4, 10).select("clip", "frame", "event_id")


@query("first_frame_objects", "N4", f"WITH f AS ({FRAMES}), o AS (SELECT clip, frame, event_type AS obj FROM f), s AS (SELECT clip, obj FROM o WHERE frame = 0) SELECT clip, frame, obj FROM o SEMI JOIN s USING (clip, obj)")
def first_frame_objects(spark, d):
    """All frames of each clip, with the objects (event types) of its first frame."""
    return selection.objects_of_first_frame(frames(spark, d).select("clip", "frame", F.col("event_type").alias("obj")), ["clip"], "frame", "obj")


@query("skip_first_and_last", "F18 F17", f"WITH f AS ({FRAMES}), h AS (SELECT clip, frame, row_number() OVER (PARTITION BY clip ORDER BY frame) AS rn, count(*) OVER (PARTITION BY clip) AS n FROM f WHERE value > 30) SELECT clip, frame FROM h WHERE rn > 1 AND rn < n AND n >= 5")
def skip_first_and_last(spark, d):
    h = frames(spark, d).where("value > 30").withColumns({"rn": F.row_number().over(Window.partitionBy("clip").orderBy("frame")), "n": F.count("*").over(Window.partitionBy("clip"))})
    return h.where("rn > 1 and rn < n and n >= 5").select("clip", "frame")


@query(
    "depth_frames_scaled", "G11 G15 F15 R10",
    f"""WITH f AS ({FRAMES}), z AS (SELECT clip, frame, CASE WHEN event_type = 'view' THEN 0.0 WHEN value < 0.001 OR value >= 80 THEN 0.0 ELSE value END AS z FROM f), m AS (SELECT *, min(z) OVER (PARTITION BY clip) AS lo, max(z) OVER (PARTITION BY clip) AS hi FROM z)
    SELECT clip, frame, round(CASE WHEN hi > lo THEN (z - lo) / (hi - lo) ELSE 0 END * 2 - 1, 6) AS scaled, z > 0 AS valid FROM m""",
)
def depth_frames_scaled(spark, d):
    from quarryframe.functions.geometry import clean_depth, confident_depth, min_max_scaled, valid_depth

    f = frames(spark, d).withColumn("z", confident_depth(clean_depth(F.col("value"), 80.0), F.when(F.col("event_type") == "view", 0.0).otherwise(1.0)))
    w = Window.partitionBy("clip")
    return f.withColumns({"lo": F.min("z").over(w), "hi": F.max("z").over(w)}).select("clip", "frame", F.round(min_max_scaled(F.col("z"), F.col("lo"), F.col("hi")), 6).alias("scaled"), valid_depth(F.col("z")).alias("valid"))


@query(
    "quantile_trim", "F16",
    f"""WITH f AS ({FRAMES}), q AS (SELECT clip, quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.9) AS hi FROM f GROUP BY clip)
    SELECT f.clip, count(*) AS kept, round(avg(value), 6) AS mean FROM f JOIN q USING (clip) WHERE value BETWEEN lo AND hi GROUP BY f.clip""",
)
def quantile_trim(spark, d):
    f = frames(spark, d)
    q = f.groupBy("clip").agg(F.percentile("value", F.array(F.lit(0.1), F.lit(0.9))).alias("q"))
    return f.join(q, "clip").where(F.col("value").between(F.col("q")[0], F.col("q")[1])).groupBy("clip").agg(F.count("*").alias("kept"), F.round(F.avg("value"), 6).alias("mean"))


@query(
    "majority_label", "A6",
    """WITH c AS (SELECT user_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END AS label FROM events), n AS (SELECT user_id, label, count(*) AS n FROM c GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, label) AS rn FROM n WHERE label <> 0)
    SELECT u.user_id, r.label AS majority FROM (SELECT DISTINCT user_id FROM c) u LEFT JOIN r ON u.user_id = r.user_id AND rn = 1""",
)
def majority_label(spark, d):
    label = F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1).when(F.col("event_type") == "purchase", 2).otherwise(3)
    return evaluation.majority_label(table(spark, d, "events").select("user_id", label.alias("label")), ["user_id"], "label")


@query(
    "object_j", "A12 A14",
    f"""WITH f AS ({FRAMES}), a AS (SELECT clip, frame, CASE WHEN value > 30 THEN 1 ELSE 0 END AS t, CASE WHEN value > 22 THEN 1 ELSE 0 END AS p FROM f),
    b AS (SELECT *, max(greatest(t, p)) OVER (PARTITION BY clip ORDER BY frame ROWS UNBOUNDED PRECEDING) AS on_, max(t) OVER (PARTITION BY clip) AS ever FROM a)
    SELECT clip, round(100 * avg(CASE WHEN greatest(t, p) = 0 THEN 1.0 ELSE t * p / CAST(greatest(t, p) AS DOUBLE) END), 6) AS j, count(*) AS frames FROM b WHERE on_ = 1 AND ever = 1 GROUP BY clip""",
)
def object_j(spark, d):
    f = frames(spark, d).select("clip", "frame", (F.col("value") > 30).cast("int").alias("t"), (F.col("value") > 22).cast("int").alias("p"))
    f = f.withColumns({"i": F.col("t") * F.col("p"), "u": F.greatest("t", "p"), "in_t": F.col("t") == 1})
    return evaluation.scored_j(f.withColumn("seen", F.col("u") == 1), ["clip"], "frame", "i", "u", "in_t", "seen").withColumn("j", F.round("j", 6))


@query(
    "event_sessions", "2.12",
    """WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '1 hour' THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    b AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM a) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '1 hour' AS session_end, count(*) AS events FROM b GROUP BY user_id, s""",
)
def event_sessions(spark, d):
    return sessions.sessions(table(spark, d, "events"), "user_id", "ts", "1 hour", "1 hour")


@query("window_counts", "2.12", "SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def window_counts(spark, d):
    return sessions.tumbling_counts(table(spark, d, "events"), "ts", "1 day", "1 hour", "event_type")


@query("log_pivot", "A30", "SELECT user_id, event_type, list(round(value, 4) ORDER BY ts, event_id) AS series, count(*) AS n FROM events GROUP BY 1, 2")
def log_pivot(spark, d):
    cells = F.sort_array(F.collect_list(F.struct("ts", "event_id", F.round("value", 4).alias("v"))))
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.transform(cells, lambda x: x["v"]).alias("series"), F.count("*").alias("n"))


@query("json_props", "R6 P16", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, count(DISTINCT CAST(json_extract(props, '$.k') AS BIGINT)) AS k_distinct FROM events GROUP BY 1")
def json_props(spark, d):
    e = table(spark, d, "events").select("event_type", F.from_json("props", "k long")["k"].alias("k"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("k_sum"), F.count_distinct("k").alias("k_distinct"))


@query("running_meter", "A31 A32", "SELECT event_type, round(avg(value), 2) AS mean, round(var_pop(value), 2) AS variance, round(sum(value), 2) AS total, count(*) AS n FROM events GROUP BY 1")
def running_meter(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 2).alias("mean"), F.round(F.var_pop("value"), 2).alias("variance"), F.round(F.sum("value"), 2).alias("total"), F.count("*").alias("n"))


@query("first_last_wins", "O4 U4 A5", f"WITH f AS ({FRAMES}) SELECT clip, arg_max(frame, struct_pack(v := value, k := -frame)) AS best_frame, arg_min(frame, struct_pack(v := value, k := frame)) AS worst_frame, count(*) FILTER (value > 40) AS yes, count(*) FILTER (value > 20 AND value <= 40) AS partial, count(*) FILTER (value <= 20) AS no FROM f GROUP BY clip")
def first_last_wins(spark, d):
    v = F.col("value")
    return frames(spark, d).groupBy("clip").agg(
        F.max_by("frame", F.struct("value", -F.col("frame"))).alias("best_frame"), F.min_by("frame", F.struct("value", "frame")).alias("worst_frame"),
        F.count_if(v > 40).alias("yes"), F.count_if((v > 20) & (v <= 40)).alias("partial"), F.count_if(v <= 20).alias("no"),
    )


@query("init_selection", "S8", f"WITH f AS ({FRAMES}), s AS (SELECT clip, max(value) AS best, arg_max(frame, struct_pack(v := value, k := -frame)) AS by_score, arg_max(frame, struct_pack(v := event_id % 97, k := -frame)) AS by_iou, max(event_id % 97) AS iou FROM f GROUP BY clip) SELECT clip, CASE WHEN best >= 60 THEN by_score ELSE by_iou END AS init_frame FROM s")
def init_selection(spark, d):
    f = frames(spark, d).withColumn("iou", F.col("event_id") % 97)
    s = f.groupBy("clip").agg(F.max("value").alias("best"), F.max_by("frame", F.struct("value", -F.col("frame"))).alias("by_score"), F.max_by("frame", F.struct("iou", -F.col("frame"))).alias("by_iou"))
    return s.select("clip", F.when(F.col("best") >= 60, F.col("by_score")).otherwise(F.col("by_iou")).alias("init_frame"))


@query("greedy_tracks", "S1 J11", None)
def greedy_tracks(spark, d):
    from quarryframe.operators.stateful import track_boxes

    f = frames(spark, d)
    x, y = F.pmod(F.col("event_id"), F.lit(7)) * 4.0, F.pmod(F.floor("value"), F.lit(5)) * 3.0
    boxes = f.select("clip", (F.floor(F.col("frame") / 2)).alias("frame"), x.alias("x0"), y.alias("y0"), (x + 12).alias("x1"), (y + 10).alias("y1"))
    return track_boxes(boxes, "clip", "frame", ("x0", "y0", "x1", "y1"))


@query("box_nms", "S5", None)
def box_nms(spark, d):
    from quarryframe.operators.stateful import suppress

    f = frames(spark, d)
    x, y = F.pmod(F.col("event_id"), F.lit(11)) * 5.0, F.pmod(F.floor("value"), F.lit(9)) * 4.0
    return suppress(f.select("clip", "event_id", x.alias("x0"), y.alias("y0"), (x + 14).alias("x1"), (y + 14).alias("y1"), F.col("value").alias("score")), "clip", "event_id", ("x0", "y0", "x1", "y1"), "score", 0.5)


@query("greedy_dedup", "S2 J12", None)
def greedy_dedup(spark, d):
    """Band pairs come from a bucketed join; the greedy pass sees one clip's tracks and pairs."""
    import pandas as pd

    from quarryframe.operators.stateful import greedy_dedup as dedup

    f = frames(spark, d).where("value > 30").select("clip", "frame", "event_id", "value")
    a, b = (f.select("clip", F.col("frame").alias(f"{s}_frame"), F.col("event_id").alias(f"{s}_id"), F.col("value").alias(f"{s}_v")) for s in "ab")
    pairs = intervals.band_join(a, b, ["clip"], "a_frame", "b_frame", 5).where("a_id < b_id").withColumn("iou", F.least("a_v", "b_v") / F.greatest("a_v", "b_v"))
    side = f.groupBy("clip").agg(F.sort_array(F.collect_list(F.struct("event_id", "value"))).alias("tracks")).join(pairs.groupBy("clip").agg(F.collect_list(F.struct("a_id", "b_id", "iou")).alias("pairs")), "clip", "left")

    def run(batches):
        for batch in batches:
            rows = []
            for clip, tracks, pairs_ in zip(batch["clip"], batch["tracks"], batch["pairs"]):
                ids = [t["event_id"] for t in tracks]
                at = {e: i for i, e in enumerate(ids)}
                near = {(at[p["a_id"]], at[p["b_id"]]): p["iou"] for p in (pairs_ if pairs_ is not None else [])}
                hits = dedup([t["value"] for t in tracks], near, 0.8)
                rows += [(clip, e, None if h is None else ids[h]) for e, h in zip(ids, hits)]
            yield pd.DataFrame(rows, columns=["clip", "event_id", "duplicate_of"]).astype({"duplicate_of": "Int64"})

    return side.mapInPandas(run, "clip long, event_id long, duplicate_of long")


@query("pose_state_machine", "S3 F14 A.5 A.6", None)
def pose_state_machine(spark, d):
    """The tracker over each clip, with the event values as its silhouette IoU."""
    import pandas as pd

    from quarryframe.operators.stateful import PoseTracker

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("frame")
        iou = {int(f): float(v) / 60 for f, v in zip(group["frame"], group["value"])}
        clean = [f for f, v in iou.items() if v > 0.9]

        def track(frame, pose):
            m = {"iou": iou[frame], "rmse_norm": 0.04 if iou[frame] > 0.1 else float("nan"), "underfill": 0.2, "score": iou[frame], "rotation": 40 * abs(iou[frame] - pose), "shift": 0.1}
            return None if iou[frame] < 0.05 else (iou[frame], m)

        out = PoseTracker(track, lambda f: iou[f] if iou[f] > 0.2 else None, clean).run(sorted(iou), len(iou) // 2)
        return pd.DataFrame([(group["clip"].iloc[0], f, s, r) for f, s, r in out], columns=["clip", "frame", "status", "reason"])

    return frames(spark, d).select("clip", "frame", "value").groupBy("clip").applyInPandas(run, "clip long, frame long, status string, reason string")
