"""Operators against plain-Python loops and hand-made edge cases."""

import json
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryframe.functions import geometry, text
from quarryframe.operators import evaluation, intervals, manifest, masks, runs, selection, stateful, vectors
from quarryframe.session import require_columns
from quarryframe.sources import files, models
from quarryframe.streaming import sessions


def clean_loop(series, limit):
    def pass_(values, target):
        out, i = list(values), 0
        while i < len(values):
            j = i
            while j < len(values) and values[j] == values[i]:
                j += 1
            if values[i] == target and j - i < limit:
                out[i:j] = [not target] * (j - i)
            i = j
        return out

    return pass_(pass_(series, False), True)


def clean_spark(spark, many, limit):
    rows = [(k, i, v) for k, s in enumerate(many) for i, v in enumerate(s)]
    out = runs.clean_runs(spark.createDataFrame(rows, "clip int, frame int, v boolean"), ["clip"], ["frame"], "v", F.lit(limit)).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.clip, r.frame)):
        got.setdefault(r.clip, []).append(r.v)
    return [got[k] for k in range(len(many))]


def test_clean_runs(spark):
    T, N = True, False
    cases = [([T, T, N, T, T], [T] * 5), ([T, T, N, N, T, T], [T, T, N, N, T, T]), ([T, N, T, N, N, N], [T, T, T, N, N, N]), ([N, T, T, T, T], [T] * 5)]
    assert clean_spark(spark, [a for a, _ in cases], 2) == [b for _, b in cases]
    r = random.Random(1)
    many = [[r.random() < 0.6 for _ in range(r.randint(1, 40))] for _ in range(60)]
    assert clean_spark(spark, many, 3) == [clean_loop(s, 3) for s in many]


def test_short_run_limit_is_half_even(spark):
    got = spark.createDataFrame([(25,), (35,), (4,)], "n int").select(runs.short_run_limit(F.col("n")).alias("t")).collect()
    assert [r.t for r in got] == [2, 4, 1]


def merge_loop(ranges):
    out = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def test_merge_ranges(spark):
    r = random.Random(2)
    many = {0: [(0, 5), (5, 8), (10, 12), (1, 3)], 1: [(2, 4)] * 5}
    many |= {k: [(a, a + r.randint(1, 6)) for a in (r.randint(0, 60) for _ in range(20))] for k in range(2, 20)}
    df = spark.createDataFrame([(k, a, b) for k, v in many.items() for a, b in v], "k int, a int, b int")
    got = {}
    for x in intervals.merge_ranges(df, ["k"], "a", "b").orderBy("k", "a").collect():
        got.setdefault(x.k, []).append((x.a, x.b))
    assert got == {k: merge_loop(v) for k, v in many.items()}


def test_band_nearest_and_stab_equal_naive_joins(spark):
    r = random.Random(3)
    left, right = [(r.randint(0, 2), r.randint(-20, 60)) for _ in range(60)], [(r.randint(0, 2), r.randint(-20, 60)) for _ in range(60)]
    l, rr = spark.createDataFrame(list(enumerate(left)), "i int, p struct<k: int, a: int>").select("i", "p.*"), spark.createDataFrame(right, "k int, b int")
    got = sorted((x.i, x.b) for x in intervals.band_join(l, rr, ["k"], "a", "b", 4).collect())
    assert got == sorted((i, b) for i, (k, a) in enumerate(left) for k2, b in right if k == k2 and abs(a - b) <= 4)
    near = {x.i: x.b for x in intervals.nearest_join(l, rr, ["k"], ["i"], "a", "b", 8).collect()}
    for i, (k, a) in enumerate(left):
        some = [b for k2, b in right if k2 == k and abs(a - b) <= 8]
        assert near[i] == (min(some, key=lambda b: (abs(a - b), b)) if some else None)
    ranges = spark.createDataFrame([(j, k, b, b + j % 9) for j, (k, b) in enumerate(right)], "j int, k int, s int, e int")
    got = sorted((x.i, x.j) for x in intervals.stab(l, ranges, ["k"], "a", "s", "e", 5).collect())
    assert got == sorted((i, j) for i, (k, a) in enumerate(left) for j, (k2, b) in enumerate(right) if k == k2 and b <= a < b + j % 9)


def test_nearest_tie_takes_the_smaller(spark):
    l, r = spark.createDataFrame([(1, 10)], "k int, a int"), spark.createDataFrame([(1, 8), (1, 12)], "k int, b int")
    assert intervals.nearest_join(l, r, ["k"], [], "a", "b", 8).first().b == 8


def test_manifest_derivations(spark):
    df = spark.createDataFrame([("00:00:01.5", "00:00:01.0"), ("bad", "00:00:09"), ("00:00:01", "00:01:02.34"), (None, None)], "a string, b string")
    got = [r.d for r in df.select(manifest.duration_seconds(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got[:2] == [0, 0] and got[2] == pytest.approx(61.34) and got[3] == 0
    bad = manifest.pad_window(spark.createDataFrame([(50, 20), (10, 30)], "a int, b int"), "a", "b", 5, 100).collect()
    assert [(r.a, r.b) for r in bad] == [(5, 35)]
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(df, "c")


def test_md5_shards_cover_and_agree(spark):
    import hashlib

    df = spark.range(300).select(F.concat(F.lit("P01_"), F.col("id")).alias("k"))
    for n in (1, 3, 64):
        for r in df.select("k", manifest.md5_shard(F.col("k"), n).alias("s")).collect():
            assert r.s == int(hashlib.md5(r.k.encode()).hexdigest(), 16) % n
    with pytest.raises(ValueError):
        manifest.md5_shard(F.col("k"), 0)


def test_rank_split_and_global_rank(spark):
    got = manifest.with_global_rank(spark.range(10).select((F.col("id") * 7 % 10).alias("k")), ["k"], "r", 3).withColumn("p", manifest.rank_split(F.col("r"), 10, 3)).orderBy("k").collect()
    assert [r.r for r in got] == list(range(10)) and [r.p for r in got] == [0] * 3 + [1] * 3 + [2] * 4


def test_update_is_an_upsert_without_insert(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, x string, y int")
    up = spark.createDataFrame([(1, None, 9, "z"), (3, "n", 3, "z")], "id int, x string, y int, w string")
    assert [tuple(r) for r in manifest.update_by_key(base, up, "id").orderBy("id").collect()] == [(1, "a", 9), (2, "b", 2)]


def test_incremental_skip_is_idempotent(spark):
    planned, done = spark.createDataFrame([(1, 29.97), (2, 30.0), (3, 25.0)], "id int, fps double"), spark.createDataFrame([(1, 29.975), (2, 24.0)], "id int, fps double")
    todo = manifest.not_yet_written(planned, done, "id", {"fps": 1e-2})
    assert sorted(r.id for r in todo.collect()) == [2, 3]
    assert manifest.not_yet_written(planned, planned, "id", {"fps": 1e-2}).count() == 0


def test_evenly_spaced(spark):
    n = lambda k: F.lit(k)
    got = spark.range(1).select(selection.linspace_floor(n(3), 5).alias("a"), selection.linspace_round(n(5), 3).alias("b"), selection.linspace_round(n(3), 5).alias("c"), selection.linspace_round(n(0), 5).alias("d")).first()
    assert (got.a, got.b, got.c, got.d) == ([0, 0, 1, 1, 2], [0, 2, 4], [0, 1, 2], [])


def test_upper_fence(spark):
    df = spark.createDataFrame([(0, float(x)) for x in (1, 2, 3, 4, 100)] + [(1, 1.0), (1, 99.0)], "k int, v double")
    assert sorted(r.v for r in selection.upper_iqr_fence(df, ["k"], "v").where("k = 0").collect()) == [1, 2, 3, 4]
    assert selection.upper_iqr_fence(df, ["k"], "v").where("k = 1").count() == 2


def test_tiles_and_splits(spark):
    got = spark.range(1).select(selection.tile_starts(F.lit(100), 40, 10).alias("a"), selection.tile_starts(F.lit(30), 40, 10).alias("b")).first()
    assert (got.a, got.b) == ([0, 30, 60], [0])


def test_fractions_are_decimal_numbers(spark):
    for n, shares in ((90_000, {"train": 0.7, "test": 0.2}), (100, {"train": 0.29, "test": 0.57}), (7, {"train": 1e-5, "test": 1 / 3})):
        got = {r.s: r["count"] for r in spark.range(n).groupBy(selection.split_label(F.col("id"), F.lit(n), shares, "val").alias("s")).count().collect()}
        want = {k: math.floor(n * Fraction(str(v))) for k, v in shares.items()}
        assert got == {k: v for k, v in (want | {"val": n - sum(want.values())}).items() if v}


def test_sample_is_repeatable(spark):
    df = spark.range(200)
    a, b = ({r.id for r in selection.hash_sample(df.repartition(p), ["id"], 20, 3).collect()} for p in (2, 5))
    assert a == b and len(a) == 20


def test_text_parsers(spark):
    answers = {"yes.": "yes", "not yes": "no", "it is yes": "yes", "maybe": "no", "": "no", "I say yes, no": "yes"}
    for raw, want in answers.items():
        assert spark.range(1).select(text.parse_yes_no(F.lit(raw)).alias("v")).first().v == want
    seen = {"Partial yes": "partial", "unknown": "no", "y": "yes", "p": "partial", None: "no"}
    for raw, want in seen.items():
        assert spark.range(1).select(text.parse_visibility(F.lit(raw).cast("string")).alias("v")).first().v == want
    gate = spark.range(1).select(text.verdict_passes(F.lit("no"), F.lit("no, yes")).alias("a"), text.verdict_passes(F.lit("no"), F.lit("no, yes"), True).alias("b")).first()
    assert gate.a and not gate.b


def test_remaps(spark):
    df = spark.createDataFrame([(0,), (1,), (255,)], "v int")
    assert [r.c for r in df.select(text.cascading_remap(F.col("v"), {0: 1, 1: 2}).alias("c")).collect()] == [2, 2, 255]
    assert [r.z for r in df.select(text.reduce_zero_label(F.col("v")).alias("z")).collect()] == [255, 0, 255]


def random_masks(n, seed=0):
    draw = np.random.default_rng(seed)
    return [draw.random((int(draw.integers(1, 14)), int(draw.integers(1, 14)))) < draw.random() for _ in range(n)]


def test_run_lengths_round_trip():
    assert masks.encode(np.array([[1, 0], [1, 1]])) == [0, 2, 1, 1]
    for m in random_masks(60):
        c = masks.encode(m)
        assert (masks.decode(c, *m.shape) == m).all() and masks.from_compressed(masks.to_compressed(c)) == c and sum(c[1::2]) == m.sum()
    big = [0, 100000, 3, 70000, 5, 1]
    assert masks.from_compressed(masks.to_compressed(big)) == big


def test_mask_algebra_equals_dense(spark):
    a, b = random_masks(25, 1), random_masks(25, 2)
    b = [np.resize(y, x.shape) for x, y in zip(a, b)]
    frame = lambda ms: spark.createDataFrame([(k, *m.shape, [int(x) for x in masks.encode(m)]) for k, m in enumerate(ms)], "k int, h int, w int, counts array<int>")
    left, right = frame(a), frame(b)
    got = {r.k: r.common for r in masks.intersections(masks.runs(left, ["k"]), masks.runs(right, ["k"]), ["k"], 7).collect()}
    areas = {r.k: r.a for r in left.select("k", masks.area(F.col("counts")).alias("a")).collect()}
    boxes = {r.k: r for r in masks.bounding_box(masks.runs(left, ["k", "h"]), ["k"], F.col("h")).collect()}
    for k, (x, y) in enumerate(zip(a, b)):
        assert got.get(k, 0) == (x & y).sum() and areas[k] == x.sum()
        if x.any():
            ys, xs = np.nonzero(x)
            assert (boxes[k].x0, boxes[k].y0, boxes[k].x1, boxes[k].y1) == (xs.min(), ys.min(), xs.max(), ys.max())


def flood(m):
    labels, n = np.zeros(m.shape, int), 0
    for y, x in zip(*np.nonzero(m)):
        if labels[y, x]:
            continue
        n += 1
        stack = [(y, x)]
        while stack:
            i, j = stack.pop()
            if 0 <= i < m.shape[0] and 0 <= j < m.shape[1] and m[i, j] and not labels[i, j]:
                labels[i, j] = n
                stack += [(i + a, j + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    return labels, n


def test_components_and_morphology():
    for m in random_masks(60, 5):
        labels, n = masks.components(m)
        want, k = flood(m)
        assert n == k and (labels == want).all()
    full = np.ones((5, 5), bool)
    assert masks.erode(full, masks.square(3)).all() and not masks.opened(np.eye(5, dtype=bool), masks.square(3))[0, 4]
    island = np.zeros((8, 8), bool)
    island[1:4, 1:4] = island[6, 6] = True
    kept, changed = masks.without_small_regions(island, 4, holes=False)
    assert changed and kept.sum() == 9
    assert masks.boundary_f(island, island) == 1 and masks.boundary_f(np.zeros_like(island), island) == 0


def test_class_metrics_match_a_confusion_matrix(spark):
    draw = np.random.default_rng(0)
    pred, label = draw.integers(0, 19, (4, 300)), draw.integers(0, 19, (4, 300))
    label[:, 20:50], pred[pred == 18], label[label == 18] = 255, 17, 17
    df = spark.createDataFrame([(int(p), int(l)) for p, l in zip(pred.ravel(), label.ravel())], "p int, l int")
    got = {r.cls: r for r in evaluation.class_metrics(evaluation.class_areas(df, "p", "l", 19), nan_to=-1.0).collect()}
    keep = label.ravel() != 255
    m = np.bincount(19 * label.ravel()[keep] + pred.ravel()[keep], minlength=361).reshape(19, 19)
    for c in range(18):
        assert got[c].iou == pytest.approx(m[c, c] / (m[c].sum() + m[:, c].sum() - m[c, c])) and got[c].acc == pytest.approx(m[c, c] / m[c].sum())
    assert got[18].iou == got[18].acc == -1


def test_small_metrics(spark):
    w = spark.createDataFrame([(0, 1.0, 1.0, 0), (0, 2.0, 1.0, 1), (0, 3.0, 2.0, 2)], "k int, v double, w double, i int")
    assert evaluation.weighted_median(w, ["k"], "v", "w", ["i"]).first().weighted_median == 2
    ap = evaluation.precision_at(spark.createDataFrame([(0.5,), (0.51,)], "iou double"), "iou", [0.5]).first()
    assert ap.ap50 == 0.5
    m = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (0, 2), (1, 0)], "k int, l int")
    assert {r.k: r.majority for r in evaluation.majority_label(m, ["k"], "l").collect()} == {0: 1, 1: None}
    j = spark.createDataFrame([(0, 0, 0, 0, True, False), (0, 1, 2, 4, True, True), (0, 2, 0, 0, True, False)], "k int, f int, i int, u int, t boolean, s boolean")
    assert evaluation.scored_j(j, ["k"], "f", "i", "u", "t", "s").first().j == pytest.approx(75)
    lat = evaluation.latent_stats(spark.createDataFrame([(1, [1.0]), (2, [3.0])], "k int, v array<double>"), "k", "v").first()
    assert (lat["mean"], lat["std"]) == (2, 1)


def test_geometry(spark):
    eye = F.array(*[F.lit(float(x)) for x in (1, 0, 0, 0, 1, 0, 0, 0, 1 + 1e-12)])
    assert spark.range(1).select(geometry.rotation_angle_deg(eye, eye).alias("a")).first().a == 0
    assert spark.range(1).select(geometry.hammersley_sphere(F.lit(3), 8).alias("s")).first().s.yaw == pytest.approx(0.75 * 2 * math.pi)
    p = spark.createDataFrame([(float("nan"),), (-1.0,), (float("inf"),), (2.0,)], "z double").select(geometry.valid_depth(F.col("z")).alias("v")).collect()
    assert [r.v for r in p] == [False, False, False, True]


def test_tracker_edges():
    box = (0.0, 0.0, 10.0, 10.0)
    half = (0.0, 0.0, 10.0, 5.0)
    assert [t.frames for t in stateful.greedy_tracks([0, 4], [box, box])] == [[0, 4]]
    assert stateful.greedy_tracks([0, 5], [box, box]) == []
    first = stateful.greedy_tracks([0, 0, 1], [box, box, half])
    assert [t.id for t in first] == [0] and first[0].frames == [0, 1]


def test_dedup_nms_and_balance():
    assert stateful.greedy_dedup([1.0, 3.0, 2.0], {(0, 1): 0.3, (1, 2): 0.29}) == [1, None, None]
    boxes = np.array([[0, 0, 10, 10], [1, 0, 11, 10], [20, 0, 30, 10.0]])
    assert stateful.box_nms(boxes, np.array([0.5, 0.9, 0.1]), 0.5) == [1, 2]
    groups = stateful.balanced_groups([5, 4, 3, 3, 3], 2)
    assert sorted(sum([5, 4, 3, 3, 3][i] for i in g) for g in groups) == [8, 10] and sorted(map(len, stateful.balanced_groups([9, 1, 1, 1], 2, True))) == [2, 2]


def test_pose_gates_and_tracker():
    g = stateful.Gates()
    ok = {"iou": 0.15, "rmse_norm": float("nan"), "underfill": 0.0, "score": 1.0, "rotation": 0.0, "shift": 0.0}
    assert g.reject_reason(ok, None, 0) == "" and g.reject_reason(ok | {"iou": 0.13}, None, 0) == "geom"
    assert g.reject_reason(ok | {"score": 0.0, "rotation": 99.0, "shift": 9.0}, 1.0, 0) == "drop,rot,trans" and g.reject_reason(ok | {"rotation": 99.0}, 1.0, 1) == ""
    lost = stateful.PoseTracker(lambda f, p: None, lambda f: 1, [], budget=3)
    lost.run(list(range(10)), 5)
    assert [s for _, s, _ in lost.log] == ["reinit", "reinit", "budget_exhausted", "budget_exhausted"]
    fail = stateful.PoseTracker(lambda f, p: None, lambda f: 1 if f == 5 else None, [])
    fail.run(list(range(10)), 5)
    assert fail.log[0] == (4, "failed_track", "lost")


def test_small_solvers():
    assert stateful.best_scale(lambda s: (math.log(s) - 0.3) ** 2, 0.1, 10) == pytest.approx(math.exp(0.3), rel=1e-5)
    draw = np.random.default_rng(1)
    x = draw.normal(size=(20, 3))
    q, _ = np.linalg.qr(draw.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    s, r, t = stateful.procrustes(x, 2.5 * x @ q.T + [1, 2, 3])
    assert s == pytest.approx(2.5) and np.allclose(r, q) and np.allclose(t, [1, 2, 3])
    assert stateful.chamfer(x, x) == 0 and stateful.chamfer(x, x[:0]) == math.inf
    assert stateful.frame_scale(2 * x, x) == pytest.approx(2)
    assert stateful.cluster_poses([np.eye(4), np.eye(4)], 1, 0.1) == [0, 0]
    assert stateful.largest_dbscan_cluster(np.array([[0, 0, 0], [0.1, 0, 0], [9, 9, 9.0]]), 0.5, 2).tolist() == [True, True, False]


def test_nearest_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(4)
    v = draw.normal(size=(80, 6))
    df = spark.createDataFrame([(i, [float(a) for a in x]) for i, x in enumerate(v)], "id long, v array<double>").repartition(3)
    got = {}
    for r in vectors.nearest_vectors(df.where("id % 20 = 0"), df, "id", "v", 4).orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append(r.k)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in (0, 20, 40, 60):
        d = 1 - u @ u[q]
        assert got[q] == [i for i in np.argsort(d, kind="stable") if i != q][:4]


def test_file_sources(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for p in ("a/x.MP4", "a/b/x.mp4", "a/y.txt"):
        (tmp_path / p).write_bytes(b"1")
    listing = files.latest_by_stem(files.list_files(spark, str(tmp_path / "a"), ["mp4"])).collect()
    assert [(r.stem, r.path.endswith("a/x.MP4") or r.path.endswith("b/x.mp4")) for r in listing] == [("x", True)]
    store = tmp_path / "npz"
    store.mkdir()
    m = np.zeros((2, 4, 5), np.uint8)
    m[0, 1, 1], m[1, 2:, 3] = 1, 2
    np.savez(store / "stack.npz", masks=m)
    np.savez(store / "frames.npz", **{"10": m[1], "2": m[0]})
    np.savez(store / "bad.npz", a=m, b=m)
    got = files.read_masks(spark, str(store)).collect()
    assert sorted((r.path.split("/")[-1], r.frame, r.label) for r in got if r.frame is not None) == [("frames.npz", 2, 1), ("frames.npz", 10, 2), ("stack.npz", 0, 1), ("stack.npz", 1, 2)]
    assert sum(r.frame is None for r in got) == 1
    good = spark.createDataFrame([r for r in got if r.frame is not None], files.MASKS)
    files.write_masks(good.withColumn("clip", F.lit("c")), str(tmp_path / "out"), "clip")
    files.write_masks(good.limit(1).withColumn("clip", F.lit("d")), str(tmp_path / "out"), "clip")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    (tmp_path / "cam.json").write_text('{"3": {"cam_K": [1,2,3], "depth_scale": 0.1}}')
    assert files.read_scene_cameras(spark, str(tmp_path / "cam.json")).first().name == "000003"
    (tmp_path / "gt.json").write_text('{"3": [{"obj_id": 5, "cam_R_m2c": [1.0], "cam_t_m2c": [2.0]}]}')
    assert files.read_scene_poses(spark, str(tmp_path / "gt.json")).first().obj_id == 5
    (tmp_path / "sav.json").write_text('{"video_id": "v", "masklet_id": [7], "masklet": [[{"size": [2, 2], "counts": "04"}], [{"size": [2, 2], "counts": "13"}]]}')
    assert [(r.frame, r.object_id) for r in files.read_masklets(spark, str(tmp_path / "sav.json"), 4).orderBy("frame").collect()] == [(0, 7), (4, 7)]
    (tmp_path / "log.json").write_text('{"env": "x"}\n{"epoch": 1, "loss": 0.5}\n{"epoch": 1, "loss": 0.25}\n')
    assert files.read_train_log(spark, str(tmp_path / "log.json")).first()["values"] == [0.5, 0.25]
    (tmp_path / "m.csv").write_text("video_id,narration_id,start_frame,stop_frame,start_timestamp,stop_timestamp\nv,n,1,2,00:00:01,00:00:02\n")
    assert files.read_manifest(spark, str(tmp_path / "m.csv")).first().stop_frame == 2


def test_model_slots_keep_errors(spark):
    df = spark.createDataFrame([(1, 2), (2, 0), (3, 4)], "id int, v int")
    got = models.for_each_row(df, "id", lambda r: None if r["id"] == 3 else {"x": 1.0 / r["v"]}, "x double").orderBy("id").collect()
    assert got[0].x == 0.5 and "ZeroDivisionError" in got[1].error and len(got) == 2
    out = models.apply_model(df, "double", lambda: 2, lambda m, b: b.assign(v=b["v"] * m), "id int, v int").collect()
    assert sorted(r.v for r in out) == [0, 4, 8]


def test_streams_agree_with_batches(spark, tmp_path):
    rows = [(u, i, f"2024-01-01 00:{i:02d}:00", i % 3 != 0) for u in (1, 2) for i in range(20)]
    df = spark.createDataFrame(rows, "u long, i long, t string, good boolean").withColumn("ts", F.col("t").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = sessions.longest_runs(stream, "u", "i", "good").writeStream.format("memory").queryName("runs").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.u: r.longest for r in spark.table("runs").collect()} == {1: 2, 2: 2}
    counts = sessions.tumbling_counts(stream, "ts", "10 minutes", "1 minute", "u").writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    counts.awaitTermination()
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, sessions.tumbling_counts(df, "ts", "10 minutes", "1 minute", "u").collect()))
    assert sessions.sessions(df, "u", "ts", "5 minutes", "1 minute").count() == 2


def test_image_functions():
    from quarryframe.operators import images

    a = np.arange(12).reshape(3, 4)
    padded, box = images.pad_square(a, 99)
    assert padded.shape == (4, 4) and (images.cut_square(padded, box) == a).all()
    assert images.resize_nearest(a, 6, 8)[::2, ::2].tolist() == a.tolist()
    m = np.zeros((9, 9), bool)
    m[3:6, 3:6] = True
    assert images.dilated_foreground(m.astype(int)).sum() == 81 and images.masked_crop(np.ones((9, 9, 3)), m).shape == (3, 3, 3)
    assert (images.sample_points(m, 5, 1, 2) == images.sample_points(m, 5, 1, 2)).all() and all(m[y, x] for x, y in images.sample_points(m, 20, 0, 0))
    assert not any(m[y, x] for x, y in images.negative_points(m, np.zeros_like(m), (4, 4, 0), (1, 2), 3, 0, 0))
    depth = np.full((5, 5), 2.0)
    depth[2, 2] = 9.0
    assert images.eroded_depth(depth, 1)[2, 2] == 0 and images.eroded_depth(depth, 1)[0, 0] == 2 and images.bilateral_depth(np.full((4, 4), 2.0))[0, 0] == pytest.approx(2)
    p = np.array([[[0.9, 0.2]], [[0.1, 0.8]]])
    assert images.hard_pixels(p, np.array([[0, 255]]), 1, 0.95).tolist() == [[True, False]]
    assert len(images.contiguous_frames(10, 4, 0.5, 3)) == 4
    with pytest.raises(ValueError):
        images.contiguous_frames(2, 4, 0.5, 3)


def test_global_rank_of_many_rows(spark):
    """Enough rows that a range exchange would sample them, with nulls and ties."""
    rows = spark.range(0, 200_000, 1, 4).select(F.when(F.col("id") % 1000 > 0, F.xxhash64(F.col("id") % 150_000)).alias("k"), F.col("id").alias("i"))
    got = manifest.with_global_rank(rows, ["k", "i"]).select("k", "i", "rank").toPandas().sort_values("rank")
    assert got["rank"].tolist() == list(range(200_000))
    pairs = [(math.isnan(k), k, i) for k, i in zip(got["k"].iloc[200:2200], got["i"].iloc[200:2200])]
    assert got["k"].iloc[:200].isna().all() and pairs == sorted(pairs)
    assert manifest.with_global_rank(rows.limit(0), ["k"]).count() == 0
    single = manifest.with_global_rank(spark.range(0, 100_000, 1, 4).select(F.xxhash64("id").alias("k")), ["k"]).toPandas()
    assert (single.sort_values("k")["rank"].to_numpy() == np.arange(100_000)).all()


def test_decoders_in_turn_and_missing_masks(spark):
    work = models.first_that_works([lambda r: {"n": int(r["x"])}, lambda r: None if r["x"] == "skip" else {"n": {"one": 1}[r["x"]]}])
    assert work({"x": "7"}) == {"n": 7, "level": 0} and work({"x": "one"}) == {"n": 1, "level": 1} and work({"x": "skip"}) is None
    with pytest.raises(KeyError):
        work({"x": "none"})
    texts = spark.createDataFrame([(None,), ("{}",), ('{"images": [], "annotations": [{"image_id": 1}]}',), ("not json",)], "value string")
    assert files.amodal_annotations(texts).count() == 0 and files.masklets(texts).count() == 0 and files.scene_cameras(texts.limit(2)).count() == 0
    planned, objects = spark.createDataFrame([("a", 0), ("a", 1)], "clip string, frame int"), spark.createDataFrame([("a", 5)], "clip string, obj int")
    found = spark.createDataFrame([("a", 1, 5, [2, 3])], "clip string, frame int, obj int, counts array<int>")
    got = files.with_missing_masks(planned, objects, found, "clip", "frame", "obj", F.lit(5)).orderBy("frame").collect()
    assert [r.counts for r in got] == [[5], [2, 3]]


def test_amodal_annotations_of_a_long_video(spark):
    n = 12_000
    mark = lambda i: {"image_id": i, "track_id": 10 * i, "segmentation": {"size": [4, 5], "counts": "x"}, "bbox": [i, 1, 2, 3], "amodal_bbox": [i, 1, 4, 3]}
    long = {"images": [{"id": i, "video_id": 1, "frame_index": i + 5} for i in range(n)], "annotations": [mark(i) for i in range(-n, n)]}
    # Two videos use the same ids; an id that is listed twice is the later image.
    short = {"images": [{"id": 3, "video_id": 2, "frame_index": f} for f in (9, 8)], "annotations": [mark(3), mark(3), mark(4)]}
    texts = spark.createDataFrame([(json.dumps(x),) for x in (long, short, short)], "value string")
    got = Counter((r.video_id, r.frame, r.track_id, tuple(r.box)) for r in files.amodal_annotations(texts).collect())
    assert got == Counter({(2, 8, 30, (3.0, 1.0, 2.0, 3.0)): 4} | {(1, i + 5, 10 * i, (float(i), 1.0, 2.0, 3.0)): 1 for i in range(n)})


def test_tiling_ties_between_different_ratios(spark):
    """1000 x 800 is a quarter off 1/1 and 3/2: the last one whose tiles the image half fills wins; a small image takes the first."""
    one = spark.range(1).select(geometry.closest_tiling(F.lit(1.25), 12, F.lit(1000 * 800)).alias("a"), geometry.closest_tiling(F.lit(1.25), 12, F.lit(100)).alias("b"), geometry.closest_tiling(F.lit(1.25), 6, F.lit(1000 * 800)).alias("c")).first()
    fold = None
    for w, h in sorted(((w, h) for w in range(1, 13) for h in range(1, 13) if w * h <= 12), key=lambda x: (x[0] * x[1], x)):
        off = abs(1.25 - w / h)
        if fold is None or off < fold[0] or off == fold[0] and 800_000 > 0.5 * 448 * 448 * w * h:
            fold = off, w, h
    assert tuple(one.a) == fold[1:] and tuple(one.c) == (3, 2) and one.b.w * one.b.h <= one.a.w * one.a.h


def test_contact_of_narrow_masks_is_their_intersection():
    hands, objects = np.zeros((4, 455), bool), np.zeros((4, 455), bool)
    hands[:, :5], objects[:, 4:9] = True, True
    assert masks.contact_boundary(hands, objects).sum() == 4


def test_subset_of_unknown_classes():
    with pytest.raises(ValueError, match="no such classes: cat"):
        text.class_subset(F.lit(0), ["dog"], ["cat"])


def clips_loop(good, segments, patience):
    """The writer as a loop over the decoded frames: which frames each segment gets."""
    out, opened, failed = {}, set(), 0
    for t in sorted({t for _, a, b in segments for t in range(a, b)}):
        if good[t]:
            failed = 0
            opened |= {s for s, a, _ in segments if a == t}
            for s in opened:
                out[s] = out.get(s, 0) + 1
            opened -= {s for s, _, b in segments if t >= b - 1}
            continue
        failed += 1
        for s in opened:
            out[s] = out.get(s, 0) + 1
        if failed == patience:
            opened, failed = set(), 0
    return out


def test_written_clips_equal_a_loop(spark):
    rng, frames, segments, want = random.Random(3), [], [], set()
    for clip in range(12):
        good = [rng.random() < (0.3 + 0.05 * clip) for _ in range(80)]
        own = [(clip * 100 + i, a, min(a + rng.randint(1, 25), 80)) for i, a in enumerate(rng.choices(range(79), k=6))]
        frames += [(clip, t, g) for t, g in enumerate(good)]
        segments += [(clip, *s) for s in own]
        want |= {(s, n) for s, n in clips_loop(good, own, 3).items()}
    f, s = spark.createDataFrame(frames, "clip int, frame long, good boolean"), spark.createDataFrame(segments, "clip int, seg int, a long, b long")
    got = intervals.written_clips(f, s, "clip", "frame", "good", "seg", "a", "b", 3).collect()
    assert {(r.seg, r.written) for r in got} == want and len(got) == len(want)


def test_resumable_sample_deals_evenly(spark):
    for n, workers in ((3, 7), (10, 4), (12, 4), (0, 3)):
        rows = selection.resumable_sample(spark.range(n), "id", workers, seed=5).collect()
        steps = -(-n // workers)
        assert sorted((r.worker, r.step) for r in rows) == [(w, s) for w in range(workers) for s in range(steps)]
        assert {r.id for r in rows} == set(range(n))
        later = selection.resumable_sample(spark.range(n), "id", workers, seed=5, done=1).collect()
        assert sorted(later) == sorted(r for r in rows if r.step >= 1)


def test_unknown_sources_are_errors(spark):
    from quarryframe.sources import plugins

    plugins.register("empty", plugins.Source({}, "a int", lambda row: None))
    with pytest.raises(ValueError, match="Invalid source"):
        plugins.by_name("empty").metadata(spark, "x")
    with pytest.raises(ValueError, match="no source"):
        plugins.by_name("absent")
