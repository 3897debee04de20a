"""Nothing is left out: whole clips, whole vocabularies, whole pages."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryframe.operators import evaluation, selection, stateful

FOLDER = os.environ.get("QUARRY_TEST_TABLES", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@tables
def test_masklets_of_all_frames(spark):
    from quarryframe.plans import REGISTRY

    got = REGISTRY["masklet_rows"].build(spark, FOLDER)
    assert got.count() == 2 * spark.read.parquet(f"{FOLDER}/events.parquet").count()


def test_spans_and_diameter():
    p = np.random.default_rng(1).normal(size=(3000, 3)) * [5, 1, 1]
    assert stateful.hull_diameter(p[:700]) == pytest.approx(max(np.linalg.norm(p[:700] - q, axis=1).max() for q in p[:700]))
    line = np.outer(np.arange(100.0), [0.6, 0.8, 0])
    assert stateful.hull_diameter(line) == pytest.approx(99) and stateful.pca_span(line) == pytest.approx(99)
    deep = np.outer(np.arange(100.0), [0, 0, 1])  # depths 2 to 97 stay
    assert stateful.visible_diameter(deep) == pytest.approx(95) and stateful.visible_diameter(deep[:49]) == 0
    assert stateful.hull_diameter(p[:1]) == stateful.pca_span(p[:1]) == 0 and stateful.hull_diameter(np.ones((5, 3))) == 0


def test_pose_errors():
    square, turned = np.array([[1.0, 0, 0], [0, 1, 0], [-1, 0, 0], [0, -1, 0]]), np.eye(4)
    turned[:2, :2] = [[0, -1], [1, 0]]
    assert stateful.add_error(turned, np.eye(4), square) == pytest.approx(math.sqrt(2))
    assert stateful.adds_error(turned, np.eye(4), square) == pytest.approx(0)


def test_scene_normalisation():
    near = np.array([[0, 0, 0], [0.05, 0, 0], [0.1, 0, 0], [5, 5, 5]])
    move, scale, keep = stateful.scene_normalisation(near)
    assert list(keep) == [True, True, True, False] and move == pytest.approx([-0.05, 0, 0]) and scale == pytest.approx(18)
    assert stateful.scene_normalisation(near, cluster=False)[1] == pytest.approx(1.8 / 5)


def test_depth_boundary_f1():
    z = np.ones((6, 6))
    z[:, 3:] = 2.0
    assert stateful.depth_boundary_f1(z, z, z > 0) == pytest.approx(1) and stateful.depth_boundary_f1(np.ones((6, 6)), z, z > 0) == 0
    shallow = np.where(z > 1, 1.2, 1.0)  # an edge up to t = 0.2 only
    t = np.linspace(0.05, 0.25, 10)
    assert stateful.depth_boundary_f1(shallow, z, z > 0) == pytest.approx(t[1 + t < 1.2].sum() / t.sum())


def test_masked_depth_rmse_and_occluded_iou(spark):
    px = spark.createDataFrame([(1, 2.0, 1.0, True), (1, 4.0, 4.0, True), (1, 9.0, 1.0, False), (2, 1.0, 1.0, False)], "k int, p double, t double, m boolean")
    got = {r.k: (r.rmse, r.rmse_norm) for r in evaluation.depth_rmse(px, "p", "t", F.col("m"), ["k"]).collect()}
    assert got[1] == pytest.approx((math.sqrt(0.5), math.sqrt(0.5) / 2.5)) and got[2] == (math.inf, math.inf)
    areas = spark.createDataFrame([(1, 0, 4), (1, 2, 4), (2, 0, 3)], "k int, i int, u int")
    got = {r.k: r for r in evaluation.occluded_miou(areas, "i", "u", ["k"]).collect()}
    assert got[1].miou == pytest.approx(0.25, abs=1e-5) and got[1].miou_occ == pytest.approx(0.5, abs=1e-5) and got[2].miou == 0 and math.isnan(got[2].miou_occ)


def test_objects_of_the_first_frame(spark):
    rows = [(1, 3, "a"), (1, 3, "b"), (1, 4, "a"), (1, 5, "c"), (1, 6, None), (2, 0, "c"), (2, 1, "c")]
    clips = spark.createDataFrame(rows, "clip int, frame int, obj string")
    got = selection.objects_of_first_frame(clips, ["clip"], "frame", "obj")
    assert sorted(map(tuple, got.collect())) == [r for r in rows if r[2] and (r[0], r[2]) != (1, "c")]
    with pytest.raises(Exception, match="no objects"):
        selection.objects_of_first_frame(spark.createDataFrame([(1, 0, None), (1, 1, "a")], clips.schema), ["clip"], "frame", "obj").collect()
