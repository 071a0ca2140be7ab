"""Frames, pairs, selection, scaling, sources, streams."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from trivet import config
from trivet.operators import frames, matchgraph, recon, scaling, select
from trivet.plans.mesh_pipeline import Stages, scale_meshes
from trivet.sources import files, images, sinks
from trivet.streaming import frames as streams


@pytest.mark.parametrize("case,step", [((30, 1, 15.0, None, 7), 4), ((60, 1, 30.0, None, 6), 10), ((60, 1, 30.0, 10.0, 50), 3), ((60, 1, 30.0, 15.0, 5), 12), ((0, 2, 30.0, None, 5), 2)])
def test_stride(spark, case, step):
    count, interval, fps, target, most = case
    v = spark.createDataFrame([(1, count, fps)], "video_id long, frame_count long, fps double")
    out = frames.stride(v, F.lit(interval), None if target is None else F.lit(target), F.lit(most))
    assert out.first()["step"] == step
    assert frames.extract_rows(out, most).count() == (0 if count == 0 else min(most, -(-count // step)))


def test_gate_fold_coverage(spark):
    f = spark.createDataFrame([(1, 0, 150.0, 20.0, 40.0), (1, 1, 150.0, 220.0, 40.0), (1, 2, 5.0, 250.0, 0.0)], "video_id long, seq long, sharpness double, brightness double, contrast double")
    g = {r["seq"]: r for r in frames.gate(f).collect()}
    assert g[0]["reasons"] == ["Underexposed (brightness 20.0 < 30.0)"] and g[1]["accepted"] and len(g[2]["reasons"]) == 4
    a, b = [10.0] * 16, [200.0] * 16
    t = spark.createDataFrame([(1, 0, a), (1, 1, a), (1, 2, b), (2, 0, b)], "video_id long, seq long, thumb array<double>")
    assert [r["accepted"] for r in frames.fold_redundant(t).orderBy("video_id", "seq").collect()] == [True, False, True, True]
    cov = {r["video_id"]: r["coverage"] for r in frames.coverage(t).collect()}
    assert cov == {1: 1.0, 2: 0.1}
    assert frames.guidance is not None
    notes = spark.range(1).select(frames.guidance(F.lit(0.5), F.lit(0.0), F.lit(0.0), F.lit(0.4)).alias("n")).first()["n"]
    assert notes == [frames.MORE_SLOWLY, frames.ORBIT]


def test_bridge(spark):
    rows = [(1, i, 0.9 if i != 2 else 0.1, False, 100.0, 40.0, 50, [float(i * 40)]) for i in range(5)]
    f = spark.createDataFrame(rows, "video_id long, seq long, optical double, severe boolean, brightness double, contrast double, keypoints int, thumb array<double>")
    e = spark.createDataFrame([(1, i, j, True, True) for i, j in ((0, 1), (3, 4), (1, 2), (2, 3))], "video_id long, i long, j long, is_connected boolean, is_parallax_bearing boolean")
    out = {r["seq"]: r for r in select.select_keyframes(f, e, 3).collect()}
    assert out[2]["selected"] and sum(r["selected"] for r in out.values()) == 3
    again = select.select_keyframes(f, e, 3).collect()
    assert {r["seq"]: r for r in again} == out
    bad = f.withColumns({"severe": F.lit(True), "brightness": F.lit(5.0)})
    assert all(r["reason"].startswith("Severe underexposure") for r in select.select_keyframes(bad, e.limit(0), 3).collect())


def test_classify(spark):
    e = spark.createDataFrame([(1, 0, 1, 0, 15), (1, 0, 2, 20, 10), (1, 0, 3, 3, 3)], "video_id long, i long, j long, f_inliers int, h_inliers int")
    c = {r["j"]: r for r in matchgraph.classify(e).collect()}
    assert (c[1]["is_connected"], c[1]["is_parallax_bearing"], c[1]["h_ratio"]) == (True, False, 1.0)
    assert c[2]["is_parallax_bearing"] and not c[3]["is_connected"]


def test_scaling(spark):
    obs = spark.createDataFrame([(1, x) for x in (25.0, 25.1, 24.9, 25.0)], "mesh_id long, length double")
    v = spark.createDataFrame([(1, 0, 15.0, 20.0, 30.0), (1, 1, 10.0, 20.0, 30.0)], "mesh_id long, vid long, x double, y double, z double")
    out, est = scale_meshes(v, obs, F.lit(50.0), (10.0, 20.0, 30.0))
    e = est.first()
    assert e["scale_factor"] == pytest.approx(2) and e["confidence"] > 0.95 and e["verified"]
    assert out.where("vid = 0").first()["x"] == pytest.approx(20)
    with pytest.raises(Exception, match="finite"):
        scaling.measure(obs.unionByName(spark.createDataFrame([(1, -1.0)], obs.schema)), "mesh_id", "length").collect()
    t = spark.createDataFrame([(50.0, 50.0, 50.0, 50.5, 49.0, 50.2)], "a double, b double, c double, x double, y double, z double")
    assert scaling.compare_truth(t, ("a", "b", "c"), ("x", "y", "z"), F.lit(1.0)).first()["passed"]


def test_recon_rules(spark):
    m = spark.createDataFrame([("j", "a", 2, 10, 3), ("j", "b", 8, 150, 3), ("j", "c", 8, 150, 3)], "job_id string, path string, images long, points long, files int")
    assert recon.best_model(m).first()["path"] == "b"
    s = spark.createDataFrame([(20, 4, False), (5, 2, False), (20, 4, True)], "n int, r int, d boolean").select(recon.status(F.col("n"), F.col("r"), F.col("d")).alias("s"))
    assert [r["s"] for r in s.collect()] == ["partial", "process_failed", "success"]
    j = spark.createDataFrame([('{"views":[1,2,3,4],"poses":{"a":1,"b":2,"c":3}}',), ("{broken",), ('{"views":[],"poses":[]}',)], "body string")
    got = j.select(*[c.alias(n) for n, c in recon.sfm_counts(F.col("body")).items()]).collect()
    assert [tuple(r) for r in got] == [(3, 0.75), (None, None), (None, None)]
    assert recon.options_of("delaunay_mesher", ["--Mapper.x", "1", "--DelaunayMeshing.y", "2", "--delaunay_mesher.z"]) == ["--DelaunayMeshing.y", "2", "--z"]


def test_files(spark, tmp_path):
    import sqlite3

    (tmp_path / "0").mkdir()
    (tmp_path / "0" / "images.bin").write_bytes(struct.pack("<Q", 7) + b"x")
    (tmp_path / "0" / "points3D.txt").write_text("# c\n1 2\n3 4\n\n")
    (tmp_path / "m.ply").write_bytes(b"ply\nformat ascii 1.0\nelement vertex 3\nelement face 1\nend_header\n")
    (tmp_path / "v.MP4").write_bytes(b"abc")
    with sqlite3.connect(tmp_path / "d.db") as db:
        db.execute("create table matches(pair_id int, rows int)")
        db.execute("insert into matches values (1, 5), (2, 0)")
    db.close()
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    s = files.model_stats(raw).first()
    assert (s["images"], s["points"]) == (7, 2)
    p = files.ply_counts(raw.where("path like '%.ply'")).first()
    assert (p["n_vertices"], p["n_faces"], p["is_mesh"]) == (3, 1, True)
    assert files.database_matches(raw.where("path like '%.db'")).first()["matches"] == 1
    checked = {r["path"].rsplit("/", 1)[1]: r["error"] for r in files.check_videos(files.list_files(spark, str(tmp_path))).collect()}
    assert checked["v.MP4"] is None and checked["m.ply"] == "unsupported_format"


def test_pixels():
    g = np.zeros((8, 8), np.uint8)
    g[:, 4:] = 255
    assert images.sharpness(np.full((5, 5), 7, np.uint8)) == 0 and images.sharpness(g) > 0
    assert images.thumbnail(g, 2).tolist() == [[0, 255], [0, 255]]
    assert images.thumbnail(np.arange(9, dtype=np.uint8).reshape(3, 3), 3).tolist() == np.arange(9.0).reshape(3, 3).tolist()


def test_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(v, s, rng.integers(0, 3, 4).astype(float).tolist()) for v in (1, 2) for s in range(20)]
    t = spark.createDataFrame(rows, "video_id long, seq long, thumb array<double>")
    t.repartitionByRange(3, "seq").write.parquet(f"{tmp_path}/t")
    live = spark.readStream.schema(t.schema).parquet(f"{tmp_path}/t")
    out = streams.drain(streams.fold_redundant(live, 0.7, 2.0), "fold_test").select("video_id", "seq", "accepted")
    assert sorted(out.collect()) == sorted(frames.fold_redundant(t, 0.7, 2.0).select("video_id", "seq", "accepted").collect())


def test_config_and_stages(spark):
    c = config.from_mapping({"capture": {"min_contrast": 5, "unknown": 1}, "scaling": {"marker_size_mm": 10, "aruco": {"marker_size_mm": 20}}})
    assert c.capture.min_contrast == 5 and c.scaling.marker_size_mm == 20
    with pytest.raises(ValueError):
        config.Capture(selection_mode="x")
    assert config.marker_dictionary(" dict_4x4_50 ") == "DICT_4X4_50"
    s = Stages().register("double", lambda d, _: d.selectExpr("id * 2 as id")).register("broken", lambda d, _: d.select("nothing"))
    assert s.dry_run(spark.range(3)) == {"double": True, "broken": False}


def test_sinks(spark):
    s = spark.createDataFrame([(1, "a/X.jpg"), (1, "b/x.jpg"), (1, "c/y.jpg")], "video_id long, path string")
    assert [r["copy_name"] for r in sinks.copy_names(s).orderBy("path").collect()] == ["X.jpg", "00001_x.jpg", "y.jpg"]
    r = sinks.report(spark.createDataFrame([(1, 1.23456, None)], "k long, a double, b string"), "k", {"a": 2}).first()["body"]
    assert r == '{"k":1,"a":1.23,"b":null}'


def test_config_sections():
    c = config.from_mapping({"name": "n", "video": {"sample_interval": 2, "target_fps": 15}, "export": {"format": "ply"}, "scaling": {"reference": {"type": "manual", "size_mm": 20}, "measurement": {"tolerance": 0.1}}, "printability": {"target_bed_size_mm": [1, 2, 3]}, "mesh": None})
    assert (c.name, c.video.sample_interval, c.video.target_fps, c.export.format, c.scaling.strategy, c.scaling.marker_size_mm, c.scaling.tolerance) == ("n", 2, 15, "ply", "manual", 20.0, 0.1)
    assert c.printability.target_bed_size_mm == (1, 2, 3) and c.mesh.max_hole_size == 30 and len(config.MARKER_DICTIONARIES) == 17
    with pytest.warns(UserWarning, match="frame_interval"):
        config.from_mapping({"video": {"frame_interval": 2}})
    with pytest.raises(ValueError):
        config.from_mapping([1])


def test_hamming_matches(spark):
    from trivet.operators.matchgraph import knn_ratio

    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 256, (20, 8)), rng.integers(0, 256, (30, 8))
    b[:10] = a[:10] ^ (rng.random((10, 8)) < 0.2)
    rows = lambda d: spark.createDataFrame([(1, i, v.tolist()) for i, v in enumerate(d)], "pair long, id long, d array<int>")
    got = {(r["id"], r["match"]) for r in knn_ratio(rows(a), rows(b), 0.8, hamming=True).collect()}
    dist = np.array([[sum(int(x ^ y).bit_count() for x, y in zip(u, v, strict=True)) for v in b] for u in a])
    two = np.sort(dist, axis=1)[:, :2]
    assert got == {(i, int(dist[i].argmin())) for i in range(20) if two[i, 0] < 0.8 * two[i, 1]} and len(got) >= 10
