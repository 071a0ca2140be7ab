"""Reports, logs, markers and concatenation on small tables, empty ones included."""

import json

import pytest
from pyspark.sql import functions as F

from trivet.operators import mesh, recon, scaling
from trivet.sources import reports


def test_warnings_keep_what_is_there(spark):
    df = spark.createDataFrame([(["a", "a"], ["b", "a", "b"]), (None, ["x"]), (["x"], None)], "old array<string>, new array<string>")
    got = [r[0] for r in df.select(mesh.add_warnings(F.col("old"), F.col("new"))).collect()]
    assert got == [["a", "a", "b"], ["x"], ["x"]]


def test_dense_needs_a_gpu_build(spark):
    df = spark.createDataFrame([("Without CUDA",), ("without GPU support",), ("with cuda",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(recon.can_run_dense(F.col("t"))).collect()] == [False, False, True, True, False]


def test_log_tail(spark):
    rows = [("a", i, f"l{i}") for i in range(7)] + [("b", 0, "x")]
    df = spark.createDataFrame(rows, "job_id string, line_no long, line string")
    got = {r.job_id: (r.n_lines, r.tail) for r in recon.log_tail(df, 2).collect()}
    assert got == {"a": (7, "l5\nl6"), "b": (1, "x")}
    assert recon.log_tail(df.limit(0)).count() == 0


def test_observations_of_one_dictionary(spark):
    df = spark.createDataFrame([(1, "DICT_4X4_50", None), (2, "DICT_5X5_50", None)], "marker_id int, dictionary string, corners array<struct<x:double,y:double>>")
    assert [(r.marker_id, r.edge_lengths_2d) for r in scaling.observations(df).collect()] == [(1, None)]
    assert scaling.observations(df, 7).count() == 0
    with pytest.raises(ValueError):
        scaling.observations(df, dictionary="DICT_9X9")


def test_concatenated_ids_do_not_meet(spark):
    f = spark.createDataFrame([(0, 1, 0, 0, 1, 2), (0, 2, 1, 0, 1, 2)], "mesh_id long, part long, fid long, v0 long, v1 long, v2 long")
    v = spark.createDataFrame([(0, p, i, 0.0, 0.0, 0.0) for p in (1, 2) for i in range(3)], "mesh_id long, part long, vid long, x double, y double, z double")
    faces, vertices = mesh.concatenate(f, v, "part")
    assert sorted((r.v0, r.v1, r.v2) for r in faces.collect()) == [(0, 1, 2), (3, 4, 5)]
    assert sorted(r.vid for r in vertices.collect()) == list(range(6))
    assert mesh.concatenate(f.limit(0), v.limit(0), "part")[0].count() == 0


def test_reports_keep_fields_and_their_order(spark):
    job = spark.createDataFrame([("r", None, 0, "w")], "run_id string, mesh_path string, mesh_bytes long, workspace_path string")
    body = json.loads(reports.reconstruction_report(job).first().body)
    assert tuple(body) == reports.RECONSTRUCTION
    assert body["mesh_generated"] is False and body["point_count"] is None and body["workspace_dir"] == "w"
    runs = spark.createDataFrame([(1, ("s",)), (2, ("t",))], "video_id long, summary struct<a:string>")
    frames = spark.createDataFrame([(1, 1, "b", False), (1, 0, "a", True)], "video_id long, seq long, filename string, is_accepted boolean")
    got = {r.video_id: json.loads(r.body) for r in reports.capture_report(runs, frames).collect()}
    assert tuple(got[1]) == reports.CAPTURE and got[1]["summary"] == got[1]["metadata"] == {"a": "s"}
    assert got[1]["selected_frames"] == ["a"] and got[1]["rejected_frames"] == ["b"] and [f["filename"] for f in got[1]["frame_results"]] == ["a", "b"]
    assert got[2]["frame_results"] == [] and got[2]["selected_frames"] == []
    parts = spark.createDataFrame([(1, 0.12345678)], "mesh_id long, scale_factor double")
    assert json.loads(reports.scaling_report(parts).first().body)["scale_factor"] == 0.123457
    assert tuple(json.loads(reports.geometry_report(parts).first().body)) == reports.GEOMETRY
