"""Engines on this machine, tables of commands, and folders of mesh files."""

import os

import numpy as np
import pytest

from trivet import errors
from trivet.config import marker_dictionary
from trivet.operators import mesh
from trivet.plans import mesh_files
from trivet.sources import engines, meshfiles

from test_mesh import CORNERS, CUBE


def program(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(f"#!/bin/sh\n{text}\n")
    path.chmod(0o755)
    return path


def test_engine_is_found_in_order(tmp_path, monkeypatch):
    monkeypatch.setenv("PATH", str(tmp_path / "path") + os.pathsep + os.environ["PATH"])
    e = engines.get_engine("COLMAP")
    assert e.find() is None and e.find(tmp_path / "none") is None
    with pytest.raises(errors.ReconstructionBinaryNotFoundError):
        e.require()
    on_path = program(tmp_path / "path" / "colmap", "echo")
    low = program(tmp_path / "install" / "bin" / "colmap", "echo")
    assert e.find() == on_path and e.find(tmp_path / "install") == low
    top = program(tmp_path / "install" / "colmap.bat", "echo")
    assert e.find(tmp_path / "install") == top and e.find(low) == low and engines.get_engine("colmap", str(low)).find() == low
    with pytest.raises(ValueError):
        engines.get_engine("other")


def test_command(tmp_path):
    p = program(tmp_path / "meshroom_batch", "echo")
    got = engines.get_engine().command("/in", "/out", "/tmp/c", ("--save", "x"), {"scale": 2, "--force": True}, str(tmp_path))
    assert got == [str(p), "--input", "/in", "--output", "/out", "--cache", "/tmp/c", "--save", "x", "--scale", "2", "--force", "True"]
    assert engines.get_engine().command("/in", "/out", path=str(p)) == [str(p), "--input", "/in", "--output", "/out"]


def test_gpu_build(tmp_path):
    assert not engines.has_gpu(program(tmp_path / "a", "echo 3.9 Without CUDA"))
    assert engines.has_gpu(program(tmp_path / "b", "echo 3.9 with CUDA"))
    assert not engines.has_gpu(program(tmp_path / "c", '[ "$1" = help ] && echo without GPU support'))
    assert not engines.has_gpu(program(tmp_path / "d", "sleep 9"), 0.2) and not engines.has_gpu(tmp_path / "none")


def test_commands_run_as_a_table(spark):
    rows = [
        ("good", ["sh", "-c", "echo a; echo b; echo c"], 20.0), ("bad", ["sh", "-c", "echo no >&2; exit 3"], None), ("late", ["sh", "-c", "sleep 30"], 0.3),
        ("none", ["/no/such/program"], 1.0), ("null", None, 1.0), ("fatal", ["sh", "-c", "echo CUDA error"], 5.0),
    ]
    jobs = spark.createDataFrame(rows, "job_id string, command array<string>, timeout_seconds double")
    got = {r.job_id: r for r in engines.run_commands(jobs, 2).collect()}
    assert {k: r.status for k, r in got.items()} == {"good": "ok", "bad": "failed", "late": "timeout", "none": "not_found", "null": "not_found", "fatal": "failed"}
    assert (got["good"].n_lines, got["good"].tail, got["bad"].exit_code, got["bad"].tail) == (3, "b\nc", 3, "no")
    assert engines.run_commands(jobs.limit(0)).count() == 0


def test_errors_are_told_apart():
    assert issubclass(errors.ReconstructionInvalidInputError, FileNotFoundError) and issubclass(errors.ReconstructionTimeoutError, errors.ReconstructionExecutionError)
    with pytest.raises(errors.ScalingConfigError):
        marker_dictionary("DICT_9")
    with pytest.raises(errors.MeshFormatError):
        meshfiles.write_meshes(None, None, "", "xyz")


@pytest.fixture
def folder(tmp_path):
    small = [(8, 9, 10), (8, 10, 11), (8, 11, 9), (9, 11, 10)]
    tetra = [(5.0, 0, 0), (6, 0, 0), (5, 1, 0), (5, 0, 1)]
    some = {
        "a/hole.obj": (CORNERS, [f[::-1] for f in CUBE[:-1]]), "a/two.obj": ([*CORNERS, *tetra, (7, 7, 7)], [*CUBE, *small]),
        "b/HOLE.obj": ([*CORNERS, (9, 9, 9)], [*CUBE, (0, 0, 1)]), "b/points.obj": (CORNERS, []),
    }
    for name, (v, f) in some.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(meshfiles.format_mesh("obj", np.array(v, float), np.array(f, int).reshape(-1, 3)))
    (tmp_path / "in" / "empty.stl").write_bytes(b"solid x\nendsolid x\n")
    (tmp_path / "in" / "note.txt").write_text("x")
    return tmp_path


def run(spark, folder, fn, *args):
    out = fn(spark, str(folder / "in"), f"file://{folder}/{fn.__name__}", *args).collect()
    found = {}
    for r in out:
        read = meshfiles.parse_obj(open(r["output"], "rb").read()) if r["status"] == "ok" else (None, None)
        found[r["path"].split("/in/")[1]] = (r["status"], r["error"], *read)
    assert len({r["output"] for r in out if r["output"]}) == 3 and any(r["output"] and r["output"].endswith("/two_cleaned.obj") for r in out)
    return found


def test_folders_of_files(spark, folder):
    got = run(spark, folder, mesh_files.fill_holes)
    assert sorted(got) == ["a/hole.obj", "a/two.obj", "b/HOLE.obj", "b/points.obj", "empty.stl"]
    assert len(got["a/hole.obj"][3]) == 12 and got["b/points.obj"][:2] == ("invalid", "Mesh contains insufficient geometry: 8 vertices, 0 faces.")
    assert got["empty.stl"][:2] == ("invalid", "Mesh contains insufficient geometry: 0 vertices, 0 faces.")
    p = np.array(CORNERS)
    assert sum(np.linalg.det(p[list(t)]) for t in got["a/hole.obj"][3]) / 6 == pytest.approx(8)
    got = run(spark, folder, mesh_files.remove_isolated_components, 5)
    assert [len(x) for x in got["a/two.obj"][2:]] == [9, 12]
    got = run(spark, folder, mesh_files.remove_unreferenced_vertices)
    assert [len(x) for x in got["b/HOLE.obj"][2:]] == [8, 12] and [len(x) for x in got["a/two.obj"][2:]] == [12, 16]
    assert len(run(spark, folder, mesh_files.unify_normals)["a/hole.obj"][3]) == 11


def test_usable(spark):
    f = spark.createDataFrame([(1, 0, 0, 1, 2)], "mesh_id long, fid long, v0 long, v1 long, v2 long")
    v = spark.createDataFrame([(1, i, 0.0, 0.0, 0.0) for i in range(3)] + [(2, 0, 0.0, 0.0, 0.0)], "mesh_id long, vid long, x double, y double, z double")
    assert {r["mesh_id"]: r["usable"] for r in mesh.usable(f, v).collect()} == {1: True, 2: False}
    assert mesh.usable(f.limit(0), v.limit(0)).count() == 0
