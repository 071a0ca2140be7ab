"""Analytic fixtures: cube, holes, duplicates, orphans, bad vertices, components."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trivet.config import Mesh
from trivet.operators import clean, graph, mesh, printable, repair
from trivet.plans.mesh_pipeline import process_meshes
from trivet.sources import meshfiles

CORNERS = [(x, y, z) for x in (-1.0, 1.0) for y in (-1.0, 1.0) for z in (-1.0, 1.0)]
CUBE = [(0, 1, 3), (0, 3, 2), (4, 6, 7), (4, 7, 5), (0, 4, 5), (0, 5, 1), (2, 3, 7), (2, 7, 6), (0, 2, 6), (0, 6, 4), (1, 5, 7), (1, 7, 3)]


def tables(spark, meshes):
    faces = [(k, i, *map(int, f)) for k, (v, fs) in meshes.items() for i, f in enumerate(fs)]
    verts = [(k, i, *map(float, p)) for k, (v, fs) in meshes.items() for i, p in enumerate(v)]
    return (
        spark.createDataFrame(faces, "mesh_id long, fid long, v0 long, v1 long, v2 long"),
        spark.createDataFrame(verts, "mesh_id long, vid long, x double, y double, z double"),
    )


@pytest.fixture(scope="module")
def meshes(spark):
    tetra_v = [(5, 0, 0), (6, 0, 0), (5, 1, 0), (5, 0, 1)]
    tetra_f = [(8, 10, 9), (8, 9, 11), (8, 11, 10), (9, 10, 11)]
    return {
        1: (CORNERS, CUBE),
        2: (CORNERS, CUBE[:-1]),  # a hole of three edges
        3: ([*CORNERS, (9, 9, 9), (8, 8, 8)], [*CUBE, (1, 0, 3)]),  # a duplicate and two orphans
        4: ([*CORNERS, *tetra_v], [*CUBE, *tetra_f]),  # two components
        5: ([*CORNERS, (0, 0, float("nan"))], [*CUBE, (0, 1, 8)]),
        6: (CORNERS, [*CUBE, (0, 1, 99)]),
    }


def test_diagnose(spark, meshes):
    f, v = tables(spark, meshes)
    d = {r["mesh_id"]: r for r in mesh.diagnose(f, v, loops=repair.boundary_loops(f)).collect()}
    cube = d[1]
    assert (cube["status"], cube["is_watertight"], cube["component_count"], cube["euler_characteristic"], cube["boundary_edge_count"]) == ("VALID", True, 1, 2, 0)
    assert cube["surface_area"] == pytest.approx(24) and cube["volume"] == pytest.approx(8) and cube["extent_x"] == 2
    assert (d[2]["boundary_edge_count"], d[2]["boundary_loop_count"], d[2]["status"]) == (3, 1, "WARNING")
    assert (d[3]["duplicate_faces"], d[3]["unreferenced_vertices"], d[3]["non_manifold_edge_count"]) == (1, 2, 3)
    assert d[4]["component_count"] == 2
    assert (d[5]["nan_vertices"], d[5]["component_count"], d[5]["surface_area"], d[5]["status"]) == (1, 1, None, "ERROR")
    assert (d[6]["invalid_faces"], d[6]["boundary_edge_count"], d[6]["status"]) == (1, 0, "ERROR")


def test_clean(spark, meshes):
    f, v = tables(spark, meshes)
    _, v2, c = clean.clean(f, v)
    c = {r["mesh_id"]: r for r in c.collect()}
    assert (c[3]["faces_after"], c[3]["vertices_after"], c[3]["duplicates_removed"], c[3]["orphans_removed"]) == (12, 8, 1, 2)
    assert (c[5]["bad_vertices"], c[5]["faces_on_bad_vertices"], c[5]["faces_after"]) == (1, 1, 12)
    assert (c[6]["invalid_removed"], c[6]["faces_after"]) == (1, 12)
    assert v2.where("mesh_id = 3").agg(F.max("vid")).first()[0] == 7


def test_components(spark, meshes):
    f, v = tables(spark, {4: meshes[4], 1: meshes[1]})
    for strategy, kept in (("largest", [True, False]), ("keep_all", [True, True]), ("min_faces", [True, False]), ("relative_threshold", [True, True]), ("odd", [True, False])):
        k = clean.keep_components(clean.component_stats(f, v), strategy, 100, 0.05).where("mesh_id = 4").orderBy("component")
        assert [r["is_kept"] for r in k.collect()] == kept
    out, counts = clean.filter_components(f, v)
    assert {r["mesh_id"]: r["faces_after"] for r in counts.collect()} == {4: 12, 1: 12}


def test_repair_and_winding(spark, meshes):
    big = [(np.cos(a), np.sin(a), 0.0) for a in np.linspace(0, 2 * np.pi, 32, endpoint=False)] + [(0, 0, 1.0)]
    f, v = tables(spark, {2: meshes[2], 7: (big, [(i, (i + 1) % 32, 32) for i in range(32)])})
    out, c = repair.repair(f, v, max_edges=20)
    c = {r["mesh_id"]: r for r in c.collect()}
    assert (c[2]["loops_before"], c[2]["successful"], c[2]["edges_after"]) == (1, 1, 0)
    assert (c[7]["attempted"], c[7]["loops_after"], c[7]["edges_after"]) == (0, 1, 32)
    closed = repair.repair(f, v, max_edges=40)[1].where("mesh_id = 7").first()
    assert closed["faces_added"] == 30 and closed["edges_after"] == 0
    mixed = f.where("mesh_id = 7").unionByName(spark.createDataFrame([(1, i, *(x if i % 3 else x[::-1])) for i, x in enumerate(CUBE)], f.schema))
    vv = v.unionByName(tables(spark, {1: meshes[1]})[1])
    turned = repair.unify_winding(mixed, vv)
    assert mesh.consistent_winding(turned).where("not consistent").count() == 0
    assert mesh.area_volume(turned, vv).where("mesh_id = 1").first()["volume"] == pytest.approx(8)


def _turned(verts, faces):
    """Faces turned alike by a walk in plain Python, for meshes whose components can be turned."""
    owners = {}
    for k, f in enumerate(faces):
        for u, v in zip(f, f[1:] + f[:1], strict=True):
            owners.setdefault((min(u, v), max(u, v)), []).append((k, u < v))
    flip = {}
    for root in range(len(faces)):
        if root in flip:
            continue
        flip[root], part = False, [root]
        for f in part:
            for (a, x), (b, y) in (o for o in owners.values() if len(o) == 2):
                for here, there in ((a, b), (b, a)):
                    if here == f and there not in flip:
                        flip[there] = flip[f] ^ (x == y)
                        part.append(there)
        p = np.array(verts, float)
        vol = sum(np.linalg.det(p[list(faces[f])]) * (-1 if flip[f] else 1) for f in part)
        if vol < -1e-9:
            flip.update({f: not flip[f] for f in part})
    return [(f[0], f[2], f[1]) if flip[k] else tuple(f) for k, f in enumerate(faces)]


@pytest.mark.parametrize("local", [200_000, 0])
def test_winding_equals_walk(spark, meshes, monkeypatch, local):
    """Mixed senses, several components, open and isolated faces, also where components are solved in rounds."""
    monkeypatch.setattr(repair, "components", lambda e, k: graph.components(e, k, local_edges=local))
    rng = np.random.default_rng(5)
    mixed = {}
    for k in (1, 2, 4):
        v, fs = meshes[k]
        mixed[k] = (v, [f if rng.random() < 0.5 else f[::-1] for f in map(tuple, fs)])
    mixed[8] = ([(0, 0, 1.0), (1, 0, 1), (0, 1, 1)], [(0, 2, 1)])
    mixed[9] = ([(np.cos(a), np.sin(a), 0.3 * np.sin(2 * a)) for a in range(5)], [(i, (i + 1) % 5, (i + 2) % 5) for i in range(5)])  # one-sided
    f, v = tables(spark, mixed)
    got = {}
    for r in repair.unify_winding(f, v).orderBy("mesh_id", "fid").collect():
        got.setdefault(r["mesh_id"], []).append((r["v0"], r["v1"], r["v2"]))
    for k in (1, 2, 4, 8):
        assert got[k] == _turned(*mixed[k])
    assert [sorted(t) for t in got[9]] == [sorted(t) for t in mixed[9][1]]
    senses = repair.face_senses(f.where("mesh_id = 9"))
    assert senses.select("component").distinct().count() == 1 and senses.where("fid = 0").first()["flip"] is False
    assert repair.unify_winding(f.limit(0), v).count() == 0


def test_printable(spark, meshes):
    f, v = tables(spark, {1: (np.array(CORNERS) * 5, CUBE), 2: (np.array(CORNERS) * 5, CUBE[:-1])})
    r = {x["mesh_id"]: x for x in printable.report(f, v).collect()}
    assert r[1]["is_printable"] and r[1]["min_wall_thickness_mm"] == pytest.approx(10, abs=1e-3) and r[1]["overhang_face_count"] == 2
    assert not r[2]["is_printable"] and r[2]["min_wall_thickness_mm"] is None
    with pytest.raises(ValueError):
        printable.overhang_faces(f, v, 91)


def test_process_keeps_coordinates(spark, meshes):
    v0 = [(x + 100, y + 200, z + 300) for x, y, z in CORNERS]
    p = process_meshes(*tables(spark, {1: (v0, CUBE[:-1]), 4: meshes[4]}), Mesh())
    after = {r["mesh_id"]: r for r in p.after.collect()}
    assert after[1]["status"] == "VALID" and after[1]["min_x"] == 99 and after[1]["n_faces"] == 12
    assert after[4]["n_faces"] == 12


def test_graph_local_equals_distributed(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(a), int(b)) for k, a, b in zip(rng.integers(0, 4, 300), rng.integers(0, 120, 300), rng.integers(0, 120, 300), strict=True)]
    e = spark.createDataFrame(rows, "k long, a long, b long")
    assert sorted(graph.components(e, "k").collect()) == sorted(graph.components(e, "k", local_edges=0).collect())
    assert graph.components(e.limit(0), "k").count() == 0


@pytest.mark.parametrize("kind,binary", [("obj", True), ("ply", True), ("stl", True), ("stl", False)])
def test_files_round_trip(spark, meshes, tmp_path, kind, binary):
    f, v = tables(spark, {1: meshes[1], 4: meshes[4]})
    written = meshfiles.write_meshes(f, v, f"file://{tmp_path}/m", kind, binary)
    assert sorted(r["n_faces"] for r in written.collect()) == [12, 16]
    f2, v2 = meshfiles.read_meshes(spark, f"{tmp_path}/m")
    areas = sorted(r["area"] for r in mesh.area_volume(f2, v2).collect())
    assert areas == pytest.approx(sorted(r["area"] for r in mesh.area_volume(f, v).collect()), rel=1e-5)
