"""Mesh queries over the relations M1 (one mesh) and M2 (a mesh an order)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivet.operators import clean, mesh, printable, repair
from trivet.plans.mesh_pipeline import process_meshes
from trivet.plans.relations import MESH, many_meshes, one_mesh
from trivet.storage import cut

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


_STATS = """
SELECT mesh_id, count(*) AS n_edges, count(*) FILTER (WHERE c = 1) AS boundary_edges,
       CAST(coalesce(sum(c) FILTER (WHERE c > 2), 0) // 3 AS BIGINT) AS non_manifold_edges,
       min(c) = 2 AND max(c) = 2 AS closed, max(c) <= 2 AS edge_manifold
FROM ec GROUP BY mesh_id"""


@query(f"WITH {MESH} {_STATS}")
def mesh_edge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.edge_stats(many_meshes(spark, sf_dir)[0])


@query(f"""WITH {MESH}, d1 AS (SELECT mesh_id, unnest([v0, v1, v2]) AS u, unnest([v1, v2, v0]) AS v FROM m1),
ec1 AS (SELECT mesh_id, least(u, v) AS lo, greatest(u, v) AS hi, count(*) AS c FROM d1 GROUP BY 1, 2, 3) {_STATS.replace('FROM ec', 'FROM ec1')}""")
def mesh_edge_stats_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.edge_stats(one_mesh(spark, sf_dir)[0])


@query(f"WITH {MESH} SELECT mesh_id, max(c) <= 2 AS edge_manifold FROM ec GROUP BY mesh_id")
def mesh_edge_manifold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.edge_stats(many_meshes(spark, sf_dir)[0]).select("mesh_id", "edge_manifold")


@query(f"""WITH {MESH} SELECT mesh_id, count(*) AS n_faces, count(*) - count(DISTINCT list_sort([v0, v1, v2])) AS duplicates FROM m1 GROUP BY mesh_id""")
def mesh_duplicate_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.duplicate_faces(one_mesh(spark, sf_dir)[0])


@query(f"""WITH {MESH} SELECT mesh_id, fid, v0, v1, v2 FROM (SELECT *, row_number() OVER (PARTITION BY mesh_id, list_sort([v0, v1, v2]) ORDER BY fid) AS r FROM m1) WHERE r = 1""")
def mesh_first_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.first_faces(one_mesh(spark, sf_dir)[0]).select("mesh_id", "fid", "v0", "v1", "v2")


@query(f"""WITH {MESH} SELECT mesh_id, fid FROM m1 WHERE v0 = v1 OR v1 = v2 OR v0 = v2
  OR v0 NOT IN (SELECT vid FROM pv) OR v1 NOT IN (SELECT vid FROM pv) OR v2 NOT IN (SELECT vid FROM pv)""")
def mesh_invalid_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.invalid_faces(*one_mesh(spark, sf_dir))


@query(f"WITH {MESH} SELECT CAST(0 AS BIGINT) AS mesh_id, fid FROM n2 WHERE nx*nx + ny*ny + nz*nz <= 10000")
def mesh_degenerate_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.corner_points(*one_mesh(spark, sf_dir)).where(mesh.degenerate(50.0)).select("mesh_id", "fid")


@query(f"""WITH {MESH}, v AS (SELECT mesh_id, vid FROM pv UNION ALL SELECT mesh_id, vid + 1000000000 FROM pv)
SELECT mesh_id, vid FROM v WHERE vid NOT IN (SELECT unnest([v0, v1, v2]) FROM m1)""")
def mesh_orphan_vertices_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All faces of the one mesh; a shifted copy of each vertex, which no face names, is there too."""
    faces, vertices = one_mesh(spark, sf_dir)
    copies = vertices.withColumn("vid", F.col("vid") + 1_000_000_000)
    return mesh.orphan_vertices(faces, vertices.unionByName(copies)).select("mesh_id", "vid")


@query(f"""WITH {MESH}, r AS (SELECT mesh_id, vid, row_number() OVER (PARTITION BY mesh_id ORDER BY vid) - 1 AS n FROM v2m)
SELECT f.mesh_id, f.fid, a.n AS v0, b.n AS v1, c.n AS v2 FROM m2 f JOIN r a ON f.mesh_id = a.mesh_id AND f.v0 = a.vid
JOIN r b ON f.mesh_id = b.mesh_id AND f.v1 = b.vid JOIN r c ON f.mesh_id = c.mesh_id AND f.v2 = c.vid""")
def mesh_dense_reindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.dense_reindex(*many_meshes(spark, sf_dir))[0]


@query(f"""WITH {MESH} SELECT mesh_id, count(*) AS n_vertices, CAST(0 AS BIGINT) AS nan_vertices, CAST(0 AS BIGINT) AS inf_vertices, min(x) AS min_x, min(y) AS min_y, min(z) AS min_z,
max(x) AS max_x, max(y) AS max_y, max(z) AS max_z, max(x) - min(x) AS extent_x, max(y) - min(y) AS extent_y, max(z) - min(z) AS extent_z FROM v2m GROUP BY mesh_id""")
def mesh_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.vertex_stats(many_meshes(spark, sf_dir)[1])


@query(f"""WITH {MESH} SELECT mesh_id, round(sum(sqrt(nx*nx + ny*ny + nz*nz) / 2), 3) AS area,
round(sum((x0*(y1*z2-z1*y2) + y0*(z1*x2-x1*z2) + z0*(x1*y2-y1*x2)) / 6), 3) + 0 AS volume FROM n2 GROUP BY mesh_id""")
def mesh_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = mesh.area_volume(*many_meshes(spark, sf_dir))
    return a.select("mesh_id", F.round("area", 3).alias("area"), (F.round("volume", 3) + 0).alias("volume"))


@query(f"""WITH {MESH}, r AS (SELECT vid, row_number() OVER (ORDER BY vid) - 1 AS n FROM pv)
SELECT f.mesh_id, f.fid, a.n AS v0, b.n AS v1, c.n AS v2 FROM m1 f JOIN r a ON f.v0 = a.vid JOIN r b ON f.v1 = b.vid JOIN r c ON f.v2 = c.vid""")
def mesh_dense_reindex_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.dense_reindex(*one_mesh(spark, sf_dir))[0]


@query(f"""WITH {MESH} SELECT mesh_id, count(*) AS n_vertices, CAST(0 AS BIGINT) AS nan_vertices, CAST(0 AS BIGINT) AS inf_vertices, min(x) AS min_x, min(y) AS min_y, min(z) AS min_z,
max(x) AS max_x, max(y) AS max_y, max(z) AS max_z, max(x) - min(x) AS extent_x, max(y) - min(y) AS extent_y, max(z) - min(z) AS extent_z FROM pv GROUP BY mesh_id""")
def mesh_bbox_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.vertex_stats(one_mesh(spark, sf_dir)[1])


@query(f"""WITH {MESH} SELECT CAST(0 AS BIGINT) AS mesh_id, round(sum(sqrt(nx*nx + ny*ny + nz*nz) / 2), 2) AS area,
round(sum((x0*(y1*z2-z1*y2) + y0*(z1*x2-x1*z2) + z0*(x1*y2-y1*x2)) / 6), 0) + 0 AS volume FROM n2""")
def mesh_area_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = mesh.area_volume(*one_mesh(spark, sf_dir))
    return a.select("mesh_id", F.round("area", 2).alias("area"), (F.round("volume", 0) + 0).alias("volume"))


@query(f"""WITH {MESH}, v AS (SELECT mesh_id, count(*) AS v FROM v2m GROUP BY 1), e AS (SELECT mesh_id, count(*) AS e FROM ec GROUP BY 1), f AS (SELECT mesh_id, count(*) AS f FROM m2 GROUP BY 1)
SELECT v.mesh_id, v - e + f AS euler FROM v JOIN e ON v.mesh_id = e.mesh_id JOIN f ON v.mesh_id = f.mesh_id""")
def mesh_euler(spark: SparkSession, sf_dir: str) -> DataFrame:
    faces, vertices = many_meshes(spark, sf_dir)
    n = lambda df, c: df.groupBy("mesh_id").agg(F.count("*").alias(c))
    both = n(vertices, "v").join(mesh.edge_stats(faces).select("mesh_id", "n_edges"), "mesh_id").join(n(faces, "f"), "mesh_id")
    return both.select("mesh_id", F.expr("v - n_edges + f").alias("euler"))


@query(f"""WITH {MESH}, w AS (SELECT mesh_id, max(c) = 1 AS consistent FROM (SELECT mesh_id, u, v, count(*) AS c FROM de GROUP BY 1, 2, 3) GROUP BY 1)
SELECT e.mesh_id, closed, consistent FROM (SELECT mesh_id, min(c) = 2 AND max(c) = 2 AS closed FROM ec GROUP BY 1) e JOIN w ON e.mesh_id = w.mesh_id""")
def mesh_watertight(spark: SparkSession, sf_dir: str) -> DataFrame:
    faces = many_meshes(spark, sf_dir)[0]
    return mesh.edge_stats(faces).select("mesh_id", "closed").join(mesh.consistent_winding(faces), "mesh_id")


@query(f"WITH {MESH} SELECT mesh_id, a, b FROM adj")
def mesh_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.adjacency(many_meshes(spark, sf_dir)[0])


# Components of M2: at most a dozen faces a mesh, so plain reachability is small.
COMP = """
both_ways AS (SELECT mesh_id, a, b FROM adj UNION SELECT mesh_id, b, a FROM adj),
reach(mesh_id, fid, r) AS (SELECT mesh_id, a, a FROM both_ways UNION SELECT reach.mesh_id, reach.fid, w.b FROM reach JOIN both_ways w ON reach.mesh_id = w.mesh_id AND reach.r = w.a),
comp AS (SELECT mesh_id, fid, min(r) AS component FROM reach GROUP BY 1, 2)"""
MESHR = f"WITH RECURSIVE {MESH}, {COMP}"


@query(f"{MESHR} SELECT mesh_id, fid, component FROM comp")
def mesh_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.face_components(many_meshes(spark, sf_dir)[0])


@query(f"""{MESHR}, n AS (SELECT mesh_id, count(DISTINCT component) AS n FROM comp GROUP BY 1), f AS (SELECT mesh_id, count(*) AS f FROM m2 GROUP BY 1)
SELECT f.mesh_id, coalesce(n, f) AS component_count FROM f LEFT JOIN n ON f.mesh_id = n.mesh_id""")
def mesh_component_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.component_counts(many_meshes(spark, sf_dir)[0])


PARTS = f"""{MESHR},
pa AS (SELECT n2.mesh_id, component, count(*) AS n_faces, sum(sqrt(nx*nx + ny*ny + nz*nz) / 2) AS area FROM n2 JOIN comp ON n2.mesh_id = comp.mesh_id AND n2.fid = comp.fid GROUP BY 1, 2),
pu AS (SELECT DISTINCT f.mesh_id, component, unnest([v0, v1, v2]) AS vid FROM m2 f JOIN comp ON f.mesh_id = comp.mesh_id AND f.fid = comp.fid),
pn AS (SELECT mesh_id, component, count(*) AS n_vertices FROM pu GROUP BY 1, 2),
ps AS (SELECT pa.*, n_vertices, row_number() OVER (PARTITION BY pa.mesh_id ORDER BY pa.component) - 1 AS idx, max(n_faces) OVER (PARTITION BY pa.mesh_id) AS most,
       max(area) OVER (PARTITION BY pa.mesh_id) AS widest, count(*) OVER (PARTITION BY pa.mesh_id) AS many FROM pa JOIN pn ON pa.mesh_id = pn.mesh_id AND pa.component = pn.component)"""


@query(f"{PARTS} SELECT mesh_id, component, n_faces, n_vertices, round(area, 3) AS area, CAST(idx AS BIGINT) AS idx FROM ps")
def mesh_component_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = clean.component_stats(*many_meshes(spark, sf_dir))
    return s.select("mesh_id", "component", "n_faces", "n_vertices", F.round("area", 3).alias("area"), F.col("idx").cast("long"))


_RULES = {
    "keep_all": "true", "largest": "n_faces = most", "largest_by_area": "abs(area - widest) < 0.000001", "min_faces": "n_faces >= 4", "relative_threshold": "n_faces >= most * 0.6",
}


def _strategy(name: str, rule: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = clean.keep_components(clean.component_stats(*many_meshes(spark, sf_dir)), name, 4, 0.6)
        return s.select("mesh_id", "component", "is_kept")

    QUERIES[f"mesh_component_filter_{name}"] = run
    ORACLES[f"mesh_component_filter_{name}"] = f"""{PARTS}, k AS (SELECT *, ({rule}) OR many = 1 AS k0 FROM ps)
SELECT mesh_id, component, k0 OR (NOT bool_or(k0) OVER (PARTITION BY mesh_id) AND row_number() OVER (PARTITION BY mesh_id ORDER BY n_faces DESC, component) = 1) AS is_kept FROM k"""


for _n, _r in _RULES.items():
    _strategy(_n, _r)


@query(f"""{PARTS}, k AS (SELECT mesh_id, component, n_faces, n_faces = most AS k0, many FROM ps),
g AS (SELECT mesh_id, any_value(many) AS many, count(*) FILTER (WHERE k0) AS kept, sum(n_faces) FILTER (WHERE k0) AS kf FROM k GROUP BY 1),
f AS (SELECT mesh_id, count(*) AS f FROM m2 GROUP BY 1)
SELECT f.mesh_id, coalesce(many, 1) AS components_before, CASE WHEN many > 1 THEN kept ELSE 1 END AS components_after, f AS faces_before,
       CAST(CASE WHEN many > 1 THEN kf ELSE f END AS BIGINT) AS faces_after, CAST(CASE WHEN many > 1 THEN f - kf ELSE 0 END AS BIGINT) AS removed_faces
FROM f LEFT JOIN g ON f.mesh_id = g.mesh_id""")
def mesh_component_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.filter_components(*many_meshes(spark, sf_dir))[1]


FANS = """
rp AS (SELECT mesh_id, NOT bool_or(v0 = v1 OR v1 = v2 OR v0 = v2) AS plain FROM m2 GROUP BY 1),
th AS (SELECT mesh_id, max(c) <= 2 AS thin FROM ec GROUP BY 1),
lk AS (SELECT DISTINCT mesh_id, unnest([v0, v1, v2]) AS hub, least(unnest([v1, v2, v0]), unnest([v2, v0, v1])) AS a, greatest(unnest([v1, v2, v0]), unnest([v2, v0, v1])) AS b
       FROM m2 WHERE NOT (v0 = v1 OR v1 = v2 OR v0 = v2)),
lb AS (SELECT mesh_id, hub, a, b FROM lk UNION SELECT mesh_id, hub, b, a FROM lk),
lr(mesh_id, hub, n, r) AS (SELECT DISTINCT mesh_id, hub, a, a FROM lb UNION SELECT lr.mesh_id, lr.hub, lr.n, lb.b FROM lr JOIN lb ON lr.mesh_id = lb.mesh_id AND lr.hub = lb.hub AND lr.r = lb.a),
lc AS (SELECT mesh_id, hub, count(DISTINCT m) AS pieces FROM (SELECT mesh_id, hub, n, min(r) AS m FROM lr GROUP BY 1, 2, 3) GROUP BY 1, 2),
ld AS (SELECT mesh_id, hub, max(d) AS most, count(*) FILTER (WHERE d = 1) AS ends FROM (SELECT mesh_id, hub, a, count(*) AS d FROM lb GROUP BY 1, 2, 3) GROUP BY 1, 2),
ok AS (SELECT lc.mesh_id, bool_and(pieces = 1 AND most <= 2 AND ends IN (0, 2)) AS fans FROM lc JOIN ld ON lc.mesh_id = ld.mesh_id AND lc.hub = ld.hub GROUP BY 1),
vm AS (SELECT rp.mesh_id, plain AND thin AND coalesce(fans, false) AS vertex_manifold FROM rp JOIN th ON rp.mesh_id = th.mesh_id LEFT JOIN ok ON rp.mesh_id = ok.mesh_id)"""


@query(f"{MESHR}, {FANS} SELECT mesh_id, vertex_manifold FROM vm")
def mesh_vertex_manifold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.vertex_manifold(many_meshes(spark, sf_dir)[0])


# Walks over boundary edges, one step a row: `todo` is what is not walked yet, in the order of corners and faces.
LOOPS = """
dc AS (SELECT mesh_id, fid, unnest([0, 1, 2]) AS corner, unnest([v0, v1, v2]) AS u, unnest([v1, v2, v0]) AS v FROM m2),
b1 AS (SELECT mesh_id, min(fid) AS fid, min(corner) AS corner, min(u) AS u, min(v) AS v FROM dc GROUP BY mesh_id, least(u, v), greatest(u, v) HAVING count(*) = 1),
walk(mesh_id, todo, first, here, n, loops) AS (
  SELECT mesh_id, list({'u': u, 'v': v} ORDER BY corner, fid), NULL::BIGINT, NULL::BIGINT, 0, 0 FROM b1 GROUP BY 1
  UNION ALL
  SELECT mesh_id, CASE WHEN k > 0 THEN todo[:k - 1] || todo[k + 1:] ELSE todo END, CASE WHEN here IS NULL THEN todo[k].u ELSE first END,
         CASE WHEN k > 0 AND (here IS NULL OR todo[k].v <> first) THEN todo[k].v END, CASE WHEN here IS NULL THEN 1 ELSE n + 1 END,
         loops + CASE WHEN k > 0 AND here IS NOT NULL AND todo[k].v = first AND n >= 2 THEN 1 ELSE 0 END
  FROM (SELECT *, CASE WHEN here IS NULL THEN 1 ELSE coalesce(list_position(list_transform(todo, lambda e: e.u), here), 0) END AS k FROM walk WHERE len(todo) > 0)),
bl AS (SELECT mesh_id, greatest(1, max(loops)) AS boundary_loops FROM walk GROUP BY 1)"""


@query(f"WITH RECURSIVE {MESH}, {LOOPS} SELECT mesh_id, CAST(boundary_loops AS BIGINT) AS boundary_loops FROM bl")
def mesh_boundary_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.boundary_loops(many_meshes(spark, sf_dir)[0])


@query()
def mesh_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(*many_meshes(spark, sf_dir), max_edges=8)[1]


@query()
def mesh_unify_winding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.unify_winding(*many_meshes(spark, sf_dir))


@query(f"""{PARTS},
nv AS (SELECT mesh_id, count(*) AS n_vertices FROM v2m GROUP BY 1), nf AS (SELECT mesh_id, count(*) AS n_faces, count(*) FILTER (WHERE v0 = v1 OR v1 = v2 OR v0 = v2) AS invalid, count(*) - count(DISTINCT list_sort([v0, v1, v2])) AS dup FROM m2 GROUP BY 1),
es AS ({_STATS}),
cc AS (SELECT mesh_id, count(DISTINCT component) AS n FROM comp GROUP BY 1),
dg AS (SELECT mesh_id, count(*) FILTER (WHERE sqrt(nx*nx + ny*ny + nz*nz) / 2 <= 1e-7) AS deg FROM n2 GROUP BY 1)
SELECT nv.mesh_id, n_vertices, n_faces, invalid AS invalid_faces, CASE WHEN invalid = 0 THEN deg ELSE 0 END AS degenerate_faces, CASE WHEN invalid = 0 THEN dup ELSE 0 END AS duplicate_faces,
  CASE WHEN invalid = 0 THEN boundary_edges ELSE 0 END AS boundary_edge_count, CASE WHEN invalid = 0 THEN non_manifold_edges ELSE 0 END AS non_manifold_edge_count,
  CASE WHEN invalid = 0 THEN coalesce(cc.n, n_faces) ELSE 1 END AS component_count, n_vertices - n_edges + n_faces AS euler_characteristic,
  CASE WHEN invalid > 0 THEN 'ERROR' WHEN deg > 0 OR dup > 0 OR boundary_edges > 0 OR non_manifold_edges > 0 OR coalesce(cc.n, n_faces) > 1 THEN 'WARNING' ELSE 'VALID' END AS status
FROM nv JOIN nf ON nv.mesh_id = nf.mesh_id JOIN es ON nv.mesh_id = es.mesh_id JOIN dg ON nv.mesh_id = dg.mesh_id LEFT JOIN cc ON nv.mesh_id = cc.mesh_id""")
def mesh_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mesh.diagnose(*many_meshes(spark, sf_dir))
    return d.select(
        "mesh_id", "n_vertices", "n_faces", "invalid_faces", "degenerate_faces", "duplicate_faces", "boundary_edge_count", "non_manifold_edge_count", "component_count", "euler_characteristic", "status"
    )


@query(f"""WITH {MESH}, f2 AS (SELECT * FROM m1 WHERE NOT (v0 = v1 OR v1 = v2 OR v0 = v2)),
f3 AS (SELECT f2.* FROM f2 JOIN n2 ON f2.fid = n2.fid WHERE sqrt(nx*nx + ny*ny + nz*nz) / 2 > 50), f4 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY list_sort([v0, v1, v2]) ORDER BY fid) AS r FROM f3) WHERE r = 1),
us AS (SELECT count(*) AS n FROM pv WHERE vid IN (SELECT unnest([v0, v1, v2]) FROM f4)), c AS (SELECT (SELECT count(*) FROM pv) AS vb, (SELECT count(*) FROM m1) AS fb, (SELECT count(*) FROM f2) AS c2, (SELECT count(*) FROM f3) AS c3, (SELECT count(*) FROM f4) AS c4, (SELECT n FROM us) AS va)
SELECT CAST(0 AS BIGINT) AS mesh_id, vb AS vertices_before, fb AS faces_before, CAST(0 AS BIGINT) AS bad_vertices, CAST(0 AS BIGINT) AS faces_on_bad_vertices, fb - c2 AS invalid_removed, c2 - c3 AS degenerate_removed,
c3 - c4 AS duplicates_removed, vb - va AS orphans_removed, va AS vertices_after, c4 AS faces_after FROM c""")
def mesh_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(*one_mesh(spark, sf_dir), area_threshold=50.0)[2]


@query(f"""WITH {MESH}, un AS (SELECT mesh_id, fid, nz / sqrt(nx*nx + ny*ny + nz*nz) AS c FROM n2 WHERE nx*nx + ny*ny + nz*nz > 0)
SELECT mesh_id, fid FROM un WHERE c < 0 AND degrees(acos(greatest(-1.0, least(1.0, -c)))) < 45""")
def overhang_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printable.overhang_faces(*many_meshes(spark, sf_dir))


# Rays from all face centres, as no mesh of M2 has more than 500 faces, against the faces of meshes named by `{of}`.
RAYS = """
bx AS (SELECT mesh_id, greatest(sqrt(pow(max(x) - min(x), 2) + pow(max(y) - min(y), 2) + pow(max(z) - min(z), 2)) * 1e-6, 1e-9) AS eps FROM v2m GROUP BY 1),
ul AS (SELECT n2.*, eps, sqrt(nx*nx + ny*ny + nz*nz) AS ln FROM n2 JOIN bx ON n2.mesh_id = bx.mesh_id WHERE n2.mesh_id IN (SELECT mesh_id FROM {of})),
ry AS (SELECT mesh_id, eps, (x0 + x1 + x2) / 3 - nx / ln * eps AS ox, (y0 + y1 + y2) / 3 - ny / ln * eps AS oy, (z0 + z1 + z2) / 3 - nz / ln * eps AS oz,
              -(nx / ln) AS dx, -(ny / ln) AS dy, -(nz / ln) AS dz FROM ul WHERE ln > 0),
tr AS (SELECT mesh_id, x0, y0, z0, x1 - x0 AS ax, y1 - y0 AS ay, z1 - z0 AS az, x2 - x0 AS bx, y2 - y0 AS by_, z2 - z0 AS bz FROM g2),
mt AS (SELECT ry.*, ax, ay, az, bx, by_, bz, ox - x0 AS sx, oy - y0 AS sy, oz - z0 AS sz, dy * bz - dz * by_ AS hx, dz * bx - dx * bz AS hy, dx * by_ - dy * bx AS hz FROM ry JOIN tr ON ry.mesh_id = tr.mesh_id),
mq AS (SELECT *, ax * hx + ay * hy + az * hz AS det, sy * az - sz * ay AS qx, sz * ax - sx * az AS qy, sx * ay - sy * ax AS qz FROM mt),
mh AS (SELECT mesh_id, eps, (sx * hx + sy * hy + sz * hz) / det AS u, (dx * qx + dy * qy + dz * qz) / det AS v, (bx * qx + by_ * qy + bz * qz) / det AS t FROM mq WHERE abs(det) > 1e-14),
tk AS (SELECT mesh_id, min(t) AS thickness FROM mh WHERE u >= 0 AND v >= 0 AND u + v <= 1 AND t > 10 * eps GROUP BY 1)"""


@query(f"WITH {MESH}, {RAYS.format(of='m2')} SELECT mesh_id, round(thickness, 6) AS thickness FROM tk")
def thickness_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = printable.thickness(*many_meshes(spark, sf_dir))
    return t.select("mesh_id", F.round("thickness", 6).alias("thickness"))


@query(f"""{MESHR}, {FANS},
wd AS (SELECT mesh_id, max(c) = 1 AS consistent FROM (SELECT mesh_id, u, v, count(*) AS c FROM de GROUP BY 1, 2, 3) GROUP BY 1),
es AS ({_STATS}),
vo AS (SELECT mesh_id, sum((x0*(y1*z2-z1*y2) + y0*(z1*x2-x1*z2) + z0*(x1*y2-y1*x2)) / 6) AS volume FROM n2 GROUP BY 1),
so AS (SELECT es.mesh_id, closed AND consistent AND volume > 0 AS solid, edge_manifold FROM es JOIN wd ON es.mesh_id = wd.mesh_id JOIN vo ON es.mesh_id = vo.mesh_id),
sl AS (SELECT mesh_id FROM so WHERE solid), {RAYS.format(of='sl')},
un AS (SELECT mesh_id, fid, nz / sqrt(nx*nx + ny*ny + nz*nz) AS c FROM n2 WHERE nx*nx + ny*ny + nz*nz > 0),
oh AS (SELECT mesh_id, count(*) AS n FROM un WHERE c < 0 AND degrees(acos(greatest(-1.0, least(1.0, -c)))) < 45 GROUP BY 1),
rj AS (SELECT so.mesh_id, solid, edge_manifold AND vertex_manifold AS mf, coalesce(n, 0) AS n, thickness FROM so JOIN vm ON so.mesh_id = vm.mesh_id LEFT JOIN oh ON so.mesh_id = oh.mesh_id LEFT JOIN tk ON so.mesh_id = tk.mesh_id)
SELECT mesh_id, solid AS is_watertight, mf AS is_manifold, thickness AS min_wall_thickness_mm, CAST(n AS BIGINT) AS overhang_face_count, solid AND mf AND coalesce(thickness >= 1.2, false) AS is_printable,
  list_filter([CASE WHEN NOT solid THEN 'Mesh is open/non-watertight; cannot form a sealed solid volume.' END,
    CASE WHEN NOT mf THEN 'Mesh contains non-manifold edges or vertices.' END,
    CASE WHEN n > 0 THEN n || ' downward-facing surface elements require support structures at >45.0°.' END,
    CASE WHEN thickness < 1.2 THEN 'Estimated minimum wall thickness (' || printf('%.2f', thickness) || ' mm) is below configured threshold (1.20 mm).' END,
    CASE WHEN NOT solid THEN 'Wall thickness analysis skipped: ray intersection requires a closed, watertight mesh.' END], lambda w: w IS NOT NULL) AS warnings FROM rj""")
def printable_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printable.report(*many_meshes(spark, sf_dir))


@query()
def mesh_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    faces, vertices = many_meshes(spark, sf_dir)
    return process_meshes(cut(faces, "m2"), cut(vertices, "m2")).after
