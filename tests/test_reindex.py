"""Vertices of one large mesh are numbered by several tasks."""

from trivet.operators import mesh


def test_large_mesh_is_numbered_by_ranges(spark):
    n = 20_000
    vertices = spark.range(n).selectExpr("0L as mesh_id", "id * 7 % 20000 * 3 as vid", "cast(id as double) as x", "0D as y", "0D as z")
    vertices = vertices.unionByName(spark.createDataFrame([(1, 9, 0.0, 0.0, 0.0), (1, 4, 0.0, 0.0, 0.0)], vertices.schema))
    faces = spark.createDataFrame([(0, 5, 0, 3, 59_997), (1, 6, 9, 4, 9)], "mesh_id long, fid long, v0 long, v1 long, v2 long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        f, v = mesh.dense_reindex(faces, vertices)
        most = max(len(x) for x in v.where("mesh_id = 0").select("vid").rdd.glom().collect())
        assert most < n
        assert sorted(r["vid"] for r in v.where("mesh_id = 0").collect()) == list(range(n))
        assert sorted(map(tuple, f.collect())) == [(0, 5, 0, 1, n - 1), (1, 6, 1, 0, 1)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
