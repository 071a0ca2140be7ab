"""Measurement, truth, reconstruction rules, scalar functions, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivet.functions import scalars
from trivet.functions import vectors as V
from trivet.operators import recon, scaling
from trivet.plans.relations import MESH, part_vertices, table
from trivet.sources import sinks

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


_M = """m AS (SELECT l_suppkey, avg(l_quantity) AS mean, median(l_quantity) AS median, stddev_pop(l_quantity) AS std_dev, min(l_quantity) AS min_val, max(l_quantity) AS max_val, count(*) AS measurement_count FROM lineitem GROUP BY 1)"""


@query(f"WITH {_M} SELECT l_suppkey, round(mean, 6) AS mean, round(median, 6) AS median, round(std_dev, 6) AS std_dev, min_val, max_val, measurement_count, max_val - min_val AS spread FROM m")
def measure_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = scaling.measure(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity")
    return m.withColumns({c: F.round(c, 6) for c in ("mean", "median", "std_dev")})


@query(f"WITH {_M} SELECT l_suppkey, round(50 / median, 6) AS scale_factor, round(std_dev * std_dev, 4) AS variance, round(greatest(0, least(1, 1 - std_dev / mean)), 4) AS confidence FROM m")
def scale_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scaling.estimate(scaling.measure(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity"), F.lit(50.0))
    return e.select("l_suppkey", F.round("scale_factor", 6).alias("scale_factor"), F.round("variance", 4).alias("variance"), F.round("confidence", 4).alias("confidence"))


@query("SELECT l_suppkey, round(50 / avg(l_quantity), 6) AS scale_factor FROM lineitem GROUP BY 1")
def calibrator_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = scaling.mean_scale(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", 50.0)
    return m.select("l_suppkey", F.round("scale_factor", 6).alias("scale_factor"))


@query(f"WITH {MESH} SELECT mesh_id, vid, round(10 + 3 * (x - 10), 6) AS x, round(20 + 3 * (y - 20), 6) AS y, round(30 + 3 * (z - 30), 6) AS z FROM pv")
def scale_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = part_vertices(spark, sf_dir)
    out = scaling.scale_vertices(v, v.select("mesh_id", F.lit(3.0).alias("factor")).distinct(), (10.0, 20.0, 30.0))
    return out.withColumns({a: F.round(a, 6) for a in "xyz"})


@query("""WITH u AS (SELECT p.p_partkey, p.p_retailprice AS t, round(avg(l_extendedprice / l_quantity), 4) AS m FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey GROUP BY 1, 2)
SELECT p_partkey, round(abs(m - t), 4) AS abs_err, round(CASE WHEN t > 0 THEN abs(m - t) / t * 100 ELSE 0 END, 4) AS rel_err_pct, abs(m - t) <= 1000 AS passed FROM u""")
def truth_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.round(F.avg(F.col("l_extendedprice") / F.col("l_quantity")), 4).alias("m"))
    t = scaling.compare_truth(table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("t")).join(m, "p_partkey"), ("t",), ("m",), F.lit(1000.0))
    return t.select("p_partkey", F.round("abs_err_0", 4).alias("abs_err"), F.round("rel_err_pct_0", 4).alias("rel_err_pct"), "passed")


_MODELS = """md AS (SELECT CAST(o_custkey AS VARCHAR) AS job_id, 'sparse/' || o_orderkey AS path, o_orderkey % 9 AS images, CAST(o_totalprice AS BIGINT) // 100000 AS points, CAST(length(o_orderpriority) AS INTEGER) AS files FROM orders)"""


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("job_id"), F.concat(F.lit("sparse/"), F.col("o_orderkey")).alias("path"), (F.col("o_orderkey") % 9).alias("images"),
        F.expr("cast(round(o_totalprice) as bigint) div 100000").alias("points"), F.length("o_orderpriority").alias("files"),
    )


@query(f"WITH {_MODELS} SELECT job_id, path, images, points, files FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY images DESC, points DESC, files DESC, path) AS r FROM md) WHERE r = 1")
def model_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recon.best_model(_models(spark, sf_dir))


_NAMES = ("texturedMesh.obj", "mesh.ply", "out/filtered.obj", "out/cloud.ply", "a/textured_final.stl")


@query(f"""WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS job_id, CAST(o_orderkey % 2 AS INTEGER) AS dir_rank, o_orderkey % 3 AS length, '/job/' || o_orderkey || '/' || CASE o_orderkey % 5 WHEN 0 THEN '{_NAMES[0]}' WHEN 1 THEN '{_NAMES[1]}' WHEN 2 THEN '{_NAMES[2]}' WHEN 3 THEN '{_NAMES[3]}' ELSE '{_NAMES[4]}' END AS path FROM orders),
l AS (SELECT *, CASE WHEN path LIKE '%/texturedMesh.obj' THEN dir_rank * 4 WHEN path LIKE '%/mesh.ply' THEN dir_rank * 4 + 3 WHEN path LIKE '%/textured_final.stl' THEN 1000 WHEN path LIKE '%filter%' THEN 1001 END AS r FROM f WHERE length > 0)
SELECT job_id, path FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY r, dir_rank, path) AS n FROM l WHERE r IS NOT NULL) WHERE n = 1""")
def artifact_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trivet.sources.files import mesh_rank

    o = table(spark, sf_dir, "orders")
    name = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    f = o.select(
        F.col("o_custkey").cast("string").alias("job_id"), (F.col("o_orderkey") % 2).cast("int").alias("dir_rank"), (F.col("o_orderkey") % 3).alias("length"),
        F.concat(F.lit("/job/"), F.col("o_orderkey"), F.lit("/"), name).alias("path"),
    )
    return recon.first_artifact(f, mesh_rank(F.col("path"), F.col("dir_rank")))


@query("""WITH j AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS r FROM orders GROUP BY 1)
SELECT o_custkey, n, r, round(r / CAST(n AS DOUBLE), 4) AS ratio_4dp, least(1.0, round(r / CAST(n AS DOUBLE), 3)) AS ratio_3dp FROM j""")
def registration_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("r"))
    reg = lambda d, c: recon.registration(F.col("o_custkey"), F.col("r"), F.col("n"), d, c)
    return j.withColumns({"ratio_4dp": reg(4, False), "ratio_3dp": reg(3, True)})


@query("""WITH j AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS r FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN r < 3 THEN 'process_failed' WHEN n >= 10 AND round(r / CAST(n AS DOUBLE), 4) < 0.35 AND o_custkey % 2 = 1 THEN 'partial' ELSE 'success' END AS status FROM j""")
def fragmentation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("r"))
    return j.select("o_custkey", recon.status(F.col("n"), F.col("r"), F.col("o_custkey") % 2 == 0).alias("status"))


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN 'timeout' WHEN 'click' THEN 'invalid_input' WHEN 'view' THEN 'success' ELSE 'process_failed' END AS status FROM events""")
def error_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "timeout").when(F.col("event_type") == "click", "invalid_input").when(F.col("event_type") != "view", "other")
    return table(spark, sf_dir, "events").select("event_id", recon.status_of_error(kind).alias("status"))


@query("""WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, CAST(p_partkey % 97 AS DOUBLE) AS z FROM part)
SELECT p_partkey, round(sqrt(x*x + y*y + z*z), 6) AS length, round((x*1 + y*2 + z*3), 6) AS dot, round(y*3 - z*2, 6) AS cx, round(z*1 - x*3, 6) AS cy, round(x*2 - y*1, 6) AS cz,
round(sqrt((x-1)*(x-1) + (y-2)*(y-2) + (z-3)*(z-3)), 6) AS distance, round(x / sqrt(x*x + y*y + z*z), 6) AS unit_x FROM p""")
def vector_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = (F.col("p_size").cast("double"), F.col("p_retailprice"), (F.col("p_partkey") % 97).cast("double"))
    b = (F.lit(1.0), F.lit(2.0), F.lit(3.0))
    c = V.cross(a, b)
    r = lambda x, n: F.round(x, 6).alias(n)
    return table(spark, sf_dir, "part").select(
        "p_partkey", r(V.norm(a), "length"), r(V.dot(a, b), "dot"), r(c[0], "cx"), r(c[1], "cy"), r(c[2], "cz"), r(V.distance(a, b), "distance"), r(V.normalized(a)[0], "unit_x")
    )


@query("""WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, CAST(p_partkey % 97 AS DOUBLE) AS z FROM part)
SELECT p_partkey, round((2*x + 5) / (1 + z * CAST(0.01 AS DOUBLE)), 6) AS x, round((2*y - 3) / (1 + z * CAST(0.01 AS DOUBLE)), 6) AS y, round((2*z + 1) / (1 + z * CAST(0.01 AS DOUBLE)), 6) AS z FROM p""")
def transform4x4(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = [[2, 0, 0, 5], [0, 2, 0, -3], [0, 0, 2, 1], [0, 0, 0.01, 1]]
    p = (F.col("p_size").cast("double"), F.col("p_retailprice"), (F.col("p_partkey") % 97).cast("double"))
    out = V.transform_point(m, p)
    return table(spark, sf_dir, "part").select("p_partkey", *[F.round(c, 6).alias(a) for c, a in zip(out, "xyz", strict=True)])


@query("""WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS s, CAST(p_partkey % 97 AS DOUBLE) AS z FROM part)
SELECT p_partkey, s AS width, 2 * s AS depth, z AS height, round(s * (2 * s) * z, 6) AS volume, s / 2 AS center_x, s AS center_y, z / 2 AS center_z FROM p""")
def bbox_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = (F.lit(0.0),) * 3
    s = F.col("p_size").cast("double")
    box = V.box_measures(zero, (s, 2 * s, (F.col("p_partkey") % 97).cast("double")))
    return table(spark, sf_dir, "part").select("p_partkey", *[(F.round(c, 6) if n == "volume" else c).alias(n) for n, c in box.items()])


@query("""WITH c AS (SELECT p_partkey, CAST(p_partkey * 7919 AS BIGINT) AS n FROM part), b AS (SELECT *, [n & 255, (n >> 8) & 255, (n >> 16) & 255, (n >> 24) & 255] AS l FROM c),
t AS (SELECT *, array_to_string(list_transform(l, lambda x: CASE WHEN (x > 32 AND x < 127) OR (x > 160 AND x <> 173) THEN chr(CAST(x AS INTEGER)) ELSE '?' END), '') AS s FROM b)
SELECT p_partkey, CASE WHEN n <= 0 OR s = '????' THEN 'unknown' ELSE s END AS codec FROM t""")
def fourcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", scalars.fourcc(F.col("p_partkey") * 7919).alias("codec"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d_%H%M%S') || '_' || regexp_replace(o_orderpriority, '[^a-zA-Z0-9_-]', '_', 'g') AS run_id FROM orders")
def run_id_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.run_id(F.col("o_orderdate"), F.col("o_orderpriority")).alias("run_id"))


@query("""WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, CASE WHEN k % 10 > 0 THEN CAST(k % 7 AS INTEGER) WHEN k % 7 > 0 THEN CAST(k % 7 AS INTEGER) END AS pose_count, CASE WHEN k % 10 > 0 THEN least(1.0, round((k % 7) / CAST(k % 10 AS DOUBLE), 3)) END AS ratio FROM e""")
def sfm_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    e = table(spark, sf_dir, "events").select("event_id", k.alias("k"))
    many = lambda n: F.slice(F.sequence(F.lit(1), F.lit(10)), F.lit(1), n)
    as_map = F.to_json(F.map_from_arrays(F.transform(many(F.col("k") % 10), lambda i: i.cast("string")), many(F.col("k") % 10)))
    body = F.concat(F.lit('{"views":'), as_map, F.lit(',"poses":'), F.to_json(many(F.col("k") % 7)), F.lit("}"))
    c = recon.sfm_counts(F.col("body"))
    return e.withColumn("body", body).select("event_id", c["pose_count"].alias("pose_count"), c["ratio"].alias("ratio"))


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def sha256_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("project_name"), F.lit("m.stl").alias("stl_filename"), F.col("text").cast("binary").alias("content"), *[F.lit(1.0).alias(c) for c in ("width", "depth", "height", "volume", "scale_factor")], F.lit(True).alias("is_watertight"), F.lit("t").alias("created_at"))
    return sinks.build_manifest(d).select(F.col("project_name").cast("long").alias("doc_id"), F.get_json_object("body", "$.file_sha256").alias("sha256"))


@query("""SELECT p_partkey, round(sqrt(CAST(p_size AS DOUBLE) * p_size + 9), 6) AS side_0, CAST(3 AS DOUBLE) AS side_3 FROM part""")
def marker_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size").cast("double")
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    zero, three = F.lit(0.0), F.lit(3.0)
    e = scaling.marker_edges(F.array(at(zero, zero), at(s, three), at(s, F.lit(9.0)), at(zero, three)))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(F.get(e, 0), 6).alias("side_0"), F.get(e, 3).alias("side_3"))


@query("""SELECT user_id AS video_id, count(*) AS extracted_count, sum(event_id) AS id_sum FROM events GROUP BY 1""")
def frame_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), F.col("event_id").alias("source_frame_index"), scalars.frame_name(F.col("event_id")).alias("filename"), F.lit(0.0).alias("timestamp_seconds"))
    m = sinks.frame_manifest(e.select("video_id").distinct(), e)
    got = m.select("video_id", F.from_json("body", "extracted_count long, frames array<struct<source_frame_index: long>>").alias("j"))
    return got.select("video_id", F.col("j.extracted_count").alias("extracted_count"), F.aggregate("j.frames", F.lit(0).cast("long"), lambda s, x: s + x["source_frame_index"]).cast("decimal(38,0)").cast("long").alias("id_sum"))
