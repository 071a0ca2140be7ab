"""Capture and mesh relations over the driver's tables, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events of a user as the frames of a video."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("video_id"),
        (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("long").alias("seq"),
        (F.col("value") * 3).alias("sharpness"),
        (F.get_json_object("props", "$.k").cast("int") * 2.55).alias("brightness"),
        (F.col("event_id") % 64).cast("double").alias("contrast"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


FRAMES = """
frames AS (
  SELECT user_id AS video_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq, value * 3 AS sharpness,
         CAST(json_extract_string(props, '$.k') AS INTEGER) * CAST(2.55 AS DOUBLE) AS brightness, CAST(event_id % 64 AS DOUBLE) AS contrast,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""


def thumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings of a label as the thumbnails of a video."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("label").cast("long").alias("video_id"),
        (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("long").alias("seq"),
        "vec_id",
        F.col("embedding").cast("array<double>").alias("thumb"),
    )


THUMBS = """
thumbs AS (
  SELECT CAST(label AS BIGINT) AS video_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS seq, vec_id, CAST(embedding AS DOUBLE[]) AS thumb
  FROM embeddings)"""


def many_meshes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """M2: the lines of an order as a strip of triangles over parts; faces, and the vertices they name."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("mesh_id"),
        (F.col("l_orderkey") * 1000 + F.row_number().over(w) - 1).alias("fid"),
        F.col("l_partkey").alias("v0"),
        F.lead("l_partkey", 1).over(w).alias("v1"),
        F.lead("l_partkey", 2).over(w).alias("v2"),
    )
    faces = li.where("v2 is not null")
    used = faces.select("mesh_id", F.explode(F.array("v0", "v1", "v2")).alias("vid")).distinct()
    return faces, used.join(part_vertices(spark, sf_dir).drop("mesh_id"), "vid").select("mesh_id", "vid", "x", "y", "z")


def part_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.lit(0).cast("long").alias("mesh_id"), F.col("p_partkey").alias("vid"), F.col("p_size").cast("double").alias("x"),
        (F.col("p_retailprice") - 900).alias("y"), (F.col("p_partkey") % 97).cast("double").alias("z"),
    )


def one_mesh(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """M1: the same faces as one mesh over all parts."""
    faces, _ = many_meshes(spark, sf_dir)
    return faces.withColumn("mesh_id", F.lit(0).cast("long")), part_vertices(spark, sf_dir)


MESH = """
li AS (
  SELECT l_orderkey, l_partkey, l_returnflag, row_number() OVER w - 1 AS i, lead(l_partkey, 1) OVER w AS b, lead(l_partkey, 2) OVER w AS c
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice)),
m2 AS (SELECT l_orderkey AS mesh_id, l_orderkey * 1000 + i AS fid, l_partkey AS v0, b AS v1, c AS v2 FROM li WHERE c IS NOT NULL),
m1 AS (SELECT CAST(0 AS BIGINT) AS mesh_id, fid, v0, v1, v2 FROM m2),
pv AS (SELECT CAST(0 AS BIGINT) AS mesh_id, p_partkey AS vid, CAST(p_size AS DOUBLE) AS x, p_retailprice - 900 AS y, CAST(p_partkey % 97 AS DOUBLE) AS z FROM part),
used AS (SELECT DISTINCT mesh_id, unnest([v0, v1, v2]) AS vid FROM m2),
v2m AS (SELECT used.mesh_id, used.vid, pv.x, pv.y, pv.z FROM used JOIN pv ON used.vid = pv.vid),
de AS (SELECT mesh_id, fid, unnest([v0, v1, v2]) AS u, unnest([v1, v2, v0]) AS v FROM m2),
ec AS (SELECT mesh_id, least(u, v) AS lo, greatest(u, v) AS hi, count(*) AS c, min(fid) AS a, max(fid) AS b FROM de GROUP BY 1, 2, 3),
g2 AS (
  SELECT f.*, p.x AS x0, p.y AS y0, p.z AS z0, q.x AS x1, q.y AS y1, q.z AS z1, r.x AS x2, r.y AS y2, r.z AS z2
  FROM m2 f JOIN pv p ON f.v0 = p.vid JOIN pv q ON f.v1 = q.vid JOIN pv r ON f.v2 = r.vid),
n2 AS (
  SELECT *, (y1-y0)*(z2-z0)-(z1-z0)*(y2-y0) AS nx, (z1-z0)*(x2-x0)-(x1-x0)*(z2-z0) AS ny, (x1-x0)*(y2-y0)-(y1-y0)*(x2-x0) AS nz FROM g2),
adj AS (SELECT DISTINCT mesh_id, a, b FROM ec WHERE c = 2 AND a < b)"""


def pair_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1: neighbouring frames of F1 (three ahead) with inlier counts made from their k."""
    from trivet.operators.matchgraph import neighbour_pairs

    p = neighbour_pairs(frames(spark, sf_dir).select("video_id", "seq", "k"), 3, carry=("k",))
    return p.select(
        "video_id", "i", "j", (F.col("k_i") + F.col("k_j")).alias("raw_matches"),
        ((F.col("k_i") + F.col("k_j")) % 40).cast("int").alias("f_inliers"), ((7 * F.col("k_i") + F.col("k_j")) % 40).cast("int").alias("h_inliers"),
    )


PAIRS = (
    FRAMES
    + """,
e1 AS (
  SELECT a.video_id, a.seq AS i, b.seq AS j, a.k + b.k AS raw_matches, (a.k + b.k) % 40 AS f, (7 * a.k + b.k) % 40 AS h
  FROM frames a JOIN frames b ON a.video_id = b.video_id AND b.seq BETWEEN a.seq + 1 AND a.seq + 3),
cl AS (
  SELECT *, greatest(f, h) >= 15 AS conn, CASE WHEN f = 0 AND h >= 15 THEN CAST(1 AS DOUBLE) WHEN f = 0 THEN CAST(0 AS DOUBLE) ELSE least(CAST(1 AS DOUBLE), h / CAST(f AS DOUBLE)) END AS r FROM e1),
me AS (SELECT *, conn AND f >= 15 AND r < CAST(0.85 AS DOUBLE) AS par FROM cl),
nb AS (SELECT video_id, i AS n, j AS o, conn, par FROM me UNION ALL SELECT video_id, j, i, conn, par FROM me),
dg AS (SELECT video_id, n AS seq, count(*) FILTER (WHERE conn) AS t_deg, count(*) FILTER (WHERE par) AS p_deg FROM nb GROUP BY 1, 2),
os AS (
  SELECT video_id, seq, brightness, contrast, k, brightness < 10 OR brightness > 248 OR contrast < 5 AS severe,
         round(CASE WHEN brightness < 10 OR brightness > 248 OR contrast < 5 THEN CAST(0.05 AS DOUBLE)
               ELSE CAST(0.4 AS DOUBLE) * least(CAST(1 AS DOUBLE), sharpness / 100) + CAST(0.3 AS DOUBLE) * least(CAST(1 AS DOUBLE), contrast / 50) + CAST(0.3 AS DOUBLE) * least(CAST(1 AS DOUBLE), (k * 3) / CAST(250 AS DOUBLE)) * greatest(CAST(0.2 AS DOUBLE), (k % 10) / CAST(9 AS DOUBLE)) END, 3) AS optical
  FROM frames),
ut AS (
  SELECT os.*, coalesce(t_deg, 0) AS t_deg, coalesce(p_deg, 0) AS p_deg,
         round(optical + CAST(0.3 AS DOUBLE) * least(CAST(1 AS DOUBLE), coalesce(p_deg, 0) / CAST(2 AS DOUBLE)) + CAST(0.2 AS DOUBLE) * least(CAST(1 AS DOUBLE), coalesce(t_deg, 0) / CAST(3 AS DOUBLE)), 3) AS utility
  FROM os LEFT JOIN dg ON os.video_id = dg.video_id AND os.seq = dg.seq)"""
)
