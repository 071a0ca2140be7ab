"""Files, headers, reports, logs and input rules, over rows made by rule from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trivet.operators import mesh, printable, recon, scaling
from trivet.plans.mesh_pipeline import scale_meshes
from trivet.plans.relations import MESH, many_meshes, one_mesh, table
from trivet.sources import files, reports, sinks

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return keep


def _field(name: str, kind: str = "string") -> Column:
    return F.get_json_object("body", f"$.{name}").cast(kind).alias(name.replace(".", "_"))


_SUFFIXES = (".mp4", ".MOV", ".m4v", ".avi", ".MKV", ".txt", "")


@query(f"""WITH f AS (SELECT o_orderkey, '/v/' || o_orderkey || {list(_SUFFIXES)}[o_orderkey % 7 + 1] AS path, o_orderkey % 5 AS length FROM orders)
SELECT o_orderkey, CASE WHEN length <= 0 THEN 'empty' WHEN NOT regexp_matches(lower(path), '\\.(mp4|mov|m4v|avi|mkv)$') THEN 'unsupported_format' END AS error FROM f""")
def video_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.element_at(F.array(*[F.lit(s) for s in _SUFFIXES]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    f = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("/v/"), F.col("o_orderkey"), end).alias("path"), (F.col("o_orderkey") % 5).alias("length"))
    return files.check_videos(f).select("o_orderkey", "error")


@query("""WITH v AS (SELECT p_partkey, p_size * 60 AS width, (p_partkey % 30) * 40 AS height, (p_partkey % 6) * 10 AS fps, p_partkey % 50 - 5 AS n, p_partkey % 2 = 0 AS readable FROM part),
c AS (SELECT *, CASE WHEN n > 0 THEN n WHEN readable THEN 1 END AS k FROM v)
SELECT p_partkey, CASE WHEN fps > 0 THEN round(k / CAST(fps AS DOUBLE), 3) END AS duration_seconds, CASE WHEN width <= 0 OR height <= 0 THEN 'bad_size' WHEN fps <= 0 THEN 'bad_fps' WHEN coalesce(k, 0) <= 0 THEN 'no_frames'
  WHEN width < 640 OR height < 360 THEN 'too_small' END AS error FROM c""")
def video_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    v = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") * 60).alias("width"), (k % 30 * 40).alias("height"), (k % 6 * 10.0).alias("fps"), (k % 50 - 5).alias("frame_count"), (k % 2 == 0).alias("readable"), (k * 7919).alias("fourcc"),
    )
    good, bad = files.ingest(v, 640, 360)
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad).select("p_partkey", "duration_seconds", "error")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 > 0 THEN CAST(p_size AS BIGINT) END AS n_vertices, CASE WHEN p_partkey % 7 > 0 THEN p_partkey % 3 END AS n_faces,
p_partkey % 7 > 0 AND p_size > 0 AND p_partkey % 3 > 0 AS is_mesh FROM part""")
def ply_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.format_string("ply\nformat ascii 1.0\nelement vertex %d\nproperty float x\nelement face %d\nend_header\nelement vertex 9\n", F.col("p_size").cast("long"), F.col("p_partkey") % 3)
    text = F.when(F.col("p_partkey") % 7 > 0, head).otherwise("solid part\n")
    f = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), text.cast("binary").alias("content"))
    return files.ply_counts(f).select(F.col("path").cast("long").alias("p_partkey"), "n_vertices", "n_faces", "is_mesh")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE (o_orderkey % 9) // 2 END AS images, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_orderkey % 9 END AS points FROM orders""")
def sparse_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = F.col("o_custkey")
    low_first = F.concat(*[F.lpad(F.hex(F.shiftright(c, 8 * i).bitwiseAND(255)), 2, "0") for i in range(8)])
    lines = F.concat(F.lit("# a comment\n\n"), F.repeat(F.lit("1 0.5 0.5\n"), (F.col("o_orderkey") % 9).cast("int"))).cast("binary")
    binary, text = o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1")
    name = lambda n: F.concat(F.lit("/m/"), F.col("o_orderkey"), F.lit(f"/{n}")).alias("path")
    f = binary.select(name("images.bin"), F.unhex(low_first).alias("content"))
    for n in ("images.txt", "points3D.txt"):
        f = f.unionByName(text.select(name(n), lines.alias("content")))
    return files.model_stats(f).select(F.regexp_extract("model", r"(\d+)$", 1).cast("long").alias("o_orderkey"), "images", "points")


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL")
def file_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("path"), F.col("text").cast("binary").alias("content"))
    return files.file_hashes(d).select(F.col("path").cast("long").alias("doc_id"), "sha256")


@query("""SELECT p_partkey, '# Manufacturing Job Summary' || chr(10) || chr(10) || '- **Project**: ' || p_name || chr(10) || '- **Model**: `m.stl`' || chr(10) || '- **SHA-256**: `' || sha256(p_name) || '`' || chr(10)
|| printf('- **Bounding Box**: %.2f x %.2f x %.2f mm', p_size * 0.5::DOUBLE, p_size::DOUBLE, (p_partkey % 97)::DOUBLE) || chr(10) || printf('- **Volume**: %.2f mm^3', p_size * 0.25::DOUBLE) || chr(10)
|| '- **Watertight**: ' || CASE WHEN p_partkey % 2 = 0 THEN 'YES' ELSE 'NO' END || chr(10) || printf('- **Scale Multiplier**: %.6f', (p_partkey % 8) * 0.125::DOUBLE) || chr(10) || '- **Generated At**: t' || chr(10) AS summary FROM part""")
def job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = F.col("p_size").cast("double"), F.col("p_partkey")
    text = sinks.job_summary(F.col("p_name"), F.lit("m.stl"), F.sha2("p_name", 256), (s * 0.5, s, (k % 97).cast("double")), s * 0.25, k % 2 == 0, k % 8 * F.lit(0.125), F.lit("t"))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("summary"))


@query("""WITH f AS (SELECT o_custkey, '/d/' || o_orderkey || '/IMG_' || (o_orderkey % 3) || CASE WHEN o_orderkey % 2 = 0 THEN '.jpg' ELSE '.JPG' END AS path, 'IMG_' || (o_orderkey % 3) || CASE WHEN o_orderkey % 2 = 0 THEN '.jpg' ELSE '.JPG' END AS n FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, lower(n) ORDER BY path) - 1 AS r, row_number() OVER (PARTITION BY o_custkey ORDER BY path) - 1 AS o FROM f)
SELECT path, CASE WHEN r > 0 THEN printf('%05d_', o) || n ELSE n END AS copy_name FROM r""")
def copy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    name = F.concat(F.lit("/d/"), k, F.lit("/IMG_"), k % 3, F.when(k % 2 == 0, ".jpg").otherwise(".JPG"))
    return sinks.copy_names(table(spark, sf_dir, "orders").select("o_custkey", name.alias("path")), "o_custkey").select("path", "copy_name")


@query("""SELECT p_partkey, p_name AS file_name, CAST(p_size AS BIGINT) AS file_size_bytes, p_size * 2 AS resolution_width, p_size AS resolution_height, CASE WHEN p_partkey % 2 = 0 THEN 'avc1' ELSE 'unknown' END AS codec, 10 AS n_keys FROM part""")
def metadata_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    v = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("file_name"), F.col("p_name").alias("file_path"), s.cast("long").alias("file_size_bytes"), F.lit(1.5).alias("duration_seconds"), s.alias("frame_count"),
        F.lit(30.0).alias("fps"), (s * 2).alias("width"), s.alias("height"), F.when(F.col("p_partkey") % 2 == 0, "avc1").alias("codec"),
    )
    body = reports.metadata_report(v, "p_partkey")
    return body.select("p_partkey", _field("file_name"), _field("file_size_bytes", "long"), _field("resolution.width", "int"), _field("resolution.height", "int"), _field("codec"), F.size(F.json_object_keys("body")).alias("n_keys"))


@query("""WITH e AS (SELECT user_id, event_id, event_type <> 'error' AS ok FROM events)
SELECT user_id, count(*) AS n, count(*) FILTER (WHERE ok) AS n_selected, count(*) FILTER (WHERE NOT ok) AS n_rejected, CAST(min(event_id) AS VARCHAR) AS first, count(*) AS total, count(*) AS total_again FROM e GROUP BY 1""")
def capture_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    frames = e.select("user_id", F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("filename"), F.col("value").alias("sharpness"), (F.col("event_type") != "error").alias("is_accepted"))
    runs = e.groupBy("user_id").agg(F.struct(F.count("*").alias("extracted_frames")).alias("summary"))
    body = reports.capture_report(runs, frames, "user_id")
    size = lambda p: F.coalesce(F.json_array_length(F.get_json_object("body", p)), F.lit(0)).cast("long")
    return body.select(
        "user_id", size("$.frame_results").alias("n"), size("$.selected_frames").alias("n_selected"), size("$.rejected_frames").alias("n_rejected"), F.get_json_object("body", "$.frame_results[0].filename").alias("first"),
        F.get_json_object("body", "$.summary.extracted_frames").cast("long").alias("total"), F.get_json_object("body", "$.metadata.extracted_frames").cast("long").alias("total_again"),
    )


@query("""SELECT o_orderkey, o_orderstatus AS status, CASE WHEN o_orderkey % 3 > 0 THEN 'm.obj' END AS mesh_path, o_orderkey % 3 = 1 AS mesh_generated, 20 AS n_keys FROM orders""")
def reconstruction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    j = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.when(k % 3 > 0, "m.obj").alias("mesh_path"), F.when(k % 3 == 1, 10).otherwise(0).alias("mesh_bytes"), F.lit("w").alias("workspace_path")
    )
    return reports.reconstruction_report(j, "o_orderkey").select("o_orderkey", _field("status"), _field("mesh_path"), _field("mesh_generated", "boolean"), F.size(F.json_object_keys("body")).alias("n_keys"))


@query(f"""WITH {MESH}, a AS (SELECT mesh_id, sum(sqrt(nx*nx + ny*ny + nz*nz) / 2) AS area FROM n2 GROUP BY 1), b AS (SELECT mesh_id, count(*) AS n, max(x) - min(x) AS ex FROM v2m GROUP BY 1)
SELECT a.mesh_id, n AS vertex_count_before, CAST(0 AS BIGINT) AS repairs_attempted, round(area, 4) AS area, round(ex, 4) AS extent_x, 24 AS n_keys FROM a JOIN b ON a.mesh_id = b.mesh_id""")
def geometry_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, v = many_meshes(spark, sf_dir)
    d = mesh.vertex_stats(v).join(mesh.area_volume(f, v), "mesh_id")
    before = reports.diagnostics(d, "diagnostics_before").withColumn("vertex_count_before", F.col("diagnostics_before.n_vertices"))
    got = lambda p: F.get_json_object("body", p).cast("double")
    return reports.geometry_report(before).select(
        "mesh_id", _field("vertex_count_before", "long"), _field("repairs_attempted", "long"), got("$.diagnostics_before.area").alias("area"), got("$.diagnostics_before.extents[0]").alias("extent_x"),
        F.size(F.json_object_keys("body")).alias("n_keys"),
    )


@query("""SELECT p_partkey, 'ok' AS status, round(p_size / CAST(7 AS DOUBLE), 6) AS scale_factor, CAST(0.5 AS DOUBLE) AS origin_x, CAST(NULL AS VARCHAR) AS output_mesh_path, 18 AS n_keys FROM part""")
def scaling_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "part").select("p_partkey", F.lit("ok").alias("status"), (F.col("p_size") / 7.0).alias("scale_factor"), F.array(*[F.lit(x) for x in (0.50001, 0.0, 0.0)]).alias("transformation_origin"))
    body = reports.scaling_report(m, "p_partkey")
    return body.select("p_partkey", _field("status"), _field("scale_factor", "double"), F.get_json_object("body", "$.transformation_origin[0]").cast("double").alias("origin_x"), _field("output_mesh_path"), F.size(F.json_object_keys("body")).alias("n_keys"))


@query("""SELECT p_partkey, p_size > 25 AS is_printable, CAST(p_size AS BIGINT) AS overhang_face_count, 6 AS n_keys, p_size <= 30 AS passed, CAST(p_size AS DOUBLE) AS measured, 8 AS n_keys_truth FROM part""")
def check_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size").cast("double")
    p = table(spark, sf_dir, "part")
    r = reports.printability_report(p.select("p_partkey", (s > 25).alias("is_printable"), F.col("p_size").cast("long").alias("overhang_face_count")), "p_partkey")
    t = p.select("p_partkey", F.array(s, s, s).alias("reconstructed_dimensions_mm"), (s <= 30).alias("passed"))
    t = reports.validation_report(t, "p_partkey").select("p_partkey", _field("passed", "boolean"), F.get_json_object("body", "$.reconstructed_dimensions_mm[0]").cast("double").alias("measured"), F.size(F.json_object_keys("body")).alias("n_keys_truth"))
    return r.select("p_partkey", _field("is_printable", "boolean"), _field("overhang_face_count", "long"), F.size(F.json_object_keys("body")).alias("n_keys")).join(t, "p_partkey")


@query("""SELECT p_partkey, round(sqrt(CAST(p_size AS DOUBLE) * p_size + 9), 6) AS side_0 FROM part WHERE p_partkey % 3 = 1 AND p_partkey % 5 = 2""")
def marker_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = F.col("p_size").cast("double"), F.col("p_partkey")
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    zero = F.lit(0.0)
    m = table(spark, sf_dir, "part").select("p_partkey", (k % 5).alias("marker_id"), F.when(k % 3 == 1, "DICT_4X4_50").otherwise("DICT_5X5_100").alias("dictionary"), F.array(at(zero, zero), at(s, F.lit(3.0)), at(s, F.lit(9.0)), at(zero, F.lit(3.0))).alias("corners"))
    return scaling.observations(m, 2, " dict_4x4_50").select("p_partkey", F.round(F.get("edge_lengths_2d", 0), 6).alias("side_0"))


@query("""WITH l AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events)
SELECT user_id, count(*) AS n_lines, string_agg(event_id || ' ' || event_type, chr(10) ORDER BY event_id) FILTER (WHERE r <= 5) AS tail FROM l GROUP BY 1""")
def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.concat_ws(" ", F.col("event_id").cast("string"), "event_type").alias("line"))
    return recon.log_tail(e, 5, "user_id", "event_id")


@query("""SELECT p_partkey, p_partkey % 3 <> 0 AND p_partkey % 5 <> 0 AS dense, CASE WHEN p_partkey % 4 = 0 THEN 'a|b|a|c' ELSE 'b|c' END AS warnings FROM part""")
def engine_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    text = F.when(k % 3 == 0, "v3 (Without CUDA)").when(k % 5 != 0, "v3 with CUDA")
    old = F.when(k % 4 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("a")))
    notes = mesh.add_warnings(old, F.array(F.lit("b"), F.lit("c"), F.lit("c")))
    return table(spark, sf_dir, "part").select("p_partkey", recon.can_run_dense(text).alias("dense"), F.concat_ws("|", notes).alias("warnings"))


_BAD = "CASE WHEN vid % 50 = 0 THEN 'NaN'::DOUBLE WHEN vid % 50 = 1 THEN 'Infinity'::DOUBLE ELSE x END"


def _with_bad(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    f, v = many_meshes(spark, sf_dir)
    return f, v.withColumn("x", F.when(F.col("vid") % 50 == 0, float("nan")).when(F.col("vid") % 50 == 1, float("inf")).otherwise(F.col("x")))


@query(f"""WITH {MESH}, b AS (SELECT *, vid % 50 <= 1 AS bad FROM v2m)
SELECT mesh_id, count(*) AS n_vertices, count(*) FILTER (WHERE vid % 50 = 0) AS nan_vertices, count(*) FILTER (WHERE vid % 50 = 1) AS inf_vertices, coalesce(min(x) FILTER (WHERE NOT bad), 0) AS min_x, coalesce(max(y) FILTER (WHERE NOT bad), 0) AS max_y FROM b GROUP BY 1""")
def mesh_bad_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.vertex_stats(_with_bad(spark, sf_dir)[1]).select("mesh_id", "n_vertices", "nan_vertices", "inf_vertices", "min_x", "max_y")


@query(f"WITH {MESH} SELECT mesh_id, fid FROM m2 WHERE v0 % 50 <= 1 OR v1 % 50 <= 1 OR v2 % 50 <= 1")
def mesh_faces_on_bad_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.faces_on_bad_vertices(*_with_bad(spark, sf_dir))


@query(f"""WITH {MESH}, r AS (SELECT mesh_id // 64 AS m, mesh_id, vid, row_number() OVER (PARTITION BY mesh_id // 64 ORDER BY mesh_id, vid) - 1 AS n FROM v2m)
SELECT f.mesh_id // 64 AS mesh_id, f.fid, a.n AS v0, b.n AS v1, c.n AS v2 FROM m2 f JOIN r a ON f.mesh_id = a.mesh_id AND f.v0 = a.vid
JOIN r b ON f.mesh_id = b.mesh_id AND f.v1 = b.vid JOIN r c ON f.mesh_id = c.mesh_id AND f.v2 = c.vid""")
def mesh_concatenate(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, v = mesh.dense_reindex(*many_meshes(spark, sf_dir))
    many = lambda df: df.withColumn("part", F.col("mesh_id")).withColumn("mesh_id", F.expr("mesh_id div 64"))
    return mesh.concatenate(many(f), many(v), "part")[0].select("mesh_id", "fid", "v0", "v1", "v2")


@query(f"""WITH {MESH}, l AS (SELECT *, sqrt(nx*nx + ny*ny + nz*nz) AS ln FROM n2)
SELECT mesh_id, fid, CASE WHEN ln > 0 THEN round(nx / ln, 6) + 0 ELSE 0 END AS nx, CASE WHEN ln > 0 THEN round(ny / ln, 6) + 0 ELSE 0 END AS ny, CASE WHEN ln > 0 THEN round(nz / ln, 6) + 0 ELSE 0 END AS nz FROM l""")
def mesh_face_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = mesh.unit_normals(*many_meshes(spark, sf_dir))
    return n.withColumns({c: F.round(c, 6) + 0 for c in ("nx", "ny", "nz")})


@query(f"""WITH {MESH}, r AS (SELECT fid, row_number() OVER (ORDER BY fid) - 1 AS i, count(*) OVER () AS n FROM m1)
SELECT CAST(0 AS BIGINT) AS mesh_id, fid FROM r WHERE i IN (SELECT (k * ((SELECT count(*) FROM m1) - 1)) // (least(500, (SELECT count(*) FROM m1)) - 1) FROM range(500) t(k))""")
def thickness_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printable.sample_faces(one_mesh(spark, sf_dir)[0]).select("mesh_id", "fid")


@query(f"""WITH {MESH}, v AS (SELECT mesh_id, count(*) AS n_vertices FROM v2m GROUP BY 1), f AS (SELECT mesh_id, count(*) AS n_faces FROM m2 GROUP BY 1)
SELECT coalesce(v.mesh_id, f.mesh_id) AS mesh_id, coalesce(n_vertices, 0) AS n_vertices, coalesce(n_faces, 0) AS n_faces, coalesce(n_vertices, 0) >= 6 AND coalesce(n_faces, 0) >= 3 AS usable,
  CASE WHEN NOT (coalesce(n_vertices, 0) >= 6 AND coalesce(n_faces, 0) >= 3) THEN 'Mesh contains insufficient geometry: ' || coalesce(n_vertices, 0) || ' vertices, ' || coalesce(n_faces, 0) || ' faces.' END AS error
FROM v FULL JOIN f ON v.mesh_id = f.mesh_id""")
def mesh_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.usable(*many_meshes(spark, sf_dir), 6, 3)


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber IN (1, 2, 3, 4)""")
def scaling_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    q = F.when(n == 1, -F.col("l_quantity")).when(n == 2, float("nan")).when(n == 3, float("inf")).when(n == 4, None).otherwise(F.col("l_quantity"))
    return scaling.rejects(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", q.cast("double").alias("size")), "size").select("l_orderkey", "l_linenumber")


@query(f"""WITH {MESH}, m AS (SELECT l_orderkey AS mesh_id, median(l_quantity) AS md FROM lineitem GROUP BY 1), u AS (SELECT DISTINCT mesh_id FROM m2)
SELECT u.mesh_id, round(50 / md, 6) AS scale_factor, true AS verified FROM u JOIN m ON u.mesh_id = m.mesh_id""")
def scale_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("mesh_id"), F.col("l_quantity").alias("length"))
    est = scale_meshes(many_meshes(spark, sf_dir)[1], lengths, F.lit(50.0), (1.0, 2.0, 3.0))[1]
    return est.select("mesh_id", F.round("scale_factor", 6).alias("scale_factor"), "verified")
