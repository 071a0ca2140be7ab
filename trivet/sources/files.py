"""Capture files as tables: videos, images, headers, models, registrations, hashes, artifacts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trivet.functions.scalars import file_name, fourcc, suffix

VIDEO_SUFFIXES = (".mp4", ".mov", ".m4v", ".avi", ".mkv")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) without reading content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def check_videos(files: DataFrame) -> DataFrame:
    """Adds `error`: null for a file that is not empty and has a video's suffix in any case."""
    known = suffix(F.col("path")).isin(*VIDEO_SUFFIXES)
    return files.withColumn("error", F.when(F.col("length") <= 0, "empty").when(~known, "unsupported_format"))


def video_metadata(videos: DataFrame) -> DataFrame:
    """Adds duration (count / fps, 3 digits), codec and `error`; a count of 0 or less with a readable frame is 1."""
    n = F.when(F.col("frame_count") > 0, F.col("frame_count")).when(F.col("readable"), F.lit(1).cast("long")) if "readable" in videos.columns else F.col("frame_count")
    v = videos.withColumn("frame_count", n)
    bad = F.when((F.col("width") <= 0) | (F.col("height") <= 0), "bad_size").when(F.col("fps") <= 0, "bad_fps").when(F.coalesce("frame_count", F.lit(0)) <= 0, "no_frames")
    return v.withColumns({"duration_seconds": F.when(F.col("fps") > 0, F.round(F.col("frame_count") / F.col("fps"), 3)), "codec": fourcc(F.col("fourcc")), "error": bad})


def ingest(videos: DataFrame, min_width: int = 0, min_height: int = 0) -> tuple[DataFrame, DataFrame]:
    """Videos that are sound and large enough, and the others with their error."""
    v = video_metadata(videos)
    small = F.when((F.col("width") < min_width) | (F.col("height") < min_height), "too_small")
    v = v.withColumn("error", F.coalesce("error", small))
    return v.where("error is null").drop("error"), v.where("error is not null")


def ply_counts(files: DataFrame, head: int = 65_536) -> DataFrame:
    """(path, n_vertices, n_faces, is_mesh) from the first bytes of binaryFile rows; nulls where there is no header."""
    text = F.decode(F.substring("content", 1, head), "ISO-8859-1")
    top = F.regexp_extract(text, r"(?s)^(ply\r?\n.*?)end_header", 1)

    def n(e: str) -> Column:
        return F.nullif(F.regexp_extract(top, rf"element {e} (\d+)", 1), F.lit("")).cast("long")

    return files.select("path", n("vertex").alias("n_vertices"), n("face").alias("n_faces")).withColumn("is_mesh", F.coalesce((F.col("n_vertices") > 0) & (F.col("n_faces") > 0), F.lit(False)))


def little_endian_u64(content: Column) -> Column:
    """The number in the first eight bytes of binary; null with fewer bytes or above the signed range."""
    backwards = F.concat(*[F.substring(F.hex(F.substring(content, 1, 8)), 15 - 2 * i, 2) for i in range(8)])
    return F.when(F.octet_length(content) >= 8, F.conv(backwards, 16, 10).cast("long"))


def model_stats(files: DataFrame) -> DataFrame:
    """(model, images, points): record counts of images and points3D files, binary before text.

    Binary files begin with their count; text files have a line a point and two lines an image,
    comments (#) and blank lines aside.
    """
    name = F.lower(file_name(F.col("path")))
    f = files.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("model"), name.alias("name"), "content")
    f = f.where(F.col("name").isin("images.bin", "points3d.bin", "images.txt", "points3d.txt"))
    lines = F.size(F.filter(F.split(F.decode("content", "UTF-8"), "\n"), lambda x: (F.trim(x) != "") & ~F.ltrim(x).startswith("#")))
    n = F.when(F.col("name").endswith(".bin"), little_endian_u64(F.col("content"))).when(F.col("name") == "images.txt", F.floor(lines / 2)).otherwise(lines)
    s = f.select("model", "name", n.cast("long").alias("n"))
    pick = lambda a: F.max(F.when(F.col("name") == a, F.col("n")))
    return s.groupBy("model").agg(
        F.coalesce(pick("images.bin"), pick("images.txt"), F.lit(0)).alias("images"), F.coalesce(pick("points3d.bin"), pick("points3d.txt"), F.lit(0)).alias("points")
    )


def database_matches(files: DataFrame) -> DataFrame:
    """(path, matches) of SQLite databases: pairs with rows in two_view_geometries, else in matches; 0 if unreadable.

    SQLite needs a file of its own, so each database is put into the task's temp folder while it is read.
    """
    import sqlite3
    import tempfile

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for raw in b["content"]:
                n = 0
                with tempfile.NamedTemporaryFile(suffix=".db") as f:
                    f.write(raw)
                    f.flush()
                    with sqlite3.connect(f.name) as db:
                        for t in ("two_view_geometries", "matches"):
                            try:
                                n = n or db.execute(f"select count(*) from {t} where rows > 0").fetchone()[0]
                            except sqlite3.DatabaseError:
                                continue
                    db.close()
                out.append(n)
            yield pd.DataFrame({"path": b["path"], "matches": out})

    return files.select("path", "content").mapInPandas(count, "path string, matches long")


def file_hashes(files: DataFrame) -> DataFrame:
    return files.select("path", F.sha2("content", 256).alias("sha256"))


#: Mesh file names in the order in which they are looked for.
MESH_NAMES = ("texturedMesh.obj", "texturedMesh.ply", "mesh.obj", "mesh.ply")


def mesh_rank(path: Column, dir_rank: Column) -> Column:
    """The rank of an artifact as the job's mesh, smaller first, null for no mesh.

    The known names directly in a searched directory come first, directory by directory; then any
    mesh deeper down that is no cloud or pose file: textured ones, filtered ones, the others.
    """
    name, low = file_name(path), F.lower(file_name(path))
    out = F.lit(None).cast("int")
    for k, known in reversed(list(enumerate(MESH_NAMES))):
        out = F.when(name == known, dir_rank * len(MESH_NAMES) + k).otherwise(out)
    mesh = suffix(path).isin(".obj", ".ply", ".stl") & ~low.contains("cloud") & ~low.contains("pose")
    later = F.when(mesh & low.contains("textured"), 1000).when(mesh & F.lower(path).contains("filter"), 1001).when(mesh, 1002)
    return F.coalesce(out, later)
