"""Folders of mesh files through one operator to folders of mesh files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trivet.operators import clean, mesh, repair
from trivet.sources.meshfiles import list_meshes, read_meshes, write_meshes
from trivet.storage import cut

K = mesh.K
Work = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def rewrite(spark: SparkSession, source: str, folder: str, work: Work, ending: str = "_cleaned", kind: str = "obj") -> DataFrame:
    """Writes what `work` makes of (faces, vertices) to the URI `folder`, one file a mesh, named by its source's name and an ending.

    Returns a row for each source file: mesh_id, path, output, sha256, n_faces, status, error. Files
    with less than three vertices or without a face are `invalid` and not worked on, a mesh that
    loses all its faces is `empty`; neither is written. Of files with one name in any case, all but
    the first by path have their id in the name.
    """
    files = cut(list_meshes(spark, source).select(K, "path"), "files")
    faces, vertices = (cut(t.drop("path"), "files") for t in read_meshes(spark, source))
    size = cut(mesh.usable(faces, vertices), "files")
    good = size.where("usable").select(K)
    f, v = work(faces.join(good, K, "left_semi"), vertices.join(good, K, "left_semi"))
    stem = F.regexp_extract("path", r"([^/]*)\.[^./]+$", 1)
    first = F.row_number().over(Window.partitionBy(F.lower("stem")).orderBy("path")) == 1
    name = F.concat("stem", F.when(first, "").otherwise(F.concat(F.lit("_"), F.hex(K))), F.lit(ending))
    names = files.withColumn("stem", stem).withColumn("name", name).select(K, "name")
    done = cut(write_meshes(f.join(names, K), v, folder, kind, name="name").withColumnRenamed("path", "output"), "files")
    out = files.join(size.select(K, "usable", "error"), K, "left").join(done, K, "left")
    status = F.when(~F.coalesce("usable", F.lit(False)), "invalid").when(F.col("output").isNull(), "empty").otherwise("ok")
    return out.select(K, "path", "output", "sha256", "n_faces", status.alias("status"), F.when(F.col("usable").isNull(), mesh.TOO_FEW % (0, 0)).otherwise(F.col("error")).alias("error"))


def fill_holes(spark: SparkSession, source: str, folder: str, max_edges: int = 30, kind: str = "obj") -> DataFrame:
    """Closes holes of up to max_edges, then turns faces alike."""

    def work(f: DataFrame, v: DataFrame) -> tuple[DataFrame, DataFrame]:
        return repair.unify_winding(repair.repair(f, v, max_edges)[0], v), v

    return rewrite(spark, source, folder, work, kind=kind)


def unify_normals(spark: SparkSession, source: str, folder: str, kind: str = "obj") -> DataFrame:
    return rewrite(spark, source, folder, lambda f, v: (repair.unify_winding(f, v), v), kind=kind)


def remove_isolated_components(spark: SparkSession, source: str, folder: str, min_faces: int = 100, kind: str = "obj") -> DataFrame:
    """Components of less than min_faces go with their vertices; a mesh never loses all of them."""

    def work(f: DataFrame, v: DataFrame) -> tuple[DataFrame, DataFrame]:
        kept = cut(clean.filter_components(f, v, "min_faces", min_faces)[0], "kept")
        lost = mesh.orphan_vertices(kept, v).join(mesh.orphan_vertices(f, v).select(K, "vid"), [K, "vid"], "left_anti")
        return kept, v.join(lost.select(K, "vid"), [K, "vid"], "left_anti")

    return rewrite(spark, source, folder, work, kind=kind)


def remove_unreferenced_vertices(spark: SparkSession, source: str, folder: str, kind: str = "obj") -> DataFrame:
    """The fixed order of cleaning: bad vertices, invalid, flat and repeated faces, then vertices that no face names."""
    return rewrite(spark, source, folder, lambda f, v: clean.clean(f, v)[:2], kind=kind)
