"""Mesh cleaning and component filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trivet.operators import mesh as M
from trivet.storage import cut

K = M.K


def clean(faces: DataFrame, vertices: DataFrame, area_threshold: float = 1e-7, degenerate: bool = True, duplicates: bool = True, orphans: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Faces, vertices and counters after the fixed order: bad vertices, invalid, degenerate, duplicate faces, orphans.

    Vertices with NaN or infinite coordinates go with their faces; faces that repeat a corner or name
    no vertex go; then faces without area, later copies of a face, and vertices that no face names.
    Vertex ids become dense in order of the old ones. Counters: one row a mesh.
    """
    faces, vertices = cut(faces, "clean"), cut(vertices, "clean")
    good = vertices.where(~M.bad_vertex())
    bad_v = vertices.where(M.bad_vertex())
    f1 = faces.join(M.faces_on_bad_vertices(faces, vertices), [K, "fid"], "left_anti")
    f2 = cut(f1.join(M.invalid_faces(f1, good), [K, "fid"], "left_anti"), "clean")
    f3 = M.corner_points(f2, good).where(~M.degenerate(area_threshold)).select(*f2.columns) if degenerate else f2
    f3 = cut(f3, "clean")
    f4 = cut(M.first_faces(f3), "clean") if duplicates else f3
    lone = M.orphan_vertices(f4, good)
    v2 = good.join(lone.select(K, "vid"), [K, "vid"], "left_anti") if orphans else good
    out_f, out_v = M.dense_reindex(f4, v2)

    def n(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(K).agg(F.count("*").alias(name))

    c = n(vertices, "vertices_before").join(n(faces, "faces_before"), K, "full")
    for df, name in ((bad_v, "bad_vertices"), (f1, "_f1"), (f2, "_f2"), (f3, "_f3"), (f4, "_f4"), (v2, "vertices_after")):
        c = c.join(n(df, name), K, "left")
    c = c.fillna(0)
    c = c.select(
        K, "vertices_before", "faces_before", "bad_vertices",
        (F.col("faces_before") - F.col("_f1")).alias("faces_on_bad_vertices"), (F.col("_f1") - F.col("_f2")).alias("invalid_removed"),
        (F.col("_f2") - F.col("_f3")).alias("degenerate_removed"), (F.col("_f3") - F.col("_f4")).alias("duplicates_removed"),
        (F.col("vertices_before") - F.col("bad_vertices") - F.col("vertices_after")).alias("orphans_removed"), "vertices_after", F.col("_f4").alias("faces_after"),
    )
    return out_f, out_v, c


def component_stats(faces: DataFrame, vertices: DataFrame, comp: DataFrame | None = None) -> DataFrame:
    """Vertices, faces, box and area of each face component (comp, where known), numbered by smallest fid."""
    f = cut(faces.join(comp or M.face_components(faces), [K, "fid"]), "parts")
    used = f.select(K, "component", F.explode(F.array("v0", "v1", "v2")).alias("vid")).distinct().join(vertices, [K, "vid"])
    box = [fn(a).alias(f"{n}_{a}") for n, fn in (("min", F.min), ("max", F.max)) for a in "xyz"]
    v = used.groupBy(K, "component").agg(F.count("*").alias("n_vertices"), *box)
    area = M.corner_points(f, vertices).groupBy(K, "component").agg(F.count("*").alias("n_faces"), F.sum(M.face_area()).alias("area"))
    return v.join(area, [K, "component"]).withColumn("idx", F.row_number().over(Window.partitionBy(K).orderBy("component")) - 1)


def keep_components(stats: DataFrame, strategy: str = "largest", min_faces: int = 100, min_ratio: float = 0.05) -> DataFrame:
    """Adds is_kept to component_stats; ties of the largest all stay, an unknown strategy is `largest`.

    A mesh never loses everything: if no component would stay, its first largest one does. A mesh
    with one component keeps it whatever the strategy.
    """
    w = Window.partitionBy(K)
    most, widest = F.max("n_faces").over(w), F.max("area").over(w)
    rule = {
        "keep_all": F.lit(True),
        "largest_by_area": F.col("area") == widest,
        "min_faces": F.col("n_faces") >= min_faces,
        "relative_threshold": F.col("n_faces") >= most * min_ratio,
    }.get(strategy, F.col("n_faces") == most)
    s = stats.withColumn("_k", rule | (F.count("*").over(w) == 1))
    first = F.row_number().over(w.orderBy(F.desc("n_faces"), "component")) == 1
    return s.withColumn("is_kept", F.col("_k") | (~F.max("_k").over(w) & first)).drop("_k")


def filter_components(faces: DataFrame, vertices: DataFrame, strategy: str = "largest", min_faces: int = 100, min_ratio: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """The faces of kept components, and one row of counts a mesh.

    A mesh with one component, or none since no faces touch, stays as it is, isolated faces included.
    """
    faces = cut(faces, "comps")
    comp = cut(M.face_components(faces), "comps")
    stats = cut(keep_components(component_stats(faces, vertices, comp), strategy, min_faces, min_ratio), "comps")
    several = stats.groupBy(K).agg(F.count("*").alias("components_before"), F.count_if("is_kept").alias("components_after"))
    kept = comp.join(stats.where("is_kept").select(K, "component"), [K, "component"], "left_semi").select(K, "fid")
    flat = faces.join(several.where("components_before > 1").select(K), K, "left_anti")
    out = faces.join(kept.join(several.where("components_before > 1").select(K), K, "left_semi"), [K, "fid"], "left_semi").unionByName(flat)
    counts = faces.groupBy(K).agg(F.count("*").alias("faces_before")).join(several, K, "left").join(out.groupBy(K).agg(F.count("*").alias("faces_after")), K, "left")
    return out, counts.select(
        K, F.coalesce("components_before", F.lit(1)).cast("long").alias("components_before"), F.coalesce("components_after", F.lit(1)).cast("long").alias("components_after"),
        "faces_before", "faces_after", F.greatest(F.lit(0), F.col("faces_before") - F.col("faces_after")).alias("removed_faces"),
    )
