"""Mesh diagnostics on tables: vertices (mesh_id, vid, x, y, z) and faces (mesh_id, fid, v0, v1, v2).

All operators work on any number of meshes and return nothing for meshes without rows, unless said.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trivet.functions import vectors as V
from trivet.operators.graph import components
from trivet.storage import cut

K = "mesh_id"


def directed_edges(faces: DataFrame) -> DataFrame:
    """Three edges a face, in the face's direction: (mesh_id, fid, corner, u, v)."""
    pairs = F.array(*[F.struct(F.lit(i).alias("corner"), F.col(a).alias("u"), F.col(b).alias("v")) for i, (a, b) in enumerate((("v0", "v1"), ("v1", "v2"), ("v2", "v0")))])
    return faces.select(K, "fid", F.explode(pairs).alias("e")).select(K, "fid", "e.*")


def edge_counts(faces: DataFrame) -> DataFrame:
    """Undirected edges with the number of their faces: (mesh_id, lo, hi, c)."""
    e = directed_edges(faces).select(K, F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi"))
    return e.groupBy(K, "lo", "hi").agg(F.count("*").alias("c"))


def edge_stats(faces: DataFrame) -> DataFrame:
    """(mesh_id, n_edges, boundary_edges, non_manifold_edges, closed, edge_manifold).

    non_manifold_edges is the sum of the multiplicities above two, divided by three and rounded down;
    it is the number of such edges only where each has three faces.
    """
    c = F.col("c")
    return edge_counts(faces).groupBy(K).agg(
        F.count("*").alias("n_edges"),
        F.count_if(c == 1).alias("boundary_edges"),
        F.floor(F.coalesce(F.sum(F.when(c > 2, c)), F.lit(0)) / 3).cast("long").alias("non_manifold_edges"),
        ((F.min(c) == 2) & (F.max(c) == 2)).alias("closed"),
        (F.max(c) <= 2).alias("edge_manifold"),
    )


def sorted_corners() -> Column:
    return F.array_sort(F.array("v0", "v1", "v2"))


def duplicate_faces(faces: DataFrame) -> DataFrame:
    """Faces over distinct corner sets, winding aside: (mesh_id, n_faces, duplicates)."""
    kinds = faces.groupBy(K, sorted_corners().alias("t")).agg(F.count("*").alias("c"))
    return kinds.groupBy(K).agg(F.sum("c").alias("n_faces"), (F.sum("c") - F.count("*")).alias("duplicates"))


def first_faces(faces: DataFrame) -> DataFrame:
    """Of faces with equal corner sets the one with the smallest fid."""
    low = faces.groupBy(K, sorted_corners().alias("_t")).agg(F.min("fid").alias("fid")).select(K, "fid")
    return faces.join(low, [K, "fid"], "left_semi")


def repeats_corner() -> Column:
    return (F.col("v0") == F.col("v1")) | (F.col("v1") == F.col("v2")) | (F.col("v0") == F.col("v2"))


def invalid_faces(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Faces that repeat a corner or name a vertex that their mesh does not have (mesh_id, fid)."""
    corners = faces.select(K, "fid", F.explode(F.array("v0", "v1", "v2")).alias("vid"))
    lost = corners.join(vertices.select(K, "vid"), [K, "vid"], "left_anti").select(K, "fid")
    return faces.where(repeats_corner()).select(K, "fid").unionByName(lost).distinct()


def bad_vertex() -> Column:
    return V.not_finite(F.col("x")) | V.not_finite(F.col("y")) | V.not_finite(F.col("z"))


def faces_on_bad_vertices(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Faces with a corner whose coordinates are NaN or infinite: (mesh_id, fid)."""
    corners = faces.select(K, "fid", F.explode(F.array("v0", "v1", "v2")).alias("vid"))
    return corners.join(vertices.where(bad_vertex()).select(K, "vid"), [K, "vid"], "left_semi").select(K, "fid").distinct()


def corner_points(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Faces with the coordinates of their corners: x0, y0, z0, x1 and so on."""
    for i in range(3):
        p = vertices.select(K, F.col("vid").alias(f"v{i}"), *[F.col(a).alias(f"{a}{i}") for a in "xyz"])
        faces = faces.join(p, [K, f"v{i}"])
    return faces


def point(i: int) -> V.Vector:
    return tuple(F.col(f"{a}{i}") for a in "xyz")


def face_normal() -> V.Vector:
    """Not of unit length: its length is twice the area."""
    return V.cross(V.minus(point(1), point(0)), V.minus(point(2), point(0)))


def face_area() -> Column:
    return 0.5 * V.norm(face_normal())


def degenerate(threshold: float = 1e-7) -> Column:
    return F.isnan(face_area()) | (face_area() <= threshold)


def orphan_vertices(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Vertices that no face names."""
    used = faces.select(K, F.explode(F.array("v0", "v1", "v2")).alias("vid")).distinct()
    return vertices.join(used, [K, "vid"], "left_anti")


#: Fixed value: why a mesh cannot be worked on.
TOO_FEW = "Mesh contains insufficient geometry: %d vertices, %d faces."


def usable(faces: DataFrame, vertices: DataFrame, min_vertices: int = 3, min_faces: int = 1) -> DataFrame:
    """(mesh_id, n_vertices, n_faces, usable, error) for each mesh with a vertex or a face; error says what is too few."""
    v = vertices.groupBy(K).agg(F.count("*").alias("n_vertices"))
    f = faces.groupBy(K).agg(F.count("*").alias("n_faces"))
    n = v.join(f, K, "full").fillna(0)
    ok = (F.col("n_vertices") >= min_vertices) & (F.col("n_faces") >= min_faces)
    return n.withColumn("usable", ok).withColumn("error", F.when(~ok, F.format_string(TOO_FEW, "n_vertices", "n_faces")))


def numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """Adds the place of each row, from 0, in its mesh by the column `by`.

    Rows are dealt by ranges of (mesh_id, by) and numbered within a range from the count of the mesh's
    rows in the ranges before, so that no task holds a large mesh.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut(df.repartitionByRange(parts, K, by).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(K).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(K, "_part").agg(F.count("*").alias("_c")).select(K, "_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(K, "_part").orderBy(by)).cast("long") - 1
    return dealt.withColumn("_place", place).join(starts, [K, "_part"]).withColumn(name, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")


def dense_reindex(faces: DataFrame, vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New vertex ids from 0 in order of the old ones; faces follow, and keep their fid."""
    rank = numbered(vertices, "vid", "new")
    out = faces
    for i in range(3):
        out = out.join(rank.select(K, F.col("vid").alias(f"v{i}"), F.col("new").alias(f"n{i}")), [K, f"v{i}"])
    return out.select(K, "fid", *[F.col(f"n{i}").alias(f"v{i}") for i in range(3)]), rank.select(K, F.col("new").alias("vid"), "x", "y", "z")


def concatenate(faces: DataFrame, vertices: DataFrame, part: str) -> tuple[DataFrame, DataFrame]:
    """The geometries (column `part`) of a mesh as one, in order of `part`: ids from 0 in each move behind those before.

    Only the counts of a mesh's geometries meet in a task, not their rows.
    """
    before = Window.partitionBy(K).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    start = vertices.groupBy(K, part).agg((F.max("vid") + 1).alias("_n")).select(K, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    f, v = faces.join(start, [K, part]), vertices.join(start, [K, part])
    return f.withColumns({c: F.col(c) + F.col("_o") for c in ("v0", "v1", "v2")}).drop("_o", part), v.withColumn("vid", F.col("vid") + F.col("_o")).drop("_o", part)


def unit_normals(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """(mesh_id, fid, nx, ny, nz): normals of length 1; zeros for a face without area. Coordinates do not move."""
    n, size = face_normal(), V.norm(face_normal())
    return corner_points(faces, vertices).select(K, "fid", *[F.when(size > 0, c / size).otherwise(0.0).alias(f"n{a}") for a, c in zip("xyz", n, strict=True)])


def add_warnings(old: Column, new: Column) -> Column:
    """`old` with those of `new` behind it that it does not hold yet, in their order; null lists are empty."""
    none = F.array().cast("array<string>")
    return F.aggregate(F.coalesce(new, none), F.coalesce(old, none), lambda have, w: F.when(F.array_contains(have, w), have).otherwise(F.array_append(have, w)))


def vertex_stats(vertices: DataFrame) -> DataFrame:
    """Counts of vertices, NaN and infinite ones, and the box of the finite ones (zeros if none)."""
    nan = F.isnan("x") | F.isnan("y") | F.isnan("z")
    inf = (F.abs("x") == float("inf")) | (F.abs("y") == float("inf")) | (F.abs("z") == float("inf"))
    ok = ~(nan | inf)
    box = [f(F.when(ok, F.col(a))).alias(f"{n}_{a}") for n, f in (("min", F.min), ("max", F.max)) for a in "xyz"]
    s = vertices.groupBy(K).agg(F.count("*").alias("n_vertices"), F.count_if(nan).alias("nan_vertices"), F.count_if(inf).alias("inf_vertices"), *box)
    s = s.withColumns({f"{n}_{a}": F.coalesce(F.col(f"{n}_{a}"), F.lit(0.0)) for n in ("min", "max") for a in "xyz"})
    return s.withColumns({f"extent_{a}": F.col(f"max_{a}") - F.col(f"min_{a}") for a in "xyz"})


def area_volume(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Total area and signed volume of each mesh."""
    p = corner_points(faces, vertices)
    return p.groupBy(K).agg(F.sum(face_area()).alias("area"), F.sum(V.dot(point(0), V.cross(point(1), point(2))) / 6).alias("volume"))


def adjacency(faces: DataFrame) -> DataFrame:
    """Pairs of faces that share an edge of exactly two faces: (mesh_id, a, b), a < b.

    Both faces come out of the edge's own aggregate, so no self-join is needed.
    """
    e = directed_edges(faces).select(K, "fid", F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi"))
    two = e.groupBy(K, "lo", "hi").agg(F.count("*").alias("c"), F.min("fid").alias("a"), F.max("fid").alias("b"))
    return two.where("c = 2 and a < b").select(K, "a", "b").distinct()


def face_components(faces: DataFrame) -> DataFrame:
    """Components over face adjacency (mesh_id, fid, component): isolated faces are no nodes and not returned."""
    return components(adjacency(faces), K).select(K, F.col("id").alias("fid"), "component")


def component_counts(faces: DataFrame) -> DataFrame:
    """(mesh_id, component_count): the face count where no two faces are adjacent."""
    comp = face_components(faces).groupBy(K).agg(F.countDistinct("component").alias("n"))
    return faces.groupBy(K).agg(F.count("*").alias("f")).join(comp, K, "left").select(K, F.coalesce("n", "f").alias("component_count"))


def consistent_winding(faces: DataFrame) -> DataFrame:
    """Whether no directed edge of a mesh occurs twice: (mesh_id, consistent)."""
    return directed_edges(faces).groupBy(K, "u", "v").agg(F.count("*").alias("c")).groupBy(K).agg((F.max("c") == 1).alias("consistent"))


def vertex_manifold(faces: DataFrame) -> DataFrame:
    """(mesh_id, vertex_manifold): the faces around each vertex form one closed or open fan.

    Around a vertex each face is an edge between its other two corners. With all edges in two faces
    at most, every degree in that link is 1 or 2, so the link is a union of paths and cycles; it is
    one piece if it is connected, which the component count of the links tells.
    """
    flags = faces.groupBy(K).agg((~F.bool_or(repeats_corner())).alias("plain")).join(edge_counts(faces).groupBy(K).agg((F.max("c") <= 2).alias("thin")), K)
    links = faces.where(~repeats_corner()).select(
        K, F.explode(F.array(*[F.struct(F.col(f"v{i}").alias("at"), F.col(f"v{(i + 1) % 3}").alias("a"), F.col(f"v{(i + 2) % 3}").alias("b")) for i in range(3)])).alias("l")
    ).select(F.struct(K, "l.at").alias("link"), "l.a", "l.b")
    ends = links.select("link", F.explode(F.array("a", "b")).alias("n")).distinct().groupBy("link").agg(F.count("*").alias("nodes"))
    edges = links.select("link", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    comp = components(edges, "link").groupBy("link").agg(F.countDistinct("component").alias("pieces"))
    degree = edges.select("link", F.explode(F.array("a", "b")).alias("n")).groupBy("link", "n").agg(F.count("*").alias("d"))
    shape = degree.groupBy("link").agg(F.max("d").alias("most"), F.count_if(F.col("d") == 1).alias("ends"))
    good = ends.join(comp, "link").join(shape, "link").select(F.col(f"link.{K}").alias(K), ((F.col("pieces") == 1) & (F.col("most") <= 2) & F.col("ends").isin(0, 2)).alias("ok"))
    return flags.join(good.groupBy(K).agg(F.bool_and("ok").alias("fans")), K, "left").select(K, (F.col("plain") & F.col("thin") & F.coalesce("fans", F.lit(False))).alias("vertex_manifold"))


def diagnose(faces: DataFrame, vertices: DataFrame, area_threshold: float = 1e-7, loops: DataFrame | None = None) -> DataFrame:
    """One row a mesh with all counts, status, warnings and errors.

    Checks are gated: with an invalid face, edges, duplicates and orphans are not counted (0), nor
    are degenerate faces, and with a NaN vertex neither components (1), area nor volume. A mesh
    without a vertex or face is an error. `loops` (mesh_id, boundary_loops) is joined if given.
    """
    base = vertex_stats(vertices).join(faces.groupBy(K).agg(F.count("*").alias("n_faces")), K, "full")
    parts = (
        invalid_faces(faces, vertices).groupBy(K).agg(F.count("*").alias("invalid_faces")),
        corner_points(faces, vertices).groupBy(K).agg(F.count_if(degenerate(area_threshold)).alias("_degenerate"), F.sum(face_area()).alias("_area"), F.sum(V.dot(point(0), V.cross(point(1), point(2))) / 6).alias("_volume")),
        duplicate_faces(faces).select(K, F.col("duplicates").alias("_duplicates")),
        orphan_vertices(faces, vertices).groupBy(K).agg(F.count("*").alias("_orphans")),
        edge_stats(faces),
        consistent_winding(faces),
        component_counts(faces),
    )
    for p in parts:
        base = base.join(p, K, "left")
    if loops is not None:
        base = base.join(loops.select(K, F.col("boundary_loops").alias("_loops")), K, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    d = base.withColumns({c: zero(c) for c in ("n_vertices", "n_faces", "nan_vertices", "inf_vertices", "invalid_faces")})
    some = (F.col("n_vertices") > 0) & (F.col("n_faces") > 0)
    sound = some & (F.col("invalid_faces") == 0)
    whole = sound & (F.col("nan_vertices") == 0)
    count = lambda gate, c: F.when(gate, zero(c)).otherwise(F.lit(0).cast("long"))
    d = d.withColumns(
        {
            "degenerate_faces": count(whole & (F.col("inf_vertices") == 0), "_degenerate"),
            "duplicate_faces": count(sound, "_duplicates"),
            "unreferenced_vertices": count(sound, "_orphans"),
            "boundary_edge_count": count(sound, "boundary_edges"),
            "boundary_loop_count": count(sound, "_loops") if loops is not None else F.lit(None).cast("long"),
            "non_manifold_edge_count": count(sound, "non_manifold_edges"),
            "components": F.when(whole, F.coalesce("component_count", F.lit(1))).otherwise(F.lit(1)).cast("long"),
            "surface_area": F.when(whole & (F.col("_area") > 0) & ~F.isnan("_area"), F.col("_area")),
            "euler": F.when(some, F.col("n_vertices") - zero("n_edges") + F.col("n_faces")).otherwise(F.lit(0).cast("long")),
            "is_watertight": F.coalesce(F.col("closed"), F.lit(False)) & sound,
            "is_winding_consistent": F.coalesce(F.col("consistent"), F.lit(False)),
        }
    )
    shut = whole & F.col("is_watertight") & (F.col("_volume") > 0)
    d = d.withColumn("solid_volume", F.when(shut, F.col("_volume")))

    def said(cond: Column, text: str, c: str) -> Column:
        return F.when(cond, F.format_string(text, F.col(c)))

    errors = F.filter(
        F.array(
            F.when(~some, F.lit("Mesh has no vertices or no faces.")),
            said(F.col("nan_vertices") > 0, "%d vertices have NaN coordinates.", "nan_vertices"),
            said(F.col("inf_vertices") > 0, "%d vertices have infinite coordinates.", "inf_vertices"),
            said(F.col("invalid_faces") > 0, "%d faces are invalid.", "invalid_faces"),
        ),
        lambda x: x.isNotNull(),
    )
    warnings = F.filter(
        F.array(
            said(F.col("degenerate_faces") > 0, "%d faces have no area.", "degenerate_faces"),
            said(F.col("duplicate_faces") > 0, "%d faces are duplicates.", "duplicate_faces"),
            said(F.col("unreferenced_vertices") > 0, "%d vertices belong to no face.", "unreferenced_vertices"),
            said(F.col("boundary_edge_count") > 0, "The surface is open at %d edges.", "boundary_edge_count"),
            said(F.col("non_manifold_edge_count") > 0, "%d edges are not manifold.", "non_manifold_edge_count"),
            said(F.col("components") > 1, "The mesh has %d components.", "components"),
        ),
        lambda x: x.isNotNull(),
    )
    d = d.withColumn("errors", errors).withColumn("warnings", warnings)
    d = d.withColumn("status", F.when(F.size("errors") > 0, "ERROR").when(F.size("warnings") > 0, "WARNING").otherwise("VALID"))
    box = [f"{n}_{a}" for n in ("min", "max", "extent") for a in "xyz"]
    return d.select(
        K, "n_vertices", "n_faces", *box, "surface_area", F.col("solid_volume").alias("volume"), F.col("components").alias("component_count"), "boundary_edge_count", "boundary_loop_count",
        "non_manifold_edge_count", "is_watertight", "is_winding_consistent", F.col("euler").alias("euler_characteristic"), "nan_vertices", "inf_vertices",
        "invalid_faces", "degenerate_faces", "duplicate_faces", "unreferenced_vertices", "status", "warnings", "errors",
    )
