"""The reports of a run, one JSON object a row with the fields, order and digits that their readers expect.

Each function takes a table with one row an object and returns (key, body); write it with df.write.text.
A column that the table does not have is written as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of the reports, in their order.
METADATA = ("file_name", "file_path", "file_size_bytes", "duration_seconds", "frame_count", "fps", "width", "height", "resolution", "codec")
FRAME_RESULT = ("filename", "sharpness", "brightness", "contrast", "is_blurry", "is_underexposed", "is_overexposed", "is_low_contrast", "is_redundant", "is_accepted", "rejection_reasons")
CAPTURE = (
    "run_id", "timestamp", "summary", "metadata", "selected_frames", "rejected_frames", "average_sharpness", "viewpoint_diversity_score", "guidance_notes", "selected_frames_dir", "frame_results",
)
RECONSTRUCTION = (
    "run_id", "timestamp", "backend", "status", "success", "input_frames", "registered_cameras", "registration_ratio", "point_count", "sparse_reconstruction", "point_cloud_path",
    "dense_point_cloud_path", "camera_poses_path", "mesh_generated", "mesh_path", "execution_time_seconds", "workspace_path", "workspace_dir", "log_path", "error_message",
)
GEOMETRY = (
    "success", "status", "input_mesh_path", "output_mesh_path", "execution_time_seconds", "vertex_count_before", "vertex_count_after", "face_count_before", "face_count_after",
    "component_count_before", "component_count_after", "removed_components", "degenerate_faces_before", "degenerate_faces_removed", "boundary_defects_before", "repairs_attempted",
    "repairs_successful", "remaining_boundary_defects", "stages_completed", "diagnostics_before", "diagnostics_after", "actions", "warnings", "error_message",
)
SCALING = (
    "status", "success", "input_mesh_path", "output_mesh_path", "scale_factor", "transformation_origin", "reference", "measurement", "scale_estimate", "bounds_before", "bounds_after",
    "vertex_count_before", "vertex_count_after", "face_count_before", "face_count_after", "execution_time_seconds", "warnings", "errors",
)
PRINTABILITY = ("is_watertight", "is_manifold", "min_wall_thickness_mm", "overhang_face_count", "is_printable", "warnings")
VALIDATION = ("target_name", "ground_truth_dimensions_mm", "reconstructed_dimensions_mm", "absolute_error_mm", "relative_error_pct", "tolerance_threshold_mm", "passed", "notes")

NONE = {"ignoreNullFields": "false"}


def _body(rows: DataFrame, key: str, names: tuple[str, ...], made: dict[str, Column] | None = None) -> DataFrame:
    made = made or {}
    cols = [(made[n] if n in made else F.col(n) if n in rows.columns else F.lit(None).cast("string")).alias(n) for n in names]
    return rows.select(key, F.to_json(F.struct(*cols), NONE).alias("body"))


def _round(rows: DataFrame, digits: dict[str, int]) -> dict[str, Column]:
    return {c: F.round(F.col(c).cast("double"), d) for c, d in digits.items() if c in rows.columns}


def metadata_report(videos: DataFrame, key: str = "video_id") -> DataFrame:
    """The container's data; `resolution` repeats width and height, a missing codec is `unknown`."""
    made = {"resolution": F.struct("width", "height"), "codec": F.coalesce("codec", F.lit("unknown")), "file_size_bytes": F.coalesce("file_size_bytes", F.lit(0))}
    return _body(videos, key, METADATA, made)


def capture_report(runs: DataFrame, frames: DataFrame, key: str = "video_id") -> DataFrame:
    """A run's summary (struct column `summary`, written twice) with the results of its frames in order of `seq`.

    frames: key, seq, is_accepted and what else FRAME_RESULT names. One run's frames meet in one row, as in the file.
    """
    each = F.struct("seq", F.struct(*[F.col(c) if c in frames.columns else F.lit(None).cast("string").alias(c) for c in FRAME_RESULT]).alias("r"))
    got = frames.groupBy(key).agg(F.sort_array(F.collect_list(each)).alias("_f"))
    rows = runs.join(got, key, "left").withColumn("_r", F.transform(F.coalesce("_f", F.array().cast(got.schema["_f"].dataType)), lambda x: x["r"]))
    pick = lambda ok: F.transform(F.filter("_r", lambda x: x["is_accepted"] == F.lit(ok)), lambda x: x["filename"])
    return _body(rows, key, CAPTURE, {"metadata": F.col("summary"), "selected_frames": pick(True), "rejected_frames": pick(False), "frame_results": F.col("_r")})


def reconstruction_report(jobs: DataFrame, key: str = "run_id") -> DataFrame:
    """A job's result; all fields may be null. mesh_generated: there is a mesh path whose file (`mesh_bytes`) is not empty."""
    made = {"mesh_generated": F.col("mesh_path").isNotNull() & (F.coalesce("mesh_bytes", F.lit(0)) > 0), "workspace_dir": F.col("workspace_path")}
    return _body(jobs, key, RECONSTRUCTION, made)


def diagnostics(d: DataFrame, name: str, key: str = "mesh_id") -> DataFrame:
    """(key, name): the rows of mesh.diagnose as one struct, areas, volumes, boxes and extents to four digits."""
    four = lambda c: F.round(c, 4)
    boxes = {"bounding_box_min": "min", "bounding_box_max": "max", "extents": "extent"}
    made = [F.array(*[four(f"{p}_{a}") for a in "xyz"]).alias(n) for n, p in boxes.items() if f"{p}_x" in d.columns]
    flat = {f"{p}_{a}" for p in boxes.values() for a in "xyz"} | {key}
    kinds = dict(d.dtypes)
    rest = [four(c).alias(c) if kinds[c] == "double" else F.col(c) for c in d.columns if c not in flat]
    return d.select(key, F.struct(*rest, *made).alias(name))


def geometry_report(meshes: DataFrame, key: str = "mesh_id") -> DataFrame:
    """A mesh's way through processing. Counters that the table lacks are 0; `actions` holds the structs components, cleanup, repair."""
    counts = {n: F.coalesce(n, F.lit(0)) if n in meshes.columns else F.lit(0) for n in GEOMETRY[5:18]}
    act = F.struct(*[F.col(c) if c in meshes.columns else F.lit(None).cast("string").alias(c) for c in ("components", "cleanup", "repair")])
    return _body(meshes, key, GEOMETRY, counts | _round(meshes, {"execution_time_seconds": 4}) | {"actions": act})


def scaling_report(meshes: DataFrame, key: str = "mesh_id") -> DataFrame:
    """A mesh's scaling: the factor to six digits, the origin and the seconds to four."""
    made = _round(meshes, {"scale_factor": 6, "execution_time_seconds": 4})
    if "transformation_origin" in meshes.columns:
        made["transformation_origin"] = F.transform("transformation_origin", lambda x: F.round(x, 4))
    return _body(meshes, key, SCALING, made)


def printability_report(meshes: DataFrame, key: str = "mesh_id") -> DataFrame:
    return _body(meshes, key, PRINTABILITY)


def validation_report(targets: DataFrame, key: str = "target_name") -> DataFrame:
    return _body(targets, key, VALIDATION)
