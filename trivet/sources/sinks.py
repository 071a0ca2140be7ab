"""Reports and manifests as JSON or Markdown columns, one row an object; write them with df.write.text or .json."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frame_manifest(videos: DataFrame, frames: DataFrame) -> DataFrame:
    """(video_id, body): the header of a video and its frames in source order."""
    f = frames.groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("source_frame_index", "filename", "timestamp_seconds"))).alias("frames"), F.count("*").alias("extracted_count"))
    cols = [c for c in videos.columns if c != "video_id"]
    return videos.join(f, "video_id", "left").select("video_id", F.to_json(F.struct("video_id", *cols, F.coalesce("extracted_count", F.lit(0)).alias("extracted_count"), "frames")).alias("body"))


def report(rows: DataFrame, key: str, digits: dict[str, int] | None = None) -> DataFrame:
    """(key, body): a row as one JSON object, doubles rounded as `digits` says; nulls are written as nulls."""
    cols = [F.round(c, digits[c]).alias(c) if digits and c in digits else F.col(c) for c in rows.columns]
    return rows.select(key, F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("body"))


def build_manifest(rows: DataFrame) -> DataFrame:
    """(project_name, body) for rows with stl_filename, content, width, depth, height, volume, is_watertight, scale_factor, created_at."""
    return rows.select(
        "project_name",
        F.to_json(
            F.struct(
                "project_name", "stl_filename", F.sha2("content", 256).alias("file_sha256"), F.array("width", "depth", "height").alias("bounding_box_mm"), F.col("volume").alias("volume_mm3"),
                "is_watertight", F.col("scale_factor").alias("scale_factor_applied"), F.lit("mm").alias("units"), "created_at",
            )
        ).alias("body"),
    )


def job_summary(name: Column, model: Column, digest: Column, size: tuple[Column, Column, Column], volume: Column, tight: Column, scale: Column, made: Column, units: str = "mm") -> Column:
    """A Markdown summary for the operator of a printer."""
    return F.format_string(
        "# Manufacturing Job Summary\n\n- **Project**: %s\n- **Model**: `%s`\n- **SHA-256**: `%s`\n"
        f"- **Bounding Box**: %.2f x %.2f x %.2f {units}\n- **Volume**: %.2f {units}^3\n- **Watertight**: %s\n- **Scale Multiplier**: %.6f\n- **Generated At**: %s\n",
        name, model, digest, *size, volume, F.when(tight, "YES").otherwise("NO"), scale, made,
    )


def copy_names(selected: DataFrame, key: str = "video_id", path: str = "path") -> DataFrame:
    """Adds `copy_name`: the file name, with a running number in front where another of the key has it in any case."""
    from pyspark.sql import Window

    name = F.regexp_extract(path, r"([^/]*)$", 1)
    s = selected.withColumn("_n", name)
    rank = F.row_number().over(Window.partitionBy(key, F.lower("_n")).orderBy(path)) - 1
    order = F.row_number().over(Window.partitionBy(key).orderBy(path)) - 1
    return s.withColumn("_r", rank).withColumn("_o", order).withColumn("copy_name", F.when(F.col("_r") > 0, F.format_string("%05d_%s", "_o", "_n")).otherwise(F.col("_n"))).drop("_n", "_r", "_o")
