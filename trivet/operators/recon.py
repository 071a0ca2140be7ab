"""Rules on the results of external reconstruction engines, which themselves are not run here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_model(models: DataFrame) -> DataFrame:
    """The model of each job with most images, then points, then files; the first path of equals."""
    tied = models.withColumn("_r", F.row_number().over(Window.partitionBy("job_id").orderBy(F.desc("images"), F.desc("points"), F.desc("files"), "path")))
    return tied.where("_r = 1").drop("_r")


def first_artifact(found: DataFrame, ladder: Column) -> DataFrame:
    """(job_id, path): the artifact of the smallest ladder rank (null ranks do not count), then directory rank, then path."""
    f = found.withColumn("_l", ladder).where("_l is not null and length > 0")
    return f.groupBy("job_id").agg(F.min_by("path", F.struct("_l", "dir_rank", "path")).alias("path"))


def registration(job: Column, count: Column, total: Column, digits: int, clamp: bool) -> Column:
    """count / total rounded; null without a total; one backend clamps at 1."""
    r = F.when(total > 0, F.round(count / total, digits))
    return F.least(F.lit(1.0), r) if clamp else r


def sfm_counts(body: Column) -> dict[str, Column]:
    """pose_count and ratio of a registration file: views and poses as lists or as objects; null if unreadable."""

    def size(name: str) -> Column:
        part = F.get_json_object(body, f"$.{name}")
        return F.coalesce(F.json_array_length(part), F.size(F.json_object_keys(part)))

    poses, views = size("poses"), size("views")
    ok = F.get_json_object(body, "$").isNotNull()
    n = F.when(ok, F.when(views > 0, F.coalesce(poses, F.lit(0))).otherwise(F.when(poses > 0, poses)))
    return {"pose_count": n, "ratio": F.when(ok & (views > 0), F.least(F.lit(1.0), F.round(F.coalesce(poses, F.lit(0)) / views, 3)))}


def status(frames: Column, registered: Column, dense: Column) -> Column:
    """process_failed below three registered frames; partial for 10 frames or more with under 35 %, unless dense succeeded.

    An unknown number of registered frames fails nothing.
    """
    thin = (frames >= 10) & (F.round(registered / frames, 4) < 0.35) & ~F.coalesce(dense, F.lit(False))
    return F.when(registered < 3, "process_failed").when(thin, "partial").otherwise("success")


#: Error kinds in the order in which they are tested, with the status each means.
ERRORS = (("timeout", "timeout"), ("binary_not_found", "binary_unavailable"), ("invalid_input", "invalid_input"), ("artifact_not_found", "artifact_missing"))


def status_of_error(kind: Column) -> Column:
    out = F.when(kind.isNull(), "success")
    for name, s in ERRORS:
        out = out.when(kind == name, s)
    return out.otherwise("process_failed")


#: The option prefixes that each subcommand of the engine takes.
PREFIXES = {
    "feature_extractor": ("--FeatureExtraction.", "--ImageReader.", "--SiftExtraction."),
    "exhaustive_matcher": ("--FeatureMatching.", "--ExhaustiveMatching.", "--SiftMatching."),
    "mapper": ("--Mapper.", "--IncrementalMapper."),
    "patch_match_stereo": ("--PatchMatchStereo.",),
    "stereo_fusion": ("--StereoFusion.",),
    "poisson_mesher": ("--PoissonMeshing.",),
    "delaunay_mesher": ("--DelaunayMeshing.",),
}


def options_of(subcommand: str, args: list[str]) -> list[str]:
    """The options meant for a subcommand, each with its value: `--<subcommand>.x` becomes `--x`, its known prefixes stay."""
    own, out = f"--{subcommand}.", []
    values = [*args[1:], "--"]
    for a, value in zip(args, values, strict=True):
        if not a.startswith((own, *PREFIXES.get(subcommand, ()))):
            continue
        out.append("--" + a.removeprefix(own) if a.startswith(own) else a)
        if not value.startswith("--"):
            out.append(value)
    return out


def count_matches(geometries: Column, matches: Column) -> Column:
    """Verified pairs, or raw ones where none is verified."""
    return F.coalesce(F.nullif(geometries, F.lit(0)), matches)


#: What a matcher prints when it has failed although it exits with 0.
FATAL = (
    "not enough gpu memory",
    "failed to create feature matcher",
    "failed to create sift gpu feature matcher",
    "cuda out of memory",
    "failed to initialize siftgpu",
    "siftgpu failed",
    "cuda error",
)


def fatal(text: Column) -> Column:
    out = F.lit(False)
    for t in FATAL:
        out = out | F.lower(text).contains(t)
    return out


def log_tail(lines: DataFrame, most: int = 20, key: str = "job_id", order: str = "line_no", text: str = "line") -> DataFrame:
    """(key, n_lines, tail): the last `most` lines of each log, in order. Only these leave the window, whatever a log's length."""
    last = Window.partitionBy(key).orderBy(F.desc(order))
    end = lines.withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= most)
    tail = end.groupBy(key).agg(F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"])).alias("tail"))
    return lines.groupBy(key).agg(F.count("*").alias("n_lines")).join(tail, key)


def can_run_dense(version_text: Column) -> Column:
    """Whether an engine has a GPU build, by what it prints about itself; an unreadable answer has none."""
    low = F.lower(version_text)
    return F.coalesce(~low.contains("without gpu support") & ~low.contains("without cuda"), F.lit(False))


def mapper_line(text: Column) -> dict[str, Column]:
    """Images and points of a line `Reconstruction with N images and M points`."""
    pat = r"Reconstruction with (\d+) images and (\d+) points"
    return {n: F.try_to_number(F.regexp_extract(text, pat, g), F.lit("999999999")).cast("long") for g, n in ((1, "images"), (2, "points"))}
