"""Frame quality on tables: stride, gates, totals, guidance, folds, coverage, buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = "video_id"


def stride(videos: DataFrame, interval: Column, target_fps: Column | None, max_frames: Column) -> DataFrame:
    """Adds `step`: every step-th frame of (frame_count, fps) is kept, at most max_frames of them.

    step is the interval, or round(fps / target) (half to even) where a target below fps is given; a
    known count that would still pass max_frames widens it to count div max_frames at least. An fps of
    0 or less counts as 30.
    """
    fps = F.when(F.col("fps") > 0, F.col("fps")).otherwise(30.0)
    step = F.greatest(F.lit(1), interval)
    if target_fps is not None:
        step = F.when((target_fps > 0) & (fps > target_fps), F.greatest(F.lit(1), F.bround(fps / target_fps, 0).cast("int"))).otherwise(step)
    v = videos.withColumn("_s", step.cast("long")).withColumn("_m", max_frames)
    wide = (F.col("frame_count") > 0) & (F.col("_m") > 0) & (F.ceil(F.col("frame_count") / F.col("_s")) > F.col("_m"))
    return v.withColumn("step", F.when(wide, F.greatest(F.col("_s"), F.expr("frame_count div _m"), F.lit(1))).otherwise(F.col("_s"))).drop("_s", "_m")


def extract_rows(videos: DataFrame, max_frames: int) -> DataFrame:
    """Frame rows of strided videos: (video_id, source_frame_index, seq, filename, timestamp_seconds)."""
    last = F.least(F.col("frame_count") - 1, F.col("step") * (max_frames - 1))
    f = videos.where("frame_count > 0").select(K, "fps", F.explode(F.sequence(F.lit(0).cast("long"), last, F.col("step"))).alias("source_frame_index"), "step")
    fps = F.when(F.col("fps") > 0, F.col("fps")).otherwise(30.0)
    return f.select(
        K, "source_frame_index", F.expr("source_frame_index div step").alias("seq"),
        F.format_string("frame_%06d.jpg", "source_frame_index").alias("filename"), F.round(F.col("source_frame_index") / fps, 4).alias("timestamp_seconds"),
    )


def gate(
    frames: DataFrame, sharpness: float = 100.0, dark: float = 30.0, bright: float = 235.0, contrast: float = 15.0, texture: float = 10.0, redundancy: float = 0.98
) -> DataFrame:
    """Adds the flags, `reasons` in fixed order, and `accepted` (no reason).

    Flags compare unrounded values. `similarity` (to the last accepted frame, null for none) makes the
    redundancy flag where the column exists. The printed limits of exposure and contrast are those set.
    """
    s, b, c = F.col("sharpness"), F.col("brightness"), F.col("contrast")
    again = F.col("similarity") >= redundancy if "similarity" in frames.columns else F.lit(False)
    f = frames.withColumns(
        {
            "is_blurry": s < sharpness, "is_underexposed": b < dark, "is_overexposed": b > bright, "is_low_contrast": c < contrast,
            "is_low_texture": s < texture, "is_redundant": F.coalesce(again, F.lit(False)),
        }
    )
    text = [
        ("is_blurry", F.format_string(f"Low sharpness (%.1f < threshold {sharpness:.1f})", s)),
        ("is_underexposed", F.format_string(f"Underexposed (brightness %.1f < {dark:.1f})", b)),
        ("is_overexposed", F.format_string(f"Overexposed (brightness %.1f > {bright:.1f})", b)),
        ("is_low_contrast", F.format_string(f"Low contrast (std dev %.1f < {contrast:.1f})", c)),
        ("is_low_texture", F.format_string(f"Low visible detail (heuristic score %.1f < threshold {texture:.1f})", s)),
    ]
    if "similarity" in frames.columns:
        text.append(("is_redundant", F.format_string(f"Redundant frame (similarity %.3f >= threshold {redundancy:.3f})", "similarity")))
    f = f.withColumn("reasons", F.filter(F.array(*[F.when(F.col(c), t) for c, t in text]), lambda x: x.isNotNull()))
    return f.withColumn("accepted", F.size("reasons") == 0)


def totals(gated: DataFrame) -> DataFrame:
    """Counts and ratios of each video; the counts overlap, the mean sharpness is of rounded values."""
    n = F.count("*")
    t = gated.groupBy(K).agg(
        n.alias("n_frames"), F.count_if("accepted").alias("selected"), F.count_if("is_blurry").alias("blurry"),
        F.count_if(F.col("is_underexposed") | F.col("is_overexposed") | F.col("is_low_contrast")).alias("exposure"),
        F.count_if("is_low_texture").alias("low_texture"), F.count_if("is_redundant").alias("redundant"), F.avg(F.round("sharpness", 2)).alias("average_sharpness"),
    )
    per = lambda c: F.col(c) / F.greatest(F.lit(1), F.col("n_frames"))
    return t.withColumns({"blur_ratio": per("blurry"), "exposure_ratio": per("exposure"), "redundancy_ratio": per("redundant"), "diversity": F.round(per("selected"), 3)})


#: Fixed texts of the recommendations.
MORE_SLOWLY = "High motion blur detected. Move the camera more slowly around the object."
STEADIER = "Moderate motion blur observed in several frames. Stabilize camera movement."
FARTHER = "Many frames are nearly identical. Move the camera farther between captures."
LIGHT = "Poor exposure or low contrast detected in multiple frames. Improve scene lighting."
ORBIT = "Low frame diversity detected. Ensure a continuous orbital trajectory around the target."
NO_ISSUE = (
    "No major issues detected by the current capture checks. This assessment does not guarantee successful 3D reconstruction; "
    "review viewpoint coverage and reconstruction results."
)


def guidance(blur: Column, exposure: Column, redundancy: Column, coverage: Column) -> Column:
    notes = F.filter(
        F.array(F.when(blur > 0.4, MORE_SLOWLY).when(blur > 0.2, STEADIER), F.when(redundancy > 0.5, FARTHER), F.when(exposure > 0.3, LIGHT), F.when(coverage < 0.6, ORBIT)),
        lambda x: x.isNotNull(),
    )
    return F.when(F.size(notes) == 0, F.array(F.lit(NO_ISSUE))).otherwise(notes)


def similarity(a: Column, b: Column, full: float = 255.0) -> Column:
    """1 - mean(abs(a - b)) / full over two arrays."""
    return 1 - F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x) / F.size(a) / full


def fold_redundant(thumbs: DataFrame, threshold: float = 0.98, full: float = 255.0) -> DataFrame:
    """Keeps a frame if it differs from the last one kept: (video_id, seq, similarity, accepted).

    The state is one thumbnail a video; rows come in order of seq, one video in memory at a time by
    its Arrow batches, and a rejected frame does not replace the state. The first frame is kept.
    """
    import numpy as np
    import pyarrow as pa

    def fold(batches):
        video, state = None, None
        for b in batches:
            v, t = b.column(0).to_pylist(), b.column(2)
            sims, oks = [], []
            for i in range(b.num_rows):
                x = np.asarray(t[i].values.to_numpy(zero_copy_only=False), np.float64)
                if v[i] != video:
                    video, state = v[i], None
                sim = None if state is None else 1.0 - float(np.abs(x - state).sum()) / len(x) / full
                ok = sim is None or sim < threshold
                state = x if ok else state
                sims.append(sim)
                oks.append(ok)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sims, pa.float64()), pa.array(oks)], names=["video_id", "seq", "similarity", "accepted"])

    n = int(thumbs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = thumbs.select(K, "seq", "thumb").repartition(n, K).sortWithinPartitions(K, "seq")
    return t.mapInArrow(fold, "video_id long, seq long, similarity double, accepted boolean")


def coverage(thumbs: DataFrame, full: float = 255.0) -> DataFrame:
    """min(1, 4 * mean difference of consecutive thumbnails), 3 digits; 0.1 with one readable frame."""
    w = Window.partitionBy(K).orderBy("seq")
    d = thumbs.withColumn("_p", F.lag("thumb").over(w)).select(K, (1 - similarity(F.col("thumb"), F.col("_p"), full)).alias("d"))
    return d.groupBy(K).agg(F.when(F.count("*") < 2, 0.1).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 4 * F.avg("d"))), 3)).alias("coverage"))


def buckets(frames: DataFrame, budget: int, graph: bool = True) -> DataFrame:
    """Adds n, n_buckets and bucket: temporal sectors [b n / B, (b + 1) n / B) with truncated bounds.

    B is max(2, 3/4 of the budget) with a match graph and a budget of 3 or more, else the budget;
    never above n. The bucket follows from seq by arithmetic, then is corrected to the truncated bound.
    """
    n = F.count("*").over(Window.partitionBy(K))
    f = frames.withColumn("n", n)
    own = F.least(F.lit(budget).cast("long"), F.col("n"))
    many = F.when(own >= 3, F.greatest(F.lit(2).cast("long"), F.floor(own * 0.75))).otherwise(own) if graph else own
    f = f.withColumn("n_buckets", F.least(many, F.col("n")))
    width = F.col("n") / F.col("n_buckets")
    guess = F.least(F.floor(F.col("seq") / width), F.col("n_buckets") - 1)
    up = F.least(guess + 1, F.col("n_buckets") - 1)
    return f.withColumn("bucket", F.when(F.col("seq") >= F.floor(up * width), up).when(F.col("seq") < F.floor(guess * width), guess - 1).otherwise(guess).cast("long"))


def severe(keypoints: Column | None = None) -> Column:
    """Frames of no use: dark, bright or flat, and with few keypoints where these are given."""
    bad = (F.col("brightness") < 10) | (F.col("brightness") > 248) | (F.col("contrast") < 5)
    return bad if keypoints is None else bad | (keypoints < 8)


def optical_score(is_severe: Column, keypoints: Column, grid: Column, threshold: float = 100.0) -> Column:
    one = F.lit(1.0)
    s = 0.4 * F.least(one, F.col("sharpness") / max(1.0, threshold)) + 0.3 * F.least(one, F.col("contrast") / 50) + 0.3 * F.least(one, keypoints / 250.0) * F.greatest(F.lit(0.2), grid)
    return F.round(F.when(is_severe, 0.05).otherwise(s), 3)


def grid_coverage(keypoints: Column, width: Column, height: Column) -> Column:
    """Share of the cells of a 3 x 3 grid that hold a keypoint (array of struct x, y)."""
    cw, ch = F.greatest(F.lit(1), F.expr("1") * F.floor(width / 3)), F.greatest(F.lit(1), F.floor(height / 3))
    cell = lambda p: F.least(F.lit(2), F.floor(p["y"] / ch)) * 3 + F.least(F.lit(2), F.floor(p["x"] / cw))
    return F.size(F.array_distinct(F.transform(keypoints, cell))) / 9.0
