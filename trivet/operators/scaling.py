"""Reference measurements, scale estimates, marker edges and ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trivet.functions import vectors as V


def positive(x: Column, what: str) -> Column:
    """x where it is finite and above 0, else an error."""
    return F.when(x.isNotNull() & ~V.not_finite(x) & (x > 0), x).otherwise(F.raise_error(F.lit(f"{what} must be finite and above 0")).cast("double"))


def rejects(obs: DataFrame, value: str) -> DataFrame:
    """The observations that `positive` would refuse."""
    x = F.col(value)
    return obs.where(x.isNull() | V.not_finite(x) | (x <= 0))


def measure(obs: DataFrame, key: str, value: str) -> DataFrame:
    """(key, mean, median, std_dev, min_val, max_val, spread, measurement_count): population deviation."""
    x = positive(F.col(value), "an observation")
    m = obs.select(key, x.alias("x")).groupBy(key).agg(
        F.avg("x").alias("mean"), F.median("x").alias("median"), F.stddev_pop("x").alias("std_dev"), F.min("x").alias("min_val"), F.max("x").alias("max_val"), F.count("x").alias("measurement_count")
    )
    return m.withColumn("spread", F.col("max_val") - F.col("min_val"))


def estimate(measured: DataFrame, known_mm: Column) -> DataFrame:
    """Adds scale_factor (known / median), variance and confidence (1 - deviation / mean, within 0 and 1)."""
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("std_dev") / F.col("mean")))
    return measured.withColumns(
        {"scale_factor": positive(known_mm, "the known size") / F.col("median"), "variance": F.col("std_dev") * F.col("std_dev"), "confidence": F.when(F.col("mean") > 0, share).otherwise(0.0)}
    )


def mean_scale(obs: DataFrame, key: str, value: str, known_mm: float) -> DataFrame:
    """The older calibration: known size over the mean."""
    return obs.groupBy(key).agg((F.lit(float(known_mm)) / F.avg(positive(F.col(value), "an observation"))).alias("scale_factor"))


def marker_edges(corners: Column) -> Column:
    """The four side lengths of a marker (array of four struct x, y): perimeter order, closed."""
    side = lambda i: F.hypot(F.get(corners, (i + 1) % 4)["x"] - F.get(corners, i)["x"], F.get(corners, (i + 1) % 4)["y"] - F.get(corners, i)["y"])
    return F.array(*[side(i) for i in range(4)])


def observations(markers: DataFrame, marker_id: int | None = None, dictionary: str = "DICT_4X4_50") -> DataFrame:
    """Found markers of one dictionary, of one id where it is given, with their four side lengths (edge_lengths_2d).

    markers: marker_id, dictionary, corners (array of struct x, y) and what else. Without four corners the lengths are null.
    """
    from trivet.config import marker_dictionary

    m = markers.where(F.col("dictionary") == marker_dictionary(dictionary))
    m = m if marker_id is None else m.where(F.col("marker_id") == marker_id)
    return m.withColumn("edge_lengths_2d", F.when(F.size("corners") == 4, marker_edges(F.col("corners"))))


def corner_lengths(corners: Column) -> Column:
    """The four side lengths of a marker in space (array of struct x, y, z); other than four finite points are an error."""
    at = lambda i: tuple(F.get(corners, i)[a] for a in "xyz")
    bad = (F.size(corners) != 4) | F.exists(corners, lambda p: V.not_finite(p["x"]) | V.not_finite(p["y"]) | V.not_finite(p["z"]))
    return F.when(bad, F.raise_error(F.lit("a marker needs four finite corners")).cast("array<double>")).otherwise(F.array(*[V.distance(at((i + 1) % 4), at(i)) for i in range(4)]))


def scale_vertices(vertices: DataFrame, factors: DataFrame, origin: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """Vertices scaled about an origin by their mesh's factor (mesh_id, factor); faces stay as they are."""
    p = tuple(F.col(a) for a in "xyz")
    s = V.scale_about(p, positive(F.col("factor"), "a factor"), tuple(F.lit(float(o)) for o in origin))
    return vertices.join(factors, "mesh_id").select("mesh_id", "vid", *[c.alias(a) for c, a in zip(s, "xyz", strict=True)])


def compare_truth(df: DataFrame, truth: tuple[str, ...], measured: tuple[str, ...], tolerance: Column) -> DataFrame:
    """Adds abs_err_<i>, rel_err_pct_<i> (0 where the truth is not above 0) and passed (all within tolerance)."""
    passed = F.lit(True)
    for i, (t, m) in enumerate(zip(truth, measured, strict=True)):
        err = F.abs(F.col(m) - F.col(t))
        df = df.withColumns({f"abs_err_{i}": err, f"rel_err_pct_{i}": F.when(F.col(t) > 0, err / F.col(t) * 100).otherwise(0.0)})
        passed = passed & (F.col(f"abs_err_{i}") <= tolerance)
    return df.withColumn("passed", passed)
