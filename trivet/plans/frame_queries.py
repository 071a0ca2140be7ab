"""Frame and match-graph queries over F1 (events), F2 (embeddings) and E1 (pairs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivet.operators import frames as fr
from trivet.operators import matchgraph as mg
from trivet.operators.select import select_keyframes, selection_span
from trivet.plans.relations import FRAMES, PAIRS, THUMBS, frames, pair_edges, thumbs
from trivet.storage import cut
from trivet.streaming import frames as streams

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@query(f"""WITH {FRAMES}, v AS (SELECT video_id, count(*) AS frame_count, CAST(24 + video_id % 37 AS DOUBLE) AS fps FROM frames GROUP BY 1),
s AS (SELECT *, CASE WHEN fps > 15 THEN greatest(1, CAST(round_even(fps / 15, 0) AS BIGINT)) ELSE 1 END AS s0 FROM v),
t AS (SELECT *, CASE WHEN ceil(frame_count / CAST(s0 AS DOUBLE)) > 12 THEN greatest(s0, frame_count // 12, 1) ELSE s0 END AS step FROM s)
SELECT video_id, i AS source_frame_index, i // step AS seq, printf('frame_%06d.jpg', i) AS filename, round(i / fps, 4) AS timestamp_seconds
FROM (SELECT *, unnest(range(0, frame_count, step)) AS i FROM t) WHERE i // step < 12""")
def frame_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = frames(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("frame_count")).withColumn("fps", (24 + F.col("video_id") % 37).cast("double"))
    return fr.extract_rows(fr.stride(v, F.lit(1), F.lit(15.0), F.lit(12)), 12)


_GATE = f"""WITH {FRAMES}, g AS (SELECT *, sharpness < 100 AS is_blurry, brightness < 30 AS is_underexposed, brightness > 235 AS is_overexposed, contrast < 15 AS is_low_contrast, sharpness < 10 AS is_low_texture FROM frames),
q AS (SELECT *, NOT (is_blurry OR is_underexposed OR is_overexposed OR is_low_contrast OR is_low_texture) AS accepted FROM g)"""


@query(f"{_GATE} SELECT video_id, seq, is_blurry, is_underexposed, is_overexposed, is_low_contrast, is_low_texture, accepted FROM q")
def frame_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = fr.gate(frames(spark, sf_dir))
    return g.select("video_id", "seq", "is_blurry", "is_underexposed", "is_overexposed", "is_low_contrast", "is_low_texture", "accepted")


# Java prints the shortest decimal of a double rounded half up; a decimal cast does the same.
_D = "CAST(CAST(CAST({} AS VARCHAR) AS DECIMAL(38, 18)) AS DECIMAL(18, 1))"


@query(f"""{_GATE}, p AS (SELECT *, {_D.format('sharpness')} AS s, {_D.format('brightness')} AS b, {_D.format('contrast')} AS c FROM q)
SELECT video_id, seq, concat_ws('; ', CASE WHEN is_blurry THEN 'Low sharpness (' || s || ' < threshold 100.0)' END, CASE WHEN is_underexposed THEN 'Underexposed (brightness ' || b || ' < 30.0)' END,
CASE WHEN is_overexposed THEN 'Overexposed (brightness ' || b || ' > 235.0)' END, CASE WHEN is_low_contrast THEN 'Low contrast (std dev ' || c || ' < 15.0)' END,
CASE WHEN is_low_texture THEN 'Low visible detail (heuristic score ' || s || ' < threshold 10.0)' END) AS reasons FROM p""")
def frame_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.gate(frames(spark, sf_dir)).select("video_id", "seq", F.concat_ws("; ", "reasons").alias("reasons"))


_TOTALS = f"""{_GATE}, t AS (SELECT video_id, count(*) AS n_frames, count(*) FILTER (WHERE accepted) AS selected, count(*) FILTER (WHERE is_blurry) AS blurry,
count(*) FILTER (WHERE is_underexposed OR is_overexposed OR is_low_contrast) AS exposure, count(*) FILTER (WHERE is_low_texture) AS low_texture, round(avg(round(sharpness, 2)), 4) AS average_sharpness FROM q GROUP BY 1)"""


@query(f"""{_TOTALS} SELECT *, round(blurry / CAST(n_frames AS DOUBLE), 6) AS blur_ratio, round(exposure / CAST(n_frames AS DOUBLE), 6) AS exposure_ratio, round(selected / CAST(n_frames AS DOUBLE), 3) AS diversity FROM t""")
def frame_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fr.totals(fr.gate(frames(spark, sf_dir)))
    r = lambda c, n: F.round(c, n).alias(c)
    return t.select("video_id", "n_frames", "selected", "blurry", "exposure", "low_texture", r("average_sharpness", 4), r("blur_ratio", 6), r("exposure_ratio", 6), "diversity")


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query(f"""{_TOTALS}, r AS (SELECT video_id, blurry / CAST(n_frames AS DOUBLE) AS b, exposure / CAST(n_frames AS DOUBLE) AS e, round(selected / CAST(n_frames AS DOUBLE), 3) AS d FROM t),
n AS (SELECT video_id, concat_ws(' ', CASE WHEN b > 0.4 THEN {_text(fr.MORE_SLOWLY)} WHEN b > 0.2 THEN {_text(fr.STEADIER)} END, CASE WHEN e > 0.3 THEN {_text(fr.LIGHT)} END, CASE WHEN d < 0.6 THEN {_text(fr.ORBIT)} END) AS s FROM r)
SELECT video_id, CASE WHEN s = '' THEN {_text(fr.NO_ISSUE)} ELSE s END AS guidance FROM n""")
def frame_guidance(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fr.totals(fr.gate(frames(spark, sf_dir)))
    notes = fr.guidance(F.col("blur_ratio"), F.col("exposure_ratio"), F.lit(0.0), F.col("diversity"))
    return t.select("video_id", F.concat_ws(" ", notes).alias("guidance"))


_SIM = "1 - list_sum(list_transform(range(1, 65), lambda i: abs(a[i] - b[i]))) / 64"


@query(f"""WITH RECURSIVE {THUMBS}, fold(video_id, seq, state, accepted) AS (
  SELECT video_id, seq, thumb, true FROM thumbs WHERE seq = 0
  UNION ALL
  SELECT t.video_id, t.seq, CASE WHEN s.sim < 0.87 THEN t.thumb ELSE s.state END, s.sim < 0.87
  FROM (SELECT f.video_id, f.seq, f.state, 1 - list_sum(list_transform(range(1, 65), lambda i: abs(n.thumb[i] - f.state[i]))) / 64 AS sim FROM fold f JOIN thumbs n ON n.video_id = f.video_id AND n.seq = f.seq + 1) s
  JOIN thumbs t ON t.video_id = s.video_id AND t.seq = s.seq + 1)
SELECT video_id, seq, accepted FROM fold""")
def frame_redundancy_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.fold_redundant(thumbs(spark, sf_dir), 0.87, 1.0).select("video_id", "seq", "accepted")


@query(f"""WITH {THUMBS}, p AS (SELECT video_id, thumb AS a, lag(thumb) OVER (PARTITION BY video_id ORDER BY seq) AS b FROM thumbs), d AS (SELECT video_id, 1 - ({_SIM}) AS d FROM p)
SELECT video_id, CASE WHEN count(*) < 2 THEN CAST(0.1 AS DOUBLE) ELSE round(greatest(0, least(1, 4 * avg(d))), 3) END AS coverage FROM d GROUP BY 1""")
def frame_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.coverage(thumbs(spark, sf_dir), 1.0)


_BUCKET = f"""WITH {FRAMES}, n AS (SELECT video_id, seq, sharpness, count(*) OVER (PARTITION BY video_id) AS n FROM frames),
b AS (SELECT *, least(n, greatest(2, CAST(floor(least(20, n) * 0.75) AS BIGINT))) AS nb FROM n),
k AS (SELECT *, (SELECT max(x) FROM (SELECT unnest(range(0, nb)) AS x) WHERE floor(x * (n / CAST(nb AS DOUBLE))) <= seq) AS bucket FROM b)"""


@query(f"{_BUCKET} SELECT video_id, seq, CAST(bucket AS BIGINT) AS bucket FROM k")
def frame_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.buckets(frames(spark, sf_dir), 20).select("video_id", "seq", "bucket")


@query(f"{_BUCKET} SELECT video_id, CAST(bucket AS BIGINT) AS bucket, seq FROM (SELECT *, row_number() OVER (PARTITION BY video_id, bucket ORDER BY sharpness DESC, seq) AS r FROM k) WHERE r = 1")
def bucket_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fr.buckets(frames(spark, sf_dir), 20)
    return b.groupBy("video_id", "bucket").agg(F.max_by("seq", F.struct("sharpness", -F.col("seq"))).alias("seq"))


@query(f"WITH {PAIRS} SELECT video_id, i, j FROM e1")
def match_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mg.neighbour_pairs(frames(spark, sf_dir)).select("video_id", "i", "j")


@query(f"WITH {PAIRS} SELECT video_id, i, j, raw_matches, f AS f_inliers, h AS h_inliers, round(r, 3) AS h_ratio, conn AS is_connected, par AS is_parallax_bearing FROM me")
def match_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mg.classify(pair_edges(spark, sf_dir))


@query(f"WITH {PAIRS} SELECT video_id, seq, t_deg, p_deg FROM dg")
def match_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mg.degrees(mg.classify(pair_edges(spark, sf_dir)))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 with three keypoints for each unit of k, a grid share of its last digit, and its optical score."""
    f = frames(spark, sf_dir).withColumns({"keypoints": F.col("k") * 3, "grid": (F.col("k") % 10) / 9.0}).withColumn("severe", fr.severe())
    return f.withColumn("optical", fr.optical_score(F.col("severe"), F.col("keypoints"), F.col("grid")))


@query(f"WITH {PAIRS} SELECT video_id, seq, severe, optical, CAST(p_deg AS BIGINT) AS p_deg, CAST(t_deg AS BIGINT) AS t_deg, utility FROM ut")
def frame_utility(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mg.degrees(mg.classify(pair_edges(spark, sf_dir)))
    f = _scored(spark, sf_dir).join(d, ["video_id", "seq"], "left").fillna(0, ["p_deg", "t_deg"])
    return f.select("video_id", "seq", "severe", "optical", "p_deg", "t_deg", mg.utility(F.col("optical"), F.col("p_deg"), F.col("t_deg")).alias("utility"))


@query(f"""WITH RECURSIVE {PAIRS}, cn AS (SELECT video_id, n, o FROM nb WHERE conn),
up(video_id, n, r) AS (SELECT DISTINCT video_id, n, n FROM cn UNION SELECT up.video_id, up.n, cn.o FROM up JOIN cn ON up.video_id = cn.video_id AND up.r = cn.n),
cc AS (SELECT video_id, count(DISTINCT m) AS c FROM (SELECT video_id, n, min(r) AS m FROM up GROUP BY 1, 2) GROUP BY 1),
pc AS (SELECT video_id, count(*) AS pairs, count(*) FILTER (WHERE conn) AS connected, count(*) FILTER (WHERE par) AS parallax, count(*) FILTER (WHERE conn AND NOT par) AS homography FROM me GROUP BY 1),
tc AS (SELECT video_id, count(*) FILTER (WHERE t_deg > 0) AS t FROM dg GROUP BY 1), n AS (SELECT video_id, count(*) AS n FROM frames GROUP BY 1)
SELECT n.video_id, coalesce(pairs, 0) AS pairs, coalesce(connected, 0) AS connected, coalesce(parallax, 0) AS parallax, coalesce(homography, 0) AS homography, n - coalesce(t, 0) AS isolated, coalesce(c, 0) AS components
FROM n LEFT JOIN pc ON n.video_id = pc.video_id LEFT JOIN tc ON n.video_id = tc.video_id LEFT JOIN cc ON n.video_id = cc.video_id""")
def match_diag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mg.diagnostics(frames(spark, sf_dir), mg.classify(pair_edges(spark, sf_dir)))


@query(f"""WITH {THUMBS}, q AS (SELECT a.video_id AS pair, a.vec_id AS id, b.vec_id AS match, sqrt(list_sum(list_transform(range(1, 65), lambda i: (a.thumb[i] - b.thumb[i]) * (a.thumb[i] - b.thumb[i])))) AS d
FROM thumbs a JOIN thumbs b ON a.video_id = b.video_id AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY pair, id ORDER BY d, match) AS r, lead(d) OVER (PARTITION BY pair, id ORDER BY d, match) AS d2 FROM q)
SELECT pair, id, match FROM r WHERE r = 1 AND d < 0.95 * d2""")
def knn_ratio_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = thumbs(spark, sf_dir).select(F.col("video_id").alias("pair"), F.col("vec_id").alias("id"), F.col("thumb").alias("d"))
    return mg.knn_ratio(t.where("id % 2 = 0"), t.where("id % 2 = 1"), 0.95)


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every frame gets a thumbnail of one pixel, its k: equal k are twins at a similarity of 1.
    f = _scored(spark, sf_dir).withColumn("thumb", F.array(F.col("k").cast("double")))
    return select_keyframes(f, mg.classify(pair_edges(spark, sf_dir)), 20, 0.9999, 100.0)


@query()
def selector_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir)


@query()
def bridge_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir).where(F.col("reason").startswith("Bridge frame")).select("video_id", "seq", "reason")


@query()
def rejection_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _selected(spark, sf_dir).where("not selected")
    return s.groupBy("video_id", F.regexp_extract("reason", r"^(\w+ \w+)", 1).alias("kind")).agg(F.count("*").alias("frames"))


@query()
def selection_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = frames(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("n"))
    return selection_span(_selected(spark, sf_dir).where("selected").join(n, "video_id"))


def _as_stream(df: DataFrame, order: str) -> DataFrame:
    """A table in the shared folder, in files by order, read as a stream."""
    t = cut(df.repartitionByRange(4, order), "stream")
    return df.sparkSession.readStream.schema(t.schema).option("maxFilesPerTrigger", 100).parquet(t.inputFiles()[0].rsplit("/", 1)[0])


@query(ORACLES["frame_redundancy_fold"])
def stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams.fold_redundant(_as_stream(thumbs(spark, sf_dir).select("video_id", "seq", "thumb"), "seq"), 0.87, 1.0)
    return streams.drain(s, "stream_fold_out").select("video_id", "seq", "accepted")


@query(f"{_GATE} SELECT video_id, count(*) AS n_frames, count(*) FILTER (WHERE accepted) AS selected, count(*) FILTER (WHERE is_blurry) AS blurry FROM q GROUP BY 1")
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = fr.gate(_as_stream(frames(spark, sf_dir).drop("k"), "seq"))
    return streams.drain(streams.running_totals(g), "stream_totals_out", "complete")


@query(f"WITH {FRAMES} SELECT video_id, seq FROM frames WHERE seq < 40")
def stream_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.drain(streams.limit_frames(_as_stream(frames(spark, sf_dir).select("video_id", "seq"), "seq"), 40), "stream_limit_out")


@query(f"WITH {PAIRS} SELECT video_id, i, j FROM e1")
def stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.drain(streams.neighbour_pairs(_as_stream(frames(spark, sf_dir).select("video_id", "seq"), "seq")), "stream_pairs_out")
