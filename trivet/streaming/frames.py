"""Streaming twins: sequential redundancy, running totals, frame limits, neighbour pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trivet.storage import new_path

K = "video_id"


def fold_redundant(frames: DataFrame, threshold: float = 0.98, full: float = 255.0) -> DataFrame:
    """A stream of (video_id, seq, thumb) to (video_id, seq, similarity, accepted).

    State: the thumbnail of the last frame kept, one a video. Frames of a batch are taken in order of
    seq; frames must not come earlier than those of batches before.
    """

    def fold(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = np.asarray(state.get[0]) if state.exists else None
        rows = pd.concat(list(parts)).sort_values("seq")
        out = []
        for seq, thumb in zip(rows["seq"], rows["thumb"], strict=True):
            x = np.asarray(thumb, float)
            sim = None if last is None else 1.0 - float(np.abs(x - last).sum()) / len(x) / full
            ok = sim is None or sim < threshold
            last = x if ok else last
            out.append((key[0], seq, sim, ok))
        state.update((last.tolist(),))
        yield pd.DataFrame(out, columns=["video_id", "seq", "similarity", "accepted"])

    return frames.groupBy(K).applyInPandasWithState(
        fold, "video_id long, seq long, similarity double, accepted boolean", "thumb array<double>", "append", GroupStateTimeout.NoTimeout
    )


def limit_frames(frames: DataFrame, most: int) -> DataFrame:
    """The first `most` frames of each video in arrival order (seq within a batch); state: how many are through."""

    def take(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done = state.get[0] if state.exists else 0
        rows = pd.concat(list(parts)).sort_values("seq").head(max(0, most - done))
        state.update((done + len(rows),))
        yield rows[["video_id", "seq"]]

    return frames.groupBy(K).applyInPandasWithState(take, "video_id long, seq long", "done long", "append", GroupStateTimeout.NoTimeout)


def running_totals(gated: DataFrame) -> DataFrame:
    """Counts of each video so far; write in update or complete mode."""
    return gated.groupBy(K).agg(F.count("*").alias("n_frames"), F.count_if("accepted").alias("selected"), F.count_if("is_blurry").alias("blurry"))


def neighbour_pairs(frames: DataFrame, ahead: int = 3) -> DataFrame:
    """Pairs (video_id, i, j) with i < j <= i + ahead; state: the last `ahead` positions of a video."""

    def pair(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = list(state.get[0]) if state.exists else []
        out = []
        for seq in sorted(pd.concat(list(parts))["seq"].tolist()):
            out += [(key[0], i, seq) for i in last if seq - i <= ahead]
            last = [*last, seq][-ahead:]
        state.update((last,))
        yield pd.DataFrame(out, columns=["video_id", "i", "j"]).astype("int64")

    return frames.groupBy(K).applyInPandasWithState(pair, "video_id long, i long, j long", "last array<long>", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there, into tables in the shared folder, and returns what they hold.

    A batch is written under its number, so one that is run again replaces itself. In complete mode
    the last batch is the result, in the others all are.
    """
    spark, path = stream.sparkSession, new_path(stream.sparkSession, name)
    done: set[int] = set()

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        done.add(number)

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", new_path(spark, f"{name}-state")).foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    if not done:
        return spark.createDataFrame([], stream.schema)
    read = [max(done)] if mode == "complete" else sorted(done)
    return spark.read.schema(stream.schema).parquet(*[f"{path}/batch={n}" for n in read])
