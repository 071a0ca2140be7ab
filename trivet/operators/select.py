"""Keyframe selection over the match graph: sector anchors, bridges, fill, and why a frame was left out.

Each pick depends on the picks before it, so one video is one unit of work; its frames are bounded by
the stride (hundreds), and videos spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = "video_id"
OUT = "video_id long, seq long, selected boolean, reason string, utility double"


class _Video:
    """One video's frames by position, its graph, and what is selected so far."""

    def __init__(self, rows: pd.DataFrame, links: pd.DataFrame, budget: int, redundancy: float, full: float, geometric: bool):
        self.rows = rows.sort_values("seq").reset_index(drop=True)
        self.n = len(self.rows)
        self.budget = min(budget, self.n)
        self.graph = geometric and len(links) > 0
        at = {s: k for k, s in enumerate(self.rows["seq"])}
        self.near: list[set[int]] = [set() for _ in range(self.n)]
        self.wide: list[set[int]] = [set() for _ in range(self.n)]
        if self.graph:
            for i, j, linked, parallax in links[["i", "j", "is_connected", "is_parallax_bearing"]].itertuples(index=False):
                if linked and i in at and j in at:
                    for nbrs in (self.near, self.wide) if parallax else (self.near,):
                        nbrs[at[i]].add(at[j])
                        nbrs[at[j]].add(at[i])
        gain = [0.3 * min(1.0, len(w) / 2) + 0.2 * min(1.0, len(t) / 3) for w, t in zip(self.wide, self.near, strict=True)] if self.graph else [0.0] * self.n
        self.utility = [round(o + g, 3) for o, g in zip(self.rows["optical"], gain, strict=True)]
        self.bad = self.rows["severe"].tolist()
        self.plain = self.rows[["seq", "brightness", "contrast", "keypoints"]].to_dict("list")
        self.thumb = np.stack([np.asarray(t, float) for t in self.rows["thumb"]])
        self.redundancy, self.full = redundancy, full
        self.chosen: dict[int, str] = {}

    def twin(self, k: int) -> tuple[int, float] | None:
        """The first selected frame that is too similar, with the similarity."""
        if not self.chosen:
            return None
        order = sorted(self.chosen)
        sim = 1.0 - np.abs(self.thumb[order] - self.thumb[k]).reshape(len(order), -1).mean(axis=1) / self.full
        near = np.flatnonzero(sim >= self.redundancy)
        return (order[near[0]], float(sim[near[0]])) if len(near) else None

    def best_first(self, ks: Iterator[int]) -> list[int]:
        return sorted(ks, key=lambda k: (-self.utility[k], k))

    def anchors(self) -> None:
        many = max(2, int(self.budget * 0.75)) if self.graph and self.budget >= 3 else self.budget
        many = min(many, self.n)
        for b in range(many):
            low = int(b * (self.n / many))
            high = self.n if b == many - 1 else int((b + 1) * (self.n / many))
            usable = [k for k in self.best_first(range(low, high)) if not self.bad[k]]
            fresh = next((k for k in usable if self.twin(k) is None), None)
            if fresh is not None:
                self.chosen[fresh] = f"Temporal anchor for sector {b + 1}/{many} (utility: {self.utility[fresh]:.2f})"
            elif usable:
                self.chosen[usable[0]] = f"Fallback anchor for sector {b + 1}/{many} (utility: {self.utility[usable[0]]:.2f})"

    def pieces(self) -> list[set[int]]:
        """Components of the selected frames, in order of their first frame."""
        left, out = set(self.chosen), []
        for s in sorted(self.chosen):
            if s not in left:
                continue
            piece, front = set(), {s}
            while front:
                piece |= front
                front = {m for k in front for m in self.near[k] if m in left} - piece
            left -= piece
            out.append(piece)
        return out

    def bridges(self) -> None:
        pieces = self.pieces()
        if len(pieces) <= 1:
            return
        spans = {k: sum(bool(self.near[k] & p) for p in pieces) for k in range(self.n) if k not in self.chosen and not self.bad[k]}
        for k in sorted((k for k, c in spans.items() if c > 1), key=lambda k: (-spans[k], -self.utility[k], k)):
            why = f"Bridge frame linking {spans[k]} disconnected subgraphs (utility: {self.utility[k]:.2f})"
            if len(self.chosen) < self.budget:
                self.chosen[k] = why
            else:
                # Full: the bridge takes the place of a weak frame that it does not touch.
                out = next(
                    (r for p in sorted(pieces, key=len, reverse=True) if len(p) > 1 for r in sorted(p, key=lambda x: (self.utility[x], x)) if k not in self.near[r]), None
                )
                if out is None:
                    continue
                del self.chosen[out]
                self.chosen[k] = why
            pieces = self.pieces()
            if len(pieces) <= 1:
                return

    def fill(self) -> None:
        for k in self.best_first(k for k in range(self.n) if k not in self.chosen and not self.bad[k]):
            if len(self.chosen) >= self.budget:
                return
            if self.twin(k) is None:
                self.chosen[k] = f"High-utility supplemental keyframe (utility: {self.utility[k]:.2f})"

    def rejected(self, k: int) -> str:
        r = {c: v[k] for c, v in self.plain.items()}
        if self.bad[k]:
            if r["brightness"] < 10:
                return f"Severe underexposure (brightness {r['brightness']:.1f} < 10.0)"
            if r["brightness"] > 248:
                return f"Severe overexposure (brightness {r['brightness']:.1f} > 248.0)"
            if r["contrast"] < 5:
                return f"Near-zero contrast (std dev {r['contrast']:.1f} < 5.0)"
            if r["keypoints"] < 8:
                return f"Insufficient visual features (keypoints {int(r['keypoints'])} < 8)"
            return "Severe optical quality defect"
        if twin := self.twin(k):
            return f"Visual redundancy with frame_{int(self.plain['seq'][twin[0]]):06d} (similarity {twin[1]:.3f} >= threshold)"
        if self.graph and not self.near[k]:
            return "Graph isolation (0 geometrically verified inliers)"
        if self.graph and not self.wide[k]:
            return "Homography-dominated motion without verified parallax"
        what = "reconstruction utility" if self.graph else "optical quality score"
        return f"Lower {what} ({self.utility[k]:.2f}) than selected anchors in sector"


def select_keyframes(frames: DataFrame, edges: DataFrame, budget: int = 30, redundancy: float = 0.98, full: float = 255.0, geometric: bool = True) -> DataFrame:
    """Rows (video_id, seq, selected, reason, utility) for frames with optical, severe, brightness, contrast, keypoints, thumb.

    Sector anchors come first, then bridges between components of what is selected, then the best of
    the rest up to the budget. Ties go to the earlier frame. Among several selected twins the
    earliest is named.
    """

    def one(key, rows: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({c.split()[0]: [] for c in OUT.split(", ")})
        v = _Video(rows, links, budget, redundancy, full, geometric)
        v.anchors()
        if v.graph:
            v.bridges()
        v.fill()
        why = [v.chosen.get(k) or v.rejected(k) for k in range(v.n)]
        return pd.DataFrame({"video_id": key[0], "seq": v.rows["seq"], "selected": [k in v.chosen for k in range(v.n)], "reason": why, "utility": v.utility})

    f = frames.select(K, "seq", "optical", "severe", "brightness", "contrast", "keypoints", "thumb")
    e = edges.select(K, "i", "j", "is_connected", "is_parallax_bearing")
    return f.groupBy(K).cogroup(e.groupBy(K)).applyInPandas(one, OUT)


def selection_span(selected: DataFrame) -> DataFrame:
    """(video_id, temporal_coverage_ratio, max_temporal_gap) of selected frames (video_id, seq, n)."""
    from pyspark.sql import Window

    gap = F.col("seq") - F.lag("seq").over(Window.partitionBy(K).orderBy("seq"))
    s = selected.withColumn("_g", gap)
    return s.groupBy(K).agg(
        F.round((F.max("seq") - F.min("seq")) / F.greatest(F.lit(1), F.max("n") - 1), 3).alias("temporal_coverage_ratio"), F.coalesce(F.max("_g"), F.lit(0)).alias("max_temporal_gap")
    )
