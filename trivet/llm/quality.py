"""Quality classifier by Bradley-Terry pairwise ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trivet.llm.common import cut, free
from trivet.llm.langid import held_out

#: Features of a text: shares of bytes by class (each as it is and as its root), then shape.
SHARES = ("upper", "lower", "digit", "symbol", "bar", "mark", "stop", "high", "control")
FEATURES = [f"{r}{s}" for s in SHARES for r in ("", "root_")] + ["distinct", "richness", "word_length", "log_words", "line_words", "repeated_lines"]


def _classes() -> np.ndarray:
    """The class of each byte, -1 for none."""
    of = np.full(256, -1)
    for k, chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#*$%&<>@^~_=+\\{}[]`", "|", "!?", ".,;:")):
        for c in chars.encode():
            of[c] = k
    of[128:] = 7
    of[:32] = 8
    return of


_SUM = np.eye(9)[_classes()] * (_classes() >= 0)[:, None]


def features(text: str) -> np.ndarray:
    """One row of FEATURES from the whole text; an empty text gives zeros."""
    raw = text.encode()
    out = np.zeros(len(FEATURES))
    if not raw:
        return out
    share = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _SUM / len(raw)
    out[0:18:2], out[1:18:2] = share, np.sqrt(share)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x]
    n, kinds = len(words), len(set(words))
    if n:
        out[18:] = (
            kinds / n,
            np.log1p(kinds) / np.log1p(n),
            min(30.0, len(raw) / n) / 10,
            np.log1p(n) / 10,
            np.log1p(n / max(1, len(lines))) / 5,
            1 - len(set(lines)) / max(1, len(lines)),
        )
    return out


@dataclass(frozen=True)
class RankModel:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    width: float

    def score(self, texts: list[str]) -> np.ndarray:
        """0 to 1; 0.5 at the threshold."""
        return self.rate(_matrix(texts))

    def rate(self, x: np.ndarray) -> np.ndarray:
        """The scores of rows of features."""
        return 1 / (1 + np.exp(-np.clip((_dot((x - self.mean) / self.scale, self.weight) - self.cut) / self.width, -30, 30)))


def _dot(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """z @ w, each row by itself: the same to the last bit in whatever batch a row comes."""
    return (z * w).sum(axis=1)


def _matrix(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))


def fit(x: np.ndarray, good: list[int], share_bad: float, pairs: int | None = None, ridge: float = 1e-3, steps: int = 25) -> RankModel:
    """Fits on rows of features x and labels good at hand. Bradley-Terry: P(a preferred to b) = sigmoid(w . (f(a) - f(b))), by Newton steps on the logistic loss.

    Every good document is paired with every bad one, written out (tables take fit_rows), or as many
    as pairs says are drawn at random (fixed seed). The threshold is the quantile of the
    fitted documents' scores at share_bad, each class weighing its share, moved to the middle of the
    gap between the two scores there. With one class or none nothing can be ranked: all score 0.5 or
    more if no bad one was seen, else less.
    """
    y = np.array(good, dtype=bool)
    d = x.shape[1]
    if not y.any() or y.all():
        return RankModel(np.zeros(d), np.ones(d), np.zeros(d), 0.0 if y.all() else 1.0, 1.0)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = (x - mean) / scale
    if pairs is None:
        diff = (z[y][:, None] - z[~y]).reshape(-1, d)
    else:
        rng = np.random.default_rng(7)
        diff = z[rng.choice(np.flatnonzero(y), pairs)] - z[rng.choice(np.flatnonzero(~y), pairs)]
    w = np.zeros(d)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        grad = diff.T @ (p - 1) / len(diff) + ridge * w
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(d), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    order = np.argsort(s, kind="stable")
    mass = np.where(y, (1 - share_bad) / y.sum(), share_bad / (~y).sum())[order]
    k = int(np.clip(np.searchsorted(np.cumsum(mass), share_bad - 1e-12), 0, len(s) - 2))
    cut = (s[order[k]] + s[order[k + 1]]) / 2
    return RankModel(mean, scale, w, float(cut), float(max(1e-6, s.std() / 3)))


#: Sums over all pairs meet on grids of scores: first moments STEP apart, read between by cubics
#: (off by some 3e-9), second moments in cells of COARSE, which only steer the steps. From FAR apart
#: a sigmoid is 0 or 1 in double precision. Sums are of integers, so no order of rows changes them.
STEP, COARSE, FAR = 1 / 32, 1 / 4, 40.0
_ONE, _ROUGH = 1 << 32, 1 << 8
_CELLS = 1 << 40


def _merge(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    own, first = np.unique(keys[order], return_index=True)
    return own, np.add.reduceat(sums[order], first, axis=0)


def _key(row: int, q: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (2 * row + q) * _CELLS + cell + _CELLS // 2


def _tally(q: np.ndarray, z: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By class and cell of the score, what all pairs of these rows with any others need: row 0 has the
    number and sum of the rows, spread over the four nearest points of the grid, rows 1 to d the matrix
    of second moments."""
    s = _dot(z, w)
    at = np.floor(s / STEP).astype(np.int64)
    t = s / STEP - at
    part = np.stack([t * (1 - t) * (t - 2) / 6, (t + 1) * (t - 1) * (t - 2) / 2, (t + 1) * t * (2 - t) / 2, (t + 1) * t * (t - 1) / 6], axis=1)
    v = np.concatenate([np.ones((len(z), 1)), z], axis=1)
    keys = [_key(0, q[:, None], at[:, None] + np.arange(-1, 3)).ravel()]
    sums = [np.rint(part[:, :, None] * v[:, None] * _ONE).astype(np.int64).reshape(-1, v.shape[1])]
    cell = _key(0, q, np.floor(s / COARSE).astype(np.int64))
    v = np.rint(v * _ROUGH)
    for c in np.unique(cell):
        mine = v[cell == c]
        keys.append(c + 2 * _CELLS * np.arange(1, v.shape[1]))
        sums.append((mine[:, 1:].T @ mine).astype(np.int64))
    return _merge(np.concatenate(keys), np.concatenate(sums))


def _over(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums by key of part(q, x) over all of rows (q int, x array<double>), sorted by key."""
    names = [f"v{k}" for k in range(len(FEATURES) + 1)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            q, x = b.column(0).to_numpy().astype(np.int64), b.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            for a in range(0, len(q), 4096):
                held.append(part(q[a : a + 4096], x[a : a + 4096]))
                if len(held) > 1:
                    held = [_merge(np.concatenate([k for k, _ in held]), np.concatenate([s for _, s in held]))]
        for keys, sums in held:
            yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array(c) for c in np.ascontiguousarray(sums.T)]], names=["key", *names])

    out = rows.mapInArrow(work, ", ".join(f"{c} long" for c in ["key", *names])).groupBy("key").agg(*[F.sum(c).alias(c) for c in names]).toArrow().sort_by("key")
    return out.column(0).to_numpy(), np.stack([c.to_numpy() for c in out.columns[1:]], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -FAR, FAR)))


def _slope(keys: np.ndarray, sums: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient and Hessian of the mean loss over all n[1] * n[0] pairs, and the variance of the scores, from tallies."""
    kind, cell = keys // _CELLS, keys % _CELLS - _CELLS // 2
    d = sums.shape[1] - 1
    (sb, b), (sa, a) = ((cell[kind == q] * STEP, sums[kind == q] / _ONE / n[q]) for q in (0, 1))
    below = np.concatenate([np.zeros((1, d + 1)), b.cumsum(axis=0)])
    grad, cross = b[:, 1:].sum(axis=0), np.zeros((d, d))
    for i in range(0, len(sa), 256):
        s, m = sa[i : i + 256], a[i : i + 256]
        lo, hi = np.searchsorted(sb, s[0] - FAR), np.searchsorted(sb, s[-1] + FAR, "right")
        p = _sigmoid(s[:, None] - sb[lo:hi])
        won = p @ b[lo:hi] + below[lo]
        grad += m[:, 1:].T @ (won[:, 0] - 1) - m[:, 0] @ won[:, 1:]
        cross += m[:, 1:].T @ ((p * (1 - p)) @ b[lo:hi, 1:])
    hess = -cross - cross.T
    for q, other, m in ((0, sa, a), (1, sb, b)):
        p = _sigmoid((cell[kind == 2 + q][:, None] + 0.5) * COARSE - other)
        pull = (p * (1 - p)) @ m[:, 0] / n[q] / _ROUGH**2
        hess += [pull @ sums[kind == 2 * j + q, 1:] for j in range(1, d + 1)]
    first, second = ((b[:, 0] @ sb**k * n[0] + a[:, 0] @ sa**k * n[1]) / n.sum() for k in (1, 2))
    return grad, hess, second - first**2


def _threshold(scores: DataFrame, share_bad: float, n: np.ndarray) -> float:
    """The quantile of scores (q, s) at share_bad, each class weighing its share: the middle between the
    least score whose mass from below reaches it and the next other one. Exact: 4,096 bins at a time."""
    lo, hi = scores.agg(F.min("s"), F.max("s")).first()
    before = after = None
    under = np.zeros(2)
    weight = np.array([share_bad, 1 - share_bad]) / n
    while lo < hi:
        bin_ = F.least(F.floor((F.col("s") - lo) / (hi - lo) * 4096), F.lit(4095))
        inside = scores.where(F.col("s").between(lo, hi)).groupBy(bin_.alias("k"))
        found = sorted(inside.agg(F.count_if(F.col("q") == 0), F.count_if(F.col("q") == 1), F.min("s"), F.max("s")).collect())
        for i, (_, bad, good, lo, hi) in enumerate(found):
            if (under + (bad, good)) @ weight >= share_bad - 1e-12 or i == len(found) - 1:
                break
            under += (bad, good)
        before = found[i - 1][4] if i else before
        after = found[i + 1][3] if i + 1 < len(found) else after
    if after is not None:
        return (lo + after) / 2
    return lo if before is None else (before + lo) / 2


def fit_rows(rows: DataFrame, share_bad: float, ridge: float = 1e-3, steps: int = 60) -> RankModel:
    """fit for a table (q int, x array<double>) of any size: mean, scale, all pairs of a good and a bad row, and the threshold come from all rows.

    A Newton step reads the rows once; the driver gets sums by cells of the score, whose number goes
    with the range of the scores and not with the rows. A step that makes the gradient longer is
    halved. Among scores that tie, the threshold is above all of them.
    """
    keys, sums = _over(rows, lambda q, x: _merge(q, np.rint(np.concatenate([np.ones((len(x), 1)), x * _ONE], axis=1)).astype(np.int64)))
    if len(keys) < 2:
        return fit(np.zeros((len(keys), len(FEATURES))), keys.tolist(), share_bad)
    n = sums[:, 0].astype(float)
    mean = sums[:, 1:].sum(axis=0) / _ONE / n.sum()
    _, sums = _over(rows, lambda q, x: _merge(q, np.rint(np.concatenate([np.ones((len(x), 1)), (x - mean) ** 2 * _ONE], axis=1)).astype(np.int64)))
    scale = np.maximum(np.sqrt(sums[:, 1:].sum(axis=0) / _ONE / n.sum()), 1e-6)
    w = best = np.zeros(len(FEATURES))
    step, least = np.zeros(len(w)), np.inf
    for _ in range(steps):
        grad, hess, var = _slope(*_over(rows, lambda q, x: _tally(q, (x - mean) / scale, w)), n)
        grad += ridge * w
        if (size := np.linalg.norm(grad)) < least:
            best, least, spread = w, size, var
            step = np.linalg.solve(hess + ridge * np.eye(len(w)), grad)
        else:
            step = step / 2
        if np.abs(step).max() < 1e-6:
            break
        w = best - step

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_dot((x - mean) / scale, best))], names=["q", "s"])

    scores = cut(rows.mapInArrow(score, "q int, s double"), "scores")
    at = _threshold(scores, share_bad, n)
    free(scores)
    return RankModel(mean, scale, best, float(at), float(max(1e-6, np.sqrt(max(0.0, spread)) / 3)))


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, x) for every row of docs: hash of the text (null without one) and FEATURES of the whole text."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col)).alias("th"), F.col(text_col).alias("text"))
    schema = own.select("doc_id", "th", F.array(F.lit(0.0)).alias("x")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [_matrix([t or "" for t in b.column(2).slice(a, 128).to_pylist()]).ravel() for a in range(0, b.num_rows, 128)]
            flat = pa.array(np.concatenate([np.zeros(0), *x]))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(FEATURES)), flat)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), rows], names=["doc_id", "th", "x"])

    return own.mapInArrow(work, schema)


def _learn(known_texts: DataFrame, labels: DataFrame, parts: int, part: int, id_col: str, label_col: str) -> RankModel:
    """train on features that are there already."""
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("q")).where("q in (0, 1) and i is not null")
    known = known.where(~held_out(F.col("i"), parts, part)).distinct()
    n = {r["q"]: r["count"] for r in known.groupBy("q").count().collect()}
    if not n:
        return fit(_matrix([]), [], 0.5)
    own = known_texts.where(F.col("th").isNotNull() & ~held_out(F.col("doc_id"), parts, part))
    found = own.join(known, F.col("doc_id") == F.col("i")).groupBy("i", "q").agg(F.min_by("x", "th").alias("x"))
    rows = cut(found.select("q", "x"), "ranked")
    model = fit_rows(rows, n.get(0, 0) / sum(n.values()))
    free(rows)
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    parts: int = 3,
    part: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> RankModel:
    """Fits on all documents with a label, whatever their number and length.

    Only labels whose id is not held out are read; null labels or texts are not learned from. The
    share of bad documents is counted over all labels that may be learned from. Features are computed
    where the texts are, one row an id (that of the smallest text hash), and stay there.
    """
    x = cut(featured(docs, id_col, text_col), "features")
    model = _learn(x, labels, parts, part, id_col, label_col)
    free(x)
    return model


def score_quality(docs: DataFrame, model: RankModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every whole text; null text is empty, other columns are ignored."""
    return _rated(featured(docs, id_col, text_col), model)


def _rated(x: DataFrame, model: RankModel) -> DataFrame:
    own = x.select("doc_id", "x")
    schema = own.select("doc_id", F.lit(0.0).alias("score")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.rate(b.column(1).flatten().to_numpy().reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return own.mapInArrow(work, schema).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def classify(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """Learns from labels that are not held out and scores all documents: (doc_id, held_out, score, predicted).

    A row for each row of docs; equal texts get equal scores, an empty table gives an empty result,
    and other columns are ignored. Labels that repeat are one; an id with both labels counts as both.
    Features are computed once, for learning and scoring.
    """
    x = cut(featured(docs), "features")
    out = _rated(x, _learn(x, labels, parts, part, "doc_id", "quality"))
    return out.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score", "predicted")
