"""Language ID by string kernels."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trivet.llm.common import hash60

BITS = 16  # n-grams of each length are hashed to 2**BITS columns
_MAYBE = re.compile(r"[^\W\d_]")  # letters, and a few numbers such as superscripts


def has_letter(text: str) -> bool:
    """Whether a character of the text is of Unicode category L."""
    return any(m[0].isalpha() for m in _MAYBE.finditer(text))


def ngram_flags(text: str, flags: np.ndarray, lengths: int) -> None:
    """Marks in flags (lengths * 2**BITS booleans, cleared first) the character n-grams that the whole text holds."""
    flags[:] = False
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    h = np.zeros(len(c), np.uint32)
    for n in range(lengths):
        if len(c) <= n:
            break
        h = (h[: len(c) - n] + c[n:] + np.uint32(1)) * np.uint32(2654435761)
        flags[(h >> np.uint32(32 - BITS)) + np.uint32(n << BITS)] = True
        h ^= h >> np.uint32(15)


@dataclass(frozen=True)
class LanguageModel:
    """One-versus-rest ridge scores as weights of the landmarks' n-grams."""

    langs: list[str]
    lengths: int
    cols: np.ndarray  # the columns that a landmark holds
    weights: np.ndarray  # a row for each of cols, a column for each language

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The best language of each text and its share of a softmax over the scores; und, 0 without a letter."""
        flags = np.zeros(self.lengths << BITS, bool)
        x = np.zeros((len(texts), len(self.cols)), np.float32)
        norm = np.ones(len(texts))
        known = np.zeros(len(texts), bool)
        for i, t in enumerate(texts):
            if self.langs and t is not None and has_letter(t):
                ngram_flags(t, flags, self.lengths)
                x[i] = flags[self.cols]
                norm[i] = max(1, np.count_nonzero(flags)) ** 0.5
                known[i] = True
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        s = (x @ self.weights) / norm[:, None]
        e = np.exp(4.0 * (s - s.max(axis=1, keepdims=True)))
        best = s.argmax(axis=1)
        p = e[np.arange(len(texts)), best] / e.sum(axis=1)
        return [self.langs[b] if k else "und" for b, k in zip(best, known, strict=True)], np.where(known, p, 0.0)


def fit(texts: list[str], langs: list[str], landmarks: int = 256, ridge: float = 1e-2, lengths: int = 3) -> LanguageModel:
    """Kernel ridge regression on Nyström features of the blended-spectrum presence kernel.

    k(x, y) is the number of n-grams of 1 to `lengths` characters that both texts hold, over the root
    of the product of their own numbers. Features are K(x, landmarks) K(landmarks, landmarks)^-1/2;
    a ridge regression on +1 and -1 is solved for each language. As K(x, landmarks) is itself the
    product of n-gram presence and the landmarks' n-grams, the landmarks are multiplied into the
    ridge weights once, and a batch of texts is scored by one product of matrices.
    """
    names = sorted(set(langs))
    if not names:
        return LanguageModel([], lengths, np.zeros(0, np.int64), np.zeros((0, 0), np.float32))
    y = np.array([names.index(v) for v in langs])
    rank = np.zeros(len(y), int)  # of a text among those of its language: landmarks are spread evenly
    for k in range(len(names)):
        rank[y == k] = np.arange((y == k).sum())
    marks = np.lexsort((y, rank))[:landmarks]
    flags = np.zeros(lengths << BITS, bool)
    sets, norm = [], np.ones(len(texts))
    for i, t in enumerate(texts):
        ngram_flags(t, flags, lengths)
        sets.append(np.flatnonzero(flags).astype(np.int32))
        norm[i] = max(1, len(sets[-1])) ** 0.5
    cols = np.unique(np.concatenate([sets[i] for i in marks])) if len(marks) else np.zeros(0, np.int64)
    at = np.full(lengths << BITS, -1, np.int32)
    at[cols] = np.arange(len(cols), dtype=np.int32)

    def rows(of: np.ndarray) -> np.ndarray:
        x = np.zeros((len(of), len(cols)), np.float32)
        for r, i in enumerate(of):
            own = at[sets[i]]
            x[r, own[own >= 0]] = 1 / norm[i]
        return x

    mark_rows = rows(marks)
    kmm = (mark_rows @ mark_rows.T).astype(np.float64)
    val, vec = np.linalg.eigh(kmm)
    root = vec / np.sqrt(np.maximum(val, 1e-6 * val.max())) @ vec.T
    phi = np.concatenate([(rows(np.arange(a, min(a + 256, len(y)))) @ mark_rows.T).astype(np.float64) @ root for a in range(0, len(y), 256)])
    goal = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    w = np.linalg.solve(phi.T @ phi + ridge * len(y) / 100 * np.eye(len(marks)), phi.T @ goal)
    return LanguageModel(names, lengths, cols.astype(np.int64), (mark_rows.T @ (root @ w)).astype(np.float32))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text, modulo parts, is part; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == part


def train(
    docs: DataFrame,
    per_lang: int = 400,
    max_rows: int = 20_000,
    max_langs: int = 250,
    max_chars: int = 20_000,
    max_total: int = 40_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """Fits on a bounded sample: per language the per_lang texts with the smallest id hash, of those with
    1 to max_chars characters; at most max_rows and max_total characters in all. Of more than max_langs
    languages the most frequent are learned (ties by name)."""
    d = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where("l is not null and t is not null")
    d = d.where(F.length("t").between(1, max_chars)).withColumn("h", hash60(F.coalesce(F.col("i").cast("string"), F.md5("t"))))
    counts = {r["l"]: r["count"] for r in d.groupBy("l").count().orderBy(F.desc("count"), "l").limit(max_langs).collect()}
    if not counts:
        return fit([], [])
    most = max(1, min(per_lang, max_rows // len(counts)))
    below = F.lit(0)
    for lang, n in counts.items():  # twice the rows wanted; the exact number follows
        below = F.when(F.col("l") == lang, int(min(1.0, 2 * most / n + 0.0) * ((1 << 60) - 1))).otherwise(below)
    first = Window.partitionBy("l").orderBy("h", "i")
    few = d.where(F.col("h") <= below).withColumn("r", F.row_number().over(first)).where(F.col("r") <= most)
    few = few.withColumn("c", F.sum(F.length("t")).over(first.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("c") <= max_total // len(counts))
    got = sorted(((r["l"], r["h"], r["t"]) for r in few.select("l", "h", "t").collect()))
    return fit([x[2] for x in got], [x[0] for x in got])


def predict_languages(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Adds lang_pred and score (0 to 1) to doc_id, text and the columns of carry.

    A text that is null or has no letter, and any text where nothing was learned, is `und` with
    score 0. Texts are read whole, however long, in slices of 128 rows of an Arrow batch; repeated
    rows get equal results. Other columns are ignored.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"_c_{c}") for c in carry])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 128):
                b = whole.slice(a, 128)
                lang, p = model.predict(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(p, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])

    schema = own.selectExpr("*", "'' as lang_pred", "0D as score").schema
    out = own.mapInArrow(score, schema)
    return out.select("doc_id", "text", "lang_pred", "score", *[F.col(f"_c_{c}").alias(c) for c in carry])


def identify(docs: DataFrame, parts: int = 4, part: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the rows that are not held out and predicts all: (doc_id, held_out, lang_pred, score).

    A row for each input row; repeated rows and ties of ids are rows of their own, an empty table gives
    an empty result, and where no row has a language every text is und.
    """
    model = train(docs.where(~held_out(F.col(id_col), parts, part)), id_col=id_col, text_col=text_col, lang_col=lang_col)
    out = predict_languages(docs, model, id_col, text_col)
    return out.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "lang_pred", "score")
