"""Pixel kernels over Spark's image source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Fixed weights of luma from red, green and blue.
LUMA = (0.299, 0.587, 0.114)


def gray(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """Gray pixels of an image struct; three or four channels come as blue, green, red (, alpha)."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return x[:, :, 0]
    return np.rint(x[:, :, 2] * LUMA[0] + x[:, :, 1] * LUMA[1] + x[:, :, 0] * LUMA[2]).astype(np.uint8)


def sharpness(g: np.ndarray) -> float:
    """Population variance of the 3 x 3 Laplacian, borders mirrored without repeating the edge."""
    p = np.pad(g.astype(np.float64), 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def _weights(n: int, m: int) -> np.ndarray:
    """m x n: the share of each of n cells in m equal stretches."""
    edge = np.arange(m + 1) * n / m
    low = np.maximum(edge[:-1, None], np.arange(n))
    high = np.minimum(edge[1:, None], np.arange(n) + 1)
    return np.clip(high - low, 0, None) * m / n


def thumbnail(g: np.ndarray, side: int = 64) -> np.ndarray:
    """Area average to side x side, as whole numbers."""
    return np.rint(_weights(g.shape[0], side) @ g.astype(np.float64) @ _weights(g.shape[1], side).T).clip(0, 255)


SCHEMA = "path string, width int, height int, sharpness double, brightness double, contrast double, thumb array<double>"


def frame_metrics(spark: SparkSession, path: str, side: int = 64) -> DataFrame:
    """Sharpness, brightness, contrast and thumbnail of every image under a path; an unreadable image is an error."""
    images = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(path).select("image.*")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples():
                if r.height <= 0 or r.width <= 0:
                    raise ValueError(f"cannot read image {r.origin}")
                g = gray(r.height, r.width, r.nChannels, r.data)
                rows.append((r.origin, r.width, r.height, sharpness(g), float(g.mean()), float(g.std()), thumbnail(g, side).ravel()))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return images.mapInPandas(work, SCHEMA)
