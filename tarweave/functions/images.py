"""Pixel statistics on Spark's image struct, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarweave.schemas import IMAGE

CHANNELS = 3
BINS = 256


def _channel_counts(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """Counts of each byte value, one row for each of the first three channels."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height * width, channels)
    # One bincount over (channel, value) codes instead of one per channel.
    codes = pixels[:, :CHANNELS].astype(np.int32) + np.arange(CHANNELS, dtype=np.int32) * BINS
    return np.bincount(codes.ravel(), minlength=CHANNELS * BINS).reshape(CHANNELS, BINS)


def _usable(height, width, channels, data) -> bool:
    if data is None or pd.isna(height) or pd.isna(width) or pd.isna(channels):
        return False
    return height * width > 0 and channels >= CHANNELS and len(data) == height * width * channels


def largest_share(height: int, width: int, channels: int, data: bytes) -> float | None:
    """``dominance`` of one image; None when it has no usable pixels."""
    if not _usable(height, width, channels, data):
        return None
    return float(_channel_counts(height, width, channels, data).max() / (height * width))


def _image_rows(images: pd.DataFrame):
    for h, w, c, data in zip(images["height"], images["width"], images["nChannels"], images["data"]):
        yield (int(h), int(w), int(c), data) if _usable(h, w, c, data) else None


def channel_histogram(image: Column) -> Column:
    """Three arrays of 256 counts, in the channel order of the struct."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.LongType())))
    def histogram(images: pd.DataFrame) -> pd.Series:
        return pd.Series([None if r is None else list(_channel_counts(*r)) for r in _image_rows(images)])

    return histogram(image)


def dominance(image: Column) -> Column:
    """Largest share of the pixels that one value takes in any channel.

    Null for an image with fewer than three channels or the wrong length.
    """

    @F.pandas_udf(T.DoubleType())
    def shares(images: pd.DataFrame) -> pd.Series:
        return pd.Series([None if r is None else largest_share(*r) for r in _image_rows(images)], dtype="float64")

    return shares(image)


def is_monochromatic(image: Column, threshold: float = 0.95) -> Column:
    """True when one value of a channel covers strictly more than ``threshold``."""
    return dominance(image) > F.lit(threshold)


def is_not_monochromatic(image: Column, threshold: float = 0.8) -> Column:
    return ~is_monochromatic(image, threshold)


def decode_one(raw: bytes | None, decode: Callable[[bytes], np.ndarray]) -> tuple[dict | None, str | None]:
    """Image struct and error, one of them None; a bad sample never ends the shard."""
    if raw is None:
        return None, "no image bytes"
    try:
        rgb = np.asarray(decode(raw), dtype=np.uint8)
        height, width, channels = rgb.shape
    except Exception as problem:
        return None, f"{type(problem).__name__}: {problem}"
    bgr = np.ascontiguousarray(rgb[:, :, ::-1])
    return {"origin": "", "height": height, "width": width, "nChannels": channels, "mode": 16,
            "data": bgr.tobytes()}, None


def decode_image(data: Column, decode: Callable[[bytes], np.ndarray]) -> Column:
    """Run a codec plug-in: ``struct<image, error>`` with one of the two null.

    ``decode`` returns a height x width x 3 array of RGB bytes.
    """
    result = T.StructType([T.StructField("image", IMAGE), T.StructField("error", T.StringType())])

    @F.pandas_udf(result)
    def decoded(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode_one(raw, decode) for raw in column], columns=["image", "error"])

    return decoded(data)
