"""Pixel features over encoded images, one Arrow batch at a time."""

from __future__ import annotations

import io
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# BT.601 luma weights and the gray-world temperature range.
LUMA = (0.299, 0.587, 0.114)
REFERENCE_KELVIN, MIN_KELVIN, MAX_KELVIN = 6500.0, 2500.0, 10000.0

SIZE_TYPE = T.StructType(
    [T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]
)


def read_size(raw: bytes) -> tuple[int, int] | None:
    """(width, height) from a PNG, PPM or JPEG header; NULL for other data."""
    if raw[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", raw[16:24])
    if raw[:2] == b"P6":
        _, width, height, _ = raw[:64].split(maxsplit=3)
        return int(width), int(height)
    if raw[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(raw) and raw[at] == 0xFF:
            marker = raw[at + 1]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", raw[at + 5 : at + 9])
                return width, height
            at += 2 + struct.unpack(">H", raw[at + 2 : at + 4])[0]
    return None


def decode_rgb(raw: bytes) -> np.ndarray:
    """Height x width x 3 pixels. PPM is read here; other formats need an image package."""
    if raw[:2] == b"P6":
        _, width, height, rest = raw.split(maxsplit=3)
        header_end = len(raw) - len(rest) + len(rest.split(maxsplit=1)[0]) + 1
        width, height = int(width), int(height)
        pixels = np.frombuffer(raw, np.uint8, width * height * 3, header_end)
        return pixels.reshape(height, width, 3)
    from PIL import Image

    return np.asarray(Image.open(io.BytesIO(raw)).convert("RGB"))


@lru_cache(maxsize=256)
def _taps(size: int, target: int):
    """Bilinear source rows and weights for half-pixel centers."""
    at = np.maximum((np.arange(target) + 0.5) * (size / target) - 0.5, 0.0)
    low = np.minimum(at.astype(int), size - 1)
    return low, np.minimum(low + 1, size - 1), at - low


def difference_bits(pixels: np.ndarray) -> np.ndarray:
    """64 bits: on an 8 x 9 gray thumbnail, is a pixel brighter than its right neighbor."""
    gray = pixels.astype(np.float64) @ np.array(LUMA)
    r0, r1, rw = _taps(gray.shape[0], 8)
    c0, c1, cw = _taps(gray.shape[1], 9)
    rows = gray[r0] * (1 - rw)[:, None] + gray[r1] * rw[:, None]
    small = rows[:, c0] * (1 - cw) + rows[:, c1] * cw
    return (small[:, :-1] > small[:, 1:]).reshape(64).astype(np.float32)


def gray_world_kelvin(pixels: np.ndarray) -> float:
    """Color temperature from the red/blue ratio of the channel means."""
    red, blue = (pixels[:, :, c].mean(dtype=np.float64) for c in (0, 2))
    ratio = red / (blue + 1e-6)
    return float(np.clip(REFERENCE_KELVIN / (ratio + 1e-6), MIN_KELVIN, MAX_KELVIN))


def pixel_feature(compute, dtype: T.DataType, arrow_type: pa.DataType, decode=decode_rgb):
    """A column function applying ``compute`` to decoded images; NULL stays NULL."""

    @F.arrow_udf(dtype)
    def feature(images: pa.Array) -> pa.Array:
        values = (None if raw is None else compute(decode(raw)) for raw in images.to_pylist())
        return pa.array(list(values), arrow_type)

    return feature


dhash = pixel_feature(difference_bits, T.ArrayType(T.FloatType()), pa.list_(pa.float32()))
white_balance = pixel_feature(gray_world_kelvin, T.FloatType(), pa.float32())


@F.arrow_udf(SIZE_TYPE)
def image_size(images: pa.Array) -> pa.Array:
    sizes = [None if raw is None else read_size(raw) for raw in images.to_pylist()]
    return pa.array(
        [None if s is None else {"width": s[0], "height": s[1]} for s in sizes],
        pa.struct([("width", pa.int32()), ("height", pa.int32())]),
    )
