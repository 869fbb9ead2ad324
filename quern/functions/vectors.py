"""Vector columns: similarity, normalization, bit packing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine_similarity(a: Column, b: Column) -> Column:
    """NULL when either vector has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_squared(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x * x)


def l2_normalize(v: Column) -> Column:
    """Unit vector; the norm is taken once per row, not once per element."""
    scaled = F.transform(
        F.array(norm(v)), lambda n: F.transform(v, lambda x: (x.cast("double") / n).cast("float"))
    )
    return F.get(scaled, 0)


def pack_bits(bits: Column) -> Column:
    """A 64-element 0/1 vector as one bigint, element 0 in the lowest bit."""

    def bit(i: int) -> Column:
        value = (1 << i) if i < 63 else -(1 << 63)
        return F.when(F.get(bits, i) > 0.5, F.lit(value)).otherwise(F.lit(0)).cast("bigint")

    return F.when(bits.isNotNull(), reduce(lambda a, b: a.bitwiseOR(b), [bit(i) for i in range(64)]))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two packed vectors."""
    return F.bit_count(a.bitwiseXOR(b))


def similarity_verdict(similarity: Column, threshold: float = 0.9) -> Column:
    return F.when(
        F.coalesce(similarity, F.lit(0.0)) > threshold, "close"
    ).otherwise("distant")
