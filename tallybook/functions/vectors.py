"""Array and fingerprint functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import col


def _fold(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a, b) -> Column:
    return _fold(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm2(a) -> Column:
    return _fold(F.transform(col(a), lambda x: x.cast("double") * x.cast("double")))


def cosine(a, b) -> Column:
    """Cosine similarity; NULL if a norm is zero."""
    n = F.sqrt(norm2(a) * norm2(b))
    return F.when(n > 0, dot(a, b) / n)


def unit_vector(a) -> Column:
    n = F.sqrt(norm2(a))
    return F.when(n > 0, F.transform(col(a), lambda x: x.cast("double") / n))


def match_count(a, b) -> Column:
    """Number of positions with equal values."""
    return _fold(F.zip_with(col(a), col(b), lambda x, y: F.when(x == y, 1.0).otherwise(0.0))).cast("bigint")


def hamming(a, b) -> Column:
    """Positions that differ between two equal-length arrays; unequal lengths raise."""
    a, b = col(a), col(b)
    diff = _fold(F.zip_with(a, b, lambda x, y: F.when(x == y, 0.0).otherwise(1.0))).cast("bigint")
    return F.when(F.size(a) == F.size(b), diff).otherwise(
        F.raise_error(F.lit("vectors are not the same length")).cast("bigint")
    )


def hamming_text(a, b) -> Column:
    """Hamming distance of two strings by character."""
    return hamming(F.split(col(a), ""), F.split(col(b), ""))


def hamming_bits(a, b) -> Column:
    """Hamming distance of two packed fingerprints."""
    return F.bit_count(col(a).bitwiseXOR(col(b))).cast("bigint")


def bit_similarity(a, b) -> Column:
    """Share of equal places of two bit arrays of the same length, whatever it is."""
    return F.lit(1.0) - hamming(a, b) / F.size(col(a))


def pair_loss(p, q, e) -> Column:
    """Logistic pair loss log(1 + exp(-e <p, q>)); ``e`` is +1 for linked pairs and -1 for others."""
    return F.log1p(F.exp(-col(e) * dot(p, q)))


def zscore(a) -> Column:
    """Centre an array and scale it to unit length, so that a dot product is a correlation."""
    a = col(a)
    mean = _fold(F.transform(a, lambda x: x.cast("double"))) / F.size(a)
    dev = F.transform(a, lambda x: x.cast("double") - mean)
    n = F.sqrt(norm2(dev))
    return F.when(n > 0, F.transform(dev, lambda x: x / n)).otherwise(F.transform(dev, lambda x: F.lit(0.0)))
