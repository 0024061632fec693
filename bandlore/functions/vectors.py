"""Expressions over the feature array of one row."""

from pyspark.sql import functions as F

from bandlore.functions.scalar import col


def total(values):
    return F.aggregate(col(values), F.lit(0.0), lambda acc, v: acc + v)


def dot(left, right):
    return total(F.zip_with(col(left), col(right), lambda a, b: a * b))


def subtract(left, right):
    return F.zip_with(col(left), col(right), lambda a, b: a - b)


def shift_scale(features, shift, scale):
    """(x - shift) / scale, element by element."""
    return F.zip_with(subtract(features, shift), col(scale), lambda d, s: d / s)


def unscale(features, shift, scale):
    """x * scale + shift, element by element."""
    scaled = F.zip_with(col(features), col(scale), lambda x, s: x * s)
    return F.zip_with(scaled, col(shift), lambda x, m: x + m)


def sigmoid(score):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(score)))


def literal_array(values):
    return F.array(*[F.lit(float(v)) for v in values])
