"""Column functions on ``array<float>`` vectors; arithmetic is in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def normalize(vector: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    norm = l2_norm(vector)
    return F.when(norm > 0, F.transform(as_double(vector), lambda x: x / norm)).otherwise(as_double(vector))


def cosine(a: Column, b: Column) -> Column:
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def squared_l2(a: Column, b: Column) -> Column:
    squares = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def cosine_from_squared_l2(distance: Column) -> Column:
    """Holds for unit vectors."""
    return 1 - distance / 2


def angular_distance(cos: Column) -> Column:
    return F.sqrt(F.greatest(2 * (1 - cos), F.lit(0.0)))


def closeness(distance: Column) -> Column:
    return 1 / (1 + distance)
