"""Vector distances as Column expressions over ``array<double>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def dot(x: Column, y: Column) -> Column:
    return _fold(F.zip_with(x, y, lambda a, b: a * b))


def norm(x: Column) -> Column:
    return F.sqrt(_fold(F.transform(x, lambda a: a * a)))


def euclidean(x: Column, y: Column) -> Column:
    return F.sqrt(_fold(F.zip_with(x, y, lambda a, b: (a - b) * (a - b))))


def manhattan(x: Column, y: Column) -> Column:
    return _fold(F.zip_with(x, y, lambda a, b: F.abs(a - b)))


def cosine_similarity(x: Column, y: Column) -> Column:
    return dot(x, y) / (norm(x) * norm(y))


def cosine_distance(x: Column, y: Column) -> Column:
    return F.lit(1.0) - cosine_similarity(x, y)
