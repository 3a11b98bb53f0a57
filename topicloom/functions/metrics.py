"""Weighted distances as Column expressions (see ``settings.Metric``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import DIGITS, Metric
from .vectors import euclidean


def weighted(metric: Metric, parts: dict[str, Column], category: Column) -> Column:
    """Distance from ready vector distances per metric column and a ready category term."""
    total = reduce(lambda s, v: s + F.lit(v[1]) * parts[v[0]], metric.vectors, F.lit(metric.category) * category)
    return F.greatest(F.least(total, F.lit(1.0)), F.lit(0.0)) if metric.cap else total


def distance(metric: Metric, x: dict[str, Column], y: dict[str, Column], category: Column) -> Column:
    """Distance between two rows given as maps from metric column to vector column."""
    return weighted(metric, {c: euclidean(x[c], y[c]) for c in metric.columns}, category)


def comparable(value: Column) -> Column:
    return F.round(value, DIGITS)
