"""Parsing of label responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: markers that may precede a label or tag list in a response
LABEL_MARKERS = ("cluster label:", "Cluster label:")
TAG_MARKERS = ("cluster tags:", "Cluster tags:")
COMMUNITY_MARKERS = ("COMMUNITY:", "Community:")


def _without(text: Column, markers: tuple[str, ...]) -> Column:
    for marker in markers:
        text = F.when(text.contains(marker), _strip(F.replace(text, F.lit(marker), F.lit("")))).otherwise(text)
    return text


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _unwrap(text: Column, left: str, right: str) -> Column:
    inner = F.substring(text, F.lit(2), F.greatest(F.char_length(text) - 2, F.lit(0)))
    return F.when(text.startswith(left) & text.endswith(right), _strip(inner)).otherwise(text)


def _undash(text: Column) -> Column:
    return F.when(text.startswith("-"), _strip(F.substring(text, F.lit(2), F.char_length(text)))).otherwise(text)


def response_label(response: Column) -> Column:
    """Label on the first line: marker, then quotes, then a leading dash are removed."""
    line = F.split_part(response, F.lit("\n"), F.lit(1))
    return _undash(_unwrap(_without(line, LABEL_MARKERS), '"', '"'))


def response_tags(response: Column) -> Column:
    """Tags on the second line: marker, dash, quotes, brackets, then split at commas."""
    line = F.split_part(response, F.lit("\n"), F.lit(2))
    text = _unwrap(_unwrap(_undash(_without(line, TAG_MARKERS)), '"', '"'), "[", "]")
    tags = F.transform(F.split(text, ","), _strip)
    return F.when(line == "", F.array().cast("array<string>")).otherwise(tags)


def community_label(response: Column) -> Column:
    return _unwrap(_undash(_without(response, COMMUNITY_MARKERS)), '"', '"')
