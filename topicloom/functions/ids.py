"""Identifiers, noise predicate and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import NOISE_SUFFIX


def topic_id(label: Column, day: Column) -> Column:
    """``{day}_{sha256 of "{day}_{label}"}_{label}``."""
    d = F.date_format(day, "yyyy-MM-dd")
    text = label.cast("string")
    return F.concat_ws("_", d, F.sha2(F.concat_ws("_", d, text), 256), text)


def split_id(old_id: Column, sub_label: Column, day: Column) -> Column:
    """Id of one part of a split topic: the hash covers the whole old id, so equally numbered
    topics of different days cannot meet."""
    d = F.date_format(day, "yyyy-MM-dd")
    sub = sub_label.cast("string")
    return F.concat_ws("_", d, F.sha2(F.concat_ws("_", d, old_id, sub), 256),
                       F.concat_ws(".", id_label(old_id), sub))


def noise_id(day: Column) -> Column:
    return topic_id(F.lit("-1"), day)


def is_noise(topic: Column) -> Column:
    return topic.endswith(NOISE_SUFFIX)


def id_label(topic: Column) -> Column:
    """Part after the last underscore."""
    return F.substring_index(topic, "_", -1)


def id_day(topic: Column) -> Column:
    """Part before the first underscore."""
    return F.substring_index(topic, "_", 1)


def midnight(text: Column) -> Column:
    """``2024-01-30T10:11:12.345Z`` to the start of that day (UTC session); NULL when malformed."""
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]'Z'"))
    return F.date_trunc("day", parsed)


def first_value(column: Column) -> Column:
    """First element of a multi-valued field, NULL for an empty list."""
    return F.try_element_at(column, F.lit(1))


def reference_date(value: dt.datetime | dt.date | str) -> dt.date:
    """Job argument to a date; text must be ``YYYY-MM-DD``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    if isinstance(value, str):
        try:
            return dt.datetime.strptime(value, "%Y-%m-%d").date()
        except ValueError as error:
            raise TypeError(f"not a YYYY-MM-DD date: {value!r}") from error
    raise TypeError(f"expected datetime, date or text, got {type(value).__name__}")
