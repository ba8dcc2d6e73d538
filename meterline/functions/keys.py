"""Forecast keys: build them from region and segment, and read them back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def series_key(region: Column, segment: Column) -> Column:
    """Key of a unit without suffix; folded regions carry ``ALL`` as segment."""
    return F.concat(region, F.when(region.isin(*C.FOLDED_REGIONS), F.lit("ALL")).otherwise(segment))


def first_match(text: Column, rules, default: str | None) -> Column:
    """Label of the first rule whose pattern the text is like."""
    result = None
    for pattern, label in rules:
        hit = text.like(pattern)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result.otherwise(F.lit(default))


def key_region(key: Column) -> Column:
    return first_match(F.lower(key), C.REGION_RULES, C.NO_REGION)


def key_segment(key: Column) -> Column:
    return first_match(F.trim(F.lower(key)), C.SEGMENT_RULES, C.NO_SEGMENT)


def renamed_region(region: Column) -> Column:
    result = region
    for old, new in C.REGION_RENAME.items():
        result = F.when(F.upper(region) == old, F.lit(new)).otherwise(result)
    return result
