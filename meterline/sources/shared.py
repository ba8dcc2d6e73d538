"""Build each table of a query once.

Queries are composed of functions that return lazy DataFrames. Within one query build the
same table is often asked for several times; ``shared`` hands out one DataFrame for it, which
saves analysis time and gives Spark equal subplans whose exchanges it can reuse. The memory
lives only as long as the build of one query, so no file listing is kept beyond it.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame

from ..session import run_folder

_BUILT: ContextVar[dict | None] = ContextVar("built", default=None)


@contextmanager
def one_build():
    """Share tables inside the block; a build within a build joins the outer one."""
    if _BUILT.get() is not None:
        yield
        return
    token = _BUILT.set({})
    try:
        yield
    finally:
        _BUILT.reset(token)


def shared(build):
    """Mark a table function ``build(spark, sf_dir, ...)``."""

    @wraps(build)
    def once(spark, sf_dir, *args):
        built = _BUILT.get()
        if built is None:
            return build(spark, sf_dir, *args)
        key = (build.__module__, build.__qualname__, sf_dir, args)
        if key not in built:
            built[key] = build(spark, sf_dir, *args)
        return built[key]

    return once


_KEPT: dict[tuple, DataFrame] = {}


def kept(settings):
    """Mark a table function whose result is stored and kept for the application, as a job keeps its output for others.

    For fits, which many queries read. ``settings`` is called for what the fit depends on beside the data.
    """

    def mark(build):
        @wraps(build)
        def once(spark, sf_dir):
            key = (spark.sparkContext.applicationId, build.__module__, build.__qualname__, sf_dir, repr(settings()))
            if key not in _KEPT:
                _KEPT[key] = stored(build(spark, sf_dir))
            return _KEPT[key]

        return once

    return mark


def stored(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Write a table that a query reads several times to the shared folder and read it back.

    The raw usage behind it is then scanned once, plans above it stay short, later scans are
    pruned to their columns, and a lost executor costs no recomputation of the raw part.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/table-{uuid.uuid4().hex}"
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
