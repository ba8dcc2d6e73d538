"""Small helpers of the operators: tables, folds, slices of a batch, column quoting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import shared_folder
from ..sources.shared import stored

__all__ = ["table", "fold", "slices", "col", "keep_columns", "unused", "stored", "shared_folder", "words_of", "map_texts", "SPACE"]

#: What separates words in all operators that split on ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[col(n) for n in names])


def fold(doc_id: Column, of: int) -> Column:
    """``crc32`` of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % F.lit(of)


def words_of(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def slices(lengths, budget: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``budget`` characters together; a longer row is a run of its own."""
    start, used = 0, 0
    for i, n in enumerate(lengths):
        if i > start and used + n > budget:
            yield start, i
            start, used = i, 0
        used += n
    if start < len(lengths):
        yield start, len(lengths)


def map_texts(df: DataFrame, text: str, keep: list[str], fields: list[tuple[str, str]],
              work: Callable[[list[str | None]], list], budget: int = 1_500_000) -> DataFrame:
    """Columns ``keep`` of every row, unchanged, and the columns that ``work`` makes from its text.

    ``work`` gets the texts of some rows, about ``budget`` characters together (null: None), and
    returns a list of values for each of ``fields`` (name, type). Runs in tasks, without a shuffle.
    """
    made = [T.StructField(f"m{i}", T._parse_datatype_string(kind)) for i, (_, kind) in enumerate(fields)]
    # plain names inside: mapInArrow looks columns up by name, which fails for names with a dot
    kept = [T.StructField(f"c{i}", df.schema[name].dataType) for i, name in enumerate(keep)]
    arrow = [to_arrow_type(f.dataType) for f in made]
    names = [*(f.name for f in kept), *(f.name for f in made)]
    at = keep.index(text) if text in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, last = batch.columns[: len(keep)], batch.column(at)
            lengths = [x.as_buffer().size if x.is_valid else 0 for x in last] if len(last) else []
            for lo, hi in slices(lengths, budget):
                columns = work(last.slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [k.slice(lo, hi - lo) for k in keys] + [pa.array(c, type=t) for c, t in zip(columns, arrow)], names=names)

    given = [col(n).alias(f.name) for n, f in zip(keep, kept)] + ([] if text in keep else [col(text).alias("t")])
    out = df.select(*given).mapInArrow(run, T.StructType([*kept, *made]))
    return out.toDF(*keep, *(name for name, _ in fields))
