"""Reading tables and running Python over text columns in bounded pieces."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows of an Arrow batch that a function sees at once, and the text after which a piece ends.
PIECE_ROWS, PIECE_CHARS = 256, 4_000_000


def ship(module_name: str) -> None:
    """Pickle a module's functions by value, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def kept_by_worker(key: object, make: Callable[[], object]) -> object:
    """An object that a Python worker makes once and later tasks of it find again."""
    holder = sys.modules.setdefault("sluice_worker_memo", ModuleType("sluice_worker_memo")).__dict__
    if key not in holder:
        holder[key] = make()
    return holder[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterator[pa.RecordBatch], text_at: int = 1) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces of few rows and little text, so that memory does not follow the batch size."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            rows = min(PIECE_ROWS, batch.num_rows - at)
            while rows > 1 and batch.slice(at, rows).column(text_at).nbytes > PIECE_CHARS:
                rows //= 2
            yield batch.slice(at, rows)
            at += rows


def over_texts(df: DataFrame, id_col: str, text_col: str, make: Callable[[], Callable[[list], dict]], schema: str, *more: str) -> DataFrame:
    """One row per row of ``df``: its id, then the columns that ``make()(texts, ...)`` returns
    as lists. ``make`` runs once per task and holds the task's tables and memos. Only the id,
    the text and the columns in ``more`` travel to Python, whatever else ``df`` has."""
    kind = df.schema[id_col].dataType.simpleString()
    names = [part.split()[0] for part in schema.split(",")]
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(f"more{k}") for k, c in enumerate(more)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for piece in pieces(batches):
            function = function or make()
            columns = [piece.column(k).to_pylist() for k in range(1, piece.num_columns)]
            out = function(*columns)
            yield pa.RecordBatch.from_arrays([piece.column(0), *(pa.array(out[n], type=types[n]) for n in names)], names=["id", *names])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    types = {f.name: to_arrow_type(f.dataType) for f in StructType.fromDDL(schema)}
    return narrow.mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def crc_mod(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % of


def filter_rows(df: DataFrame, text_col: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """The rows, with all their columns, for which ``make()(texts)`` says true."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for piece in pieces(batches, at):
            function = function or make()
            yield piece.filter(pa.array(function(piece.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def change_text(df: DataFrame, text_col: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """The rows with ``make()(texts)`` in place of their texts; other columns stay."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for piece in pieces(batches, at):
            function = function or make()
            yield piece.set_column(at, piece.schema.field(at), pa.array(function(piece.column(at).to_pylist()), piece.schema.field(at).type))

    return df.mapInArrow(run, df.schema)
