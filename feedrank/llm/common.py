"""Shared helpers of the training-data operators.

Every operator takes a DataFrame and reads its columns by name right at the
start (``narrow``), so extra or clashing columns of the caller never meet the
operator's own ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.session import delete_path, scratch_dir, ship_package

# Fixed value: ASCII white space, the separators of words.
WORD_SPACE = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ``documents`` table under ``sf_dir``, optionally only some columns."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return df.select(*columns) if columns else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (string) only."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage with files every executor can see, so a lost executor never
    recomputes what lies behind them.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete the files of :func:`stored` tables that nothing reads any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            delete_path(df.sparkSession, folder)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    """Arrow form of a DDL schema; also makes sure tasks can import this package."""
    from pyspark.sql.pandas.types import to_arrow_schema
    ship_package(spark)
    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def per_document(docs: DataFrame, schema: str,
                 rows: Callable[[Iterator[tuple]], Iterable[tuple]]) -> DataFrame:
    """Apply ``rows`` to (doc_id, text) pairs, a task at a time, through Arrow.

    ``rows`` gets an iterator over all pairs of one Arrow batch and yields
    result tuples in the order of ``schema``. One batch is in memory at a time.
    """
    return per_batch(narrow(docs), schema, rows)


def per_batch(df: DataFrame, schema: str,
              rows: Callable[[Iterator[tuple]], Iterable[tuple]]) -> DataFrame:
    """As :func:`per_document` for any columns: tuples in, tuples out."""
    target = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(rows(_tuples(batch)))
            columns = list(zip(*out)) if out else [[] for _ in target]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, target)], schema=target)

    return df.mapInArrow(run, schema)


def _tuples(batch: pa.RecordBatch) -> Iterator[tuple]:
    # Slices keep the Python strings of a large batch from living all at once.
    for start in range(0, batch.num_rows, 256):
        part = batch.slice(start, 256)
        yield from zip(*(c.to_pylist() for c in part.columns))


