"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else, the same in every engine."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(docs: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, list[Column]]:
    """The columns under the names c0, c1, ..., which no helper column has, and the expressions that give them back.

    So no name of a user's column can meet one that an operator needs for itself.
    """
    columns = list(docs.columns if columns is None else columns)
    inside = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    return inside, [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]


def unused(name: str, columns: Sequence[str]) -> str:
    """The name, with as many underscores in front as keep it from being one of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def running_total(
    df: DataFrame, by: Sequence[str], bucket: str, order: Sequence[Column], value: Column, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all earlier rows with the same ``by``.

    Rows are ordered by ``bucket``, then ``order``; neither ``by`` nor ``bucket``
    may be null. The bucket splits a large ``by`` group: bucket sums are
    combined on the map side, only they are accumulated over a whole group, and
    every bucket is sorted on its own. So no task sees more rows of a group
    than one bucket holds.
    """
    keys = [*by, bucket]
    valued_, inside_, start_ = (unused(n, df.columns) for n in ("_value", "_inside", "_start"))
    valued = df.withColumn(valued_, value)
    sums = valued.groupBy(*keys).agg(F.sum(valued_).alias(start_))
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, F.coalesce(F.sum(start_).over(earlier), F.lit(0)).alias(start_))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        valued.withColumn(inside_, F.coalesce(F.sum(valued_).over(inside), F.lit(0)))
        .join(starts, keys)
        .withColumn(name, (F.col(start_) + F.col(inside_)).cast("long"))
        .drop(valued_, inside_, start_)
    )


def worker_path(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and keep their batches small."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def text_slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def fit_in_task(sample: DataFrame, order: Sequence[Column], train: Callable[[pa.Table], object]) -> object:
    """What ``train`` makes of a sample of bounded size, computed by one task so that the driver holds only the result.

    The sample's rows come in the given order. The result has to be picklable.
    """
    worker_path(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if found:
            result = pickle.dumps(train(pa.Table.from_batches(found)))
            yield pa.RecordBatch.from_arrays([pa.array([result], pa.binary())], names=["result"])

    rows = sample.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "result binary").collect()
    return pickle.loads(rows[0]["result"]) if rows else train(sample.limit(0).toArrow())
