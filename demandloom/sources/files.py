"""Reading the source files and reading and writing result tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.config import MONTH
from demandloom.operators import boosting
from demandloom.schemas import SCHEMAS, TIMESTAMP_FORMAT, struct_of


def _without_nan(df: DataFrame) -> DataFrame:
    """NaN text in a number column means no value; Spark would compare it as the largest number."""
    missing = F.lit(None).cast("double")
    doubles = {f.name: F.nanvl(f.name, missing) for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(doubles) if doubles else df


#: Text is quoted where needed, and a quote inside a text is doubled.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """CSV with a header, columns matched by name, unreadable values as NULL.

    Columns come in the order of the header, further ones as text; a column of
    the schema that the files lack is added as NULL. Files of one folder must
    agree in their header: one that names the columns otherwise stops the job,
    since Spark reads them by position. ``multiline`` lets a quoted text run
    over several lines; such a file is read by one task, so keep large tables in
    many files or in parquet.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multiline, enforceSchema=False)
    header = reader.csv(path).columns
    typed = {f.name: f for f in schema}
    present = T.StructType([typed.get(c, T.StructField(c, T.StringType())) for c in header])
    found = reader.options(mode="PERMISSIVE", timestampNTZFormat=TIMESTAMP_FORMAT).schema(present).csv(path)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in header}
    return _without_nan(found.withColumns(absent) if absent else found)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with the columns and types of the schema; columns that the files lack are NULL, others are left out."""
    stored = spark.read.parquet(path)
    return stored.select(
        *[(F.col(f.name) if f.name in stored.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def scan_tolerant(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", multiline: bool = False
) -> DataFrame:
    """The table, or no rows with the same schema when the path does not exist.

    A folder without any data file, as a failed write leaves it, is an error.
    """
    try:
        return scan_csv(spark, path, schema, multiline) if fmt == "csv" else scan_parquet(spark, path, schema)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_sources(
    spark: SparkSession, base: str, fmt: str = "csv", files: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """All source tables below ``base``; ``files`` overrides the name of a table's file.

    Reviews hold free text, so their texts may run over several lines.
    """
    names = files or {}
    return {
        table: scan_tolerant(spark, f"{base}/{names.get(table, f'{table}.{fmt}')}", schema, fmt, table == "reviews")
        for table, schema in SCHEMAS.items()
    }


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_table(df: DataFrame, path: str, partition_by: str = MONTH) -> None:
    """Parquet, one folder per month.

    The rebalance hint brings the rows of a month together for few files, and
    splits a month that is too large for one task.
    """
    df.hint("rebalance", F.col(partition_by)).write.mode("overwrite").partitionBy(partition_by).parquet(path)


def read_csv_like(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored table, or the built one when nothing is stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return build()


# Snapshots: each version is written to its own folder and then listed in a log. The
# log has one small file for each entry, numbered from 0; an entry is written by
# creating the file of the next number, which fails if another writer was first and
# is then tried with the number after it. A reader takes the entry with the highest
# number, so it never sees a half written version, no writer hides another one, and
# clocks do not matter. Earlier versions stay as backups.

LOG_SCHEMA = struct_of("number long, version string, path string")


def new_version() -> str:
    """A readable name; the order of versions is that of the log."""
    return f"{datetime.now(timezone.utc).strftime('%Y%m%d_%H%M%S_%f')}_{uuid.uuid4().hex[:8]}"


def log_entries(spark: SparkSession, log: str) -> DataFrame:
    """(number, version, path) of the complete entries; none if nothing has been written yet."""
    try:
        stored = spark.read.schema(LOG_SCHEMA).json(log)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)
    return stored.where(F.col("path").isNotNull())


def _next_number(spark: SparkSession, log: str) -> int:
    return log_entries(spark, log).agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]


def _log(spark: SparkSession, log: str, version: str, path: str) -> int:
    """List a version under the next free number, which is returned. The file system must create files exclusively, as HDFS does."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(log).getFileSystem(spark._jsc.hadoopConfiguration())
    number = _next_number(spark, log)
    while True:
        target = hadoop.Path(f"{log}/{number:020d}.json")
        try:
            out = system.create(target, False)
        except Py4JJavaError:
            if not system.exists(target):
                raise
            number += 1
            continue
        try:
            out.write(bytearray(json.dumps({"number": number, "version": version, "path": path}).encode()))
        finally:
            out.close()
        return number


def _newest(spark: SparkSession, log: str, version: str | None = None) -> str:
    entries = log_entries(spark, log)
    wanted = entries.filter(F.col("version") == version) if version else entries
    entry = wanted.orderBy(F.desc("number")).first()
    if entry is None:
        raise FileNotFoundError(f"nothing listed in {log}")
    return entry["path"]


def write_snapshot(df: DataFrame, root: str, version: str | None = None) -> str:
    version = version or new_version()
    path = f"{root}/data/version={version}"
    df.write.parquet(path)
    _log(df.sparkSession, f"{root}/log", version, path)
    return version


def snapshot_log(spark: SparkSession, root: str) -> DataFrame:
    return log_entries(spark, f"{root}/log")


def read_snapshot(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    return spark.read.parquet(_newest(spark, f"{root}/log", version))


def save_models(
    spark: SparkSession, models: dict[str, PipelineModel | boosting.BoostedTrees], best: str | None, root: str, version: str | None = None
) -> list[str]:
    """Each trained model under a versioned name; the log ``model_latest`` then names the best one.

    A reader of the log finds the model before until the new one is complete.
    """
    version = version or new_version()
    paths = {name: f"{root}/model_{name}_{version}" for name in models}
    for name, model in models.items():
        if isinstance(model, boosting.BoostedTrees):
            boosting.save(spark, model, paths[name])
        else:
            model.write().overwrite().save(paths[name])
    if best in models:
        _log(spark, f"{root}/model_latest", version, paths[best])
    return list(paths.values())


def load_model(spark: SparkSession, path: str) -> PipelineModel | boosting.BoostedTrees:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/trees")
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return boosting.load(spark, path)
    return PipelineModel.load(path)


def latest_model(spark: SparkSession, root: str) -> PipelineModel | boosting.BoostedTrees:
    """The best model of the newest training."""
    return load_model(spark, _newest(spark, f"{root}/model_latest"))
