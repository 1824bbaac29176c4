"""What a tolerant scan cannot read, and what types a file's columns have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.schemas import TIMESTAMP_FORMAT
from demandloom.session import materialize
from demandloom.sources.files import CSV_OPTIONS

BROKEN = "_corrupt_record"
REJECTS = "array<struct<column_name: string, raw: string, reason: string>>"


def _read_as(c: str, kind: T.DataType) -> Column:
    """The text as a value of the type, or NULL; NaN text is no value."""
    text = F.col(f"`{c}`")
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)).cast(kind)
    value = text.try_cast(kind)
    return F.nanvl(value, F.lit(None).cast(kind)) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def scan_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The typed rows of CSV files with a header, and (file, column_name, raw, reason) for all that could not be read.

    The files are scanned once: rows come as text with the line they are from
    where its fields do not match the header, are given their types, and are
    stored with their rejects. A value that is not of its column's type is NULL in
    the row and a reject with its text; empty fields and NaN text are missing
    values, no rejects. A line whose fields do not match the header, as one cut off inside quotes, is
    a reject with column_name NULL and the whole line, and no row.
    Columns come in the order of the header; further ones stay text, absent ones are NULL.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multiline, enforceSchema=False)
    header = reader.csv(path).columns
    texts = T.StructType([T.StructField(c, T.StringType()) for c in [*header, BROKEN]])
    lines = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN).schema(texts).csv(path)
    kinds = {f.name: f.dataType for f in schema}
    typed = {c: _read_as(c, kinds[c]) for c in header if c in kinds}
    entries = [
        F.when(
            F.col(f"`{c}`").isNotNull() & value.isNull() & (F.lower(F.trim(F.col(f"`{c}`"))) != "nan"),
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("raw"), F.lit(f"no {kinds[c].simpleString()}").alias("reason")),
        )
        for c, value in typed.items()
        if not isinstance(kinds[c], T.StringType)
    ]
    line = F.struct(
        F.lit(None).cast("string").alias("column_name"), F.col(BROKEN).alias("raw"), F.lit("fields do not match the header").alias("reason")
    )
    broken = F.col(BROKEN).isNotNull()
    found = F.when(broken, F.array(line)).otherwise(F.filter(F.array(*entries), lambda e: e.isNotNull()) if entries else F.array())
    columns = [typed.get(c, F.col(f"`{c}`")).alias(c) for c in header]
    columns += [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in header]
    stored = materialize(
        lines.select(*columns, F.col("_metadata.file_path").alias("_file"), broken.alias("_broken"), found.cast(REJECTS).alias("_rejects")),
        "scanned",
    )
    rows = stored.where(~F.col("_broken")).drop("_file", "_broken", "_rejects")
    rejects = stored.select(F.col("_file").alias("file"), F.inline("_rejects"))
    return rows, rejects


# The types of the lattice from the narrowest to the widest, with the texts that each can hold.
LATTICE = {
    "bigint": r"[+-]?[0-9]{1,18}",
    "double": r"[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?|NaN",
    "timestamp": r"[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?",
}


def infer_types(df: DataFrame) -> DataFrame:
    """(column_name, inferred, n_values) for the text columns of a table, from all its rows in one aggregation.

    The type is the narrowest of bigint, double, timestamp and string that holds every
    value; bigint is below double, and timestamp stands beside both. Empty texts and
    NULL hold no value; a column without values is a string.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    totals = []
    for i, c in enumerate(names):
        text = F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
        totals.append(F.count(text).alias(f"n_{i}"))
        for kind, pattern in LATTICE.items():
            totals.append(F.count_if(text.rlike(f"^({pattern})$")).alias(f"{kind}_{i}"))
    entries = []
    for i, c in enumerate(names):
        n = F.col(f"n_{i}")
        kind = F.when(n == 0, "string")
        for name in LATTICE:
            kind = kind.when(F.col(f"{name}_{i}") == n, name)
        entries.append(F.struct(F.lit(c).alias("column_name"), kind.otherwise("string").alias("inferred"), n.alias("n_values")))
    return df.agg(*totals).select(F.inline(F.array(*entries)))


def fits(inferred: str, declared: str) -> Column:
    """Whether a column of the inferred type can be read as the declared one without losing values."""
    wider = {"bigint": ("bigint", "int", "double"), "double": ("double",), "timestamp": ("timestamp", "timestamp_ntz")}
    result = F.col(declared) == "string"
    for kind, allowed in wider.items():
        result = result | ((F.col(inferred) == kind) & F.col(declared).isin(*allowed))
    return result
