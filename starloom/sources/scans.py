"""Scans with declared schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from ..functions import parse_flag
from .schemas import FLOAT_WRITTEN_IDS, schema_of


def _struct(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    sep: str = "\t",
    float_ids: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """Headerless delimited files; columns bind by position, a malformed cell becomes NULL.

    BOOLEAN columns accept 0/1 as well as true/false.  ``float_ids`` are integer
    columns that may be written with a decimal point; they pass through DOUBLE,
    which holds every 32-bit integer exactly.
    """
    target = _struct(schema)
    raw, fixes = [], {}
    for field in target:
        name, kind = field.name, field.dataType
        if isinstance(kind, BooleanType):
            raw.append(StructField(name, StringType()))
            fixes[name] = parse_flag(F.col(f"`{name}`"))
        elif name in float_ids:
            raw.append(StructField(name, DoubleType()))
            fixes[name] = F.col(f"`{name}`").try_cast(kind)
        else:
            raw.append(field)
    df = spark.read.schema(StructType(raw)).options(sep=sep, **options).csv(path)
    return df.withColumns(fixes) if fixes else df


def scan_source(
    spark: SparkSession, folder: str, table: str, suffix: str = ".csv", optional: bool = False, **options: str
) -> DataFrame:
    """One of the declared source tables, from ``<folder>/<table><suffix>``; an ``optional`` one may be absent."""
    path, schema = f"{folder.rstrip('/')}/{table}{suffix}", schema_of(table)
    try:
        return scan_delimited(spark, path, schema, float_ids=FLOAT_WRITTEN_IDS.get(table, ()), **options)
    except AnalysisException as error:
        if not optional or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _struct(schema))


def scan_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A staging set; with ``schema`` no footer has to be read to plan the scan."""
    reader = spark.read if schema is None else spark.read.schema(_struct(schema))
    return reader.parquet(path)


def scan_checked(
    spark: SparkSession, path: str | list[str], schema: StructType | str, sep: str = "\t", float_ids: Sequence[str] = (), **options: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of delimited files that fit the schema, and those that do not: record, reason, path.

    A record is a line.  It is ``short`` or ``long`` if it has too few or too many cells, ``mistyped`` if a cell that is
    not empty does not fit its column.  Every record is in one of the two frames; a line of white space alone is none.
    Both come from one scan, so store the rejects, or both, if the files are large.
    """
    target = _struct(schema)
    flags = [f.name for f in target if isinstance(f.dataType, BooleanType)]
    raw = StructType([StructField(f.name, StringType()) if f.name in flags or f.name in float_ids else f for f in target])
    corrupt = "_corrupt_record"
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.add(corrupt, StringType()))
    lines = spark.read.text(path).select(F.col("value").alias("_record"), F.col("_metadata.file_path").alias("_path")).filter("trim(translate(_record, '\t', ' ')) <> ''")
    told = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, **options}
    df = lines.select("*", F.from_csv("_record", kind, told).alias("_cells")).select("_record", "_path", "_cells.*")
    fixed = {c: parse_flag(F.col(f"`{c}`")) for c in flags}
    fixed |= {c: F.col(f"`{c}`").try_cast("double").try_cast(target[c].dataType) for c in float_ids if c in target.names}
    odd = F.col(corrupt).isNotNull()
    for c, value in fixed.items():
        odd = odd | (F.col(f"`{c}`").isNotNull() & value.isNull())
    marked = df.withColumn("_odd", odd)
    good = marked.filter("not _odd").withColumns(fixed).select(*[F.col(f"`{c}`") for c in target.names])
    cells = F.size(F.split("_record", f"\\Q{sep}\\E", -1))
    reason = F.when(cells < len(target), "short").when(cells > len(target), "long").otherwise("mistyped")
    return good, marked.filter("_odd").select(F.col("_record").alias("record"), reason.alias("reason"), F.col("_path").alias("path"))
