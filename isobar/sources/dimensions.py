"""CSV dimensions with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The spellings found for the same column.
ALIASES = {
    "latitude": "lat", "lattitude": "lat",
    "longitude": "lng", "longtitude": "lng",
    "time": "datetime",
    "name": "city",
}


def harmonise(df: DataFrame, schema: StructType | None = None, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Rename known spellings, leaving a name alone where its target already exists.

    With the ``schema`` of the target table only its own columns are targets, and none of them is renamed.
    """
    present, wanted = set(df.columns), set(schema.fieldNames()) if schema else None
    fits = lambda old, new: new != "city" if wanted is None else new in wanted and old not in wanted
    return df.withColumnsRenamed(
        {old: new for old, new in aliases.items() if old in present and new not in present and fits(old, new)}
    )


def read_dimension(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a CSV whose header must list the schema's columns in order.

    A reordered header fails the read; by default Spark would bind by position
    and swap the values silently.
    """
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST")


def read_with_rejects(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV that fit the schema, and those that don't: file, line (its text) and reason.

    Each line is in one of the two. A line is turned away if it has too few or too many fields,
    a value of another type, or none where the column must have one. The header is skipped.
    """
    corrupt = "_line"
    while corrupt in schema.fieldNames():
        corrupt += "_"
    loose = StructType([StructField(f.name, f.dataType) for f in schema.fields] + [StructField(corrupt, StringType())])
    rows = spark.read.csv(path, schema=loose, header=True, enforceSchema=True, mode="PERMISSIVE",
                          columnNameOfCorruptRecord=corrupt).select("*", F.col("_metadata.file_path").alias("_file"))
    required = [f.name for f in schema.fields if not f.nullable]
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    separators = F.regexp_count(F.col(corrupt), F.lit(',(?=(?:[^"]*"[^"]*")*[^"]*$)'))  # outside quotes
    reason = (
        F.when(separators > len(schema) - 1, "too many fields")
        .when(separators < len(schema) - 1, "too few fields")
        .when(F.col(corrupt).isNotNull(), "value of another type")
        .when(missing != "", F.concat(F.lit("no value of "), missing))
    )
    values = F.concat_ws(",", *[F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in schema.fields])
    rows = rows.where(values >= "")  # always so; only columns that are used are parsed and checked, and this uses them all
    good = rows.where(reason.isNull()).select(*schema.fieldNames())
    away = rows.select(F.col("_file").alias("file"), F.coalesce(F.col(corrupt), values).alias("line"), reason.alias("reason"))
    return good, away.where(F.col("reason").isNotNull())


def bulk_load(spark: SparkSession, path: str, columns: Sequence[str], schema: StructType) -> DataFrame:
    """Read a CSV by position: the caller's column list replaces the skipped header.

    Only ``schema``'s columns are kept, cast to its types; those the list lacks are null
    where they may be.
    """
    text = StructType([StructField(c, StringType()) for c in columns])
    rows = harmonise(spark.read.csv(path, schema=text, header=True, enforceSchema=True, mode="FAILFAST"), schema)
    value = lambda f: F.lit(None) if f.nullable and f.name not in rows.columns else F.col(f.name)
    return rows.select(*[value(f).cast(f.dataType).alias(f.name) for f in schema.fields])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Refuse an empty dimension."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df
