"""Load the domain tables from catalog tables or file paths, validated against their schemas.

``locations`` maps each domain table to either a catalog name (``db.table``
or ``catalog.db.table``: tables of another database are just another name)
or a path (``/data/visits``, ``s3a://...``), optionally prefixed with a
format (``csv:/data/party``). Paths in self-describing formats are read as
stored; others use the declared schema. Every table is checked against its
declared columns and types before any job runs (metadata only, no job).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.jobs import Tables
from . import schemas

FORMATS = {"parquet", "orc", "csv", "json"}
SELF_DESCRIBING = {"parquet", "orc"}


def read_location(spark: SparkSession, location: str, schema=None) -> DataFrame:
    fmt, sep, rest = location.partition(":")
    if sep and fmt in FORMATS and not rest.startswith("//"):
        reader = spark.read.format(fmt)
        if fmt not in SELF_DESCRIBING and schema is not None:
            reader = reader.schema(schemas.plain(schema))
        if fmt == "csv":
            reader = reader.option("header", "true")
        return reader.load(rest)
    if "/" in location:  # a path or URI: parquet
        return spark.read.parquet(location)
    return spark.table(location)  # a catalog name, possibly of another database


def load_tables(spark: SparkSession, locations: dict[str, str], opening_hours_wide: str) -> Tables:
    """Domain tables for ``plans.jobs``, keys folded; ``opening_hours_wide`` has one column per centre."""
    frames = {}
    for name, schema in schemas.DOMAIN.items():
        df = read_location(spark, locations[name], schema)
        frames[name] = schemas.fold_keys(schemas.check(df, schema).select(*schema.fieldNames()))
    hours = read_location(spark, opening_hours_wide)
    schemas.check(hours, schemas.OPENING_HOURS_KEYS)
    return Tables(opening_hours_wide=schemas.fold_centres(hours), **frames)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "episodio", salt_by: Sequence[str] = (), salts: int = 16) -> DataFrame:
    """Save ``df``, keys folded, as a catalog table bucketed (and sorted) by ``key``; return it.

    Use it for the large tables whose group keys all contain one column:
    ``visit_raw`` by ``episodio`` (the classification's DISTINCT runs bucket
    by bucket, no shuffle of the visits) and ``queue_log`` by
    ``rut_paciente`` (ticket copies are combined and tickets ranked without
    a shuffle).

    A placeholder patient would fill one bucket. With ``salt_by`` buckets have
    two levels: the key and a salt computed from these columns, ``salts``
    values at most a key. Any grouping by the key and these columns finds its rows in one
    bucket still, so ``queue_log`` takes ``salt_by=["fecha"]``: a patient's days are spread,
    a ticket's rows of a day are not, and there is nothing to merge afterwards.
    """
    rows = schemas.fold_keys(df)
    levels = [key]
    if salt_by:
        rows = rows.withColumn(schemas.SALT, F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
        levels = [key, schemas.SALT]
    # a task per bucket, so that each bucket is one file
    rows.repartition(buckets, *levels).write.mode("overwrite").bucketBy(buckets, *levels).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)
