"""Table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from touchline.operators.quality import schema_issues
from touchline.sources.landing import PACKED_ROWS, SOURCE_FILE
from touchline.sources.tables import VERSION


# JSON keeps microseconds only when told so
EXACT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def conform(df: DataFrame, expected: StructType, table: str = "table") -> DataFrame:
    """B1: the frame in declared column order, or an error when names or types differ.

    Nulls in columns declared non-null stop the write that meets them, inside the same
    pass; no job runs here.
    """
    issues = schema_issues(df, expected, table)
    if issues:
        raise ValueError("; ".join(issues))
    return df.select(
        *[F.col(f.name) if f.nullable else _required(f.name, table) for f in expected]
    )


def _required(name: str, table: str) -> Column:
    stop = F.raise_error(F.lit(f"{table}: null in column {name}"))
    return F.when(F.col(name).isNull(), stop).otherwise(F.col(name)).alias(name)


def spread_for_write(df: DataFrame, *by: str) -> DataFrame:
    """Bring equal partition values together before a partitioned write.

    The rebalance hint lets adaptive execution split the exchange where one value holds
    too many rows and merge where values are small, so neither one giant task nor a file
    per task and value results.
    """
    return df.hint("rebalance", *by)


def write_table(
    df: DataFrame,
    path: str,
    expected: StructType | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """B1, B2: parquet table, checked against its declared layout when one is given."""
    if expected is not None:
        df = conform(df, expected, path)
    if partition_by:
        spread_for_write(df, *partition_by).write.partitionBy(*partition_by).mode(mode).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_catalog_table(
    df: DataFrame,
    name: str,
    comment: str = "",
    properties: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Managed table with comment and properties such as ``quality``."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    spark = df.sparkSession
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_sql_text(comment)}")
    if properties:
        listed = ", ".join(f"{_sql_text(k)} = {_sql_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def _sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def write_json_groups(df: DataFrame, path: str, by: str, mode: str = "overwrite") -> None:
    """JSON folder per value of ``by``; large groups become several files."""
    writer = spread_for_write(df, by).write.partitionBy(by).mode(mode)
    writer.json(path, timestampFormat=EXACT_TIME)


def write_packed(df: DataFrame, path: str, by: str, pack: int = 50_000) -> None:
    """B3 for very many small files: an indented JSON array per value of ``by``, packed.

    Each file written is one indented array, whose elements hold a small file's name and rows;
    ``landing.read_packed`` opens them.  Files hold about ``pack`` rows, so their number grows
    with the rows and not with the names; nothing is listed or renamed on the driver.
    """
    packs = max(1, -(-df.count() // pack))
    dealt = df.withColumn("__pack", F.pmod(F.xxhash64(by), F.lit(packs))).repartition("__pack")
    rows = F.struct(*[c for c in df.columns if c != by])
    files = dealt.groupBy("__pack", by).agg(F.collect_list(rows).alias(PACKED_ROWS))
    named = F.struct(F.col(by).alias(SOURCE_FILE), PACKED_ROWS)
    texts = files.groupBy("__pack").agg(
        F.to_json(F.collect_list(named), {"pretty": "true", "timestampFormat": EXACT_TIME}).alias("value")
    )
    texts.select("value").write.option("maxRecordsPerFile", 1).text(path)


def write_version(
    df: DataFrame,
    path: str,
    version: int,
    source: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Whole-table replacement as a new version folder; older versions stay readable.

    Writing the same version again replaces only that version, so a retry is harmless, and
    a plan that reads an older version never loses its input.
    """
    rows = spread_for_write(df, *partition_by) if partition_by else df
    writer = rows.write.format(source).mode("overwrite").option("timestampFormat", EXACT_TIME)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path.rstrip('/')}/{VERSION}={version}")


def replace_partitions(df: DataFrame, path: str, *by: str, spread: bool = True) -> None:
    """Overwrite only the partitions that ``df`` holds (idempotent batch write, B5).

    Without ``spread`` rows are written from where they are, which spares an exchange where
    ``df`` holds one partition only.
    """
    (
        (spread_for_write(df, *by) if spread else df)
        .write.partitionBy(*by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
