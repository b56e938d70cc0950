"""Offer archive / dated delta / run history in the CSV contract.

The CSV edge keeps the original contract: ``;`` separator, UTF-8, a header
line, every cell a string, embedded quotes doubled (so files written by a
standard CSV writer read back unchanged).  Inside the engine the same data
lives in Parquet (see ``alertlake.plans.pipeline``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.sources.ledger import read_table

CSV_OPTIONS = {"sep": fixed.CSV_SEPARATOR, "encoding": "UTF-8", "quote": '"', "escape": '"',
               "multiLine": "true"}


def string_schema(columns: list[str]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def read_offers_csv(spark: SparkSession, path: str, headers: list[str] | None = None) -> DataFrame:
    """archive/delta CSV with a header; every cell a string, empty or
    missing cells read as "" (as a dict reader yields them)."""
    headers = fixed.OFFER_COLUMNS if headers is None else headers
    reader = spark.read.options(**CSV_OPTIONS).option("header", "true").option("enforceSchema", "false")
    df = reader.schema(string_schema(headers)).csv(path)
    return df.select(*[F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(h) for h in headers])


def write_offers_csv(rows: DataFrame, path: str, headers: list[str] | None = None,
                     force_headers: bool | None = None, mode: str = "append") -> None:
    """Write rows in header order; keys outside the contract are
    dropped, missing columns written as "".  Each file starts with a header line unless
    ``force_headers`` is False."""
    headers = fixed.OFFER_COLUMNS if headers is None else headers
    cols = [F.coalesce(F.col(h).cast("string"), F.lit("")).alias(h) if h in rows.columns else F.lit("").alias(h)
            for h in headers]
    (rows.select(*cols).write.mode(mode).options(**CSV_OPTIONS)
     .option("header", "false" if force_headers is False else "true").csv(path))


def write_dated_delta(rows: DataFrame, root: str, day: str, run_id: str, force_headers: bool | None = None) -> str:
    """The run's delta as ``<root>/run_date=<yyyyMMdd>/run=<run id>/`` (replaced on replay,
    so a re-run never duplicates lines; runs of one day stand side by side)."""
    target = f"{root}/run_date={day}/run={run_id}"
    write_offers_csv(rows, target, force_headers=force_headers, mode="overwrite")
    return target


def read_dated_delta(spark: SparkSession, root: str, day: str) -> DataFrame:
    """One day's deltas, empty when the day has none."""
    headers = fixed.OFFER_COLUMNS
    options = {**CSV_OPTIONS, "header": "true", "enforceSchema": "false", "recursiveFileLookup": "true"}
    df = read_table(spark, f"{root}/run_date={day}", string_schema(headers), "csv", options)
    return df.select(*[F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(h) for h in headers])


def append_history_csv(history: DataFrame, path: str) -> None:
    """Append the 7-column run-history row(s)."""
    (history.select(*[F.col(c).cast("string").alias(c) for c in fixed.RUN_HISTORY_COLUMNS])
     .write.mode("append").options(**CSV_OPTIONS).option("header", "true").csv(path))


def add_column_if_missing(df: DataFrame, name: str = "Message_ID") -> DataFrame:
    """Append-only schema evolution: a missing column is added last with
    "" values; an existing one (and its values) is kept; idempotent."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(""))
