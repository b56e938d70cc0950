"""Incremental publish (P3-P9, A2, A9, J7, J8, W4-W6) and run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.functions import text as T
from alertlake.operators import dedup

def max_published(published: DataFrame, id_col: str = "ID") -> Column:
    """A2: greatest published offer number, 0 when nothing is published (strict parse)."""
    return F.coalesce(F.max(T.parse_offer_id_strict(F.col(id_col))), F.lit(0)).cast("bigint")


def publish_delta(rows: DataFrame, last_published: int | Column, id_col: str = "ID") -> DataFrame:
    """Rows whose ID number is strictly greater than the last published one
    (replaying the same delta publishes nothing new)."""
    last = last_published if isinstance(last_published, Column) else F.lit(last_published)
    return rows.withColumn("id_num", T.parse_offer_id_strict(F.col(id_col))).where(F.col("id_num") > last)


def publish_shape(rows: DataFrame, headers: list[str] | None = None,
                  keep: tuple[str, ...] = ("sheet_row",)) -> DataFrame:
    """Published row shape: header order, missing values as "", ``Traite``
    = (exclusion reason present), text-forced columns prefixed with a quote."""
    headers = fixed.OFFER_COLUMNS if headers is None else headers
    cols = []
    for h in headers:
        v = F.coalesce(F.col(h).cast("string"), F.lit("")) if h in rows.columns else F.lit("")
        if h == "Traite":
            v = F.when(F.coalesce(F.col("Raison_exclusion"), F.lit("")) != "", F.lit("TRUE")).otherwise(F.lit("FALSE"))
        elif h in fixed.FORCE_TEXT_COLUMNS:
            v = F.when(v != "", F.concat(F.lit("'"), v)).otherwise(v)
        cols.append(v.alias(h))
    return rows.select(*cols, *[c for c in keep if c in rows.columns])


def append_positions(delta: DataFrame, last_row: int, order_col: str, out_col: str = "sheet_row") -> DataFrame:
    """Sheet row of each new row: ``last_row + 1`` onwards in delta order."""
    return dedup.assign_ordered_ids(delta, [order_col], out_col=out_col, start=last_row + 1)


def islands(rows: DataFrame, pos_col: str, flag: Column) -> DataFrame:
    """Contiguous ``pos`` ranges per flag value (gaps and islands).

    ``pos - rank within flag`` is constant along a run; the rank comes from a
    skew-safe grouped numbering (a flag has two values, so a window per flag
    would put half of all rows in one task)."""
    f = rows.select(F.col(pos_col).alias("_pos"), flag.alias("flag"))
    ranked = dedup.rank_within_group(f, ["flag"], ["_pos"], out_col="_r")
    return (ranked.groupBy("flag", (F.col("_pos") - F.col("_r")).alias("_grp"))
            .agg(F.min("_pos").cast("bigint").alias("range_start"),
                 F.max("_pos").cast("bigint").alias("range_end"))
            .drop("_grp"))


def resolve_source_ids(message_ids: DataFrame, ledger: DataFrame) -> DataFrame:
    """Real source ids of the given messages (``message_id, pos``) in
    their order; unknown messages and sentinel ids are dropped."""
    j = message_ids.join(ledger.select("message_id", "gmail_id"), "message_id", "inner")
    return j.where(~F.col("gmail_id").isin(*fixed.SENTINEL_SOURCE_IDS) & F.col("gmail_id").isNotNull())


def check_cap(df: DataFrame, cap: int = fixed.MAX_MESSAGES_PER_RUN) -> None:
    """Refuse a batch above the safety cap."""
    n = df.count()
    if n > cap:
        raise RuntimeError(f"{n} messages to mark, above the safety cap ({cap})")


def processed_source_ids(ledger: DataFrame) -> DataFrame:
    """J8 (right side): real source ids of entries the pipeline processed
    (status not NULL / PENDING / ERREUR)."""
    ok = F.col("statut_extraction").isNotNull() & ~F.col("statut_extraction").isin("PENDING", "ERREUR")
    real = F.col("gmail_id").isNotNull() & ~F.col("gmail_id").isin(*fixed.SENTINEL_SOURCE_IDS)
    return ledger.where(ok & real).select("gmail_id").distinct()


def gate_state(audit: DataFrame) -> DataFrame:
    """One row: blocked when an unacknowledged failed publish exists."""
    unacked = (F.col("status") == "failed") & F.col("acked_at").isNull()
    return audit.agg(
        (F.count_if(unacked) > 0).alias("blocked"),
        F.count_if(unacked).cast("bigint").alias("n_unacked"),
        F.max(F.when(unacked, F.col("recorded_at"))).alias("last_failure_at"))


def run_stats(status: DataFrame, offers: DataFrame, dry_run: bool = False) -> DataFrame:
    """A4: one row of run counters from per-mail statuses and offer rows."""
    s = status.agg(
        F.count_if(F.col("statut_extraction") == "OK").cast("bigint").alias("fichiers_ok"),
        F.count_if(F.col("statut_extraction") == "PARTIEL").cast("bigint").alias("fichiers_partiel"),
        F.count_if(F.col("statut_extraction") == "ERREUR").cast("bigint").alias("erreurs"),
        F.count_if(F.col("statut_extraction") == "IGNORE").cast("bigint").alias("ignores"))
    o = offers.agg(
        F.count(F.lit(1)).cast("bigint").alias("offres_ecrites"),
        F.count_if(F.col("Doublon_ID") != "").cast("bigint").alias("doublons"),
        F.count_if(F.col("Raison_exclusion") != "").cast("bigint").alias("blacklistes"))
    # Two one-row aggregates: combined on the driver (scalars, not data).
    row = {**s.first().asDict(), **o.first().asDict(), "dry_run": dry_run}
    schema = ", ".join(f"{k} bigint" for k in list(row)[:-1]) + ", dry_run boolean"
    return status.sparkSession.createDataFrame([tuple(row.values())], schema)


def history_row(stats: DataFrame, run_ts: str) -> DataFrame:
    """The 7-column history row of one run."""
    return stats.select(F.lit(run_ts).alias("Date_run"),
                        F.col("fichiers_ok").alias("Fichiers_traites"),
                        F.col("offres_ecrites").alias("Offres_extraites"),
                        F.col("doublons").alias("Doublons"), F.col("ignores").alias("Ignores"),
                        F.col("erreurs").alias("Erreurs"), F.col("dry_run").alias("Dry_run"))
