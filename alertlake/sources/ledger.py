"""Status ledger: one row per Message-ID.

The ledger is a keyed table (``sources/keyed.py``), not a JSON file: a run commits the rows that it
changes, so an upsert of a few mails rewrites nothing, and runs at the same time lose nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.sources.keyed import KeyedTable

LEDGER_COLUMNS = ["message_id", "gmail_id", "fichier", "date_email", "fetched_at", "indexed_at",
                  "statut_extraction"]
LEDGER_SCHEMA = ", ".join(f"{c} string" for c in LEDGER_COLUMNS)
_ENTRY = "struct<" + ", ".join(f"{c}: string" for c in LEDGER_COLUMNS[1:]) + ">"


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def read_ledger_json(spark: SparkSession, path: str) -> DataFrame:
    """A legacy JSON ledger object ``{message_id: {...}}``; missing -> empty."""
    raw = read_table(spark, str(path), "value string", "text", {"wholetext": "true"})
    m = raw.select(F.explode(F.from_json("value", f"map<string, {_ENTRY}>")).alias("message_id", "e"))
    return m.select("message_id", *[F.col(f"e.{c}").alias(c) for c in LEDGER_COLUMNS[1:]])


def legacy_index_to_ledger(index: DataFrame, order_col: str) -> DataFrame:
    """Legacy index rows (Message-ID, Fichier, Date_email, Date_indexation,
    Statut_extraction) -> ledger rows; the last row of a Message-ID wins,
    empty status means PENDING, the source id is the pre-API sentinel."""
    status = F.coalesce(F.nullif(F.col("Statut_extraction"), F.lit("")), F.lit("PENDING"))
    entry = F.struct(
        F.lit(fixed.SENTINEL_SOURCE_IDS[0]).alias("gmail_id"),
        F.coalesce(F.col("Fichier"), F.lit("")).alias("fichier"),
        F.coalesce(F.col("Date_email"), F.lit("")).alias("date_email"),
        F.coalesce(F.col("Date_indexation"), F.lit("")).alias("fetched_at"),
        F.coalesce(F.col("Date_indexation"), F.lit("")).alias("indexed_at"),
        status.alias("statut_extraction"))
    last = index.groupBy(F.col("Message-ID").alias("message_id")).agg(F.max_by(entry, F.col(order_col)).alias("e"))
    return last.select("message_id", "e.*")


def latest_per_message(rows: DataFrame, order_col: str) -> DataFrame:
    """Collapse many rows per message to the last one (partial aggregation)."""
    payload = [c for c in LEDGER_COLUMNS[1:] if c in rows.columns]
    last = rows.groupBy("message_id").agg(
        F.max_by(F.struct(*payload), F.col(order_col)).alias("e"))
    return last.select("message_id", "e.*")


def upsert_index(ledger: DataFrame, indexed: DataFrame, now: Column) -> DataFrame:
    """R14 + S6: merge index results (message_id, fichier, date_email) into the
    ledger.  Indexed entries keep their source id, fetch time and status
    (defaults: the indexed row's ``gmail_id``, else ``manual``; now; PENDING) and get the new file, date and
    ``indexed_at = now``; other ledger entries are unchanged."""
    o = ledger.select(*[F.col(c).alias(f"o_{c}") for c in LEDGER_COLUMNS])
    n = indexed.select(F.col("message_id").alias("n_message_id"), F.col("fichier").alias("n_fichier"),
                       F.col("date_email").alias("n_date_email"),
                       (F.col("gmail_id") if "gmail_id" in indexed.columns else F.lit(None).cast("string")).alias("n_gmail_id"))
    j = o.join(n, F.col("o_message_id") == F.col("n_message_id"), "full_outer")
    hit = F.col("n_message_id").isNotNull()

    def pick(new: Column, old: str) -> Column:
        return F.when(hit, new).otherwise(F.col(f"o_{old}"))

    return j.select(
        F.coalesce("n_message_id", "o_message_id").alias("message_id"),
        pick(F.coalesce("o_gmail_id", "n_gmail_id", F.lit("manual")), "gmail_id").alias("gmail_id"),
        pick(F.col("n_fichier"), "fichier").alias("fichier"),
        pick(F.col("n_date_email"), "date_email").alias("date_email"),
        pick(F.coalesce(F.col("o_fetched_at"), now), "fetched_at").alias("fetched_at"),
        pick(now, "indexed_at").alias("indexed_at"),
        pick(F.coalesce("o_statut_extraction", F.lit("PENDING")), "statut_extraction").alias("statut_extraction"),
    )


def set_status(ledger: DataFrame, statuses: DataFrame) -> DataFrame:
    """Apply per-message statuses (message_id, statut_extraction) to the ledger."""
    s = statuses.select("message_id", F.col("statut_extraction").alias("_new"))
    return (ledger.join(s, "message_id", "left")
            .withColumn("statut_extraction", F.coalesce("_new", "statut_extraction")).drop("_new"))


def low_watermark(ledger: DataFrame, margin_hours: int = fixed.OVERLAP_MARGIN_HOURS) -> DataFrame:
    """One row: ``n_real`` entries with a real source id, ``last_fetch``
    (greatest ``fetched_at`` among them) and ``after_date`` = that instant
    minus the margin, as ``yyyy/MM/dd`` (NULL when nothing was fetched)."""
    real = (~F.coalesce(F.col("gmail_id"), F.lit("")).isin(*fixed.SENTINEL_SOURCE_IDS)) & \
        (F.coalesce(F.col("fetched_at"), F.lit("")) != "")
    agg = ledger.agg(F.count_if(real).cast("bigint").alias("n_real"),
                     F.max(F.when(real, F.col("fetched_at"))).alias("last_fetch"))
    ts = F.to_timestamp("last_fetch", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    after = F.date_format(ts - F.expr(f"INTERVAL {int(margin_hours)} HOURS"), "yyyy/MM/dd")
    return agg.withColumn("after_date", after)


def after_date(ledger: DataFrame, since_days: int | None = None, now: str | None = None,
               margin_hours: int = fixed.OVERLAP_MARGIN_HOURS) -> str:
    """R5 decision: the low watermark of the ledger, else ``now - since_days``
    (``now`` as ``yyyy-MM-ddTHH:mm:ssZ``), else an error.  Returns ``yyyy/MM/dd``."""
    start = F.col("after_date")
    if since_days is not None:
        base = F.to_timestamp(F.lit(now), "yyyy-MM-dd'T'HH:mm:ss'Z'") if now else F.current_timestamp()
        start = F.coalesce(start, F.date_format(base - F.make_interval(days=F.lit(int(since_days))), "yyyy/MM/dd"))
    chosen = low_watermark(ledger, margin_hours).select(start.alias("after_date")).first().after_date
    if chosen is None:
        raise ValueError("the ledger records no fetch and since_days is not given: nothing to start from")
    return chosen


# ---------------------------------------------------------------- tables on any store


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
               options: dict[str, str] | None = None) -> DataFrame:
    """A table that may not exist yet (then empty with ``schema``).  Any other fault is an error:
    a ledger that cannot be read must not look empty."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).options(**(options or {})).format(fmt).load(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# ---------------------------------------------------------------- the ledger as a keyed table


def ledger_table(spark: SparkSession, root: str) -> KeyedTable:
    """The stored ledger: an upsert writes the rows it changes, the latest commit of a Message-ID holds."""
    return KeyedTable(spark, root, LEDGER_SCHEMA, "message_id")


def read_ledger(spark: SparkSession, root: str, ids: DataFrame | None = None) -> DataFrame:
    """Current ledger (or only the buckets of some Message-IDs); empty when never written."""
    return ledger_table(spark, root).read(ids)


def index_messages(ledger: KeyedTable, txn: str, indexed: DataFrame, now: Column, after: int = 0) -> int:
    """R14 as one commit: only the rows of the indexed messages are written."""
    ids = indexed.select("message_id").distinct()
    return ledger.commit(txn, lambda rows: upsert_index(rows.join(ids, "message_id", "left_semi"), indexed, now), ids, after)


def record_statuses(ledger: KeyedTable, txn: str, statuses: DataFrame, after: int = 0) -> int:
    """S6 as one commit: only rows that get a status are written."""
    ids = statuses.select("message_id").distinct()
    return ledger.commit(txn, lambda rows: set_status(rows.join(ids, "message_id", "left_semi"), statuses), ids, after)
