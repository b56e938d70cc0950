"""Fetch stage over a message listing (R4-R7, S4, S16): which messages are new, and their payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.operators import route


def payload(raw: Column) -> Column:
    """The bytes of a URL-safe base64 payload."""
    return F.unbase64(F.translate(raw, "-_", "+/"))


def select_listing(listing: DataFrame, domains: list[str], after: str) -> DataFrame:
    """R4 + R5: messages of active sender domains since ``after`` (``yyyy/MM/dd``, pushed as a literal)."""
    since = F.to_timestamp(F.lit(after), "yyyy/MM/dd").cast(listing.schema["date_ts"].dataType)
    recent = route.with_sender_domain(listing.where(F.col("date_ts") >= since), "from_hdr")
    return recent.where(route.sender_predicate(F.col("sender_domain"), domains))


def skip_reasons(messages: DataFrame, ledger: DataFrame, domain_map: DataFrame) -> DataFrame:
    """``messages`` with ``skip_reason``: known by source id, without Message-ID, known by Message-ID, or of
    a sender without a folder; NULL if new.  Only ledger rows that share an id with the messages are kept
    for the joins."""
    ids = messages.select("gmail_id").distinct()
    names = messages.select("message_id").distinct()
    by_id = ledger.where("gmail_id is not null").select("gmail_id").join(ids, "gmail_id", "left_semi") \
        .distinct().withColumn("_known_id", F.lit(True))
    by_name = ledger.select("message_id").join(names, "message_id", "left_semi").distinct().withColumn("_known_name", F.lit(True))
    j = route.expected_folder(messages, domain_map).join(by_id, "gmail_id", "left").join(by_name, "message_id", "left")
    reason = (F.when(F.col("_known_id").isNotNull(), F.lit("known_source_id"))
              .when(F.col("message_id").isNull(), F.lit("no_message_id"))
              .when(F.col("_known_name").isNotNull(), F.lit("known_message_id"))
              .when(F.col("expected_folder").isNull(), F.lit("unknown_domain")))
    return j.withColumn("skip_reason", reason).drop("_known_id", "_known_name", "expected_folder")


def summary(judged: DataFrame) -> DataFrame:
    """Found / new / downloaded counts."""
    return judged.agg(F.count(F.lit(1)).cast("bigint").alias("n_found"),
                      F.count_if(~F.col("skip_reason").eqNullSafe("known_source_id")).cast("bigint").alias("n_new"),
                      F.count_if(F.col("skip_reason").isNull()).cast("bigint").alias("n_downloaded"))
