"""Offer rows from raw offers (P1, P2, A5, T12): IDs, key, links, tags, flags.

Input ``raw``: ``message_id, offer_pos, provider_key, date_email`` plus the
ten raw-offer string fields.  Rows with an empty title are rejected (and
take no ID); every other row gets the next ID in (date_email, message_id,
offer_pos) order, is keyed, linked to its duplicate, tagged and flagged.
Duplicates and blacklisted offers are kept, only marked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.functions import text as T
from alertlake.operators import dedup

ORDER = ["date_email", "message_id", "offer_pos"]


def _s(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def valid_offer(titre: Column) -> Column:
    return F.coalesce(titre, F.lit("")) != ""


def rejects(raw: DataFrame) -> DataFrame:
    """Offers dropped for an empty title, with the reason."""
    return (raw.where(~valid_offer(F.col("titre")))
            .select("message_id", "offer_pos", F.lit("titre_vide").alias("reason")))


def offer_rows(raw: DataFrame, start_id: int | Column = 1, archive_map: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
               keywords: dict[str, list[str]] | None = None, blacklist: list[str] | None = None,
               dept: Column | None = None, archive: DataFrame | None = None,
               canonical: str = "last") -> DataFrame:
    """The 21 offer columns (plus ``_seq``, the numeric ID).

    ``archive`` (rows with ``Cle_dedup``, ``ID``, ``ord``) or ``archive_map``
    gives the keys of earlier runs (see ``dedup.link_duplicates``)."""
    valid = raw.where(valid_offer(F.col("titre")))
    # The key is computed before the ID checkpoint, so it is materialised once
    # and not recomputed by each branch of the duplicate-link join.
    valid = valid.withColumn("Cle_dedup", T.dedup_key(_s("entreprise"), _s("ville"), _s("titre")))
    ided = dedup.assign_ordered_ids(valid, ORDER, out_col="_seq", start=start_id)
    ided = ided.withColumn("ID", T.format_offer_id(F.col("_seq")))
    linked = dedup.link_duplicates(ided, order_col="_seq", archive_map=archive_map, archive=archive,
                                   canonical=canonical)
    bl = T.blacklist_term(F.col("titre"), blacklist)
    stack = T.stack_tags(F.concat(_s("titre"), F.lit(" "), _s("notes")), keywords)
    dept_col = dept if dept is not None else _s("dept")
    return linked.select(
        F.col("ID"),
        F.lit("FALSE").alias("Traite"),
        F.substring(_s("date_email"), 1, 10).alias("Date_decouverte"),
        T.source_display(F.col("provider_key")).alias("Source"),
        F.col("titre").alias("Titre"),
        _s("entreprise").alias("Entreprise"),
        F.col("Cle_dedup"),
        F.col("Doublon_ID"),
        _s("ville").alias("Ville"),
        dept_col.alias("Dept"),
        _s("type_contrat").alias("Type_contrat"),
        _s("salaire_min").alias("Salaire_min"),
        _s("salaire_max").alias("Salaire_max"),
        _s("url").alias("URL"),
        F.coalesce(F.col("url_qualite"), F.lit("vide")).alias("URL_qualite"),
        F.lit("").alias("URL_redirect"),
        stack.alias("Stack"),
        F.coalesce(F.concat(F.lit(fixed.BLACKLIST_REASON_PREFIX), bl), F.lit("")).alias("Raison_exclusion"),
        F.lit("").alias("Date_candidature"),
        T.compose_notes(_s("notes"), bl).alias("Notes"),
        F.col("message_id").alias("Message_ID"),
        F.col("_seq"),
    )


def mail_status(raw: DataFrame, mails: DataFrame | None = None) -> DataFrame:
    """A5: per mail, OK when every extracted offer is valid, PARTIEL when some
    are rejected or none were extracted.  ``mails`` (message_id) lists mails
    that may have produced no offer at all."""
    per = raw.groupBy("message_id").agg(
        F.count_if(valid_offer(F.col("titre"))).cast("bigint").alias("n_ok"),
        F.count_if(~valid_offer(F.col("titre"))).cast("bigint").alias("n_rejected"))
    if mails is not None:
        per = mails.select("message_id").distinct().join(per, "message_id", "left") \
            .fillna(0, ["n_ok", "n_rejected"])
    status = F.when((F.col("n_rejected") == 0) & (F.col("n_ok") > 0), F.lit("OK")).otherwise(F.lit("PARTIEL"))
    return per.withColumn("statut_extraction", status)
