"""Driver tables seen through the data model of the pipeline.

The driver tables are not alert mails; each view maps one of them onto the
entity an operator works on, the same way in Spark (DataFrame) and in SQL
(a CTE for the oracle).  Every view reads whole tables.

* ``doc_offers``: each document is an offer: ``titre`` = the whole text,
  ``entreprise`` = source, ``ville`` = lang, ``ord`` = doc_id; a document with
  a ``labels`` row counts as already archived.
* ``page_links``: anchors of ``pages.html`` (generic link extraction, X13).
* ``ev_files``: each event is a landed mail file: message id = user (and
  day, for digest-like types), path built from type and id, fetch time =
  ts, status from the event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake.functions import text as T
from alertlake.session import spread


def table(spark: SparkSession, sf_dir: str, name: str, text_work: bool = False) -> DataFrame:
    """A driver table.  ``text_work=True`` for queries doing heavy per-row text
    work: a scan with fewer splits than cores is then spread over all cores
    (a no-op for large inputs); light queries read the table as split."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if text_work else df


# ---------------------------------------------------------------- doc_offers

def doc_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", text_work=True)
    return d.select(
        F.col("doc_id").alias("ord"),
        F.col("text").alias("titre"),
        F.col("source").alias("entreprise"),
        F.col("lang").alias("ville"),
        T.format_offer_id(F.col("doc_id") + 1).alias("ID"),
    )


def archived_doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ord"))


SQL_DOC_OFFERS = """doc_offers AS (
  SELECT doc_id AS ord, text AS titre, source AS entreprise, lang AS ville,
         printf('E%06d', doc_id + 1) AS "ID",
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id) AS archived
  FROM documents)"""

# ---------------------------------------------------------------- page_links

LINK_RE = r'<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>'


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages", text_work=True)
    arr = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(LINK_RE), 1).alias("href"),
        F.regexp_extract_all("html", F.lit(LINK_RE), 2).alias("anchor_text"))
    return (p.select("page_id", "url", F.posexplode(arr).alias("pos0", "l"))
            .select("page_id", "url", (F.col("pos0") + 1).cast("bigint").alias("pos"),
                    F.col("l.href").alias("href"), F.col("l.anchor_text").alias("anchor_text")))


SQL_PAGE_LINKS = """page_links AS (
  SELECT page_id, url, i::BIGINT AS pos, hs[i] AS href, ts[i] AS anchor_text
  FROM (SELECT page_id, url,
               regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS hs,
               regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2) AS ts
        FROM pages) x, range(1, len(hs) + 1) r(i))"""

# ---------------------------------------------------------------- ev_files

# Events of these types are daily digests: one Message-ID per user and day
# (repeated deliveries of a day are copies); other types reuse one id per user.
DAILY_MESSAGE_TYPES = ("view", "click", "signup")
STATUS_OF_EVENT = {"view": None, "signup": "PENDING", "click": "OK",
                   "purchase": "PARTIEL", "error": "ERREUR"}


def ev_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    status = F.lit(None).cast("string")
    for k, v in STATUS_OF_EVENT.items():
        if v is not None:
            status = F.when(F.col("event_type") == k, F.lit(v)).otherwise(status)
    prefixed = F.col("value") < 25
    name = F.when(prefixed, F.concat(F.date_format("ts", "yyyyMMdd-HHmm"), F.lit("-m"),
                                     F.col("event_id").cast("string"), F.lit(".eml"))) \
        .otherwise(F.concat(F.lit("m"), F.col("event_id").cast("string"), F.lit(".eml")))
    gmail = (F.when(F.col("value") < 2, F.lit("before_gmail_api"))
             .when(F.col("value") < 4, F.lit("manual"))
             .otherwise(F.concat(F.lit("g"), F.col("event_id").cast("string"))))
    return e.select(
        F.col("event_id"),
        F.col("ts"),
        F.when(F.col("event_type").isin(*DAILY_MESSAGE_TYPES),
               F.concat(F.lit("<"), F.col("user_id").cast("string"), F.lit("."),
                        F.date_format("ts", "yyyyMMdd"), F.lit("@mail>")))
        .otherwise(F.concat(F.lit("<"), F.col("user_id").cast("string"), F.lit("@mail>"))).alias("message_id"),
        F.col("event_type").alias("folder"),
        name.alias("file_name"),
        F.concat(F.col("event_type"), F.lit("/"), name).alias("fichier"),
        gmail.alias("gmail_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+0000'").alias("date_email"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at"),
        status.alias("statut_extraction"),
        F.col("value"),
    )


def _sql_status() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS_OF_EVENT.items() if v is not None)
    return f"CASE event_type {whens} ELSE NULL END"


SQL_EV_FILES = f"""ev_files AS (
  SELECT event_id, ts,
         CASE WHEN event_type IN ('view', 'click', 'signup') THEN '<' || user_id::VARCHAR || '.' || strftime(ts, '%Y%m%d') || '@mail>'
              ELSE '<' || user_id::VARCHAR || '@mail>' END AS message_id, event_type AS folder,
         fname AS file_name, event_type || '/' || fname AS fichier,
         CASE WHEN value < 2 THEN 'before_gmail_api' WHEN value < 4 THEN 'manual'
              ELSE 'g' || event_id::VARCHAR END AS gmail_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0000' AS date_email,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS fetched_at,
         {_sql_status()} AS statut_extraction, value
  FROM (SELECT *, CASE WHEN value < 25 THEN strftime(ts, '%Y%m%d-%H%M') || '-m' || event_id::VARCHAR || '.eml'
                       ELSE 'm' || event_id::VARCHAR || '.eml' END AS fname FROM events) e)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------- mails from pages / events

HOST_RE = r"^[a-z]+://([^/:?#]+)"


def page_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page is a received mail: sender = an address at the page's host."""
    p = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", HOST_RE, 1)
    return p.select("page_id", "url", "html",
                    F.concat(F.lit("Alerts <x@"), host, F.lit(">")).alias("from_hdr"))


SQL_PAGE_MAILS = f"""page_mails AS (
  SELECT page_id, url, html, 'Alerts <x@' || regexp_extract(url, '{HOST_RE}', 1) || '>' AS from_hdr FROM pages)"""


def mail_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message listing: each event is a message from the host of page ``user_id``."""
    e = table(spark, sf_dir, "events")
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", HOST_RE, 1).alias("host"))
    return e.join(p, e.user_id == p.page_id).select(
        "event_id",
        F.concat(F.lit("g"), F.col("event_id").cast("string")).alias("gmail_id"),
        F.concat(F.lit("<"), F.col("user_id").cast("string"), F.lit("@mail>")).alias("message_id"),
        F.concat(F.lit("x@"), F.col("host")).alias("from_hdr"),
        F.col("ts").alias("date_ts"),
        "event_type")


SQL_MAIL_LIST = f"""mail_list AS (
  SELECT e.event_id, 'g' || e.event_id::VARCHAR AS gmail_id, '<' || e.user_id::VARCHAR || '@mail>' AS message_id,
         'x@' || regexp_extract(p.url, '{HOST_RE}', 1) AS from_hdr, e.ts AS date_ts, e.event_type
  FROM events e JOIN pages p ON p.page_id = e.user_id)"""
