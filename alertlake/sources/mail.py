"""Raw mail scan and decode.

``.eml`` files are read once with the ``binaryFile`` source and decoded by a
``mapInPandas`` job using the standard ``email`` package (MIME decoding has
no SQL form); everything after works on the decoded ``emails`` table.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from email import policy
from email.message import EmailMessage
from email.parser import BytesParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake import fixed

EMAILS_SCHEMA = ("path string, message_id string, from_hdr string, subject string, date_raw string, "
                 "html string, text string, parse_error string")
_EMAIL_FIELDS = [f.split()[0] for f in EMAILS_SCHEMA.split(", ")]
_HEADERS = {"message_id": "Message-ID", "from_hdr": "From", "subject": "Subject", "date_raw": "Date"}
BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"

EXCLUDED_DIRS = ("_duplicates", "tests")


def scan_mail_files(spark: SparkSession, root: str) -> DataFrame:
    """Every ``*.eml`` below ``root`` except the quarantine and test folders."""
    df = (spark.read.format("binaryFile")
          .option("pathGlobFilter", "*.eml")
          .option("recursiveFileLookup", "true")
          .load(root))
    return exclude_dirs(df, root)


def exclude_dirs(df: DataFrame, root: str) -> DataFrame:
    cond = F.lit(True)
    for d in EXCLUDED_DIRS:
        cond = cond & ~F.col("path").contains(f"/{d}/")
    return df.where(cond)


#: Glob characters of a path, escaped so that a listed path is read as it stands.
_GLOB = re.compile(r"([\\\[\]{}*?])")


def read_mail_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The content of the given files; an empty table for none."""
    if not paths:
        return spark.createDataFrame([], BINARY_SCHEMA)
    return spark.read.format("binaryFile").load([_GLOB.sub(r"\\\1", p) for p in paths])


def _body(message: EmailMessage, kind: str) -> str:
    """The first leaf of that content type, as text: bytes that its charset does not know are replaced."""
    leaf = next((p for p in message.walk() if not p.is_multipart() and p.get_content_type() == kind), None)
    if leaf is None:
        return ""
    raw = leaf.get_payload(decode=True) or b""
    try:
        codecs.lookup(charset := leaf.get_content_charset("utf-8"))
    except LookupError:
        charset = "utf-8"
    return raw.decode(charset, "replace")


def _record(path: str, content: bytes) -> dict[str, str | None]:
    """One mail as a row of ``EMAILS_SCHEMA``; what cannot be parsed leaves only its error."""
    row: dict[str, str | None] = dict.fromkeys(_EMAIL_FIELDS)
    row["path"] = path
    try:
        message = BytesParser(policy=policy.default).parsebytes(content)
        headers = {field: str(message[name] or "") for field, name in _HEADERS.items()}
        bodies = {"html": _body(message, "text/html"), "text": _body(message, "text/plain")}
    except Exception as fault:  # any malformed mail: an error row downstream, not a failed job
        row["parse_error"] = f"{type(fault).__name__}: {fault}"
        return row
    headers["message_id"] = headers["message_id"].strip() or None
    return {**row, **headers, **bodies}


def _decode_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame([_record(p, bytes(c)) for p, c in zip(pdf["path"], pdf["content"])], columns=_EMAIL_FIELDS)


def decode_mails(files: DataFrame) -> DataFrame:
    """S2 + S3 (headers): one row per file in the ``EMAILS_SCHEMA`` shape;
    a file that cannot be parsed gets ``parse_error`` instead of failing the job.
    Batches follow ``spark.sql.execution.arrow.maxRecordsPerBatch`` (500 in
    ``alertlake.session``), which bounds the memory of one Python worker."""
    return files.select("path", "content").mapInPandas(_decode_batches, EMAILS_SCHEMA)


def parse_mail_date(raw: Column) -> Column:
    """S3: RFC 2822 ``Date`` header -> TIMESTAMP instant (NULL when unparsable).

    The weekday is dropped first (a weekday is not a legal parse field) and a
    trailing comment such as ``(CET)`` is ignored.  Zone names of the old mail
    format (``GMT``, ``EST``, ``Z``) and two-digit years are understood."""
    body = F.regexp_replace(F.coalesce(raw, F.lit("")), r"^\s*[A-Za-z]{3},\s*", "")
    body = F.trim(F.regexp_replace(body, r"\s*\([^)]*\)\s*$", ""))
    zone = F.regexp_extract(body, r"\s([A-Za-z]{1,4})$", 1)
    offset = F.element_at(F.create_map(*[F.lit(x) for z, o in fixed.ZONE_OFFSETS for x in (z, o)]), F.upper(zone))
    body = F.when(offset.isNotNull(), F.concat(F.regexp_replace(body, "[A-Za-z]+$", ""), offset)).otherwise(body)
    # a two-digit year: 00 to 68 are this century
    short = r"^(\d{1,2}\s+[A-Za-z]{3}\s+)(\d{2})(\s)"
    year = F.regexp_extract(body, short, 2)
    century = F.when(year.try_cast("int") <= 68, F.lit("20")).otherwise(F.lit("19"))
    body = F.when(year != "", F.concat(F.regexp_extract(body, short, 1), century, F.regexp_replace(
        body, r"^\d{1,2}\s+[A-Za-z]{3}\s+", ""))).otherwise(body)
    return F.coalesce(F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm:ss xx")),
                      F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm xx")))


def local_parts(ts: Column, tz: str = fixed.LOCAL_TZ) -> tuple[Column, Column]:
    """(local wall time, offset string ``+hhmm``) of an instant in zone ``tz``."""
    local = F.from_utc_timestamp(ts, tz)
    minutes = ((F.unix_timestamp(local) - F.unix_timestamp(ts)) / 60).cast("int")
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(minutes)
    off = F.concat(sign, F.lpad((a / 60).cast("int").cast("string"), 2, "0"),
                   F.lpad((a % 60).cast("string"), 2, "0"))
    return local, off


def local_iso(ts: Column, tz: str = fixed.LOCAL_TZ) -> Column:
    """Ledger ``date_email`` form: ``yyyy-MM-ddTHH:mm:ss+hhmm`` in the local zone."""
    local, off = local_parts(ts, tz)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), off)


def name_prefix(ts: Column, tz: str = fixed.LOCAL_TZ) -> Column:
    """``yyyyMMdd-HHmm`` of the local time."""
    local, _ = local_parts(ts, tz)
    return F.date_format(local, "yyyyMMdd-HHmm")


def build_filename(source_id: Column, subject_slug: Column) -> Column:
    """``<source id>-<subject slug>.eml`` (unique by source id)."""
    return F.concat(source_id, F.lit("-"), subject_slug, F.lit(".eml"))
