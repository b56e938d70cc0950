"""End-to-end batch run (P10): gate -> ingest/index -> snapshot -> extract -> publish -> mark.

All state lives in Parquet tables under one workspace folder (shared
storage on a cluster):

``emails/``        decoded mails, appended once per new file (never re-read as .eml)
``ledger/``        ledger (a keyed table: ``sources/keyed.py``), one commit per run and stage
``parts/``, ``keys/``   summary of every offer partition and published batch; index of dedup keys (``sources/archive.py``)
``snapshots/``     PENDING ids taken before extraction, per run
``offers/``        offer archive, partition ``run_id``
``rejects/``, ``run_events/``, ``run_history/``   per run
``published/``     published rows, partition ``batch_id``
``publish_audit/`` one row per publish attempt (the gate reads it)
``routed/``        mails of a run with their provider, partitioned by run and provider
``quarantine/``    duplicate files of a run (R13), under a name free in the quarantine
``index_errors/``  files of a run that cannot be indexed: no Message-ID, or no readable date
``indexed/``, ``statuses/``, ``new_paths/``   what a run adds to the ledger, and the files it reads
``to_mark/``       source ids to mark as processed, per run
``journal/``       one record per run and stage (``plans/journal.py``)

A run goes through the stages index, snapshot, extract, publish and mark.  A stage writes partitions of its
own run, is recorded in the journal, and then takes effect on the shared tables, the ledger last.  A run that
died goes on under its id where its journal ends, so no mail is lost and none is extracted twice.
Files are not renamed or moved (file-manager work): the ledger keeps the
path as found, and duplicates are reported in ``run_events``.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.functions import text as T
from alertlake.operators import dedup, enrich, fetch, geo, publish, route
from alertlake.operators import extract as X
from alertlake.operators.joins import sized_broadcast
from alertlake.plans.journal import Journal
from alertlake.session import materialize, release_kept
from alertlake.sources import dims, files, ledger as LG, mail as M, offers_io
from alertlake.sources.archive import Archive

OFFERS_SCHEMA = ", ".join(f"`{c}` string" for c in fixed.OFFER_COLUMNS) + ", run_id string"
AUDIT_SCHEMA = "batch_id string, status string, message string, recorded_at string, acked_at string"


class PublishBlocked(RuntimeError):
    """An unacknowledged failed publish exists."""


@dataclass
class Config:
    providers: list = field(default_factory=lambda: list(fixed.PROVIDERS))
    extractable: list = field(default_factory=lambda: list(fixed.EXTRACTABLE_PROVIDERS))
    keywords: dict = field(default_factory=lambda: dict(fixed.STACK_KEYWORDS))
    blacklist: list = field(default_factory=lambda: list(fixed.TITLE_BLACKLIST))
    cities: list = field(default_factory=lambda: list(fixed.CITY_DEPT))
    canonical: str = "last"          # archive key -> ID: last archived row (reproduced) or first
    statuses: tuple = ("PENDING",)   # statuses (re)processed by extraction
    csv_deltas: str | None = None    # folder for dated CSV deltas (S9), None = Parquet only
    csv_headers: bool | None = None  # header line of those files: always, never, None = automatic
    geocode: DataFrame | None = None  # (city, postcode) reference of J5
    mark_cap: int | None = None      # A9: most messages that a run may mark, checked before publishing (None = off)
    sender_domains: list = field(default_factory=list)  # R4: active sender domains of a fetch (none: those of the providers)


class Workspace:
    def __init__(self, root: str, sources: str):
        self.root = root
        self.sources = sources
        self.preview: tuple[DataFrame, DataFrame] | None = None  # mails and ledger of a dry run
        self.preview_offers: DataFrame | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        """A workspace table (empty with ``schema`` when not written yet), with partitions of unfinished stages."""
        return LG.read_table(spark, self.path(name), schema)

    def read_whole(self, spark: SparkSession, name: str, schema: str, stage: str) -> DataFrame:
        """A workspace table without the partitions of runs whose ``stage`` is not recorded."""
        hidden = self.journal(spark).unfinished(stage)
        table = self.read(spark, name, schema)
        return table.where(~F.col("run_id").isin(*hidden)) if hidden else table

    def journal(self, spark: SparkSession) -> Journal:
        return Journal(spark, self.path("journal"))

    def archive(self, spark: SparkSession) -> Archive:
        return Archive(spark, self.root)

    def ledger(self, spark: SparkSession):
        return LG.ledger_table(spark, self.path("ledger"))


QUARANTINE_SCHEMA = "path string, message_id string, known_path string, quarantine_path string, run_id string"
EMAIL_COLS = ("path string, message_id string, from_hdr string, subject string, date_raw string, html string, "
              "text string, parse_error string, date_email string, sender_domain string, run_id string")


def _replace_run(df: DataFrame, path: str, run: str, col: str = "run_id") -> None:
    """Write a run's rows as its partition, in place of whatever it held: a replay without rows leaves it empty."""
    df.write.mode("overwrite").parquet(f"{path}/{col}={run}")


def check_gate(spark: SparkSession, ws: Workspace) -> None:
    state = publish.gate_state(_audit_state(spark, ws)).first()
    if state["blocked"]:
        raise PublishBlocked(f"publish blocked: unacknowledged failure recorded at {state['last_failure_at']}")


def ack_failures(spark: SparkSession, ws: Workspace, now: str) -> None:
    """Acknowledge every recorded failure (the gate opens again).

    Acknowledged rows are appended, nothing is rewritten: a crash leaves the gate closed."""
    open_rows = _audit_state(spark, ws).where((F.col("status") == "failed") & F.col("acked_at").isNull())
    open_rows.withColumn("acked_at", F.lit(now)).transform(materialize) \
        .write.mode("append").parquet(ws.path("publish_audit"))


def _audit_state(spark: SparkSession, ws: Workspace) -> DataFrame:
    """One row per publish attempt; an attempt is acknowledged once any of its rows is."""
    audit = ws.read(spark, "publish_audit", AUDIT_SCHEMA)
    return audit.groupBy("batch_id", "status", "message", "recorded_at").agg(F.max("acked_at").alias("acked_at")) \
        .select("batch_id", "status", "message", "recorded_at", "acked_at")


def relative_path(path: Column, root: str) -> Column:
    """Path of a scanned file relative to the sources root (as stored in the ledger)."""
    prefix = "file:" if not root.startswith(("file:", "hdfs:", "s3", "gs:", "abfs")) else ""
    base = prefix + (os.path.abspath(root) if prefix else root).rstrip("/") + "/"
    return F.regexp_replace(path, "^" + rx_escape(base), "")


def new_files(spark: SparkSession, ws: Workspace, run_id: str, dry_run: bool) -> DataFrame:
    """(path, content) of the files that no run has seen; their list stays a table.

    Files are listed without their content and compared with the ledger, the quarantine and the index errors.  Then
    the folder is scanned again for the times between which the new ones were last modified (two instants, pushed
    to the file source, which opens no other file), and joined with the list."""
    seen = LG.read_ledger(spark, ws.path("ledger")).select(F.col("fichier").alias("path"))
    for name in ("quarantine", "index_errors"):
        # a replayed run finds its own files again
        seen = seen.unionByName(ws.read(spark, name, "path string, run_id string").where(F.col("run_id") != run_id)
                                .select("path"))
    rel = relative_path(F.col("path"), ws.sources).alias("path")
    listed = M.scan_mail_files(spark, ws.sources).select(rel, "modificationTime")
    new = listed.join(seen.distinct(), "path", "left_anti")
    if dry_run:
        new = new.transform(materialize)
    else:
        _replace_run(new, ws.path("new_paths"), run_id)
        new = spark.read.schema("path string, modificationTime timestamp").parquet(f"{ws.path('new_paths')}/run_id={run_id}")
    first, last = new.agg(F.min("modificationTime"), F.max("modificationTime")).first()
    if first is None:
        return spark.createDataFrame([], "path string, content binary")
    files_ = M.scan_mail_files(spark, ws.sources).where(F.col("modificationTime").between(F.lit(first), F.lit(last)))
    paths, _ = sized_broadcast(new.select("path"))
    return files_.select(rel, "content").join(paths, "path", "left_semi")


def ingest_and_index(spark: SparkSession, ws: Workspace, run_id: str, now: str, dry_run: bool) -> dict:
    """Decode the files that no run has seen, then index them."""
    return index_decoded(spark, ws, M.decode_mails(new_files(spark, ws, run_id, dry_run)), run_id, now, dry_run)


LISTING_SCHEMA = "gmail_id string, from_hdr string, date_ts timestamp, raw string"


def fetch_and_index(spark: SparkSession, ws: Workspace, cfg: Config, listing: DataFrame, run_id: str, now: str,
                    dry_run: bool, since_days: int | None = None) -> dict:
    """Index the messages of a listing (``LISTING_SCHEMA``; ``raw`` is URL-safe base64).

    Messages of active senders since the ledger's low watermark, not known by their source id, are decoded and
    indexed with that id and ``fetched_at = now``; so the run can later mark them at their source."""
    ledger = LG.read_ledger(spark, ws.path("ledger"))
    after = LG.after_date(ledger, since_days, now)
    domains = cfg.sender_domains or sorted({d.lower() for _, _, ds, skip in cfg.providers if not skip for d in ds})
    chosen = fetch.select_listing(listing, domains, after)
    ids = ledger.where("gmail_id is not null").select("gmail_id").distinct()
    # Known by its source id: neither its payload nor its headers are looked at.
    n_known = chosen.select("gmail_id").join(ids, "gmail_id", "left_semi").count()
    decoded = M.decode_mails(chosen.join(ids, "gmail_id", "left_anti").select(
        F.concat(F.lit("fetched/"), "gmail_id", F.lit(".eml")).alias("path"),
        fetch.payload(F.col("raw")).alias("content"))).transform(materialize)
    named = decoded.select(F.regexp_extract("path", r"^fetched/(.*)\.eml$", 1).alias("gmail_id"), "path", "message_id",
                           "from_hdr")
    judged = fetch.skip_reasons(route.with_sender_domain(named, "from_hdr"), ledger,
                                dims.domain_folder_map(dims.provider_dim(spark, cfg.providers))).transform(materialize)
    new = judged.where("skip_reason is null").select("path", "gmail_id")
    counts = index_decoded(spark, ws, decoded.join(new, "path"), run_id, now, dry_run)
    found = fetch.summary(judged).first().asDict()
    return {**counts, **found, "n_found": found["n_found"] + n_known}


def index_decoded(spark: SparkSession, ws: Workspace, decoded: DataFrame, run_id: str, now: str,
                  dry_run: bool) -> dict:
    """W3 + R10 + R14: land decoded mails and what they add to the ledger (see ``apply_index``).

    A Message-ID known under another file, or a later path (sort order) of a
    Message-ID new in this batch, is a duplicate and is not indexed."""
    if "gmail_id" not in decoded.columns:
        decoded = decoded.withColumn("gmail_id", F.lit(None).cast("string"))
    ts = M.parse_mail_date(F.col("date_raw"))
    decoded = decoded.withColumn("date_email", M.local_iso(ts)) \
        .withColumn("sender_domain", T.sender_domain(F.col("from_hdr"))) \
        .withColumn("run_id", F.lit(run_id)).transform(materialize)
    reason = F.when(F.col("parse_error").isNotNull(), F.col("parse_error")) \
        .when(F.col("message_id").isNull(), F.lit("no Message-ID")) \
        .when(F.col("date_email").isNull(), F.concat(F.lit("no readable date: "), F.coalesce("date_raw", F.lit(""))))
    errors = decoded.withColumn("reason", reason).where("reason is not null")
    ok = decoded.where(reason.isNull())
    # only the ledger buckets of this batch's Message-IDs are read
    ledger = LG.read_ledger(spark, ws.path("ledger"), ok.select("message_id"))
    # Only ledger entries of this batch's Message-IDs are looked up: the batch
    # ids (small, size-checked) are broadcast into a semi join with the ledger.
    batch_ids, _ = sized_broadcast(ok.select("message_id").distinct(), materialize=True)
    known = ledger.join(batch_ids, "message_id", "left_semi") \
        .select("message_id", F.col("fichier").alias("known_path"))
    j = ok.join(known, "message_id", "left").withColumn("_k", F.split("path", "/"))
    j = dedup.first_per_key(j, ["message_id"], "_k", out_col="_first")
    dup = F.when(F.col("known_path").isNotNull(), F.col("known_path") != F.col("path")).otherwise(~F.col("_first"))
    j = j.withColumn("action", F.when(dup, F.lit("duplicate")).otherwise(
        route.file_action(F.lit(None).cast("string"), F.col("path"), F.regexp_extract("path", "([^/]+)$", 1))))
    kept = j.where(F.col("action") != "duplicate")
    indexed = kept.select("message_id", F.col("path").alias("fichier"), "date_email", "gmail_id")
    counts = {r["action"]: r["n"] for r in j.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts["errors"] = errors.count()
    landed = ok.select(*[c.split()[0] for c in EMAIL_COLS.split(", ")])
    if dry_run:
        ws.preview = (landed, LG.upsert_index(ledger, indexed, F.lit(now)).transform(materialize))
    else:
        _replace_run(landed, ws.path("emails"), run_id)
        _replace_run(errors.select("path", "message_id", "reason"), ws.path("index_errors"), run_id)
        # Duplicates go to quarantine, under a name that no earlier file there has
        base = F.regexp_replace(F.regexp_extract("path", "([^/]+)$", 1), r"\.eml$", "")
        dups = j.where(F.col("action") == "duplicate").select(
            "path", "message_id", "known_path", F.lit("_duplicates").alias("folder"), base.alias("base"))
        there = ws.read(spark, "quarantine", QUARANTINE_SCHEMA).where(F.col("run_id") != run_id).select(
            F.lit("_duplicates").alias("folder"), F.regexp_extract("quarantine_path", "([^/]+)$", 1).alias("name"))
        named = route.canonical_names(dups, there)
        _replace_run(named.select("path", "message_id", "known_path",
                                  F.concat_ws("/", "folder", "new_name").alias("quarantine_path")), ws.path("quarantine"), run_id)
        _replace_run(indexed, ws.path("indexed"), run_id)
    return counts


INDEXED_SCHEMA = "message_id string, fichier string, date_email string, gmail_id string"


def apply_index(spark: SparkSession, ws: Workspace, run_id: str, now: str, after: int = 0) -> None:
    """The run's indexed mails enter the ledger, in one commit."""
    indexed = spark.read.schema(INDEXED_SCHEMA).parquet(f"{ws.path('indexed')}/run_id={run_id}")
    LG.index_messages(ws.ledger(spark), f"index {run_id}", indexed, F.lit(now), after)


def rx_escape(s: str) -> str:
    from alertlake.functions import rx
    return rx.escape(s)


SNAPSHOT_SCHEMA = "message_id string, fichier string, date_email string"


def _pending(spark: SparkSession, ws: Workspace, cfg: Config, dry_run: bool = False) -> DataFrame:
    ledger = LG.read_ledger(spark, ws.path("ledger"))
    if dry_run and ws.preview:
        fresh = ws.preview[1]
        ledger = ledger.join(fresh.select("message_id"), "message_id", "left_anti").unionByName(fresh)
    return ledger.where(route.is_pending(F.col("statut_extraction"), cfg.statuses)).select("message_id", "fichier", "date_email")


def snapshot_run(spark: SparkSession, ws: Workspace, cfg: Config, run_id: str) -> dict:
    """The mails that the run will extract, whatever the ledger says later."""
    _replace_run(_pending(spark, ws, cfg), ws.path("snapshots"), run_id)
    return {}


def extract_run(spark: SparkSession, ws: Workspace, cfg: Config, run_id: str, dry_run: bool,
                now: str | None = None, after: int = 0) -> dict:
    """Dispatch, extraction jobs, offer rows, statuses and sinks for the run's snapshot (see ``apply_extract``).

    A dry run takes the pending mails, also those that a dry index run would have landed, and writes nothing.
    ``now`` dates the CSV delta (today without it)."""
    if dry_run:
        pending = _pending(spark, ws, cfg, True).transform(materialize)
    else:
        pending = spark.read.schema(SNAPSHOT_SCHEMA).parquet(f"{ws.path('snapshots')}/run_id={run_id}")
    wanted = ["message_id", "path", "from_hdr", "subject", "html", "sender_domain"]
    emails = ws.read_whole(spark, "emails", EMAIL_COLS, "index")
    # Mails lie in the partition of the run that landed them: three narrow columns tell which
    # runs the pending ones come from, and only those partitions' html is read.
    keys = ["message_id", "fichier", "run_id"]
    landed = emails.select("message_id", F.col("path").alias("fichier"), "run_id")
    landed = landed.join(pending, ["message_id", "fichier"]).groupBy("message_id", "fichier").agg(
        F.min("run_id").alias("run_id"), F.first("date_email").alias("date_email")).transform(materialize)
    runs = [r.run_id for r in landed.select("run_id").distinct().collect()]
    emails = emails.where(F.col("run_id").isin(*runs)).select(*wanted, "run_id")
    # The pending mails are few next to the landed ones: they are broadcast (size-checked)
    # into an inner join, so the stored html is read once and never shuffled;
    # pending mails without a landed file are added back (html NULL).
    pend_b, _ = sized_broadcast(landed, materialize=True)
    found = emails.withColumnRenamed("path", "fichier").join(pend_b, keys, "inner").drop("run_id")
    if dry_run and ws.preview:
        fresh = ws.preview[0].select(*wanted).withColumnRenamed("path", "fichier")
        found = found.unionByName(fresh.join(pending, ["message_id", "fichier"]))
    missing = pending.join(found.select("message_id", "fichier"), ["message_id", "fichier"], "left_anti")
    mails = found.unionByName(missing, allowMissingColumns=True)
    routed = route.detect_provider(mails, dims.provider_dim(spark, cfg.providers))
    routed = route.dispatch(routed, cfg.extractable, F.col("html").isNotNull())
    if dry_run:
        routed = routed.transform(materialize)
    else:
        # Stored partitioned by provider: each extraction job's provider filter
        # becomes partition pruning, so the seven jobs read each mail once in total.
        rp = ws.path("routed")
        own = f"{rp}/run_id={run_id}"
        routed.write.mode("overwrite").partitionBy("provider_key").parquet(own)
        routed = spark.read.schema(routed.schema).parquet(own)
    to_extract = routed.where(F.col("dispatch_status").isNull())
    raw = X.extract_offers(to_extract.select("message_id", "provider_key", "subject", "html"),
                           [p for p in cfg.extractable if p in X.EXTRACTORS])
    raw = raw.join(pending.select("message_id", "date_email"), "message_id").transform(materialize)
    archive = ws.archive(spark)
    n = raw.where(enrich.valid_offer(F.col("titre"))).count()
    start = _next_id(archive) if dry_run else archive.reserve(run_id, n, after)
    resolved = geo.resolve_cities(raw.select("ville"), dims.city_dim(spark, cfg.cities), cfg.geocode)
    raw_geo = geo.attach_dept(raw, resolved)
    rows = enrich.offer_rows(raw_geo, start_id=start, archive_map=lambda keys: archive.known(keys, cfg.canonical),
                             keywords=cfg.keywords, blacklist=cfg.blacklist).drop("_seq").withColumn("run_id", F.lit(run_id))
    rows = rows.transform(materialize)
    extracted_status = enrich.mail_status(raw, to_extract.select("message_id"))
    status = routed.where(F.col("dispatch_status").isNotNull()).select("message_id", F.col("dispatch_status")
                                                                        .alias("statut_extraction")) \
        .unionByName(extracted_status.select("message_id", "statut_extraction"))
    stats = publish.run_stats(status, rows, dry_run)
    events = _run_events(routed, extracted_status, rows)
    out = stats.first().asDict()
    if dry_run:
        ws.preview_offers = rows
        return out
    _replace_run(rows.drop("run_id"), ws.path("offers"), run_id)
    if cfg.csv_deltas:
        day = (now or datetime.now(timezone.utc).isoformat())[:10].replace("-", "")
        offers_io.write_dated_delta(rows.drop("run_id"), cfg.csv_deltas, day, run_id, cfg.csv_headers)
    _replace_run(enrich.rejects(raw), ws.path("rejects"), run_id)
    _replace_run(publish.history_row(stats, run_id), ws.path("run_history"), run_id)
    _replace_run(events, ws.path("run_events"), run_id)
    _replace_run(status, ws.path("statuses"), run_id)
    return out


def _next_id(archive: Archive) -> int:
    return archive.parts.read().where("kind = 'offers'").agg(F.coalesce(F.max("last_id"), F.lit(0))).first()[0] + 1


def apply_extract(spark: SparkSession, ws: Workspace, run_id: str, versions: dict) -> None:
    """The run's keys enter the key index, its statuses the ledger: one commit each, the ledger last."""
    rows = spark.read.schema(OFFERS_SCHEMA.replace(", run_id string", "")).parquet(f"{ws.path('offers')}/run_id={run_id}")
    ws.archive(spark).add_keys(run_id, rows, versions["keys"])
    status = spark.read.schema("message_id string, statut_extraction string").parquet(f"{ws.path('statuses')}/run_id={run_id}")
    LG.record_statuses(ws.ledger(spark), f"extract {run_id}", status, versions["ledger"])


def _run_events(routed: DataFrame, status: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per logged event (level, message_id, msg)."""
    lvl = {"ERREUR": "ERR", "IGNORE": "IGN"}
    disp = routed.where(F.col("dispatch_status").isNotNull()).select(
        F.when(F.col("dispatch_status") == "ERREUR", F.lit(lvl["ERREUR"])).otherwise(F.lit(lvl["IGNORE"])).alias("level"),
        "message_id", F.concat(F.col("dispatch_reason"), F.lit(" "), F.coalesce("provider_key", F.lit(""))).alias("msg"))
    ok = F.col("statut_extraction") == "OK"
    st = status.select(F.when(ok, F.lit("INFO")).otherwise(F.lit("WARN")).alias("level"), "message_id",
                       F.concat(F.col("n_ok").cast("string"), F.lit(" offre(s), "),
                                F.col("n_rejected").cast("string"), F.lit(" ignorée(s)")).alias("msg"))
    dups = rows.where(F.col("Doublon_ID") != "").select(
        F.lit("INFO").alias("level"), F.col("Message_ID").alias("message_id"),
        F.concat(F.lit("Doublon : "), F.col("Cle_dedup"), F.lit(" → "), F.col("Doublon_ID")).alias("msg"))
    return disp.unionByName(st).unionByName(dups)


def publish_run(spark: SparkSession, ws: Workspace, batch_id: str, now: str, dry_run: bool,
                run_id: str | None = None, after: int = 0) -> int:
    """Publish the offers that no batch has published; failures are recorded.

    Only the partitions that the batch claims are read.  Of one that was written outside the journal, rows
    above the last ID published at that time are taken (P3)."""
    check_gate(spark, ws)
    archive, journal = ws.archive(spark), ws.journal(spark)
    hidden = journal.unfinished("extract")
    runs = {n.split("=", 1)[1] for n in files.names(spark, ws.path("snapshots")) if "=" in n}
    archive.adopt(ws.read(spark, "offers", OFFERS_SCHEMA), ws.read(spark, "published", OFFERS_SCHEMA.replace("run_id", "batch_id")),
                  runs)
    if dry_run:
        return archive.unpublished(hidden) + (ws.preview_offers.count() if ws.preview_offers is not None else 0)
    try:
        parts, before = archive.claim(batch_id, hidden, run_id, after)
        if not parts:
            return 0
        own = spark.createDataFrame([(p["run"], p["above"]) for p in parts], "run_id string, above bigint")
        offers = ws.read(spark, "offers", OFFERS_SCHEMA).where(F.col("run_id").isin(*[p["run"] for p in parts]))
        delta = publish.publish_delta(offers.join(F.broadcast(own), "run_id"), F.col("above"))
        # W6 + P5: rows go after the header and the rows already published
        placed = publish.append_positions(delta, before + 1, "id_num")
        shaped = publish.publish_shape(placed).transform(materialize)
        n = shaped.count()
        _replace_run(shaped, ws.path("published"), batch_id, "batch_id")
        if _audit_state(spark, ws).where((F.col("batch_id") == batch_id) & (F.col("status") == "ok")).isEmpty():
            _audit(spark, ws, batch_id, "ok", "", now)
        return n
    except Exception as e:  # record, then re-raise: the next run refuses until acknowledged
        archive.release(batch_id)
        _audit(spark, ws, batch_id, "failed", str(e), now)
        raise


def _audit(spark, ws, batch_id, status, message, now):
    spark.createDataFrame([(batch_id, status, message, now, None)], AUDIT_SCHEMA) \
        .write.mode("append").parquet(ws.path("publish_audit"))


def ids_to_mark(spark: SparkSession, ws: Workspace, cfg: Config, run_id: str) -> DataFrame:
    """J7 + A9: source ids of the run's snapshot; an error above ``cfg.mark_cap``."""
    snap = spark.read.schema(SNAPSHOT_SCHEMA).parquet(f"{ws.path('snapshots')}/run_id={run_id}").select("message_id")
    ids = publish.resolve_source_ids(snap, LG.read_ledger(spark, ws.path("ledger"), snap)).transform(materialize)
    if cfg.mark_cap is not None:
        publish.check_cap(ids, cfg.mark_cap)
    return ids


def mark_run(spark: SparkSession, ws: Workspace, cfg: Config, run_id: str) -> int:
    ids = ids_to_mark(spark, ws, cfg, run_id)
    _replace_run(ids, ws.path("to_mark"), run_id)
    return ids.count()


def run_stages(spark: SparkSession, ws: Workspace, cfg: Config, run_id: str, now: str,
               index: Callable[[str], dict]) -> dict:
    """All stages of a run, through its journal.  ``index`` lands the run's mails, given the time of its first start."""
    journal, archive, ledger = ws.journal(spark), ws.archive(spark), ws.ledger(spark)
    start = journal.begin(run_id, {"now": now, "ledger": ledger.state().version, **archive.versions()})
    now = start["now"]
    report = {"index": journal.stage(run_id, "index", lambda: index(now),
                                     lambda: apply_index(spark, ws, run_id, now, start["ledger"]))}
    journal.stage(run_id, "snapshot", lambda: snapshot_run(spark, ws, cfg, run_id))
    report["extract"] = journal.stage(run_id, "extract",
                                      lambda: extract_run(spark, ws, cfg, run_id, False, now, start["parts"]),
                                      lambda: apply_extract(spark, ws, run_id, start))
    if cfg.mark_cap is not None:
        ids_to_mark(spark, ws, cfg, run_id)  # A9: before anything is published
    report["published"] = journal.stage(run_id, "publish", lambda: {"n": publish_run(
        spark, ws, run_id, now, False, after=start["parts"])})["n"]
    report["marked"] = journal.stage(run_id, "mark", lambda: {"n": mark_run(spark, ws, cfg, run_id)})["n"]
    journal.close(run_id, report)
    return report


def run_pipeline(spark: SparkSession, ws: Workspace, run_id: str, now: str, cfg: Config | None = None,
                 dry_run: bool = False, listing: DataFrame | None = None, since_days: int | None = None) -> dict:
    """Fail-fast run: fetch (with a ``listing``) or scan, index, extract, publish, mark.

    A run that died is finished by running it again under its id; a finished one returns its report.
    A dry run simulates every stage and writes nothing."""
    cfg = cfg or Config()
    check_gate(spark, ws)
    ws.preview = ws.preview_offers = None

    def index(at: str) -> dict:
        if listing is not None:
            return fetch_and_index(spark, ws, cfg, listing, run_id, at, dry_run, since_days)
        return ingest_and_index(spark, ws, run_id, at, dry_run)

    try:
        if not dry_run:
            return run_stages(spark, ws, cfg, run_id, now, index)
        return {"index": index(now), "extract": extract_run(spark, ws, cfg, run_id, True, now),
                "published": publish_run(spark, ws, run_id, now, True), "marked": 0}
    finally:
        release_kept()  # what a run kept is of no use to another one, nor to its own replay
