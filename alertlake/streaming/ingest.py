"""Continuous mail ingest with Structured Streaming (ST1-ST4).

* ST1: ``readStream.format("binaryFile")`` over the sources folder; every new
  ``.eml`` is decoded once (``mapInPandas``) and processed once.
* ST2: the fetch overlap margin: the same Message-ID arriving again within
  the margin (event time = ingest time of the micro-batch) is dropped by
  ``dropDuplicatesWithinWatermark``; older repeats are caught by the ledger.
* ST3: ``foreachBatch`` runs the batch steps on the micro-batch: index into
  the ledger, extraction with ordered IDs and duplicate links against the
  archive, publish — the ledger is written last.
* ST4: a micro-batch is a run of the workspace's journal.  Its run id holds the query's id, which Spark
  keeps over restarts, and the batch's, so a batch that died is finished where its journal ends, and one that
  is done is read to its end (Spark requires that its state is written) and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alertlake import fixed
from alertlake.plans import pipeline as P
from alertlake.session import release_kept
from alertlake.sources import mail as M

def mail_stream(spark: SparkSession, sources: str, margin_hours: int = fixed.OVERLAP_MARGIN_HOURS) -> DataFrame:
    files = (spark.readStream.format("binaryFile").schema(M.BINARY_SCHEMA)
             .option("pathGlobFilter", "*.eml").option("recursiveFileLookup", "true").load(sources))
    files = M.exclude_dirs(files, sources)
    rel = P.relative_path(F.col("path"), sources)
    decoded = M.decode_mails(files.select(rel.alias("path"), "content"))
    # A mail without Message-ID repeats nothing but its own file.
    return (decoded.withColumn("ingest_ts", F.current_timestamp())
            .withColumn("_same", F.coalesce(F.concat(F.lit("id "), "message_id"), F.concat(F.lit("file "), "path")))
            .withWatermark("ingest_ts", f"{int(margin_hours)} hours")
            .dropDuplicatesWithinWatermark(["_same"]).drop("_same"))


def process_batch(spark: SparkSession, ws: P.Workspace, cfg: P.Config, query_id: str,
                  batch: DataFrame, batch_id: int, now: str) -> None:
    """ST3 + ST4 body of ``foreachBatch``."""
    run_id = f"s-{query_id}-{batch_id:08d}"
    journal = ws.journal(spark)
    if journal.record(run_id, "index") is not None:
        batch.write.format("noop").mode("overwrite").save()
    if journal.record(run_id, "done") is not None:
        return
    try:
        P.run_stages(spark, ws, cfg, run_id, now, lambda at: P.index_decoded(spark, ws, batch.drop("ingest_ts"), run_id, at, False))
    finally:
        release_kept()


def start(spark: SparkSession, ws: P.Workspace, checkpoint: str, cfg: P.Config | None = None,
          now: str | None = None, available_now: bool = True, query_id: str | None = None) -> StreamingQuery:
    """Start the ingest stream (``availableNow`` processes what is there, then stops).

    ``query_id`` names the stream in run ids and commits; by default it is Spark's own id of the
    query, which its checkpoint keeps."""
    cfg = cfg or P.Config()

    def body(batch: DataFrame, batch_id: int) -> None:
        stamp = now or batch.sparkSession.range(1).select(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")).first()[0]
        own = query_id or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        process_batch(batch.sparkSession, ws, cfg, own, batch, batch_id, stamp)

    w = mail_stream(spark, ws.sources).writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
