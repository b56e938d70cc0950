"""alertlake: alert mails and pages to one clean, de-duplicated offers table, on Spark.

Main entry points:

* ``alertlake.plans.pipeline.run_pipeline(spark, Workspace(root, sources), run_id, now)``
  — one batch run: gate, ingest/index, snapshot, extract, publish, mark.
* ``alertlake.streaming.ingest.start(spark, workspace, checkpoint)`` — the same
  steps per micro-batch of a file stream.
* ``alertlake.functions.text`` — the text functions as Column expressions.
* ``alertlake.operators`` — routing, extraction jobs, ordered IDs, duplicate
  links, geo resolution, publish, each a DataFrame -> DataFrame function.
"""

__version__ = "0.1.0"
