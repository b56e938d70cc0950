"""What a workspace knows of its own tables: a summary of each partition, and an index of dedup keys.

``parts``: one row per run's partition of ``offers`` (rows, first and last ID, which publish took it) and per
published batch (rows, first row).  IDs are reserved there and partitions are claimed there before anything is
written, each in one commit, so no two runs share an ID or publish a partition twice, and neither the
archive nor the published rows are read to find out where to go on.

``keys``: one row per dedup key (first and last ID, count), in hash buckets.  A run looks its own keys up, in
the buckets they fall in, and adds its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake.functions import text as T
from alertlake.sources import files
from alertlake.sources.keyed import KeyedTable

PARTS_SCHEMA = ("part string, kind string, run string, rows bigint, first_id bigint, last_id bigint, above bigint, "
                "published_by string, first_row bigint")
KEYS_SCHEMA = "Cle_dedup string, first_id string, first_ord bigint, last_id string, last_ord bigint, n bigint"


def merge_keys(rows: DataFrame, key: str) -> DataFrame:
    """Key rows add up: in whatever order they were committed, the result is the same."""
    return rows.groupBy(key).agg(
        F.min_by("first_id", F.struct("first_ord", "first_id")).alias("first_id"), F.min("first_ord").alias("first_ord"),
        F.max_by("last_id", F.struct("last_ord", "last_id")).alias("last_id"), F.max("last_ord").alias("last_ord"),
        F.sum("n").alias("n"))


def key_rows(offers: DataFrame) -> DataFrame:
    """The rows of the key index that some offers make; empty keys are left out."""
    named = offers.where(F.coalesce("Cle_dedup", F.lit("")) != "").select(
        "Cle_dedup", F.col("ID").alias("first_id"), T.parse_offer_id_lenient(F.col("ID")).cast("bigint").alias("first_ord"))
    return merge_keys(named.select("*", F.col("first_id").alias("last_id"), F.col("first_ord").alias("last_ord"),
                                   F.lit(1).cast("bigint").alias("n")), "Cle_dedup")


class Archive:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.parts = KeyedTable(spark, f"{self.root}/parts", PARTS_SCHEMA, "part")
        self.keys = KeyedTable(spark, f"{self.root}/keys", KEYS_SCHEMA, "Cle_dedup", merge_keys)

    def versions(self) -> dict:
        return {"parts": self.parts.state().version, "keys": self.keys.state().version}

    # ------------------------------------------------------------ IDs

    def reserve(self, run: str, n: int, after: int = 0) -> int:
        """Reserve ``n`` IDs for a run, above all reserved before; the first of them.  Again the same for the same n."""
        own = f"offers/{run}"

        def update(now: DataFrame) -> DataFrame:
            last = F.coalesce(F.max(F.when((F.col("kind") == "offers") & (F.col("part") != own), F.col("last_id"))), F.lit(0))
            return now.agg(last.alias("l")).select(
                F.lit(own).alias("part"), F.lit("offers").alias("kind"), F.lit(run).alias("run"),
                F.lit(n).cast("bigint").alias("rows"), (F.col("l") + 1).cast("bigint").alias("first_id"),
                (F.col("l") + n).cast("bigint").alias("last_id"), F.lit(0).cast("bigint").alias("above"),
                F.lit(None).cast("string").alias("published_by"), F.lit(None).cast("bigint").alias("first_row"))

        self.parts.commit(f"reserve {run} {n}", update, after=after)
        return self.parts.read().where(F.col("part") == own).first()["first_id"]

    # ------------------------------------------------------------ keys

    def known(self, keys: DataFrame, canonical: str) -> DataFrame:
        """(Cle_dedup, _arch_id): the last (or first) archived ID of each of these keys that is archived."""
        found = self.keys.read(keys).join(keys.distinct(), "Cle_dedup", "left_semi")
        return found.select("Cle_dedup", F.col("last_id" if canonical == "last" else "first_id").alias("_arch_id"))

    def add_keys(self, run: str, offers: DataFrame, after: int = 0) -> None:
        self.keys.commit(f"keys {run}", lambda _: key_rows(offers), after=after, blind=True)

    # ------------------------------------------------------------ publishing

    def claim(self, batch: str, hidden: list[str], run: str | None = None, after: int = 0) -> tuple[list, int]:
        """Take the partitions that no batch has taken (of one run, if given): their rows of ``parts``, and how many
        rows were published before.  ``hidden`` runs are not whole yet.  A batch that claimed before gets the same."""
        own = f"published/{batch}"

        def update(now: DataFrame) -> DataFrame:
            open_ = (F.col("kind") == "offers") & F.col("published_by").isNull() & (F.col("rows") > 0)
            if hidden:
                open_ = open_ & ~F.col("run").isin(*hidden)
            if run is not None:
                open_ = open_ & (F.col("run") == run)
            taken = now.where(open_).withColumn("published_by", F.lit(batch))
            row = now.agg(F.coalesce(F.sum(F.when(F.col("kind") == "published", F.col("rows"))), F.lit(0)).alias("before"),
                          F.coalesce(F.sum(F.when(open_, F.col("rows"))), F.lit(0)).alias("rows"))
            return taken.unionByName(row.select(
                F.lit(own).alias("part"), F.lit("published").alias("kind"), F.lit(batch).alias("run"), "rows",
                F.lit(None).cast("bigint").alias("first_id"), F.lit(None).cast("bigint").alias("last_id"),
                F.lit(None).cast("bigint").alias("above"), F.lit(None).cast("string").alias("published_by"),
                F.col("before").alias("first_row")))

        self.parts.commit(f"claim {batch} {self._attempt(batch)}", update, after=after)
        held = self.parts.read().where((F.col("published_by") == batch) | (F.col("part") == own)).collect()
        return [r for r in held if r["kind"] == "offers"], next(r["first_row"] for r in held if r["part"] == own)

    def release(self, batch: str) -> None:
        """Give the partitions of a batch back: publishing them failed."""
        self.parts.commit(f"release {batch} {self._attempt(batch)}", lambda now: now.where(
            (F.col("published_by") == batch) | (F.col("part") == f"published/{batch}"))
            .withColumn("published_by", F.lit(None).cast("string"))
            .withColumn("rows", F.when(F.col("kind") == "published", F.lit(0)).otherwise(F.col("rows")).cast("bigint"))
            .withColumn("above", F.when(F.col("kind") == "published", F.coalesce("above", F.lit(0)) + 1).otherwise(F.col("above"))))

    def _attempt(self, batch: str) -> int:
        """How often a batch was given back."""
        row = self.parts.read().where(F.col("part") == f"published/{batch}").first()
        return int(row["above"] or 0) if row else 0

    def unpublished(self, hidden: list[str]) -> int:
        rows = self.parts.read().where("kind = 'offers' and published_by is null")
        rows = rows.where(~F.col("run").isin(*hidden)) if hidden else rows
        return rows.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    # ------------------------------------------------------------ partitions written without these tables

    def adopt(self, offers: DataFrame, published: DataFrame, journaled: set[str]) -> None:
        """Summarise partitions of ``offers`` that no run of this journal wrote; rows up to the last published ID
        count as published."""
        names = [n.split("=", 1)[1] for n in files.names(self.spark, f"{self.root}/offers") if n.startswith("run_id=")]
        known = {r["run"] for r in self.parts.read().where("kind = 'offers'").select("run").collect()}
        new = sorted(set(names) - known - journaled)
        if not new:
            return
        rows = offers.where(F.col("run_id").isin(*new))
        # an ID that is none is not published yet either: publishing will say so
        number = F.coalesce(T.parse_offer_id_lenient(F.col("ID")).cast("bigint"), F.lit(0))
        last = published.agg(F.coalesce(F.max(T.parse_offer_id_lenient(F.col("ID"))), F.lit(0))).first()[0]
        before = published.count()
        parts = rows.groupBy(F.col("run_id").alias("run")).agg(
            F.count_if((number > last) | (number <= 0)).alias("rows"), F.min(number).alias("first_id"), F.max(number).alias("last_id"))
        none = F.lit(None)
        summed = parts.select(
            F.concat(F.lit("offers/"), "run").alias("part"), F.lit("offers").alias("kind"), "run", "rows", "first_id", "last_id",
            F.lit(last).cast("bigint").alias("above"), none.cast("string").alias("published_by"), none.cast("bigint").alias("first_row"))
        if before:
            summed = summed.unionByName(self.spark.createDataFrame(
                [("published/", "published", "", before, None, None, None, None, 0)], PARTS_SCHEMA))
        self.keys.commit(f"adopt {' '.join(new)}", lambda _: key_rows(rows), blind=True)
        self.parts.commit(f"adopt {' '.join(new)}", lambda _: summed)
