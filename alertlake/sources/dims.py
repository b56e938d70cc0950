"""Configuration dimensions (S13, R2, R3) as small DataFrames.

Config keeps its order: every dimension carries ``pos`` / ``cfg_pos`` so
"first entry wins" and "last entry wins" rules become ``min_by`` /
``max_by``.  Users pass their own lists/dicts (or a JSON file in the same
shape as the package defaults) to override them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.functions import text as T
from alertlake.sources.ledger import read_table

ProviderRow = tuple[str, str, list[str], bool]


def providers_from_json(spark: SparkSession, path: str) -> list[ProviderRow]:
    """Provider rules from a patterns JSON file on any store; ``_``-prefixed keys are metadata.
    A missing file gives no providers."""
    found = read_table(spark, str(path), "value string", "text", {"wholetext": "true"}).first()
    cfg = json.loads(found.value) if found else {}
    return [(k, v.get("folder") or "", list(v.get("sender_domains", [])), bool(v.get("skip", False)))
            for k, v in cfg.items() if not k.startswith("_")]


def provider_dim(spark: SparkSession, providers: list[ProviderRow] | None = None) -> DataFrame:
    """One row per (provider, sender domain): provider_key, cfg_pos, folder, domain, n_parts, skip."""
    providers = fixed.PROVIDERS if providers is None else providers
    rows = [(k, i, folder, d.lower(), len(d.split(".")), skip)
            for i, (k, folder, domains, skip) in enumerate(providers) for d in domains if d]
    return spark.createDataFrame(
        rows, "provider_key string, cfg_pos int, folder string, domain string, n_parts int, skip boolean")


def domain_folder_map(pdim: DataFrame) -> DataFrame:
    """R2: sender domain -> folder; for a domain declared twice the later entry wins."""
    return (pdim.where((F.col("folder") != "") & (F.col("domain") != ""))
            .groupBy("domain").agg(F.max_by("folder", "cfg_pos").alias("folder")))


def active_domains(pdim: DataFrame) -> DataFrame:
    """Distinct domains of providers that are not skipped (sort when listing)."""
    return pdim.where(~F.col("skip")).select("domain").distinct()


def city_dim(spark: SparkSession, cities: list[tuple[str, str]] | None = None,
             strict_compat: bool = True) -> DataFrame:
    """City -> département with the lookup key.

    ``strict_compat=True`` keys on the configured name lower-cased only (so an
    accented name with no plain twin never matches an accent-stripped lookup,
    as in the reproduced behaviour); ``False`` strips accents on both sides.
    The first configured entry of a key wins.
    """
    cities = fixed.CITY_DEPT if cities is None else cities
    rows = [(i, name, dept) for i, (name, dept) in enumerate(cities)]
    df = spark.createDataFrame(rows, "pos int, city string, dept string")
    key = F.lower(F.col("city")) if strict_compat else T.strip_accents(F.lower(F.col("city")))
    return df.withColumn("city_key", key)
