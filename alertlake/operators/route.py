"""Routing by sender domain and dispatch classification.

Routing works on *distinct* domains: a mail table has few distinct sender
domains, so suffixes are exploded and matched once per domain against the
(broadcast) provider dimension, and the small per-domain answer is joined
back to the mails — broadcast when its size allows, else with the statistics of
hot domains broadcast (one provider can send a third of all mail).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.functions import text as T
from alertlake.operators.joins import sized_broadcast
from alertlake.operators.skew import join_back


def domain_suffixes(domain: Column) -> Column:
    """``a.b.c`` -> [(a.b.c, 3), (b.c, 2), (c, 1)]: the domain, then its parents."""
    parts = F.split(F.coalesce(domain, F.lit("")), r"\.")
    n = F.size(parts)
    return F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(F.array_join(F.slice(parts, i, n - i + 1), ".").alias("suffix"),
                           (n - i + 1).alias("n_parts")))


def _per_domain(mails: DataFrame, domain_col: str) -> DataFrame:
    return mails.groupBy(domain_col).agg(F.count(F.lit(1)).alias("_grp_n"))


def _attach(mails: DataFrame, per_domain: DataFrame, domain_col: str) -> DataFrame:
    small, ok = sized_broadcast(per_domain, materialize=True)
    if ok:
        return mails.join(small, domain_col, "left").drop("_grp_n")
    return join_back(mails, small, [domain_col], "_grp_n").drop("_grp_n")


def detect_provider(mails: DataFrame, pdim: DataFrame, domain_col: str = "sender_domain") -> DataFrame:
    """Most specific provider whose sender domain is a component-wise
    suffix of the mail's domain; ties keep the earlier config entry.
    Adds provider_key, folder, skip, cfg_pos, match_parts (NULL when unknown)."""
    doms = _per_domain(mails, domain_col)
    cand = doms.select(domain_col, "_grp_n", F.explode(domain_suffixes(F.col(domain_col))).alias("s"))
    dim, _ = sized_broadcast(pdim.withColumnRenamed("domain", "_dim_domain"))
    m = cand.join(dim, F.col("s.suffix") == F.col("_dim_domain"), "left")
    best = m.groupBy(domain_col, "_grp_n").agg(F.min_by(
        F.struct("provider_key", "folder", "skip", "cfg_pos", F.col("s.n_parts").alias("match_parts")),
        F.when(F.col("provider_key").isNotNull(),
               F.struct(-F.col("s.n_parts"), F.col("cfg_pos")))).alias("_b"))
    best = best.select(domain_col, "_grp_n", "_b.*")
    return _attach(mails, best, domain_col)


def expected_folder(mails: DataFrame, domain_map: DataFrame, domain_col: str = "sender_domain",
                    out_col: str = "expected_folder") -> DataFrame:
    """Folder of the longest configured suffix of the domain (full domain
    first, then parents); NULL when none."""
    doms = _per_domain(mails, domain_col)
    cand = doms.select(domain_col, "_grp_n", F.explode(domain_suffixes(F.col(domain_col))).alias("s"))
    dim, _ = sized_broadcast(domain_map.withColumnRenamed("domain", "_dim_domain")
                             .withColumnRenamed("folder", "_dim_folder"))
    m = cand.join(dim, F.col("s.suffix") == F.col("_dim_domain"), "left")
    best = m.groupBy(domain_col, "_grp_n").agg(
        F.max_by("_dim_folder", F.when(F.col("_dim_folder").isNotNull(), F.col("s.n_parts"))).alias(out_col))
    return _attach(mails, best, domain_col)


def dispatch(routed: DataFrame, extractable: list[str] | None = None,
             file_present: Column | None = None) -> DataFrame:
    """Status before extraction and its reason.

    Missing file -> ERREUR, unknown provider -> ERREUR, skipped provider ->
    IGNORE, provider without extraction job -> IGNORE, else NULL (to extract).
    """
    extractable = fixed.EXTRACTABLE_PROVIDERS if extractable is None else extractable
    present = F.lit(True) if file_present is None else file_present
    has_job = F.array_contains(F.array(*[F.lit(p) for p in extractable]), F.col("provider_key"))
    reason = (F.when(~present, F.lit("missing_file"))
              .when(F.col("provider_key").isNull(), F.lit("unknown_provider"))
              .when(F.col("skip"), F.lit("skip"))
              .when(~has_job, F.lit("no_extractor")))
    status = (F.when(reason.isin("missing_file", "unknown_provider"), F.lit("ERREUR"))
              .when(reason.isNotNull(), F.lit("IGNORE")))
    return routed.withColumn("dispatch_reason", reason).withColumn("dispatch_status", status)


def folder_verdict(expected: Column, actual: Column) -> Column:
    """Ok / misplaced / unknown for one file."""
    return (F.when(expected.isNull(), F.lit("unknown"))
            .when(expected == actual, F.lit("ok")).otherwise(F.lit("misplaced")))


def folder_audit(files: DataFrame, domain_map: DataFrame, actual_col: str = "folder",
                 domain_col: str = "sender_domain") -> tuple[DataFrame, DataFrame]:
    """(detail rows with their verdict, verdict counts) of a file scan
    against the folder expected from the sender domain."""
    routed = expected_folder(files, domain_map, domain_col)
    detail = routed.withColumn("verdict", folder_verdict(F.col("expected_folder"), F.col(actual_col)))
    return detail, detail.groupBy("verdict").agg(F.count(F.lit(1)).alias("n_files"))


def is_pending(status: Column, statuses: tuple[str, ...] = ("PENDING",)) -> Column:
    """Missing status counts as PENDING; only listed statuses are (re)processed."""
    return F.coalesce(status, F.lit("PENDING")).isin(*statuses)


def file_action(known_path: Column, path: Column, file_name: Column) -> Column:
    """Duplicate (Message-ID known under another file), reindex (already
    has the canonical date prefix), else rename."""
    return (F.when(known_path.isNotNull() & (known_path != path), F.lit("duplicate"))
            .when(file_name.rlike(fixed.CANONICAL_NAME_PREFIX_RE), F.lit("reindex"))
            .otherwise(F.lit("rename")))


def sender_predicate(domain: Column, active: list[str]) -> Column:
    """R4 (sender part): domain equals or is a subdomain of an active domain."""
    if not active:
        raise ValueError("no sender domain configured")
    cond = F.lit(False)
    for d in active:
        cond = cond | (domain == d) | domain.endswith("." + d)
    return cond


def with_sender_domain(df: DataFrame, from_col: str, out_col: str = "sender_domain") -> DataFrame:
    return df.withColumn(out_col, T.sender_domain(F.col(from_col)))


def canonical_names(renames: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Final name of each renamed file.

    ``renames(folder, base, path)``: target ``<base>.eml`` per file.  Files
    sharing a target in one folder are taken in path order; the k-th takes
    the k-th free name among ``base.eml``, ``base_2.eml``, ``base_3.eml``, ...
    skipping names already present (``existing(folder, name)``).

    Without gathering a target's taken names anywhere: with the taken
    numbers sorted (``t_i`` the i-th smallest), the k-th free number equals
    the rank of ``k - 1/2`` among ``{t_i - i}`` and ``{k' - 1/2}`` of the
    target.  Both ranks are skew-safe group ranks."""
    from alertlake.operators import dedup

    r = renames.withColumn("_k", F.split("path", "/"))
    r = dedup.rank_within_group(r, ["folder", "base"], ["_k"], out_col="_rank").drop("_k")
    if existing is not None:
        stem = F.regexp_replace("name", r"\.eml$", "")
        numbered_re = r"^(.*)_([2-9]|[1-9][0-9]+)\.eml$"   # the names the counter can produce
        plain = existing.where(F.col("name").endswith(".eml")).select("folder", stem.alias("base"),
                                                                     F.lit(1).alias("n"))
        numbered = existing.where(F.col("name").rlike(numbered_re)).select(
            "folder", F.regexp_extract("name", numbered_re, 1).alias("base"),
            F.regexp_extract("name", numbered_re, 2).try_cast("bigint").alias("n")).where("n is not null")
        taken = plain.unionByName(numbered).distinct()
        taken = taken.join(r.select("folder", "base").distinct(), ["folder", "base"], "left_semi")
    if existing is None or taken.limit(1).count() == 0:  # no target name is taken: k-th file -> k
        n = F.col("_rank")
    else:
        taken = dedup.rank_within_group(taken, ["folder", "base"], ["n"], out_col="_i")
        t = taken.select("folder", "base", (F.col("n") - F.col("_i")).cast("double").alias("_v"),
                         F.lit(None).cast("string").alias("path"))
        q = r.select("folder", "base", (F.col("_rank") - 0.5).alias("_v"), "path")
        u = dedup.rank_within_group(t.unionByName(q), ["folder", "base"], ["_v"], out_col="_n")
        r = r.join(u.where(F.col("path").isNotNull()).select("path", "_n"), "path")
        n = F.col("_n")
    name = F.concat(F.col("base"), F.when(n > 1, F.concat(F.lit("_"), n.cast("string"))).otherwise(F.lit("")),
                    F.lit(".eml"))
    return r.withColumn("new_name", name).drop("_rank", "_n")
