"""Département resolution (J3, J4, J5) and place / salary parsing.

Resolution runs on *distinct* city strings (a city repeats across many
offers), then joins the small answer back:

1. exact: accent-stripped, lower-cased, trimmed key equal to a dimension key;
2. prefix: the first dimension entry (config order) whose key starts with the
   key's first word — an equality join of the distinct unmatched words with the
   dimension keys' beginnings, cut at the lengths that the words have;
3. geocode: a user-supplied reference table ``(city, postcode)`` standing in
   for the online geocoder; département = first two postcode characters;
4. otherwise "".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.functions import rx
from alertlake.functions import text as T
from alertlake.operators.joins import sized_broadcast
from alertlake.operators.skew import join_back

_WS = rx.space_class()


def city_key(city: Column) -> Column:
    """Lookup key: lower-cased, accent-stripped, surrounding whitespace removed."""
    trimmed = F.regexp_replace(F.lower(city), f"^{_WS}+|{_WS}+$", "")
    return T.strip_accents(trimmed)


def first_word(key: Column) -> Column:
    return F.coalesce(F.get(F.split(F.regexp_replace(key, f"^{_WS}+", ""), _WS + "+"), 0), F.lit(""))


def resolve_cities(cities: DataFrame, city_dim: DataFrame, geocode_ref: DataFrame | None = None,
                   city_col: str = "ville") -> DataFrame:
    """One row per distinct non-empty city: dept_exact, dept_prefix,
    dept_geocode, Dept (first non-NULL, else ""), dept_method."""
    c = cities.where(F.coalesce(F.col(city_col), F.lit("")) != "").groupBy(city_col) \
        .agg(F.count(F.lit(1)).alias("_grp_n"))
    c = c.withColumn("_key", city_key(F.col(city_col)))
    dim_first = city_dim.groupBy("city_key").agg(F.min_by("dept", "pos").alias("dept_exact"))
    dim_b, _ = sized_broadcast(dim_first)
    c = c.join(dim_b, c["_key"] == dim_b["city_key"], "left").drop("city_key")
    words = c.where(F.col("dept_exact").isNull()).select(first_word(F.col("_key")).alias("_fw")) \
        .where(F.col("_fw") != "").distinct()
    pref = first_with_prefix(words, "_fw", city_dim, "city_key").withColumnRenamed("dept", "dept_prefix")
    c = c.withColumn("_fw", first_word(F.col("_key"))).join(pref, "_fw", "left")
    c = c.withColumn("dept_prefix", F.when(F.col("dept_exact").isNull(), F.col("dept_prefix")))
    if geocode_ref is not None:
        g = geocode_ref.groupBy(F.col("city").alias(city_col)).agg(
            F.substring(F.min("postcode"), 1, 2).alias("dept_geocode"))
        c = c.join(g, city_col, "left")
    else:
        c = c.withColumn("dept_geocode", F.lit(None).cast("string"))
    c = c.withColumn("dept_geocode", F.when(F.col("dept_exact").isNull() & F.col("dept_prefix").isNull(),
                                            F.col("dept_geocode")))
    dept = F.coalesce("dept_exact", "dept_prefix", "dept_geocode", F.lit(""))
    method = (F.when(F.col("dept_exact").isNotNull(), F.lit("exact"))
              .when(F.col("dept_prefix").isNotNull(), F.lit("prefix"))
              .when(F.col("dept_geocode").isNotNull(), F.lit("geocode")).otherwise(F.lit("none")))
    return c.select(city_col, "_grp_n", "dept_exact", "dept_prefix", "dept_geocode",
                    dept.alias("Dept"), method.alias("dept_method"))


def first_with_prefix(words: DataFrame, word_col: str, city_dim: DataFrame, key_col: str) -> DataFrame:
    """(word, dept) of the first dimension row (by ``pos``) whose key starts with the word, for words that have one.

    A key starts with a word where its beginning of the word's length equals it.  So the keys are cut at each length
    that occurs among the words (at most the longest key's), and the join is by hash, whatever the sizes."""
    longest = city_dim.agg(F.max(F.length(key_col))).first()[0] or 0
    lengths = [r[0] for r in words.select(F.length(word_col).alias("n")).where(F.col("n").between(1, longest)).distinct().collect()]
    cut = F.transform(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"),
                      lambda n: F.when(F.length(key_col) >= n, F.substring(F.col(key_col), F.lit(1), n)))
    begins = (city_dim.select("pos", "dept", F.explode(cut).alias(word_col)).where(F.col(word_col).isNotNull())
              .groupBy(word_col).agg(F.min_by("dept", "pos").alias("dept")))
    small, _ = sized_broadcast(words.select(word_col).distinct())
    return begins.join(small, word_col, "left_semi")


def attach_dept(offers: DataFrame, resolved: DataFrame, city_col: str = "ville",
                dept_col: str = "dept") -> DataFrame:
    """Fill an empty ``dept_col`` from the resolved cities (skew-safe join back)."""
    res = resolved.select(city_col, "_grp_n", F.col("Dept").alias("_dept_resolved"))
    small, ok = sized_broadcast(res, materialize=True)
    j = offers.join(small, city_col, "left") if ok else join_back(offers, small, [city_col], "_grp_n", "left")
    fill = F.when(F.coalesce(F.col(dept_col), F.lit("")) == "", F.coalesce(F.col("_dept_resolved"), F.lit(""))) \
        .otherwise(F.col(dept_col))
    return j.withColumn(dept_col, fill).drop("_grp_n", "_dept_resolved")


# ---------------------------------------------------------------- X9 / X10

LOC_DEPT_CITY = rf"^([0-9]{{2}}){_WS}*-{_WS}*(.+)"
LOC_CITY_DEPT = rf"^(.+?){_WS}*\(([0-9]{{2}})\)$"
LOC_POSTCODE_CITY = rf"^([0-9]{{5}}){_WS}+(.+)$"
LOC_MODE = rf"{_WS}*\([^)]*\){_WS}*$"


def parse_place(place: Column) -> tuple[Column, Column]:
    """(ville, dept) from ``NN - City``, ``City (NN)``, ``NNNNN City`` or
    ``City (mode)`` (the mode is dropped); otherwise the text as the city."""
    p = F.regexp_replace(place, f"^{_WS}+|{_WS}+$", "")
    m1, m2, m3 = p.rlike(LOC_DEPT_CITY), p.rlike(LOC_CITY_DEPT), p.rlike(LOC_POSTCODE_CITY)

    def strip(c: Column) -> Column:
        return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")

    ville = (F.when(m1, strip(F.regexp_extract(p, LOC_DEPT_CITY, 2)))
             .when(m2, strip(F.regexp_extract(p, LOC_CITY_DEPT, 1)))
             .when(m3, strip(F.regexp_extract(p, LOC_POSTCODE_CITY, 2)))
             .otherwise(strip(F.regexp_replace(p, LOC_MODE, ""))))
    dept = (F.when(m1, F.regexp_extract(p, LOC_DEPT_CITY, 1))
            .when(m2, F.regexp_extract(p, LOC_CITY_DEPT, 2))
            .when(m3, F.substring(F.regexp_extract(p, LOC_POSTCODE_CITY, 1), 1, 2))
            .otherwise(F.lit("")))
    return ville, dept


SALARY_RE = (r"([0-9][0-9" + rx.space_chars() + r"]+)" + _WS + r"*<span itemprop=['\"]salaryCurrency['\"]>€</span>"
             + _WS + r"*à" + _WS + r"*([0-9][0-9" + rx.space_chars() + r"]+)" + _WS
             + r"*<span itemprop=['\"]salaryCurrency['\"]>€</span>" + _WS + r"*(par an|par mois)")


def parse_salary(block: Column) -> tuple[Column, Column]:
    """(salaire_min, salaire_max) as annual integer strings; monthly x12;
    "" when absent."""
    period = F.regexp_extract(block, SALARY_RE, 3)
    factor = F.when(period == "par mois", F.lit(12)).otherwise(F.lit(1))

    def amount(g: int) -> Column:
        return F.regexp_replace(F.regexp_extract(block, SALARY_RE, g), _WS, "").try_cast("bigint") * factor

    ok = (period != "") & amount(1).isNotNull() & amount(2).isNotNull()
    return (F.when(ok, amount(1).cast("string")).otherwise(F.lit("")),
            F.when(ok, amount(2).cast("string")).otherwise(F.lit("")))
