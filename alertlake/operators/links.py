"""Link / token extraction shared by the extraction jobs.

All matches of a pattern in a document come out of one ``regexp_extract_all``;
their groups are taken from the short match where the pattern looks at nothing
around it (else one pass per group), and exploded; no per-row Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertlake.functions import text as T


def explode_matches(df: DataFrame, text_col: str, pattern: str, groups: dict[str, int],
                    keep: list[str], pos_col: str = "pos", limit: int | None = None,
                    first_by: list[str] | None = None) -> DataFrame:
    """One row per match of ``pattern`` in ``text_col`` with its 1-based position.

    ``groups`` maps output column -> capture group.  ``limit`` keeps the first
    ``limit`` matches of each document (a feature of some templates: applied
    before any later filter).  ``first_by`` keeps only the first match of each
    value of those groups (X12 within-document dedup), decided on the match
    array of the row itself: no shuffle.
    """
    found = matches(text_col, pattern, groups, limit, first_by)
    out = df.select(*keep, F.explode(found).alias("_e"))
    return out.select(*keep, F.col("_e.p").alias(pos_col), *[F.col(f"_e.m.{name}").alias(name) for name in groups])


def matches(text_col: str, pattern: str, groups: dict[str, int], limit: int | None = None,
            first_by: list[str] | None = None) -> Column:
    """The matches that ``explode_matches`` explodes: structs of the groups (``m``) and the position (``p``)."""
    if _alone(pattern):
        zipped = F.transform(F.regexp_extract_all(text_col, F.lit(pattern), 0), lambda m: F.struct(
            *[F.regexp_extract(m, pattern, g).alias(name) for name, g in groups.items()]))
    else:
        zipped = F.arrays_zip(*[F.regexp_extract_all(text_col, F.lit(pattern), g).alias(name) for name, g in groups.items()])
    if limit is not None:
        zipped = F.slice(zipped, 1, limit)
    pos = F.transform(zipped, lambda m, i: F.struct(m.alias("m"), (i + 1).cast("bigint").alias("p")))
    if first_by:
        pos = first_in_array(pos, lambda e: F.struct(*[e["m"][k] for k in first_by]))
    return pos


def _alone(pattern: str) -> bool:
    """Does a match depend on its own characters only (no look-around, anchor or boundary)?"""
    return not re.search(r"\(\?[=!<]|\\[bBAzZG]|(?<!\[)\^|\$", pattern)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, wherever ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def blocks(text: Column, size: int) -> Column:
    """The text in blocks of ``size`` characters (the last one may be shorter)."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), 0)


def places(cut: Column, size: int, marker: str) -> Column:
    """Where ``marker`` (letters and slashes) occurs in a text cut into ``blocks``: its place from 0, and the
    digits that follow it, up to ``size - len(marker)`` at least.  Blocks are no shorter than the marker.  One pass, and a sum over what a block holds for each place."""
    def in_block(all_: Column) -> Column:
        def of(block: Column, b: Column) -> Column:
            def found(two: Column) -> Column:
                own = F.split(F.substring(two, F.lit(1), F.length(block) + (len(marker) - 1)), marker, -1)
                return bound(own, lambda parts: F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda _, i: bound(
                    F.aggregate(F.slice(parts, F.lit(1), i + 1), i * len(marker), lambda n, x: n + F.length(x)),
                    lambda at: F.struct((b * size + at).alias("at"), F.regexp_extract(
                        F.substring(two, at + (len(marker) + 1), F.lit(size)), "^[0-9]+", 0).alias("digits")))))
            return bound(F.concat(block, F.coalesce(F.get(all_, b + 1), F.lit(""))), found)
        return F.flatten(F.transform(all_, of))

    return bound(cut, in_block)


def least_places(at: Column, ids: Column) -> Column:
    """For each of ``ids``, the least of ``places`` whose digits begin with it (none: NULL).

    The places' beginnings as long as an id and the ids are sorted together, so an id stands next to its places."""
    def of_lengths(wanted: Column) -> Column:
        beginnings = F.flatten(F.transform(F.array_distinct(F.transform(wanted, F.length)), lambda n: F.transform(
            F.filter(at, lambda p: F.length(p["digits"]) >= n),
            lambda p: F.struct(F.substring(p["digits"], F.lit(1), n).alias("k"), F.lit(0).alias("q"), p["at"].alias("i")))))
        asked = F.transform(wanted, lambda x, i: F.struct(x.alias("k"), F.lit(1).alias("q"), i.alias("i")))
        return bound(F.sort_array(F.concat(beginnings, asked)), answered)

    def answered(s: Column) -> Column:
        heads = F.transform(s, lambda e, j: F.when(
            (j == 0) | (F.get(s, j - 1)["k"] != e["k"]), F.struct(F.when(e["q"] == 0, e["i"]).alias("at"))))
        both = F.zip_with(s, filled_forward(heads), lambda e, h: F.struct(
            F.when(e["q"] == 1, e["i"]).alias("i"), h["at"].alias("at")))
        return F.transform(F.sort_array(F.filter(both, lambda x: x["i"].isNotNull())), lambda x: x["at"])

    return bound(ids, of_lengths)


def filled_forward(arr: Column) -> Column:
    """The array with each NULL replaced by the last value before it (none: NULL): a run of places per value."""
    def fill(a: Column) -> Column:
        heads = F.filter(F.transform(a, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda e: e["x"].isNotNull())
        return bound(heads, lambda h: F.concat(
            F.slice(a, F.lit(1), F.coalesce(F.get(h, F.lit(0))["i"], F.size(a))),
            F.flatten(F.transform(h, lambda e, k: F.array_repeat(
                e["x"], (F.coalesce(F.get(h, k + 1)["i"], F.size(a)) - e["i"]).cast("int"))))))

    return bound(arr, fill)


def first_in_array(arr: Column, key) -> Column:
    """Elements whose ``key`` does not occur earlier in the array (order kept).

    Keys are sorted with their places, so equal ones stand together and the first of each is its least
    place: n log n steps.  The array and its keys are bound to lambda variables, so the regexes that
    make the array run once per row, not once per element."""
    def first(a: Column) -> Column:
        keyed = F.sort_array(F.transform(a, lambda e, i: F.struct(key(e).alias("k"), i.alias("i"))))
        heads = bound(keyed, lambda s: F.filter(
            s, lambda e, j: (j == 0) | ~F.get(s, j - 1)["k"].eqNullSafe(e["k"])))
        return F.transform(F.sort_array(F.transform(heads, lambda e: e["i"])), lambda i: F.get(a, i))

    return bound(arr, first)


def carry_forward_last(df: DataFrame, part_cols: list[str], order_col: str, value: Column,
                       out_col: str) -> DataFrame:
    """Last non-empty ``value`` at or before each row of the partition."""
    w = (Window.partitionBy(*part_cols).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out_col, F.last(F.nullif(value, F.lit("")), ignorenulls=True).over(w))


def url_quality(native_id: Column, template_prefix: Column, raw_url: Column) -> tuple[Column, Column]:
    """X11: canonical URL from a native id (``construite``), else the tracking
    URL as found (``email``), else nothing (``vide``)."""
    has_id = native_id.isNotNull() & (native_id != "")
    has_url = raw_url.isNotNull() & (raw_url != "")
    url = (F.when(has_id, F.concat(template_prefix, native_id))
           .when(has_url, T.clean_entities(raw_url)).otherwise(F.lit("")))
    quality = F.when(has_id, F.lit("construite")).when(has_url, F.lit("email")).otherwise(F.lit("vide"))
    return url, quality
