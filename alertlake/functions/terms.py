"""Many terms looked for in one pass over a text.

The terms become one pattern shaped like a tree of their characters, so a place in the text costs as many steps
as characters can follow there, however many terms there are.  At each place the longest term is
found; the terms that begin it are known beforehand.  What a found term means is read from a literal table of buckets
by its hash, so that too does not grow with the number of terms.
"""

from __future__ import annotations

import functools
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertlake.functions import rx

_ALNUM = "a-zA-Z0-9"
#: Between buckets, before a term, and before its numbers; no term may hold them.
_BUCKET, _TERM, _NUMBERS = "\ufdd0", "\ufdd1", "\ufdd2"


def tree_pattern(terms: list[str], end: str = "") -> str:
    """A pattern that matches the longest of the terms that is followed by ``end``."""
    root: dict = {}
    for term in terms:
        node = root
        for c in term:
            node = node.setdefault(c, {})
        node[""] = {}

    def write(node: dict) -> str:
        ways = [rx.escape(c) + write(child) for c, child in sorted(node.items()) if c]
        if "" in node:
            ways.append(end)
        return ways[0] if len(ways) == 1 else "(?:" + "|".join(ways) + ")"

    firsts = "" if "" in root else "(?=[" + "".join(rx.escape(c) for c in sorted(root)) + "])"
    return firsts + write(root)


def _is_alnum(c: str) -> bool:
    return c.isascii() and c.isalnum()


@functools.lru_cache(maxsize=16)
def _compiled(terms: tuple[tuple[str, tuple[int, ...]], ...], whole_words: bool) -> tuple[str, int, str]:
    """The pattern, the number of buckets, and the buckets' table."""
    own = dict(terms)
    if any(c in t for t in own for c in (_BUCKET, _TERM, _NUMBERS)):
        raise ValueError("a term holds a character that separates terms")
    pattern = tree_pattern(list(own), f"(?![{_ALNUM}])" if whole_words else "")
    pattern = (f"(?<![{_ALNUM}])" if whole_words else "") + f"(?=({pattern}))"
    size = 1 << max(0, len(own) - 1).bit_length()
    buckets = [""] * size
    for term in own:
        numbers = set()
        for n in range(len(term) + 1):
            begins = own.get(term[:n])
            if begins and (n == len(term) or not whole_words or not _is_alnum(term[n])):
                numbers.update(begins)
        buckets[zlib.crc32(term.encode()) % size] += f"{_TERM}{term}{_NUMBERS}{','.join(map(str, sorted(numbers)))}"
    return pattern, size, _BUCKET.join(b + _TERM for b in buckets)


def numbers_in(text: Column, terms: dict[str, list[int]], whole_words: bool = False) -> Column:
    """The numbers of all terms in the text, each once and sorted; null in a null text.

    With ``whole_words``, a term counts only where no ASCII letter or digit stands before or after it."""
    pattern, size, table = _compiled(tuple((t, tuple(n)) for t, n in terms.items()), whole_words)
    buckets = F.split(F.lit(table), _BUCKET)

    def numbers(term: Column) -> Column:
        bucket = F.get(buckets, F.pmod(F.crc32(F.encode(term, "UTF-8")), F.lit(size)).cast("int"))
        after = F.split_part(bucket, F.concat(F.lit(_TERM), term, F.lit(_NUMBERS)), F.lit(2))
        return F.split(F.substring_index(after, _TERM, 1), ",").cast("array<int>")

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 1))
    return F.sort_array(F.array_distinct(F.flatten(F.transform(found, numbers))))


def name_of(number: Column, names: list[str]) -> Column:
    """The name with that number (from 0); null for null."""
    return F.get(F.split(F.lit(_BUCKET.join(names)), _BUCKET), number)
