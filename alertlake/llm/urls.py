"""URL filter: all glob rules at once, by a bit-parallel wildcard automaton.

A rule ``host/path`` becomes a glob over the canonical URL ``.host/path``: the rule's
host after any subdomains, then its path as a prefix.  All globs are laid out side by
side in the bits of a few 64-bit words (Shift-And).  The words of many URLs advance
together, one character a step, so the cost does not depend on the number of rules
that a URL could fit, only on the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import bound_batches

#: (verdict, host, path) of the production rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: URLs that advance together; bounds the state to a few MB.
ROWS = 4096


class GlobAutomaton:
    """Shift-And masks of globs over bytes.  ``*`` stands for any bytes but ``/``, ``**`` for any.

    Bit i of the state says that the glob's elements up to i fit the text so far.  An
    element is a byte; a star adds no bit of its own, it lets the bit before it stay."""

    def __init__(self, globs: Sequence[str]):
        starts, finals, match, keep_in, keep_all = [], [], [], [], []
        for glob in globs:
            raw, i = glob.encode(), 0
            starts.append(len(match))
            match.append(None)  # the bit "nothing read yet"; it is never set by a byte
            keep_in.append(False)
            keep_all.append(False)
            while i < len(raw):
                if raw[i:i + 2] == b"**":
                    keep_all[-1] = True
                    i += 2
                elif raw[i:i + 1] == b"*":
                    keep_in[-1] = True
                    i += 1
                else:
                    match.append(raw[i])
                    keep_in.append(False)
                    keep_all.append(False)
                    i += 1
            finals.append(len(match) - 1)
        self.words = -(-max(1, len(match)) // 64)
        self.start = self._mask(starts)
        self.finals = finals
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        by_byte: dict[int, list[int]] = {}
        for bit, byte in enumerate(match):
            if byte is not None:
                by_byte.setdefault(byte, []).append(bit)
        for byte, bits in by_byte.items():
            self.step[byte] = self._mask(bits)
        everywhere = self._mask([i for i, k in enumerate(keep_all) if k])
        in_part = self._mask([i for i, k in enumerate(keep_in) if k])
        self.stay[:] = everywhere | in_part
        self.stay[ord("/")] = everywhere

    def _mask(self, bits: Sequence[int]) -> np.ndarray:
        words = np.zeros(self.words, np.uint64)
        for b in bits:
            words[b // 64] |= np.uint64(1 << (b % 64))
        return words

    def fits(self, texts: Sequence[bytes]) -> np.ndarray:
        """Which glob fits which whole text, as a matrix of texts by globs.

        Texts are sorted by length, so that those that have ended no longer take part."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order])
        state = np.tile(self.start, (len(texts), 1))
        joined = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        for k in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -k, side="left"))  # texts longer than k
            byte = joined[begin[:live] + k]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[byte]) | (now & self.stay[byte])
        out = np.zeros((len(texts), len(self.finals)), bool)
        for j, bit in enumerate(self.finals):
            out[order, j] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
        return out


def rule_glob(host: str, path: str) -> str:
    """The rule's host at the end of ``.host``, its path at the start of the path."""
    return f"*.{host}{path}**"


def _split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, sign, rest = (url or "").partition("://")
    if not sign:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.encode().lower().decode(), slash + path


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: its id, ``host``, ``path``, ``rule``, ``verdict``.

    The longest rule that fits decides (of equally long ones the first given).  Where none
    fits, ``rule`` is null and the verdict is ``default``.  A null URL or one without
    ``://`` has an empty host and path, which no rule fits.  Only the id and the URL are
    read; an empty table gives an empty result."""
    bound_batches(pages.sparkSession)
    automaton = GlobAutomaton([rule_glob(h, p) for _, h, p in rules])
    names = np.array([h + p for _, h, p in rules] + [None], dtype=object)
    verdicts = np.array([v for v, _, _ in rules] + [default], dtype=object)
    longest = np.array([len(n) for n in names[:-1]], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                split = [_split_url(u) for u in part.column(1).to_pylist()]
                fits = automaton.fits([f".{h}{p}".encode() for h, p in split])
                size = np.where(fits, longest, -1)
                best = np.where(fits.any(axis=1), size.argmax(axis=1), len(rules))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([h for h, _ in split], pa.string()),
                     pa.array([p for _, p in split], pa.string()),
                     pa.array(names[best], pa.string()), pa.array(verdicts[best], pa.string())],
                    names=[id_col, "host", "path", "rule", "verdict"])

    source = pages.select(id_col, url_col)
    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def oracle(rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow") -> str:
    """The same in DuckDB SQL."""
    values = ", ".join(f"({i}, '{v}', '{h}', '{p}')" for i, (v, h, p) in enumerate(rules))
    return f"""
WITH r(k, verdict, host, path) AS (VALUES {values}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM u),
m AS (SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path) * 1000 - r.k) AS rule,
             arg_max(r.verdict, length(r.host || r.path) * 1000 - r.k) AS verdict
      FROM s JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY page_id)
SELECT s.page_id, s.host, s.path, m.rule, coalesce(m.verdict, '{default}') AS verdict
FROM s LEFT JOIN m ON s.page_id = m.page_id"""
