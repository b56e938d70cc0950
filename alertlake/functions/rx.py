"""Regex helpers so one pattern means the same thing on the JVM and in the oracle.

Java's ``java.util.regex`` differs from Python's ``re`` on str patterns:
``\\s``, ``\\w`` and ``\\b`` are ASCII unless ``(?U)`` is given, ``(?i)`` folds
ASCII only unless ``(?u)``, and ``\\Z`` stops before a final line break.
Character classes built here are explicit code-point lists, accepted by both
Java and RE2 (the SQL oracle), so no flag is needed where they are used.
"""

from __future__ import annotations

import functools
import re


def _ranges_to_class(cps: list[int]) -> str:
    out = []
    i = 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        if i == j:
            out.append("\\x{%X}" % cps[i])
        else:
            out.append("\\x{%X}-\\x{%X}" % (cps[i], cps[j]))
        i = j + 1
    return "".join(out)


@functools.cache
def space_chars() -> str:
    """Body of a character class equal to Python's ``\\s`` on str (``str.isspace``)."""
    return _ranges_to_class([cp for cp in range(0x3100) if chr(cp).isspace()])


@functools.cache
def space_list() -> str:
    """The characters of Python's ``\\s`` on str, as a plain string (for translate)."""
    return "".join(chr(cp) for cp in range(0x3100) if chr(cp).isspace())


def space_class(extra: str = "") -> str:
    return "[" + space_chars() + extra + "]"


# Python ``\w`` on str ~ letters, digits, underscore.  RE2 form for the oracle.
RE2_WORD = r"[\pL\pN_]"
RE2_NONWORD = r"[^\pL\pN_]"


def java(pattern: str, flags: str = "U") -> str:
    """Compile-ready Java form of a Python-style pattern.

    Adds the inline flags (default ``U``: Unicode classes, which also implies
    Unicode case folding) and maps the end-of-input anchor ``\\Z`` to ``\\z``.
    """
    pattern = pattern.replace(r"\Z", r"\z")
    return f"(?{flags}){pattern}" if flags else pattern


_META = set(r"\.^$|?*+()[]{}/#-")


def escape(literal: str) -> str:
    """Escape a literal for use inside a Java or RE2 pattern."""
    return "".join("\\" + c if c in _META else c for c in literal)


def sql_quote(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"
