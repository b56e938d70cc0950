"""SQL (DuckDB dialect) twins of ``alertlake.functions.text``, for the oracle.

RE2 has no look-around and ASCII-only ``\\b``/``\\s``: boundaries are written
as explicit consumed classes and whitespace as the explicit class of
``alertlake.functions.rx.space_chars`` (Python's ``str.isspace`` set).
"""

from __future__ import annotations

from alertlake import fixed
from alertlake.functions import rx
from alertlake.functions.text import _fold_apostrophes_py, strip_accents_py

q = rx.sql_quote


def strip_accents(x: str) -> str:
    return f"strip_accents({x})"


def normalize(x: str) -> str:
    return f"regexp_replace(strip_accents(lower({x})), {q(rx.space_class(r'\-_/') + '+')}, '', 'g')"


def clean_entities(x: str) -> str:
    out = x
    for ent, ch in fixed.HTML_ENTITIES:
        out = f"replace({out}, {q(ent)}, {q(ch)})"
    return out


def clean_html(x: str) -> str:
    t = f"regexp_replace({x}, '(?s)<style[^>]*>.*?</style>', '', 'g')"
    t = f"regexp_replace({t}, '(?s)<script[^>]*>.*?</script>', '', 'g')"
    t = f"regexp_replace({t}, '<[^>]+>', ' ', 'g')"
    t = clean_entities(t)
    t = f"regexp_replace({t}, {q(rx.space_class() + '+')}, ' ', 'g')"
    return f"trim({t}, ' ')"


def title_slug(x: str) -> str:
    nw = rx.RE2_NONWORD
    gender = f"(^|{nw})(?:h/f|f/h|h/f/x|m/f)({nw}|$)"
    t = f"regexp_replace({x}, {q(gender)}, '\\1\\2', 'gi')"
    t = f"regexp_replace({t}, {q(r'\([^\n]*?\)|\[[^\n]*?\]')}, '', 'g')"
    words = f"regexp_extract_all({t}, {q('[a-zA-Z' + chr(0xC0) + '-' + chr(0xFF) + '0-9]+')})"
    stop = "[" + ", ".join(q(w) for w in fixed.TITLE_STOPWORDS) + "]"
    norm = f"list_transform({words}, lambda w: strip_accents(lower(w)))"
    kept = f"list_filter({norm}, lambda w: NOT list_contains({stop}, w))"
    return f"substr(array_to_string({kept}, ''), 1, {fixed.SLUG_MAX_LEN})"


def dedup_key(e: str, v: str, t: str) -> str:
    return (f"concat_ws('|', coalesce(nullif({normalize(e)}, ''), {q(fixed.KEY_EMPTY_COMPANY)}), "
            f"coalesce(nullif({normalize(v)}, ''), {q(fixed.KEY_EMPTY_CITY)}), "
            f"coalesce(nullif({title_slug(t)}, ''), {q(fixed.KEY_EMPTY_TITLE)}))")


def blacklist_term(x: str, terms: list[str]) -> str:
    folded = f"translate(strip_accents(lower({x})), {q(fixed.APOSTROPHE_VARIANTS)}, {q(chr(39) * len(fixed.APOSTROPHE_VARIANTS))})"
    whens = " ".join(
        f"WHEN strpos({folded}, {q(_fold_apostrophes_py(strip_accents_py(t.lower())))}) > 0 THEN {q(t)}"
        for t in terms)
    return f"(CASE {whens} ELSE NULL END)"


def _kw_re2(variations: list[str]) -> str:
    alt = "|".join(rx.escape(v) for v in variations)
    return f"(^|[^a-zA-Z0-9])(?:{alt})([^a-zA-Z0-9]|$)"


def stack_tags(x: str, keywords: dict[str, list[str]]) -> str:
    items = ", ".join(
        f"CASE WHEN regexp_matches(lower({x}), {q(_kw_re2(vs))}) THEN {q(name)} END"
        for name, vs in keywords.items())
    return f"array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ',')"


def contract_type(x: str, terms: list[str]) -> str:
    nw = rx.RE2_NONWORD
    alt = "|".join(rx.escape(t) for t in terms)
    return f"regexp_extract({x}, {q(f'(?i)(?:^|{nw})({alt})(?:{nw}|$)')}, 1)"


def format_offer_id(n: str) -> str:
    return f"printf('E%06d', {n})"


def sender_domain(x: str) -> str:
    return f"lower(regexp_extract(coalesce({x}, ''), '@([\\pL\\pN_.\\-]+)', 1))"


def subject_slug(x: str) -> str:
    a = f"regexp_replace(coalesce({x}, ''), '[^\\x00-\\x7F]', '', 'g')"
    d = f"regexp_replace({a}, '[^a-zA-Z0-9]+', '-', 'g')"
    t = f"lower(regexp_replace({d}, '^-+|-+$', '', 'g'))"
    c = f"substr({t}, 1, {fixed.SUBJECT_SLUG_MAX_LEN})"
    return f"(CASE WHEN {c} = '' THEN {q(fixed.SUBJECT_SLUG_EMPTY)} ELSE {c} END)"
