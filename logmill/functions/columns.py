"""Scalar functions on log columns, all as Catalyst expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import LEVELS

# What statements lose, in this order.
SQL_PATTERNS = (r"(?d)'.+?'", r'(?d)"[^"]+?"', r"(?d)\b\d+\b", r"(?i)IN\s*\(\?(?:,\s*\?)*\)")
TABLE_PATTERN, TABLE_WORDS = r"""(?i)\b{}\s+[`"]?(\w+)""", ("from", "into", "update")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def level_value(name: Column | str, default: int | None = None) -> Column:
    """Number of a level name in any case; ``default`` for an unknown or null name."""
    table = F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(F.coalesce(_col(name), F.lit("")))), F.lit(default).cast("int"))


def level_name(value: Column | str) -> Column:
    """Upper-case name of a level number; null for a number that is no level."""
    table = F.create_map(*[F.lit(x) for k, v in LEVELS.items() for x in (v, k.upper())])
    return F.when(_col(value).isNotNull(), F.try_element_at(table, F.coalesce(_col(value), F.lit(-1)).cast("int")))


def level_for_status(status: Column | str) -> Column:
    """Level name of an HTTP status."""
    s = _col(status)
    return F.when(s >= 500, "error").when(s >= 400, "warning").when(s >= 300, "notice").otherwise("info")


def uri_path(uri: Column | str) -> Column:
    """Path of ``METHOD url``: no method, scheme, host, query, fragment or leading slash; null if nothing is left."""
    plain = F.regexp_replace(_col(uri), r"(?s)^[^ ]* ", "")
    plain = F.regexp_replace(plain, r"(?s)^.*?://[^/]*", "")
    plain = F.regexp_replace(plain, r"(?s)[?#].*$", "")
    return F.nullif(F.ltrim(plain, F.lit("/")), F.lit(""))


def limit_str(text: Column | str, n: int, end: str = "...") -> Column:
    """The first ``n`` characters, and ``end`` if there were more."""
    t = _col(text)
    return F.when(F.char_length(t) > n, F.concat(F.left(t, F.lit(n)), F.lit(end))).otherwise(t)


def glob_match(text: Column | str, patterns: Sequence[object]) -> Column:
    """Whether a pattern covers the whole text; ``*`` stands for anything. Leading slashes of text and patterns do not count.

    Patterns that are empty or no strings are passed over. A pattern whose only ``*`` is its last character becomes a prefix test, which
    Parquet readers can use when the column itself is tested.
    """
    t = _col(text)
    tests = []
    for p in patterns:
        if not isinstance(p, str) or not p.lstrip("/"):
            continue
        p = p.lstrip("/")
        if "*" not in p:
            tests.append(t == p)
        elif p.index("*") == len(p) - 1:
            tests.append(t.startswith(p[:-1]))
        else:
            tests.append(t.rlike("(?s)^" + ".*".join(map(re.escape, p.split("*"))) + r"\z"))
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)) if tests else F.lit(False)


def normalize_sql(sql: Column | str, keep_identifiers: bool = False) -> Column:
    """The statement with quoted strings, numbers and lists of placeholders replaced by placeholders.

    Double-quoted text counts as a string, so statements on ``"users"`` and ``"orders"`` become equal; ``keep_identifiers`` leaves it.
    """
    quoted, identifier, number, in_list = SQL_PATTERNS
    steps = [quoted, number] if keep_identifiers else [quoted, identifier, number]
    text = _col(sql)
    out = F.regexp_replace(reduce(lambda s, pattern: F.regexp_replace(s, pattern, "?"), steps, text), in_list, "IN (?)")
    some = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in "'\"("])  # without these only numbers can be replaced
    return F.when(some, out).otherwise(F.regexp_replace(text, number, "?"))


def sql_table(sql: Column | str) -> Column:
    """The table after the first FROM, else INTO, else UPDATE; else ``unknown``."""
    found = [F.nullif(F.regexp_extract(_col(sql), TABLE_PATTERN.format(word), 1), F.lit("")) for word in TABLE_WORDS]
    return F.coalesce(*found, F.lit("unknown"))


def exception_class(stacktrace: Column | str) -> Column:
    """Class at the head of a stack trace; empty if there is none."""
    return F.coalesce(F.regexp_extract(_col(stacktrace), r"^([\w\\.]+): ", 1), F.lit(""))


def occurrences() -> Column:
    """How many events a row stands for."""
    return F.coalesce("count", F.lit(1).cast("long")) + F.coalesce("suppressed_count", F.lit(0).cast("long"))


def trace_url(trace_id: Column | str, template: str) -> Column:
    """Link of a trace; ``template`` holds one ``%s``."""
    return F.format_string(template, _col(trace_id))
