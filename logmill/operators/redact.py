"""Masking of sensitive fields and values."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts of sensitive names, and the mask.
KEY_PATTERNS = ("password", "secret", "token", "key", "authorization", "cookie", "credit_card", "two_factor")
MASK = "********"


def _sensitive(name: str, patterns: Sequence[str]) -> bool:
    return any(p and p.lower() in name.lower() for p in patterns)


def _valid(regexes: Sequence[str]) -> list[str]:
    out = []
    for r in regexes:
        try:
            re.compile(r)
            out.append(r)
        except (re.error, TypeError):
            pass  # an invalid pattern is passed over, it stops nothing
    return out


def _values(c: Column, regexes: Sequence[str], mask: str) -> Column:
    return reduce(lambda x, r: F.regexp_replace(x, r, mask.replace("\\", "\\\\").replace("$", "\\$")), regexes, c)


def _column(c: Column, kind: T.DataType, patterns: Sequence[str], regexes: Sequence[str], mask: str) -> Column:
    if isinstance(kind, T.StructType):
        parts = [(F.when(c[f.name].isNotNull(), F.lit(mask)) if _sensitive(f.name, patterns) else _column(c[f.name], f.dataType, patterns, regexes, mask)).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _column(x, kind.elementType, patterns, regexes, mask))
    if isinstance(kind, T.MapType):
        hit = lambda k: reduce(lambda a, b: a | b, [F.lower(k).contains(p.lower()) for p in patterns], F.lit(False))
        if isinstance(kind.valueType, T.StringType):
            return F.transform_values(c, lambda k, v: F.when(hit(k), F.lit(mask)).otherwise(_values(v, regexes, mask)))
        return F.transform_values(c, lambda k, v: F.when(~hit(k), _column(v, kind.valueType, patterns, regexes, mask)))
    return _values(c, regexes, mask) if isinstance(kind, T.StringType) else c


def masked_text(c: Column, name: str, key_patterns: Sequence[str] = KEY_PATTERNS, value_regexes: Sequence[str] = (), mask: str = MASK) -> Column:
    """The text ``c`` of a field called ``name``: the mask if the name holds a pattern and the text is not null, else with the regexes masked."""
    return F.when(c.isNotNull(), F.lit(mask)) if _sensitive(name, key_patterns) else _values(c, _valid(value_regexes), mask)


def redact_columns(df: DataFrame, key_patterns: Sequence[str] = KEY_PATTERNS, value_regexes: Sequence[str] = (), mask: str = MASK, columns: Sequence[str] | None = None) -> DataFrame:
    """Every column, struct field or map key whose name holds a pattern becomes ``mask``, as a text; other texts have the regexes masked.

    In a map whose values are no texts a sensitive value becomes null, as a map has one value type. Numbers of a list are no names.
    """
    regexes = _valid(value_regexes)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if columns is not None and f.name not in columns:
            out.append(c)
        elif _sensitive(f.name, key_patterns):
            out.append(F.when(c.isNotNull(), F.lit(mask)).alias(f.name))
        else:
            out.append(_column(c, f.dataType, key_patterns, regexes, mask).alias(f.name))
    return df.select(*out)


# A JSON object without white space whose values are texts, whole numbers or words, without escapes.
_PAIR = r'"[^"\\\x00-\x1f]*":(?:"[^"\\\x00-\x1f]*"|-?(?:0|[1-9][0-9]*)|true|false|null)'
_FLAT = rf"^\{{{_PAIR}(?:,{_PAIR})*\}}$"
FLAT_LENGTH = 4096  # characters of a text that is matched as a whole


def _flat_masked(c: Column, key_patterns: Sequence[str], mask: str) -> tuple[Column, Column]:
    """(whether the text ``c`` is a flat object that expressions can mask, the text with its sensitive values masked)."""
    parts = [p for p in key_patterns if p]
    if not parts or not all(re.fullmatch(r"[A-Za-z0-9_-]+", p) for p in parts) or re.search(r'["\\\x00-\x1f]', mask):
        return F.lit(False), c
    # two characters have small letters that are ASCII, which a match that knows ASCII's cases alone would miss
    flat = (F.length(c) <= FLAT_LENGTH) & c.rlike(_FLAT) & ~c.rlike("[\u0130\u212a]")
    hit = rf'([{{,])"([^"]*(?i:{"|".join(map(re.escape, parts))})[^"]*)":(?:"[^"]*"|[^,}}]+)'
    return flat, F.regexp_replace(c, hit, '$1"$2":"' + mask.replace("$", "\\$") + '"')


def redact_json(df: DataFrame, columns: Sequence[str], key_patterns: Sequence[str] = KEY_PATTERNS, value_regexes: Sequence[str] = (), mask: str = MASK) -> DataFrame:
    """The same for JSON texts of any depth; a text that is no JSON, or too deep to be read, stays as it is.

    Without value regexes, a text that holds no part of a sensitive name and no escape has nothing to mask: it stays as it is and never leaves
    the JVM; nor do flat objects without white space, escapes and fractions, which are masked by expressions (a key that an object repeats stays
    repeated there). All others go through one function in Arrow batches, which gives them without white space.
    """
    regexes = [re.compile(r) for r in _valid(value_regexes)]

    def walk(x: object) -> object:
        if isinstance(x, dict):
            return {k: mask if _sensitive(k, key_patterns) else walk(v) for k, v in x.items()}
        if isinstance(x, list):
            return [walk(v) for v in x]
        return reduce(lambda s, r: r.sub(lambda _: mask, s), regexes, x) if isinstance(x, str) else x

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            return json.dumps(walk(json.loads(text)), ensure_ascii=False, separators=(",", ":"))
        except (ValueError, RecursionError):
            return text

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(one, na_action="ignore")

    def masked(c: str) -> Column:
        if regexes:
            return clean(c)
        some = [F.contains(F.lower(c), F.lit(p.lower())) for p in key_patterns if p]
        here = reduce(lambda a, b: a | b, some, F.contains(F.col(c), F.lit("\\")))
        flat, done = _flat_masked(F.col(c), key_patterns, mask)
        return F.when(here & flat, done).otherwise(F.coalesce(clean(F.when(here & ~flat, F.col(c))), F.col(c)))

    return df.withColumns({c: masked(c) for c in columns})


def mask_values(df: DataFrame, columns: Sequence[str], regexes: Sequence[str], mask: str = MASK) -> DataFrame:
    """Every regex, in order, masked in the given text columns; invalid ones are passed over."""
    return df.withColumns({c: _values(F.col(c), _valid(regexes), mask) for c in columns})


def sensitive_profile(df: DataFrame, key_patterns: Sequence[str] = KEY_PATTERNS, value_regexes: Sequence[str] = (), mask: str = MASK) -> DataFrame:
    """Per text column: name_matches, rows scanned, values that a regex hits, values that are masked already; one pass."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    regexes = _valid(value_regexes)
    hit = lambda c: reduce(lambda a, b: a | b, [F.col(c).rlike(r) for r in regexes], F.lit(False))
    total = lambda test: F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("long")
    sums = df.agg(F.count(F.lit(1)).alias("n"), *[total(hit(c)).alias(f"h{i}") for i, c in enumerate(names)], *[total(F.col(c) == mask).alias(f"m{i}") for i, c in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(_sensitive(c, key_patterns)).alias("name_matches"), F.col("n").alias("rows"), F.col(f"h{i}").alias("value_hits"), F.col(f"m{i}").alias("masked")) for i, c in enumerate(names)])
    return sums.select(F.inline(rows))
