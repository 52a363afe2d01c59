"""Rule-based anonymisation with values that a retry repeats.

Every random value comes from SHA-256 of salt, table, column, primary key, token and digit numbers: the same
in each attempt, new with a new salt. All of it is Column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Values of a list that a rule picks from; they become part of the plan.
MOST_VALUES = 10_000


@dataclass(frozen=True)
class Rule:
    """``operation``: REPLACE, APPEND or DELETE; ``exclude``: values kept; ``exclude_row``: values that keep the row."""

    column: str
    operation: str
    text: str = ""
    exclude: tuple[str, ...] = ()
    exclude_row: tuple[str, ...] = ()


def keyed(salt: str, table: str, column: str, pk: Column, *numbers: int) -> Column:
    """64 hex digits."""
    return F.sha2(F.concat_ws("|", F.lit(salt), F.lit(table), F.lit(column), pk.cast("string"), *(F.lit(str(n)) for n in numbers)), 256)


def below(hexed: Column, n: int) -> Column:
    """A number in [0, n) from the first 12 hex digits."""
    return F.conv(F.substring(hexed, 1, 12), 16, 10).cast("bigint") % n


def _guid(h: Callable[..., Column]) -> Column:
    x = h(0)
    return F.concat_ws("-", *(F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def _number(h: Callable[..., Column], n: int) -> Column:
    if n < 2:
        raise ValueError("RANDOM(number, n) needs n of 2 or more")
    return F.concat((1 + below(h(0), 9)).cast("string"), *(below(h(i), 10).cast("string") for i in range(1, n)))


def _letters(h: Callable[..., Column], n: int) -> Column:
    if n < 1:
        raise ValueError("RANDOM(string, n) needs n of 1 or more")
    return F.concat(*(F.substring(F.lit(LETTERS), below(h(i), 52).cast("int") + 1, F.lit(1)) for i in range(n)))


def load_lists(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Lists to pick values from (``city``, ``street``), from a JSON file of arrays by name."""
    row = spark.read.option("multiLine", True).json(path).first().asDict()
    if long := [k for k, v in row.items() if len(v or []) > MOST_VALUES]:
        raise ValueError(f"more than {MOST_VALUES} values in {long}")
    return {k: list(v or []) for k, v in row.items()}


def _pick(h: Callable[..., Column], name: str, lists: dict[str, list[str]] | None) -> Column:
    values = (lists or {}).get(name)
    if not values:
        raise ValueError(f"a rule picks a {name}, and no list of these is given")
    return F.element_at(F.array(*map(F.lit, values)), (below(h(0), len(values)) + 1).cast("int"))


def split_template(text: str) -> list[str]:
    """Tokens ``{...}`` and plain runs. Unbalanced braces or parentheses raise."""
    depth = {"{": 0, "(": 0}
    for ch in text:
        for o, c in ("{}", "()"):
            depth[o] += (ch == o) - (ch == c)
            if depth[o] < 0 or depth[o] > 1:
                raise ValueError(f"unbalanced {o}{c} in {text!r}")
    if any(depth.values()):
        raise ValueError(f"unbalanced template {text!r}")
    return re.findall(r"\{[^{}]*\}|[^{}]+", text)


#: Name of a token's function, its pattern and the columns it makes; unknown functions make an empty text.
TOKENS: list[tuple[str, Callable]] = [
    (r"GUID", lambda h, m, lists: _guid(h)),
    (r"RANDOM\(\s*(city|street)\s*\)", lambda h, m, lists: _pick(h, m[1], lists)),
    (r"RANDOM\(\s*number\s*,\s*(\d+)\s*\)", lambda h, m, lists: _number(h, int(m[1]))),
    (r"RANDOM\(\s*string\s*,\s*(\d+)\s*\)", lambda h, m, lists: _letters(h, int(m[1]))),
]


def template_column(text: str, salt: str, table: str, column: str, pk: Column, lists: dict[str, list[str]] | None = None) -> Column:
    """A template as a column: blank is '', text without a token is trimmed, a RANDOM without a number raises."""
    if not text.strip():
        return F.lit("")
    if "{" not in text:
        return F.lit(text.strip())
    parts = []
    for k, token in enumerate(split_template(text)):
        if not token.startswith("{"):
            parts.append(F.lit(token))
            continue
        body = token[1:-1].strip()
        if re.fullmatch(r"RANDOM\(\s*(number|string)\s*,?\s*\)", body):
            raise ValueError(f"{body}: no length")
        for pattern, make in TOKENS:
            if m := re.fullmatch(pattern, body):
                parts.append(make(lambda *n, k=k: keyed(salt, table, column, pk, k, *n), m, lists))
                break
    return F.concat(*parts) if parts else F.lit("")


def anonymize(df: DataFrame, rules: list[Rule], table: str, pk: str, salt: str, lists: dict[str, list[str]] | None = None) -> DataFrame:
    """``df`` under its rules; names match in any case. Null stays null; DELETE makes null; a row that holds a
    value of any ``exclude_row`` is left whole."""
    keep_row = F.lit(False)
    for r in rules:
        if r.exclude_row:
            keep_row = keep_row | F.coalesce(F.col(r.column).cast("string").isin(list(r.exclude_row)), F.lit(False))
    by_name = {c.lower(): c for c in df.columns}
    new: dict[str, Column] = {}
    for r in rules:
        name = by_name.get(r.column.lower())
        if name is None:
            continue
        c, kind = F.col(name), df.schema[name].dataType
        made = template_column(r.text, salt, table, name.lower(), F.col(pk), lists) if r.operation != "DELETE" else F.lit(None)
        made = F.concat(c.cast("string"), made) if r.operation == "APPEND" else made
        kept = keep_row | (F.coalesce(c.cast("string").isin(list(r.exclude)), F.lit(False)) if r.exclude else F.lit(False))
        new[name] = F.when(kept | c.isNull(), c).otherwise(made.cast(kind))
    return df.withColumns(new)
