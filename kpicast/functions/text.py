"""Small helpers for rules written as Spark SQL text.

Rules and generated feature lists are kept as SQL expressions over column names:
they read like the rule they state, and a list of hundreds of them is parsed in
one call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def quoted(label: str) -> str:
    return "'" + label.replace("'", "''") + "'"


def num(value: float) -> str:
    return f"{float(value)!r}D"


def case(cases: list[tuple[str, str]], default: str) -> str:
    """Ordered rule: the first condition that holds gives the value."""
    arms = " ".join(f"WHEN {condition} THEN {value}" for condition, value in cases)
    return f"CASE {arms} ELSE {default} END"


def label_case(cases: list[tuple[str, str]], default: str) -> str:
    """:func:`case` whose values are label texts."""
    return case([(condition, quoted(label)) for condition, label in cases], quoted(default))


def any_of(conditions: list[str]) -> str:
    return "(" + " OR ".join(f"({c})" for c in conditions) + ")"


def all_of(conditions: list[str]) -> str:
    return "(" + " AND ".join(f"({c})" for c in conditions) + ")"


def one_of(column: str, labels: list[str]) -> str:
    return f"{column} IN ({', '.join(quoted(label) for label in labels)})"


def add(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """``df`` with new columns given as SQL text."""
    return df.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in expressions.items()])


def pick(df: DataFrame, names: list[str], expressions: dict[str, str]) -> DataFrame:
    """The named columns and the new ones."""
    return df.selectExpr(*names, *[f"{sql} AS `{name}`" for name, sql in expressions.items()])


def column(sql: str) -> Column:
    return F.expr(sql)
