"""Row filters and column steps over all-text frames, given as plain dicts."""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class StepError(ValueError):
    """A step names a column the frame does not have, or is not known."""


def _readable(col: Column) -> Column:
    """Number in a text; a type suffix as in ``1d`` or a NaN is no number."""
    number = F.when(~col.rlike(r"[0-9.][dDfF]\s*$"), col.try_cast("double"))
    return F.when(~F.isnan(number), number)


def _number(compare: Callable[[Any, Any], Column]) -> Callable[[Column, Any], Column]:
    return lambda col, value: compare(_readable(col), F.lit(float(value)))


def _texts(values: Iterable[Any]) -> list[str]:
    return [str(v) for v in values]


_TESTS: dict[str, Callable[[Column, Any], Column]] = {
    "eq": lambda col, value: col == str(value),
    "ne": lambda col, value: col != str(value),
    "in": lambda col, values: col.isin(_texts(values)),
    "not_in": lambda col, values: ~col.isin(_texts(values)),
    "gt": _number(operator.gt),
    "gte": _number(operator.ge),
    "lt": _number(operator.lt),
    "lte": _number(operator.le),
    "is_null": lambda col, _: col.isNull(),
    "not_null": lambda col, _: col.isNotNull(),
    "regex": lambda col, pattern: col.rlike(str(pattern)),
    "not_regex": lambda col, pattern: ~col.rlike(str(pattern)),
}
OPERATORS = tuple(_TESTS)


def predicate(column: str, op: str, value: Any = None) -> Column:
    """SQL three-valued logic keeps NULL out of every test but ``is_null``."""
    if op not in _TESTS:
        raise StepError(f"unknown operator {op!r}; known: {', '.join(OPERATORS)}")
    return _TESTS[op](F.col(f"`{column}`"), value)


def _require(df: DataFrame, columns: Iterable[str], step: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise StepError(f"{step}: missing columns {missing}; present {df.columns}")


def filter_rows(df: DataFrame, column: str, operator: str, value: Any = None) -> DataFrame:
    _require(df, [column], "filter")
    return df.where(predicate(column, operator, value))


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    _require(df, columns, "select_columns")
    return df.select(*[f"`{c}`" for c in columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    _require(df, mapping, "rename")
    return df.withColumnsRenamed(dict(mapping))


_STEPS: dict[str, Callable[..., DataFrame]] = {
    "filter": filter_rows,
    "select_columns": select_columns,
    "drop_columns": drop_columns,
    "rename": rename_columns,
}


def apply_steps(df: DataFrame, steps: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Steps in order, each ``{"op": name, ...arguments}``."""
    for step in steps:
        arguments = dict(step)
        name = arguments.pop("op", None)
        if name not in _STEPS:
            raise StepError(f"unknown step {name!r}; known: {', '.join(_STEPS)}")
        df = _STEPS[name](df, **arguments)
    return df


def pick_column(columns: Sequence[str], patterns: Iterable[str]) -> str | None:
    """First column matching the first pattern that matches any."""
    return next((c for p in patterns for c in columns if re.search(p, c)), None)


def require_column(columns: Sequence[str], patterns: Sequence[str], meaning: str) -> str:
    found = pick_column(columns, patterns)
    if found is None:
        raise StepError(f"no column for {meaning}: none of {list(patterns)} matches {list(columns)}")
    return found
