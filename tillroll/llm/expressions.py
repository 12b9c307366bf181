"""Helpers for expressions on arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def hashable(rows: DataFrame, within: str = "") -> list[Column]:
    """All columns of ``rows``, found ``within`` a struct if named. Maps have no hash, so columns that hold one are taken as text."""
    at = f"{within}." if within else ""
    column = lambda name, kind: F.to_json(F.struct(F.col(f"{at}`{name}`").alias("c"))) if "map<" in kind or kind == "variant" else F.col(f"{at}`{name}`")
    return [column(name, kind) for name, kind in rows.dtypes]
