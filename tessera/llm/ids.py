"""Checks of id columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def require_integers(df: DataFrame, id_col: str) -> None:
    kind = df.schema[id_col].dataType.simpleString()
    if kind not in _INTEGERS:
        raise TypeError(f"{id_col} must be an integer column, it is {kind}")
