"""Carry a row's other columns past an operator that adds columns of its own."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REST = "__rest"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, needed: list[str]) -> DataFrame:
    """The needed columns, and all others in one struct, out of reach of an operator's own names."""
    others = [c for c in df.columns if c not in needed]
    rest = F.struct(*[F.col(quoted(c)) for c in others]) if others else F.struct(F.lit(None).cast("int").alias("none"))
    return df.select(*needed, rest.alias(REST))


def unpacked(df: DataFrame, columns: list[str], needed: list[str]) -> list:
    """The columns of the frame that was packed, in its order."""
    return [F.col(c) if c in needed else F.col(REST).getField(c).alias(c) for c in columns]
