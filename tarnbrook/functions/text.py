"""Typing of text cells: null tokens, numbers, days, width rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the load format.
NULL_TOKENS = ("NULL", "")
DAY_FORMAT = "M/d/yyyy"


def null_token(cell: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    return F.when(~cell.isin(*tokens), cell)


def null_tokens(df: DataFrame, columns: list[str], tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Replace every null token in ``columns`` by NULL."""
    return df.withColumns({name: null_token(F.col(name), tokens) for name in columns})


def to_whole(cell: Column, precision: int, target: str) -> Column:
    """Text to a whole number of at most ``precision`` digits; NULL if it is none.

    The decimal step rounds half up ('12.6' gives 13); a direct cast to an
    integer type would reject the fraction.
    """
    return cell.try_cast(f"decimal({precision},0)").cast(target)


def to_day(cell: Column, day_format: str = DAY_FORMAT) -> Column:
    return F.try_to_date(cell, day_format)

