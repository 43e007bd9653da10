"""Validation rules as column expressions.

A rule is ``(condition_that_is_an_error, message_column)``. ``errors_array``
folds rules into one ``array<string>`` column (empty = valid), so a whole
batch is validated in one projection instead of one Python object per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


SEP = "\x1f"  # never part of a message


def rule(is_error: Column, message) -> Column:
    msg = message if isinstance(message, Column) else F.lit(message)
    return F.when(F.coalesce(is_error, F.lit(False)), msg)


def errors_array(*rules: Column) -> Column:
    if not rules:
        return F.array().cast("array<string>")
    # concat_ws skips nulls inside generated code; an array filter would be
    # interpreted for every row
    joined = F.concat_ws(SEP, *rules)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, SEP))
