"""Plan shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fixed(rows: DataFrame, kept: list[str], computed: dict[str, Column]) -> DataFrame:
    """`kept` columns and `computed` ones, the latter evaluated once per row.

    A filter on a computed column is normally pushed below it with the whole
    expression copied into the condition, which then runs twice. It cannot move
    below a generator, so the values are passed through one of a single row.
    """
    values = F.struct(*[c.alias(n) for n, c in computed.items()])
    return rows.select(*kept, F.inline(F.array(values)))
