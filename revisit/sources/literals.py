"""Values written as SQL text, and literal rows as a relation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def sql_list(values: Iterable[object]) -> str:
    return "(" + ", ".join(sql_literal(v) for v in values) + ")"


def values_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence[object]]) -> DataFrame:
    """Literal rows as a relation, known to the planner by size."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(sql_list(row) for row in rows)} AS t({', '.join(columns)})")
