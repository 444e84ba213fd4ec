"""Rate tables: declared measures over any keys, each built from additive parts.

A measure names the sums and counts it needs and how to finish them. Additive parts can be
aggregated map-side, pooled again over coarser keys, and shared by several tables of one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisit.functions.rounding import mean, percent
from revisit.operators import exact_sums as X

Gathered = Callable[..., Column]  # a sum's digits by its part's name, and over all groups with ``True``


@dataclass(frozen=True)
class Measure:
    """``parts`` maps part names to SQL aggregates; ``finish`` turns the parts into the result.

    ``exact`` does so where a part is a sum of doubles, or of decimals of more than six places.
    ``whole`` says that the parts are also needed as sums over all groups, under the names of :func:`over_all`.
    """

    name: str
    parts: Mapping[str, str]
    finish: Callable[[], Column]
    exact: Callable[[Gathered], Column] | None = None
    whole: bool = False


def over_all(part: str) -> str:
    return f"_all_{part}"


ROWS = {"rows": "count(1)"}


def rows(name: str) -> Measure:
    return Measure(name, ROWS, lambda: F.col("rows"))


def total(name: str, column: str) -> Measure:
    """The sum: a whole number or decimal, or the double nearest to the exact sum of doubles."""
    part, known = f"sum_{column}", {f"count_{column}": f"count({column})"}
    exact = lambda of: X.nearest_double(of(part), F.col(f"count_{column}"))
    return Measure(name, {part: f"sum({column})", **known}, lambda: F.col(part), exact)


def total_if(name: str, condition: str) -> Measure:
    part = f"if_{name}"
    return Measure(name, {part: f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"}, lambda: F.col(part))


def _sum_and_count(column: str) -> dict[str, str]:
    return {f"sum_{column}": f"sum({column})", f"count_{column}": f"count({column})"}


def flag_percent(name: str, flag: str) -> Measure:
    """Share of ones among the rows where the flag is known."""
    exact = lambda of: X.exact_percent(of(f"sum_{flag}"), F.col(f"count_{flag}"))
    return Measure(name, _sum_and_count(flag), lambda: percent(F.col(f"sum_{flag}"), F.col(f"count_{flag}")), exact)


def average(name: str, column: str) -> Measure:
    exact = lambda of: X.exact_mean(of(f"sum_{column}"), F.col(f"count_{column}"))
    return Measure(name, _sum_and_count(column), lambda: mean(F.col(f"sum_{column}"), F.col(f"count_{column}")), exact)


def share_of_rows(name: str) -> Measure:
    """Rows of the group as a percentage of all groups in the table."""
    return Measure(name, ROWS, lambda: percent(F.col("rows"), F.col(over_all("rows"))), whole=True)


def share_of_total(name: str, column: str) -> Measure:
    part = f"sum_{column}"
    exact = lambda of: X.exact_share(of(part), of(part, True))
    return Measure(name, {part: f"sum({column})"}, lambda: percent(F.col(part), F.col(over_all(part))), exact, whole=True)


def part_aggregates(df: DataFrame, measures: Sequence[Measure]) -> list[Column]:
    """The measures' parts as aggregates that are exact: whole numbers, decimals, or digits of doubles.

    A sum of doubles becomes several columns (see :mod:`exact_sums`) and costs a pass that finds the sizes.
    """
    needed: dict[str, str] = {}
    for measure in measures:
        needed.update(measure.parts)
    kinds = {f.name: f.dataType for f in df.agg(*[F.expr(sql).alias(part) for part, sql in needed.items()]).schema}
    out, doubles = [], {}
    for part, sql in needed.items():
        kind = kinds[part]
        if isinstance(kind, T.IntegralType):
            out.append(F.expr(sql).cast("bigint").alias(part))
        elif isinstance(kind, T.DecimalType):
            out.append(F.expr(sql).alias(part))
        elif isinstance(kind, T.FractionalType) and sql.startswith("sum(") and sql.endswith(")"):
            doubles[part] = F.expr(sql[4:-1])
        else:
            raise TypeError(f"{sql}: {kind.simpleString()} can't be added up exactly")
    return out + (X.digit_sums(df, doubles) if doubles else [])


def pool_parts(parts: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Add up parts over coarser keys."""
    wanted = dict.fromkeys(part for measure in measures for part in measure.parts)
    names = [name for part in wanted for name in X.parts_of(parts.columns, part)]
    return parts.groupBy(*keys).agg(*[F.sum(part).alias(part) for part in names])


def with_totals(parts: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Adds the sums over all groups that shares need: one aggregate that combines map-side, read as a scalar, so no task sees all groups."""
    wanted = dict.fromkeys(part for measure in measures if measure.whole for part in measure.parts)
    names = [name for part in wanted for name in X.parts_of(parts.columns, part)]
    if not names:
        return parts
    totals = parts.agg(F.struct(*[F.sum(name).alias(name) for name in names])).scalar()
    return parts.withColumn("_totals", totals).select("*", *[F.col(f"_totals.`{name}`").alias(over_all(name)) for name in names]).drop("_totals")


def finish(parts: DataFrame, keys: Sequence[str], measures: Sequence[Measure], min_rows: int | None = None) -> DataFrame:
    """Results from parts; ``min_rows`` keeps groups of at least that many rows."""
    if min_rows is not None:
        parts = parts.where(F.col("rows") >= min_rows)
    single = parts.columns
    parts = with_totals(parts, measures)
    kinds = {f.name: f.dataType for f in parts.schema}

    def by_digits(part: str) -> bool:
        kind = kinds.get(part)
        return X.is_split(single, part) or (isinstance(kind, T.DecimalType) and kind.scale > 6)

    def gathered(part: str, everywhere: bool = False) -> Column:
        renamed = over_all if everywhere else str
        return X.gathered(single, part, renamed) if X.is_split(single, part) else X.as_sum(F.col(renamed(part)))

    def result(measure: Measure) -> Column:
        return measure.exact(gathered) if measure.exact and any(map(by_digits, measure.parts)) else measure.finish()

    return parts.select(*keys, *[result(measure).alias(measure.name) for measure in measures])


def rate_by(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    where: Column | str | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """One row per key with the declared measures; without keys, one row for the whole table."""
    source = df if where is None else df.where(where)
    counted = [*measures, rows("rows")] if min_rows is not None else measures
    return finish(source.groupBy(*keys).agg(*part_aggregates(source, counted)), keys, measures, min_rows)


def parts_by_sets(df: DataFrame, key_sets: Mapping[str, Sequence[str]], measures: Sequence[Measure]) -> DataFrame:
    """Parts of several tables from one scan, as grouping sets; column ``table`` names the set.

    Rows expand in memory and combine map-side, so the scan is read once and the shuffle carries
    group rows only.
    """
    keys = list(dict.fromkeys(key for key_set in key_sets.values() for key in key_set))
    sets: dict[int, list[str]] = {}  # tables by the grouping id of their keys; tables may share keys
    for name, key_set in key_sets.items():
        absent = sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in key_set)
        sets.setdefault(absent, []).append(name)
    wanted = [[F.col(k) for i, k in enumerate(keys) if not absent >> (len(keys) - 1 - i) & 1] for absent in sets]
    grouped = df.groupingSets(wanted, *[F.col(k) for k in keys])
    parts = grouped.agg(F.grouping_id().alias("_set"), *part_aggregates(df, measures))
    names = F.create_map(*[F.lit(x).cast("bigint") if isinstance(x, int) else F.array(*[F.lit(n) for n in x]) for pair in sets.items() for x in pair])
    return parts.withColumn("table", F.explode(names[F.col("_set")])).drop("_set")


def top_n(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in the given order, kept per task before they meet."""
    return df.orderBy(*by).limit(n)
