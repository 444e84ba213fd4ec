"""Exact interpolated quantiles and outlier fences for columns of any numeric type.

Short whole numbers are counted by value in one job. Other types are found by radix selection: a value has a
key of 64-bit whole numbers in the same order, and each level counts 16 bits of it among the rows that agree
with a wanted rank in the bits before. Counts are combined map-side, so what is shuffled is at most 65,536
rows per task and wanted rank. Levels end as soon as few enough rows are left.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BITS = 16


SHORT = ("integer", "short", "byte")


def _rank_values(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """``(name, p, place, end, value)``: the values at the ranks just below and above each wanted place."""
    kinds = [f.dataType for f in df.select(*columns).schema.fields]
    other = [c for c, kind in zip(columns, kinds) if not isinstance(kind, T.NumericType)]
    if other:
        raise TypeError(f"quantiles need numbers, got {other}")
    if all(kind.typeName() in SHORT for kind in kinds):
        return _counted_values(df, columns, probabilities)
    return _selected_values(df, columns, kinds, probabilities)


def with_keys(df: DataFrame, columns: Sequence[str], kinds: Sequence[T.DataType]) -> tuple[DataFrame, list[list[str]]]:
    """The columns with whole numbers of 64 bits that stand in the order of their values, and these numbers' names.

    Wide decimals have several, one after the other. 0 and -0 are equal. What is used more than once is a
    column of its own, so that it is worked out once per row.
    """
    two_to = lambda n: F.pow(F.lit(2.0), n)  # noqa: E731 - exact for whole numbers
    infinite = F.lit(float("inf"))
    keys: list[list[Column]] = []
    sizes, guesses, exponents = {}, {}, {}
    for i, (name, kind) in enumerate(zip(columns, kinds)):
        x = F.col(name)
        if isinstance(kind, T.DecimalType):
            parts, rest = [], x.cast(f"decimal(38,{kind.scale})")
            for digits in (36, 18, 0):
                if kind.precision > digits:
                    unit = F.lit(Decimal(1).scaleb(digits - kind.scale)).cast(f"decimal(38,{kind.scale})")
                    parts.append(F.call_function("div", rest, unit))
                    rest = rest % unit
            keys.append(parts)
        elif isinstance(kind, T.IntegralType):
            keys.append([x.cast("bigint")])
        else:
            size, finite, guess, exponent = (F.col(f"_{part}{i}") for part in ("size", "finite", "guess", "exponent"))
            sizes |= {f"_size{i}": F.abs(x.cast("double")), f"_finite{i}": F.when(F.abs(x.cast("double")) < infinite, F.abs(x.cast("double"))).otherwise(F.lit(1.0))}
            guesses[f"_guess{i}"] = F.floor(F.log2(F.when(finite > 0, finite).otherwise(F.lit(1.0)))).cast("int")
            exponents[f"_exponent{i}"] = guess + F.when(two_to(guess) > finite, -1).when((guess < 1023) & (two_to(guess + 1) <= finite), 1).otherwise(0)
            normal = ((exponent + 1023).cast("bigint") * (1 << 52)) + ((finite / two_to(exponent) - 1) * float(1 << 52)).cast("bigint")
            tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")  # below 2**-1022 there is no exponent left
            key = F.when(size < F.lit(2.0**-1022), tiny).when(size < infinite, normal).otherwise(F.lit(2047 << 52))
            keys.append([F.when(F.isnan(size), F.lit((2048 << 52) - 1)).otherwise(key * F.when(x < 0, -1).otherwise(1))])
    named = [[f"_key{i}_{j}" for j in range(len(parts))] for i, parts in enumerate(keys)]
    out = df.select(*columns)
    for step in (sizes, guesses, exponents):
        out = out.withColumns(step) if step else out
    wide = {name: key for names, parts in zip(named, keys) for name, key in zip(names, parts)}
    return out.select(*columns, *[key.alias(name) for name, key in wide.items()]), named


def _digit(key: Column, j: int) -> Column:
    """The j-th 16 bits of a key, from the top; the top ones have its sign."""
    part = F.shiftright(key, 48 - 16 * j)
    return (part if j == 0 else part.bitwiseAND(F.lit(0xFFFF))).cast("int")


def _selected_values(df: DataFrame, columns: Sequence[str], kinds: Sequence[T.DataType], probabilities: Sequence[float]) -> DataFrame:
    """The same by radix selection; a job per level, of which a row per wanted rank comes to the driver."""
    spark = df.sparkSession
    keyed, names = with_keys(df, columns, kinds)
    deepest = max(map(len, names))
    levels = 4 * deepest
    cells = [
        F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("value"), *[(F.col(own[j]) if j < len(own) else F.lit(0).cast("bigint")).alias(f"k{j}") for j in range(deepest)])
        for i, (c, own) in enumerate(zip(columns, names))
    ]
    rows = keyed.select(F.inline(F.array(*cells))).where("value IS NOT NULL")
    rows = rows.select("c", "value", *[_digit(F.col(f"k{j // 4}"), j % 4).alias(f"d{j}") for j in range(levels)])

    def inside(prefixes: dict[tuple[int, ...], int], level: int) -> DataFrame:
        """The rows of any of the prefixes, with its number: a row per wanted rank at most is broadcast."""
        names = ["c", *[f"d{j}" for j in range(level)]]
        known = spark.createDataFrame([(*prefix, i) for prefix, i in prefixes.items()], ", ".join(f"{n} int" for n in [*names, "prefix"]))
        return rows.join(F.broadcast(known), names)

    def located(counts: DataFrame, by: str, wanted: list[tuple]) -> dict[int, tuple]:
        """For each wanted rank the group it falls in: its value of ``by``, the rows before it, and its rows."""
        up_to = W.partitionBy("prefix").orderBy(by)
        counts = counts.withColumn("through", F.sum("n").over(up_to)).withColumn("before", F.col("through") - F.col("n"))
        asked = spark.createDataFrame([(i, prefix, rank) for i, (prefix, rank) in enumerate(wanted)], "want int, of int, rank bigint")
        found = counts.join(F.broadcast(asked), (F.col("prefix") == F.col("of")) & (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("through")))
        return {r["want"]: (r[by], r["before"], r["n"]) for r in found.select("want", by, "before", "n").collect()}

    totals = {r["c"]: r["n"] for r in rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranks = []  # column, probability, place, end, rank among the rows of its prefix, prefix
    for c, total in totals.items():
        for p in map(float, probabilities):
            place = p * (total - 1)
            ranks += [(c, p, place, end, int(rank), (c,)) for end, rank in (("low", math.floor(place)), ("high", math.ceil(place)))]
    level, most = 0, max(totals.values(), default=0)
    while level < levels and most > 1 << BLOCK_BITS:
        prefixes = {prefix: i for i, prefix in enumerate(dict.fromkeys(r[-1] for r in ranks))}
        counts = inside(prefixes, level).groupBy("prefix", f"d{level}").agg(F.count(F.lit(1)).alias("n"))
        found = located(counts, f"d{level}", [(prefixes[r[-1]], r[-2]) for r in ranks])
        ranks = [(*r[:-2], r[-2] - found[i][1], (*r[-1], found[i][0])) for i, r in enumerate(ranks)]
        level, most = level + 1, max(n for _, _, n in found.values())
    out = []
    if ranks:
        prefixes = {prefix: i for i, prefix in enumerate(dict.fromkeys(r[-1] for r in ranks))}
        counts = inside(prefixes, level).groupBy("prefix", "value").agg(F.count(F.lit(1)).alias("n"))
        found = located(counts, "value", [(prefixes[r[-1]], r[-2]) for r in ranks])
        whole = [isinstance(kind, T.IntegralType) for kind in kinds]
        out = [(columns[c], p, place, end, found[i][0], whole[c]) for i, (c, p, place, end, _, _) in enumerate(ranks)]
    return spark.createDataFrame(out, "name string, p double, place double, end string, value double, whole boolean")


def _counted_values(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    counts = (
        df.select(*[F.col(c).cast("int").alias(c) for c in columns])
        .unpivot([], list(columns), "name", "value")
        .where("value IS NOT NULL")
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("block", F.shiftright("value", BLOCK_BITS))
    )
    blocks = counts.groupBy("name", "block").agg(F.sum("n").alias("n"))
    up_to = W.partitionBy("name").orderBy("block")
    blocks = blocks.select(
        "name",
        "block",
        (F.sum("n").over(up_to) - F.col("n")).alias("before"),
        F.sum("n").over(up_to).alias("through"),
        F.sum("n").over(W.partitionBy("name")).alias("total"),
    )
    places = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p")
    wanted = (
        blocks.select("*", places)
        .withColumn("place", F.expr("p * (total - 1)"))
        .selectExpr("*", "inline(array(struct('low' AS end, floor(place) AS rank), struct('high' AS end, ceil(place) AS rank)))")
        .where("rank >= before AND rank < through")
        .select("name", "block", "before", "p", "place", "end", "rank")
    )
    # Two ranks per column and probability: a handful of rows.
    inside = counts.join(F.broadcast(wanted), ["name", "block"])
    running = F.sum("n").over(W.partitionBy("name", "p", "end").orderBy("value")) + F.col("before")
    return inside.withColumn("running", running).where("rank < running AND rank >= running - n").withColumn("whole", F.lit(True))


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """``(name, p, value)``: linearly interpolated quantiles, NULL ignored and NaN above all numbers.

    Columns of 32-bit whole numbers shrink to one count per distinct value. Values are pooled in blocks of
    65,536; the block that holds a wanted rank is found first, then the value inside it. With any other type among the
    columns, all are found by radix selection. No task therefore orders more than 65,536 rows per
    column and wanted rank, whatever the number of distinct values. Interpolation is between doubles.
    """
    ends = _rank_values(df, columns, probabilities)
    return ends.groupBy("name", "p").agg(_between(F.lit(True)).alias("value"))


def _between(condition: Column) -> Column:
    """Interpolation between the two rank values of the rows that meet the condition."""
    low = F.max(F.when(condition & (F.col("end") == "low"), F.col("value")))
    high = F.max(F.when(condition & (F.col("end") == "high"), F.col("value")))
    place = F.max(F.when(condition, F.col("place")))
    above = place - F.floor(place)
    # between doubles, weighted ends neither overflow nor make NaN of two equal infinities
    weighted = F.when(low == high, low.cast("double")).otherwise(low * (1 - above) + high * above)
    return F.when(F.max(F.when(condition, F.col("whole"))), low + (high - low) * above).otherwise(weighted)


def approximate_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """As :func:`quantiles` from mergeable sketches, for any numeric type; returns values that occur."""
    sketch = [F.percentile_approx(c, [float(p) for p in probabilities], 10_000).alias(c) for c in columns]
    rows = df.agg(*sketch)
    cells = [
        F.struct(F.lit(c).alias("name"), F.lit(float(p)).alias("p"), F.col(c)[i].cast("double").alias("value"))
        for c in columns
        for i, p in enumerate(probabilities)
    ]
    return rows.select(F.inline(F.array(*cells)))


def upper_fences(df: DataFrame, columns: Sequence[str], reach: float = 3.0, exact: bool = True) -> DataFrame:
    """One row: for each column ``q1``, ``q3`` and the fence ``q3 + reach * (q3 - q1)``."""
    quarters = {"q1": 0.25, "q3": 0.75}
    find = _rank_values if exact else approximate_quantiles
    long = find(df, columns, list(quarters.values()))

    def quarter(column: str, p: float) -> Column:
        own = (F.col("name") == column) & (F.col("p") == p)
        return _between(own) if exact else F.max(F.when(own, F.col("value")))

    row = long.agg(*[quarter(c, p).alias(f"{c}_{q}") for c in columns for q, p in quarters.items()])
    return row.selectExpr("*", *[f"{c}_q3 + {reach} * ({c}_q3 - {c}_q1) AS {c}_fence" for c in columns])
