"""Compare two versions of a table: row counts and cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisit.operators.keys import surrogate_key
from revisit.operators.quality import union_all
from revisit.session import fresh_folder, write_table


def reconcile_counts(left: Mapping[str, DataFrame], right: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, left_rows, right_rows, is_match)`` for every table of both sides."""

    def counts(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
        return union_all(
            [df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias("table_name"), name) for t, df in tables.items()]
        )

    both = counts(left, "left_rows").join(counts(right, "right_rows"), "table_name", "full")
    return both.select(
        "table_name", "left_rows", "right_rows", F.col("left_rows").eqNullSafe(F.col("right_rows")).alias("is_match")
    )


def all_counts_match(counts: DataFrame) -> DataFrame:
    return counts.agg(F.every("is_match").alias("all_match"))


#: A number as text. Casts also read suffixes and names (1d, 1f, NaN, Infinity), which are text here.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _plain(value: Column, kind: T.DataType) -> Column:
    """Nested values and bytes as text, so that they can be ordered and compared; a map's entries in order."""
    if isinstance(kind, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(value)))
    if isinstance(kind, (T.ArrayType, T.StructType, T.VariantType)):
        return F.to_json(value)
    return F.hex(value) if isinstance(kind, T.BinaryType) else value


def _plain_kind(kind: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(kind, (T.MapType, T.ArrayType, T.StructType, T.VariantType, T.BinaryType)) else kind


def _number(value: Column, kind: T.DataType) -> Column | None:
    """A number, or text that is written as one; None for other types."""
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.StringType):
        return F.when(value.rlike(NUMBER_TEXT), F.trim(value).try_cast("double"))
    return None


def _same(left: Column, right: Column, kinds: tuple[T.DataType, T.DataType], tolerance: float) -> Column:
    """Both NULL, numbers within the tolerance where both sides are or read as numbers, or the same text."""
    same = left.cast("string").eqNullSafe(right.cast("string"))
    if kinds[0] == kinds[1] and not isinstance(kinds[0], (T.StringType, T.FractionalType)):
        same = left.eqNullSafe(right)
    x, y = _number(left, kinds[0]), _number(right, kinds[1])
    if x is None or y is None:
        return same
    near = F.abs(x - y) <= tolerance * F.greatest(F.lit(1.0), F.abs(y))
    return same | F.coalesce(near & ~F.isnan(x) & ~F.isnan(y), F.lit(False))


def compare_rows(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key of either side: row counts and the values of both sides as structs.

    Both sides meet in one aggregate instead of a full join. It combines map-side, so copies of a
    key collapse before the shuffle and can never pair up with each other. A key is expected once
    per side; the counts show where it is not, and then the smallest row of each side is compared.
    """
    kinds = dict(left.dtypes)

    def side(df: DataFrame, mark: int) -> DataFrame:
        keys = [F.col(k) if dict(df.dtypes)[k] == kinds[k] else F.col(k).try_cast(kinds[k]).alias(k) for k in key]
        own = {f.name: f.dataType for f in df.schema}
        values = [_plain(F.col(f"`{c}`"), own[c]).alias(c) for c in _values(df, key)]
        return df.select(*keys, F.lit(mark).alias("_side"), F.struct(*values).alias(f"_row{mark}"))

    def of(mark: int, column: Column) -> Column:
        return F.when(F.col("_side") == mark, column)

    tagged = side(left, 0).unionByName(side(right, 1), allowMissingColumns=True)
    return tagged.groupBy(*key).agg(
        F.count(of(0, F.lit(1))).alias("left_rows"),
        F.count(of(1, F.lit(1))).alias("right_rows"),
        F.min("_row0").alias("left_row"),
        F.min("_row1").alias("right_row"),
    )


def _values(df: DataFrame, key: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in key]


def one_sided(left: DataFrame, right: DataFrame, key: Sequence[str]) -> dict[str, str]:
    """Columns that one side alone has, with the problem this is."""
    a, b = _values(left, key), _values(right, key)
    return {c: "column_missing_right" for c in a if c not in b} | {c: "column_missing_left" for c in b if c not in a}


IN_BOTH = "left_rows > 0 AND right_rows > 0"
PROBLEMS = {
    "missing_left": "left_rows = 0",
    "missing_right": "right_rows = 0",
    "repeated_key": "left_rows > 1 OR right_rows > 1",
}


def _cell_tests(left: DataFrame, right: DataFrame, key: Sequence[str], tolerance: float) -> dict[str, Column]:
    """Per column: do the two rows of a key differ in it?"""
    kinds = [{f.name: _plain_kind(f.dataType) for f in df.schema} for df in (left, right)]
    return {
        c: F.expr(IN_BOTH)
        & ~_same(F.col("left_row")[c], F.col("right_row")[c], (kinds[0][c], kinds[1][c]), tolerance)
        for c in _values(left, key)
        if c in right.columns
    }


def cell_differences(left: DataFrame, right: DataFrame, key: Sequence[str], tolerance: float = 1e-6) -> DataFrame:
    """Every difference: ``(key…, column_name, left_value, right_value, problem)``.

    Problems are ``missing_left``, ``missing_right``, ``repeated_key`` (one row per key, with the two
    row counts as values), ``value`` (one row per differing cell), ``column_missing_left`` and
    ``column_missing_right`` (one row without a key per column). Numbers, and text written as one, are equal
    within ``tolerance * max(1, |right|)``; two NULLs or NaNs are equal. Values of one other type are compared as they
    are, nested ones as JSON and bytes as hex digits; values of two types compare as text.
    """
    nothing = F.lit(None).cast("string")

    def entry(name: Column, x: Column, y: Column, problem: str) -> Column:
        return F.struct(
            name.alias("column_name"),
            x.cast("string").alias("left_value"),
            y.cast("string").alias("right_value"),
            F.lit(problem).alias("problem"),
        )

    found = [
        F.when(differs, entry(F.lit(c), F.col("left_row")[c], F.col("right_row")[c], "value"))
        for c, differs in _cell_tests(left, right, key, tolerance).items()
    ]
    for problem, condition in PROBLEMS.items():
        counts = (F.col("left_rows"), F.col("right_rows")) if problem == "repeated_key" else (nothing, nothing)
        found.append(F.when(F.expr(condition), entry(nothing, *counts, problem)))
    rows = compare_rows(left, right, key)
    cells = rows.select(*key, F.inline(F.array_compact(F.array(*found))))
    columns = [
        left.sparkSession.range(1).select(*[F.lit(None).cast(dict(left.dtypes)[k]).alias(k) for k in key], F.inline(F.array(entry(F.lit(c), nothing, nothing, problem))))
        for c, problem in one_sided(left, right, key).items()
    ]
    return union_all([cells, *columns]) if columns else cells


def first_differences(differences: DataFrame, key: Sequence[str], n: int = 50) -> DataFrame:
    """The first ``n`` differences by key and column, for reading."""
    return differences.orderBy(*key, F.col("column_name").asc_nulls_first(), "problem").limit(n)


def reconcile_cells(
    left: Mapping[str, DataFrame], right: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], tolerance: float = 1e-6
) -> DataFrame:
    """Per table: rows on both sides and the number of differing cells, missing rows and repeated keys."""

    def summary(name: str) -> DataFrame:
        tests = _cell_tests(left[name], right[name], keys[name], tolerance)
        differing = reduce(add, [F.when(differs, 1).otherwise(0) for differs in tests.values()], F.lit(0))
        alone = len(one_sided(left[name], right[name], keys[name]))  # a column of one side counts once
        number = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast("bigint")
        return compare_rows(left[name], right[name], keys[name]).agg(
            F.lit(name).alias("table_name"),
            number("left_rows").alias("left_rows"),
            number("right_rows").alias("right_rows"),
            (number(differing) + F.lit(alone)).cast("bigint").alias("cell_diffs"),
            *[F.count_if(F.expr(condition)).alias(problem) for problem, condition in PROBLEMS.items()],
        )

    return union_all([summary(name) for name in keys])


def row_surplus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other: the columns of both, ``left_copies`` and ``right_copies``.

    The exact difference of two bags of rows, wherever their rows stand. Rows are told apart by a SHA-256 of
    their values (with their lengths), which is what is grouped by: copies collapse map-side, and one aggregate
    sees both sides. Columns that one side alone has play no part. NULLs are equal; 0 and -0 are, too.
    """
    kinds = [{f.name: f.dataType for f in df.schema} for df in (left, right)]
    common = [c for c in left.columns if c in kinds[1]]

    def value(c: str, mark: int) -> Column:
        """In a type that both sides share: their own, double for two kinds of numbers, else text."""
        own, other = _plain_kind(kinds[mark][c]), _plain_kind(kinds[1 - mark][c])
        plain = _plain(F.col(f"`{c}`"), kinds[mark][c])
        if own != other:
            plain = plain.cast("double" if isinstance(own, T.NumericType) and isinstance(other, T.NumericType) else "string")
        fractional = isinstance(own, T.NumericType) and isinstance(other, T.NumericType) and (own != other or isinstance(own, T.FractionalType))
        return (F.when(plain == 0, F.abs(plain)).otherwise(plain) if fractional else plain).alias(c)

    def side(df: DataFrame, mark: int) -> DataFrame:
        rows = df.select([value(c, mark) for c in common])
        texts = [F.col(f"`{c}`").cast("string") for c in common]
        encoded = F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(x), F.lit(":"), x), F.lit("-")) for x in texts])
        return rows.select(F.sha2(encoded.cast("binary"), 256).alias("_print"), F.lit(1 - 2 * mark).alias("_sign"), F.struct([F.col(f"`{c}`") for c in common]).alias("_row"))

    both = side(left, 0).unionByName(side(right, 1))
    counted = both.groupBy("_print").agg(F.sum("_sign").alias("_more"), F.first("_row").alias("_row")).where("_more != 0")
    return counted.select("_row.*", F.greatest("_more", F.lit(0)).alias("left_copies"), F.greatest(-F.col("_more"), F.lit(0)).alias("right_copies"))


def differences_without_key(left: DataFrame, right: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Cells that differ between tables without a key: ``(pair, column_name, left_value, right_value, problem)``.

    Rows that both sides have equally often drop out first, so a moved row is no difference. What is left of each
    side is ordered by all columns and paired by position; problems are as in :func:`cell_differences`, and rows
    that find no partner are ``missing_left`` or ``missing_right``. Pairs within the tolerance are equal.
    """
    folder = fresh_folder(left.sparkSession)
    surplus = write_table(row_surplus(left, right), folder)
    columns = [c for c in surplus.columns if c not in ("left_copies", "right_copies")]

    def numbered(copies: str) -> DataFrame:
        own = surplus.where(F.col(copies) > 0).select(*columns, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias("_copy"))
        return surrogate_key(own, "pair", columns, "bigint").drop("_copy")

    return cell_differences(numbered("left_copies"), numbered("right_copies"), ["pair"], tolerance)
