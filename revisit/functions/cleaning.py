"""Cleaning rules as SQL expressions.

Each rule takes the SQL text of a value, usually a column name, and returns SQL text, so rules nest
and a wide table is one ``selectExpr``. All of them stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from revisit.sources.literals import sql_list, sql_literal

MISSING_MARKERS = ("?", "")


def null_if_marker(text: str, markers: Sequence[str] = MISSING_MARKERS) -> str:
    """Trimmed text, or NULL where it is one of the missing markers."""
    return f"CASE WHEN trim({text}) NOT IN {sql_list(markers)} THEN trim({text}) END"


def label_if_marker(text: str, label: str, markers: Sequence[str]) -> str:
    """Trimmed text, with the markers turned into a category. NULL stays NULL."""
    return f"CASE WHEN trim({text}) IN {sql_list(markers)} THEN {sql_literal(label)} ELSE trim({text}) END"


def keep_allowed(text: str, allowed: Iterable[str]) -> str:
    """Trimmed text where it belongs to the domain, else NULL."""
    return f"CASE WHEN trim({text}) IN {sql_list(allowed)} THEN trim({text}) END"


def relabel(text: str, names: Mapping[str, str]) -> str:
    """Replace whole values by their standard label; others pass through."""
    cases = " ".join(f"WHEN {sql_literal(old)} THEN {sql_literal(new)}" for old, new in names.items())
    return f"CASE {text} {cases} ELSE {text} END"


def strip_interval(text: str) -> str:
    """``[70-80)`` to ``70-80``."""
    return f"replace(replace({text}, '[', ''), ')', '')"


def interval(text: str) -> str:
    """As :func:`strip_interval`, but text that is not written ``[...)`` becomes NULL."""
    return f"CASE WHEN trim({text}) LIKE '[%)' THEN {strip_interval(f'trim({text})')} END"


def interval_middle(text: str, half_width: int) -> str:
    """Lower bound of ``low-high`` plus half the width; NULL where the bound is not a number."""
    return f"try_cast(substring_index({text}, '-', 1) AS INT) + {half_width}"


def whole_number(text: str, kind: str = "INT") -> str:
    """Tolerant cast: what is not a whole number becomes NULL."""
    return f"try_cast({text} AS {kind})"


def decimal_number(text: str) -> str:
    """Tolerant cast to DOUBLE. Text must end in a digit or a point: Spark would read ``1d`` as 1.0."""
    return f"CASE WHEN right(trim({text}), 1) BETWEEN '.' AND '9' THEN try_cast({text} AS DOUBLE) END"


def two_way_flag(text: str, yes: str, no: str) -> str:
    """1 for ``yes``, 0 for ``no``, NULL for anything else."""
    return f"CASE trim({text}) WHEN {sql_literal(yes)} THEN 1 WHEN {sql_literal(no)} THEN 0 END"


def flag(condition: str) -> str:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def band(value: str, bands: Sequence[tuple[int, str]], beyond: str) -> str:
    """Label of the first ``(upper bound, label)`` that holds the value. NULL falls into ``beyond``."""
    cases = " ".join(f"WHEN {value} <= {upper} THEN {sql_literal(label)}" for upper, label in bands)
    return f"CASE {cases} ELSE {sql_literal(beyond)} END"


def exact_band(value: str, values: Sequence[int], beyond: str) -> str:
    """The number as text for the listed values, ``beyond`` for all others and NULL."""
    return f"CASE WHEN {value} IN {sql_list(values)} THEN CAST({value} AS STRING) ELSE {sql_literal(beyond)} END"


def tail_band(value: str, top: int) -> str:
    """The number as text, with ``top`` and more pooled as ``'<top>+'``. NULL stays NULL."""
    return f"CASE WHEN {value} >= {top} THEN '{top}+' ELSE CAST({value} AS STRING) END"


@dataclass(frozen=True)
class CodeRange:
    """Codes in ``[low, high)``, plus every code whose whole part equals ``symptom``."""

    label: str
    low: int
    high: int
    symptom: int | None = None


def code_group(
    code: str,
    number: str,
    prefixes: Sequence[tuple[str, str]],
    ranges: Sequence[CodeRange],
    missing: str,
    other: str,
) -> str:
    """Group of a code: missing, then text prefixes, then ranges of its number; the first match wins."""
    cases = [f"WHEN {code} IS NULL THEN {sql_literal(missing)}"]
    cases += [f"WHEN startswith({code}, {sql_literal(p)}) THEN {sql_literal(label)}" for p, label in prefixes]
    for rule in ranges:
        symptom = "" if rule.symptom is None else f" OR floor({number}) = {rule.symptom}"
        cases.append(f"WHEN {number} >= {rule.low} AND {number} < {rule.high}{symptom} THEN {sql_literal(rule.label)}")
    return f"CASE {' '.join(cases)} ELSE {sql_literal(other)} END"


def count_in(columns: Iterable[str], values: Sequence[str]) -> str:
    """How many of the columns hold one of the values; NULL counts as no."""
    return " + ".join(flag(f"{column} IN {sql_list(values)}") for column in columns)


def pack(columns: Iterable[str], letters: Mapping[str, str], absent: str = "-") -> str:
    """Many columns over one small domain as one text, a letter per column; anything else is ``absent``."""
    cases = " ".join(f"WHEN {sql_literal(value)} THEN '{letter}'" for value, letter in letters.items())
    return "concat(" + ", ".join(f"CASE trim({column}) {cases} ELSE '{absent}' END" for column in columns) + ")"


def unpack(packed: str, position: int, letters: Mapping[str, str]) -> str:
    """The value at a position (from 1) of packed text, or NULL."""
    cases = " ".join(f"WHEN '{letter}' THEN {sql_literal(value)}" for value, letter in letters.items())
    return f"CASE substring({packed}, {position}, 1) {cases} END"


def count_packed(packed: str, values: Sequence[str], letters: Mapping[str, str], absent: str = "-") -> str:
    """How many packed columns hold one of the values."""
    others = [absent, *[letter for value, letter in letters.items() if value not in values]]
    kept = packed
    for letter in others:
        kept = f"replace({kept}, '{letter}', '')"
    return f"length({kept})"


def id_group(identifier: str, groups: Mapping[str, Sequence[int]], other: str) -> str:
    """Label of the id set that holds the id."""
    cases = " ".join(f"WHEN {identifier} IN {sql_list(ids)} THEN {sql_literal(label)}" for label, ids in groups.items())
    return f"CASE {cases} ELSE {sql_literal(other)} END"
