"""Two versions of the encounter fact: as built, and with planted differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["encounter_id"]
COMPARED = ["encounter_id", "patient_nbr", "num_medications", "payer_code", "is_first_encounter", "score"]
SCORE = "num_lab_procedures / 3.0D"

# Dialect-neutral rules over a left row: what the right version holds.
RIGHT_KEEPS = "encounter_id % 1009 <> 5"
RIGHT_EXTRA = "encounter_id % 1013 = 7"
CHANGED = {
    "num_medications": "CASE WHEN encounter_id % 499 = 3 THEN num_medications + 1 ELSE num_medications END",
    "payer_code": "CASE WHEN encounter_id % 751 = 2 THEN NULL ELSE payer_code END",
    "score": "CASE WHEN encounter_id % 311 = 0 THEN score + 0.25 WHEN encounter_id % 2 = 0 THEN score * 1.000000001 ELSE score END",
}


def left_version(fact: DataFrame) -> DataFrame:
    return fact.withColumn("score", F.expr(SCORE)).select(*COMPARED)


def right_version(left: DataFrame) -> DataFrame:
    changed = left.where(RIGHT_KEEPS).selectExpr(*[f"{CHANGED[c]} AS {c}" if c in CHANGED else c for c in COMPARED])
    extra = left.where(RIGHT_EXTRA).withColumn("encounter_id", -F.col("encounter_id"))
    return changed.unionByName(extra)


def sql_versions() -> dict[str, str]:
    """The same two versions for the oracle."""
    columns = ", ".join(f"CAST(num_lab_procedures AS DOUBLE) / 3.0 AS {c}" if c == "score" else c for c in COMPARED)
    changed = ", ".join(f"CAST({CHANGED[c]} AS DOUBLE) AS {c}" if c == "score" else f"{CHANGED.get(c, c)} AS {c}" for c in COMPARED)
    extra = ", ".join("-encounter_id AS encounter_id" if c == "encounter_id" else c for c in COMPARED)
    return {
        "l": f"SELECT {columns} FROM fact",
        "r": f"SELECT {changed} FROM l WHERE {RIGHT_KEEPS} UNION ALL SELECT {extra} FROM l WHERE {RIGHT_EXTRA}",
    }
