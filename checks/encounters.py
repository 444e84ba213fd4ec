"""Dirty raw encounters derived from ``orders``, and a second version of tables with planted differences.

One raw row per order plus duplicates. The column rules are expressions that Spark SQL and DuckDB
read the same way, so both engines start from the same text. Everything after this point is computed
independently on each side.
"""

from __future__ import annotations

from revisit.plans import vocabulary as V

PATIENT = (
    "CASE WHEN k % 211 = 0 OR k % 485 = 0 THEN '?' WHEN k % 4 = 0 THEN CAST(10000000 + k AS STRING) "
    "WHEN k % 4 = 1 THEN CAST(20000000 + (k - k % 12) AS STRING) ELSE CAST(c AS STRING) END"
)


def pick(number: str, values: list[str], otherwise: str | None = None) -> str:
    """``values[number]`` as CASE."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {number} {cases} ELSE {'NULL' if otherwise is None else otherwise} END"


def _code(j: int) -> str:
    n = f"((k + {j}) % 50)"
    return (
        f"CASE WHEN {n} = 0 THEN '?' WHEN {n} = 1 THEN 'V45' WHEN {n} = 2 THEN 'E909' "
        f"WHEN {n} <= 6 THEN concat('250.', CAST((k + {j}) % 93 AS STRING)) WHEN {n} = 7 THEN ' ? ' "
        f"WHEN {n} = 8 THEN concat(CAST(785 + (k % 5) AS STRING), '.5') "
        f"ELSE CAST(1 + (7919 * (k + {j})) % 999 AS STRING) END"
    )


def _drug(i: int) -> str:
    n = f"((k * {i + 3} + c) % {20 + 10 * i})"
    return (
        f"CASE WHEN {n} = 0 THEN 'Up' WHEN {n} = 1 THEN 'Down' WHEN {n} <= 3 THEN 'Steady' "
        f"WHEN {n} = 4 AND k % 13 = 0 THEN '?' ELSE 'No' END"
    )


def raw_rules() -> dict[str, str]:
    """Raw column -> expression over ``k`` (order key), ``c`` (customer key) and ``patient``."""
    rules = {
        "encounter_id": "CAST(k + 1 AS STRING)",
        "patient_nbr": "patient",
        "race": pick("(7 * k + 3) % 8", ["Caucasian", "AfricanAmerican", "?", "Asian", " Hispanic ", "Other", "Caucasian", " ? "]),
        "gender": "CASE WHEN k % 499 = 0 THEN 'Unknown/Invalid' WHEN c % 2 = 0 THEN 'Female' ELSE ' Male' END",
        "age": (
            "CASE WHEN k % 811 = 0 THEN '70-80' "
            "ELSE concat('[', CAST(10 * (c % 10) AS STRING), '-', CAST(10 * (c % 10) + 10 AS STRING), ')') END"
        ),
        "weight": "CASE WHEN k % 32 = 0 THEN concat('[', CAST(25 * (c % 8) AS STRING), '-', CAST(25 * (c % 8) + 25 AS STRING), ')') ELSE '?' END",
        "admission_type_id": "CAST(1 + (5 * k) % 8 AS STRING)",
        "discharge_disposition_id": "CASE WHEN k % 941 = 0 THEN '31' ELSE CAST(1 + (13 * k) % 30 AS STRING) END",
        "admission_source_id": "CASE WHEN (11 * k) % 26 = 15 THEN '17' ELSE CAST(1 + (11 * k) % 26 AS STRING) END",
        "time_in_hospital": "CASE WHEN k % 1201 = 0 THEN 'x' ELSE CAST(1 + (3 * k + c) % 15 AS STRING) END",
        "payer_code": pick("(7 * k + 3) % 5", ["MC", "?", "HM", " SP", "?"]),
        "medical_specialty": pick("(7 * k + 3) % 6", ["Cardiology", "?", "?", "InternalMedicine", "Surgery-General"]),
        "num_lab_procedures": "CASE WHEN k % 509 = 0 THEN '700' ELSE CAST(1 + (17 * k) % 98 AS STRING) END",
        "num_procedures": "CASE WHEN k % 1009 = 0 THEN 'abc' ELSE CAST(k % 7 AS STRING) END",
        "num_medications": (
            "CASE WHEN k % 101 = 0 THEN '200' WHEN k % 1303 = 5 THEN 'abc' ELSE CAST(1 + (k * k) % 37 AS STRING) END"
        ),
        "number_outpatient": "CASE WHEN k % 701 = 0 THEN 'n/a' ELSE CAST(k % 5 AS STRING) END",
        "number_emergency": "CAST(k % 3 AS STRING)",
        "number_inpatient": "CASE WHEN k % 907 = 0 THEN NULL ELSE CAST((k * k + c) % 6 AS STRING) END",
        "diag_1": _code(0),
        "diag_2": _code(1),
        "diag_3": _code(2),
        "number_diagnoses": "CAST(1 + k % 16 AS STRING)",
        "max_glu_serum": pick("(5 * k + c) % 7", ["None", "None", "Norm", ">200", ">300", " None ", "?"]),
        "A1Cresult": pick("(3 * k + c) % 6", ["None", "None", "Norm", ">7", ">8"], "'None'"),
    }
    rules |= {name: _drug(i) for i, name in enumerate(V.RAW_DRUG_COLUMNS)}
    rules["change"] = "CASE WHEN k % 613 = 0 THEN 'Maybe' WHEN (k + c) % 2 = 0 THEN 'Ch' ELSE 'No' END"
    rules["diabetesMed"] = "CASE WHEN (k + 2 * c) % 4 = 0 THEN 'No' ELSE ' Yes' END"
    rules["readmitted"] = "CASE WHEN (31 * k + c) % 9 = 0 THEN '<30' WHEN (31 * k + c) % 9 <= 4 THEN '>30' ELSE 'NO' END"
    return {name: rules[name] for name in V.RAW_COLUMNS}


def raw_sql(rename: bool = False) -> str:
    """All raw rows from ``orders``: every order once, and a second copy of some under another patient."""
    columns = ", ".join(
        f"{rule} AS {name.replace('-', '_') if rename else chr(96) + name + chr(96)}" for name, rule in raw_rules().items()
    )
    return f"""SELECT {columns} FROM (
  SELECT k, c, {PATIENT} AS patient FROM (SELECT o_orderkey AS k, o_custkey AS c FROM orders) o
  UNION ALL
  SELECT k, c, CAST(c + 1 AS STRING) AS patient FROM (SELECT o_orderkey AS k, o_custkey AS c FROM orders) d WHERE k % 97 = 0
) s"""


def lookup_lines() -> list[str]:
    """The stacked lookup file as text lines: three sections, separators and repeated headers.

    Some descriptions carry a leading blank, and one contains quoted commas, as in real files.
    """
    sections = [
        ("admission_type_id", V.ADMISSION_TYPES),
        ("discharge_disposition_id", V.DISCHARGES),
        ("admission_source_id", V.ADMISSION_SOURCES),
    ]
    lines: list[str] = []
    for header, rows in sections:
        lines += [","] if lines else []
        lines.append(f"{header},description")
        for key, text in rows:
            padded = f" {text}" if header == "admission_source_id" and key % 2 else text
            lines.append(f'{key},"{padded}"' if "," in padded else f"{key},{padded}")
    return lines
