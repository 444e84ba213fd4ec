"""Hand-written raw encounters: a clean base row and what each case changes."""

from pyspark.sql import DataFrame, SparkSession

from revisit.plans import vocabulary as V
from revisit.sources.readers import text_schema

STAGED = [c for c in V.RAW_COLUMNS if c not in V.HYPHENATED] + list(V.HYPHENATED.values())
BASE = {
    "race": "Caucasian", "gender": "Female", "age": "[70-80)", "weight": "?", "admission_type_id": "1",
    "discharge_disposition_id": "1", "admission_source_id": "7", "time_in_hospital": "3", "payer_code": "MC",
    "medical_specialty": "Cardiology", "num_lab_procedures": "40", "num_procedures": "1", "num_medications": "10",
    "number_outpatient": "0", "number_emergency": "0", "number_inpatient": "0", "diag_1": "428", "diag_2": "250.01",
    "diag_3": "V27", "number_diagnoses": "5", "max_glu_serum": "None", "A1Cresult": "None", "change": "No",
    "diabetesMed": "Yes", "readmitted": "NO",
} | {name: "No" for name in V.DRUG_NAMES}


def staged(spark: SparkSession, cases: list[dict]) -> DataFrame:
    rows = []
    for i, case in enumerate(cases, start=1):
        row = {"encounter_id": str(i), "patient_nbr": str(1000 + i)} | BASE | case
        rows.append(tuple(row[c] for c in STAGED))
    return spark.createDataFrame(rows, text_schema(STAGED))


def lookups(spark: SparkSession) -> DataFrame:
    pairs = [(str(i), text) for rows in (V.ADMISSION_TYPES, V.DISCHARGES, V.ADMISSION_SOURCES) for i, text in rows]
    return spark.createDataFrame([*pairs, (None, None), ("admission_source_id", "description")], text_schema(V.LOOKUP_COLUMNS))
