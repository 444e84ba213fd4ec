"""Data-quality tables: row counts, missing rates, issues, assertions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisit.functions.rounding import percent
from revisit.operators.quality import absent_rows, count_if, filled, orphan_rows, row_count, union_all, with_status
from revisit.operators.reshape import rows_of
from revisit.plans import vocabulary as V

Tables = Mapping[str, DataFrame]

# Entity and grain of the row-count ledger, by table.
GRAINS = {
    "cln_encounter_medications": ("encounter_medications", "encounter x prescribed drug"),
    "fact_encounter": ("fact_encounter", "encounter"),
    "fact_encounter_medication": ("fact_encounter_medication", "encounter x drug"),
    "dim_patient": ("dim_patient", "patient_nbr"),
    "dim_age_group": ("dim_age_group", "age decade"),
    "dim_diagnosis_group": ("dim_diagnosis_group", "ICD-9 group"),
    "dim_admission_type": ("dim_admission_type", "admission_type_id"),
    "dim_discharge_disposition": ("dim_discharge_disposition", "discharge_disposition_id"),
    "dim_admission_source": ("dim_admission_source", "admission_source_id"),
    "dim_medication": ("dim_medication", "drug"),
}

# Raw column, its missing marker, clean column, what replaces it there, treatment.
MISSING_RULES = [
    ("weight", "?", "weight_band", None, "kept as NULL (97% missing - not used for analysis)"),
    ("payer_code", "?", "payer_code", None, "kept as NULL"),
    ("medical_specialty", "?", "medical_specialty", None, "kept as NULL"),
    ("race", "?", "race", None, "kept as NULL"),
    ("diag_1", "?", "diag_1", None, "NULL -> diagnosis group Missing"),
    ("A1Cresult", "None", "a1c_result", V.NOT_MEASURED, "'None' means test not done -> category Not measured"),
]


def raw_counts(tables: Tables) -> DataFrame:
    """One row about the staged encounters. Two ledgers need it, and its distinct count shuffles every key."""
    staged = tables["stg_encounters"]
    counts = staged.agg(F.count(F.lit(1)).alias("raw_rows"), filled(count_if(~F.col("gender").isin(*V.GENDERS))).alias("bad_gender"))
    return counts.select("raw_rows", distinct_values(staged, "encounter_id").alias("distinct_keys"), "bad_gender")


def distinct_values(df: DataFrame, column: str) -> Column:
    """The number of distinct values, by itself: keys are mostly unique, so nothing else should travel with them."""
    return df.agg(F.count_distinct(column)).scalar()


def row_counts(tables: Tables, raw: DataFrame | None = None) -> DataFrame:
    """Rows per table, with raw rows and distinct raw keys for the encounters."""
    raw = raw_counts(tables) if raw is None else raw
    first = raw.select(
        F.lit("encounters").alias("entity"),
        "raw_rows",
        "distinct_keys",
        row_count(tables["cln_encounters"]).scalar().alias("clean_rows"),
        F.lit("encounter_id").alias("grain"),
    )
    unknown = F.lit(None).cast("bigint")
    others = [
        row_count(tables[name], "clean_rows").select(
            F.lit(entity).alias("entity"),
            unknown.alias("raw_rows"),
            unknown.alias("distinct_keys"),
            "clean_rows",
            F.lit(grain).alias("grain"),
        )
        for name, (entity, grain) in GRAINS.items()
    ]
    return union_all([first, *others])


def null_rates(tables: Tables) -> DataFrame:
    """Share of missing values before and after cleaning: one pass over each table."""

    def rates(df: DataFrame, conditions: list[Column]) -> DataFrame:
        n = F.count(F.lit(1))
        return df.agg(F.array(*[percent(count_if(c), n) for c in conditions]).alias("rates"))

    raw = rates(tables["stg_encounters"], [F.col(column) == marker for column, marker, *_ in MISSING_RULES])
    clean = rates(
        tables["cln_encounters"],
        [F.col(c).isNull() if label is None else F.col(c) == label for _, _, c, label, _ in MISSING_RULES],
    )
    both = raw.select(F.col("rates").alias("raw"), clean.scalar().alias("clean"))
    return rows_of(
        both,
        [
            {
                "entity": F.lit("encounters"),
                "column_name": F.lit(column),
                "raw_missing_pct": F.col("raw")[i],
                "clean_null_pct": F.col("clean")[i],
                "treatment": F.lit(treatment),
            }
            for i, (column, *_, treatment) in enumerate(MISSING_RULES)
        ],
    )


def issues(tables: Tables, raw: DataFrame | None = None) -> DataFrame:
    """What cleaning found, as counts of affected rows: one pass over each table."""
    discharge = "discharge_disposition_id"
    clean = tables["cln_encounters"].agg(
        F.count(F.lit(1)).alias("rows"),
        filled(count_if(F.col("is_readmit_eligible") == 0)).alias("not_eligible"),
        filled(count_if(F.col("is_first_encounter") == 0)).alias("repeats"),
        F.sum("is_num_meds_outlier").alias("meds_outliers"),
        F.sum("is_num_labs_outlier").alias("labs_outliers"),
        filled(count_if(F.col("diag_1").startswith("V") | F.col("diag_1").startswith("E"))).alias("supplementary"),
    )
    unresolved = orphan_rows(tables["cln_encounters"], discharge, tables["dim_discharge_disposition"])
    repeat_patients = tables["dim_patient"].agg(filled(count_if(F.col("n_encounters") > 1)).alias("n"))
    raw = raw_counts(tables) if raw is None else raw
    one = raw.select(
        F.struct("*").alias("raw"),
        clean.select(F.struct("*")).scalar().alias("clean"),
        unresolved.scalar().alias("unresolved"),
        repeat_patients.scalar().alias("repeat_patients"),
    )
    raw_rows = F.col("raw.raw_rows")
    # The check names of the issue ledger.
    found = {
        "encounters: duplicate encounter_id (extras dropped)": raw_rows - F.col("raw.distinct_keys"),
        "encounters: gender Unknown/Invalid (dropped)": F.col("raw.bad_gender"),
        "encounters: rows dropped in cleaning": raw_rows - F.col("clean.rows"),
        "encounters: expired / hospice discharge (excluded from readmission rates)": F.col("clean.not_eligible"),
        "encounters: repeat encounters of the same patient": F.col("clean.repeats"),
        "encounters: num_medications outlier (> Q3 + 3*IQR, kept)": F.col("clean.meds_outliers"),
        "encounters: num_lab_procedures outlier (> Q3 + 3*IQR, kept)": F.col("clean.labs_outliers"),
        "encounters: diag_1 is a V/E supplementary code": F.col("clean.supplementary"),
        "encounters: discharge id not in IDS_mapping": F.col("unresolved"),
        "encounters: patients with > 1 encounter": F.col("repeat_patients"),
    }
    return rows_of(one, [{"check_name": F.lit(name), "affected_rows": n} for name, n in found.items()])


def seeded_lookups(tables: Tables) -> DataFrame:
    """The three seeded id dimensions as text rows, as they should stand in the lookup file."""
    dims = {
        "dim_admission_type": "admission_type_id",
        "dim_discharge_disposition": "discharge_disposition_id",
        "dim_admission_source": "admission_source_id",
    }
    rows = [
        tables[name].select(F.col(key).cast("string").alias("admission_type_id"), "description") for name, key in dims.items()
    ]
    return union_all(rows)


def assertions(tables: Tables) -> DataFrame:
    """Twelve checks. Row rules share one pass over the fact; each key check counts per key first."""
    fact, drugs = tables["fact_encounter"], tables["fact_encounter_medication"]
    col = F.col
    negative = (
        (col("num_medications") < 0)
        | (col("number_inpatient") < 0)
        | (col("number_emergency") < 0)
        | (col("number_outpatient") < 0)
    )
    clean_rows = row_count(tables["cln_encounters"]).scalar()
    n = F.count(F.lit(1))
    own = fact.agg(
        n.alias("rows"),
        filled(count_if(~col("readmitted").isin(*V.READMITTED))).alias("label"),
        filled(count_if(~col("time_in_hospital").between(*V.STAY_DAYS))).alias("stay"),
        filled(count_if(col("readmit_30d_flag") > col("readmit_any_flag"))).alias("flags"),
        filled(count_if(negative)).alias("negative"),
    )
    # Fixed values below: the check names of the twelve assertions.
    keys = {
        "patient_nbr": "dim_patient",
        "admission_type_id": "dim_admission_type",
        "discharge_disposition_id": "dim_discharge_disposition",
        "admission_source_id": "dim_admission_source",
    }
    key_checks = {f"fact_encounter.{key} -> {dim}": orphan_rows(fact, key, tables[dim]) for key, dim in keys.items()}
    key_checks["fact_encounter_medication.medication_key -> dim_medication"] = orphan_rows(
        drugs, "medication_key", tables["dim_medication"]
    )
    key_checks["seeded lookup rows exist verbatim in IDS_mapping.csv"] = absent_rows(
        seeded_lookups(tables), tables["stg_ids_mapping"], V.LOOKUP_COLUMNS
    )
    row_checks = {
        "fact_encounter.encounter_id unique": col("rows") - distinct_values(fact, "encounter_id"),
        "fact_encounter rows = cln_encounters rows": F.abs(col("rows") - clean_rows),
        "readmitted in {<30, >30, NO}": col("label"),
        "time_in_hospital between 1 and 14": col("stay"),
        "readmit_30d_flag <= readmit_any_flag": col("flags"),
        "non-negative visit / medication counts": col("negative"),
    }
    simple = rows_of(own, [{"check_name": F.lit(name), "failed_rows": failed} for name, failed in row_checks.items()])
    related = [df.select(F.lit(name).alias("check_name"), "failed_rows") for name, df in key_checks.items()]
    return with_status(union_all([simple, *related]))
