"""Full refresh: raw files to all 32 tables, each written once and read back."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

from revisit.plans import cleaning, kpis, ledgers, star
from revisit.plans.staging import staged_encounters, staged_lookups
from revisit.session import released_shuffles, scratch_folder, write_table
from revisit.sources.writers import replace_tables, write_tables

# The names of the written tables.
STAR_TABLES = [
    "fact_encounter", "fact_encounter_medication", "dim_patient", "dim_age_group", "dim_diagnosis_group",
    "dim_admission_type", "dim_discharge_disposition", "dim_admission_source", "dim_medication",
]
COUNTED_TABLES = ["stg_encounters", "stg_ids_mapping", "cln_encounters", "cln_encounter_medications", *STAR_TABLES]
QUALITY_TABLES = ["dq_row_counts", "dq_null_rates", "dq_issues", "dq_assertions"]

# Key of each table whose cells are compared between two refreshes.
COMPARED_TABLES = {
    "a_kpi_headline": [],  # one row
    "a_readmit_by_age": ["age_group", "age_mid"],
    "a_readmit_by_diagnosis": ["primary_diagnosis_group"],
    "a_readmit_by_los_band": ["los_band"],
    "a_readmit_by_medication": ["medication", "drug_class"],
    "a_readmit_by_prior_inpatient": ["prior_inpatient_band"],
    "dq_issues": ["check_name"],
    "dq_assertions": ["check_name"],
}

Tables = dict[str, DataFrame]


SEEDED: Mapping[str, Callable[[SparkSession], DataFrame]] = {
    "dim_admission_type": star.dim_admission_type,
    "dim_discharge_disposition": star.dim_discharge_disposition,
    "dim_admission_source": star.dim_admission_source,
    "dim_medication": star.dim_medication,
}


def stage(spark: SparkSession, encounters: str, lookups: str, root: str) -> Tables:
    builds = {
        "stg_encounters": lambda: staged_encounters(spark, encounters),
        "stg_ids_mapping": lambda: staged_lookups(spark, lookups),
    }
    return replace_tables(spark, builds, root)


def clean(tables: Tables, root: str) -> None:
    """Order and fences first, from four narrow columns; then the wide rows in one pass."""
    spark = tables["stg_encounters"].sparkSession
    compact = cleaning.compact(tables["stg_encounters"])
    with scratch_folder(spark) as scratch:
        with released_shuffles(spark):
            keys = write_table(cleaning.encounter_keys(compact), f"{scratch}/encounter_keys")
        narrow = {
            f"{scratch}/order": lambda: cleaning.patient_sequence(keys),
            f"{scratch}/fence": lambda: cleaning.fences(keys),
        }
        order, fence = write_tables(spark, narrow).values()
        tables |= replace_tables(spark, {"cln_encounters": lambda: cleaning.clean_encounters(compact, order, fence)}, root)


def model(tables: Tables, root: str) -> None:
    """Everything that reads the clean encounters alone, then the fact that needs two dimensions."""
    rows = tables["cln_encounters"]
    spark = rows.sparkSession
    builds = {name: partial(build, spark) for name, build in SEEDED.items()}
    builds |= {
        "cln_encounter_medications": lambda: cleaning.medications_long(rows),
        "fact_encounter_medication": lambda: star.fact_encounter_medication(rows, star.dim_medication(spark)),
        "dim_age_group": lambda: star.dim_age_group(rows),
        "dim_diagnosis_group": lambda: star.dim_diagnosis_group(rows),
        "dim_patient": lambda: star.dim_patient(rows),
    }
    tables |= replace_tables(spark, builds, root)
    fact = {
        "fact_encounter": lambda: star.fact_encounter(rows, tables["dim_age_group"], tables["dim_diagnosis_group"]),
    }
    tables |= replace_tables(spark, fact, root)


def analyse(tables: Tables, root: str) -> None:
    """The shared parts next to the tables that do not use them, then the tables made from the parts."""
    spark = tables["fact_encounter"].sparkSession
    alone = [name for name in kpis.TABLES if name not in kpis.RATE_TABLES]
    with scratch_folder(spark) as scratch:
        path = f"{scratch}/rate_parts"
        written = replace_tables(spark, {name: partial(kpis.kpi_table, tables, name) for name in alone}, root, {path: lambda: kpis.rate_parts(tables)})
        parts = written.pop(path)
        tables |= written
        tables |= replace_tables(spark, {name: partial(kpis.rate_table_from_parts, tables, parts, name) for name in kpis.RATE_TABLES}, root)


def check(tables: Tables, root: str) -> None:
    """Raw counts next to the ledgers that do not use them, then the two that do."""
    spark = tables["fact_encounter"].sparkSession
    alone = {"dq_null_rates": ledgers.null_rates, "dq_assertions": ledgers.assertions}
    with scratch_folder(spark) as scratch:
        path = f"{scratch}/raw_counts"
        written = replace_tables(spark, {name: partial(build, tables) for name, build in alone.items()}, root, {path: lambda: ledgers.raw_counts(tables)})
        raw = written.pop(path)
        tables |= written
        counted = {"dq_row_counts": ledgers.row_counts, "dq_issues": ledgers.issues}
        tables |= replace_tables(spark, {name: partial(build, tables, raw) for name, build in counted.items()}, root)


STAGES: Mapping[str, Callable[[Tables, str], None]] = {
    "cleaning": clean,
    "model": model,
    "analysis": analyse,
    "quality": check,
}


def refresh(spark: SparkSession, encounters: str, lookups: str, root: str) -> Tables:
    """All 32 tables below ``root``; running it again replaces them with the same content.

    Analysis and quality both read the model and not each other, so they run side by side.
    """
    tables = stage(spark, encounters, lookups, root)
    clean(tables, root)
    model(tables, root)
    results = [dict(tables), dict(tables)]
    last = inheritable_thread_target(spark)(lambda step, own: step(own, root))
    with ThreadPoolExecutor(len(results)) as pool:
        list(pool.map(last, [analyse, check], results))
    return results[0] | results[1]
