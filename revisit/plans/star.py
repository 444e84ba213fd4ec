"""Star schema: seven dimensions and two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisit.functions.cleaning import id_group
from revisit.operators.keys import first_per_entity, surrogate_key
from revisit.operators.reshape import pooled_distinct
from revisit.plans import vocabulary as V
from revisit.plans.cleaning import eligible, medications_long
from revisit.sources.literals import values_table

FACT_FLAGS = ("readmit_30d_flag", "readmit_any_flag", "is_readmit_eligible")
FACT_COLUMNS = [
    "encounter_id", "patient_nbr", "age_key", "primary_diag_group_key", "secondary_diag_group_key",
    "admission_type_id", "discharge_disposition_id", "admission_source_id", "patient_encounter_seq",
    "is_first_encounter", "payer_code", "medical_specialty", "diag_1", "time_in_hospital", "los_band",
    "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "prior_inpatient_band", "number_diagnoses", "max_glu_serum", "a1c_result",
    "n_diabetes_meds", "n_meds_changed", "med_change_flag", "diabetes_med_flag", "insulin_flag", "insulin_status",
    "readmitted", *FACT_FLAGS, "is_num_meds_outlier", "is_num_labs_outlier",
]


def dim_admission_type(spark: SparkSession) -> DataFrame:
    unknown = F.col("description").isin(*V.UNKNOWN_ADMISSION_TYPES)
    label = F.when(unknown, F.lit("Unknown")).otherwise(F.col("description"))
    return values_table(spark, ["admission_type_id", "description"], V.ADMISSION_TYPES).withColumn("admission_type", label)


def dim_discharge_disposition(spark: SparkSession) -> DataFrame:
    key = "discharge_disposition_id"
    return values_table(spark, ["discharge_disposition_id", "description"], V.DISCHARGES).withColumns(
        {
            "discharge_group": F.expr(id_group(key, V.DISCHARGE_GROUPS, V.DISCHARGE_OTHER)),
            "is_readmit_eligible": F.expr(eligible(key)),
        }
    )


def dim_admission_source(spark: SparkSession) -> DataFrame:
    group = F.expr(id_group("admission_source_id", V.SOURCE_GROUPS, V.SOURCE_OTHER))
    return values_table(spark, ["admission_source_id", "description"], V.ADMISSION_SOURCES).withColumn(
        "admission_source_group", group
    )


def dim_medication(spark: SparkSession) -> DataFrame:
    rows = [(key, name, drug_class) for key, (name, drug_class) in enumerate(V.DRUGS, start=1)]
    return values_table(spark, ["medication_key", "medication", "drug_class"], rows)


def dim_age_group(clean: DataFrame) -> DataFrame:
    return surrogate_key(clean.select("age_group", "age_mid").distinct(), "age_key", ["age_mid", "age_group"])


def dim_diagnosis_group(clean: DataFrame) -> DataFrame:
    groups = pooled_distinct(clean, ["diag_1_group", "diag_2_group", "diag_3_group"], "diag_group")
    return surrogate_key(groups, "diag_group_key", ["diag_group"])


def dim_patient(clean: DataFrame) -> DataFrame:
    """Attributes at the patient's first analysable encounter, and the number of those."""
    return first_per_entity(clean, "patient_nbr", "encounter_id", ["race", "gender", "age_group"], "n_encounters").select(
        "patient_nbr", "race", "gender", F.col("age_group").alias("first_age_group"), "n_encounters"
    )


def fact_encounter(clean: DataFrame, ages: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Encounters with dimension keys; the diagnosis dimension plays two roles.

    The dimensions are written tables, so their size is known and decides how they are joined.
    """
    primary = diagnoses.select(
        F.col("diag_group").alias("diag_1_group"), F.col("diag_group_key").alias("primary_diag_group_key")
    )
    secondary = diagnoses.select(
        F.col("diag_group").alias("diag_2_group"), F.col("diag_group_key").alias("secondary_diag_group_key")
    )
    return (
        clean.join(ages.select("age_group", "age_key"), "age_group")
        .join(primary, "diag_1_group")
        .join(secondary, "diag_2_group")
        .withColumn("insulin_status", F.col("med_insulin"))
        .select(*FACT_COLUMNS)
    )


def fact_encounter_medication(clean: DataFrame, medications: DataFrame) -> DataFrame:
    """Encounter and drug, with the outcome flags on each row.

    Every clean encounter is in the encounter fact, so the flags are carried through the unpivot
    and no join between the facts is needed.
    """
    return (
        medications_long(clean, FACT_FLAGS)
        .join(F.broadcast(medications.select("medication", "medication_key")), "medication")
        .select("encounter_id", "medication_key", "dose_status", *FACT_FLAGS)
    )


def join_medication_fact(long: DataFrame, medications: DataFrame, fact: DataFrame) -> DataFrame:
    """The same fact by joining the two tables on the encounter, for a long table without flags."""
    return (
        long.join(F.broadcast(medications.select("medication", "medication_key")), "medication")
        .join(fact.select("encounter_id", *FACT_FLAGS), "encounter_id")
        .select("encounter_id", "medication_key", "dose_status", *FACT_FLAGS)
    )
