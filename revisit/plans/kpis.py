"""The fifteen KPI tables, declared as keys and measures.

Thirteen of them share one view of the encounter fact. Each can be built alone, or all of them
from one scan with :func:`all_tables`.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisit.functions.cleaning import tail_band
from revisit.functions.rounding import mean, percent
from revisit.operators import rates as R
from revisit.plans import vocabulary as V
from revisit.session import fresh_folder, write_table

ELIGIBLE = "is_readmit_eligible = 1"

COUNT = R.rows("encounters")
READMITS = R.total("readmits_30d", "readmit_30d_flag")
RATE_30D = R.flag_percent("readmit_30d_pct", "readmit_30d_flag")
RATE_ANY = R.flag_percent("readmit_any_pct", "readmit_any_flag")
AVG_STAY = R.average("avg_los_days", "time_in_hospital")
AVG_MEDICATIONS = R.average("avg_num_medications", "num_medications")
CHANGE_PERCENT = R.flag_percent("med_change_pct", "med_change_flag")
SHARE = R.share_of_rows("share_pct")


@dataclass(frozen=True)
class RateTable:
    keys: tuple[str, ...]
    measures: tuple[R.Measure, ...]
    eligible_only: bool = True
    first: int | None = None


RATE_TABLES: dict[str, RateTable] = {
    "a_readmit_by_age": RateTable(("age_group", "age_mid"), (COUNT, READMITS, RATE_30D, RATE_ANY, AVG_STAY)),
    "a_readmit_by_diagnosis": RateTable(
        ("primary_diagnosis_group",), (COUNT, SHARE, READMITS, RATE_30D, RATE_ANY, AVG_STAY)
    ),
    "a_readmit_top_diag_codes": RateTable(("diag_1",), (COUNT, RATE_30D), first=V.TOP_CODES),
    "a_readmit_by_los": RateTable(("los_days", "los_band"), (COUNT, READMITS, RATE_30D, RATE_ANY)),
    "a_readmit_by_los_band": RateTable(("los_band",), (COUNT, READMITS, RATE_30D, AVG_MEDICATIONS)),
    "a_readmit_by_insulin": RateTable(("insulin_status",), (COUNT, RATE_30D)),
    "a_readmit_by_med_change": RateTable(("diabetes_med", "med_change"), (COUNT, RATE_30D)),
    "a_readmit_by_n_meds": RateTable(("n_diabetes_meds",), (COUNT, RATE_30D)),
    "a_readmit_by_prior_inpatient": RateTable(("prior_inpatient_band",), (COUNT, READMITS, RATE_30D)),
    "a_readmit_by_a1c": RateTable(("a1c_result",), (COUNT, RATE_30D, CHANGE_PERCENT)),
    "a_readmit_by_discharge": RateTable(("discharge_group",), (COUNT, READMITS, RATE_30D), eligible_only=False),
    "a_readmit_by_admission_type": RateTable(("admission_type",), (COUNT, RATE_30D)),
}

MEDICATION_MEASURES = (
    R.rows("encounters_prescribed"),
    R.total_if("encounters_dose_changed", "dose_status IN ('Up', 'Down')"),
    READMITS,
    RATE_30D,
)
UTILISATION_MEASURES = (
    R.rows("patients"),
    R.total("encounters", "n_encounters"),
    R.share_of_total("encounter_share_pct", "n_encounters"),
)

TABLES = [
    "a_kpi_headline", "a_readmit_by_age", "a_readmit_by_diagnosis", "a_readmit_top_diag_codes", "a_readmit_by_los",
    "a_readmit_by_los_band", "a_readmit_by_medication", "a_readmit_by_insulin", "a_readmit_by_med_change",
    "a_readmit_by_n_meds", "a_readmit_by_prior_inpatient", "a_readmit_by_a1c", "a_readmit_by_discharge",
    "a_readmit_by_admission_type", "a_patient_utilisation",
]


@dataclass(frozen=True)
class Label:
    """A label from a dimension, and the fact key that stands for it until the groups are made."""

    dimension: str
    fact_key: str
    key: str
    column: str


LABELS = {
    "age_group": Label("dim_age_group", "age_key", "age_key", "age_group"),
    "age_mid": Label("dim_age_group", "age_key", "age_key", "age_mid"),
    "primary_diagnosis_group": Label("dim_diagnosis_group", "primary_diag_group_key", "diag_group_key", "diag_group"),
    "admission_type": Label("dim_admission_type", "admission_type_id", "admission_type_id", "admission_type"),
    "discharge_group": Label(
        "dim_discharge_disposition", "discharge_disposition_id", "discharge_disposition_id", "discharge_group"
    ),
}


def fact_keys(spec: RateTable) -> list[str]:
    """The columns of the fact that a table is grouped by before labels are looked up."""
    return list(dict.fromkeys(LABELS[k].fact_key if k in LABELS else k for k in spec.keys))


def rate_view(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The encounter fact with the labels that come from its own columns."""
    return tables["fact_encounter"].withColumns(
        {
            "los_days": F.col("time_in_hospital"),
            "diabetes_med": F.when(F.col("diabetes_med_flag") == 1, "On diabetes med").otherwise("No diabetes med"),
            "med_change": F.when(F.col("med_change_flag") == 1, "Changed").otherwise("Not changed"),
            "n_diabetes_meds": F.expr(tail_band("n_diabetes_meds", 3)),
        }
    )


def _with_labels(tables: Mapping[str, DataFrame], parts: DataFrame, spec: RateTable) -> DataFrame:
    """Dimension labels for grouped parts, added up over keys that share a label.

    The facts are grouped by key first, so the join sees one row per key. A key that is not in its
    dimension drops out here.
    """
    wanted: dict[str, dict[str, Label]] = {}
    for key in spec.keys:
        if key in LABELS:
            wanted.setdefault(LABELS[key].dimension, {})[key] = LABELS[key]
    for dimension, labels in wanted.items():
        any_label = next(iter(labels.values()))
        columns = [F.col(label.column).alias(name) for name, label in labels.items()]
        names = tables[dimension].select(F.col(any_label.key).alias(any_label.fact_key), *columns)
        parts = parts.join(names, any_label.fact_key)
    return R.pool_parts(parts, spec.keys, spec.measures)


def _arrange(tables: Mapping[str, DataFrame], parts: DataFrame, spec: RateTable) -> DataFrame:
    """Finished table from the parts of its fact keys; both halves are added up where needed."""
    if not spec.eligible_only or set(spec.keys) & set(LABELS):
        parts = _with_labels(tables, parts, spec)
    if not spec.first:
        return R.finish(parts, spec.keys, spec.measures)
    known = parts.where(" AND ".join(f"{key} IS NOT NULL" for key in spec.keys))
    order = [F.col("encounters").desc(), *[F.col(k) for k in spec.keys]]
    return R.top_n(R.finish(known, spec.keys, spec.measures), order, spec.first)


def rate_table(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One rate table from its own scan."""
    spec = RATE_TABLES[name]
    view = rate_view(tables)
    rows = view.where(ELIGIBLE) if spec.eligible_only else view
    return _arrange(tables, rows.groupBy(*fact_keys(spec)).agg(*R.part_aggregates(rows, spec.measures)), spec)


def rate_parts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Parts of all rate tables from one scan of the fact, by fact keys and eligibility."""
    sets = {name: (*fact_keys(spec), "is_readmit_eligible") for name, spec in RATE_TABLES.items()}
    measures = {m.name: m for spec in RATE_TABLES.values() for m in spec.measures}.values()
    return R.parts_by_sets(rate_view(tables), sets, list(measures))


def rate_table_from_parts(tables: Mapping[str, DataFrame], parts: DataFrame, name: str) -> DataFrame:
    """The same table as :func:`rate_table`, from the shared parts."""
    spec = RATE_TABLES[name]
    own = parts.where(F.col("table") == name)
    return _arrange(tables, own.where(ELIGIBLE) if spec.eligible_only else own, spec)


def headline(fact: DataFrame, exact: bool = True) -> DataFrame:
    """Sixteen headline numbers, fifteen of them in one pass that combines map-side. Rates are over eligible encounters, shares over all.

    ``exact=False`` estimates the number of patients and so needs no shuffle by patient.
    """

    def ones(flag: str, condition: str | None = None) -> Column:
        return F.sum(flag) if condition is None else F.sum(F.when(F.expr(condition), F.col(flag)).otherwise(0))

    first = f"{ELIGIBLE} AND is_first_encounter = 1"
    parts = fact.agg(
        F.count(F.lit(1)).alias("n"),
        *([] if exact else [F.approx_count_distinct("patient_nbr").alias("patients")]),
        ones("is_readmit_eligible").alias("eligible"),
        ones("readmit_30d_flag", ELIGIBLE).alias("eligible_30d"),
        ones("readmit_any_flag", ELIGIBLE).alias("eligible_any"),
        ones("readmit_30d_flag").alias("all_30d"),
        ones("readmit_30d_flag", first).alias("first_30d"),
        F.count_if(F.expr(first)).alias("first_n"),
        *[F.sum(c).alias(f"sum_{c}") for c in ("time_in_hospital", "num_medications", "num_lab_procedures")],
        *[F.count(c).alias(f"count_{c}") for c in ("time_in_hospital", "num_medications", "num_lab_procedures")],
        *[ones(c).alias(c) for c in ("med_change_flag", "diabetes_med_flag", "insulin_flag")],
        F.count_if(F.col("a1c_result") != V.NOT_MEASURED).alias("tested"),
        F.count_if(F.col("number_inpatient") > 0).alias("prior"),
    )
    if exact:  # by itself, so that the shuffle by patient carries one column and not all sums
        parts = parts.withColumn("patients", fact.agg(F.count_distinct("patient_nbr")).scalar())
    col = F.col
    average = lambda c: mean(col(f"sum_{c}"), col(f"count_{c}"))
    return parts.select(
        col("n").alias("encounters_total"),
        col("patients").alias("patients_total"),
        col("eligible").alias("eligible_encounters"),
        col("eligible_30d").alias("readmits_30d"),
        percent(col("eligible_30d"), col("eligible")).alias("readmit_30d_pct"),
        percent(col("eligible_any"), col("eligible")).alias("readmit_any_pct"),
        percent(col("all_30d"), col("n")).alias("readmit_30d_pct_all_encounters"),
        percent(col("first_30d"), col("first_n")).alias("readmit_30d_pct_first_encounter"),
        average("time_in_hospital").alias("avg_los_days"),
        average("num_medications").alias("avg_num_medications"),
        average("num_lab_procedures").alias("avg_num_lab_procedures"),
        percent(col("med_change_flag"), col("n")).alias("med_change_pct"),
        percent(col("diabetes_med_flag"), col("n")).alias("on_diabetes_med_pct"),
        percent(col("insulin_flag"), col("n")).alias("on_insulin_pct"),
        percent(col("tested"), col("n")).alias("a1c_tested_pct"),
        percent(col("prior"), col("n")).alias("prior_inpatient_pct"),
    )


def by_medication(tables: Mapping[str, DataFrame], min_rows: int = V.MEDICATION_MIN_ROWS) -> DataFrame:
    """Encounters where a drug was prescribed; drugs below ``min_rows`` encounters are left out.

    The facts are added up by drug key first, so that the join sees one row per key.
    """
    keys, facts = ["medication", "drug_class"], tables["fact_encounter_medication"].where(ELIGIBLE)
    parts = facts.groupBy("medication_key").agg(*R.part_aggregates(facts, MEDICATION_MEASURES))
    named = parts.join(tables["dim_medication"].select("medication_key", *keys), "medication_key")
    return R.finish(R.pool_parts(named, keys, MEDICATION_MEASURES), keys, MEDICATION_MEASURES, min_rows)


def patient_utilisation(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Patients by their number of encounters, five and more pooled."""
    banded = tables["dim_patient"].withColumn("encounters_per_patient", F.expr(tail_band("n_encounters", 5)))
    return R.rate_by(banded, ["encounters_per_patient"], UTILISATION_MEASURES)


def kpi_table(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Any of the fifteen tables by name, from its own scan."""
    if name == "a_kpi_headline":
        return headline(tables["fact_encounter"])
    if name == "a_readmit_by_medication":
        return by_medication(tables)
    if name == "a_patient_utilisation":
        return patient_utilisation(tables)
    return rate_table(tables, name)


def all_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All fifteen tables; the rate tables share one written set of parts."""
    spark = tables["fact_encounter"].sparkSession
    parts = write_table(rate_parts(tables), f"{fresh_folder(spark)}/rate_parts")
    return {
        name: rate_table_from_parts(tables, parts, name) if name in RATE_TABLES else kpi_table(tables, name) for name in TABLES
    }
