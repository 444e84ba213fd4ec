"""Report queries over the star and the KPI tables: measures under slicers, datasets, chart rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisit.functions.rounding import fraction
from revisit.operators.distinct import entity_parts, pooled
from revisit.operators.measures import additive_by, against_overall, matrix, related_rows
from revisit.operators.quality import count_if
from revisit.operators.rates import rate_by
from revisit.plans import kpis
from revisit.plans import vocabulary as V

Tables = Mapping[str, DataFrame]

SUMS = {
    "encounters": "1",
    "eligible_encounters": "CASE WHEN is_readmit_eligible = 1 THEN 1 ELSE 0 END",
    "readmits_30d": "CASE WHEN is_readmit_eligible = 1 AND readmit_30d_flag = 1 THEN 1 ELSE 0 END",
    "readmits_any": "CASE WHEN is_readmit_eligible = 1 AND readmit_any_flag = 1 THEN 1 ELSE 0 END",
    "first_eligible": "CASE WHEN is_readmit_eligible = 1 AND is_first_encounter = 1 THEN 1 ELSE 0 END",
    "first_30d": "CASE WHEN is_readmit_eligible = 1 AND is_first_encounter = 1 AND readmit_30d_flag = 1 THEN 1 ELSE 0 END",
    "days": "time_in_hospital",
    "days_known": "CASE WHEN time_in_hospital IS NOT NULL THEN 1 ELSE 0 END",
    "medications": "num_medications",
    "medications_known": "CASE WHEN num_medications IS NOT NULL THEN 1 ELSE 0 END",
    "labs": "num_lab_procedures",
    "labs_known": "CASE WHEN num_lab_procedures IS NOT NULL THEN 1 ELSE 0 END",
    "changed": "CASE WHEN med_change_flag = 1 THEN 1 ELSE 0 END",
    "on_insulin": "CASE WHEN insulin_flag = 1 THEN 1 ELSE 0 END",
    "tested": f"CASE WHEN a1c_result <> '{V.NOT_MEASURED}' THEN 1 ELSE 0 END",
    "prior": "CASE WHEN number_inpatient > 0 THEN 1 ELSE 0 END",
}
RATIOS = {
    "readmit_30d_rate": ("readmits_30d", "eligible_encounters"),
    "readmit_any_rate": ("readmits_any", "eligible_encounters"),
    "readmit_30d_rate_first": ("first_30d", "first_eligible"),
    "avg_los_days": ("days", "days_known"),
    "avg_medications": ("medications", "medications_known"),
    "avg_lab_procedures": ("labs", "labs_known"),
    "med_change_rate": ("changed", "encounters"),
    "on_insulin_rate": ("on_insulin", "encounters"),
    "a1c_tested_rate": ("tested", "encounters"),
    "prior_inpatient_rate": ("prior", "encounters"),
}
COUNTS = ["encounters", "patients", "eligible_encounters", "readmits_30d", "readmits_any"]


def with_labels(tables: Tables, wanted: set[str] | None, diagnosis_key: str) -> DataFrame:
    """The encounter fact with the age and diagnosis labels that are wanted; ``None`` wants all.

    ``diagnosis_key`` chooses which of the two roles of the diagnosis dimension is active.
    """
    view = tables["fact_encounter"]
    if wanted is None or wanted & {"age_group", "age_mid"}:
        view = view.join(tables["dim_age_group"], "age_key")
    if wanted is None or "diag_group" in wanted:
        diagnoses = tables["dim_diagnosis_group"].select(F.col("diag_group_key").alias(diagnosis_key), "diag_group")
        view = view.join(diagnoses, diagnosis_key)
    return view


def overall_rate(tables: Tables) -> DataFrame:
    """The 30-day rate with every filter removed, as a one-cell table."""
    eligible = F.col("is_readmit_eligible") == 1
    return tables["fact_encounter"].agg(
        fraction(count_if(eligible & (F.col("readmit_30d_flag") == 1)), count_if(eligible)).alias("rate")
    )


def measures(
    tables: Tables,
    keys: Sequence[str] = (),
    patient_keys: Sequence[str] = (),
    where: Column | str | None = None,
    patient_where: Column | str | None = None,
    diagnosis_key: str = "primary_diag_group_key",
) -> DataFrame:
    """All encounter measures by fact keys and patient attributes, under slicers on either."""
    patients = tables["dim_patient"]
    sliced = patients if patient_where is None else patients.where(patient_where)
    needs_patients = bool(patient_keys) or patient_where is not None
    sums = additive_by(
        with_labels(tables, set(keys) if where is None else None, diagnosis_key),
        keys,
        {name: F.expr(sql) for name, sql in SUMS.items()},
        "patient_nbr",
        sliced if needs_patients else None,
        patient_keys,
        where,
        entities="patients",
    )
    return _rated(sums, [*keys, *patient_keys], overall_rate(tables))


def _rated(sums: DataFrame, keys: Sequence[str], overall: DataFrame) -> DataFrame:
    ratios = [fraction(F.col(a), F.col(b)).alias(name) for name, (a, b) in RATIOS.items()]
    rated = sums.select(*keys, *[F.col(c).cast("bigint").alias(c) for c in COUNTS], *ratios)
    return against_overall(rated, F.col("readmit_30d_rate"), overall, "readmit_30d_vs_overall")


def measure_parts(
    tables: Tables, keys: Sequence[str], patient_keys: Sequence[str] = (), diagnosis_key: str = "primary_diag_group_key"
) -> DataFrame:
    """What :func:`measures_of_parts` needs to answer for any mix of the given slicers; to be written once.

    Rows are the combinations of slicer values that occur, times ranges of patient numbers. Facts meet their
    patients only here, and not at all without ``patient_keys``.
    """
    sums = {name: F.expr(sql) for name, sql in SUMS.items()}
    rows = with_labels(tables, set(keys), diagnosis_key)
    if patient_keys:
        per_patient = rows.groupBy("patient_nbr", *keys).agg(*[F.sum(column).alias(name) for name, column in sums.items()])
        rows = per_patient.join(tables["dim_patient"].select("patient_nbr", *patient_keys), "patient_nbr")
        sums = {name: F.col(name) for name in SUMS}
    return entity_parts(rows, [*keys, *patient_keys], "patient_nbr", sums)


def measures_of_parts(parts: DataFrame, keys: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """All encounter measures by any slicers of stored parts, under a filter on any of them, without the facts."""
    overall = parts.agg(fraction(F.sum("readmits_30d"), F.sum("eligible_encounters")).alias("rate"))
    return _rated(pooled(parts, keys, "patients", list(SUMS), where), keys, overall)


def _readmits(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows and 30-day readmissions by key, before labels are looked up."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name), count_if(F.col("readmit_30d_flag") == 1).alias("readmits"))


def _summed(labelled: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Counts of keys added up over their labels."""
    return labelled.groupBy(*keys).agg(F.sum(name).alias(name), F.sum("readmits").alias("readmits"))


def drug_measures(tables: Tables, encounter_where: Column | str | None = None, min_rows: int = 0) -> DataFrame:
    """Drug measures by drug; a filter on encounters reaches the drugs through the shared key.

    ``min_rows`` is the visual filter of the drug bar.
    """
    rows = tables["fact_encounter_medication"].where(F.col("is_readmit_eligible") == 1)
    if encounter_where is not None:
        rows = related_rows(rows, tables["fact_encounter"].where(encounter_where), "encounter_id")
    by_key = _readmits(rows, ["medication_key"], "drug_encounters")
    sums = _summed(by_key.join(tables["dim_medication"].select("medication_key", "medication"), "medication_key"), ["medication"], "drug_encounters")
    rate = fraction(F.col("readmits"), F.col("drug_encounters")).alias("drug_readmit_30d_rate")
    return sums.where(F.col("drug_encounters") >= min_rows).select("medication", "drug_encounters", rate)


def encounters_on_drug(tables: Tables, drug: str) -> DataFrame:
    """Encounter facts of one drug: the same relationship followed the other way."""
    chosen = tables["dim_medication"].where(F.col("medication") == drug).select("medication_key")
    rows = tables["fact_encounter_medication"].join(chosen, "medication_key", "left_semi")
    return related_rows(tables["fact_encounter"], rows, "encounter_id")


def admission_by_stay(tables: Tables) -> DataFrame:
    """30-day rate by admission type and stay band, with the distance from the overall rate."""
    types = tables["dim_admission_type"].select("admission_type_id", "admission_type")
    eligible = tables["fact_encounter"].where(F.col("is_readmit_eligible") == 1)
    by_key = _readmits(eligible, ["admission_type_id", "los_band"], "encounters")
    keys = ["admission_type", "los_band"]
    rate = fraction(F.col("readmits"), F.col("encounters")).alias("rate")
    groups = _summed(by_key.join(types, "admission_type_id"), keys, "encounters").select(*keys, "encounters", rate)
    return against_overall(groups, F.col("rate"), overall_rate(tables), "vs_overall")


def admission_by_stay_matrix(tables: Tables) -> DataFrame:
    return matrix(admission_by_stay(tables), "admission_type", "los_band", V.LOS_LABELS, "rate")


def a1c_by_change(tables: Tables) -> DataFrame:
    """HbA1c result by medication change."""
    keys = ["a1c_result", "med_change_flag"]
    return rate_by(tables["fact_encounter"], keys, [kpis.COUNT, kpis.RATE_30D], kpis.ELIGIBLE)


# Report datasets: KPI table, columns, order.
DATASETS = {
    "age": ("a_readmit_by_age", ["age_group", "age_mid", "encounters", "readmit_30d_pct"], ["age_mid"]),
    "diagnosis": (
        "a_readmit_by_diagnosis",
        ["primary_diagnosis_group", "encounters", "readmit_30d_pct"],
        ["-readmit_30d_pct", "primary_diagnosis_group"],
    ),
    "stay": ("a_readmit_by_los", ["los_days", "encounters", "readmit_30d_pct"], ["los_days"]),
    "medication": (
        "a_readmit_by_medication",
        ["medication", "encounters_prescribed", "readmit_30d_pct"],
        ["-readmit_30d_pct", "medication"],
    ),
    "prior": (
        "a_readmit_by_prior_inpatient",
        ["prior_inpatient_band", "encounters", "readmit_30d_pct"],
        ["prior_inpatient_band"],
    ),
    "discharge": (
        "a_readmit_by_discharge",
        ["discharge_group", "encounters", "readmit_30d_pct"],
        ["-readmit_30d_pct", "discharge_group"],
    ),
}
INSULIN_ORDER = ["No", "Steady", "Up", "Down"]
CARDS = [
    "encounters_total", "patients_total", "readmit_30d_pct", "readmit_any_pct", "avg_los_days", "on_insulin_pct",
    "a1c_tested_pct",
]


def _by(column: str) -> Column:
    return F.col(column[1:]).desc_nulls_last() if column.startswith("-") else F.col(column).asc_nulls_last()


def headline_dataset(kpi: DataFrame) -> DataFrame:
    """Headline numbers with the rates as fractions."""
    return kpi.select(
        "encounters_total",
        "patients_total",
        (F.col("readmit_30d_pct") / 100).alias("readmit_30d_rate"),
        (F.col("readmit_any_pct") / 100).alias("readmit_any_rate"),
        "avg_los_days",
    )


def dataset(kpi: DataFrame, name: str) -> DataFrame:
    _, columns, order = DATASETS[name]
    return kpi.select(*columns).orderBy(*[_by(c) for c in order])


def cards(kpi: DataFrame) -> DataFrame:
    """Cards as ``(position, card, value)`` rows."""
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("card"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(CARDS, start=1)
    ]
    return kpi.select(F.inline(F.array(*cells)))


OVERVIEW = ["encounters", "patients", "readmit_30d_rate", "readmit_any_rate", "avg_los_days", "on_insulin_rate"]


def overview_cards(tables: Tables, where: Column | str | None = None, patient_where: Column | str | None = None) -> DataFrame:
    """The overview cards from the measures, so that slicers apply to them."""
    return measures(tables, where=where, patient_where=patient_where).select(*OVERVIEW)


def diagnosis_chart(kpi: DataFrame) -> DataFrame:
    """Diagnosis groups by falling rate, without the missing ones."""
    return dataset(kpi.where(F.col("primary_diagnosis_group") != V.DIAGNOSIS_MISSING), "diagnosis")


def insulin_chart(kpi: DataFrame) -> DataFrame:
    """Insulin statuses in their fixed order."""
    place = F.array_position(F.array(*[F.lit(s) for s in INSULIN_ORDER]), F.col("insulin_status")).cast("int")
    return kpi.where(F.col("insulin_status").isNotNull()).withColumn("position", place).orderBy("position")
