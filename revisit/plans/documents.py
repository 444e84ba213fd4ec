"""The metrics document and the headline snapshot as one-row tables with a JSON column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisit.operators.quality import pass_summary

Tables = Mapping[str, DataFrame]

# The names in the published snapshot.
HEADLINE = [
    "encounters_total", "patients_total", "eligible_encounters", "readmits_30d", "readmit_30d_pct", "readmit_any_pct",
    "readmit_30d_pct_first_encounter", "avg_los_days", "avg_num_medications", "med_change_pct", "on_insulin_pct",
    "a1c_tested_pct", "prior_inpatient_pct",
]
# The rules that a snapshot states.
RULES = {
    "readmission_definition": "readmitted '<30' -> readmit_30d_flag = 1 (any = '<30' or '>30')",
    "rate_denominator": "readmission-eligible encounters (discharge to expired / hospice excluded)",
    "outlier_rule": "num_medications / num_lab_procedures > Q3 + 3*IQR (flagged, kept)",
}
TOP_GROUPS = 5


def _records(df: DataFrame, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """One cell: the rows of a report-sized table as an ordered array of structs."""
    entry = F.struct(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("o"), F.struct(*columns).alias("r"))
    return df.agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["r"]).alias("records"))


def _map(df: DataFrame, order: Sequence[Column], key: str, value: str) -> DataFrame:
    """One cell: ``key -> value`` in the given order."""
    records = _records(df, order, [key, value])
    pairs = F.transform("records", lambda r: F.struct(r[key], r[value]))
    return records.select(F.map_from_entries(pairs).alias("pairs"))


def _json(column: Column) -> Column:
    return F.to_json(column, {"ignoreNullFields": "false"})


def metrics(tables: Tables) -> DataFrame:
    """Headline KPIs and the data-quality tables in one JSON document."""
    col = F.col
    counts, nulls = tables["dq_row_counts"], tables["dq_null_rates"]
    issues, checks = tables["dq_issues"], tables["dq_assertions"]
    quality = F.struct(
        _records(counts, [col("entity")], counts.columns).scalar().alias("row_counts"),
        _records(nulls, [col("column_name")], nulls.columns).scalar().alias("null_rates"),
        _map(issues, [col("check_name")], "check_name", "affected_rows").scalar().alias("issues"),
        _map(checks, [col("check_name")], "check_name", "status").scalar().alias("assertions"),
    )
    kpi = tables["a_kpi_headline"]
    document = F.struct(F.struct(*kpi.columns).alias("kpis"), quality.alias("data_quality"))
    return kpi.select(_json(document).alias("document"))


def snapshot(tables: Tables) -> DataFrame:
    """Headline subset, rates by age, stay and prior visits, top groups, drugs by rate, checks passed."""
    col = F.col
    rate = "readmit_30d_pct"

    def rates(name: str, label: str, order: str) -> Column:
        return _map(tables[name], [col(order)], label, rate).scalar()

    diagnosis = ["primary_diagnosis_group", "encounters", rate]
    top = tables["a_readmit_by_diagnosis"].orderBy(col("encounters").desc(), diagnosis[0]).limit(TOP_GROUPS)
    drugs = _records(
        tables["a_readmit_by_medication"], [-col(rate), col("medication")], ["medication", "encounters_prescribed", rate]
    )
    passed = pass_summary(tables["dq_assertions"])
    kpi = tables["a_kpi_headline"]
    document = F.struct(
        F.struct(*[F.lit(text).alias(name) for name, text in RULES.items()]).alias("config"),
        F.struct(*HEADLINE).alias("headline"),
        rates("a_readmit_by_age", "age_group", "age_mid").alias("readmit_30d_pct_by_age"),
        rates("a_readmit_by_los_band", "los_band", "los_band").alias("readmit_30d_pct_by_los_band"),
        rates("a_readmit_by_prior_inpatient", "prior_inpatient_band", "prior_inpatient_band").alias(
            "readmit_30d_pct_by_prior_inpatient"
        ),
        _records(top, [-col("encounters"), col(diagnosis[0])], diagnosis).scalar().alias("top_diagnosis_groups"),
        drugs.scalar().alias("medications_by_readmit_30d_pct"),
        passed.select("passed").scalar().alias("assertions_passed"),
        passed.select("total").scalar().alias("assertions_total"),
    )
    return kpi.select(_json(document).alias("document"))
