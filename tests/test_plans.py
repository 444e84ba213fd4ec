"""The physical plans keep the shape that matters on large data."""

import os

import pytest

from checks.build import built
from revisit.plans import cleaning, kpis, ledgers, reports, star
from revisit.session import write_table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are missing")


@pytest.fixture(scope="module")
def tables(spark):
    return built(spark, FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unpivot_is_one_scan_without_shuffle(tables):
    text = plan(cleaning.medications_long(tables["cln_encounters"]))
    assert text.count("FileScan") == 1 and "Expand" in text and "Exchange" not in text


def test_facts_do_not_shuffle(tables):
    clean = tables["cln_encounters"]
    encounter = plan(star.fact_encounter(clean, tables["dim_age_group"], tables["dim_diagnosis_group"]))
    assert "Exchange hashpartitioning" not in encounter and encounter.count("BroadcastHashJoin") == 3
    assert "Exchange hashpartitioning" not in plan(star.fact_encounter_medication(clean, tables["dim_medication"]))


def test_a_rate_table_reads_its_columns_only(tables):
    text = plan(kpis.rate_table(tables, "a_readmit_by_insulin"))
    assert "ReadSchema: struct<insulin_status:string,readmit_30d_flag:int,is_readmit_eligible:int>" in text
    assert "PushedFilters: [IsNotNull(is_readmit_eligible), EqualTo(is_readmit_eligible,1)]" in text


def test_all_rate_tables_share_one_fact_scan(tables):
    text = plan(kpis.rate_parts(tables))
    assert text.count("Expand") == 1 and text.count("FileScan") == 1 and "Join" not in text


def test_labels_are_joined_after_grouping(tables):
    text = plan(kpis.rate_table(tables, "a_readmit_by_discharge"))
    assert text.index("Join [discharge_disposition_id") < text.index("HashAggregate(keys=[discharge_disposition_id")


@pytest.mark.parametrize("build", [kpis.by_medication, reports.drug_measures, reports.admission_by_stay])
def test_fact_rows_are_grouped_by_key_before_their_labels(tables, build):
    text = plan(build(tables))
    assert text.index("Join [") < text.index(f"HashAggregate(keys=[{'medication_key' if 'medication_key' in text else 'admission_type_id'}")


@pytest.mark.parametrize("name", ["a_readmit_by_diagnosis", "a_patient_utilisation"])
def test_shares_need_no_window_over_all_groups(tables, name):
    assert "Window" not in plan(kpis.kpi_table(tables, name))


def test_wide_rows_are_shuffled_once(spark, tables):
    types = cleaning.compact(tables["stg_encounters"])
    order = tables["cln_encounters"].select("encounter_id", "patient_encounter_seq")
    rows = cleaning.clean_encounters(types, order, cleaning.fences(cleaning.encounter_keys(types)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(rows).split("Subquery")[0] + plan(rows).split("SortMergeJoin")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning(encounter_id") == 2  # the wide rows and the narrow order


def test_no_cross_joins(tables):
    frames = [kpis.kpi_table(tables, name) for name in kpis.TABLES]
    frames += [build(tables) for build in (ledgers.row_counts, ledgers.null_rates, ledgers.issues, ledgers.assertions)]
    for df in frames:
        assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)


def test_a_hot_patient_is_summed_before_the_patient_join(spark, tables):
    fact = tables["fact_encounter"]
    hot = fact.withColumn("patient_nbr", fact.patient_nbr * 0)
    rows = reports.measures({**tables, "fact_encounter": hot}, ["los_band"]).collect()
    assert sum(r.encounters for r in rows) == fact.count() and {r.patients for r in rows} == {1}
    text = plan(reports.measures(tables, ["los_band"], ["race"]))
    assert text.count("Join") == 1  # no label is asked for, so only the patients are joined
    assert text.index("Join [patient_nbr") < text.index("HashAggregate(keys=[patient_nbr")


def test_fences_need_no_wide_rows(tables):
    text = plan(cleaning.encounter_keys(cleaning.compact(tables["stg_encounters"])))
    assert "ReadSchema: struct<encounter_id:string,patient_nbr:string,num_lab_procedures:string,num_medications:string>" in text


def test_measures_of_stored_parts_never_see_patients(spark, tables, tmp_path):
    parts = write_table(reports.measure_parts(tables, ["los_band", "age_mid"], ["gender"]), str(tmp_path / "parts"))
    text = plan(reports.measures_of_parts(parts, ["los_band"], "gender = 'Female' AND age_mid >= 40"))
    assert "patient_nbr" not in text and "Join" not in text and "PushedFilters: [IsNotNull(gender), IsNotNull(age_mid)" in text
