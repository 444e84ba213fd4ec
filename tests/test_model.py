"""The whole model on hand-written encounters."""

import json

import pytest

from revisit.operators.quality import pass_summary
from revisit.plans import cleaning, documents, kpis, ledgers, refresh, reports, star
from revisit.session import fresh_folder, write_table
from tests.encounters import lookups, staged

CASES = [
    {"patient_nbr": "1", "readmitted": "<30", "metformin": "Up"},
    {"patient_nbr": "1", "readmitted": "NO", "age": "[60-70)", "race": "Asian"},
    {"patient_nbr": "2", "readmitted": ">30", "discharge_disposition_id": "11", "diag_1": "?"},
    {"patient_nbr": "3", "readmitted": "<30", "discharge_disposition_id": "31", "diag_2": "?", "insulin": "Down"},
    {"patient_nbr": "3", "gender": "?"},
    {"patient_nbr": "4", "change": "?", "time_in_hospital": "9", "A1Cresult": ">7", "number_inpatient": "2"},
]


@pytest.fixture(scope="module")
def tables(spark):
    t = {"stg_encounters": staged(spark, CASES), "stg_ids_mapping": lookups(spark)}
    types = cleaning.compact(t["stg_encounters"])
    keys = cleaning.encounter_keys(types)
    rows = cleaning.clean_encounters(types, cleaning.patient_sequence(keys), cleaning.fences(keys))
    t["cln_encounters"] = write_table(rows, f"{fresh_folder(spark)}/cln_encounters")
    refresh.model(t, fresh_folder(spark))
    return t


def test_dimensions(tables):
    ages = tables["dim_age_group"].orderBy("age_key").collect()
    assert [tuple(r) for r in ages] == [(1, "60-70", 65), (2, "70-80", 75)]
    patients = {r.patient_nbr: r for r in tables["dim_patient"].collect()}
    assert (patients[1].race, patients[1].first_age_group, patients[1].n_encounters) == ("Caucasian", "70-80", 2)
    assert patients[3].n_encounters == 1


def test_both_ways_to_the_medication_fact(tables):
    carried = sorted(tables["fact_encounter_medication"].collect())
    joined = star.join_medication_fact(tables["cln_encounter_medications"], tables["dim_medication"], tables["fact_encounter"])
    assert carried == sorted(joined.collect()) and len(carried) == 2


def test_denominators(tables):
    row = kpis.headline(tables["fact_encounter"]).first()
    assert (row.encounters_total, row.patients_total, row.eligible_encounters, row.readmits_30d) == (5, 4, 4, 2)
    assert (row.readmit_30d_pct, row.readmit_30d_pct_all_encounters, row.med_change_pct) == (50.0, 40.0, 0.0)
    assert row.readmit_30d_pct_first_encounter == 66.67


def test_unknown_discharge_shows_only_where_its_label_is_not_needed(tables):
    by_discharge = kpis.kpi_table(tables, "a_readmit_by_discharge")
    assert {r.discharge_group: r.encounters for r in by_discharge.collect()} == {"Home": 3, "Expired": 1}
    assert sum(r.encounters for r in kpis.kpi_table(tables, "a_readmit_by_age").collect()) == 4


def test_change_rate_ignores_unknown_flags(tables):
    rows = {r.a1c_result: r.med_change_pct for r in kpis.kpi_table(tables, "a_readmit_by_a1c").collect()}
    assert rows == {"Not measured": 0.0, ">7": None}


@pytest.mark.parametrize("name", list(kpis.RATE_TABLES))
def test_shared_scan_equals_single_scan(tables, name):
    parts = kpis.rate_parts(tables)
    shared, single = kpis.rate_table_from_parts(tables, parts, name), kpis.rate_table(tables, name)
    assert shared.columns == single.columns and sorted(map(str, shared.collect())) == sorted(map(str, single.collect()))


def test_medication_minimum_is_a_parameter(tables):
    assert kpis.by_medication(tables).count() == 0
    assert {r.medication for r in kpis.by_medication(tables, min_rows=1).collect()} == {"metformin", "insulin"}


def test_issues_and_assertions(tables):
    issues = {r.check_name: r.affected_rows for r in ledgers.issues(tables).collect()}
    assert issues["encounters: rows dropped in cleaning"] == 1
    assert issues["encounters: gender Unknown/Invalid (dropped)"] == 1
    assert issues["encounters: discharge id not in IDS_mapping"] == 1
    checks = {r.check_name: (r.failed_rows, r.status) for r in ledgers.assertions(tables).collect()}
    assert len(checks) == 12
    failing = {name for name, (_, status) in checks.items() if status == "FAIL"}
    assert failing == {"fact_encounter.discharge_disposition_id -> dim_discharge_disposition"}
    assert tuple(pass_summary(ledgers.assertions(tables)).first()) == (11, 12)


def test_seeded_lookups_must_stand_in_the_file(tables):
    short = tables | {"stg_ids_mapping": tables["stg_ids_mapping"].where("description <> 'Elective'")}
    checks = {r.check_name: r.failed_rows for r in ledgers.assertions(short).collect()}
    assert checks["seeded lookup rows exist verbatim in IDS_mapping.csv"] == 1


def test_row_counts_and_null_rates(tables):
    counts = {r.entity: r for r in ledgers.row_counts(tables).collect()}
    assert tuple(counts["encounters"])[1:4] == (6, 6, 5) and counts["dim_patient"].raw_rows is None
    rates = {r.column_name: (r.raw_missing_pct, r.clean_null_pct) for r in ledgers.null_rates(tables).collect()}
    assert rates["weight"] == (100.0, 100.0) and rates["diag_1"] == (16.67, 20.0) and rates["A1Cresult"] == (83.33, 80.0)


def test_measures_count_each_patient_once(tables):
    row = reports.measures(tables).first()
    assert (row.encounters, row.patients, row.eligible_encounters) == (5, 4, 4)
    assert row.readmit_30d_vs_overall == 0.0
    by_race = {r.race: r for r in reports.measures(tables, [], ["race"]).collect()}
    assert by_race["Caucasian"].encounters == 5  # the race at the first encounter


def test_encounter_filter_reaches_the_drugs_and_back(tables):
    drugs = {r.medication: r.drug_encounters for r in reports.drug_measures(tables).collect()}
    assert drugs == {"metformin": 1, "insulin": 1}
    some = reports.drug_measures(tables, "discharge_disposition_id = 31").collect()
    assert [(r.medication, r.drug_readmit_30d_rate) for r in some] == [("insulin", 1.0)]
    assert [r.encounter_id for r in reports.encounters_on_drug(tables, "metformin").collect()] == [1]


def test_secondary_diagnosis_role(tables):
    rows = {r.diag_group: r.encounters for r in reports.measures(tables, ["diag_group"], diagnosis_key="secondary_diag_group_key").collect()}
    assert rows == {"Diabetes": 4, "Missing": 1}


def test_documents_are_valid_json(spark, tables):
    root = fresh_folder(spark)
    full = dict(tables)
    refresh.analyse(full, root)
    refresh.check(full, root)
    metrics = json.loads(documents.metrics(full).first().document)
    assert metrics["kpis"]["encounters_total"] == 5 and len(metrics["data_quality"]["assertions"]) == 12
    snapshot = json.loads(documents.snapshot(full).first().document)
    assert list(snapshot["readmit_30d_pct_by_age"]) == ["60-70", "70-80"]
    assert snapshot["assertions_passed"] == 11 and snapshot["medications_by_readmit_30d_pct"] == []
