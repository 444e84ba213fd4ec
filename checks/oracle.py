"""The same tables as DuckDB SQL, written independently of the Spark plans.

Every query is a chain of named subqueries that ends in one SELECT. The subqueries start from the
driver's ``orders`` table, as the Spark side does.
"""

from __future__ import annotations

from checks.encounters import lookup_lines, raw_sql
from revisit.plans import vocabulary as V
from revisit.plans.cleaning import CLEAN_COLUMNS
from revisit.plans.star import FACT_COLUMNS


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def numbers(values) -> str:
    return ", ".join(str(v) for v in values)


def literal_rows(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else quoted([v]) for v in row) + ")" for row in rows)


def pct(numerator: str, denominator: str) -> str:
    """Percentage with two decimals, half up, in whole numbers."""
    d = f"CAST({denominator} AS HUGEINT)"
    return f"CAST((20000 * CAST({numerator} AS HUGEINT) + {d}) // nullif(2 * {d}, 0) AS DOUBLE) / 100.0"


def avg2(column: str, where: str = "") -> str:
    """Mean with two decimals, half up, in whole numbers."""
    keep = f" FILTER (WHERE {where})" if where else ""
    n = f"CAST(count({column}){keep} AS HUGEINT)"
    return f"CAST((200 * CAST(sum({column}){keep} AS HUGEINT) + {n}) // nullif(2 * {n}, 0) AS DOUBLE) / 100.0"


def known_pct(flag: str) -> str:
    return pct(f"sum({flag})", f"count({flag})")


RAW = raw_sql(rename=True)


def _typed() -> str:
    def marked(c: str, name: str | None = None) -> str:
        return f"nullif(nullif(trim({c}), '?'), '') AS {name or c}"

    def measured(c: str, name: str) -> str:
        return f"if(trim({c}) IN ('None', '?', ''), 'Not measured', trim({c})) AS {name}"

    whole = [
        "admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital", "num_lab_procedures",
        "num_procedures", "num_medications", "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
    ]
    columns = [
        "TRY_CAST(encounter_id AS BIGINT) AS encounter_id",
        "TRY_CAST(patient_nbr AS BIGINT) AS patient_nbr",
        "replace(nullif(nullif(trim(race), '?'), ''), 'AfricanAmerican', 'African American') AS race",
        "if(trim(gender) IN ('Male', 'Female'), trim(gender), NULL) AS gender",
        "if(starts_with(trim(age), '[') AND ends_with(trim(age), ')'), trim(trim(age), '[)'), NULL) AS age_group",
        "trim(nullif(nullif(trim(weight), '?'), ''), '[)') AS weight_band",
        *[f"TRY_CAST({c} AS INTEGER) AS {c}" for c in whole],
        *[marked(c) for c in ("payer_code", "medical_specialty", "diag_1", "diag_2", "diag_3")],
        measured("max_glu_serum", "max_glu_serum"),
        measured("A1Cresult", "a1c_result"),
        *[f"if(trim({d}) IN ('No', 'Steady', 'Up', 'Down'), trim({d}), NULL) AS med_{d}" for d in V.DRUG_NAMES],
        "CAST(CASE trim(change) WHEN 'Ch' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS med_change_flag",
        "CAST(CASE trim(diabetesMed) WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS diabetes_med_flag",
        "if(trim(readmitted) IN ('<30', '>30', 'NO'), trim(readmitted), NULL) AS readmitted",
    ]
    return f"SELECT {', '.join(columns)} FROM raw"


KEPT = """SELECT * FROM typed WHERE encounter_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY encounter_id
  ORDER BY patient_nbr NULLS LAST, num_medications NULLS FIRST, num_lab_procedures NULLS FIRST) = 1"""
NUMBERED = """SELECT encounter_id, patient_nbr,
  CAST(row_number() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) AS BIGINT) AS patient_encounter_seq
FROM kept WHERE patient_nbr IS NOT NULL"""
BOUNDS = """SELECT quantile_cont(num_medications, 0.25) AS m1, quantile_cont(num_medications, 0.75) AS m3,
  quantile_cont(num_lab_procedures, 0.25) AS l1, quantile_cont(num_lab_procedures, 0.75) AS l3 FROM kept"""

CHAPTERS = """SELECT * FROM (VALUES
  ('Circulatory', 390, 460), ('Circulatory', 785, 786), ('Respiratory', 460, 520), ('Respiratory', 786, 787),
  ('Digestive', 520, 580), ('Digestive', 787, 788), ('Genitourinary', 580, 630), ('Genitourinary', 788, 789),
  ('Injury', 800, 1000), ('Musculoskeletal', 710, 740), ('Neoplasms', 140, 240)) AS t(chapter, low, high)"""
# Every code in use with its group: the codes are few, the ranges do not overlap.
CODES = """SELECT code, CASE
    WHEN code[1] IN ('V', 'E') THEN 'Other'
    WHEN starts_with(code, '250') THEN 'Diabetes'
    ELSE coalesce((SELECT min(chapter) FROM chapters
                   WHERE TRY_CAST(code AS DOUBLE) >= low AND TRY_CAST(code AS DOUBLE) < high), 'Other') END AS chapter
FROM (SELECT diag_1 AS code FROM kept UNION SELECT diag_2 FROM kept UNION SELECT diag_3 FROM kept) u WHERE code IS NOT NULL"""


def _clean() -> str:
    n_in = lambda values: " + ".join(f"coalesce(CAST(med_{d} IN ({values}) AS INTEGER), 0)" for d in V.DRUG_NAMES)
    special = {
        "is_first_encounter": "CAST(n.patient_encounter_seq = 1 AS INTEGER)",
        "patient_encounter_seq": "n.patient_encounter_seq",
        "encounter_id": "k.encounter_id",
        "patient_nbr": "k.patient_nbr",
        "age_mid": "TRY_CAST(string_split(age_group, '-')[1] AS INTEGER) + 5",
        "los_band": """CASE WHEN time_in_hospital BETWEEN 1 AND 2 THEN '01: 1-2 days' WHEN time_in_hospital BETWEEN 3 AND 4
            THEN '02: 3-4 days' WHEN time_in_hospital BETWEEN 5 AND 7 THEN '03: 5-7 days' ELSE '04: 8-14 days' END""",
        "prior_inpatient_band": "if(number_inpatient BETWEEN 0 AND 2, CAST(number_inpatient AS VARCHAR), '3+')",
        "prior_visits_total": "number_outpatient + number_emergency + number_inpatient",
        "n_diabetes_meds": n_in("'Steady', 'Up', 'Down'"),
        "n_meds_changed": n_in("'Up', 'Down'"),
        "insulin_flag": "coalesce(CAST(med_insulin <> 'No' AS INTEGER), 0)",
        "readmit_30d_flag": "CAST(readmitted = '<30' AS INTEGER)",
        "readmit_any_flag": "CAST(readmitted <> 'NO' AS INTEGER)",
        "is_readmit_eligible": "CAST(discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21) AS INTEGER)",
        "is_num_meds_outlier": "coalesce(CAST(num_medications > m3 + 3 * (m3 - m1) AS INTEGER), 0)",
        "is_num_labs_outlier": "coalesce(CAST(num_lab_procedures > l3 + 3 * (l3 - l1) AS INTEGER), 0)",
        "dq_missing_weight": "CAST(weight_band IS NULL AS INTEGER)",
        "dq_missing_race": "CAST(race IS NULL AS INTEGER)",
    }
    special |= {f"diag_{i}_group": f"coalesce(c{i}.chapter, 'Missing')" for i in (1, 2, 3)}
    columns = [f"{special[c]} AS {c}" if c in special else c for c in CLEAN_COLUMNS]
    joins = " ".join(f"LEFT JOIN codes c{i} ON diag_{i} = c{i}.code" for i in (1, 2, 3))
    return f"""SELECT {', '.join(columns)} FROM kept k JOIN numbered n ON n.encounter_id = k.encounter_id {joins}, bounds
WHERE time_in_hospital >= 1 AND time_in_hospital <= 14 AND readmitted IS NOT NULL AND gender IS NOT NULL
  AND age_group IS NOT NULL AND admission_type_id IS NOT NULL AND discharge_disposition_id IS NOT NULL
  AND admission_source_id IS NOT NULL"""


def _long() -> str:
    renamed = ", ".join(f"med_{d} AS {d}" for d in V.DRUG_NAMES)
    return f"""SELECT encounter_id, medication, dose_status
FROM (SELECT encounter_id, {renamed} FROM clean) UNPIVOT (dose_status FOR medication IN ({', '.join(V.DRUG_NAMES)}))
WHERE dose_status <> 'No'"""


def _types() -> str:
    return f"""SELECT admission_type_id, description,
  if(description IN ('NULL', 'Not Available', 'Not Mapped'), 'Unknown', description) AS admission_type
FROM (VALUES {literal_rows(V.ADMISSION_TYPES)}) AS t(admission_type_id, description)"""


def _grouped_ids(rows, key: str, groups, other: str, name: str, extra: str = "") -> str:
    members = literal_rows((i, label) for label, ids in groups.items() for i in ids)
    return f"""SELECT t.id AS {key}, t.description, coalesce(g.label, '{other}') AS {name}{extra}
FROM (VALUES {literal_rows(rows)}) AS t(id, description) LEFT JOIN (VALUES {members}) AS g(id, label) ON g.id = t.id"""


def _fact() -> str:
    special = {
        "primary_diag_group_key": "p.diag_group_key",
        "secondary_diag_group_key": "s.diag_group_key",
        "age_key": "a.age_key",
        "insulin_status": "e.med_insulin",
    }
    columns = ", ".join(f"{special.get(c, 'e.' + c)} AS {c}" for c in FACT_COLUMNS)
    return f"""SELECT {columns} FROM clean e JOIN dim_age a ON a.age_group = e.age_group
JOIN dim_diag p ON p.diag_group = e.diag_1_group JOIN dim_diag s ON s.diag_group = e.diag_2_group"""


def _lookups() -> str:
    rows = []
    for line in lookup_lines()[1:]:
        left, right = line.split(",", 1)
        right = right.strip('"')
        rows.append(f"({quoted([left]) if left else 'NULL'}, {quoted([right]) if right else 'NULL'})")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t(admission_type_id, description)"


TABLES = {
    "raw": RAW,
    "typed": _typed(),
    "kept": KEPT,
    "numbered": NUMBERED,
    "bounds": BOUNDS,
    "chapters": CHAPTERS,
    "codes": CODES,
    "clean": _clean(),
    "meds": _long(),
    "dim_type": _types(),
    "dim_discharge": _grouped_ids(
        V.DISCHARGES, "discharge_disposition_id", V.DISCHARGE_GROUPS, "Unknown", "discharge_group",
        ", CAST(t.id NOT IN (11, 13, 14, 19, 20, 21) AS INTEGER) AS is_readmit_eligible",
    ),
    "dim_source": _grouped_ids(V.ADMISSION_SOURCES, "admission_source_id", V.SOURCE_GROUPS, "Other", "admission_source_group"),
    "dim_drug": f"""SELECT * FROM (VALUES {literal_rows((i, n, c) for i, (n, c) in enumerate(V.DRUGS, start=1))})
AS t(medication_key, medication, drug_class)""",
    "dim_age": """SELECT CAST(dense_rank() OVER (ORDER BY age_mid NULLS LAST, age_group) AS INTEGER) AS age_key, age_group, age_mid
FROM clean GROUP BY age_group, age_mid""",
    "dim_diag": """SELECT CAST(row_number() OVER (ORDER BY diag_group) AS INTEGER) AS diag_group_key, diag_group
FROM (SELECT DISTINCT unnest([diag_1_group, diag_2_group, diag_3_group]) AS diag_group FROM clean)""",
    "dim_patient": """SELECT f.patient_nbr, f.race, f.gender, f.age_group AS first_age_group, n.n_encounters
FROM (SELECT patient_nbr, CAST(count(*) AS BIGINT) AS n_encounters, min(encounter_id) AS first_id FROM clean GROUP BY patient_nbr) n
JOIN clean f ON f.encounter_id = n.first_id""",
    "fact": _fact(),
    "fact_med": """SELECT m.encounter_id, d.medication_key, m.dose_status, f.readmit_30d_flag, f.readmit_any_flag,
  f.is_readmit_eligible FROM meds m JOIN dim_drug d USING (medication) JOIN fact f USING (encounter_id)""",
    "elig": "SELECT * FROM fact WHERE is_readmit_eligible = 1",
    "lookups": _lookups(),
}


def sql(select: str, **extra: str) -> str:
    """``select`` after the table chain; ``extra`` adds subqueries before it."""
    chain = ",\n".join(f"{name} AS ({body})" for name, body in {**TABLES, **extra}.items())
    return f"WITH {chain}\n{select}"


COUNT = "CAST(count(*) AS BIGINT) AS encounters"
READMITS = "CAST(sum(readmit_30d_flag) AS BIGINT) AS readmits_30d"
RATE_30D = f"{known_pct('readmit_30d_flag')} AS readmit_30d_pct"
RATE_ANY = f"{known_pct('readmit_any_flag')} AS readmit_any_pct"
STAY = f"{avg2('time_in_hospital')} AS avg_los_days"


def _headline() -> str:
    big = lambda e, n: f"CAST({e} AS BIGINT) AS {n}"
    e = "WHERE is_readmit_eligible = 1"
    first = "WHERE is_readmit_eligible = 1 AND is_first_encounter = 1"
    share = lambda c, n: f"{pct(f'count(*) FILTER (WHERE {c})', 'count(*)')} AS {n}"
    columns = [
        big("count(*)", "encounters_total"),
        big("count(DISTINCT patient_nbr)", "patients_total"),
        big(f"count(*) FILTER ({e})", "eligible_encounters"),
        big(f"sum(readmit_30d_flag) FILTER ({e})", "readmits_30d"),
        f"{pct(f'sum(readmit_30d_flag) FILTER ({e})', f'count(*) FILTER ({e})')} AS readmit_30d_pct",
        f"{pct(f'sum(readmit_any_flag) FILTER ({e})', f'count(*) FILTER ({e})')} AS readmit_any_pct",
        f"{pct('sum(readmit_30d_flag)', 'count(*)')} AS readmit_30d_pct_all_encounters",
        f"{pct(f'sum(readmit_30d_flag) FILTER ({first})', f'count(*) FILTER ({first})')} AS readmit_30d_pct_first_encounter",
        STAY,
        f"{avg2('num_medications')} AS avg_num_medications",
        f"{avg2('num_lab_procedures')} AS avg_num_lab_procedures",
        share("med_change_flag = 1", "med_change_pct"),
        share("diabetes_med_flag = 1", "on_diabetes_med_pct"),
        share("insulin_flag = 1", "on_insulin_pct"),
        share("a1c_result <> 'Not measured'", "a1c_tested_pct"),
        share("number_inpatient > 0", "prior_inpatient_pct"),
    ]
    return f"SELECT {', '.join(columns)} FROM fact"


KPIS = {
    "a_kpi_headline": _headline(),
    "a_readmit_by_age": f"""SELECT age_group, age_mid, {COUNT}, {READMITS}, {RATE_30D}, {RATE_ANY}, {STAY}
FROM elig JOIN dim_age USING (age_key) GROUP BY ALL""",
    "a_readmit_by_diagnosis": f"""SELECT diag_group AS primary_diagnosis_group, {COUNT},
{pct('count(*)', '(SELECT count(*) FROM elig)')} AS share_pct, {READMITS}, {RATE_30D}, {RATE_ANY}, {STAY}
FROM elig JOIN dim_diag ON diag_group_key = primary_diag_group_key GROUP BY diag_group""",
    "a_readmit_top_diag_codes": f"""SELECT diag_1, {COUNT}, {RATE_30D} FROM elig WHERE diag_1 IS NOT NULL
GROUP BY diag_1 ORDER BY count(*) DESC, diag_1 LIMIT 15""",
    "a_readmit_by_los": f"""SELECT time_in_hospital AS los_days, los_band, {COUNT}, {READMITS}, {RATE_30D}, {RATE_ANY}
FROM elig GROUP BY time_in_hospital, los_band""",
    "a_readmit_by_los_band": f"""SELECT los_band, {COUNT}, {READMITS}, {RATE_30D},
{avg2('num_medications')} AS avg_num_medications FROM elig GROUP BY los_band""",
    "a_readmit_by_medication": f"""SELECT medication, drug_class, CAST(count(*) AS BIGINT) AS encounters_prescribed,
CAST(count(*) FILTER (WHERE dose_status <> 'Steady') AS BIGINT) AS encounters_dose_changed, {READMITS}, {RATE_30D}
FROM fact_med JOIN dim_drug USING (medication_key) WHERE is_readmit_eligible = 1
GROUP BY medication, drug_class HAVING count(*) >= 500""",
    "a_readmit_by_insulin": f"SELECT insulin_status, {COUNT}, {RATE_30D} FROM elig GROUP BY insulin_status",
    "a_readmit_by_med_change": f"""SELECT if(diabetes_med_flag = 1, 'On diabetes med', 'No diabetes med') AS diabetes_med,
if(med_change_flag = 1, 'Changed', 'Not changed') AS med_change, {COUNT}, {RATE_30D} FROM elig GROUP BY 1, 2""",
    "a_readmit_by_n_meds": f"""SELECT if(n_diabetes_meds < 3, CAST(n_diabetes_meds AS VARCHAR), '3+') AS n_diabetes_meds,
{COUNT}, {RATE_30D} FROM elig GROUP BY 1""",
    "a_readmit_by_prior_inpatient": f"""SELECT prior_inpatient_band, {COUNT}, {READMITS}, {RATE_30D}
FROM elig GROUP BY prior_inpatient_band""",
    "a_readmit_by_a1c": f"""SELECT a1c_result, {COUNT}, {RATE_30D}, {known_pct('med_change_flag')} AS med_change_pct
FROM elig GROUP BY a1c_result""",
    "a_readmit_by_discharge": f"""SELECT discharge_group, {COUNT}, {READMITS}, {RATE_30D}
FROM fact JOIN dim_discharge USING (discharge_disposition_id) GROUP BY discharge_group""",
    "a_readmit_by_admission_type": f"""SELECT admission_type, {COUNT}, {RATE_30D}
FROM elig JOIN dim_type USING (admission_type_id) GROUP BY admission_type""",
    "a_patient_utilisation": f"""SELECT if(n_encounters < 5, CAST(n_encounters AS VARCHAR), '5+') AS encounters_per_patient,
CAST(count(*) AS BIGINT) AS patients, CAST(sum(n_encounters) AS BIGINT) AS encounters,
{pct('sum(n_encounters)', '(SELECT sum(n_encounters) FROM dim_patient)')} AS encounter_share_pct FROM dim_patient GROUP BY 1""",
}

ROW_COUNTS = """SELECT 'encounters' AS entity, (SELECT count(*) FROM raw) AS raw_rows,
  (SELECT count(DISTINCT encounter_id) FROM raw) AS distinct_keys, (SELECT count(*) FROM clean) AS clean_rows, 'encounter_id' AS grain
""" + "\n".join(
    f"UNION ALL SELECT '{entity}', NULL, NULL, (SELECT count(*) FROM {table}), '{grain}'"
    for entity, table, grain in [
        ("encounter_medications", "meds", "encounter x prescribed drug"),
        ("fact_encounter", "fact", "encounter"),
        ("fact_encounter_medication", "fact_med", "encounter x drug"),
        ("dim_patient", "dim_patient", "patient_nbr"),
        ("dim_age_group", "dim_age", "age decade"),
        ("dim_diagnosis_group", "dim_diag", "ICD-9 group"),
        ("dim_admission_type", "dim_type", "admission_type_id"),
        ("dim_discharge_disposition", "dim_discharge", "discharge_disposition_id"),
        ("dim_admission_source", "dim_source", "admission_source_id"),
        ("dim_medication", "dim_drug", "drug"),
    ]
)


def _null_rates() -> str:
    rules = [
        ("weight", "weight = '?'", "weight_band IS NULL", "kept as NULL (97% missing - not used for analysis)"),
        ("payer_code", "payer_code = '?'", "payer_code IS NULL", "kept as NULL"),
        ("medical_specialty", "medical_specialty = '?'", "medical_specialty IS NULL", "kept as NULL"),
        ("race", "race = '?'", "race IS NULL", "kept as NULL"),
        ("diag_1", "diag_1 = '?'", "diag_1 IS NULL", "NULL -> diagnosis group Missing"),
        ("A1Cresult", "A1Cresult = 'None'", "a1c_result = 'Not measured'", "'None' means test not done -> category Not measured"),
    ]
    share = lambda c, t: f"(SELECT {pct(f'count(*) FILTER (WHERE {c})', 'count(*)')} FROM {t})"
    return "\nUNION ALL ".join(
        f"SELECT 'encounters' AS entity, '{name}' AS column_name, {share(raw, 'raw')} AS raw_missing_pct, "
        f"{share(clean, 'clean')} AS clean_null_pct, {quoted([text])} AS treatment"
        for name, raw, clean, text in rules
    )


ISSUES = "\nUNION ALL ".join(
    f"SELECT '{name}' AS check_name, CAST(({count}) AS BIGINT) AS affected_rows"
    for name, count in {
        "encounters: duplicate encounter_id (extras dropped)": "SELECT count(*) - count(DISTINCT encounter_id) FROM raw",
        "encounters: gender Unknown/Invalid (dropped)": "SELECT count(*) FROM raw WHERE gender NOT IN ('Male', 'Female')",
        "encounters: rows dropped in cleaning": "SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM clean)",
        "encounters: expired / hospice discharge (excluded from readmission rates)": "SELECT count(*) FROM clean WHERE is_readmit_eligible = 0",
        "encounters: repeat encounters of the same patient": "SELECT count(*) FROM clean WHERE is_first_encounter = 0",
        "encounters: num_medications outlier (> Q3 + 3*IQR, kept)": "SELECT sum(is_num_meds_outlier) FROM clean",
        "encounters: num_lab_procedures outlier (> Q3 + 3*IQR, kept)": "SELECT sum(is_num_labs_outlier) FROM clean",
        "encounters: diag_1 is a V/E supplementary code": "SELECT count(*) FROM clean WHERE left(diag_1, 1) IN ('V', 'E')",
        "encounters: discharge id not in IDS_mapping": "SELECT count(*) FROM clean ANTI JOIN dim_discharge USING (discharge_disposition_id)",
        "encounters: patients with > 1 encounter": "SELECT count(*) FROM dim_patient WHERE n_encounters > 1",
    }.items()
)
ASSERTIONS = (
    "SELECT check_name, failed_rows, if(failed_rows = 0, 'PASS', 'FAIL') AS status FROM ("
    + "\nUNION ALL ".join(
        f"SELECT '{name}' AS check_name, CAST(({count}) AS BIGINT) AS failed_rows"
        for name, count in {
            "fact_encounter.encounter_id unique": "SELECT count(*) - count(DISTINCT encounter_id) FROM fact",
            "fact_encounter rows = cln_encounters rows": "SELECT abs((SELECT count(*) FROM fact) - (SELECT count(*) FROM clean))",
            "fact_encounter.patient_nbr -> dim_patient": "SELECT count(*) FROM fact ANTI JOIN dim_patient USING (patient_nbr)",
            "fact_encounter.admission_type_id -> dim_admission_type": "SELECT count(*) FROM fact ANTI JOIN dim_type USING (admission_type_id)",
            "fact_encounter.discharge_disposition_id -> dim_discharge_disposition": "SELECT count(*) FROM fact ANTI JOIN dim_discharge USING (discharge_disposition_id)",
            "fact_encounter.admission_source_id -> dim_admission_source": "SELECT count(*) FROM fact ANTI JOIN dim_source USING (admission_source_id)",
            "fact_encounter_medication.medication_key -> dim_medication": "SELECT count(*) FROM fact_med ANTI JOIN dim_drug USING (medication_key)",
            "seeded lookup rows exist verbatim in IDS_mapping.csv": """SELECT count(*) FROM (
                SELECT admission_type_id AS id, description FROM dim_type UNION ALL SELECT discharge_disposition_id, description FROM dim_discharge
                UNION ALL SELECT admission_source_id, description FROM dim_source) s WHERE (CAST(id AS VARCHAR), description) NOT IN
                (SELECT (trim(admission_type_id), trim(description)) FROM lookups WHERE admission_type_id IS NOT NULL)""",
            "readmitted in {<30, >30, NO}": "SELECT count(*) FROM fact WHERE readmitted NOT IN ('<30', '>30', 'NO')",
            "time_in_hospital between 1 and 14": "SELECT count(*) FROM fact WHERE time_in_hospital < 1 OR time_in_hospital > 14",
            "readmit_30d_flag <= readmit_any_flag": "SELECT count(*) FROM fact WHERE readmit_30d_flag > readmit_any_flag",
            "non-negative visit / medication counts": "SELECT count(*) FROM fact WHERE least(num_medications, number_inpatient, number_emergency, number_outpatient) < 0",
        }.items()
    )
    + ")"
)
QUALITY = {
    "dq_row_counts": ROW_COUNTS,
    "dq_null_rates": _null_rates(),
    "dq_issues": ISSUES,
    "dq_assertions": ASSERTIONS,
}
