"""Raw text encounters to typed, deduplicated, enriched encounters."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisit.functions import cleaning as C
from revisit.operators.keys import keep_first, sequence
from revisit.operators.quantiles import upper_fences
from revisit.operators.reshape import to_long
from revisit.plans import vocabulary as V
from revisit.sources.literals import sql_list

MARKED = ["payer_code", "medical_specialty", "diag_1", "diag_2", "diag_3"]
WHOLE = [
    "admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital",
    "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "number_diagnoses",
]
OUTLIER_COLUMNS = ["num_medications", "num_lab_procedures"]
MED_COLUMNS = {name: f"med_{name}" for name in V.DRUG_NAMES}
DOSE_LETTERS = {"No": "N", "Steady": "S", "Up": "U", "Down": "D"}

CLEAN_COLUMNS = [
    "encounter_id", "patient_nbr", "patient_encounter_seq", "is_first_encounter", "race", "gender", "age_group",
    "age_mid", "weight_band", "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "los_band", "payer_code", "medical_specialty", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency", "number_inpatient", "prior_inpatient_band",
    "prior_visits_total", "diag_1", "diag_2", "diag_3", "diag_1_group", "diag_2_group", "diag_3_group",
    "number_diagnoses", "max_glu_serum", "a1c_result", *MED_COLUMNS.values(), "n_diabetes_meds", "n_meds_changed",
    "med_change_flag", "diabetes_med_flag", "insulin_flag", "readmitted", "readmit_30d_flag", "readmit_any_flag",
    "is_readmit_eligible", "is_num_meds_outlier", "is_num_labs_outlier", "dq_missing_weight", "dq_missing_race",
]


def compact(raw: DataFrame) -> DataFrame:
    """Missing markers to NULL, tolerant casts, standard labels. One projection, no shuffle.

    The 23 drug columns travel as one text with a letter per drug, in ``doses``. That halves the
    width of the rows that are sorted and shuffled, and the drug counts become text lengths.
    """
    rules = {
        "encounter_id": C.whole_number("encounter_id", "BIGINT"),
        "patient_nbr": C.whole_number("patient_nbr", "BIGINT"),
        "race": C.relabel(C.null_if_marker("race"), V.RACE_NAMES),
        "gender": C.keep_allowed("gender", V.GENDERS),
        "age_group": C.interval("age"),
        "weight_band": C.strip_interval(C.null_if_marker("weight")),
    }
    rules |= {name: C.whole_number(name) for name in WHOLE}
    rules |= {name: C.null_if_marker(name) for name in MARKED}
    rules["max_glu_serum"] = C.label_if_marker("max_glu_serum", V.NOT_MEASURED, V.NOT_MEASURED_MARKERS)
    rules["a1c_result"] = C.label_if_marker("A1Cresult", V.NOT_MEASURED, V.NOT_MEASURED_MARKERS)
    rules["doses"] = C.pack(V.DRUG_NAMES, DOSE_LETTERS)
    rules["med_change_flag"] = C.two_way_flag("change", "Ch", "No")
    rules["diabetes_med_flag"] = C.two_way_flag("diabetesMed", "Yes", "No")
    rules["readmitted"] = C.keep_allowed("readmitted", V.READMITTED)
    return raw.selectExpr(*[f"{rule} AS {name}" for name, rule in rules.items()])


def unpacked() -> dict[str, str]:
    """Rules for the drug columns from ``doses``."""
    return {med: C.unpack("doses", i, DOSE_LETTERS) for i, med in enumerate(MED_COLUMNS.values(), start=1)}


def typed(raw: DataFrame) -> DataFrame:
    """As :func:`compact`, with one column per drug."""
    rows = compact(raw)
    meds = [f"{rule} AS {med}" for med, rule in unpacked().items()]
    at = rows.columns.index("doses")
    return rows.selectExpr(*rows.columns[:at], *meds, *rows.columns[at + 1 :])


def preference() -> list[Column]:
    """Which copy of an encounter stays: known patient first, then the smallest values."""
    return [F.col("patient_nbr").isNull(), F.col("patient_nbr"), *[F.col(c).asc_nulls_first() for c in OUTLIER_COLUMNS]]


def copy_order(types: DataFrame) -> Column:
    """Order among copies that :func:`preference` can't tell apart, the same for compact and typed rows.

    A hash of all values and of which are NULL, with the drug columns as their packed text.
    """
    meds = list(MED_COLUMNS.values())
    doses = F.col("doses") if "doses" in types.columns else F.expr(C.pack(meds, DOSE_LETTERS))
    others = sorted(set(types.columns) - {"encounter_id", "doses", *meds})
    unknown = reduce(add, [F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(others)])
    return F.xxhash64(doses, unknown, *others)


def deduplicated(types: DataFrame) -> DataFrame:
    return keep_first(types, "encounter_id", preference(), copy_order(types))


def encounter_keys(types: DataFrame) -> DataFrame:
    """The four numbers of each kept encounter that order patients and set outlier fences.

    The same choice as :func:`deduplicated`, as a map-side combined minimum over four columns. It
    spares the wide rows a second shuffle for the patient order.
    """
    picked = F.min(F.struct(F.col("patient_nbr").isNull().alias("unknown"), "patient_nbr", *OUTLIER_COLUMNS))
    return (
        types.where(F.col("encounter_id").isNotNull())
        .groupBy("encounter_id")
        .agg(picked.alias("p"))
        .select("encounter_id", *[F.col(f"p.{c}").alias(c) for c in ["patient_nbr", *OUTLIER_COLUMNS]])
    )


def patient_sequence(keys: DataFrame, **limits: int) -> DataFrame:
    """Position of each encounter among those of its patient, before any integrity filter."""
    known = keys.where(F.col("patient_nbr").isNotNull()).select("encounter_id", "patient_nbr")
    return sequence(known, "patient_nbr", "encounter_id", "patient_encounter_seq", **limits)


def fences(keys: DataFrame, exact: bool = True) -> DataFrame:
    return upper_fences(keys, OUTLIER_COLUMNS, reach=3.0, exact=exact)


def with_code_numbers(rows: DataFrame) -> DataFrame:
    """The numeric part of the diagnosis codes, parsed once for all range tests; NULL for V and E codes."""
    return rows.selectExpr("*", *[f"{C.decimal_number(f'diag_{i}')} AS diag_{i}_num" for i in (1, 2, 3)])


def diagnosis_group(i: int) -> str:
    return C.code_group(
        f"diag_{i}", f"diag_{i}_num", V.DIAGNOSIS_PREFIXES, V.DIAGNOSIS_RANGES, V.DIAGNOSIS_MISSING, V.DIAGNOSIS_OTHER
    )


def derived() -> dict[str, str]:
    """Bands, groups, counts and flags, from typed columns, code numbers, patient order and fences."""
    rules = unpacked() | {
        "is_first_encounter": C.flag("patient_encounter_seq = 1"),
        "age_mid": C.interval_middle("age_group", 5),
        "los_band": C.band("time_in_hospital", V.LOS_BANDS, V.LOS_LONGEST),
        "prior_inpatient_band": C.exact_band("number_inpatient", [0, 1, 2], "3+"),
        "prior_visits_total": "number_outpatient + number_emergency + number_inpatient",
        "n_diabetes_meds": C.count_packed("doses", V.PRESCRIBED, DOSE_LETTERS),
        "n_meds_changed": C.count_packed("doses", V.DOSE_CHANGED, DOSE_LETTERS),
        "insulin_flag": C.flag(f"{unpacked()['med_insulin']} IN {sql_list(V.PRESCRIBED)}"),
        "readmit_30d_flag": C.flag("readmitted = '<30'"),
        "readmit_any_flag": C.flag("readmitted IN ('<30', '>30')"),
        "is_readmit_eligible": eligible("discharge_disposition_id"),
        "is_num_meds_outlier": C.flag("num_medications > fence.num_medications_fence"),
        "is_num_labs_outlier": C.flag("num_lab_procedures > fence.num_lab_procedures_fence"),
        "dq_missing_weight": C.flag("weight_band IS NULL"),
        "dq_missing_race": C.flag("race IS NULL"),
    }
    return rules | {f"diag_{i}_group": diagnosis_group(i) for i in (1, 2, 3)}


def eligible(discharge: str) -> str:
    """0 after a discharge that rules out readmission, else 1; an unknown id counts as eligible."""
    return f"CASE WHEN {discharge} IN {sql_list(V.NOT_ELIGIBLE_DISCHARGES)} THEN 0 ELSE 1 END"


def integrity() -> str:
    """Rows that can be analysed: known patient, outcome, gender, age and ids, stay of 1 to 14 days."""
    needed = [
        "patient_nbr", "readmitted", "gender", "age_group",
        "admission_type_id", "discharge_disposition_id", "admission_source_id",
    ]
    low, high = V.STAY_DAYS
    return " AND ".join([*[f"{name} IS NOT NULL" for name in needed], f"time_in_hospital BETWEEN {low} AND {high}"])


def rejected(types: DataFrame) -> DataFrame:
    """Kept copies that fail the integrity rule; an unknown value fails it."""
    return deduplicated(types).where(f"NOT coalesce({integrity()}, false)")


def clean_encounters(rows: DataFrame, order: DataFrame, fence: DataFrame) -> DataFrame:
    """One row per analysable encounter, from :func:`compact` rows.

    ``order`` and ``fence`` come from :func:`patient_sequence` and :func:`fences`, that is from
    before the integrity filter. The wide rows are shuffled once, by encounter; the order joins on
    that same partitioning, and the one-row fences arrive as a scalar.
    """
    kept = with_code_numbers(deduplicated(rows).where(integrity()))
    limits = fence.select(F.struct(*[f"{c}_fence" for c in OUTLIER_COLUMNS])).scalar()
    rules = derived()
    return (
        kept.join(order.select("encounter_id", "patient_encounter_seq"), "encounter_id")
        .withColumn("fence", limits)
        .selectExpr(*[f"{rules[name]} AS {name}" if name in rules else name for name in CLEAN_COLUMNS])
    )


def medications_long(clean: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per encounter and prescribed drug; ``carry`` adds encounter columns to each row."""
    columns = {med: name for name, med in MED_COLUMNS.items()}
    return to_long(clean, ["encounter_id", *carry], columns, "medication", "dose_status", V.PRESCRIBED)
