"""Fixed values of the readmission model: source columns, domains, labels, lookups."""

from __future__ import annotations

from revisit.functions.cleaning import CodeRange

# The 23 drugs in source order, with their class. The position is the drug's key.
DRUGS = [
    ("metformin", "Biguanide"),
    ("repaglinide", "Meglitinide"),
    ("nateglinide", "Meglitinide"),
    ("chlorpropamide", "Sulfonylurea"),
    ("glimepiride", "Sulfonylurea"),
    ("acetohexamide", "Sulfonylurea"),
    ("glipizide", "Sulfonylurea"),
    ("glyburide", "Sulfonylurea"),
    ("tolbutamide", "Sulfonylurea"),
    ("pioglitazone", "Thiazolidinedione"),
    ("rosiglitazone", "Thiazolidinedione"),
    ("acarbose", "Alpha-glucosidase inhibitor"),
    ("miglitol", "Alpha-glucosidase inhibitor"),
    ("troglitazone", "Thiazolidinedione"),
    ("tolazamide", "Sulfonylurea"),
    ("examide", "Other (examide)"),
    ("citoglipton", "Other (citoglipton)"),
    ("insulin", "Insulin"),
    ("glyburide_metformin", "Combination"),
    ("glipizide_metformin", "Combination"),
    ("glimepiride_pioglitazone", "Combination"),
    ("metformin_rosiglitazone", "Combination"),
    ("metformin_pioglitazone", "Combination"),
]
DRUG_NAMES = [name for name, _ in DRUGS]

# Header of the raw encounter file. Combination drugs are written with a hyphen there.
RAW_DRUG_COLUMNS = [name.replace("_", "-") for name in DRUG_NAMES]
RAW_COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight",
    "admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital",
    "payer_code", "medical_specialty", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "diag_1", "diag_2", "diag_3",
    "number_diagnoses", "max_glu_serum", "A1Cresult", *RAW_DRUG_COLUMNS, "change", "diabetesMed", "readmitted",
]
HYPHENATED = {raw: name for raw, name in zip(RAW_DRUG_COLUMNS, DRUG_NAMES) if raw != name}
LOOKUP_COLUMNS = ["admission_type_id", "description"]

# Domains and labels.
GENDERS = ["Male", "Female"]
DOSES = ["No", "Steady", "Up", "Down"]
PRESCRIBED = ["Steady", "Up", "Down"]
DOSE_CHANGED = ["Up", "Down"]
READMITTED = ["<30", ">30", "NO"]
RACE_NAMES = {"AfricanAmerican": "African American"}
NOT_MEASURED = "Not measured"
NOT_MEASURED_MARKERS = ["None", "?", ""]
STAY_DAYS = (1, 14)
LOS_BANDS = [(2, "01: 1-2 days"), (4, "02: 3-4 days"), (7, "03: 5-7 days")]
LOS_LONGEST = "04: 8-14 days"
LOS_LABELS = [label for _, label in LOS_BANDS] + [LOS_LONGEST]
MEDICATION_MIN_ROWS = 500
TOP_CODES = 15

# Diagnosis groups by ICD-9 code, first match wins.
DIAGNOSIS_MISSING = "Missing"
DIAGNOSIS_OTHER = "Other"
DIAGNOSIS_PREFIXES = [("V", "Other"), ("E", "Other"), ("250", "Diabetes")]
DIAGNOSIS_RANGES = [
    CodeRange("Circulatory", 390, 460, 785),
    CodeRange("Respiratory", 460, 520, 786),
    CodeRange("Digestive", 520, 580, 787),
    CodeRange("Genitourinary", 580, 630, 788),
    CodeRange("Injury", 800, 1000),
    CodeRange("Musculoskeletal", 710, 740),
    CodeRange("Neoplasms", 140, 240),
]

# Admission types.
ADMISSION_TYPES = [
    (1, "Emergency"),
    (2, "Urgent"),
    (3, "Elective"),
    (4, "Newborn"),
    (5, "Not Available"),
    (6, "NULL"),
    (7, "Trauma Center"),
    (8, "Not Mapped"),
]
UNKNOWN_ADMISSION_TYPES = ["NULL", "Not Available", "Not Mapped"]

# Discharge dispositions, their groups, and those after which no readmission can follow.
DISCHARGES = [
    (1, "Discharged to home"),
    (2, "Discharged/transferred to another short term hospital"),
    (3, "Discharged/transferred to SNF"),
    (4, "Discharged/transferred to ICF"),
    (5, "Discharged/transferred to another type of inpatient care institution"),
    (6, "Discharged/transferred to home with home health service"),
    (7, "Left AMA"),
    (8, "Discharged/transferred to home under care of Home IV provider"),
    (9, "Admitted as an inpatient to this hospital"),
    (10, "Neonate discharged to another hospital for neonatal aftercare"),
    (11, "Expired"),
    (12, "Still patient or expected to return for outpatient services"),
    (13, "Hospice / home"),
    (14, "Hospice / medical facility"),
    (15, "Discharged/transferred within this institution to Medicare approved swing bed"),
    (16, "Discharged/transferred/referred another institution for outpatient services"),
    (17, "Discharged/transferred/referred to this institution for outpatient services"),
    (18, "NULL"),
    (19, "Expired at home. Medicaid only, hospice."),
    (20, "Expired in a medical facility. Medicaid only, hospice."),
    (21, "Expired, place unknown. Medicaid only, hospice."),
    (22, "Discharged/transferred to another rehab fac including rehab units of a hospital ."),
    (23, "Discharged/transferred to a long term care hospital."),
    (24, "Discharged/transferred to a nursing facility certified under Medicaid but not certified under Medicare."),
    (25, "Not Mapped"),
    (26, "Unknown/Invalid"),
    (27, "Discharged/transferred to a federal health care facility."),
    (28, "Discharged/transferred/referred to a psychiatric hospital of psychiatric distinct part unit of a hospital"),
    (29, "Discharged/transferred to a Critical Access Hospital (CAH)."),
    (30, "Discharged/transferred to another Type of Health Care Institution not Defined Elsewhere"),
]
DISCHARGE_GROUPS = {
    "Expired": [11, 19, 20, 21],
    "Hospice": [13, 14],
    "Home": [1],
    "Home with health service": [6, 8],
    "Skilled nursing / rehab / long-term care": [3, 4, 15, 22, 23, 24, 27, 30],
    "Other hospital / institution": [2, 5, 9, 10, 12, 16, 17, 28, 29],
    "Left AMA": [7],
}
DISCHARGE_OTHER = "Unknown"
NOT_ELIGIBLE_DISCHARGES = [11, 13, 14, 19, 20, 21]

# Admission sources and their groups. Id 16 does not exist.
ADMISSION_SOURCES = [
    (1, "Physician Referral"),
    (2, "Clinic Referral"),
    (3, "HMO Referral"),
    (4, "Transfer from a hospital"),
    (5, "Transfer from a Skilled Nursing Facility (SNF)"),
    (6, "Transfer from another health care facility"),
    (7, "Emergency Room"),
    (8, "Court/Law Enforcement"),
    (9, "Not Available"),
    (10, "Transfer from critial access hospital"),
    (11, "Normal Delivery"),
    (12, "Premature Delivery"),
    (13, "Sick Baby"),
    (14, "Extramural Birth"),
    (15, "Not Available"),
    (17, "NULL"),
    (18, "Transfer From Another Home Health Agency"),
    (19, "Readmission to Same Home Health Agency"),
    (20, "Not Mapped"),
    (21, "Unknown/Invalid"),
    (22, "Transfer from hospital inpt/same fac reslt in a sep claim"),
    (23, "Born inside this hospital"),
    (24, "Born outside this hospital"),
    (25, "Transfer from Ambulatory Surgery Center"),
    (26, "Transfer from Hospice"),
]
SOURCE_GROUPS = {
    "Referral": [1, 2, 3],
    "Emergency room": [7],
    "Transfer": [4, 5, 6, 10, 18, 19, 22, 25, 26],
    "Unknown": [9, 15, 17, 20, 21],
}
SOURCE_OTHER = "Other"
