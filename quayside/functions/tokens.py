"""Fixed values that must equal the reader being replaced."""

# The strings a default pandas ``read_csv`` turns into a missing
# value (pandas 2.x defaults, in its own sorted order).  The empty string is
# included.  ``none``, ``Null``, ``-`` and `` NA`` are *not* tokens.
PANDAS_NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The fill value written for every missing cell before load, and
# the audit columns the loader stamps itself.
SENTINEL = "-"
AUDIT_COLUMNS = ("created_at", "updated_at")
# A journal table's own bookkeeping: the name of the file that wrote a row.  Batch
# and streamed loads both write it; it is never a required column.
SOURCE_FILE = "_source_file"

# The required columns of the legacy (routed) claims load, in the
# order that load lists them.  Any the file lacks is added as "-"; the flag
# column is computed, never filled.
LEGACY_CLAIMS_REQUIRED = (
    "talon", "report_period", "source", "account_number", "upload_date", "status",
    "talon_type", "goal", "patient", "birth_date", "gender", "policy", "smo_code", "enp",
    "treatment_start", "treatment_end", "doctor", "doctor_profile", "staff_position",
    "department", "care_conditions", "medical_assistance_type", "disease_type", "main_disease_character",
    "visits", "mo_visits", "home_visits", "case_code", "main_diagnosis", "additional_diagnosis",
    "mp_profile", "bed_profile", "dispensary_monitoring", "specialty", "outcome", "result",
    "operator", "initial_input_date", "last_change_date", "amount", "sanctions", "ksg", "uet",
    "additional_status_info", "is_complex",
)
