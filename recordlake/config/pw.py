"""Prevailing-wage program settings.

The alias map of this program is an input file with columns ORIGINAL and
FINAL_2025; pass its path to the plan. The target schema is read from the
newest vintage.

FIXED VALUES: headers ignored in the 2015 vintage; the target-schema year.
"""

IGNORED_COLUMNS_BY_YEAR = {
    2015: (
        "CASE_ASSIGNED_TO_ANALYST",
        "CASE_SENT_TO_CO_FOR_APPROVAL",
        "DATE_REDETERMINATION_RECEIVED",
        "VOIDED_DATE",
        "PW_TRACKING_NUMBER",
        "TYPE_DBA_SCA",
    ),
}

TARGET_SCHEMA_YEAR = 2025
MAPPING_SOURCE_COLUMN = "ORIGINAL"
MAPPING_TARGET_COLUMN = "FINAL_2025"
SOURCE_YEAR_COLUMN = "SOURCE_YEAR"
