"""Code maps of the cleaning stage.

FIXED VALUES: keys and outputs below must equal the source workflow's maps
exactly; unknown values pass through unchanged (single-pass replacement).
"""

# Case status, after strip + upper. The LCA variant also knows the
# "certified withdrawn" spellings; the PERM variant does not.
STATUS_MAP_LCA = {
    "CERTIFIED": "Certified",
    "CERTIFIED-EXPIRED": "Certified - Expired",
    "CERTIFIED - EXPIRED": "Certified - Expired",
    "CERTIFIED-WITHDRAWN": "Certified - Withdrawn",
    "CERTIFIED - WITHDRAWN": "Certified - Withdrawn",
    "DENIED": "Denied",
    "WITHDRAWN": "Withdrawn",
    "INVALIDATED": "Invalidated",
}
STATUS_MAP_PERM = {
    "CERTIFIED": "Certified",
    "CERTIFIED-EXPIRED": "Certified - Expired",
    "CERTIFIED - EXPIRED": "Certified - Expired",
    "DENIED": "Denied",
    "WITHDRAWN": "Withdrawn",
    "INVALIDATED": "Invalidated",
}
STATUS_NULLS = ("NAN", "")

# Visa class, after strip (case kept).
VISA_CLASS_MAP = {
    "R": "H-1B",
    "A": "E-3 Australian",
    "S": "H-1B1 Singapore",
    "C": "H-1B1 Chile",
}
VISA_CLASS_NULLS = ("NAN", "nan", "")

# Pay unit, after strip, exact case.
PAY_UNIT_MAP = {
    "yr": "Year", "YEAR": "Year", "year": "Year",
    "hr": "Hour", "HOUR": "Hour", "hour": "Hour",
    "mth": "Month", "MONTH": "Month", "month": "Month",
    "wk": "Week", "WEEK": "Week", "week": "Week",
    "bi": "Bi-Weekly", "BI-WEEKLY": "Bi-Weekly", "BI": "Bi-Weekly",
    "bi-weekly": "Bi-Weekly",
}
PAY_UNIT_NULLS = ("nan", "NAN", "")

# Yes/no flags, after strip.
YES_NO_MAP = {
    "Y": "Yes", "N": "No",
    "y": "Yes", "n": "No",
    "YES": "Yes", "NO": "No",
    "1": "Yes", "0": "No",
    "1.0": "Yes", "0.0": "No",
}
YES_NO_NULLS = ("nan", "NAN", "")

# Upper-cased free text (form type, visa type of the permanent program).
UPPER_TEXT_NULLS = ("NAN", "")
