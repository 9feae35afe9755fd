"""Labour-condition program: canonical schema, header aliases, projections.

FIXED VALUES: all lists and maps below are the source workflow's, in its order.
"""

CANONICAL_COLUMNS = [
    "case_number", "case_status", "received_date", "decision_date", "original_cert_date", "visa_class",
    "job_title", "soc_code", "soc_title", "full_time_position", "begin_date", "end_date",
    "total_worker_positions",
    "new_employment", "continued_employment", "change_previous_employment", "new_concurrent_employment",
    "change_employer", "amended_petition",
    "employer_name", "trade_name_dba", "employer_address1", "employer_address2", "employer_city",
    "employer_state", "employer_postal_code", "employer_country", "employer_province", "employer_phone",
    "employer_phone_ext", "employer_fein", "naics_code", "employer_county",
    "employer_poc_last_name", "employer_poc_first_name", "employer_poc_middle_name", "employer_poc_job_title",
    "employer_poc_address1", "employer_poc_address2", "employer_poc_city", "employer_poc_state",
    "employer_poc_postal_code", "employer_poc_country", "employer_poc_province", "employer_poc_phone",
    "employer_poc_phone_ext", "employer_poc_email",
    "agent_representing_employer", "agent_attorney_last_name", "agent_attorney_first_name",
    "agent_attorney_middle_name", "agent_attorney_name", "agent_attorney_address1", "agent_attorney_address2",
    "agent_attorney_city", "agent_attorney_state", "agent_attorney_postal_code", "agent_attorney_country",
    "agent_attorney_province", "agent_attorney_phone", "agent_attorney_phone_ext",
    "agent_attorney_email_address", "lawfirm_name_business_name", "lawfirm_business_fein",
    "state_of_highest_court", "name_of_highest_state_court",
    "worksite_workers", "secondary_entity", "secondary_entity_business_name", "worksite_address1",
    "worksite_address2", "worksite_city", "worksite_county", "worksite_state", "worksite_postal_code",
    "wage_rate_of_pay_from", "wage_rate_of_pay_to", "wage_unit_of_pay",
    "prevailing_wage", "pw_unit_of_pay", "pw_tracking_number", "pw_wage_level", "pw_wage_source",
    "pw_oes_year", "pw_other_source", "pw_other_year", "pw_survey_publisher", "pw_survey_name",
    "total_worksite_locations", "agree_to_lc_statement", "h_1b_dependent", "willful_violator", "support_h1b",
    "statutory_basis", "appendix_a_attached", "public_disclosure",
    "withdrawn", "labor_con_agree", "masters_exemption", "certified_begin_date", "certified_end_date",
    "preparer_last_name", "preparer_first_name", "preparer_middle_initial", "preparer_business_name",
    "preparer_email",
    "year",
]

# Old header -> canonical header, in map order (first physical column wins).
ALIASES = {
    "case_no": "case_number",
    "lca_case_number": "case_number",
    "approval_status": "case_status",
    "status": "case_status",
    "submitted_date": "received_date",
    "lca_case_submit": "received_date",
    "case_submitted": "received_date",
    "dol_decision_date": "decision_date",
    "program": "visa_class",
    "program_designation": "visa_class",
    "job_code": "soc_code",
    "occupational_code": "soc_code",
    "lca_case_soc_code": "soc_code",
    "occupational_title": "soc_title",
    "soc_name": "soc_title",
    "lca_case_soc_name": "soc_title",
    "lca_case_job_title": "job_title",
    "full_time_pos": "full_time_position",
    "lca_case_employment_start_date": "begin_date",
    "employment_start_date": "begin_date",
    "period_of_employment_start_date": "begin_date",
    "lca_case_employment_end_date": "end_date",
    "employment_end_date": "end_date",
    "period_of_employment_end_date": "end_date",
    "nbr_immigrants": "total_worker_positions",
    "total_workers": "total_worker_positions",
    "new_concurrent_emp": "new_concurrent_employment",
    "name": "employer_name",
    "lca_case_employer_name": "employer_name",
    "employer_business_dba": "trade_name_dba",
    "address1": "employer_address1",
    "employer_address": "employer_address1",
    "lca_case_employer_address": "employer_address1",
    "lca_case_employer_address1": "employer_address1",
    "address2": "employer_address2",
    "lca_case_employer_address2": "employer_address2",
    "city": "employer_city",
    "lca_case_employer_city": "employer_city",
    "state": "employer_state",
    "lca_case_employer_state": "employer_state",
    "postal_code": "employer_postal_code",
    "lca_case_employer_postal_code": "employer_postal_code",
    "naic_code": "naics_code",
    "lca_case_naics_code": "naics_code",
    "employer_poc_address_1": "employer_poc_address1",
    "employer_poc_address_2": "employer_poc_address2",
    "agent_attorney_law_firm_business_name": "lawfirm_name_business_name",
    "city_1": "worksite_city",
    "state_1": "worksite_state",
    "lca_case_workloc1_city": "worksite_city",
    "lca_case_workloc1_state": "worksite_state",
    "work_location_city1": "worksite_city",
    "work_location_state1": "worksite_state",
    "worksite_workers_1": "worksite_workers",
    "secondary_entity_1": "secondary_entity",
    "secondary_entity_business_name_1": "secondary_entity_business_name",
    "worksite_address1_1": "worksite_address1",
    "worksite_address2_1": "worksite_address2",
    "worksite_city_1": "worksite_city",
    "worksite_county_1": "worksite_county",
    "worksite_state_1": "worksite_state",
    "worksite_postal_code_1": "worksite_postal_code",
    "wage_rate_1": "wage_rate_of_pay_from",
    "lca_case_wage_rate_from": "wage_rate_of_pay_from",
    "wage_rate_of_pay": "wage_rate_of_pay_from",
    "wage_rate_of_pay_from_1": "wage_rate_of_pay_from",
    "max_rate_1": "wage_rate_of_pay_to",
    "lca_case_wage_rate_to": "wage_rate_of_pay_to",
    "wage_rate_of_pay_to_1": "wage_rate_of_pay_to",
    "rate_per_1": "wage_unit_of_pay",
    "lca_case_wage_rate_unit": "wage_unit_of_pay",
    "wage_unit_of_pay_1": "wage_unit_of_pay",
    "prevailing_wage_1": "prevailing_wage",
    "pw_1": "prevailing_wage",
    "pw_unit_1": "pw_unit_of_pay",
    "pw_unit_of_pay_1": "pw_unit_of_pay",
    "pw_tracking_number_1": "pw_tracking_number",
    "pw_wage_level_1": "pw_wage_level",
    "wage_source_1": "pw_wage_source",
    "pw_source_1": "pw_wage_source",
    "pw_source": "pw_wage_source",
    "pw_wage_source": "pw_wage_source",
    "yr_source_pub_1": "pw_oes_year",
    "pw_source_year": "pw_oes_year",
    "pw_wage_source_year": "pw_oes_year",
    "pw_oes_year_1": "pw_oes_year",
    "other_wage_source_1": "pw_other_source",
    "pw_source_other": "pw_other_source",
    "pw_wage_source_other": "pw_other_source",
    "pw_other_source_1": "pw_other_source",
    "pw_non_oes_year_1": "pw_other_year",
    "pw_survey_publisher_1": "pw_survey_publisher",
    "pw_survey_name_1": "pw_survey_name",
    "h1b_dependent": "h_1b_dependent",
    "h_1b_dependent": "h_1b_dependent",
    "public_disclosure_location": "public_disclosure",
}

# Multi-site layout: columns with these prefixes whose last "_" token is an
# integer >= 2 are dropped (site 1 is kept through the aliases).
REPEAT_GROUP_PREFIXES = (
    "worksite_workers_", "secondary_entity_", "secondary_entity_business_name_",
    "worksite_address1_", "worksite_address2_",
    "worksite_city_", "worksite_county_", "worksite_state_", "worksite_postal_code_",
    "wage_rate_of_pay_from_", "wage_rate_of_pay_to_", "wage_unit_of_pay_",
    "prevailing_wage_", "pw_unit_of_pay_", "pw_tracking_number_",
    "pw_wage_level_", "pw_oes_year_", "pw_other_source_",
    "pw_non_oes_year_", "pw_survey_publisher_", "pw_survey_name_",
)

# Dual-site layout: columns ending "_2" with one of these prefixes are dropped.
SECOND_SITE_PREFIXES = (
    "wage_rate", "rate_per", "max_rate", "part_time",
    "city", "state", "prevailing_wage", "wage_source",
    "yr_source_pub", "other_wage_source",
    "pw", "pw_unit", "pw_source",
    "lca_case_workloc2", "work_location",
)

# Companion files that are not main data files.
COMPANION_FILE_MARKERS = ("appendix", "worksite")

# Cleaning stage: canonical column -> display name, in this order.
DISPLAY_COLUMNS = {
    "case_number": "Case Number",
    "case_status": "Status",
    "received_date": "Received Date",
    "decision_date": "Decision Date",
    "visa_class": "Visa Class",
    "year": "Fiscal Year",
    "job_title": "Job Title",
    "soc_code": "SOC Code",
    "soc_title": "SOC Title",
    "full_time_position": "Full Time",
    "begin_date": "Begin Date",
    "end_date": "End Date",
    "total_worker_positions": "Total Workers",
    "new_employment": "New Employment",
    "continued_employment": "Continued Employment",
    "change_previous_employment": "Change Previous Employment",
    "new_concurrent_employment": "New Concurrent Employment",
    "change_employer": "Change Employer",
    "amended_petition": "Amended Petition",
    "employer_name": "Employer Name",
    "employer_city": "Employer City",
    "employer_state": "Employer State",
    "employer_postal_code": "Employer Zip",
    "naics_code": "NAICS Code",
    "worksite_city": "Worksite City",
    "worksite_state": "Worksite State",
    "worksite_postal_code": "Worksite Zip",
    "wage_rate_of_pay_from": "Wage From",
    "wage_rate_of_pay_to": "Wage To",
    "wage_unit_of_pay": "Wage Unit",
    "prevailing_wage": "Prevailing Wage",
    "pw_unit_of_pay": "PW Unit",
    "pw_wage_level": "PW Wage Level",
    "h_1b_dependent": "H-1B Dependent",
    "willful_violator": "Willful Violator",
    "withdrawn": "Withdrawn",
}

# Cleaning stage: which display columns get which standardisation.
DATE_COLUMNS = ("Received Date", "Decision Date", "Begin Date", "End Date")
NUMBER_COLUMNS = ("Wage From", "Wage To", "Prevailing Wage")
PAY_UNIT_COLUMNS = ("Wage Unit", "PW Unit")
YES_NO_COLUMNS = ("Full Time", "H-1B Dependent", "Willful Violator", "Withdrawn")
INTEGER_COLUMNS = ("New Employment", "Continued Employment", "Change Previous Employment",
                   "New Concurrent Employment", "Change Employer", "Amended Petition")
TEXT_COLUMNS = ("Job Title", "SOC Code", "SOC Title", "Employer Name",
                "Employer City", "Employer State", "Employer Zip",
                "Worksite City", "Worksite State", "Worksite Zip",
                "PW Wage Level", "NAICS Code", "Case Number")

# Rows per batch of the first-batch dedupe.
DEDUPE_BATCH_ROWS = 200_000
