"""Permanent-certification program: header aliases and projections.

The canonical column list of this program (252 names) is an input, not shipped
here: pass it as ``schema=`` to the compile plan (one name per line in a text
file works with ``recordlake.sources.files.read_name_list``).

FIXED VALUES: the alias map below is the source workflow's, in its order. It is
walked sequentially; an entry whose old and new names are equal removes that
column under the literal policy (see ``operators.headers.alias_sequential_move``).
"""

ALIASES = [
    ("employer_name", "employer_name"),
    ("emp_business_name", "employer_name"),
    ("employer_address_1", "employer_addr1"),
    ("employer_address_2", "employer_addr2"),
    ("employer_city", "employer_city"),
    ("employer_state_province", "employer_state_province"),
    ("employer_postal_code", "employer_postal_code"),
    ("employer_country", "employer_country"),
    ("employer_phone", "employer_phone"),
    ("employer_phone_ext", "employer_phone_ext"),
    ("employer_num_employees", "employer_num_employees"),
    ("employer_year_commenced_business", "employer_year_commenced_business"),
    ("employer_fein", "employer_fein"),
    ("emp_addr1", "employer_addr1"),
    ("emp_addr2", "employer_addr2"),
    ("emp_city", "employer_city"),
    ("emp_state", "employer_state_province"),
    ("emp_postcode", "employer_postal_code"),
    ("emp_country", "employer_country"),
    ("emp_phone", "employer_phone"),
    ("emp_phoneext", "employer_phone_ext"),
    ("emp_fein", "employer_fein"),
    ("naics_code", "naics_code"),
    ("emp_naics", "naics_code"),
    ("emp_num_payroll", "employer_num_employees"),
    ("fw_ownership_interest", "fw_ownership_interest"),
    ("emp_worker_interest", "fw_ownership_interest"),
    ("emp_relationship_worker", "emp_relationship_worker"),
    ("emp_contact_name", "emp_contact_name"),
    ("emp_contact_address_1", "emp_contact_address_1"),
    ("emp_contact_address_2", "emp_contact_address_2"),
    ("emp_contact_city", "emp_contact_city"),
    ("emp_contact_state_province", "emp_contact_state_province"),
    ("emp_contact_country", "emp_contact_country"),
    ("emp_contact_postal_code", "emp_contact_postal_code"),
    ("emp_contact_phone", "emp_contact_phone"),
    ("emp_contact_email", "emp_contact_email"),
    ("emp_poc_last_name", "emp_poc_last_name"),
    ("emp_poc_first_name", "emp_poc_first_name"),
    ("emp_poc_middle_name", "emp_poc_middle_name"),
    ("emp_poc_job_title", "emp_poc_job_title"),
    ("emp_poc_addr1", "emp_poc_addr1"),
    ("emp_poc_addr2", "emp_poc_addr2"),
    ("emp_poc_city", "emp_poc_city"),
    ("emp_poc_state", "emp_poc_state"),
    ("emp_poc_postal_code", "emp_poc_postal_code"),
    ("emp_poc_country", "emp_poc_country"),
    ("emp_poc_province", "emp_poc_province"),
    ("emp_poc_phone", "emp_poc_phone"),
    ("emp_poc_phoneext", "emp_poc_phoneext"),
    ("emp_poc_email", "emp_poc_email"),
    ("agent_attorney_name", "agent_attorney_name"),
    ("agent_attorney_firm_name", "agent_attorney_firm_name"),
    ("agent_attorney_phone", "agent_attorney_phone"),
    ("agent_attorney_phone_ext", "agent_attorney_phone_ext"),
    ("agent_attorney_address_1", "agent_attorney_address_1"),
    ("agent_attorney_address_2", "agent_attorney_address_2"),
    ("agent_attorney_city", "agent_attorney_city"),
    ("agent_attorney_state_province", "agent_attorney_state_province"),
    ("agent_attorney_country", "agent_attorney_country"),
    ("agent_attorney_postal_code", "agent_attorney_postal_code"),
    ("agent_attorney_email", "agent_attorney_email"),
    ("atty_ag_rep_type", "atty_ag_rep_type"),
    ("atty_ag_last_name", "atty_ag_last_name"),
    ("atty_ag_first_name", "atty_ag_first_name"),
    ("atty_ag_middle_name", "atty_ag_middle_name"),
    ("atty_ag_address1", "atty_ag_address1"),
    ("atty_ag_address2", "atty_ag_address2"),
    ("atty_ag_city", "atty_ag_city"),
    ("atty_ag_state", "atty_ag_state"),
    ("atty_ag_postal_code", "atty_ag_postal_code"),
    ("atty_ag_country", "atty_ag_country"),
    ("atty_ag_province", "atty_ag_province"),
    ("atty_ag_phone", "atty_ag_phone"),
    ("atty_ag_phone_ext", "atty_ag_phone_ext"),
    ("atty_ag_email", "atty_ag_email"),
    ("atty_ag_law_firm_name", "atty_ag_law_firm_name"),
    ("atty_ag_fein", "atty_ag_fein"),
    ("atty_ag_state_bar_number", "atty_ag_state_bar_number"),
    ("atty_ag_good_standing_state", "atty_ag_good_standing_state"),
    ("atty_ag_good_standing_court", "atty_ag_good_standing_court"),
    ("pw_track_number", "pw_track_number"),
    ("pw_soc_code", "pw_soc_code"),
    ("pw_soc_title", "pw_soc_title"),
    ("pw_skill_level", "pw_skill_level"),
    ("pw_wage", "pw_wage"),
    ("pw_unit_of_pay", "pw_unit_of_pay"),
    ("pw_wage_source", "pw_wage_source"),
    ("pw_source_name_other", "pw_source_name_other"),
    ("pw_determination_date", "pw_determination_date"),
    ("pw_expiration_date", "pw_expiration_date"),
    ("job_opp_pwd_number", "pw_track_number"),
    ("job_opp_pwd_attached", "job_opp_pwd_attached"),
    ("job_opp_wage_from", "job_opp_wage_from"),
    ("job_opp_wage_to", "job_opp_wage_to"),
    ("job_opp_wage_per", "job_opp_wage_per"),
    ("job_opp_wage_conditions", "job_opp_wage_conditions"),
    ("wage_offer_from", "wage_offer_from"),
    ("wage_offer_to", "wage_offer_to"),
    ("wage_offer_unit_of_pay", "wage_offer_unit_of_pay"),
    ("worksite_address_1", "worksite_address_1"),
    ("worksite_address_2", "worksite_address_2"),
    ("worksite_city", "worksite_city"),
    ("worksite_state", "worksite_state"),
    ("worksite_postal_code", "worksite_postal_code"),
    ("primary_worksite_addr1", "primary_worksite_addr1"),
    ("primary_worksite_addr2", "primary_worksite_addr2"),
    ("primary_worksite_city", "primary_worksite_city"),
    ("primary_worksite_state", "primary_worksite_state"),
    ("primary_worksite_postal_code", "primary_worksite_postal_code"),
    ("primary_worksite_county", "primary_worksite_county"),
    ("primary_worksite_bls_area", "primary_worksite_bls_area"),
    ("primary_worksite_type", "primary_worksite_type"),
    ("is_multiple_locations", "is_multiple_locations"),
    ("is_appendix_b_attached", "is_appendix_b_attached"),
]

# Cleaning stage: canonical column -> display name, in this order.
DISPLAY_COLUMNS = {
    "case_number": "Case Number",
    "case_status": "Status",
    "decision_date": "Decision Date",
    "year": "Fiscal Year",
    "form_type": "Form Type",
    "class_of_admission": "Current Visa Type",
}

# Years up to this one use the old form unless a file name says otherwise.
LAST_OLD_FORM_YEAR = 2023
