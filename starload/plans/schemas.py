"""Declared columns of every table, and fixed code lists."""

from __future__ import annotations

# Columns of the raw declarations file. Codes are text so that leading zeros survive.
RAW = """
    fema_declaration_string string, declaration_request_number bigint, state string,
    declaration_type string, declaration_date string, fy_declared int, incident_type string,
    declaration_title string, ih_program_declared int, ia_program_declared int,
    pa_program_declared int, hm_program_declared int, incident_begin_date string,
    incident_end_date string, disaster_closeout_date string, fips string, place_code string,
    last_ia_filing_date string, hash string, id string, last_refresh string
"""

# Raw columns that cleaning drops.
RAW_UNUSED = [
    "disaster_closeout_date",
    "last_ia_filing_date",
    "hash",
    "id",
    "fema_declaration_string",
    "fy_declared",
    "place_code",
    "last_refresh",
]

CLEAN = """
    state_name string, county_name string, incident_type string, declaration_title string,
    declaration_type string, declaration_date date, declaration_request_number bigint,
    incident_begin_date date, incident_end_date date, incident_duration bigint,
    ih_program_declared boolean, ia_program_declared boolean, pa_program_declared boolean,
    hm_program_declared boolean, deaths bigint
"""

STATE = "id bigint, state_name string"
COUNTY = "id bigint, county_name string, state_fk bigint"
DISASTER = "id bigint, incident_type string"
DECLARATION = """
    id bigint, declaration_title string, declaration_type string, declaration_date date,
    declaration_request_number bigint, incident_begin_date date, incident_end_date date,
    incident_duration bigint, ih_program_declared boolean, ia_program_declared boolean,
    pa_program_declared boolean, hm_program_declared boolean, deaths bigint,
    disaster_fk bigint, county_fk bigint
"""

STAGING = [
    "state_name",
    "county_name",
    "incident_type",
    "declaration_request_number",
    "incident_begin_date",
    "incident_end_date",
    "incident_duration",
    "deaths",
]

FLAGS = [
    "ih_program_declared",
    "ia_program_declared",
    "hm_program_declared",
    "pa_program_declared",
]

# Names of the state and territory codes, as the cleaned data spells them.
STATE_NAMES = {
    "AK": "Alaska",
    "AL": "Alabama",
    "AR": "Arkansas",
    "AS": "Amarican Samoa",
    "AZ": "Arizona",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DC": "Washington D.C.",
    "DE": "Delaware",
    "FL": "Florida",
    "FM": "Federal States of Micronesia",
    "GA": "Georgia",
    "GM": "Guam",
    "GU": "Guam",
    "HI": "Hawaii",
    "IA": "Iowa",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "MA": "Massachusetts",
    "MD": "Maryland",
    "ME": "Maine",
    "MH": "Republic of the Marshall Islands",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MO": "Missouri",
    "MP": "Commonwealth of the Nothern Mariana Islands",
    "MS": "Mississippi",
    "MT": "Montana",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "NE": "Nebraska",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NV": "Nevada",
    "NY": "New York",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "PR": "Puerto Rico",
    "PW": "Republic of Palau",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VA": "Virginia",
    "VI": "Virgin Islands",
    "VT": "Vermont",
    "WA": "Washington",
    "WI": "Wisconsin",
    "WV": "West Virginia",
    "WY": "Wyoming",
}

# Names of the declaration types.
DECLARATION_TYPES = {
    "DR": "Velika katastrofa",
    "EM": "Upravljanje hitnim situacijama",
    "FM": "Upravljanje požarom",
}
