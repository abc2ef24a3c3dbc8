"""Fixed values shared by the jobs.

These are data values, patterns and labels that the results depend on; they are
listed here, together and in natural order, so that no job hides one.
"""

from __future__ import annotations

# The state the records are limited to.
HOME_STATE = "Colorado"
HOME_STATE_CODE = "CO"
COUNTY_AREA_TYPE = 4
ROLLUP_AREAS = ["Colorado", "United States"]

# Year range of the county-year table, and of the calendar.
FIRST_YEAR = 1997
LAST_YEAR = 2024
CALENDAR_START = "1997-01-01"
CALENDAR_END_EXCLUSIVE = "2025-01-01"

# Labels of the two incident periods.
EARLY_PERIOD = "1997_2015"
LATE_PERIOD = "2016_2020"

# Whom an offense is against, and the "no area" marker.
CRIME_AGAINST = ["Property", "Person", "Society"]
UNSPECIFIED_COUNTY = "not specified"
COUNTY_LEVEL = "[County Level]"
UNKNOWN = "Unknown"

# Ranked offense categories and the column each one pivots into.
CRIME_CATEGORIES = {
    "Destruction/Damage/Vandalism of Property": "property_destruction_tier",
    "Burglary/Breaking & Entering": "burglary_tier",
    "Larceny/Theft Offenses": "larceny_theft_tier",
    "Motor Vehicle Theft": "vehicle_theft_tier",
    "Robbery": "robbery_tier",
    "Arson": "arson_tier",
    "Stolen Property Offenses": "stolen_property_tier",
}

# Income type code and the column it pivots into.
INCOME_TYPES = {
    2: "median_household_income",
    1: "per_capita_income",
    3: "total_personal_income",
}

# Agency-name rewrites, applied in this order, ignoring case.
AGENCY_REWRITES = [
    (r"\bDrug Enforcement Team\b", "Drug Task Force"),
    (r"\s+Police Department\b", ""),
    (r"\s+County Sheriff('s Office)?\b", ""),
    (r"\s+Sheriff('s Office)?\b", ""),
]

# A lower-case text that each agency-name rewrite needs, in the same order.
AGENCY_REWRITE_WORDS = ["drug enforcement team", "police department", "sheriff", "sheriff"]

# County-name rewrites, applied in this order to lower-case text.
COUNTY_REWRITES = [
    (r",\s*(co|colorado)\s*$", ""),
    (r"\s+county\s*$", ""),
    (r"\s+", " "),
]

# Fixed value: characters after which a word starts, besides white space.
WORD_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"

# Fixed value: a five-digit zip code with an optional four-digit suffix.
ZIP_PATTERN = r"\A\d{5}(-\d{4})?\z"

# Hours counted as day, both ends included.
DAY_HOURS = (6, 17)

# Percentile at which each tier starts.
TIER_STEPS = [(0.75, 4), (0.50, 3), (0.25, 2)]

# Business tier labels and the lowest tier that qualifies.
TIER_LABELS = {
    4: "Tier 4 - Maximum Subsidy",
    3: "Tier 3 - Enhanced Subsidy",
    2: "Tier 2 - Standard Subsidy",
    1: "Tier 1 - Basic Review",
}
UNRANKED_LABEL = "Unranked"
QUALIFYING_TIER = 3
GOOD_STANDING = "Good Standing"

# Wording of the lookup message; {program} and {contact} are filled in.
TIER_MESSAGES = {
    4: "Your business qualifies for Maximum Security Subsidy under the {program} program.",
    3: "Your business qualifies for Enhanced Security Subsidy under the {program} program.",
    2: "Your business qualifies for Standard review under the {program} program.",
    1: "Your business is eligible for Basic Review under the {program} program.",
}
UNASSIGNED_MESSAGE = "Tier not yet assigned. Please contact {contact}."

# Fixed value: share of incidents an agency keeps when it meets its 5% target.
REDUCTION_TARGET = "0.95"

# The columns of an entity whose change opens a new version.
VERSIONED_COLUMNS = [
    "entity_status",
    "principal_zip_code",
    "principal_city",
    "entity_name",
    "entity_type",
]

# Text that stands for a missing value in seed files.
NULL_TOKENS = ["NULL", "null", ""]

# Fixed value: most rows a name search returns, plus one to tell "more".
SEARCH_ROWS = 101

# Names of months and, from Sunday, of week days.
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
WEEKDAYS = [
    "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
]
