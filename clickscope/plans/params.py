"""Fixed parameters of the registered queries (shared by Spark plans and SQL oracles)."""

from clickscope.conditions import Condition

RUN_ID = "run-0001"
SAMPLE_SEED = "clickscope"
SAMPLE_SIZE = 1000
TARGET_FLOW = (1, 2, 3, 4, 5, 6, 7)
REMARK_TOP_CITIES = 3
VISITS_DATE = "2024-01-11"

FILTERS = {
    "filter_date_range": Condition(start_date="2024-01-05", end_date="2024-01-20"),
    "filter_age_range": Condition(start_age=20, end_age=40),
    "filter_professional_in": Condition(professionals=("BUILDING", "MACHINERY")),
    "filter_city": Condition(city=7),
    "filter_gender": Condition(gender="F"),
    "filter_keyword_in": Condition(keywords=("kw1", "kw3")),
    "filter_category_in": Condition(category_ids=(3, 5, 8)),
    "filter_combined": Condition(start_date="2024-01-03", end_date="2024-01-25", start_age=15, end_age=50,
                                 professionals=("AUTOMOBILE", "BUILDING", "FURNITURE"), gender="M"),
}

# The fixture's user table has market segments instead of the shop's four
# professions; the share report is pointed at four of them.
FIXTURE_PROFESSIONS = {
    "teacher_ratio": "HOUSEHOLD",
    "programmer_ratio": "MACHINERY",
    "PM_ratio": "AUTOMOBILE",
    "stu_ratio": "BUILDING",
}
