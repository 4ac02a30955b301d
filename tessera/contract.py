"""The stacked-cube contract: names, domains and fixed values.

Everything here is a *fixed value* shared by the Spark code and the DuckDB
oracle SQL; changing one side without the other breaks the correctness gate.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Grains, geographies, sexes, bands, footnote text.
# ---------------------------------------------------------------------------
GRAIN_MONTH = "By Month"
GRAIN_YEAR = "By Year"
GRAIN_TOTAL = "By Total"
GRAINS = [GRAIN_MONTH, GRAIN_YEAR, GRAIN_TOTAL]

GEO_ALL = "ALL"  # national role: every row
GEO_NESTED = "NATION_0 BUILDING"  # overlapping sub-geography role
NESTED_PARENT = "NATION_0"
NESTED_SEGMENT = "BUILDING"
GEO_EXCLUDED = [GEO_ALL, GEO_NESTED]  # removed from the geography domain

SEX_ALL = "All"
SEXES = ["All", "F", "O"]  # All, then l_linestatus values
SEX_PARTS = ["F", "O"]

BAND_ALL = "All Bands"
# (label, lowest quantity, highest quantity), in declared order.
EXCLUSIVE_BANDS = [
    ("1", 1, 1),
    ("2-4", 2, 4),
    ("5-9", 5, 9),
    ("10-14", 10, 14),
    ("15-19", 15, 19),
    ("20-24", 20, 24),
    ("25-29", 25, 29),
    ("30-34", 30, 34),
    ("35-39", 35, 39),
    ("40-44", 40, 44),
    ("45-50", 45, 50),
]
OVERLAP_BANDS = [
    ("alt 1-9", 1, 9),
    ("alt 10-17", 10, 17),
    ("alt 18-29", 18, 29),
    ("alt 30-39", 30, 39),
    ("alt 40-49", 40, 49),
]
SENIOR_BANDS = ["35-39", "40-44", "45-50"]
EXCLUSIVE_BAND_LABELS = [b[0] for b in EXCLUSIVE_BANDS]
ALL_BAND_LABELS = [BAND_ALL] + EXCLUSIVE_BAND_LABELS + [b[0] for b in OVERLAP_BANDS]

# Measure predicates on lineitem (roles: a=primary cause, b=secondary cause,
# overlap=a and b, c=third cause, union_cnt=a or b or c, total=all rows).
RETURNFLAG_A = "R"
DISCOUNT_B_MIN = 0.05
TAX_C_MIN = 0.06

SUPPRESS_LO, SUPPRESS_HI = 1, 9
FOOTNOTE = "One or more counts between 1 and 9 were suppressed."
AS_OF_LAG_DAYS = 4

# Source text header (16 columns, in file order) -> clean column name.
SOURCE_HEADER = [
    "Data As Of",
    "Start Date",
    "End Date",
    "Group",
    "Year",
    "Month",
    "Geo",
    "Sex",
    "Band",
    "A Count",
    "Total Count",
    "B Count",
    "A and B Count",
    "C Count",
    "A, B, or C Count",
    "Footnote",
]
RENAME = {
    "Data As Of": "data_as_of",
    "Start Date": "start_date",
    "End Date": "end_date",
    "Group": "grain",
    "Year": "year",
    "Month": "month",
    "Geo": "geo",
    "Sex": "sex",
    "Band": "band",
    "A Count": "a",
    "Total Count": "total",
    "B Count": "b",
    "A and B Count": "overlap",
    "C Count": "c",
    "A, B, or C Count": "union_cnt",
    "Footnote": "footnote",
}
MEASURES = ["a", "total", "b", "overlap", "c", "union_cnt"]
DATE_COLS = ["data_as_of", "start_date", "end_date"]
KEY_COLS = ["grain", "year", "month", "geo", "sex", "band"]
SOURCE_KEY_HEADER = ["Group", "Year", "Month", "Geo", "Sex", "Band"]
TEXT_DATE_FORMAT = "MM/dd/yyyy"  # written form
TEXT_DATE_PARSE = "M/d/yyyy"  # read form: one or two digit month/day, four-digit year

# Strings pandas' CSV reader turns into missing values by default (public
# pandas documentation, read_csv na_values); the text scan mirrors them.
NA_TOKENS = [
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
]

# ---------------------------------------------------------------------------
# Modelling parameters (fixed values for the cube's calendar, 1995-01..2001-11)
# ---------------------------------------------------------------------------
MIDPOINT = 5.0
NAMED_MONTH = "1997-06-01"
BASE_YEAR = 1995
PROFILE_YEARS = (1995, 1996, 1997)  # middle year is the "second-year" share
TRAIN_END = "2000-01-01"  # train: start_date < TRAIN_END
TEST_START, TEST_END = "2000-01-01", "2001-10-01"  # closed range
FOLDS = [
    ("1998 H2", "1998-07-01", "1998-12-01"),
    ("1999 H1", "1999-01-01", "1999-06-01"),
    ("1999 H2", "1999-07-01", "1999-12-01"),
]
FIT_END = "1999-07-01"  # rows of fits with early stopping: start_date < FIT_END
VALID_START, VALID_END = "1999-07-01", "1999-12-01"

# Model parameters (fixed values)
KMEANS_KS = range(2, 9)
KMEANS_RESTARTS = 50  # per k in the sweep
KMEANS_FINAL_RESTARTS = 100  # for the chosen k; the sweep's fits of that k count
GBT_ROUNDS = 350
GBT_LEARNING_RATE = 0.05
GBT_DEPTH = 4
GBT_MIN_LEAF = 12
GBT_MAX_BINS = 256
GBT_EARLY_STOP_TOL = 0.01
# boosted trees on the log residual: name -> (rounds, learning rate, depth, smallest leaf, share of rows per tree)
RESIDUAL_TREES = {"regularized": (120, 0.05, 2, 12, 0.8), "unregularized": (60, 0.3, 6, 1, 1.0)}
STOP_PATIENCE = 20  # rounds without an improvement of more than STOP_MIN_DELTA end the fit
STOP_MIN_DELTA = 1e-5
HUBER_EPSILON = 1.35
HUBER_REG = 1e-3
SEED = 42

# Named slices: name, grain, geographies (None: the domain), sexes, bands.
SLICES = [
    ("national_monthly", GRAIN_MONTH, [GEO_ALL], [SEX_ALL], [BAND_ALL]),
    ("geo_totals", GRAIN_TOTAL, None, [SEX_ALL], [BAND_ALL]),
    ("national_bands", GRAIN_TOTAL, [GEO_ALL], [SEX_ALL], EXCLUSIVE_BAND_LABELS),
    ("national_sex_bands", GRAIN_TOTAL, [GEO_ALL], SEX_PARTS, EXCLUSIVE_BAND_LABELS),
    ("geo_monthly_panel", GRAIN_MONTH, None, [SEX_ALL], [BAND_ALL]),
]
