"""The word lists and lookup tables the engine's results depend on."""

# Cells a CSV scan reads as null whatever the cleaning config says.
CSV_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Default tokens the cleaning step turns into null.
NULL_TOKENS = ["N/A", "n/a", "null", "NULL", "None", "none", "-", ""]

# Text that fills a null in a column without a type hint.
UNKNOWN = "Unknown"

# Every character the cleaning step strips from both ends of a string.
WHITESPACE = "".join(map(chr, [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
    0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))

# Country to sales region; any other country is OTHER_REGION.
REGIONS = {
    "Algeria": "North Africa",
    "Morocco": "North Africa",
    "Tunisia": "North Africa",
    "France": "Europe",
    "UK": "Europe",
    "Germany": "Europe",
    "Spain": "Europe",
    "USA": "North America",
}
OTHER_REGION = "Other"

# Countries whose customers are business customers.
B2B_COUNTRIES = ["USA", "UK", "Germany", "France"]

# Share of the mean unit price taken as cost.
COST_SHARE = 0.6

# First month of the fiscal year.
FISCAL_START = 7
