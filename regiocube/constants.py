"""Fixed values that must equal the published statistical conventions.

Everything in this module is a FIXED VALUE (codes and labels defined by the
data provider's classifications); nothing here is logic.
"""

from __future__ import annotations

# --- FIXED VALUES: EU27 member codes (post-2020 composition, Greece = EL) ---
EU27 = (
    "AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "EL",
    "HU", "IE", "IT", "LV", "LT", "LU", "MT", "NL", "PL", "PT", "RO", "SK",
    "SI", "ES", "SE",
)

# --- FIXED VALUES: code of the published EU27 aggregate row ---
EU27_AGGREGATE = "EU27_2020"

# --- FIXED VALUES: LEVEL annotation -> nuts_level ---
LEVEL_NAMES = {"0": "country", "1": "NUTS1", "2": "NUTS2", "3": "NUTS3"}

# --- FIXED VALUES: IS_STANDARD_CODE annotation value of an obsolete code ---
OBSOLETE_CODE = "O"

# --- FIXED VALUES: aggregate citizenship codes that look like countries ---
CITIZEN_AGGREGATES = ("EU", "EA")

# --- FIXED VALUES: sex labels ---
SEX_LABELS = {"M": "Male", "F": "Female", "T": "Total"}

# --- FIXED VALUES: calendar month labels ---
MONTH_LABELS = {
    1: "January", 2: "February", 3: "March", 4: "April", 5: "May", 6: "June",
    7: "July", 8: "August", 9: "September", 10: "October", 11: "November",
    12: "December",
}

# --- FIXED VALUES: single-letter observation flags ---
FLAG_LABELS = {
    "b": "break in time series",
    "d": "definition differs (see metadata)",
    "e": "estimated",
    "f": "forecast",
    "m": "missing value; data cannot exist",
    "n": "not significant",
    "p": "provisional",
    "u": "low reliability",
}

# --- FIXED VALUES: frequency labels used by the cubes in this repo ---
FREQ_LABELS = {"A": "Annual", "Q": "Quarterly", "M": "Monthly"}

# Missing-cell marker in SDMX TSV bodies.
MISSING_CELL = ":"
