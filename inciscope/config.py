"""Domain configuration: column names, code lists, bounds.

Operators take these as arguments, so another domain only needs another config.
"""

from __future__ import annotations

# --- Fixed values: source header -> landing column ---------------------------------------------
INCIDENT_HEADERS = {
    "ID": "id",
    "Case Number": "case_number",
    "Date": "date",
    "Block": "block",
    "IUCR": "iucr",
    "Primary Type": "primary_type",
    "Description": "description",
    "Location Description": "location_description",
    "Arrest": "arrest",
    "Domestic": "domestic",
    "Beat": "beat",
    "District": "district",
    "Ward": "ward",
    "Community Area": "community_area",
    "FBI Code": "fbi_code",
    "X Coordinate": "x_coordinate",
    "Y Coordinate": "y_coordinate",
    "Year": "year",
    "Updated On": "updated_on",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Location": "location",
}
WARD_HEADERS = {"the_geom": "the_geom", "WARD": "ward", "SHAPE_Leng": "shape_leng", "SHAPE_Area": "shape_area"}
DISTRICT_HEADERS = {"the_geom": "the_geom", "DIST_LABEL": "dist_label", "DIST_NUM": "dist_num"}
AREA_HEADERS = {
    "the_geom": "the_geom",
    "AREA_NUMBE": "area_numbe",
    "COMMUNITY": "community",
    "AREA_NUM_1": "area_num_1",
    "SHAPE_AREA": "shape_area",
    "SHAPE_LEN": "shape_len",
}

# --- Fixed values: timestamp formats, each with a text pattern every parseable value has -------
TIMESTAMP_FORMATS = [
    ("MM/dd/yyyy hh:mm:ss a", "[AaPp][Mm]$"),
    ("M/d/yyyy H:mm", ":[0-9]{2}$"),
]

# --- Fixed values: coordinate text "(lat, lon)" ------------------------------------------------
LATITUDE_PATTERN = r"\(([^,]+),"
LONGITUDE_PATTERN = r",\s*([^)]+)\)"

# --- Fixed values: source file marker -> period label, first match wins ------------------------
SOURCE_PERIODS = [
    ("%2001%", "2001_2004"),
    ("%2005%", "2005_2007"),
    ("%2008%", "2008_2011"),
    ("%2012%", "2012_2017"),
]

# --- Fixed values: gate parameters -------------------------------------------------------------
YEAR_BOUNDS = (2001, 2017)
HEADER_WORDS = ["IUCR", "PRIMARY TYPE", "DESCRIPTION", "LOCATION DESCRIPTION", "FBI CODE"]
DELETED_AREA = 0
DELETED_DISTRICTS = [13, 21]

# --- Fixed values: offence code -> description -------------------------------------------------
OFFENCE_CODES = {
    "01A": "Homicide — Murder & Non-Negligent Manslaughter",
    "01B": "Homicide — Manslaughter by Negligence",
    "02": "Criminal Sexual Assault",
    "03": "Robbery",
    "04A": "Aggravated Assault",
    "04B": "Aggravated Battery",
    "05": "Burglary",
    "06": "Larceny / Theft",
    "07": "Motor Vehicle Theft",
    "08A": "Simple Assault",
    "08B": "Simple Battery",
    "09": "Arson",
    "10": "Forgery & Counterfeiting",
    "11": "Fraud",
    "12": "Embezzlement",
    "14": "Weapons Violation",
    "15": "Prostitution & Vice",
    "16": "Drug Abuse Violations",
    "17": "Gambling",
    "18": "Offenses Against Family & Children",
    "19": "Driving Under the Influence",
    "20": "Liquor Laws",
    "24": "Disorderly Conduct",
    "26": "Miscellaneous Non-Index Offenses",
}
OFFENCE_CODE_FALLBACK = "FBI Code "

# --- Fixed values: incident category lists, first match wins -----------------------------------
CATEGORY_RULES = [
    (
        "VIOLENT",
        [
            "HOMICIDE", "CRIM SEXUAL ASSAULT", "ROBBERY", "ASSAULT", "BATTERY", "KIDNAPPING",
            "HUMAN TRAFFICKING", "STALKING", "INTIMIDATION",
        ],
    ),
    (
        "PROPERTY",
        [
            "THEFT", "BURGLARY", "MOTOR VEHICLE THEFT", "ARSON", "CRIMINAL DAMAGE", "CRIMINAL TRESPASS",
            "DECEPTIVE PRACTICE", "ROBBERY",
        ],
    ),
]
VIOLENT = "VIOLENT"
PROPERTY = "PROPERTY"
OTHER = "OTHER"

# --- Fixed values: place category lists, first match wins --------------------------------------
PLACE_RULES = [
    (
        "OUTDOOR / TRANSPORT",
        [
            "STREET", "SIDEWALK", "ALLEY", "PARKING LOT / GARAGE (NON RESIDENTIAL)", "PARK PROPERTY",
            "FOREST PRESERVE", "HIGHWAY / EXPRESSWAY", "BRIDGE", "RIVER BANK",
            "LAKEFRONT / WATERFRONT / RIVERBANK", "DRIVEWAY RESIDENTIAL", "VEHICLE NON-COMMERCIAL",
            "VEHICLE-COMMERCIAL", "TAXICAB", "OTHER VEHICLE", "CTA BUS", "CTA TRAIN", "CTA STATION",
            "CTA BUS STOP", "AIRCRAFT", "BOAT / WATERCRAFT", "ATHLETIC CLUB", "EXPRESSWAY EMBANKMENT", "YARD",
        ],
    ),
    (
        "RESIDENTIAL",
        [
            "RESIDENCE", "APARTMENT", "RESIDENCE - PORCH / HALLWAY", "RESIDENCE - YARD (FRONT / BACK)", "HOUSE",
            "DRIVEWAY RESIDENTIAL", "GARAGE", "BASEMENT", "VESTIBULE", "STAIRWELL", "RESIDENCE - GARAGE",
            "NURSING HOME / RETIREMENT HOME", "COLLEGE / UNIVERSITY - GROUNDS",
            "COLLEGE / UNIVERSITY - RESIDENCE HALL",
        ],
    ),
    (
        "COMMERCIAL",
        [
            "SMALL RETAIL STORE", "DEPARTMENT STORE", "GROCERY FOOD STORE", "RESTAURANT", "BAR OR TAVERN",
            "CONVENIENCE STORE", "DRUG STORE", "BANK", "COMMERCIAL / BUSINESS OFFICE", "HOTEL / MOTEL",
            "CURRENCY EXCHANGE", "GAS STATION", "BOWLING ALLEY", "SPORTS ARENA / STADIUM", "THEATER",
            "HOSPITAL BUILDING / GROUNDS", "MEDICAL / DENTAL OFFICE", "CAR WASH", "AUTO / BOAT / RV DEALERSHIP",
            "TAVERN / LIQUOR STORE", "LAUNDRY ROOM", "CLEANERS / LAUNDROMAT", "MOVIE HOUSE / THEATER",
        ],
    ),
    (
        "INSTITUTIONAL",
        [
            "SCHOOL - PUBLIC GROUNDS", "SCHOOL - PUBLIC BUILDING", "SCHOOL - PRIVATE BUILDING",
            "SCHOOL - PRIVATE GROUNDS", "CHURCH / SYNAGOGUE / PLACE OF WORSHIP",
            "GOVERNMENT BUILDING / PROPERTY", "POLICE FACILITY / VEH PARKING LOT", "LIBRARY",
            "HOSPITAL BUILDING / GROUNDS", "FIRE STATION",
        ],
    ),
]

# --- Fixed values: duty shifts as (name, hours label, type, first hour, last hour) -------------
SHIFTS = [
    ("Morning Shift", "06:00 – 14:00", "DAY", 6, 13),
    ("Evening Shift", "14:00 – 22:00", "EVENING", 14, 21),
]
DEFAULT_SHIFT = ("Night Shift", "22:00 – 06:00", "NIGHT")

# --- Fixed values: clustering inputs and settings ----------------------------------------------
CLUSTER_FEATURES = [
    "total_crimes",
    "arrest_rate_pct",
    "domestic_pct",
    "violent_pct",
    "peak_crime_hour",
    "yoy_change_pct",
    "avg_crimes_per_year",
    "violent_share_pct",
    "property_share_pct",
]
CLUSTER_COUNT = 4
CLUSTER_SEED = 42
SWEEP_RESTARTS = 10
FINAL_RESTARTS = 20
MAX_ITERATIONS = 300
HISTOGRAM_BINS = 20
