"""What the typing queries must find, written by hand for the SQL side.

Nothing here is read from the library: a wrong pattern, code, list or threshold there shows.
Patterns are put as plain conditions on `val` where they can be; codes follow from the names
they stand for; lists hold the members that occur in the derived columns.
"""

from __future__ import annotations

# type -> (condition, smallest share, its type if values are short on average)
PATTERNS = {
    "website": ("(contains(val, 'WWW.') OR contains(val, '.COM') OR contains(val, 'HTTP:') OR contains(val, 'HTTPS:'))", ">= 0.85", None),
    "zip_code": ("regexp_full_match(val, '[0-9]{5}(-[0-9]{3})?|[0-9]{8}')", ">= 0.85", None),
    "building_classification": ("regexp_matches(val, '[A-Z][0-9]-')", ">= 0.85", None),
    "phone_number": ("regexp_full_match(val, '[0-9]{10}|[(][0-9]{3}[)][0-9]{7}|[0-9]{3}-[0-9]{3}-[0-9]{4}')", ">= 0.85", None),
    "lat_lon_cord": ("regexp_matches(val, '[(][+-]?[0-9]+[.][0-9]+,[[:space:]]*[+-]?[0-9]+[.][0-9]+[)]')", ">= 0.85", None),
    "address": ("regexp_matches(val, '[[:space:]](ROAD|STREET|PLACE|DRIVE|BLVD|ST|RD|DR|AVE)')", ">= 0.75", "street_name"),
    "school_name": ("(regexp_matches(val, '[[:space:]](SCHOOL|ACADEMY)|(HS|IS|PS|P.S)[[:space:]]|[IM].S.[[:space:]]') OR contains(val, 'ACAD'))", ">= 0.5", None),
    "house_number": ("regexp_full_match(val, '[0-9]{2,4}')", ">= 0.85", None),
    "school_level": (
        "(val IN ('HIGH SCHOOL', 'ELEMENTARY', 'ELEMENTARY SCHOOL', 'MIDDLE SCHOOL', 'TRANSFER SCHOOL', 'MIDDLE', 'HIGH SCHOOL TRANSFERL', 'YABC') "
        "OR regexp_full_match(val, 'K-[0-9]{0,2}'))",
        ">= 0.85", None,
    ),
    "subject_in_school": (
        "(val IN ('ENGLISH', 'MATH', 'SCIENCE', 'SOCIAL STUDIES', 'CHEMISTRY', 'ASSUMED TEAM TEACHING', 'EARTH SCIENCE', 'GEOMETRY', 'ECONOMICS', "
        "'GLOBAL HISTORY', 'LIVING ENVIRONMENT', 'PHYSICS', 'US GOVERNMENT', 'US HISTORY') OR starts_with(val, 'US GOVERNMENT &') "
        "OR regexp_matches(val, '^MATH [A-Z$]') OR regexp_full_match(val, 'ALGEBRA [A-Z]|GLOBAL HISTORY[A-Z]|(ENGLISH|GLOBAL HISTORY) [0-9]?'))",
        ">= 0.5", None,
    ),
}
_ANY_PHONE = "regexp_matches(val, '[0-9]{10}|[(][0-9]{3}[)][0-9]{7}|[0-9]{3}-[0-9]{3}-[0-9]{4}')"
_OLD_WEB = "(contains(val, 'WWW.') OR contains(val, '.COM') OR contains(val, 'HTTP:'))"
PATTERNS_V0 = {
    "website": (_OLD_WEB, ">= 0.85", None),
    "zip_code": ("regexp_matches(val, '[0-9]{5}')", ">= 0.85", None),
    "building_classification": PATTERNS["building_classification"],
    "phone_number": (_ANY_PHONE, ">= 0.85", None),
    "lat_lon_cord": PATTERNS["lat_lon_cord"],
    "street": ("regexp_matches(val, '[[:space:]](ROAD|STREET|PLACE|DRIVE|BLVD|ST|RD|DR|AVENUE)')", ">= 0.5", None),
    "school_name": ("(contains(val, 'SCHOOL') OR contains(val, 'ACAD') OR regexp_matches(val, '(HS|IS|PS|P.S)[[:space:]]|[IM].S.[[:space:]]'))", ">= 0.5", None),
}
PATTERNS_V1 = {
    "website": (_OLD_WEB, ">= 0.85", None),
    "address": (PATTERNS["address"][0], ">= 0.8", "street"),
    "house number": PATTERNS["house_number"],
    "school subject": (
        "(val IN ('ENGLISH', 'MATH', 'SCIENCE', 'SOCIAL STUDIES', 'ASSUMED TEAM TEACHING', 'EARTH SCIENCE', 'GEOMETRY', 'ECONOMICS', "
        "'GLOBAL HISTORY', 'LIVING ENVIRONMENT', 'PHYSICS', 'US GOVERNMENT') OR starts_with(val, 'US GOVERNMENT &') "
        "OR regexp_matches(val, '^MATH [A-Z$]') OR regexp_full_match(val, 'ALGEBRA [A-Z]|(ENGLISH|GLOBAL HISTORY) [0-9]?'))",
        ">= 0.5", None,
    ),
    "school level": PATTERNS["school_level"],
}
PATTERN_TABLE = {
    "Street": ("regexp_matches(val, 'ROAD|STREET|PLACE|DRIVE|BLVD|%ST%|%RD%|DR|AVENUE')", "> 0.85", None),
    "Website": ("(regexp_matches(val, 'WWW.|.COM') OR contains(val, 'HTTP://'))", "> 0.85", None),
    "BuildingCode": (PATTERNS["building_classification"][0], "> 0.85", None),
    "PhoneNumber": (_ANY_PHONE, "> 0.85", None),
    "ZipCode": ("regexp_matches(val, '[0-9]{5}')", "> 0.85", None),
    "Lat_Lon": (PATTERNS["lat_lon_cord"][0], "> 0.85", None),
    "SchoolName": ("(regexp_matches(val, 'HS|ACAD|[IM].S.|IS|P.S|PS|YABC') OR contains(val, 'SCHOOL'))", "> 0.85", None),
}
SHORT = 15  # mean length under which the type for short values is given

# colours and makes whose phonetic codes are looked for, and codes of abbreviations
COLORS = ("WHITE", "BLACK", "GREY", "BLUE", "GREEN", "SILVER", "YELLOW", "RED", "ORANGE", "BROWN")
SHORT_COLORS = {"W000": "WHITE", "B200": "BLACK", "G000": "GREY", "B400": "BLUE", "G600": "GREEN"}
MAKES = {
    "F630": "FORD", "T300": "TOYOTA", "H530": "HONDA", "N200": "NISSAN", "C160": "CHEVROLET",
    "M100": "MERCEDES BENZ", "D320": "DODGE", "F600": "FRUEHAUF", "B500": "BMW", "I220": "ISUZU",
}
BOROUGHS = ("K", "M", "Q", "R", "X", "BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND", "NEW YORK")
MAKE_LETTERS = 5


def code_of(name: str) -> str:
    """Phonetic code of a name in capitals: its first letter and the codes of the letters after it,
    runs of one code once, letters without a code left out."""
    codes = [next((str(i) for i, g in enumerate(("BFPV", "CGJKQSXZ", "DT", "L", "MN", "R"), 1) if c in g), "") for c in name]
    tail = "".join(b for a, b in zip(codes, codes[1:]) if b != a)
    return (name[0] + tail + "000")[:4] if len(tail) < 3 else name[0] + tail


COLOR_CODES = {code_of(c): c for c in COLORS}

# kind -> (members that occur in the derived columns, smallest share)
LISTS = {
    "area_of_study": (("ANIMAL", "LAW", "HEALTH", "ENGINEERING", "TEACHING"), 0.25),
    "city_agency": (("DOB", "DOI", "NYPL", "HEALTH"), 0.1),
    "location_type": (("HOUSE", "STREET", "BUS", "RESTAURANT/DINER", "BUILDING"), 0.1),
    "neighborhood": (("ASTORIA", "HARLEM", "FLUSHING", "MIDWOOD", "BRONX", "BROOKLYN", "MANHATTAN", "PARK", "SILVER", "STREET", "E", "W"), 0.1),
    "park_playground": (("PARK", "POOL", "BRONX", "BROOKLYN", "QUEENS"), 0.1),
    "business_name": (("DELI", "PIZZA", "BLACK", "BLUE", "BROOKLYN", "BUILDING", "GREEN", "HARLEM", "HOUSE", "PARK", "RED", "STREET"), 0.1),
    "subject_in_school": (("GEOMETRY", "EARTH", "TEACHING", "ENGLISH", "CHEMISTRY"), 0.4),
}
CASCADE_LISTS = ("area_of_study", "city_agency", "location_type", "neighborhood", "park_playground", "business_name")
LABELS = ("house_number", "person_name_initials")
ENTITIES = ("GPE", "PERSON", "ORG")
OTHER_NAMES = {
    "person": "person_name", "school_subject": "subject_in_school", "zip": "zip_code", "phone": "phone_number",
    "agency": "city_agency", "business": "business_name", "parks_playgrounds": "park_playground", "street": "street_name",
}

# mining: words taken from each column, kinds whose dashes stay, words taken out by hand
TOP_WORDS = {
    "area_of_study": 20, "city_agency": 2, "park_playground": 40, "neighborhood": 20, "location_type": 100, "school_name": 20,
    "subject_in_school": 50, "business_name": 50,
}
KEEPS_DASH = ("area_of_study", "park_playground")
REMOVED_WORDS = {
    "park_playground": ("-", "school", "academy", "charter", "high", "jhs", "middle", "secondary", "senior", "h", "j", "e", "st"),
    "neighborhood": ("st", "avenue"), "location_type": ("nyc",), "subject_in_school": ("11", "10", "b", "9", "12"),
    "business_name": ("nyc", "ny", "engineering", "york", "+"),
}
