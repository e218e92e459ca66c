import pytest
from pyspark.sql import functions as F

from colsight import rules as R
from colsight.operators import semantic as S
from colsight.plans import classify as C

RULES = {r.semantic_type: r for r in R.PATTERN_RULES}


def _match(spark, values, rule):
    df = spark.createDataFrame([(v,) for v in values], "val string")
    return {r["val"] for r in df.where(F.col("val").rlike(RULES[rule].pattern)).collect()}


@pytest.mark.parametrize(
    "rule, hits, misses",
    [
        ("website", ["WWW.A", "X.COM", "HTTP://A", "HTTPS://A"], ["www.a", "COM", "HTTP"]),
        ("zip_code", ["10001", "10001-123", "12345678"], ["1000", "12", "10001-1234", "123456"]),
        ("building_classification", ["A1-X", "R4-CONDO"], ["A-1", "11-X"]),
        ("phone_number", ["2125551234", "(212)5551234", "212-555-1234"], ["212 555 1234", "12125551234"]),
        ("lat_lon_cord", ["(40.7, -73.9)", "(40.7,-73.9)"], ["40.7,-73.9", "(40, -73)"]),
        ("address", ["1 MAIN ST", "A ROAD", "5 X AVE"], ["STREET", "MAIN"]),
        ("school_name", ["PS 1", "MY SCHOOL", "THE ACADEMY", "I.S. 5"], ["SCHOOL", "LIBRARY"]),
        ("house_number", ["12", "123", "1234"], ["1", "12345", "12A"]),
        ("school_level", ["K-8", "K-12", "HIGH SCHOOL", "YABC"], ["HIGH", "K8"]),
        ("subject_in_school", ["ENGLISH", "MATH A", "US HISTORY", "CHEMISTRY", "GLOBAL HISTORY 2"], ["ENGLISH LIT", "MATHS"]),
    ],
)
def test_patterns(spark, rule, hits, misses):
    assert _match(spark, hits + misses, rule) == set(hits)


def _patterns(vc, rule):
    return S.detect_patterns(vc, [RULES[rule]]).first()


def test_threshold_is_reached_at_the_share(column):
    at = _patterns(column("d.c", {"2125551234": 85, "x": 15}), "phone_number")
    assert (at["weight"], at["share"], at["matched"]) == (85, 0.85, True)
    below = _patterns(column("d.c", {"2125551234": 84, "x": 16}), "phone_number")
    assert not below["matched"]
    strict = R.PatternRule("zip_code", RULES["zip_code"].pattern, 0.85, strict=True)
    assert not S.detect_patterns(column("d.c", {"10001": 85, "x": 15}), [strict]).first()["matched"]


def test_address_or_street(column):
    # mean length over distinct values, not weighted
    assert _patterns(column("d.c", {"12345678 MAIN ST": 1, "1234567 MAIN S": 0, "1234567 MAIN ST": 9}), "address")["semantic_type"] == "address"
    assert _patterns(column("d.c", {"1234567 MAIN ST": 9, "123456 MAIN ST": 9}), "address")["semantic_type"] == "street_name"


def test_empty_and_unmatched_columns(column):
    r = _patterns(column("d.c", {"x": 0}), "zip_code")
    assert (r["weight"], r["share"], r["matched"]) == (0, 0.0, False)


def _shape(vc, detector):
    r = S.detect_shape(vc, [detector]).first()
    return r["semantic_type"], r["weight"], r["share"]


FIVE = {"WHITE": 10, "BLACK": 10, "GREY": 10, "RED": 10, "BROWN": 10}


def test_color_needs_half_the_codes_and_half_the_weight(column):
    assert _shape(column("d.c", {**FIVE, "TABLE": 49, "7": 1}), "color") == ("color", 99, 0.5)
    four = {k: v for k, v in FIVE.items() if k != "BROWN"}
    assert _shape(column("d.c", four), "color") == (None, 0, 0.0)
    assert _shape(column("d.c", {**FIVE, "TABLE": 51}), "color") == (None, 0, 0.0)
    # abbreviations count for the weight, not for the number of colours
    assert _shape(column("d.c", {**four, "BK": 10}), "color") == (None, 0, 0.0)


MAKES = {"FORD": 1, "TOYOT": 1, "HONDA": 1, "DODGE": 1, "BMW": 1}


def test_make_or_model_by_mean_length(column):
    assert _shape(column("d.Vehicle_Make", MAKES), "car_make") == ("car_make", 5, 0.5)
    assert _shape(column("d.make", MAKES), "car_make") == (None, 0, 0.0)
    seven = {f"{k} {'X' * (6 - len(k))}": 1 for k in MAKES}
    assert _shape(column("d.vehicle", seven), "car_make")[0] == "car_make"
    eight = {f"{k} {'X' * (7 - len(k))}": 1 for k in MAKES}
    assert _shape(column("d.vehicle", eight), "car_make")[0] == "car_model"


def test_borough_needs_five_known_of_ten(column):
    known = {"BRONX": 1, "BROOKLYN": 2, "QUEENS": 3, "MANHATTAN": 4, "K": 5}
    assert _shape(column("d.b", {**known, "x": 15}), "borough") == ("borough", 15, 0.5)
    assert _shape(column("d.b", {k: v for k, v in known.items() if k != "K"}), "borough")[0] is None
    assert _shape(column("d.b", {**known, **{f"v{i}": 1 for i in range(5)}}), "borough")[0] == "borough"
    assert _shape(column("d.b", {**known, **{f"v{i}": 1 for i in range(6)}}), "borough")[0] is None


def test_initials_need_more_than_twenty_values(column):
    letters = [chr(65 + i) for i in range(21)]
    assert _shape(column("d.mi", {c: 2 for c in letters}), "initials") == ("person_name_initials", 42, 100.0)
    assert _shape(column("d.mi", {c: 2 for c in letters[:20]}), "initials")[0] is None


@pytest.mark.parametrize("kind", sorted({**R.KEYWORD_THRESHOLDS, **R.EXTRA_KEYWORD_THRESHOLDS}))
def test_keyword_share(spark, column, kind):
    share = {**R.KEYWORD_THRESHOLDS, **R.EXTRA_KEYWORD_THRESHOLDS}[kind]
    term = R.KEYWORDS[kind][0]
    terms = S.literal_terms(spark, {kind: R.KEYWORDS[kind]})
    at, below = int(share * 100), int(share * 100) - 1
    assert S.detect_keywords(column("d.c", {term: at, "?": 100 - at}), terms, {kind: share}).first()["matched"]
    assert not S.detect_keywords(column("d.c", {term: below, "?": 100 - below}), terms, {kind: share}).first()["matched"]


@pytest.fixture
def entities(spark):
    return S.literal_terms(spark, {"GPE": ["PARIS", "ROME"], "PERSON": ["ANN", "BOB"], "ORG": ["ACME", "PARIS"]}, "label")


FILL = {f"v{i}": 1 for i in range(9)}


def test_entities(column, entities):
    def run(name, values, gated=False):
        r = S.entity_share(column(name, {**FILL, **values}), entities, gated).first()
        return r["semantic_type"], r["weight"], r["share"]

    # PARIS is also a firm, so it adds to both weights
    assert run("d.c", {"PARIS": 3, "ANN": 1}) == ("city", 6, 0.75)
    assert run("d.c", {"ROME": 2, "ANN": 2}) == ("city", 2, 0.5)
    assert run("d.c", {"ROME": 1, "ANN": 3, "ACME": 5}) == ("person_name", 8, 0.75)
    assert run("d.c", {"ROME": 1, "ACME": 3})[0] is None
    assert run("d.c", {"ROME": 2, "ANN": 1}, gated=True)[0] is None
    assert run("d.city hall", {"ROME": 2, "ANN": 1}, gated=True)[0] == "city"
    assert run("d.last_name", {"ROME": 1, "ANN": 2}, gated=True)[0] == "person_name"
    few = S.entity_share(column("d.c", {"ROME": 2, "ANN": 1}), entities).first()
    assert few["semantic_type"] is None


@pytest.fixture
def classify(spark, entities):
    keywords = S.literal_terms(spark, {k: R.KEYWORDS[k] for k in R.KEYWORD_THRESHOLDS})

    def run(vc, **options):
        return C.classify(vc, keywords, entities, **options)

    return run


def test_patterns_close_the_other_detectors(column, classify):
    r = classify(column("d.c", {"12": 50, "15": 50})).first()
    assert r["types"] == ["house_number"]
    assert [(e["semantic_type"], e["label"], e["count"]) for e in r["found"]] == [("", "house_number", 100)]
    # with a pattern found, keywords aren't looked at
    r = classify(column("d.c", {"1 MAIN STREET": 90, "DOB": 10})).first()
    assert (r["types"], r["city_agency_weight"]) == (["street_name"], 0)


def test_several_types_and_the_total_weight(column, classify):
    r = classify(column("d.c", {"SCHOOL": 10, "INSIDE": 5, "Z": 75})).first()
    assert r["types"] == ["location_type", "neighborhood"]
    assert r["types_count"] == r["location_type_weight"] + r["neighborhood_weight"]


def test_entities_clear_earlier_types(column, classify):
    values = {**FIVE, **FILL, "ROME": 1, "ANN": 1}
    # BLACK and RED are business words too, and lists are looked at after names
    assert classify(column("d.c", values)).first()["types"] == ["city", "business_name"]
    assert classify(column("d.c", values), entity_clears=False).first()["types"] == ["color", "city", "business_name"]
    assert classify(column("d.c", values), gated=True).first()["types"] == ["color", "business_name"]


def test_scaling(column):
    got = {r["val"]: r["scaled"] for r in S.minmax_scale(column("d.c", {"a": 1, "b": 3, "c": 9})).collect()}
    assert got == {"a": 0.0, "b": 0.25, "c": 1.0}
    constant = {r["scaled"] for r in S.minmax_scale(column("d.c", {"a": 4, "b": 4})).collect()}
    assert constant == {0.5}
    stats = S.scaled_count_stats(column("d.c", {"a": 1, "b": 3, "c": 9})).first()
    assert (round(stats["mean"], 6), round(stats["stdv"], 6)) == (0.416667, 0.520416)
    assert S.scaled_count_stats(column("d.c", {"a": 1})).first()["stdv"] is None


def test_breakdown_adds_up(column):
    got = {r["name"]: r["weight"] for r in S.code_weights(column("d.c", {**FIVE, "WHTE": 5, "x": 7}), R.COLOR_CODES).collect()}
    assert got == {"WHITE": 15, "BLACK": 10, "GREY": 10, "RED": 10, "BROWN": 10, "OTHERS": 7}
    full = {r["name"]: r["weight"] for r in S.code_weights(column("d.c", {"RED": 1}), R.COLOR_CODES).collect()}
    assert full == {"RED": 1, "OTHERS": 0}


def test_report_shares_lie_between_0_and_1(column, classify):
    vc = column("d.c", {**FIVE, "x": 3}).unionByName(column("d.d", {"10001": 2, "y": 1}))
    report = C.share_report(classify(vc), vc)
    for r in report.collect():
        assert all(0 <= r[c] <= 1 for c in report.columns if c.endswith("_share"))
    assert C.types_found(classify(vc)).first()["n"] == 1


def test_more_lists_than_bits_of_a_number(spark, column):
    lists = {f"kind{i}": [f"term{i}", "shared"] for i in range(130)}
    values = column("d.c", {"term0": 1, "term61": 2, "term62": 4, "term129": 8, "shared": 16})
    found = S.detect_keywords(values, S.literal_terms(spark, lists), {k: 0.5 for k in lists}).collect()
    weights = {r["semantic_type"]: r["weight"] for r in found}
    assert weights == {k: 16 + {"kind0": 1, "kind61": 2, "kind62": 4, "kind129": 8}.get(k, 0) for k in lists}


def test_breakdown_is_ordered_with_the_rest_last(column):
    got = S.code_weights(column("d.c", {"RED": 1, "WHITE": 5, "BLUE": 5, "other thing": 90}), R.COLOR_CODES).collect()
    assert [(r["rank"], r["name"], r["weight"]) for r in sorted(got, key=lambda r: r["rank"])] == [
        (1, "BLUE", 5), (2, "WHITE", 5), (3, "RED", 1), (4, "OTHERS", 90),
    ]
