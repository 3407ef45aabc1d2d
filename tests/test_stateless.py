"""Required fields, coercion, null handling, validation."""

import pytest
from pyspark.sql import functions as F

from sluice.config import FieldValidation, TypeCoercion
from sluice.functions.text import full_match, is_blank
from sluice.operators.stateless import coerce_types, handle_nulls, required_fields, validate_fields
from sluice.operators.verdict import FAILURES, LIVE, clean_rows, dead_letters, with_verdict

DDL = "eventId string, customerId string, eventTime bigint, email string, countryCode string, score double, platform string"
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def event(spark, **changes):
    base = dict(eventId="e1", customerId="c1", eventTime=1000, email=None, countryCode=None, score=None, platform=None)
    return spark.createDataFrame([tuple((base | changes).values())], DDL)


def outcome(df):
    row = df.first()
    reasons = [f["reason"] for f in row[FAILURES] or []]
    return row[LIVE], reasons


def test_required_pass_fail_and_none(spark):
    fields = ["eventId", "customerId", "eventTime"]
    assert outcome(required_fields(event(spark), fields)) == (True, [])
    assert outcome(required_fields(event(spark, customerId=None), fields)) == (False, ["MISSING_REQUIRED_FIELD"])
    assert outcome(required_fields(event(spark, customerId=" \t "), fields)) == (False, ["MISSING_REQUIRED_FIELD"])
    assert outcome(required_fields(event(spark, eventId=None, customerId=None, eventTime=None), [])) == (True, [])
    assert outcome(required_fields(event(spark), ["notThere"])) == (False, ["MISSING_REQUIRED_FIELD"])


def test_required_names_first_missing_field(spark):
    row = required_fields(event(spark, customerId=None, eventTime=None), ["eventTime", "customerId"]).first()
    assert row[FAILURES][0]["message"] == "Field 'eventTime' is null or blank"


@pytest.mark.parametrize(
    "rule, changes, live, reasons",
    [
        (FieldValidation("email", "REGEX", pattern=EMAIL), {"email": "user@example.com"}, True, []),
        (FieldValidation("email", "REGEX", pattern=EMAIL), {"email": "not-an-email"}, False, ["REGEX_FAIL"]),
        (FieldValidation("email", "REGEX", pattern=EMAIL), {}, False, ["REGEX_FAIL"]),
        (FieldValidation("email", "REGEX"), {"email": "x"}, False, ["REGEX_FAIL"]),
        (FieldValidation("score", "RANGE", min=0, max=100), {"score": 75.5}, True, []),
        (FieldValidation("score", "RANGE", min=0, max=100), {"score": 150.0}, False, ["RANGE_FAIL"]),
        (FieldValidation("score", "RANGE", min=0, max=100), {"score": 100.0}, True, []),
        (FieldValidation("score", "RANGE", min=0), {"score": float("nan")}, False, ["RANGE_FAIL"]),
        (FieldValidation("email", "RANGE", min=0), {"email": " 1.5 "}, True, []),
        (FieldValidation("email", "RANGE", min=0), {"email": "many"}, False, ["RANGE_FAIL"]),
        (FieldValidation("absent", "RANGE", min=0), {}, False, ["RANGE_FAIL"]),
        (FieldValidation("platform", "NOT_EMPTY"), {"platform": "  "}, False, ["NOT_EMPTY_FAIL"]),
        (FieldValidation("platform", "ENUM_VALUE", allowed_values=["IOS"]), {"platform": "ios"}, False, ["ENUM_VALUE_FAIL"]),
        (FieldValidation("platform", "ENUM_VALUE", allowed_values=["IOS"], on_fail="DROP_RECORD"), {}, False, []),
        (FieldValidation("platform", "ENUM_VALUE", allowed_values=["IOS"], on_fail="FORWARD"), {}, True, []),
    ],
)
def test_validation(spark, rule, changes, live, reasons):
    assert outcome(validate_fields(event(spark, **changes), [rule])) == (live, reasons)


def test_enum_fill(spark):
    rule = FieldValidation(
        "platform", "ENUM_VALUE", allowed_values=["IOS", "ANDROID", "WEB", "UNKNOWN"], on_fail="FILL_DEFAULT", default_value="UNKNOWN"
    )
    result = validate_fields(event(spark, platform="SMARTTV"), [rule])
    assert outcome(result) == (True, []) and result.first()["platform"] == "UNKNOWN"


def test_later_rule_sees_filled_value(spark):
    rules = [
        FieldValidation("score", "RANGE", min=0, max=10, on_fail="FILL_DEFAULT", default_value="-1"),
        FieldValidation("score", "RANGE", min=0),
    ]
    result = validate_fields(event(spark, score=50.0), rules)
    assert outcome(result) == (False, ["RANGE_FAIL"])
    assert result.first()[FAILURES][0]["message"] == "Field 'score' failed RANGE (value=-1.0)"


def test_full_match_is_not_find(spark):
    row = spark.createDataFrame([("abc\n",)], "s string").select(full_match(F.col("s"), "abc"), full_match(F.col("s"), "abc\\n")).first()
    assert list(row) == [False, True]


def test_blank_follows_java(spark):
    values = ["", " \t\x1c", " ", " ", "x"]
    rows = spark.createDataFrame([(v,) for v in values], "s string").select(is_blank(F.col("s"))).collect()
    assert [r[0] for r in rows] == [True, True, True, False, False]


def test_null_strategies(spark):
    filled = handle_nulls(event(spark), "FILL_DEFAULT", {"countryCode": "XX", "platform": "UNKNOWN", "score": "1.5"}).first()
    assert (filled["countryCode"], filled["platform"], filled["score"], filled["email"]) == ("XX", "UNKNOWN", 1.5, None)
    assert handle_nulls(event(spark), "FORWARD", {"email": "x"}).first()["email"] is None
    dropped = handle_nulls(event(spark, email="a"), "DROP_RECORD", {"countryCode": "XX"})
    assert outcome(dropped) == (False, ["NULL_FIELD_DROP"])
    assert "'score'" in dropped.first()[FAILURES][0]["message"]
    kept = handle_nulls(event(spark, email="a", score=1.0, platform="IOS"), "DROP_RECORD", {"countryCode": "XX"})
    assert kept.first()["countryCode"] == "XX" and outcome(kept) == (True, [])


@pytest.mark.parametrize(
    "source, target, value, expected",
    [
        ("ISO8601_STRING", "EPOCH_MILLIS", "2024-01-01T00:00:00Z", "1704067200000"),
        ("ISO8601_STRING", "EPOCH_MILLIS", " 2024-01-01T02:00:00.500+02:00[Europe/Paris] ", "1704067200500"),
        ("ISO8601_STRING", "EPOCH_MILLIS", "2024-01-01T00:00:00", "2024-01-01T00:00:00"),
        ("ISO8601_STRING", "EPOCH_MILLIS", "1704067200000", "1704067200000"),
        ("ISO8601_STRING", "EPOCH_MILLIS", "2024-13-01T00:00:00Z", "2024-13-01T00:00:00Z"),
        ("LOWERCASE_STRING", "UPPERCASE_ENUM", " created\n", "CREATED"),
        ("TRIM_STRING", None, "\x00 a b \t", "a b"),
        (None, "NUMERIC_STRING", "$1,234.50", "1234.50"),
        ("UPPERCASE_ENUM", "LOWERCASE_STRING", "As Is", "As Is"),
        ("ISO8601_STRING", "EPOCH_MILLIS", None, None),
    ],
)
def test_coercion(spark, source, target, value, expected):
    df = spark.createDataFrame([(value, 5)], "f string, n int")
    rules = [TypeCoercion("f", source, target), TypeCoercion("absent", source, target), TypeCoercion("n", source, target)]
    row = coerce_types(df, rules).first()
    assert (row["f"], row["n"]) == (expected, 5)


def test_dead_letter_keeps_row_as_it_came(spark):
    df = with_verdict(event(spark, email=" a ", score=200.0), ["email"])
    df = coerce_types(df, [TypeCoercion("email", "TRIM_STRING", None)])
    df = validate_fields(df, [FieldValidation("score", "RANGE", max=100)])
    letter = dead_letters(df, "s").first()
    assert '"email":" a "' in letter["original_json"]
    assert letter["stream_key"] == letter["original_stream_key"] == "s"
    assert (letter["original_customer_id"], letter["original_event_time_ms"]) == ("c1", 1000)
    assert clean_rows(df).count() == 0
