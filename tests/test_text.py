import pytest
from pyspark.sql import functions as F

from chronograde.functions import hashing, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("raw, cleaned", [
    ("  Clean Me   ", "Clean Me"), ("n/a", None), ("N/A", None), ("No Data", None), ("na", None), ("", None),
    ("   ", None), (None, None), ("\t x y \n", "x y"), ("nab", "nab"),
])
def test_clean_text(spark, raw, cleaned):
    assert one(spark, text.clean_text(F.lit(raw).cast("string"))) == cleaned


@pytest.mark.parametrize("raw, cleaned", [(42.0, "42"), (42.556, "42.56"), (36.80, "36.8"), (-0.5, "-0.5"), (12345678.0, "12345678"), (0.0, "0"), (100.0, "100")])
def test_clean_number(spark, raw, cleaned):
    assert one(spark, text.clean_number(F.lit(raw))) == cleaned


def test_clean_number_nan(spark):
    assert one(spark, text.clean_number(F.lit(float("nan")))) is None


@pytest.mark.parametrize("raw, label", [
    ("0.4", "40%"), ("1", "100%"), ("0.125", "12%"), ("0.135", "14%"), ("40", "40%"), ("55.9", "55%"), ("45%", "45%"),
    (None, "0%"), ("abc", "abc"), ("0", "0%"),
])
def test_format_weight(spark, raw, label):
    assert one(spark, text.format_weight(F.lit(raw).cast("string"))) == label


@pytest.mark.parametrize("raw, weight", [("100%", 100.0), (" 12.5 %", 12.5), (None, 0.0), ("1.2.3", None), ("%", None)])
def test_parse_weight(spark, raw, weight):
    assert one(spark, text.parse_weight(F.lit(raw).cast("string"))) == weight


@pytest.mark.parametrize("raw, number, formatted", [
    ("5000", "5000.0000", "5,000.00"), ("-1234567.125", "-1234567.1250", "-1,234,567.13"), ("0.125", "0.1250", "0.13"),
    ("4.86", "4.8600", "4.86"), ("1e5", None, None), ("Locked", None, None), ("", None, None), (".5", None, None), (None, None, None),
])
def test_metric_value(spark, raw, number, formatted):
    got = one(spark, text.safe_numeric(F.lit(raw).cast("string")))
    assert (None if got is None else str(got)) == number
    assert one(spark, text.format_metric(F.lit(raw).cast("string"))) == formatted


def test_years(spark):
    rows = spark.createDataFrame([("2024",), ("2025E",), ("FY 2023",), ("trend",)], "y string").select(
        text.calendar_year(F.col("y")), text.is_forecast(F.col("y"))).collect()
    assert [tuple(r) for r in rows] == [(2024, False), (2025, True), (2023, False), (None, False)]


def test_hash_skips_nulls(spark):
    a = hashing.joined_hash([F.lit("a"), F.lit(None).cast("string"), F.lit("b")])
    b = hashing.joined_hash([F.lit("a"), F.lit("b"), F.lit(None).cast("string")])
    assert one(spark, a == b)


def test_vector_hash_depends_on_order(spark):
    df = spark.createDataFrame(
        [([("a", 1.0, "x"), ("b", 100.0, None)],), ([("b", 100.0, None), ("a", 1.0, "x")],), ([],)],
        "v array<struct<sector:string,weight:double,score:string>>",
    )
    import hashlib

    first, second, empty = [r[0] for r in df.select(hashing.industry_vector_hash(F.col("v"))).collect()]
    assert first == hashlib.md5(b"a|1|x,b|100|").hexdigest()
    assert first != second and empty is None


def test_numbers_beyond_the_fixed_types_are_kept_or_reported(spark):
    assert one(spark, text.clean_number(F.lit(1e37))) == "1.0E37"
    assert one(spark, text.plain_number(F.lit(33.33333))) != one(spark, text.plain_number(F.lit(33.33334)))
    assert one(spark, text.beyond_numeric(F.lit("123456789012345"))) is True
    assert one(spark, text.beyond_numeric(F.lit("12345678901234"))) is False
    assert one(spark, text.beyond_numeric(F.lit(None).cast("string"))) is False


@pytest.mark.parametrize("raw", ["plain", 'a "b"', "back\\slash", "tab\t, line\n", "\x00\x1f\x7f", "é 日本 😀", "\u2028", "\ufffd", "", "/"])
def test_json_text_equals_the_writer(spark, raw):
    """Text without anything to escape is not given to the JSON writer, with the same result."""
    assert one(spark, text.json_text(F.lit(raw))) == one(spark, F.to_json(F.array(F.lit(raw))))[1:-1]
    assert one(spark, text.json_text(F.lit(None).cast("string"))) == "null"
