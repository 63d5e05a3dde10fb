import pytest
from pyspark.sql import functions as F

from dossier.functions.address import address_fields, parse_address
from dossier.functions.balance import cast_balance
from dossier.functions.checks import require
from tests.util import accounts

SOUND = {
    "762, East 14th Street, New York, United States of America": (
        762, "East 14th Street", "New York", "United States of America"),
    "+5, a, b, c": (5, "a", "b", "c"),
    "-5, a, b, c": (-5, "a", "b", "c"),
    "007, a, b, c": (7, "a", "b", "c"),
    "2147483647, a, b, c": (2147483647, "a", "b", "c"),
    "5, , , c": (5, "", "", "c"),
    "5, a, b, c, d": (5, "a", "b", "c"),
    "5, a, b, c, , ": (5, "a", "b", "c"),
    "5, a, b, , d": (5, "a", "b", ""),
    "5, a,b, c, d": (5, "a,b", "c", "d"),
    "5, a, b, british virgin islands ": (5, "a", "b", "british virgin islands "),
}

MALFORMED = {
    None: (None, None, None, None),
    "": (None, None, None, None),
    ", ": (None, None, None, None),
    "5, a, b": (5, "a", "b", None),
    "5, a, b, ": (5, "a", "b", None),
    "5, a, , , ": (5, "a", None, None),
    " 5, a, b, c": (None, "a", "b", "c"),
    "5\n, a, b, c": (None, "a", "b", "c"),
    "5 , a, b, c": (None, "a", "b", "c"),
    "x, a, b, c": (None, "a", "b", "c"),
    "5.0, a, b, c": (None, "a", "b", "c"),
    "2147483648, a, b, c": (None, "a", "b", "c"),
    "109 Borough High Street, London, England": (None, "London", "England", None),
}


def one(spark, text):
    return spark.createDataFrame([(text,)], "address string")


def test_parse_lenient(spark):
    cases = {**SOUND, **MALFORMED}
    df = spark.createDataFrame([(t,) for t in cases], "address string")
    for parsed in (parse_address(df, mode="lenient"), df.withColumns(address_fields())):
        assert parsed.dtypes[1:] == [
            ("number", "int"), ("road", "string"), ("city", "string"), ("country", "string")]
        found = {r.address: (r.number, r.road, r.city, r.country) for r in parsed.collect()}
        assert found == cases


def test_parse_strict_sound(spark):
    df = spark.createDataFrame([(t,) for t in SOUND], "address string")
    found = {r.address: (r.number, r.road, r.city, r.country) for r in parse_address(df).collect()}
    assert found == SOUND


@pytest.mark.parametrize("text", MALFORMED)
def test_parse_strict_malformed(spark, text):
    with pytest.raises(Exception, match="malformed address"):
        parse_address(one(spark, text)).collect()


def test_strict_check_outlives_pruning(spark):
    with pytest.raises(Exception, match="malformed address"):
        parse_address(one(spark, "5, a, b")).count()


def test_strict_check_sees_rows_a_later_filter_drops(spark):
    with pytest.raises(Exception, match="malformed address"):
        parse_address(one(spark, "5, a, b")).where("country = 'x'").count()


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        parse_address(one(spark, "5, a, b, c"), mode="loose")


def test_balance_cast(spark):
    df = cast_balance(accounts(spark, ("C", "A", "-12"), ("C", "B", "9223372036854775807")))
    assert dict(df.dtypes)["balance"] == "bigint"
    assert [r.balance for r in df.collect()] == [-12, 9223372036854775807]


@pytest.mark.parametrize("balance", ["abc", "12.7", "", None, "9223372036854775808"])
def test_balance_bad(spark, balance):
    df = accounts(spark, ("C", "A", balance))
    with pytest.raises(Exception, match=f"balance is not a whole number: {balance or '.*'}, customer C"):
        cast_balance(df).collect()
    with pytest.raises(Exception, match="balance is not a whole number"):
        cast_balance(df).count()
    assert cast_balance(df, "lenient").first().balance is None


def test_require_runs_before_later_filters(spark):
    checked = require(spark.range(10), F.col("id") < 5, F.lit("too big"))
    with pytest.raises(Exception, match="too big"):
        checked.where("id < 3").collect()


def test_require_stays_above_a_join(spark):
    left = spark.range(5)
    joined = left.join(spark.range(10).select("id", (F.col("id") > 5).alias("bad")), "id")
    assert require(joined, ~F.col("bad"), F.lit("bad")).where("NOT bad").count() == 5
