from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import blank_tokens, calendar_key, changed, in_window, parse_flag, share_of, typed_null


def test_calendar_key(spark):
    df = spark.createDataFrame([(date(2024, 2, 9),), (None,)], "d date")
    assert [r[0] for r in df.select(calendar_key(F.col("d"))).collect()] == [20240209, None]


def test_flags(spark):
    words = ["0", "1", "true", "FALSE", " True ", "", "yes", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(parse_flag(F.col("w"))).collect()]
    assert got == [False, True, True, False, True, None, None, None]


def test_null_words_become_empty_text(spark):
    df = spark.createDataFrame([("NULL", "n/a"), ("", "x"), (None, None), ("Model", "NULL")], "m string, o string")
    assert [tuple(r) for r in blank_tokens(df, {"m": ["NULL"]}).collect()] == [
        ("", "n/a"),
        ("", "x"),
        ("", None),
        ("Model", "NULL"),
    ]
    to_null = blank_tokens(df, {"m": ["NULL"], "o": ["n/a", "NULL"]}, to_null=True)
    assert [tuple(r) for r in to_null.collect()] == [(None, None), ("", "x"), (None, None), ("Model", None)]


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame(
        [(Decimal("10"), Decimal("3"), Decimal("0")), (Decimal("10"), Decimal("3"), Decimal("4"))],
        "amount decimal(19,4), part decimal(19,4), whole decimal(19,4)",
    )
    got = [r[0] for r in df.select(share_of(F.col("amount"), F.col("part"), F.col("whole"))).collect()]
    assert got == [None, Decimal("7.5")]


def test_changed_treats_null_as_a_value(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), ("a", None), (None, None)], "x string, y string")
    got = [r[0] for r in df.select(changed([F.col("x")], [F.col("y")])).collect()]
    assert got == [False, True, True, True, False]
    assert df.select(changed([], [])).first()[0] is False


@pytest.mark.parametrize(
    ("email", "person", "loose", "strict"),
    [
        ("2020-03-01", "2030-01-01", True, False),  # one date meets each bound
        ("2020-03-01", "2019-01-01", True, True),
        ("2019-01-01", "2019-01-01", False, False),
        (None, "2020-03-01", True, True),
        (None, "2030-01-01", None, False),
        ("2020-01-01", "2019-01-01", False, False),  # the lower bound is exclusive
        ("2020-06-01", "2019-01-01", True, True),  # the upper one is not
    ],
)
def test_modification_window(spark, email, person, loose, strict):
    stamp = lambda text: F.lit(text).cast("timestamp")
    low, high = datetime(2020, 1, 1), datetime(2020, 6, 1)
    got = spark.range(1).select(
        in_window([stamp(email), stamp(person)], low, high), in_window([stamp(email), stamp(person)], low, high, True)
    )
    kept = tuple(bool(v) for v in got.first())
    assert kept == (bool(loose), strict)


def test_typed_null(spark):
    assert spark.range(1).select(typed_null("tinyint").alias("n")).schema["n"].dataType.simpleString() == "tinyint"
