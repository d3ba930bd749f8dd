"""Feature expressions on the hand-made passengers, in both ANSI modes."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from featloom.functions import (
    alpha_code,
    band,
    first_char,
    missing_flag,
    nan_to_null,
    optional_capture,
    present_flag,
    round0,
    title_prefix,
    token_count,
)
from featloom.plans.passengers import (
    RAW_SCHEMA,
    age_band_counts,
    demographic_features,
    flat_features,
    survivor_prefix_counts,
    ticket_features,
)

NAN = float("nan")


def passenger(number, survived, name, age, ticket, fare, cabin):
    return (number, survived, "3", name, "male", age, "0", "0", ticket, fare, cabin, "S")


ROWS = [
    passenger("a1", 1, "Doe, Mrs. Ann (Mary Roe)", 20.0, "pc 17", 7.5, "B5 B7"),
    passenger("a2", 0, "Poe, Mr. Ed", NAN, "113", 8.4, "C2"),
    passenger("a3", 0, "Noname", 19.9, None, 0.5, None),
    passenger("a4", 1, None, None, "A/5 2", None, "F G7"),
    passenger("a5", 1, 'Fox, Dr. "Jo, B" Al', 40.0, "W.C. 6", 2.5, "D"),
    passenger("a6", 0, "Ray, Mr. Cy (J3)", 5.0, "line", -2.5, "E1"),
]

# Id: prefix, second name, multiple, ticket, ticket missing, cabin, cabins, fare, age, band
EXPECTED = {
    "a1": ("Mrs", "Mary Roe", "1", "PC", "0", "B", "2", 8.0, 20.0, "> 20"),
    "a2": ("Mr", None, "0", None, "1", "C", "1", 8.0, None, "> 20"),
    "a3": ("", None, "0", None, "1", None, "0", 1.0, 19.9, "< 20"),
    "a4": (None, None, "0", "A", "0", "F", "2", None, None, "> 20"),
    "a5": ("Dr", None, "0", "W", "0", "D", "1", 3.0, 40.0, "> 20"),
    "a6": ("Mr", None, "0", "LINE", "0", "E", "1", -3.0, 5.0, "< 20"),
}


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, RAW_SCHEMA)


def test_expressions(ansi, raw):
    found = raw.select(
        "PassengerId",
        title_prefix("Name"),
        optional_capture("Name"),
        present_flag(optional_capture("Name")),
        alpha_code("Ticket"),
        missing_flag(alpha_code("Ticket")),
        first_char("Cabin"),
        token_count("Cabin"),
        round0("Fare"),
        nan_to_null("Age"),
        band("Age", 20, "< 20", "> 20"),
    ).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == EXPECTED


def test_flat_features(ansi, raw):
    flat = flat_features(raw)
    assert flat.dtypes == [
        ("PassengerId", "string"),
        ("Sex", "string"),
        ("Age", "double"),
        ("SibSp", "string"),
        ("NamePrefix", "string"),
        ("FareRounded", "double"),
        ("CabinChar", "string"),
        ("Embarked", "string"),
        ("Parch", "string"),
        ("Pclass", "string"),
        ("CabinMulti", "string"),
        ("Survived", "int"),
        ("NameMultiple", "string"),
        ("MissingTicketChars", "string"),
    ]
    for row in flat.collect():
        wanted = EXPECTED[row.PassengerId]
        assert (row.NamePrefix, row.NameMultiple, row.MissingTicketChars) == (
            wanted[0],
            wanted[2],
            wanted[4],
        )
        assert (row.CabinChar, row.CabinMulti, row.FareRounded, row.Age) == wanted[5:9]


def test_demographic_features(raw):
    found = demographic_features(raw)
    assert found.columns == [
        "PassengerId", "Name", "Sex", "Age", "SibSp", "NamePrefix", "NameSecondary", "NameMultiple",
    ]
    for row in found.collect():
        assert (row.NamePrefix, row.NameSecondary, row.NameMultiple) == EXPECTED[row[0]][:3]


def test_ticket_features(raw):
    found = ticket_features(raw)
    assert found.columns == [
        "PassengerId", "Survived", "Pclass", "Name", "Sex", "Age", "SibSp", "Parch", "Fare",
        "Embarked", "TicketChars", "CabinChar", "CabinMulti", "FareRounded",
    ]
    for row in found.collect():
        assert row.TicketChars == EXPECTED[row.PassengerId][3]
    assert math.isnan(found.filter("PassengerId = 'a2'").first().Age)


def test_token_count_is_the_size_of_the_split(ansi, spark):
    texts = ["", " ", "a", "a b", " a", "a ", "a  b", "ä ö\tü", "　 x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    split = F.when(F.col("t").isNull(), "0").otherwise(F.size(F.split("t", " ")).cast("string"))
    for row in rows.select("t", token_count("t").alias("n"), split.alias("m")).collect():
        assert row.n == row.m


def test_first_char_is_the_first_piece(spark):
    rows = spark.createDataFrame([("",), ("äb",), ("x",), (None,)], "t string")
    found = rows.select(first_char("t").alias("a"), F.split("t", "")[0].alias("b")).collect()
    assert [r.a for r in found] == [r.b for r in found] == ["", "ä", "x", None]


def test_rounding_is_half_away_from_zero(spark):
    rows = spark.createDataFrame([(v,) for v in (2.5, -2.5, 0.5, 1.4, None)], "v double")
    assert [r[0] for r in rows.select(round0("v")).collect()] == [3.0, -3.0, 1.0, 1.0, None]


def test_group_counts(raw):
    flat = flat_features(raw)
    bands = {(r.under_20, r.Survived): r["count"] for r in age_band_counts(flat).collect()}
    assert bands == {("> 20", 1): 3, ("> 20", 0): 1, ("< 20", 0): 2}
    prefixes = {r.NamePrefix: r["count"] for r in survivor_prefix_counts(flat).collect()}
    assert prefixes == {"Mrs": 1, None: 1, "Dr": 1}
