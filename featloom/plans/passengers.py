"""The passenger data: raw schema, feature frames, lookups and column groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

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
from featloom.learning.prep import FeatureSpec
from featloom.operators.lookup import FeatureLookup

ID = "PassengerId"
LABEL = "Survived"

# Names and types of the raw columns.
RAW_SCHEMA = StructType(
    [
        StructField("PassengerId", StringType(), True),
        StructField("Survived", IntegerType(), True),
        StructField("Pclass", StringType(), True),
        StructField("Name", StringType(), True),
        StructField("Sex", StringType(), True),
        StructField("Age", DoubleType(), True),
        StructField("SibSp", StringType(), True),
        StructField("Parch", StringType(), True),
        StructField("Ticket", StringType(), True),
        StructField("Fare", DoubleType(), True),
        StructField("Cabin", StringType(), True),
        StructField("Embarked", StringType(), True),
    ]
)

# The column groups of the models.
CATEGORICAL = (
    "NamePrefix",
    "Sex",
    "CabinChar",
    "CabinMulti",
    "Embarked",
    "Parch",
    "Pclass",
    "SibSp",
)
NUMERIC = ("Age", "FareRounded")
FLAT_SPEC = FeatureSpec(CATEGORICAL, NUMERIC, ("NameMultiple", "MissingTicketChars"))
LOOKUP_SPEC = FeatureSpec(CATEGORICAL, NUMERIC, ("NameMultiple",))

# The features taken from each feature table.
TICKET_LOOKED_UP = ("CabinChar", "CabinMulti", "Embarked", "FareRounded", "Parch", "Pclass")
DEMOGRAPHIC_LOOKED_UP = ("Age", "NameMultiple", "NamePrefix", "Sex", "SibSp")


def flat_features(raw: DataFrame) -> DataFrame:
    """All features in one table: one projection over the raw rows."""
    return raw.select(
        ID,
        "Sex",
        nan_to_null("Age").alias("Age"),
        "SibSp",
        title_prefix("Name").alias("NamePrefix"),
        round0("Fare").alias("FareRounded"),
        first_char("Cabin").alias("CabinChar"),
        "Embarked",
        "Parch",
        "Pclass",
        token_count("Cabin").alias("CabinMulti"),
        LABEL,
        present_flag(optional_capture("Name")).alias("NameMultiple"),
        missing_flag(alpha_code("Ticket")).alias("MissingTicketChars"),
    )


def demographic_features(raw: DataFrame) -> DataFrame:
    """Who the passenger is, by passenger id."""
    second_name = optional_capture("Name")
    return raw.select(
        ID,
        "Name",
        "Sex",
        nan_to_null("Age").alias("Age"),
        "SibSp",
        title_prefix("Name").alias("NamePrefix"),
        second_name.alias("NameSecondary"),
        present_flag(second_name).alias("NameMultiple"),
    )


def ticket_features(raw: DataFrame) -> DataFrame:
    """What the passenger bought, by passenger id; the other raw columns stay."""
    return raw.withColumns(
        {
            "TicketChars": alpha_code("Ticket"),
            "CabinChar": first_char("Cabin"),
            "CabinMulti": token_count("Cabin"),
            "FareRounded": round0("Fare"),
        }
    ).drop("Ticket", "Cabin")


def age_band_counts(flat: DataFrame) -> DataFrame:
    """Passengers by age band and label."""
    banded = flat.select(LABEL, band("Age", 20, "< 20", "> 20").alias("under_20"))
    return banded.groupBy("under_20", LABEL).count()


def survivor_prefix_counts(flat: DataFrame) -> DataFrame:
    """Survivors by title."""
    return flat.filter(F.col(LABEL) == 1).groupBy("NamePrefix").count()


def passenger_lookups(
    ticket: str | DataFrame, demographic: str | DataFrame
) -> tuple[FeatureLookup, FeatureLookup]:
    """The two lookups of the training set; the label in the ticket table is not among them."""
    return (
        FeatureLookup(ticket, TICKET_LOOKED_UP, ID),
        FeatureLookup(demographic, DEMOGRAPHIC_LOOKED_UP, ID),
    )
