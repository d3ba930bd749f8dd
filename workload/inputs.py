"""Inputs that several checked queries share, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_validation(key: str, seed: int = 123, percent: int = 25) -> str:
    """Whether a row is held out, in SQL: the split's hash of seed and key."""
    return f"('0x' || substr(md5(concat('{seed}:', {key})), 1, 8))::BIGINT % 100 < {percent}"


def raw_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape of the raw passenger rows, with NULL and NaN in places.

    English documents get a second name in parentheses, French ones no cabin and a ticket
    without letters, Spanish ones a NaN age and no fare, German ones no text.
    """
    lang = F.col("lang")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("PassengerId"),
        F.when(F.col("n_chars") > 400, 1).otherwise(0).alias("Survived"),
        F.substring("source", 4, 2).alias("Pclass"),
        F.when(lang == "en", F.concat("text", F.lit(" (Second Name)")))
        .when(lang != "de", F.col("text"))
        .alias("Name"),
        lang.alias("Sex"),
        F.when(lang == "es", F.lit(float("nan")))
        .otherwise(F.col("n_chars") / 10.0)
        .alias("Age"),
        F.when(F.col("n_chars") > 900, "1").otherwise("0").alias("SibSp"),
        F.when(lang == "en", "2").otherwise("0").alias("Parch"),
        F.when(lang == "fr", F.col("doc_id").cast("string"))
        .otherwise(F.col("source"))
        .alias("Ticket"),
        F.when(lang != "es", F.col("n_chars") / 4.0).alias("Fare"),
        F.when(lang == "en", F.concat_ws(" ", "lang", "source"))
        .when(lang != "fr", F.col("source"))
        .alias("Cabin"),
        F.upper("lang").alias("Embarked"),
    )


RAW_PASSENGERS = """
raw AS (
  SELECT CAST(doc_id AS VARCHAR) AS PassengerId,
         CAST(CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS INTEGER) AS Survived,
         substr(source, 4, 2) AS Pclass,
         CASE WHEN lang = 'en' THEN text || ' (Second Name)'
              WHEN lang <> 'de' THEN text END AS Name,
         lang AS Sex,
         CASE WHEN lang = 'es' THEN CAST('NaN' AS DOUBLE)
              ELSE CAST(n_chars AS DOUBLE) / 10.0::DOUBLE END AS Age,
         CASE WHEN n_chars > 900 THEN '1' ELSE '0' END AS SibSp,
         CASE WHEN lang = 'en' THEN '2' ELSE '0' END AS Parch,
         CASE WHEN lang = 'fr' THEN CAST(doc_id AS VARCHAR) ELSE source END AS Ticket,
         CASE WHEN lang <> 'es' THEN CAST(n_chars AS DOUBLE) / 4.0::DOUBLE END AS Fare,
         CASE WHEN lang = 'en' THEN lang || ' ' || source
              WHEN lang <> 'fr' THEN source END AS Cabin,
         upper(lang) AS Embarked
  FROM documents)"""

# Expressions on the raw rows, one per derived feature.
NAME_PREFIX = r"regexp_extract(Name, '([A-Za-z]+)\.', 1)"
NAME_SECONDARY = r"nullif(regexp_extract(Name, '\(([A-Za-z ]+)\)', 1), '')"
TICKET_CHARS = "upper(nullif(regexp_extract(Ticket, '([A-Za-z]+)', 1), ''))"
CABIN_MULTI = (
    "CASE WHEN Cabin IS NULL THEN '0' "
    "ELSE CAST(len(string_split(Cabin, ' ')) AS VARCHAR) END"
)
AGE = "CASE WHEN NOT isnan(Age) THEN Age END"


def graded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a rule-based prediction and score for quality."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return labels.join(documents, "doc_id").select(
        "doc_id",
        "lang",
        F.col("quality").alias("label"),
        F.when(F.col("n_chars") > 200, 1).otherwise(0).alias("prediction"),
        F.least(F.col("n_chars") / 1000.0, F.lit(1.0)).alias("score"),
    )


GRADED = """
graded AS (
  SELECT l.doc_id, d.lang, l.quality AS label,
         CASE WHEN d.n_chars > 200 THEN 1 ELSE 0 END AS prediction,
         least(CAST(d.n_chars AS DOUBLE) / 1000.0::DOUBLE, 1.0::DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
