"""Scans, sinks, projections, feature expressions and profiles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
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
from featloom.operators.profile import category_levels, column_modes, group_count
from featloom.plans.passengers import (
    age_band_counts,
    demographic_features,
    flat_features,
    survivor_prefix_counts,
    ticket_features,
)
from featloom.session import scratch_path
from featloom.sources.csv import read_csv_typed
from featloom.sources.tables import as_view, load, save_overwrite, sql
from workload.inputs import (
    AGE,
    CABIN_MULTI,
    NAME_PREFIX,
    NAME_SECONDARY,
    RAW_PASSENGERS,
    TICKET_CHARS,
    raw_passengers,
    table,
)

PAGE_NUMBER = r"page=([0-9]+)"


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV with empty and NA fields and line breaks, read back with types."""
    customer = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    path = scratch_path(spark, "customers")
    customer.withColumns(
        {
            "c_acctbal": F.when(segment == "FURNITURE", "NA").otherwise(
                F.col("c_acctbal").cast("string")
            ),
            "c_nationkey": F.when(segment != "BUILDING", F.col("c_nationkey")),
            "c_name": F.concat(F.lit('"'), "c_name", F.lit('",\nJr.')),
        }
    ).write.csv(path, header=True, escape='"')
    return read_csv_typed(spark, path, customer.schema, required=["c_custkey"], multiline=True)


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, f"{sf_dir}/supplier.parquet")


def overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"supplier_{uuid.uuid4().hex}"
    path = scratch_path(spark, name)
    save_overwrite(table(spark, sf_dir, "nation"), name, path)
    return save_overwrite(table(spark, sf_dir, "supplier"), name, path)


def limit_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten-row look at a table, ordered so that the rows are defined."""
    return load(spark, f"{sf_dir}/orders.parquet").orderBy("o_orderkey").limit(10)


def take_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty ids as a scoring batch."""
    return table(spark, sf_dir, "labels").select("doc_id").orderBy("doc_id").limit(20)


def view_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_view(table(spark, sf_dir, "orders"), "all_orders")
    filled = sql(spark, "SELECT * FROM all_orders WHERE o_orderstatus = :status", {"status": "F"})
    return as_view(filled, "filled_orders")


def regex_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", title_prefix("text").alias("prefix"))


def count_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents of good quality by prefix; NULL where the language is German."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") != "de", title_prefix("text")).alias("prefix")
    )
    return group_count(documents.join(good, "doc_id"), "prefix")


def regex_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", optional_capture("url", PAGE_NUMBER).alias("page_number")
    )


def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", missing_flag(optional_capture("url", PAGE_NUMBER)).alias("missing")
    )


def present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", present_flag(optional_capture("url", PAGE_NUMBER)).alias("present")
    )


def alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", alpha_code("o_orderpriority").alias("code")
    )


def first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", first_char("text").alias("first"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the whole text; NULL where the language is German."""
    text = F.when(F.col("lang") != "de", F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", token_count(text).alias("tokens"))


def measured_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is NaN for errors."""
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", value.alias("value"))


MEASURED = """
measured AS (
  SELECT event_id, user_id,
         CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS value
  FROM events)"""


def nan_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured_events(spark, sf_dir).select("event_id", nan_to_null("value").alias("value"))


def column_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_modes(measured_events(spark, sf_dir), ["value", "user_id"])


def round_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices, and half quantities of both signs, so that exact halves occur."""
    half = F.col("l_quantity") / 2.0 + 1
    signed = F.when(F.col("l_returnflag") == "R", -half).otherwise(half)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        round0("l_extendedprice").alias("price"),
        round0(signed).alias("half"),
    )


def band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by size band and type; the size is NULL for promotions."""
    size = F.when(F.col("p_type") != "PROMO", F.col("p_size"))
    banded = table(spark, sf_dir, "part").select(
        "p_type", band(size, 20, "< 20", "> 20").alias("under_20")
    )
    return as_view(group_count(banded, "under_20", "p_type"), "size_counts")


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_levels(table(spark, sf_dir, "part"), ["p_type", "p_brand", "p_name"])


def feature_table_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_features(raw_passengers(spark, sf_dir))


def feature_table_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demographic_features(raw_passengers(spark, sf_dir))


def feature_table_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticket_features(raw_passengers(spark, sf_dir))


def prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors by title on the flat features."""
    return survivor_prefix_counts(flat_features(raw_passengers(spark, sf_dir)))


def age_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passengers by age band and label on the flat features; a missing age counts as older."""
    return as_view(
        age_band_counts(flat_features(raw_passengers(spark, sf_dir))), "group_counts"
    )


QUERIES = {
    "scan_csv": scan_csv,
    "scan_table": scan_table,
    "overwrite_roundtrip": overwrite_roundtrip,
    "limit_n": limit_n,
    "take_ids": take_ids,
    "view_filter": view_filter,
    "regex_prefix": regex_prefix,
    "count_by_prefix": count_by_prefix,
    "regex_optional": regex_optional,
    "missing_flag": missing,
    "present_flag": present,
    "alpha_code": alpha,
    "first_char": first,
    "token_count": tokens,
    "nan_to_null": nan_null,
    "column_mode": column_mode,
    "round_half_up": round_half_up,
    "band_counts": band_counts,
    "category_levels": levels,
    "feature_table_flat": feature_table_flat,
    "feature_table_demo": feature_table_demo,
    "feature_table_ticket": feature_table_ticket,
    "prefix_counts": prefix_counts,
    "age_bands": age_bands,
}

FLAT_FEATURES = f"""
        WITH {RAW_PASSENGERS}
        SELECT PassengerId, Sex, {AGE} AS Age, SibSp, {NAME_PREFIX} AS NamePrefix,
               round(Fare, 0) AS FareRounded, substr(Cabin, 1, 1) AS CabinChar, Embarked, Parch,
               Pclass, {CABIN_MULTI} AS CabinMulti, Survived,
               CASE WHEN {NAME_SECONDARY} IS NOT NULL THEN '1' ELSE '0' END AS NameMultiple,
               CASE WHEN {TICKET_CHARS} IS NULL THEN '1' ELSE '0' END AS MissingTicketChars
        FROM raw"""

ORACLES = {
    "scan_csv": """
        SELECT c_custkey, '"' || c_name || '",' || chr(10) || 'Jr.' AS c_name,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS c_nationkey,
               CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_acctbal END AS c_acctbal,
               c_mktsegment
        FROM customer""",
    "scan_table": "SELECT * FROM supplier",
    "overwrite_roundtrip": "SELECT * FROM supplier",
    "limit_n": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
    "take_ids": "SELECT doc_id FROM labels ORDER BY doc_id LIMIT 20",
    "view_filter": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "regex_prefix": r"""
        SELECT doc_id, regexp_extract(text, '([A-Za-z]+)\.', 1) AS prefix FROM documents""",
    "count_by_prefix": r"""
        SELECT CASE WHEN d.lang <> 'de' THEN regexp_extract(d.text, '([A-Za-z]+)\.', 1) END
                 AS prefix,
               count(*) AS count
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id
        WHERE l.quality = 1 GROUP BY 1""",
    "regex_optional": """
        SELECT page_id, nullif(regexp_extract(url, 'page=([0-9]+)', 1), '') AS page_number
        FROM pages""",
    "missing_flag": """
        SELECT page_id,
               CASE WHEN regexp_extract(url, 'page=([0-9]+)', 1) = '' THEN '1' ELSE '0' END
                 AS missing
        FROM pages""",
    "present_flag": """
        SELECT page_id,
               CASE WHEN regexp_extract(url, 'page=([0-9]+)', 1) <> '' THEN '1' ELSE '0' END
                 AS present
        FROM pages""",
    "alpha_code": """
        SELECT o_orderkey,
               upper(nullif(regexp_extract(o_orderpriority, '([A-Za-z]+)', 1), '')) AS code
        FROM orders""",
    "first_char": "SELECT doc_id, substr(text, 1, 1) AS first FROM documents",
    "token_count": """
        SELECT doc_id,
               CASE WHEN lang = 'de' THEN '0'
                    ELSE CAST(len(string_split(text, ' ')) AS VARCHAR) END AS tokens
        FROM documents""",
    "nan_to_null": f"""
        WITH {MEASURED}
        SELECT event_id, CASE WHEN NOT isnan(value) THEN value END AS value FROM measured""",
    "column_mode": f"""
        WITH {MEASURED},
        pairs AS (
          SELECT 'value' AS "column", value AS v FROM measured WHERE NOT isnan(value)
          UNION ALL
          SELECT 'user_id', CAST(user_id AS DOUBLE) FROM measured),
        counted AS (SELECT "column", v, count(*) AS n FROM pairs GROUP BY ALL)
        SELECT "column", v AS mode FROM counted
        QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) = 1""",
    "round_half_up": """
        SELECT l_orderkey, l_linenumber, round(l_extendedprice, 0) AS price,
               round(CASE WHEN l_returnflag = 'R' THEN -(l_quantity / 2.0::DOUBLE + 1)
                          ELSE l_quantity / 2.0::DOUBLE + 1 END, 0) AS half
        FROM lineitem""",
    "band_counts": """
        SELECT p_type,
               CASE WHEN p_type <> 'PROMO' AND p_size < 20 THEN '< 20' ELSE '> 20' END
                 AS under_20,
               count(*) AS count
        FROM part GROUP BY ALL""",
    "category_levels": """
        WITH found AS (
          SELECT 'p_type' AS "column", p_type AS level FROM part
          UNION SELECT 'p_brand', p_brand FROM part
          UNION SELECT 'p_name', p_name FROM part)
        SELECT "column", level,
               row_number() OVER (PARTITION BY "column" ORDER BY level) - 1 AS position
        FROM found""",
    "feature_table_flat": FLAT_FEATURES,
    "feature_table_demo": f"""
        WITH {RAW_PASSENGERS}
        SELECT PassengerId, Name, Sex, {AGE} AS Age, SibSp, {NAME_PREFIX} AS NamePrefix,
               {NAME_SECONDARY} AS NameSecondary,
               CASE WHEN {NAME_SECONDARY} IS NOT NULL THEN '1' ELSE '0' END AS NameMultiple
        FROM raw""",
    "feature_table_ticket": f"""
        WITH {RAW_PASSENGERS}
        SELECT PassengerId, Survived, Pclass, Name, Sex, Age, SibSp, Parch, Fare, Embarked,
               {TICKET_CHARS} AS TicketChars, substr(Cabin, 1, 1) AS CabinChar,
               {CABIN_MULTI} AS CabinMulti, round(Fare, 0) AS FareRounded
        FROM raw""",
    "prefix_counts": f"""
        WITH {RAW_PASSENGERS}
        SELECT {NAME_PREFIX} AS NamePrefix, count(*) AS count
        FROM raw WHERE Survived = 1 GROUP BY 1""",
    "age_bands": f"""
        WITH {RAW_PASSENGERS}
        SELECT CASE WHEN {AGE} < 20 THEN '< 20' ELSE '> 20' END AS under_20, Survived,
               count(*) AS count
        FROM raw GROUP BY ALL""",
}
