"""URL filter: rules, and the reputation of hosts shrunk towards their domain and suffix."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import map_batches, present, text_bytes, wide_hash
from featloom.llm.crf import NOT_MAIN, blocks
from featloom.llm.quality import beta_prior
from featloom.session import checkpointed

BOUND = 0.5
"""A host is blocked if its chance of a bad page is above this, up to ``SURE``."""
SURE = 1.645
"""Standard deviations of the posterior below its mean: 95 % for one side."""

SUFFIXES = (
    *("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.in", "co.kr"),
    *("co.jp", "ne.jp", "or.jp", "ac.jp", "com.br", "com.cn", "com.mx", "com.tr", "com.ar", "com.sg", "com.tw"),
    *("example.com", "example.org", "example.net", "github.io", "blogspot.com", "wordpress.com"),
)
"""Suffixes of more than one label under which domains are registered; any last label is one, too."""


class Rule(NamedTuple):
    """An allow or block rule for a host with its subdomains, and a beginning of the path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def lowered(text: Column) -> Column:
    """A-Z as a-z, and nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; else empty."""
    return lowered(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        one = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, one).otherwise(found)
    return found


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The longest of ``suffixes`` that ends the host at a label, else its last label; an IPv4 address whole."""
    found = F.substring_index(host, ".", -1)
    for suffix in sorted(suffixes, key=lambda s: s.count(".")):
        found = F.when((host == suffix) | host.endswith("." + suffix), suffix).otherwise(found)
    return F.when(host.rlike(r"^[0-9.]+$"), host).otherwise(found)


def domain_of(host: Column, suffix: Column) -> Column:
    """The registered domain: the suffix and one label more. A host that is a suffix is its own domain."""
    own = host.substr(F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(host == suffix, host).otherwise(F.concat_ws(".", F.substring_index(own, ".", -1), suffix))


def carried(page: str) -> str:
    """The text that a page carries in its article or main element, below the heading, with single blanks."""
    found = (b for b in blocks(page) if {"in article", "in main"} & b.around and not NOT_MAIN & b.around)
    return " ".join(b.text for b in found if b.tag != "h1")


def page_outcomes(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """url and bad of every page that carries the text of a labelled document.

    Texts are compared by 128 bits of their words with single blanks between; they are not moved. A text
    with several labels is bad if one says so. A page without text carries none.
    """

    def digests(batch: pa.RecordBatch, key: str, texts: list[str]) -> dict:
        found = [wide_hash(x.encode()) if x else (None, None) for x in texts]
        return {key: batch.column(key), "high": [a for a, _ in found], "low": [b for _, b in found]}

    def of_docs(batch: pa.RecordBatch) -> dict:
        return digests(batch, "doc_id", [" ".join(x.decode().split()) for x in text_bytes(batch)])

    def of_pages(batch: pa.RecordBatch) -> dict:
        return digests(batch, "url", [carried(x.decode()) for x in text_bytes(batch, "html")])

    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    told = map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), present("text").alias("text")),
        of_docs,
        "doc_id long, high long, low long",
    ).where("high IS NOT NULL")
    told = told.join(labels.select(F.col("doc_id").cast("long").alias("doc_id"), bad), "doc_id")
    told = told.groupBy("high", "low").agg(F.max("bad").alias("bad"))
    found = map_batches(
        pages.select("url", present("html").alias("html")), of_pages, "url string, high long, low long"
    ).where("high IS NOT NULL")
    return found.join(told, ["high", "low"]).select("url", "bad")


def reputation(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """host, n_pages, n_bad, rate, low: hosts' chances of a bad page from ``outcomes`` (host, bad).

    Suffixes are shrunk towards all pages, domains towards their suffix, hosts towards their domain.
    The strength of each prior is fitted by moments to the groups of its level. Pages are counted by
    host before any shuffle; all further steps work on the table of hosts. ``bad`` null: not counted.
    """
    hosts = (
        outcomes.where(F.col("bad").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.count_if(F.col("bad")).alias("k"))
        .withColumn("suffix", suffix_of(F.col("host"), suffixes))
        .select("host", domain_of(F.col("host"), F.col("suffix")).alias("domain"), "suffix", "n", "k")
    )
    hosts = checkpointed(hosts)
    domains = checkpointed(
        hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    )
    suffixes = checkpointed(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")))
    alpha, beta = beta_prior(suffixes, "n", "k")
    size = alpha + beta
    suffixes = suffixes.select("suffix", ((F.col("k") + alpha) / (F.col("n") + size)).alias("above"))
    size = sum(beta_prior(domains, "n", "k"))
    rate = (F.col("k") + F.col("above") * size) / (F.col("n") + size)
    domains = domains.join(suffixes, "suffix").select("domain", rate.alias("above"))
    size = sum(beta_prior(hosts, "n", "k"))
    a = F.col("k") + F.col("above") * size
    total = F.col("n") + size
    mean = a / total
    spread = F.sqrt(mean * (1 - mean) / (total + 1))
    return hosts.join(domains, "domain").select(
        "host",
        F.col("n").alias("n_pages"),
        F.col("k").alias("n_bad"),
        mean.alias("rate"),
        (mean - SURE * spread).alias("low"),
    )


def judged_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] = RULES,
    key: str = "page_id",
    url: str = "url",
    bound: float = BOUND,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """Every page with host, path, rule, verdict, rate and low.

    ``outcomes`` (url, bad) are labelled pages. The longest fitting rule decides; without one, a host is
    blocked whose lower bound is above ``bound``; hosts nobody labelled are allowed. A url that is null
    or has no ``://`` has an empty host, which no rule fits and which is allowed.
    """
    told = outcomes.select(host_of(F.col("url")).alias("host"), F.col("bad").cast("boolean").alias("bad"))
    known = checkpointed(reputation(told.where("host <> ''"), suffixes))
    rows = pages.select(
        F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    found = rows.join(known.select("host", "rate", "low"), "host", "left")
    ruled = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("low") > bound, "block").otherwise("allow")
    return found.withColumn("ruled", ruled).select(
        "page_id",
        "host",
        "path",
        F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", own).alias("verdict"),
        "rate",
        "low",
    )
