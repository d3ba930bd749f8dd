"""The checked queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.llm import mixing, negatives, quality, urls
from featloom.llm.bytebpe import round_trip
from featloom.llm.common import table
from featloom.llm.crf import extracted
from featloom.llm.exact import exact_groups
from featloom.llm.mixing import mix_report
from featloom.llm.negatives import mined
from featloom.llm.packing import packed
from featloom.llm.pitman_yor import scored
from featloom.llm.planes import encoded_files
from featloom.llm.quality import judged
from featloom.llm.repeats import repeat_report
from featloom.llm.simhash import near_groups
from featloom.llm.urls import Rule, judged_urls, page_outcomes
from featloom.llm.whitening import whitened


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page urls; outcomes are the labels of the documents whose text the pages carry."""
    pages, docs, labels = (table(spark, sf_dir, n) for n in ("pages", "documents", "labels"))
    outcomes = page_outcomes(pages, docs, labels)
    found = judged_urls(pages, outcomes)
    return found.withColumns({n: F.round(n, 6) for n in ("rate", "low")})


def op2_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without byte strings that stand elsewhere too."""
    return repeat_report(table(spark, sf_dir, "documents"))


def op3_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written as bit planes and read back."""
    return encoded_files(table(spark, sf_dir, "documents"))


def op4_island_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids."""
    return packed(table(spark, sf_dir, "documents"))


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdicts of all documents, with the source as host."""
    found = judged(table(spark, sf_dir, "documents")).drop("text_hash")
    return found.withColumn("rate", F.round("rate", 6))


def op6_block_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extracted(table(spark, sf_dir, "pages"))


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by the model of those that are not held out."""
    return scored(table(spark, sf_dir, "documents"))


def op8_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by tree reduction, and what they decode to."""
    return round_trip(table(spark, sf_dir, "documents"))


def op9_heavy_hitter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups of equal texts of all documents."""
    return exact_groups(table(spark, sf_dir, "documents")).drop("n_keep")


def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    found = near_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op11_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document the mix of all sources takes."""
    return mix_report(table(spark, sf_dir, "documents"))


def op12_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the whitened components of their covariance."""
    return whitened(table(spark, sf_dir, "embeddings"))


def op13_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors and their positives among all embeddings."""
    return mined(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_reputation": op1_url_reputation,
    "op2_repeated_strings": op2_repeated_strings,
    "op3_bit_planes": op3_bit_planes,
    "op4_island_packing": op4_island_packing,
    "op5_host_rules": op5_host_rules,
    "op6_block_crf": op6_block_crf,
    "op7_pitman_yor": op7_pitman_yor,
    "op8_tree_bpe": op8_tree_bpe,
    "op9_heavy_hitter_dedup": op9_heavy_hitter_dedup,
    "op10_simhash_trie": op10_simhash_trie,
    "op11_systematic_mix": op11_systematic_mix,
    "op12_qd_whitening": op12_qd_whitening,
    "op13_segment_negatives": op13_segment_negatives,
}



def prior_sql(name: str, groups: str) -> str:
    """The prior of ``beta_prior`` over ``groups`` (n, k), as one row with mean and size."""
    return f"""
        {name}_sums AS (
          SELECT count(*) AS c, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(k) AS DOUBLE) AS k,
                 sum(CAST(n AS DOUBLE) * n) AS s, sum(CAST(k AS DOUBLE) * k / n) AS q
          FROM {groups}),
        {name}_mean AS (SELECT *, k / n AS m FROM {name}_sums),
        {name}_inner AS (
          SELECT m, CASE WHEN n - s / n - (c - 1) > 0
                         THEN (q - n * m * m - (c - 1) * m * (1 - m)) / (n - s / n - (c - 1))
                              / (m * (1 - m)) ELSE 1 END AS i
          FROM {name}_mean),
        {name} AS (SELECT m, 1 / least(greatest(i, 1e-4), 0.99) - 1 AS size FROM {name}_inner)"""


def rule_sql(host: str, path: str, rules: Sequence[Rule], wanted: str) -> str:
    """What ``wanted`` says of the longest rule that fits."""
    lines = [
        f"WHEN (({host} = '{r.host}') OR ends_with({host}, '.{r.host}')) AND starts_with({path}, '{r.path}') "
        f"THEN '{r.text if wanted == 'rule' else r.verdict}'"
        for r in sorted(rules, key=lambda r: (len(r.text), r.text), reverse=True)
    ]
    return "CASE " + " ".join(lines) + " END"


def suffix_sql(host: str, suffixes: Sequence[str]) -> str:
    """The longest of ``suffixes`` that ends the host at a label, else its last label."""
    longest = sorted(suffixes, key=lambda s: s.count("."), reverse=True)
    lines = [f"WHEN {host} = '{s}' OR ends_with({host}, '.{s}') THEN '{s}'" for s in longest]
    return (
        f"CASE WHEN regexp_full_match({host}, '[0-9.]+') THEN {host} "
        + " ".join(lines)
        + f" ELSE list_last(string_split({host}, '.')) END"
    )


BLANK = r"[\x20\x09-\x0D]"
HOST = r"""translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"

# the article of the given pages below its heading: paragraphs of plain text, and two character references
CARRIED = r"""trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(
                regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '(?s)<h1>.*?</h1>', '', 'g'),
                '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;', '&'), '[\x20\x09-\x0D]+', ' ', 'g'))"""

ORACLES: dict[str, str] = {
    "op1_url_reputation": f"""
        WITH parts AS (SELECT page_id, {HOST} AS host, {PATH} AS path, html FROM pages),
        told AS (
          SELECT trim(regexp_replace(coalesce(text, ''), '{BLANK}+', ' ', 'g')) AS words,
                 max(quality = 0 OR toxic = 1) AS bad
          FROM documents JOIN labels USING (doc_id) GROUP BY ALL HAVING words <> ''),
        outcomes AS (
          SELECT host, bad, {suffix_sql("host", urls.SUFFIXES)} AS suffix
          FROM parts JOIN told ON words = {CARRIED} WHERE host <> ''),
        hosts AS (
          SELECT host, suffix,
                 CASE WHEN host = suffix THEN host
                      ELSE list_last(string_split(left(host, length(host) - length(suffix) - 1), '.'))
                           || '.' || suffix END AS domain,
                 count(*) AS n, count(*) FILTER (bad) AS k
          FROM outcomes WHERE bad IS NOT NULL GROUP BY ALL),
        domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
        suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
        {prior_sql("top", "suffixes")}, {prior_sql("middle", "domains")}, {prior_sql("low", "hosts")},
        by_suffix AS (SELECT suffix, (k + m * size) / (n + size) AS above FROM suffixes, top),
        by_domain AS (
          SELECT domain, (d.k + above * size) / (d.n + size) AS above
          FROM domains d JOIN by_suffix USING (suffix), middle),
        by_host AS (
          SELECT host, (h.k + above * size) / (h.n + size) AS rate, h.n + size AS total
          FROM hosts h JOIN by_domain USING (domain), low),
        bounds AS (
          SELECT host, rate, rate - {urls.SURE} * sqrt(rate * (1 - rate) / (total + 1)) AS low FROM by_host)
        SELECT page_id, host, path, {rule_sql("host", "path", urls.RULES, "rule")} AS rule,
               coalesce({rule_sql("host", "path", urls.RULES, "verdict")},
                        CASE WHEN low > {urls.BOUND} THEN 'block' ELSE 'allow' END) AS verdict,
               round(rate, 6) AS rate, round(low, 6) AS low
        FROM parts LEFT JOIN bounds USING (host)""",
    "op5_host_rules": f"""
        WITH texts AS (
          SELECT doc_id, source AS host, coalesce(text, '') AS t,
                 list_filter(string_split_regex(coalesce(text, ''), '{BLANK}+'), lambda x: x <> '') AS w,
                 list_filter(string_split(coalesce(text, ''), chr(10)),
                             lambda x: regexp_replace(x, '{BLANK}', '', 'g') <> '') AS lines
          FROM documents),
        windows AS (
          SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts)),
        counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM windows),
        covered AS (
          SELECT doc_id, count(DISTINCT i + j) AS n
          FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS j FROM counted WHERE c > 1) GROUP BY doc_id),
        measured AS (
          SELECT t.doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
                 CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                 CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
          FROM texts t LEFT JOIN covered c ON t.doc_id = c.doc_id),
        judged AS (
          SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
        hosts AS (
          SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS k FROM judged GROUP BY host),
        {prior_sql("prior", "hosts")},
        rated AS (SELECT host, n, size, (k + m * size) / (n + size) AS rate FROM hosts, prior),
        verdicts AS (
          SELECT host, round(rate, 6) AS rate,
                 rate - {quality.SURE} * sqrt(rate * (1 - rate) / (n + size + 1)) > {quality.MAX_RATE} AS rejected
          FROM rated)
        SELECT j.*, rate, rejected, NOT base_failed AND NOT rejected AS kept
        FROM judged j JOIN verdicts v ON j.host = v.host""",
    "op9_heavy_hitter_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_systematic_mix": f"""
        WITH sized AS (
          SELECT doc_id, source, CAST(len(list_filter(
                   string_split_regex(coalesce(text, ''), '{BLANK}+'), lambda x: x <> '')) AS BIGINT) AS size
          FROM documents),
        sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
        placed AS (
          SELECT *, {list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1)
                                           % {len(mixing.WEIGHTS)} + 1] AS weight,
                 {mixing.MOST} * source_size AS cap
          FROM sources),
        filled AS (
          SELECT *, {mixing.PERCENT} * sum(source_size) OVER () - 100 * (sum(cap) OVER o - cap) AS rest,
                 sum(weight) OVER () - sum(weight) OVER o + weight AS share, row_number() OVER o AS place
          FROM placed WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
        first AS (
          SELECT CAST(rest AS DOUBLE) AS rest, CAST(100 * share AS DOUBLE) AS share FROM filled
          WHERE rest / share <= 100 * cap / weight ORDER BY place LIMIT 1),
        targets AS (
          SELECT source, source_size, least(CAST(cap AS DOUBLE), f.rest * weight / f.share) AS target
          FROM filled, first f),
        rated AS (
          SELECT *, CAST(CASE WHEN source_size > 0 THEN round(target / source_size * {1 << mixing.BITS})
                         ELSE 0 END AS BIGINT) AS expected,
                 ('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', source)), 1, {mixing.BITS // 4}))::BIGINT
                   AS start
          FROM targets),
        summed AS (
          SELECT doc_id, size, source_size, target, expected, start + CAST(sum(expected) OVER (
                   PARTITION BY s.source ORDER BY size DESC, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
          FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source)
        SELECT doc_id, size, source_size, target,
               size * ((upto >> {mixing.BITS}) - ((upto - expected) >> {mixing.BITS})) AS taken
        FROM summed""",
    "op13_segment_negatives": f"""
        WITH clean AS (
          SELECT vec_id, CASE WHEN vec_id % {negatives.SHIFTED} = 0 THEN (label + 1) % {negatives.CLASSES}
                              ELSE label END AS label,
                 list_transform(embedding, lambda c: floor({negatives.SCALE} * CAST(c AS DOUBLE))) AS x,
                 row_number() OVER () AS row
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        scored AS (
          SELECT a.row AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                 CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
          FROM clean a JOIN clean b ON a.row <> b.row AND a.vec_id % {negatives.EVERY} = 0),
        positives AS (
          SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
          FROM scored WHERE same QUALIFY place <= {negatives.POSITIVES}),
        ranked AS (
          SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
                 p.score AS positive_score, n.score AS negative_score,
                 CAST(row_number() OVER (PARTITION BY p.anchor, p.place
                                         ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
          FROM positives p JOIN scored n
            ON p.anchor = n.anchor AND NOT n.same AND 100 * n.score BETWEEN {negatives.LOWEST} * p.score
                                                               AND {negatives.HIGHEST} * p.score)
        SELECT * FROM ranked WHERE rank <= {negatives.NEGATIVES}""",
}
