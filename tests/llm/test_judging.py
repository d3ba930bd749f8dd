"""Quality rules, URL verdicts, language model and page extraction."""

from __future__ import annotations

import html
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.llm import crf, urls
from featloom.llm.crf import blocks, extracted, features, labelled, main_text, trained, viterbi
from featloom.llm.pitman_yor import perplexities, scored, seated
from featloom.llm.quality import beta_prior, drop_low_quality, host_verdicts, judged, measures
from featloom.llm.queries import op1_url_reputation
from featloom.llm.urls import Rule, judged_urls, page_outcomes, reputation
from featloom.session import delete_path
from tests.llm import plain


def test_measures():
    for _, text in plain.awkward(6) + [(0, "a b c a b c\na b c\n\n a b c\n#$ <x>")]:
        got = measures((text or "").encode())
        assert got == tuple(list(plain.quality(text).values())[:5])


@pytest.mark.parametrize("clashes", [False, True])
def test_judged(spark, clashes):
    rows = plain.awkward(6)
    found = judged(plain.frame(spark, rows, clashes)).collect()
    wanted = Counter((i, *plain.quality(t).values()) for i, t in rows)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[n] for n in names) for r in found) == wanted
    assert all(r["kept"] == (not r["base_failed"]) for r in found)


def test_bad_hosts_go(spark):
    rng = random.Random(1)
    good = [(k, plain.words(rng, 60), f"h{k % 8}") for k in range(240)]
    bad = [(1000 + k, "few words", "bad") for k in range(200)] + [(1300, plain.words(rng, 60), "bad")]
    tiny = [(2000, "few words", "tiny"), (2001, plain.words(rng, 60), "tiny"), (2002, plain.words(rng, 60), None)]
    docs = plain.frame(spark, good + bad + tiny)
    kept = {r["doc_id"] for r in drop_low_quality(docs).collect()}
    assert kept == {k for k in range(240)} | {2001, 2002}
    assert drop_low_quality(docs).schema == docs.schema


def test_prior(spark):
    frame = spark.createDataFrame([(100, 10), (100, 11), (100, 9)], "n long, k long")
    alpha, beta = beta_prior(frame, "n", "k")
    assert alpha / (alpha + beta) == pytest.approx(0.1) and alpha + beta > 1000
    assert beta_prior(frame.limit(0), "n", "k") == (1.0, 1.0)
    same = spark.createDataFrame([(5, 0), (7, 0)], "n long, k long")
    assert all(x > 0 for x in beta_prior(same, "n", "k"))


def test_judged_empty(spark):
    none = plain.frame(spark, [])
    assert judged(none).count() == drop_low_quality(none).count() == 0
    assert host_verdicts(judged(none)).count() == 0


URLS = [
    "http://A.Example.ORG/es/x",
    "https://example.org/en/12?q#f",
    "https://notexample.org/en/12",
    "https://x.com/fr/1",
    "https://x.com/de/1",
    "https://x.com",
    "https://x.net/fr/",
    "no scheme",
    None,
    "",
    "a://b://c/d",
    "http://org/",
    "http://example.org#/es/",
]


def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    best = None
    for rule in rules:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            best = rule if best is None or len(rule) > len(best) else best
    return host, path, best, rules.get(best, "allow")


def test_url_rules(spark):
    pages = spark.createDataFrame([(k, u, "h", 1.0) for k, u in enumerate(URLS)], "page_id long, url string, host string, rate double")
    none = spark.createDataFrame([], "url string, bad boolean")
    found = judged_urls(pages, none).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in found] == [plain_verdict(u) for u in URLS]


def test_domains_of_ordinary_hosts(spark):
    wanted = {
        "www.foo.com": ("foo.com", "com"), "blog.foo.com": ("foo.com", "com"), "foo.com": ("foo.com", "com"),
        "a.b.foo.co.uk": ("foo.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "com": ("com", "com"),
        "h.d.example.com": ("d.example.com", "example.com"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"),
    }
    hosts = spark.createDataFrame([(h,) for h in wanted], "host string").withColumn("suffix", urls.suffix_of(F.col("host")))
    found = hosts.select("host", urls.domain_of(F.col("host"), F.col("suffix")), "suffix").collect()
    assert {h: tuple(x) for h, *x in found} == wanted
    rows = [(h, True) for h in ("www.foo.com", "blog.foo.com") for _ in range(40)] + [(f"w{k}.d{k % 9}.com", False) for k in range(90)]
    rows += [("new.foo.com", True), ("new.d1.com", True)]
    rates = {r["host"]: r["rate"] for r in reputation(spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    # a host with one page is judged by the others of its domain
    assert rates["new.foo.com"] > rates["new.d1.com"]


def test_reputation_is_shrunk(spark):
    rng = random.Random(0)
    rows = []
    for d in range(30):
        for h in range(3):
            rate = 0.9 if d == 0 else 0.1
            rows += [(f"h{h}.d{d}.example.com", rng.random() < rate) for _ in range(40)]
    rows += [("new.d0.example.com", True), ("new.d5.example.com", True), ("new.d5.example.com", None)]
    found = {r["host"]: r for r in reputation(spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    assert found["h0.d0.example.com"]["low"] > 0.5 > found["h0.d5.example.com"]["rate"]
    assert found["new.d0.example.com"]["rate"] > found["new.d5.example.com"]["rate"]
    assert found["new.d5.example.com"]["n_pages"] == 1 and found["new.d5.example.com"]["low"] < 0.5
    pages = spark.createDataFrame([(1, "http://h0.d0.example.com/x"), (2, "http://h0.d5.example.com/")], "page_id long, url string")
    told = spark.createDataFrame([(f"http://{h}/", b) for h, b in rows], "url string, bad boolean")
    verdicts = {r["page_id"]: r["verdict"] for r in judged_urls(pages, told, [Rule("zz", "/", "block")]).collect()}
    assert verdicts == {1: "block", 2: "allow"}


def plain_prior(groups):
    """Size of the beta prior of (n, k) by moments, and its mean."""
    n, k, c = sum(g[0] for g in groups), sum(g[1] for g in groups), len(groups)
    mean = k / n
    if not 0 < mean < 1:
        size = 1 + 2 / (n + 2)
        return (mean + 1 / (n + 2)) / size, size
    between = sum(n * (k / n - mean) ** 2 for n, k in groups) - (c - 1) * mean * (1 - mean)
    room = n - sum(g[0] ** 2 for g in groups) / n - (c - 1)
    inner = between / room / (mean * (1 - mean)) if room > 0 else 1.0
    return mean, 1 / min(max(inner, 1e-4), 0.99) - 1


def plain_rates(rows, suffixes=("co.uk",)):
    """rate and low of every host, level by level over dictionaries."""
    counts = [Counter() for _ in range(6)]
    chain = {}
    for host, bad in rows:
        if bad is None:
            continue
        labels = host.split(".")
        two = ".".join(labels[-2:])
        suffix = two if two in suffixes else labels[-1]
        more = len(suffix.split(".")) + 1
        chain[host] = (".".join(labels[-more:]), suffix)
        for k, name in enumerate((host, *chain[host])):
            counts[k][name] += 1
            counts[k + 3][name] += bad
    groups = [[(counts[k][g], counts[k + 3][g]) for g in counts[k]] for k in range(3)]
    mean, size = plain_prior(groups[2])
    above = {s: (counts[5][s] + mean * size) / (n + size) for s, n in counts[2].items()}
    _, size = plain_prior(groups[1])
    parents = {d: s for d, s in chain.values()}
    above = {d: (counts[4][d] + above[parents[d]] * size) / (n + size) for d, n in counts[1].items()}
    _, size = plain_prior(groups[0])
    out = {}
    for host, n in counts[0].items():
        rate = (counts[3][host] + above[chain[host][0]] * size) / (n + size)
        out[host] = (n, counts[3][host], rate, rate - urls.SURE * math.sqrt(rate * (1 - rate) / (n + size + 1)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_rates_level_by_level(spark, seed):
    rng = random.Random(seed)
    rows = []
    for d in range(12):
        suffix = rng.choice(["com", "org", "co.uk", "uk"])
        rate = rng.choice([0.02, 0.3, 0.95])
        for h in range(rng.randint(1, 4)):
            rows += [(f"h{h}.d{d}.{suffix}", rng.random() < rate) for _ in range(rng.choice([1, 3, 200]))]
    rows += [("com", True), ("co.uk", False), ("h0.d0.org", None), ("none.org", None)]
    if seed == 3:
        rows = [(h, None if b is None else False) for h, b in rows]
    frame = spark.createDataFrame(rows, "host string, bad boolean").repartition(3)
    found = {h: tuple(x) for h, *x in reputation(frame, ("co.uk",)).collect()}
    wanted = plain_rates(rows)
    assert found.keys() == wanted.keys()
    assert all(found[h] == pytest.approx(wanted[h], rel=1e-9) for h in wanted)


def test_outcomes_follow_the_text(spark, tmp_path):
    """Numbers of pages and documents have nothing to do with each other; the text tells whose label it is."""
    rng = random.Random(5)
    texts = {k: plain.words(rng, 30) + "\n<b> & " + plain.words(rng, 9) for k in range(60)}
    labels = {k: (int(k % 3 > 0), 0) for k in range(60) if k % 5} | {70: (0, 0)}
    docs = plain.frame(spark, [*texts.items(), (70, texts[1]), (71, None), (72, "")])
    pages = []
    for k in range(90):
        doc = rng.randrange(60)
        lines = (html.escape(x) for x in texts[doc].split("\n"))
        host = f"h{doc % 3}.example.net"
        body = f"<nav>Home</nav><article><h1>{texts[doc][:9]}</h1><p>{'</p> <p>'.join(lines)}</article><p>More"
        pages.append((k, f"http://{host}/x", body, doc))
    pages += [(90, "http://h1.example.net/", None, None), (91, "http://h1.example.net/", "<p>none", None)]
    wanted = {}
    for _, url, _, doc in pages:
        told = [labels[d] == (0, 0) for d in labels if doc is not None and texts.get(d, texts[1]) == texts[doc]]
        if told:
            n, k = wanted.get(url.split("/")[2], (0, 0))
            wanted[url.split("/")[2]] = n + 1, k + any(told)
    frames = {
        "pages": spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string"),
        "labels": spark.createDataFrame([(k, *v) for k, v in labels.items()], "doc_id long, quality int, toxic int"),
        "documents": docs,
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    found = page_outcomes(frames["pages"], docs, frames["labels"]).collect()
    got = Counter(r["url"].split("/")[2] for r in found), Counter(r["url"].split("/")[2] for r in found if r["bad"])
    assert {h: (n, got[1][h]) for h, n in got[0].items()} == wanted
    verdicts = {r["host"]: r["verdict"] for r in op1_url_reputation(spark, str(tmp_path)).collect()}
    assert verdicts == {"h0.example.net": "block", "h1.example.net": "allow", "h2.example.net": "allow"}


@pytest.mark.parametrize("clashes", [False, True])
def test_language_model(spark, clashes):
    rows = plain.awkward(8) + [(300 + k, ("the cat sat on the mat " * 9)[: 20 + k]) for k in range(80)]
    found = scored(plain.frame(spark, rows, clashes).repartition(3)).collect()
    tokens = [[*(w for w in plain.SPACE.findall((t or "").lower())), None] for _, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n = sum(counts.values())
    wanted = {}
    for (i, _), ws, h in zip(rows, tokens, held):
        base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in ws)
        wanted.setdefault(i, []).append((h, len(ws), sum(w in counts for w in ws), n, round(base, 6)))
    assert len(found) == len(rows)
    for r in found:
        assert (r[1], r[2], r[3], r[4], round(r[5], 6)) in wanted[r["doc_id"]]
        assert r["score"] < 0 and math.isfinite(r["score"])
    result = {r["held_out"]: r for r in perplexities(spark.createDataFrame(found)).collect()}
    assert result[True]["perplexity"] < result[True]["base_perplexity"]
    assert scored(plain.frame(spark, [])).count() == 0


def test_large_buckets_are_dealt(spark, monkeypatch):
    """With small blocks and a low limit, some or all buckets are dealt to several tasks."""
    import featloom.llm.pitman_yor as lm

    monkeypatch.setattr(lm, "BLOCK", 500)
    docs = plain.frame(spark, plain.awkward(9) + [(300 + k, "the cat sat on the mat") for k in range(80)])

    def rows(hot_bytes):
        found = scored(docs, hot_bytes=hot_bytes).collect()
        return sorted((r["doc_id"] or -1, r["n_known"], round(r["base_score"], 6), round(r["score"], 4)) for r in found)

    assert rows(1 << 30) == rows(1500) == rows(100)


def test_pairs_are_on_disk_once(spark, monkeypatch):
    """What a step was made of goes with it; what is shuffled goes with its job, and the setting comes back."""
    import featloom.llm.pitman_yor as lm
    from featloom.session import CLEAN_UP, shared_folder

    gone, seen = [], []
    monkeypatch.setattr(lm, "delete_path", lambda s, path: (seen.append(s.conf.get(CLEAN_UP)), gone.append(path), delete_path(s, path)))
    docs = plain.frame(spark, plain.awkward(3) + [(300 + k, f"the cat sat on mat {k % 9}") for k in range(80)])
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    found = scored(docs)
    left = [p.name.split("-")[0] for p in set(folder.iterdir()) - before if list(p.rglob("*.parquet"))]
    # and two tables of totals
    assert sorted({*left}) == ["blocks", "checkpoint", "logs", "questions"] and left.count("checkpoint") <= 2
    assert not any(Path(p.removeprefix("file:")).exists() for p in gone)
    # what blocks sent, and the buckets made of it, slice by slice
    assert sum(f"kind={lm.COUNTS}/slice=" in p for p in gone) == sum("wholes-" in p for p in gone) == lm.SLICES
    assert sum("/replies-" in p for p in gone) >= 5
    assert set(seen) == {"true"} and spark.conf.get(CLEAN_UP) == "false"
    assert found.count() == docs.count()


def test_blocks_of_very_many_pairs(monkeypatch):
    """Pairs and documents that do not fit one number give the same rows."""
    import featloom.llm.pitman_yor as lm

    texts = [(t or "").encode() for _, t in plain.awkward(5)]
    ids = list(range(len(texts)))
    rows = lm.block_rows(7, ids, texts, 24)
    monkeypatch.setattr(lm, "KEY_BITS", 0)
    assert lm.block_rows(7, ids, texts, 24) == rows
    assert sum(int(lm.opened(r[2])[3].sum()) for r in rows[1:]) == sum(len(t.split()) + 1 for i, t in zip(ids, texts) if not lm.is_held_out(i))


def test_few_dishes_are_seated_alike(monkeypatch):
    import featloom.llm.pitman_yor as lm

    rng = np.random.default_rng(5)
    count = np.minimum(rng.zipf(1.6, 2000) + 1, 100_000)
    above, others = rng.random(2000) * 0.02, rng.integers(0, 20_000, 2000)
    found = []
    for few in (0, 16, 1 << 30):
        monkeypatch.setattr(lm, "FEW", few)
        found.append(seated(count, above, others, 0.7, np.random.default_rng(3)).tolist())
    assert found[0] == found[1] == found[2]


def test_every_word_before_has_a_restaurant(spark):
    """3000 words, each followed by one of its own: what follows is likely however many there are."""
    ids = (k for k in range(1, 100_000))
    rows = [(next(i for i in ids if zlib.crc32(str(i).encode()) % 7 != 2), f"c{k} s{k}") for k in range(3000) for _ in range(3)]
    probes = [(next(i for i in ids if zlib.crc32(str(i).encode()) % 7 == 2), f"c{k} s{k}") for k in range(0, 3000, 30)]
    found = scored(plain.frame(spark, rows + probes)).where("held_out")
    scores = [r["score"] for r in found.collect()]
    assert len(scores) == 100
    # the first word has one chance in 3000; the other two steps were seen three times out of three
    assert min(10**x for x in scores) * 3000 > 0.2


def test_model_probabilities_sum_to_one(spark):
    """Documents of one word: the chances of all words after the start, and of a new one, are one."""
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(12)]
    rows = [(k, rng.choice(vocabulary[: 1 + k % 12])) for k in range(200)]
    train = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    known = {t for _, t in train}
    ids = (k for k in range(10_000, 20_000) if zlib.crc32(str(k).encode()) % 7 == 2)
    probes = {w: next(ids) for w in [*sorted(known), "new"]}
    empty = next(ids)
    docs = plain.frame(spark, train + [(i, w) for w, i in probes.items()] + [(empty, "")])
    scores = {r["doc_id"]: r["score"] for r in scored(docs).collect()}
    # each text is its word and the end; after a known word the end has a chance of its own
    starts = sum(10 ** scores[i] for w, i in probes.items()) + 10 ** scores[empty]
    assert 0.5 < starts <= 1.0 + 1e-6


def test_seating():
    rng = np.random.default_rng(0)
    count = np.array([1, 2, 5, 40, 10_000, 1_000_000])
    tables = np.mean([seated(count, np.full(6, 0.01), np.full(6, 50), 0.7, rng) for _ in range(200)], axis=0)
    assert tables[0] == 1 and (np.diff(tables) >= 0).all() and (tables <= count).all() and tables[-1] > 5
    # against one customer after the other
    slow = []
    for _ in range(200):
        t = 1
        for seats in range(1, 2000):
            new = (1 + 0.7 * (50 + t)) * 0.01
            t += rng.random() * (new + seats - 0.7 * t) < new
        slow.append(t)
    fast = [seated(np.array([2000]), np.array([0.01]), np.array([50]), 0.7, rng)[0] for _ in range(200)]
    assert np.mean(fast) == pytest.approx(np.mean(slow), rel=0.1)


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var t='</p>';</script></head><body><nav><ul>"
    "<li><a href='/a'>Home</a></li><li><a href='/b'>About</a></li></ul></nav><!-- <p>no</p> --><div class='ad'>Buy this "
    "thing now.</div><article><h1>Head &amp; line</h1><p><b>First  words\n of it.<br><p>Second &lt;part&gt;&nbsp;here, which "
    "is longer than the first.</p><p>Third part of the text, long enough to be read.</p></article><footer>&copy; me</footer>"
)
MAIN = "Head & line\nFirst words of it.\nSecond <part> here, which is longer than the first.\nThird part of the text, long enough to be read."


def test_blocks():
    found = [b.text for b in blocks(PAGE)]
    assert found == ["T", "Home", "About", "Buy this thing now.", *MAIN.split("\n"), "© me"]
    for broken in ("", "<", "<a", "<p", "plain", "<b a='>", "</p></div>", "<script>x", "<div>" * 2000 + "x", "<p>" * 2000, "a<1 b"):
        assert isinstance(blocks(broken), list)


def test_quotes_within_tags():
    """A quote opens a string only after an equals sign; elsewhere the first > ends the tag."""
    for page, wanted in (
        ("<p data-t=it's>One.</p><p>Two isn't it.</p>", ["One.", "Two isn't it."]),
        ('<p class="x"">Text', ["Text"]),
        ("<p a = 'x>y' b=\"'>\">z", ["z"]),
        ("<p a=>t<p a==\"x>u", ["t", "u"]),
    ):
        assert [b.text for b in blocks(page)] == wanted


def test_viterbi_is_the_best_path():
    rng = random.Random(3)
    for _ in range(60):
        model = crf.Model({f"f{k}": rng.gauss(0, 2) for k in range(5)}, (rng.gauss(0, 1), rng.gauss(0, 1)), tuple((rng.gauss(0, 2), rng.gauss(0, 2)) for _ in range(2)))
        rows = [[f"f{rng.randrange(6)}"] for _ in range(6)]

        def total(path):
            score = model.start[path[0]] + sum(model.steps[a][b] for a, b in zip(path, path[1:]))
            return score + sum(sum(model.weights.get(f, 0) for f in r) for r, y in zip(rows, path) if y)

        best = max((total([n >> k & 1 for k in range(6)]), [n >> k & 1 for k in range(6)]) for n in range(64))
        assert total(list(map(int, viterbi(model, rows)))) == pytest.approx(best[0])
    assert viterbi(model, []) == []


def real_pages(spark, sf="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{sf}/pages.parquet")


def test_held_out_pages(spark):
    pages = [r["html"] for r in real_pages(spark).orderBy("page_id").collect()]
    train = [x for k, page in enumerate(pages[:150]) for x in labelled(page, k)]
    model = trained([(features(found), marks) for found, marks in train])
    right = total = 0
    for k, page in enumerate(pages[150:]):
        for found, marks in labelled(page, k):
            labels = viterbi(model, features(found))
            right += sum(a == b for a, b in zip(labels, marks))
            total += len(marks)
    assert right / total > 0.98
    assert main_text(PAGE, model) == MAIN


PLAIN = (
    "<body><nav><a href='/'>Home {0}</a></nav><div class='content'><h1>Head {0}</h1><p>The first part of page {0} has some words "
    "to be read.</p><p>The second part of page {0} has a few more words than that.</p></div><div class='footer'>&copy; {0}</div>"
)


def test_pages_that_mark_no_main_text(spark):
    """Marked pages are found among many others; without any, the layouts are what the model knows."""
    schema = "page_id long, url string, html string"
    plain_pages = [(k, "u", PLAIN.format(k)) for k in range(300)]
    marked = [(1000 + k, "u", PLAIN.format(k).replace("div class='content'", "article")) for k in range(3)]
    hidden = [(2000, "u", "<!-- <article>x</article> -->" + PLAIN.format(9))]
    pages = spark.createDataFrame(plain_pages + marked + hidden, schema)
    given = pages.selectExpr("page_id as id", "html as page")
    assert sorted(crf.sampled(given, 2, True))[0] in {p for _, _, p in marked}
    assert sorted(crf.sampled(given, 200, True)) == sorted(p for _, _, p in marked)
    for rows in (plain_pages, plain_pages + hidden):
        for r in extracted(spark.createDataFrame(rows, schema)).collect():
            assert "The second part" in r["text"] and "Home" not in r["text"] and "©" not in r["text"]


def test_extraction(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", PAGE), (1, "u", PAGE)]
    pages = real_pages(spark).select("page_id", "url", "html").unionByName(
        spark.createDataFrame(rows, "page_id long, url string, html string")
    ).selectExpr("*", "'x' as text", "1 as n_chars")
    found = extracted(pages).collect()
    assert len(found) == 255
    got = [(r["page_id"], r["url"], r["text"]) for r in found]
    assert got.count((1, "u", MAIN)) == 2 and (None, "u", MAIN) in got and (2, None, "") in got and (3, "u", "") in got
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert extracted(pages.limit(0)).count() == 0
