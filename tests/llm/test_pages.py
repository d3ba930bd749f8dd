"""Main text of pages unlike the given ones, and the parts of the model against slow versions."""

from __future__ import annotations

import itertools
import math
import random
import time

import numpy as np
import pytest

from featloom.llm import crf
from featloom.llm.crf import blocks, features, labelled, main_text, trained

FIRST = "The harbour was rebuilt after the long storm, and the town voted to pay for the work over ten years."
SECOND = "Engineers from the north came to look at the walls, which had stood for more than two hundred years."
THIRD = "In the end the council chose stone, because it lasts longer than wood and needs fewer repairs each year."
JUNK = "Buy our new garden tools today and save up to forty percent on every single order you make this week."
TOP = '<html><head><title>t</title></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>'
END = "<footer><p>&copy; 2024 Town News. All rights reserved.</p></footer></body></html>"
TITLE = "A harbour rebuilt"
TEXT = "\n".join([TITLE, FIRST, SECOND, THIRD])


def story(middle="", end=""):
    return f"<h1>{TITLE}</h1><p>{FIRST}</p>{middle}<p>{SECOND}</p><p>{THIRD}</p>{end}"


def article(middle="", end="", after=""):
    return f"{TOP}<article>{story(middle, end)}</article>{after}{END}"


SHAPES = {
    "advert": article(f'<div class="ad"><p>{JUNK}</p></div>'),
    "aside": article(f"<aside><p>{JUNK}</p></aside>"),
    "notice": article(f'<div class="newsletter-signup"><p>{JUNK}</p></div>'),
    "form": article(end="<form><label>Email</label><input name=e><button>Send</button></form>"),
    "related": article(end='<aside class="related"><h4>Related</h4><ul><li><a href="/x">Another</a></li></ul></aside>'),
    "comments": article(after=f'<section class="comments"><h2>Comments</h2><div><p>{JUNK}</p></div></section>'),
    "comments within": article(end=f'<div id="comments"><h3>Comments</h3><p>{JUNK}</p><p>Nice one.</p></div>'),
    "comments as articles": f'{TOP}<main><article>{story()}</article><section id="comments"><h2>2 comments</h2>'
    f'<article class="comment"><p>{JUNK}</p></article><article class="comment"><p>Nice.</p></article></section></main>{END}',
    "nothing named": f'<html><body><div><a href="/">Home</a> <a href="/n">News</a></div><div><h1>{TITLE}</h1><div>{FIRST}</div>'
    f"<div>{SECOND}</div><div>{THIRD}</div></div><div>&copy; 2024 Town News</div></body></html>",
    "teasers": f'{TOP}<main>{story()}</main><article><h3><a href="/a">Other news</a></h3><p>Read more about this.</p></article>'
    f'<article><h3><a href="/b">Weather today</a></h3><p>It rains in the west.</p></article>{END}',
    "named main": f'{TOP}<div id="main">{story()}</div>{END}',
}


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").selectExpr("page_id as id", "html as page")
    pages = crf.sampled(rows, crf.SAMPLE, True)
    examples = [x for k, page in enumerate(pages) for x in labelled(page, k)]
    return trained([(features(found), marks) for found, marks in examples])


@pytest.mark.parametrize("name", SHAPES)
def test_other_shapes(model, name):
    assert main_text(SHAPES[name], model) == TEXT


def test_same_sample_in_any_partitioning(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").selectExpr("page_id as id", "html as page")
    once = crf.sampled(rows, 40, True)
    assert len(once) == 40
    assert crf.sampled(rows.repartition(7), 40, True) == once
    assert crf.sampled(rows.unionByName(rows.limit(0)).orderBy("page"), 40, True) == once


def test_comments_of_the_standard():
    for page, wanted in (
        ("<!--><p>A</p><!-- x -->B", ["A", "B"]),
        ("<!---><p>A</p>", ["A"]),
        ("<!-- x --!><p>A</p><!-- <p>no</p> -->", ["A"]),
        ("<p>A</p><!-- never closed <p>no</p>", ["A"]),
        ("a < b <!-- c", ["a < b"]),
    ):
        assert [b.text for b in blocks(page)] == wanted


def test_time_is_linear_in_nesting():
    for page in (
        "<b>" * 100_000 + "x" + "</b>" * 100_000,
        "<b><div>" + "<i>" * 50_000 + "x" + "</b>" * 50_000,
        "<div><p>" * 50_000 + "x",
        "<x" * 100_000,
    ):
        begin = time.time()
        blocks(page)
        assert time.time() - begin < 20


def test_labels_leave_out_what_is_named_otherwise():
    found, marks = labelled(SHAPES["advert"], 0)[0]
    assert "\n".join(b.text for b, mark in zip(found, marks) if mark) == TEXT
    found, marks = labelled(SHAPES["comments as articles"], 0)[0]
    assert "\n".join(b.text for b, mark in zip(found, marks) if mark) == TEXT
    assert labelled("<p>x</p>", 0) == []


def log_likelihood(score, lengths, y, edge):
    """By all label paths of each page."""
    start, steps = edge[:2], edge[2:].reshape(2, 2)
    total = 0.0
    for page, length in enumerate(lengths):
        def weight(path):
            inner = sum(steps[a][b] for a, b in zip(path, path[1:]))
            return start[path[0]] + inner + sum(score[page][k] for k in range(length) if path[k])

        paths = itertools.product((0, 1), repeat=length)
        total += weight([int(v) for v in y[page][:length]]) - math.log(sum(math.exp(weight(p)) for p in paths))
    return total


def test_slope_is_that_of_the_likelihood():
    rng = random.Random(5)
    lengths = [4, 1, 6]
    score = np.array([[rng.gauss(0, 1) if k < n else 0.0 for k in range(6)] for n in lengths])
    real = np.array([[k < n for k in range(6)] for n in lengths])
    y = np.array([[rng.randrange(2) if k < n else 0 for k in range(6)] for n in lengths])
    edge = np.array([rng.gauss(0, 1) for _ in range(6)])
    main, rest = crf.likelihood_slope(score, real, y, edge)
    step = 1e-5
    for page, k in zip(*np.nonzero(real)):
        moved = [score.copy(), score.copy()]
        moved[0][page, k] += step
        moved[1][page, k] -= step
        high, low = (log_likelihood(m, lengths, y, edge) for m in moved)
        assert main[page, k] == pytest.approx((high - low) / (2 * step), abs=1e-6)
    for k in range(6):
        moved = [edge.copy(), edge.copy()]
        moved[0][k] += step
        moved[1][k] -= step
        high, low = (log_likelihood(score, lengths, y, m) for m in moved)
        assert rest[k] == pytest.approx((high - low) / (2 * step), abs=1e-6)
