"""Operator 10: the fitted classifier, whole pages against every labelling, pages without markup."""

import itertools
import random

import numpy as np
import pytest

from chanlake.llm import extract

PAGES = "page_id long, url string, html string, k long, n string, total string"
LONG = "A paragraph of the story that is told at some length, with a good many words in it, so that nobody takes it for a link."


def _pages(spark, htmls):
    return spark.createDataFrame([(i, f"u{i}", h, 1, "x", "y") for i, h in enumerate(htmls)], PAGES).repartition(3)


def _texts(spark, htmls, **kw):
    return {r["page_id"]: r["text"] for r in extract.extract(_pages(spark, htmls), **kw).collect()}


def test_pages_without_markup_return_their_text():
    cases = {
        f"<div><p>Short one.</p><p>{LONG}</p><ul><li>one</li><li>two</li></ul></div>": f"Short one.\n\n{LONG}\n\none\n\ntwo",
        f"<div><p>Yes</p><p>No way</p><p>{LONG}</p></div>": f"Yes\n\nNo way\n\n{LONG}",
        "<p>Hello</p>": "Hello",
        "plain text": "plain text",
        f"<div><a href=a>Home</a> <a href=b>News</a></div><div><h1>Title</h1><p>{LONG}</p></div>": f"Title\n\n{LONG}",
        f"<div>menu</div><article><p>{LONG}</p></article><div>other</div>": LONG,
        "": "", None: "",
    }
    for page, want in cases.items():
        assert extract.main_text(page) == want, page


def _page(rng):
    """A small page with and without markup."""
    parts = []
    for _ in range(rng.randrange(1, 8)):
        text = rng.choice(["Yes", "No way", LONG, "A short one.", "<a href=x>Link</a>", "<a href=x>More links</a> here", "12"])
        parts.append(rng.choice(["<p>{}</p>", "<div>{}</div>", "<li>{}</li>", "<h2>{}</h2>", "<nav>{}</nav>",
                                 "<article><p>{}</p></article>", "<div class=sidebar>{}</div>"]).format(text))
    return f"<div>{''.join(parts)}</div>"


def test_whole_pages_against_every_labelling():
    """The labels of a page cost as little as any labelling, and on some pages the edges turn labels."""
    rng, turned = random.Random(8), 0
    for _ in range(400):
        blocks = extract.blocks_of(_page(rng))
        gain, edge = extract.costs(blocks), extract.edges(blocks)
        got = extract.min_cut(gain, edge)

        def cost(labels):
            return (sum(abs(g) for g, x in zip(gain, labels) if (g > 0) != x)
                    + sum(w for (a, b), w in edge.items() if labels[a] != labels[b]))
        best = min(map(cost, itertools.product([False, True], repeat=len(blocks))), default=0)
        assert cost(got) == pytest.approx(best)
        turned += sum(x != (g > 0) for x, g in zip(got, gain))
    assert turned > 20


def test_flow_is_reached(monkeypatch):
    """Text that markup leaves open goes through the flow, not only through the settling."""
    calls = []
    real = extract._dinic
    monkeypatch.setattr(extract, "_dinic", lambda nodes, *rest: calls.append(len(nodes)) or real(nodes, *rest))
    rng = random.Random(9)
    for _ in range(200):
        extract.main_text(_page(rng))
    assert len(calls) > 10


def test_weights_follow_the_marked_blocks(spark):
    """Where menus are long and stories short, the fitted weights say so; the page without markup is read by them."""
    usual = [f"<nav><a href=x>Go</a></nav><article><p>{LONG} {i}</p><p>Second part of it, as long as need be.</p></article>"
             for i in range(60)]
    w = extract.fit(_pages(spark, usual))
    assert w != extract.W_TEXT and w[1] < 0 < w[2]
    odd = [f"<nav><p>{LONG} {LONG} {i}</p></nav><article><p>tiny {i}</p></article>" for i in range(60)]
    v = extract.fit(_pages(spark, odd))
    assert v[2] < 0
    assert extract.fit(_pages(spark, ["<p>x</p>"])) == extract.W_TEXT
    assert extract.fit(_pages(spark, []).limit(0)) == extract.W_TEXT


def test_discriminant_separates():
    rng = np.random.default_rng(1)
    n, total, product = np.zeros(2), np.zeros((2, 5)), np.zeros((2, 5, 5))
    points = []
    for k in (0, 1):
        for _ in range(300):
            x = np.array([1.0, rng.normal(1 - k, 0.3), rng.normal(2 * k, 1), float(rng.random() < 0.2 + 0.6 * k), 0.0])
            points.append((k, x))
            n[k] += 1
            total[k] += x
            product[k] += np.outer(x, x)
    w = np.array(extract.discriminant(n, total, product))
    assert np.mean([(w @ x > 0) == bool(k) for k, x in points]) > 0.95


def test_results_do_not_depend_on_partitions_or_names(spark):
    rng = random.Random(10)
    htmls = [_page(rng) for _ in range(80)] + [None, "", "<p>" * 50, "<article>" + "<p>word</p>" * 500]
    one = _texts(spark, htmls)
    again = {r["page_id"]: r["text"] for r in extract.extract(_pages(spark, htmls).repartition(1)).collect()}
    assert one == again and one[80] == one[81] == one[82] == ""
    assert extract.extract(_pages(spark, []).limit(0)).collect() == []
