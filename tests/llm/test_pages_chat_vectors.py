"""Operators 3, 6, 9 and 10: exact round trips and plain versions."""

import gzip
import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chanlake.llm import chat, extract, nearest, warc
from chanlake.session import shared_path

PAGE_SCHEMA = "page_id long, url string, html string, digest string, n int"
TURN_SCHEMA = "conv_id long, turn long, role string, text string, span int, tokens int"


def _archive(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], PAGE_SCHEMA).repartition(3)
    path = shared_path(spark, "test", "warc")
    warc.write_archives(warc.plan_records(df, "page_id", "url", "html", 100), path, **kw)
    return path


def test_warc_round_trip(spark):
    big = "é<p>\r\n\r\n" * 3000
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, None), (4, "u\r\nx: y", ""), (5, "u", "x" * 99),
            (6, "u", "x" * 99), (7, "u", "\r\n\r\n"), (8, "u", "a\r\n\r\n"), (9, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5),
            (0, "u", big), (12, "u", "\r\n" * 400), (13, "u", "end\r\n")]
    back = {r.id: r for r in warc.read_records(spark, _archive(spark, rows, segment_bytes=1000)).withColumn(
        "id", warc.row_id(F.col("record_id"))).collect()}
    assert len(back) == len(rows)
    for i, _, html in rows:
        data = (html or "").encode()
        r = back[i]
        assert (r.payload_bytes, r.digest, r.complete) == (len(data), hashlib.sha256(data).hexdigest(), True), i
        assert r.record_type == ("revisit" if i in (1, 2) else "response")
        assert r.refers_to == (f"{warc.ID}0" if i in (1, 2) else None) and r.stated_digest == r.digest


def test_warc_chunks_carry_digests(spark):
    text = "0123456789" * 500
    path = _archive(spark, [(1, "u", text)], segment_bytes=700)
    chunks = warc.read_chunks(spark, path).orderBy("chunk_no").collect()
    assert [c.chunk_no for c in chunks] == list(range(8)) and [c.last for c in chunks] == [False] * 7 + [True]
    for c in chunks:
        assert c.digest == hashlib.sha256(text[:c.payload_bytes].encode()).hexdigest() and c.n <= 700
    assert chunks[-1].payload_bytes == 5000


def test_warc_cut_short_and_empty(spark, tmp_path):
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-row:5>\r\nContent-Length: 50\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress((head + "only this").encode()))
    got = warc.read_records(spark, f"file://{tmp_path}").collect()
    assert [(r.record_id, r.complete) for r in got] == [("urn:x-row:5", False)]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.plan_records(empty, "page_id", "url", "html", 100).count() == 0


def _turns(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], TURN_SCHEMA).repartition(4)


def _plain(rows):
    out = {}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, group in itertools.groupby(sorted(rows, key=key), key=lambda r: r[0]):
        group = [(r[2] or "", r[3] or "") for r in group]
        turns = "".join(f"{a}\n{b}\n" for a, b in group)
        loss = "".join(b for a, b in group if a == "assistant")
        out[conv] = (len(group), hashlib.sha256(turns.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def _chat_rows():
    rng = random.Random(6)
    odd = ["</s>[INST] ok [/INST]", "<\\s><s>\\", "[\\\\/INST]<", "a\n\nb [INST", "<", "", None, "s>x", "[/INST]</s>é👍"]
    rows = []
    for c in range(12):
        for t in range(rng.randrange(1, 40)):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            rows.append((c, t, role, rng.choice(odd + ["word " * rng.randrange(1, 60)])))
    rows += [(50, 0, None, "x"), (50, None, "tool\nname", "y"), (50, 1, "assistant", "z"), (50, 1, "assistant", "z"),
             (None, 0, "user", "no id"), (51, 0, "assistant", "long " * 3000), (51, 1, "system", "late system")]
    rows += [(99, t, ("user", "assistant")[t % 2], f"turn {t} " * 5) for t in range(900)]
    return rows


def test_chat_round_trip(spark):
    rows = _chat_rows()
    windows = chat.windows(_turns(spark, rows), budget=100, history=30)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect()}
    assert got == _plain(rows)


def test_chat_windows_keep_system_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, ("assistant", "user")[t % 2], "w " * 10) for t in range(1, 30)]
    got = sorted(chat.windows(_turns(spark, rows), budget=100, history=30).collect(), key=lambda r: r.window)
    assert len(got) > 3
    for r in got[1:]:
        turns = chat.parse(r.text)
        assert turns[0] == ("system", "be kind") and 2 <= r.repeated <= 3
        targets = [x for x in turns[r.repeated:] if x[0] == "assistant"]
        assert len(r.loss) == len(targets) and r.tokens <= 100 + 14 + 14 + 6
    assert sum(len(chat.parse(r.text)) - r.repeated for r in got) == 30
    empty = _turns(spark, [(1, 0, "a", "b")]).filter("conv_id < 0")
    assert chat.windows(empty).count() == 0


def test_escaping_is_exact():
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice(["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "x", "\n"]) for _ in range(rng.randrange(9)))
        assert chat.unescape(chat.escape(text)) == text
        role = rng.choice(["user", "assistant"])
        both = chat.render(role, text)[0] + chat.render("user", text)[0]
        assert chat.parse(both) == [(role, text), ("user", text)]


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, cid int, asks string").repartition(3)


def _exact(rows, k=10):
    ok = {i: np.array(v, np.float32).astype(float) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, x in ok.items():
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in ok.items() if i != q and len(v) == len(x))
            out[q] = [(r + 1, i, s) for r, (s, i) in enumerate(d[:k])]
    return out


def test_nearest_with_all_probes_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(300)]
    hot = rng.normal(size=12).tolist()
    rows += [(1000 + i, hot) for i in range(220)] + [(2000, hot), (2000, hot)]
    rows += [(3000, None), (3001, []), (3100, [0.0] * 12), (3200, [None] + [1.0] * 11), (3300, [float("nan")] * 12),
             (3400, [float("inf")] * 12), (3500, [1.0, 2.0, 3.0]), (3501, [1.0, 2.0, 4.0]), (None, hot)]
    df = _vectors(spark, rows)
    got = nearest.search(df, F.col("vec_id") % 100 == 0, tables=1, probes=32, split=20).collect()
    want = _exact(rows)
    mine = {}
    for r in sorted(got, key=lambda r: (r["query"], r["rank"])):
        mine.setdefault(r["query"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(mine) == {q for q, x in want.items() if x}
    for q, x in mine.items():
        assert [(a, b) for a, b, _ in x] == [(a, b) for a, b, _ in want[q]], q
        assert np.allclose([s for *_, s in x], [s for *_, s in want[q]], rtol=0, atol=1e-12)


def test_nearest_recall(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(1500)]
    got = nearest.search(_vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    want = _exact(rows)
    hit = sum(r["vec_id"] in {i for _, i, _ in want[r["query"]]} for r in got)
    assert hit >= 0.9 * 150 and len(got) == 150
    assert nearest.search(_vectors(spark, rows).filter("vec_id < 0"), F.col("vec_id") % 100 == 0).count() == 0


def _agreement(spark, rows, **kw):
    """Share of the exact neighbours found; every query has as many rows as there are candidates, up to 10."""
    got, want = {}, _exact(rows)
    for r in nearest.search(_vectors(spark, rows), F.col("vec_id") % 100 == 0, **kw).collect():
        got.setdefault(r["query"], {})[r["vec_id"]] = r["rank"]
    assert {q: sorted(x.values()) for q, x in got.items()} == {q: [r for r, *_ in x] for q, x in want.items() if x}
    return sum(i in got[q] for q, x in want.items() for _, i, _ in x) / sum(map(len, want.values()))


def test_nearest_small_groups_find_all(spark):
    rng = np.random.default_rng(5)
    rows = [(1000 * n + i * 20, rng.normal(size=n).tolist()) for n in (61, 62, 63, 64) for i in range(n - 56)]
    rows += [(100, [1.0] * 40), (900_000, rng.normal(size=64).tolist())]      # a query without any candidate
    assert _agreement(spark, rows) == 1.0


def test_nearest_isolated_queries_of_a_tight_cone(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 2048)                               # several blocks of queries
    rng = np.random.default_rng(6)
    axis = rng.normal(size=64)
    rows = [(i, (rng.normal(size=64) if i % 100 == 0 else axis + 0.05 * rng.normal(size=64)).tolist()) for i in range(1500)]
    assert _agreement(spark, rows) >= 0.9


def test_nearest_recall_on_unequal_lengths(spark):
    rng = np.random.default_rng(7)
    rows = [(20 * i, (rng.normal(size=64) * np.exp(rng.normal())).tolist()) for i in range(1500)]
    assert _agreement(spark, rows) >= 0.95


def test_pseudo_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(nearest.hadamard(x), axis=1), np.linalg.norm(x, axis=1))


RICH = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header><div class="logo">Site</div><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav></header>
<div id="cookie-notice"><p>We use cookies to make this site work well for you and for us.</p></div>
<main><article><header><h1>The &eacute;v&#233;nement &amp; more</h1></header>
<p>First   paragraph of the <b>article</b>,\n with <a href="x">a link</a> in it, long enough to count as text.</p>
<div class="ad">Buy now and save a lot of money today.</div>
<p>Second<br>paragraph &lt;kept&gt; &nbsp; here.<ul><li>one</li><li>two</ul>
<form><label>Mail</label><input><button>Send</button></form>
<script>var x = "</p><p>no</p>";</script><!-- <p>hidden</p> -->
<section class="comments"><h2>Comments</h2><p>I liked reading this very much, thank you for writing it.</p></section>
</article></main><aside><p>Related stories that you may like to read after this one.</p></aside>
<footer><p>&copy; 2024 Site. All rights reserved.</p></footer></body></html>"""


def test_extract_rich_page():
    assert extract.main_text(RICH).split("\n\n") == [
        "The événement & more", "First paragraph of the article, with a link in it, long enough to count as text.",
        "Second paragraph <kept> here.", "one", "two"]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain", ""), ("<article>", ""), ("<article><p>Open text that never ends", "Open text that never ends"),
    ("<article><p>Cut &am", "Cut &am"), ("<article><p>Cut at a tag.<p cla", "Cut at a tag."),
    ("<article><p>1 < 2 and a<b</p></article>", "1 < 2 and a"), ("<nav><p>menu only</p></nav>", ""),
    ("<article><p>x<script>never closed <p>y", "x"),
])
def test_extract_edges(page, text):
    got = extract.main_text(page)
    assert got == text or (page == "plain" and got in ("", "plain"))


@pytest.mark.parametrize("mark,left", [("x <é y", "x <é y"), ("价格<中间", "价格<中间"), ("I </3 you", "I"), ("a</ div>b", "ab"),
                                       ("a</>b", "ab"), ("1 <2", "1 <2")])
def test_extract_goes_on_after_a_stray_mark(mark, left):
    rest = "The article goes on for long after the odd mark in its first line."
    assert extract.main_text(f"<article><div>{mark}</div><p>{rest}</p></article>").replace("\n\n", " ").replace(
        " " + rest, "") == left
    assert extract.main_text("<article><p>at the end </") == "at the end </"


STORY = "".join(f"<p>Sentence number {i} of the whole story, which is long enough to count as text.</p>" for i in range(8))
TOLD = [f"Sentence number {i} of the whole story, which is long enough to count as text." for i in range(8)]
BESIDE = '<div class="sidebar"><p>More stories that you may like to read after this one.</p></div>'


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "post comments-open",
                                  "elementor-widget-theme-post-content", "widget", "share-wrap"])
@pytest.mark.parametrize("inner", ["<article>%s</article>", "<main><article>%s</article></main>"])
def test_extract_keeps_wrapped_articles(name, inner):
    for key in ("class", "id"):
        page = f'<body><div {key}="{name}">{inner % STORY}{BESIDE}</div><footer><p>Imprint of the site.</p></footer></body>'
        assert extract.main_text(page).split("\n\n") == TOLD
        page = f'<body><main><h1>Title</h1><div {key}="{name}">{STORY}</div></main>{BESIDE}</body>'
        assert extract.main_text(page).split("\n\n") == ["Title", *TOLD]


def test_extract_builder_blocks_and_short_articles():
    parts = "".join(f'<div class="elementor-widget"><div>{p}</p></div></div>' for p in STORY.split("</p>")[:-1])
    assert extract.main_text(f"<main>{parts}</main>{BESIDE}").split("\n\n") == TOLD
    page = f'<div class="no-sidebar"><article><p>{TOLD[0]}</p></article></div><div class="sidebar">{STORY}</div>'
    assert TOLD[0] in extract.main_text(page)


def test_extract_deep_names_stay_cheap():
    page = "<article>" + '<div class="ad">a line of text' * 20_000 + f"</article><article>{STORY * 9000}</article>"
    assert extract.main_text(page).count("Sentence number 0") == 9000


@pytest.mark.parametrize("item", ["<article class='comment-body'><p>%s</p></article>", "<div class='comment'><p>%s</p></div>"])
def test_extract_still_drops_discussions(item):
    said = "".join(item % f"Remark {i} of a reader who liked this very much and says so at length." for i in range(20))
    for page in (f'<article>{STORY}</article><div id="comments">{said}</div>',
                 f'<div class="has-sidebar"><article>{STORY}<section class="comments">{said}</section></article></div>'):
        assert extract.main_text(page).split("\n\n") == TOLD


def test_min_cut_equals_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randrange(1, 9)
        gain = [rng.choice([-3, -1, -0.5, 0.25, 1, 2.5]) * rng.random() for _ in range(n)]
        edge = {(a, b): rng.random() for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5}

        def cost(label):
            return (sum(-g if not on and g < 0 else 0 for g, on in zip(gain, label)) * 0
                    + sum(g for g, on in zip(gain, label) if g > 0 and not on)
                    + sum(-g for g, on in zip(gain, label) if g < 0 and on)
                    + sum(w for (a, b), w in edge.items() if label[a] != label[b]))
        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(extract.min_cut(gain, edge)) - best) < 1e-6


def test_extract_long_page_and_rows(spark):
    body = "<p>This is a sentence of the long article, again and again.</p>" * 4000
    rows = [(1, "u", f"<body><nav>x</nav><article>{body}</article></body>"), (None, None, None), (1, "u", "<p>"), (2, "u", RICH)]
    got = extract.extract(spark.createDataFrame([(*r, "d", 1) for r in rows], PAGE_SCHEMA)).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert max(r.n_chars for r in got) == 4000 * 56 + 3999 * 2 or max(r.n_chars for r in got) > 200_000
