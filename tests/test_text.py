"""Text functions: golden vectors (FIXTURES.md section 3) and a seeded fuzz
against small pure-Python versions of the stated semantics."""

import random
import re

import pytest
from pyspark.sql import functions as F

from chanlake.functions import text as T
from chanlake.plans.cleaning import clean_frame

E = "\U0001F600"
GOLDEN = [
    # input, emojis, links, cleaned message
    (None, "No Emoji", [], "No Mesage"),
    ("", "No Emoji", [], ""),
    ("Price 10000 ብር", "No Emoji", [], "Price 10 ብር"),
    ("ሐኪም። ዓለም", "No Emoji", [], "ሀኪም አለም"),
    ("see http://a.b/c?x=1 ok", "No Emoji", ["http://a.b/c?x=1"], "se ok"),
    ("Call 0911-22-33", "No Emoji", [], "Cal 091-2-3"),
    (f"Helloo {E}{E} world", E + E, [], "Helo world"),
    ("www.shop.com now", "No Emoji", ["www.shop.com"], "now"),
    ("Hi \U0001F1EA\U0001F1F9", "No Emoji", [], "Hi \U0001F1EA\U0001F1F9"),
    ("❤️", "❤", [], "️"),
    ("\U0001F468‍\U0001F469‍\U0001F467 fam", "\U0001F468\U0001F469\U0001F467", [],
     "‍ fam"),
    ("© 2024 ™", "©™", [], "2024"),
    ("a\n\nb\tc", "No Emoji", [], "a b c"),
    ("end https://a.b/c, www.k.com.", "No Emoji", ["https://a.b/c,", "www.k.com."], "end"),
    ("https://www.x.com/?a=1?b=2", "No Emoji", ["https://www.x.com/?a=1?b=2"], ""),
]


def test_frame_golden(spark):
    rows = [(i, g[0], "2024-01-01T00:00:00", [f"m/{i}.jpg"], " c ") for i, g in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "group_id int, message string, date string, "
                                     "media_path array<string>, channel string")
    out = {r["group_id"]: r for r in clean_frame(df, "2025-01-01 00:00:00").collect()}
    for i, (_, emojis, links, cleaned) in enumerate(GOLDEN):
        assert out[i]["emojis"] == emojis, i
        assert out[i]["links"] == links, i
        assert out[i]["message"] == cleaned, i
        assert out[i]["channel"] == "c"


def test_single_functions(spark):
    df = spark.createDataFrame([("http://a/b?x=1?y=2 z", "10000", "\n\n", "\r\r", "a\n\nb ")],
                               "a string, b string, c string, d string, e string")
    r = df.select(T.normalize_links("a").alias("a"), T.collapse_repeats("b").alias("b"),
                  T.collapse_repeats("c").alias("c"), T.collapse_repeats("d").alias("d"),
                  T.clean_newlines("e").alias("e"),
                  T.clean_newlines(F.lit(None).cast("string")).alias("n"),
                  T.clean_text(F.lit("see https://a.b/c ok")).alias("t14")).first()
    assert r["a"] == "http://a/b?x=1 z"
    assert r["b"] == "10" and r["c"] == "\n\n" and r["d"] == "\r"
    assert r["e"] == "a b" and r["n"] == "No Message"
    assert r["t14"] == "se htps:/a.b/c ok"


def test_combine_messages(spark):
    df = spark.createDataFrame([([" a ", "", "  ", "b\n", None],)], "m array<string>")
    assert df.select(T.combine_messages("m").alias("x")).first()["x"] == "a\nb"


# --- fuzz --------------------------------------------------------------------

def _emoji_set():
    out = set()
    for tok in T.EMOJI_CODEPOINTS.split():
        lo, _, hi = tok.partition("-")
        out.update(range(int(lo, 16), int(hi or lo, 16) + 1))
    return out


EMOJI = _emoji_set()
FOLD = dict(zip(T.AMHARIC_FOLD_FROM, T.AMHARIC_FOLD_TO))

SPACES = frozenset(c for c in map(chr, range(0x3001)) if c.isspace())


def _keep(text, wanted):
    return None if text is None else "".join(c for c in text if wanted(c))


def _runs(text, inside):
    """(inside?, run) pieces of a text."""
    out = []
    for c in text:
        k = inside(c)
        if out and out[-1][0] == k:
            out[-1][1].append(c)
        else:
            out.append((k, [c]))
    return [(k, "".join(r)) for k, r in out]


def _word_end(text, at):
    while at < len(text) and text[at] not in SPACES:
        at += 1
    return at


def _scan(text, starts, least):
    """Spans that begin with one of ``starts``, go on to white space and have ``least`` more characters."""
    spans, at = [], 0
    while at < len(text):
        head = next((s for s in starts if text.startswith(s, at)), None)
        end = _word_end(text, at + len(head)) if head else at
        if head and end - at - len(head) >= least:
            spans.append((at, end))
            at = end
        else:
            at += 1
    return spans


def _cut(text, spans):
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:s])
        at = e
    return "".join(out) + text[at:]


def _without_query(text):
    """Links lose what follows their last question mark (if anything stands before it)."""
    cuts = []
    for s, e in _scan(text, ("https://", "http://"), 1):
        host = s + text[s:e].index("//") + 2
        mark = text.rfind("?", host + 1, e)
        if mark >= 0:
            cuts.append((mark, e))
    return _cut(text, cuts)


def _no_repeats(text):
    return "".join(c for i, c in enumerate(text) if i == 0 or c != text[i - 1] or c == chr(10))


def _newlines(text):
    if text is None:
        return "No Message"
    spaced = "".join(" " if k else r for k, r in _runs(text, lambda c: c == chr(10)))
    while spaced and spaced[0] in SPACES:
        spaced = spaced[1:]
    while spaced and spaced[-1] in SPACES:
        spaced = spaced[:-1]
    return spaced


def _is_mark(c):
    return 0x1361 <= ord(c) <= 0x1368


# What each function means, as scanners over characters (none shares a pattern with the code).
PY = {
    "normalize_amharic": lambda t: None if t is None else "".join(FOLD.get(c, c) for c in t),
    "remove_punctuation": lambda t: None if t is None else "".join(" " if k else r for k, r in _runs(t, _is_mark)),
    "remove_emojis": lambda t: _keep(t, lambda c: ord(c) not in EMOJI),
    "extract_emojis": lambda t: _keep(t or "", lambda c: ord(c) in EMOJI) or "No Emoji",
    "collapse_repeats": lambda t: t and _no_repeats(t),
    "remove_urls": lambda t: t and _cut(t, _scan(t, ("http", "www"), 1)),
    "extract_links": lambda t: [t[s:e] for s, e in _scan(t or "", ("https://", "http://", "www."), 1)],
    "normalize_links": lambda t: t and _without_query(t),
    "normalize_spaces": lambda t: t and " ".join(r for k, r in _runs(t, SPACES.__contains__) if not k),
    "remove_non_amharic": lambda t: _keep(t, lambda c: 0x1200 <= ord(c) <= 0x137F or c in "0123456789" or c in SPACES),
    "clean_newlines": _newlines,
}

ALPHABET = list("abhtpw.:/?=1100 ") + ["\n", "\r", "\t", "\x0b", "\x1c", "\x85", " ",
                                         "　", " ", " ", "http", "www.", "https://",
                                         "\U0001F600", "❤", "️", "‍", "©",
                                         "\U0001F1EA", "ሐ", "ዓ", "።", "፣", "ኣ", "é", "\U0001FAE8"]


def _samples(n=400, seed=7):
    rnd = random.Random(seed)
    out = [None, ""]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 30))))
    return out


@pytest.mark.parametrize("name", sorted(PY))
def test_fuzz_against_python(spark, name):
    data = _samples()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    got = {r["i"]: r["o"] for r in df.select("i", getattr(T, name)("s").alias("o")).collect()}
    for i, s in enumerate(data):
        assert got[i] == PY[name](s), (name, repr(s), repr(got[i]))


@pytest.mark.parametrize("wide", [False, True])
def test_fuzz_clean_text(spark, wide):
    def py_clean_text(t):
        if not t:
            return ""
        for f in ("normalize_amharic", "remove_punctuation", "remove_emojis", "collapse_repeats",
                  "remove_urls", "normalize_links", "normalize_spaces"):
            t = PY[f](t)
        return t
    data = _wide_samples(seed=29) if wide else _samples(seed=11)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    got = {r["i"]: r["o"] for r in df.select("i", T.clean_text("s").alias("o")).collect()}
    for i, s in enumerate(data):
        assert got[i] == py_clean_text(s), repr(s)


def test_standardize_columns(spark):
    from chanlake.plans.cleaning import standardize_columns
    df = spark.createDataFrame([(1, "x", "c")], "`Group ID` int, Message string, other string")
    assert standardize_columns(df).columns == ["group_id", "message", "other"]


def _wide_samples(n=600, seed=23):
    """Random code points from every plane (no surrogates), mixed with
    whitespace and URL fragments."""
    rnd = random.Random(seed)
    pieces = ["http", "https://", "www.", "?", " ", "\n", "\t", "　", " ", "\x85"]

    def cp():
        while True:
            c = rnd.choice([rnd.randint(0x20, 0x7F), rnd.randint(0x80, 0xFFFF), rnd.randint(0x10000, 0x10FFFF),
                            rnd.randint(0x1F300, 0x1FAFF), rnd.randint(0x1200, 0x137F)])
            if not 0xD800 <= c <= 0xDFFF:
                return chr(c)
    out = []
    for _ in range(n):
        k = rnd.randint(1, 25)
        out.append("".join(rnd.choice(pieces) if rnd.random() < 0.25 else cp() for _ in range(k)))
    return out


@pytest.mark.parametrize("name", sorted(PY))
def test_wide_unicode_against_python(spark, name):
    data = _wide_samples()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    got = {r["i"]: r["o"] for r in df.select("i", getattr(T, name)("s").alias("o")).collect()}
    bad = [(repr(s), repr(got[i]), repr(PY[name](s))) for i, s in enumerate(data) if got[i] != PY[name](s)]
    assert not bad, (name, len(bad), bad[:3])


def test_emoji_table_against_an_independent_source():
    """The regex module's own Unicode tables: nothing of ours is missing there, and what we lack is newer than
    Python's character database (added after the table's Emoji 16)."""
    import unicodedata

    import regex
    known = regex.compile(r"\p{Emoji}")
    other = {c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and known.match(chr(c))}
    other -= set(map(ord, "#*0123456789")) | set(range(0x1F1E6, 0x1F200))      # keycaps, regional indicators
    assert EMOJI <= other
    assert all(unicodedata.category(chr(c)) == "Cn" for c in other - EMOJI)
