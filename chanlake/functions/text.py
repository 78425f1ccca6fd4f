"""Text cleaning as native Column expressions (no Python UDF, whole-stage codegen).

Every function maps a Column to a Column. The regular expressions are written
with ``\\x{..}`` escapes only, so the same pattern text is valid for Java regex
(Spark) and RE2.

Semantics follow Python ``str``/``re``: whitespace is the ``str.isspace`` set,
``.`` matches everything but ``\\n``. The reference returns blank input
unchanged; ``regexp_replace`` already maps NULL to NULL and '' to '', so the
functions below need no guard and compose without repeating their input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Whitespace code points of Python's str.isspace (what \s, \S and str.split()
# use for text).
WHITESPACE_CODEPOINTS = (
    "9 A B C D 1C 1D 1E 1F 20 85 A0 1680 2000-200A 2028 2029 202F 205F 3000"
)

# Letter folding of Ethiopic variants to their base letter, pairwise in order.
AMHARIC_FOLD_FROM = "ኀኁኂኃኄኅኆሐሑሒሓሔሕሖሠሡሢሣሤሥሦዐዑዒዓዔዕዖኣ"
AMHARIC_FOLD_TO = "ሀሁሂሀሄህሆሀሁሂሀሄህሆሰሱሲሳሴስሶአኡኢአኤእኦአ"

# Ethiopic punctuation U+1361..U+1368 (word space to paragraph separator).
ETHIOPIC_PUNCT_RANGE = "1361-1368"
# Ethiopic block kept by the non-Amharic filter.
ETHIOPIC_BLOCK_RANGE = "1200-137F"

# Single code points that count as an emoji: Unicode Emoji=Yes without
# '#', '*', 0-9 and regional indicators (Unicode 14.0 data), followed by the
# single code points added in Emoji 15.0 and 16.0.
EMOJI_CODEPOINTS = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0
25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653
265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE
26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716
271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07
2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A
1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD
1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8
1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5
1F6CB-1F6D2 1F6D5-1F6D7 1F6DD-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945
1F947-1F9FF 1FA70-1FA74 1FA78-1FA7C 1FA80-1FA86 1FA90-1FAAC 1FAB0-1FABA 1FAC0-1FAC5 1FAD0-1FAD9 1FAE0-1FAE7
1FAF0-1FAF6
1F6DC 1FA75-1FA77 1FA87-1FA88 1FAAD-1FAAF 1FABB-1FABD 1FABF 1FACE-1FACF 1FADA-1FADB 1FAE8 1FAF7-1FAF8
1FA89 1FA8F 1FABE 1FAC6 1FADC 1FADF 1FAE9
"""

NO_EMOJI = "No Emoji"
NO_MESSAGE = "No Message"
# --- end of fixed values ----------------------------------------------------


def _class_body(spec: str) -> str:
    """'9 A B 2194-2199' -> '\\x{9}-\\x{B}\\x{2194}-\\x{2199}' (regex class body).
    Adjacent code points are merged: Java tests class items one by one."""
    items = []
    for token in spec.split():
        lo, _, hi = token.partition("-")
        items.append((int(lo, 16), int(hi or lo, 16)))
    spans: list[list[int]] = []
    for a, b in sorted(items):
        if spans and a <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return "".join(f"\\x{{{a:X}}}" + (f"-\\x{{{b:X}}}" if b > a else "") for a, b in spans)


def _hint_body(spec: str, max_gap: int = 0x1000) -> str:
    """A coarse superset of a code point set: ranges closer than ``max_gap``
    merged (A9-AE, 203C-3299, 1F004-1FAF8 for the emoji set)."""
    spans = []
    for token in spec.split():
        lo, _, hi = token.partition("-")
        spans.append((int(lo, 16), int(hi or lo, 16)))
    merged: list[list[int]] = []
    for lo, hi in sorted(spans):
        if merged and lo - merged[-1][1] <= max_gap:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in merged)


WS = _class_body(WHITESPACE_CODEPOINTS)            # class body, no brackets
EMOJI = _class_body(EMOJI_CODEPOINTS)
WS_CLASS = f"[{WS}]"
NON_WS_CLASS = f"[^{WS}]"
EMOJI_CLASS = f"[{EMOJI}]+"        # runs: one replacement per run, same result
NOT_EMOJI_CLASS = f"[^{EMOJI}]+"
# Java tests a character against a long class range by range. The lookahead
# on a 3-range superset rejects ordinary characters first; since every emoji
# is inside the superset, the match set is unchanged.
EMOJI_HINT = f"[{_hint_body(EMOJI_CODEPOINTS)}]"
EMOJI_RUN_FAST = f"(?={EMOJI_HINT}){EMOJI_CLASS}"
PUNCT_RUN = f"[{_class_body(ETHIOPIC_PUNCT_RANGE)}]+"
NON_AMHARIC = f"[^{_class_body(ETHIOPIC_BLOCK_RANGE)}0-9{WS}]+"
# Java matches positive classes much faster than negated ones, so T2 keeps the
# runs of allowed characters instead of deleting the rest (same result).
AMHARIC_KEEP_RUN = f"[{_class_body(ETHIOPIC_BLOCK_RANGE)}0-9{WS}]+"
URL_ANYWHERE = f"http{NON_WS_CLASS}+|www{NON_WS_CLASS}+"
LINK = f"(https?://{NON_WS_CLASS}+|www\\.{NON_WS_CLASS}+)"
LINK_QUERY = f"(https?://{NON_WS_CLASS}+)\\?{NON_WS_CLASS}*"
SQL_LINK = f"https?://{NON_WS_CLASS}+"
EDGE_WS = f"^{WS_CLASS}+|{WS_CLASS}+$"
REPEAT_RUN = "(?d)(.)\\1+"   # (?d): '.' excludes only \n, as in Python


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _blank(c: Column) -> Column:
    """Python falsiness of a str-or-None value."""
    return c.isNull() | (c == F.lit(""))


def strip_ws(col) -> Column:
    """``str.strip()``: remove leading/trailing whitespace of the isspace set."""
    return F.regexp_replace(_c(col), EDGE_WS, "")


def normalize_amharic(col) -> Column:
    """Fold Ethiopic letter variants onto their base letter."""
    return F.translate(_c(col), AMHARIC_FOLD_FROM, AMHARIC_FOLD_TO)


def remove_non_amharic(col) -> Column:
    """Keep only the Ethiopic block, ASCII digits and whitespace."""
    return F.array_join(F.regexp_extract_all(_c(col), F.lit(AMHARIC_KEEP_RUN), 0), "")


def remove_punctuation(col) -> Column:
    """Each run of Ethiopic punctuation becomes one space."""
    return F.regexp_replace(_c(col), PUNCT_RUN, " ")


def extract_emojis(col) -> Column:
    """T4: the emoji code points of the text, concatenated; else 'No Emoji'."""
    c = _c(col)
    found = F.array_join(F.regexp_extract_all(c, F.lit(EMOJI_RUN_FAST), 0), "")
    return F.when(_blank(c) | (found == F.lit("")), F.lit(NO_EMOJI)).otherwise(found)


def remove_emojis(col) -> Column:
    """T5: drop emoji code points (joiners, VS16 and flag letters stay)."""
    return F.regexp_replace(_c(col), EMOJI_RUN_FAST, "")


def collapse_repeats(col) -> Column:
    """Every run of one repeated character (except newline) becomes one."""
    return F.regexp_replace(_c(col), REPEAT_RUN, "$1")


def remove_urls(col) -> Column:
    """Delete ``http...``/``www...`` up to the next whitespace."""
    return F.regexp_replace(_c(col), URL_ANYWHERE, "")


def extract_links(col) -> Column:
    """All links in order; blank or null text gives an empty array."""
    c = _c(col)
    found = F.regexp_extract_all(c, F.lit(LINK), 1)
    return F.when(_blank(c), F.array().cast("array<string>")).otherwise(found)


def normalize_links(col) -> Column:
    """Cut each URL at its last '?' (greedy, like the reference)."""
    return F.regexp_replace(_c(col), LINK_QUERY, "$1")


def normalize_spaces(col) -> Column:
    """``' '.join(text.split())``."""
    return F.trim(F.regexp_replace(_c(col), WS_CLASS + "+", " "))


def clean_newlines(col) -> Column:
    """Null -> 'No Message'; newline runs -> one space; strip."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(NO_MESSAGE)).otherwise(
        strip_ws(F.regexp_replace(c, "\n+", " ")))


def sql_links(col) -> Column:
    """Every ``https?://`` match of the staging model; null -> []."""
    c = _c(col)
    return F.coalesce(F.regexp_extract_all(c, F.lit(SQL_LINK), 0),
                      F.array().cast("array<string>"))


def combine_messages(col) -> Column:
    """Strip each text, drop blanks, join by newline."""
    stripped = F.transform(_c(col), lambda x: strip_ws(x))
    return F.array_join(F.filter(stripped, lambda x: x != F.lit("")), "\n")


def clean_text(col) -> Column:
    """Message cleaning chain. Blank/null -> ''; T1, T3, T5, T6, T7, T9, T10."""
    c = _c(col)
    t = normalize_amharic(c)
    t = remove_punctuation(t)
    t = remove_emojis(t)
    t = collapse_repeats(t)
    t = remove_urls(t)
    t = normalize_links(t)
    t = normalize_spaces(t)
    return F.when(_blank(c), F.lit("")).otherwise(t)
