"""Plain versions of the operators, on lists; used by the tests only."""

import hashlib


def words(text):
    return (text or "").encode().split()


def shingles(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def passages(rows, width=50):
    """{id: (n_words, n_removed, sha)} of the exact rule: windows that start in a smaller id go."""
    seen, out = {}, {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(text)
        for i in range(len(w) - width + 1):
            seen.setdefault(tuple(w[i:i + width]), doc)
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if doc is not None and seen[tuple(w[i:i + width])] < doc:
                gone[i:i + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out[doc] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def near(rows, num=4, den=5):
    """{id: (class, links)} by all pairs."""
    rows = [(i, shingles(t)) for i, t in rows if i is not None]
    links, parent = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            (i, s), (j, t) = rows[a], rows[b]
            both = len(s & t)
            if both and both * den >= num * (len(s) + len(t) - both):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i, _ in rows}


def quality(rows, min_docs=20, share=10, left_pct=30):
    """{id: cleaned text} of kept documents; rows are (id, text, host) with distinct ids."""
    import re
    from collections import defaultdict

    def norm(line):
        return re.sub(r"[ \t\x0b\x0c\r]+", " ", re.sub(r"[0-9]+", "0", line.lower())).strip(" ")

    held, hosts = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        hosts[host].add(text or "")
        for line in (text or "").split("\n"):
            if norm(line):
                held[host, norm(line)].add(text)
    out = {}
    for doc, text, host in rows:
        w, n = words(text), 0
        wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        twice = {x for x in wins if wins.count(x) > 1}
        mark = [False] * len(w)
        for i, x in enumerate(wins):
            if x in twice:
                mark[i:i + 8] = [True] * 8
        n = sum(mark)
        if len(w) < 20 or 100 * n > 30 * len(w):
            continue

        def frequent(line):
            k = len(held.get((host, norm(line)), ()))
            return norm(line) != "" and k > min_docs and k * 100 > len(hosts[host]) * share
        left = "\n".join(x for x in text.split("\n") if not frequent(x))
        if len(words(left)) * 100 >= len(w) * left_pct:
            out[doc] = left
    return out
