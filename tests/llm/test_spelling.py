"""Spelling variants against a plain search of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from shelfcast.llm import spelling


def counted(rows, least_points=6, least_count=5, every=199):
    """The words of (doc_id, text) rows and how often they occur, run by run."""
    found = Counter()
    for own, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if own is None else own}:{run}".encode())
            if h % every == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
            if len(run) >= least_points:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least_count}


def near(u, v):
    if len(u) < len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(u) == len(v) + 1 and any(u[:i] + u[i + 1 :] == v for i in range(len(u)))


def grouped(words, factor=5):
    others = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, found in others.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= factor * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(others[w]), words[form[w]] if form[w] else None))
    return rows


def as_rows(df):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


def some_words(rng):
    words = {}
    for _ in range(60):
        word = "".join(rng.choice("ab\u00e9") for _ in range(rng.randint(6, 9)))
        words[word] = rng.choice([5, 5, 25, 125, 700])
        for _ in range(4):
            cut = rng.randrange(len(word))
            other = word[:cut] + rng.choice(["", "a", "\u00e9", "ba"]) + word[cut + rng.randint(0, 1) :]
            if len(other) >= 6:
                words[other] = rng.randint(5, 30)
    return words


def test_groups_of_words_that_share_much(spark):
    rng = random.Random(3)
    for _ in range(2):
        words = some_words(rng)
        words |= {"x" * k: 10 * k for k in range(6, 15)}
        df = spark.createDataFrame(list(words.items()), "word string, n long")
        assert as_rows(spelling.group_spellings(df)) == grouped(words)


def test_long_runs_meet_without_walking(spark):
    base = "ab" * 40
    words = {base: 50, base[:-1]: 9, base[:30] + "c" + base[31:]: 8, base[:64]: 7, base[:63]: 500, base[:65]: 6, "q" * 5000: 30, "q" * 5001: 5}
    words |= {base[:30] + "cd" + base[32:]: 5, "z" + base[1:64]: 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert as_rows(spelling.group_spellings(df)) == grouped(words)


def test_words_of_documents(spark):
    rng = random.Random(5)
    words = list(some_words(rng))
    say = lambda n: " ".join(rng.choice(words).title() + rng.choice(["", ",", "7", "\u0101", "\u00d7", "-"]) for _ in range(n))
    rows = [(i, say(200)) for i in range(40)] + [(None, say(50)), (7, None), (8, ""), (9, "\u0100\u2014 1 2"), (3, say(9) * 500)]
    rows += [(50 + i, "B\u00c9ton\u00c9e" * 30_000) for i in range(6)] + rows[:2]
    docs = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], "doc_id long, text string, n long, word string, node long")
    want = counted(rows, every=7)
    got = {r["word"]: r["n"] for r in spelling.count_words(docs, slip_every=7).collect()}
    assert got == want and len(want) > 60
    short = {w: n for w, n in want.items() if len(w) < 100}
    assert as_rows(spelling.spelling_variants(docs)) >= {r for r in grouped(counted(rows)) if len(r[0]) < 100} and short


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert as_rows(spelling.spelling_variants(no_docs)) == set()
    words = counted([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert as_rows(spelling.spelling_variants(odd_docs)) == grouped(words)
