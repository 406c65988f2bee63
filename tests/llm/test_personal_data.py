"""Personal data: patterns against plain searches, the field against enumeration and numbers."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from shelfcast.llm import personal_data as pd_
from shelfcast.llm.personal_data import KINDS, Lattice, SemiMarkovField, _Learner

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def sums_to_ten(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = [
                True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                14 <= len(digits) <= 19 and sums_to_ten(digits), 10 <= len(digits) <= 15,
            ]
            if fits[kind]:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def card(rng, gap=""):
    digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    digits += next(d for d in "0123456789" if sums_to_ten(digits + d))
    return gap.join(digits[i : i + 4] for i in range(0, 16, 4))


def said(rng):
    octets = lambda: ".".join(str(rng.randrange(300)) for _ in range(4))
    number = f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
    return rng.choice([f"ann.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", octets(), card(rng), card(rng, " "), number, number[1:], "473696257"])


def made(rng, n):
    word = lambda: rng.choice(["the", "éon", "at", "of.", "call", "é\n", "token"])
    return [" ".join([*(word() for _ in range(8)), said(rng), *(word() for _ in range(6)), said(rng), word()]) for _ in range(n)]


def test_patterns_find_what_a_plain_search_finds():
    rng = random.Random(1)
    pieces = ["a", "é", "@", ".", "-", " ", "+", "(", ")", "1", "23", "255.1.1.7", "4111111111111111", "x@y.z", "%", "\n", "0" * 6]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))
        assert pd_.base_spans(text) == plain(text), text
    for text in made(rng, 100):
        assert pd_.base_spans(text) == plain(text)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "+1 ", "a@", "1 ", "+1(((", "a.", "at a.", "@a"])
def test_long_runs_take_time_in_proportion(unit):
    text = unit * 60_000
    base = pd_.base_spans(text)
    pd_.stretches(text)
    assert all(text[s:e].strip() for s, _, e in base)


def segmentations(lattice, at=0):
    if at == len(lattice.tokens):
        yield ()
        return
    for rest in segmentations(lattice, at + 1):
        yield ((at, at + 1, 0), *rest)
    for i, j in lattice.inside:
        if i == at:
            for rest in segmentations(lattice, j):
                for kind in range(1, len(KINDS) + 1):
                    yield ((i, j, kind), *rest)


def total(field, lattice, segments):
    value, came = 0.0, 0
    for i, j, kind in segments:
        features = lattice.inside[i, j] if kind else lattice.outside[i]
        value += sum(field.weights[f][kind] for f in features if f in field.weights) + field.after[came][kind]
        came = kind
    return value


def lattices():
    for text in ("call (487) 555-7209 x", "10[.]2[.]33[.]4 1", "jo at a dot b dot c"):
        yield Lattice(text, *pd_.stretches(text)[0])


def test_best_segmentation_and_sums_by_enumeration():
    rng = np.random.default_rng(4)
    for lattice in lattices():
        learner = _Learner()
        outside, inside = learner.number(lattice)
        learner.weights, learner.after = rng.normal(size=learner.weights.shape), rng.normal(size=learner.after.shape)
        field = learner.field()
        every = {s: total(field, lattice, s) for s in segmentations(lattice)}
        assert len(every) > 4
        best = max(every, key=every.get)
        assert field.best(lattice) == [(i, j, k - 1) for i, j, k in best if k]
        forward, backward, _, _ = learner.sums(outside, inside)
        values = np.array(list(every.values()))
        want = np.log(np.exp(values - values.max()).sum()) + values.max()
        assert np.isclose(np.logaddexp.reduce(forward[-1]), want) and np.isclose(backward[0, 0], want)


def test_a_step_follows_the_gradient_of_the_likelihood():
    rng = np.random.default_rng(5)
    lattice = next(iter(lattices()))
    learner = _Learner(penalty=0.0)
    outside, inside = learner.number(lattice)
    weights, after = rng.normal(size=learner.weights.shape), rng.normal(size=learner.after.shape)
    segment = max(inside)
    gold, way = {segment: 3}, []
    for at in range(len(lattice.tokens)):
        if not segment[0] < at < segment[1]:
            way.append((*segment, 4) if at == segment[0] else (at, at + 1, 0))

    def likelihood(w, a):
        learner.weights, learner.after = w, a
        return total(learner.field(), lattice, way) - np.logaddexp.reduce(learner.sums(outside, inside)[0][-1])

    learner.weights, learner.after = weights.copy(), after.copy()
    learner.learn(outside, inside, gold)
    moves = (learner.weights - weights, learner.after - after)
    grads = (np.zeros_like(weights), np.zeros_like(after))
    for which, grad in enumerate(grads):
        for place in np.ndindex(grad.shape):
            ends = []
            for step in (1e-5, -1e-5):
                both = [weights.copy(), after.copy()]
                both[which][place] += step
                ends.append(likelihood(*both))
            grad[place] = (ends[0] - ends[1]) / 2e-5
    # The first step of Adagrad is the rate times the sign of the gradient.
    for move, grad in zip(moves, grads):
        some = np.abs(grad) > 1e-2
        assert some.any() and np.allclose(move[some], learner.rate * np.sign(grad[some]), atol=1e-2)


def documents(spark, texts):
    rows = [(i, t, "en", "s", 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kind string, mark long, near string")


def test_found_in_documents(spark):
    rng = random.Random(6)
    texts = made(rng, 300) + [None, "", "x" * 9_000 + " a@b.de " + "1 " * 3000, "The at of. And so on"]
    other = ["(487) 555-7209", "487-555-7209", "ann at mail3 dot example dot com", "ann (at) host (dot) org", card(rng, "."), "10[.]2[.]33[.]44"]
    texts += [f"of the {o} éon" for o in other]
    docs = documents(spark, texts)
    field = pd_.fit(docs)
    got = {r["doc_id"]: r["spans"] for r in pd_.find_personal_data(docs, field).collect()}
    for i, text in enumerate(texts):
        assert [(s["start"], KINDS.index(s["kind"]), s["end"]) for s in got[i] if s["by_pattern"]] == plain(text or "")
    found = [[(texts[i][s["start"] : s["end"]], s["kind"]) for s in got[i]] for i in range(len(texts) - len(other), len(texts))]
    kinds = ["phone", "phone", "email", "email", "card", "ip"]
    assert found == [[pair] for pair in zip(other, kinds)]
    clean = ["of 473696257 the", "on 2021-03-04 12:30 it", "he was at home. Then", "4111111111111112", "version 3.10.2"]
    assert all(not pd_.added_spans(t, pd_.base_spans(t), field) for t in clean)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    field = pd_.fit(odd_docs)
    rows = pd_.find_personal_data(odd_docs, field).collect()
    assert len(rows) == odd_docs.count() and not any(r["spans"] for r in rows)
    assert pd_.find_personal_data(no_docs, pd_.fit(no_docs)).count() == 0
    assert SemiMarkovField({}, [[0.0] * 5] * 5).best(next(iter(lattices()))) == []
