"""Personal data in texts: exact patterns, and a semi-Markov conditional random field for the rest.

Four kinds are found by pattern: e-mail, IP and card numbers, telephone numbers. Written in
another way (an address with `at` and `dot`, a number without its plus, octets in brackets)
they pass the patterns by. The field scores whole candidate segments by what they are as a
whole: shape of the digit groups, checksum, separators, labels of a host name, the word in
front. It segments the tokens of a stretch of text at once: a dynamic program over (end,
kind) takes segments of at most `MOST_TOKENS` tokens, which chooses boundaries and kinds
together; tokens of spans found by pattern are closed to it.

It learns from spans found by pattern in a bounded sample, each also rewritten in other ways
of the same kind, and from numbers that look alike and are none (a wrong checksum, octets
over 255, dates), by ascent on the likelihood with expectations from the forward and backward
sums. Where the sample has no span, nothing is added.

Defined results: a null text is empty and has no spans; rows with a null doc_id, repeated
rows and very long texts are read like any other, each row by itself; where two spans begin
together the kind listed first comes first; an empty table gives an empty table.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.blocks import blocks

KINDS = ["email", "ip", "card", "phone"]
MOST_TOKENS = 24
SAMPLE_DOCS = 20_000
"""Documents, about, that examples are taken from, by a hash of their id."""
SAMPLE = 300
"""Examples that are learned from, before they are rewritten; the first by a hash."""
MOST_CHARACTERS = 160
"""Characters of a stretch that an example is cut to; predictions read all of it."""
CONTEXT = 24
"""Characters before and after the stretch of an example."""

# The patterns of the four kinds. A run is entered at its beginning alone and never given
# back, which finds the same and takes time in proportion to the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The spans that match a pattern, in order of start and kind."""
    found, closed, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > closed and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            closed = match.end()
            found.append((start, 0, closed))
        at = text.find("@", max(at + 1, closed))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _only_digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_only_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# Stretches of text that may hold a span, so that the rest is never cut into tokens: numbers
# whose digits have up to three separators between them, and what stands around an `at`.
_NUMBER = re.compile(r"(?:\+|\()?[0-9](?:[ ().,+_/:\[\] ‐-―-]{0,3}[0-9])++")
_AT = re.compile(r"\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+|@", re.IGNORECASE)
_HOST = re.compile(
    r"[A-Za-z0-9-]{1,63}(?:(?:\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\.)[A-Za-z0-9-]{1,63})+", re.IGNORECASE
)
_GROUP = re.compile("[0-9]+")
LEAST_DIGITS = 7
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)


def stretches(text: str) -> list[tuple[int, int]]:
    """Where spans may be, none overlapping."""
    found = []
    for m in _NUMBER.finditer(text):
        groups = _GROUP.findall(m[0])
        if len(groups) >= 4 or sum(map(len, groups)) >= LEAST_DIGITS:
            found.append(m.span())
    for m in _AT.finditer(text):
        start = m.start()
        while start > max(0, m.start() - 64) and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        host = _HOST.match(text, m.end()) if start < m.start() else None
        if host:
            found.append((start, host.end()))
    found.sort()
    merged: list[tuple[int, int]] = []
    for start, end in found:
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _kind_of(token: str) -> str:
    return "9" if token[0].isdigit() else "a" if token[0].isalpha() else " " if token[0].isspace() else token


def _segments(tokens: list[str], closed: list[bool]) -> Iterator[tuple[int, int]]:
    """Candidates: numbers of enough digits or four short groups, or words around an `at`."""
    kinds = [_kind_of(t) for t in tokens]
    ats = [k == "@" or t.lower() == "at" for k, t in zip(kinds, tokens)]
    for i, first in enumerate(kinds):
        if not (first in "9a+" or first == "(" and kinds[i + 1 : i + 2] == ["9"]) or closed[i]:
            continue
        digits, groups, wordy, at, after = 0, 0, False, False, False
        for j in range(i, min(i + MOST_TOKENS, len(tokens))):
            if closed[j]:
                break
            kind = kinds[j]
            if kind == "9":
                digits, groups = digits + len(tokens[j]), groups + (1 if len(tokens[j]) <= 3 else 99)
            after = after or (at and (kind == "." or tokens[j].lower() == "dot"))
            wordy, at = wordy or kind == "a", at or ats[j]
            if kind not in "9a" or ats[j]:
                continue
            if (at and after) or (not wordy and not at and (digits >= LEAST_DIGITS or groups == 4)):
                yield i, j + 1


def _features(text: str, tokens: list[str], starts: list[int], i: int, j: int) -> list[str]:
    """What a segment is as a whole, and what stands before and after it."""
    some, segment = tokens[i:j], text[starts[i] : starts[j]]
    groups = [len(t) for t in some if t[0].isdigit()]
    between = "".join(sorted({" " if t.isspace() else t for t in some if not t[0].isdigit() and not t[0].isalpha()}))
    front, behind = text[: starts[i]].rstrip(), text[starts[j] :]
    word = re.search(r"([^\W\d_]+)\W*$", front[-CONTEXT:])
    out = [
        "bias", "groups " + ".".join(map(str, groups[:8])), "digits " + str(min(sum(groups), 20)), "between " + between,
        "first " + _kind_of(some[0]), "front " + _kind_of(front[-1:] or " "), "joined" if text[: starts[i]][-1:].strip() else "apart",
        "goes on" if behind[:1].strip(".,;:!?)'\" \n") else "ends", "word " + (word[1].lower() if word else ""),
    ]
    digits = _only_digits(segment)
    if len(digits) >= 12:
        out.append("luhn" if luhn(digits) else "no luhn")
    if len(groups) == 4 and not any(t[0].isalpha() for t in some):
        octets = [int(t) for t in some if t[0].isdigit() and len(t) < 9]
        out.append("octets" if len(octets) == 4 and max(octets) <= 255 else "no octets")
    if any(t[0].isalpha() for t in some):
        low = [t.lower() for t in some]
        out += ["sign" if "@" in low else "said" if "at" in low else "none", "dot said" if "dot" in low else "dot"]
        out.append("name " + ("short" if some[-1].isalpha() and 2 <= len(some[-1]) <= 6 else "other"))
        out.append("gaps " + str(min(sum(t.isspace() for t in some), 8)))
    return out


class Lattice:
    """A stretch of text as tokens and candidate segments, with their features."""

    def __init__(self, text: str, start: int, end: int, taken: list[tuple[int, int]] = ()):
        # The text around decides features only, so a long text costs no more than a short one.
        self.origin = max(0, start - 2 * CONTEXT)
        near = text[self.origin : end + 2 * CONTEXT]
        spans = [m.span() for m in _TOKEN.finditer(near, start - self.origin, end - self.origin)]
        self.tokens = [near[a:b] for a, b in spans]
        self.starts = [a for a, _ in spans] + [spans[-1][1]]
        closed = [any(a + self.origin < e and s < b + self.origin for s, e in taken) for a, b in spans]
        self.outside = [["outside " + _kind_of(t)] for t in self.tokens]
        self.inside = {(i, j): _features(near, self.tokens, self.starts, i, j) for i, j in _segments(self.tokens, closed)}

    def span(self, i: int, j: int) -> tuple[int, int]:
        return self.origin + self.starts[i], self.origin + self.starts[j]


class SemiMarkovField:
    """Weights of features by kind (0 is outside), and of each kind after each."""

    def __init__(self, weights: dict[str, list[float]], after: list[list[float]]):
        self.weights, self.after = weights, after

    def _score(self, features: list[str], kinds: range) -> list[float]:
        rows = [self.weights[f] for f in features if f in self.weights]
        return [sum(r[k] for r in rows) for k in kinds]

    def best(self, lattice: Lattice) -> list[tuple[int, int, int]]:
        """The segments (first token, end, kind) of the likeliest segmentation."""
        n, kinds = len(lattice.tokens), range(len(KINDS) + 1)
        top = [[-inf] * len(kinds) for _ in range(n + 1)]
        back: list[list] = [[None] * len(kinds) for _ in range(n + 1)]
        top[0][0] = 0.0
        ending: dict[int, list[int]] = {}
        for i, j in lattice.inside:
            ending.setdefault(j, []).append(i)
        for j in range(1, n + 1):
            steps = [(j - 1, self._score(lattice.outside[j - 1], range(1)), 0)]
            steps += [(i, self._score(lattice.inside[i, j], range(1, len(kinds))), 1) for i in ending.get(j, ())]
            for i, scores, first in steps:
                for kind, score in enumerate(scores, first):
                    came = max(kinds, key=lambda k: top[i][k] + self.after[k][kind])
                    total = top[i][came] + self.after[came][kind] + score
                    if total > top[j][kind]:
                        top[j][kind], back[j][kind] = total, (i, came)
        at, kind, out = n, max(kinds, key=lambda k: top[n][k]), []
        while at:
            i, came = back[at][kind]
            if kind:
                out.append((i, at, kind - 1))
            at, kind = i, came
        return out[::-1]


def _spread(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    most = np.where(np.isfinite(most), most, 0)
    with np.errstate(divide="ignore"):
        return (np.log(np.exp(x - most).sum(axis=axis, keepdims=True)) + most).squeeze(axis)


class _Learner:
    """Weights under training: Adagrad steps on the penalised likelihood of one lattice each."""

    def __init__(self, rate: float = 0.3, penalty: float = 1e-4):
        self.rate, self.penalty, self.size = rate, penalty, len(KINDS) + 1
        self.numbers: dict[str, int] = {}
        self.weights = np.zeros((0, self.size))
        self.steps = np.zeros((0, self.size))
        self.after, self.after_steps = np.zeros((self.size, self.size)), np.zeros((self.size, self.size))

    def number(self, lattice: Lattice) -> tuple[list[np.ndarray], dict[tuple[int, int], np.ndarray]]:
        of = lambda names: np.array([self.numbers.setdefault(f, len(self.numbers)) for f in names])
        out = [of(f) for f in lattice.outside], {s: of(f) for s, f in lattice.inside.items()}
        grown = len(self.numbers) - len(self.weights)
        self.weights = np.vstack([self.weights, np.zeros((grown, self.size))])
        self.steps = np.vstack([self.steps, np.zeros((grown, self.size))])
        return out

    def sums(self, outside: list[np.ndarray], inside: dict) -> tuple[np.ndarray, np.ndarray, dict, np.ndarray]:
        """Forward and backward log sums, and the scores of segments and single tokens."""
        n = len(outside)
        single = np.array([self.weights[f, 0].sum() for f in outside])
        scores = {s: self.weights[f, 1:].sum(axis=0) for s, f in inside.items()}
        forward, backward = np.full((n + 1, self.size), -inf), np.full((n + 1, self.size), -inf)
        forward[0, 0], backward[n] = 0.0, 0.0
        by_end: dict[int, list] = {}
        by_start: dict[int, list] = {}
        for s in inside:
            by_end.setdefault(s[1], []).append(s)
            by_start.setdefault(s[0], []).append(s)
        for j in range(1, n + 1):
            forward[j, 0] = _spread(forward[j - 1] + self.after[:, 0], 0) + single[j - 1]
            for s in by_end.get(j, ()):
                forward[j, 1:] = np.logaddexp(forward[j, 1:], _spread(forward[s[0]][:, None] + self.after[:, 1:], 0) + scores[s])
        for i in range(n - 1, -1, -1):
            backward[i] = self.after[:, 0] + single[i] + backward[i + 1, 0]
            for s in by_start.get(i, ()):
                backward[i] = np.logaddexp(backward[i], _spread(self.after[:, 1:] + (scores[s] + backward[s[1], 1:])[None], 1))
        return forward, backward, scores, single

    def learn(self, outside: list[np.ndarray], inside: dict, gold: dict[tuple[int, int], int]) -> None:
        """One step towards the likelihood of the gold segments (kind by segment)."""
        forward, backward, scores, single = self.sums(outside, inside)
        n, total = len(outside), _spread(forward[-1], 0)
        change, moved = np.zeros_like(self.weights), np.zeros_like(self.after)
        covered = {t for i, j in gold for t in range(i, j)}
        labels, at = [0], 0
        while at < n:  # the gold labels in order, for what follows what
            here = next(((s, k) for s, k in gold.items() if s[0] == at), None)
            labels.append(here[1] + 1 if here else 0)
            at = here[0][1] if here else at + 1
        for came, kind in zip(labels, labels[1:]):
            moved[came, kind] += 1
        for t, features in enumerate(outside):
            each = np.exp(forward[t] + self.after[:, 0] + single[t] + backward[t + 1, 0] - total)
            moved[:, 0] -= each
            change[features, 0] += (t not in covered) - each.sum()
        for s, features in inside.items():
            each = np.exp(forward[s[0]][:, None] + self.after[:, 1:] + (scores[s] + backward[s[1], 1:])[None] - total)
            moved[:, 1:] -= each
            there = -each.sum(axis=0)
            if s in gold:
                there[gold[s]] += 1
            np.add.at(change, (features[:, None], np.arange(1, self.size)[None]), there[None])
        for value, steps, by in ((self.weights, self.steps, change), (self.after, self.after_steps, moved)):
            by -= self.penalty * value
            np.clip(by, -1, 1, out=by)  # a long list of numbers counts about as one example
            steps += by * by
            value += self.rate * by / np.sqrt(steps + 1e-8)

    def field(self) -> SemiMarkovField:
        return SemiMarkovField({f: self.weights[i].tolist() for f, i in self.numbers.items()}, self.after.tolist())


def _rewritten(kind: int, said: str, rng: random.Random) -> str:
    """The same address or number in another way."""
    digits = _only_digits(said)
    if KINDS[kind] == "email":
        name, _, host = said.rpartition("@")
        if rng.random() < 0.5:  # most addresses have no number
            name, host = (re.sub("[0-9]+", "", part).strip(".-") or part for part in (name, host))
        at, dot = rng.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "."), (" at ", "."), (" [at] ", " [dot] ")])
        return f"{name}{at}{host.replace('.', dot)}"
    if KINDS[kind] == "ip":
        return rng.choice(["[.]", "(.)", " . "]).join(said.split("."))
    if KINDS[kind] == "card":
        return rng.choice([".", "/", "_", " ", " - "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    area, middle, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    country = digits[:-10]
    forms = [f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}", f"{area} {middle} {last}"]
    forms += [f"00{country} {area} {middle} {last}", f"{country} ({area}) {middle}-{last}"] if country else []
    return rng.choice(forms)


def _alike(kind: int, said: str, rng: random.Random) -> str:
    """What looks like an address or a number of the kind, and is none."""
    digits = _only_digits(said)
    if KINDS[kind] == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
        return rng.choice([wrong, " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4))])
    if KINDS[kind] == "ip":
        return ".".join(str(300 + int(p) % 600) for p in said.split("."))
    if KINDS[kind] == "phone":
        if rng.random() < 0.5:  # groups of no telephone
            cuts = sorted(rng.sample(range(1, len(digits)), min(3, len(digits) - 1)))
            return rng.choice("-.").join(digits[a:b] for a, b in zip([0, *cuts], [*cuts, len(digits)]))
        day = f"{1 + int(digits[-2:]) % 28:02d}"
        return rng.choice([f"2019-0{1 + int(digits[-1]) % 9}-{day} 1{digits[-3]}:2{digits[-4]}", digits[-9:], f"{day}.0{1 + int(digits[-1]) % 9}.2019"])
    name, _, host = said.rpartition("@")
    return f"{re.sub('[^A-Za-z]+', ' ', name).strip() or 'it'} at {host.split('.')[0]}. {host.split('.')[-1].title()}"


def examples(text: str, rng: random.Random) -> list[tuple[str, list[Span]]]:
    """Short texts with their spans: each stretch of a text, as it is, rewritten, and spoilt."""
    spans, out = base_spans(text), []
    for start, end in stretches(text):
        low, high = max(0, start - CONTEXT), end + CONTEXT
        near = text[low:high]
        held = [(s, k, e) for s, k, e in spans if start <= s and e <= end]
        out.append((near, [(s - low, k, e - low) for s, k, e in held]))
        if len(held) == 1:
            s, k, e = held[0]
            if len(_only_digits(text[s:e])) >= 10 or k < 2:
                ways = [(_rewritten(k, text[s:e], rng), True) for _ in range(3)] + [(_alike(k, text[s:e], rng), False) for _ in range(2)]
                for new, kept in ways:
                    changed = f"{text[low:s]}{new}{text[e:high]}"
                    out.append((changed, [(s - low, k, s - low + len(new))] if kept else []))
    return out


def fit(docs: DataFrame, sample: int = SAMPLE, rounds: int = 4, seed: int = 7) -> SemiMarkovField:
    """A field of a bounded sample: of some `SAMPLE_DOCS` documents, the first `sample`
    stretches by a hash, so that neither order nor partitions of the table matter."""
    text = F.coalesce("text", F.lit(""))
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    mark = F.xxhash64(F.col("doc_id"), F.lit(seed))
    some = docs.select(mark.alias("mark"), text.alias("text")).filter(F.pmod("mark", F.lit(1 << 20)) < int(share * (1 << 20)))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            rows = []
            for own, said in zip(block.rows.column("mark").to_pylist(), block.rows.column("text").to_pylist()):
                for low, high in stretches(said):
                    near = said[max(0, low - CONTEXT) : min(high, low + MOST_CHARACTERS) + CONTEXT]
                    rows.append(((own * 31 + low) % (2**61 - 1), near))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["place", "near"]
            )

    taken = some.mapInArrow(take, "place long, near string").orderBy("place", "near").limit(sample).collect()
    learner, rng, told = _Learner(), random.Random(seed), []
    for row in taken:
        for near, spans in examples(row["near"], rng):
            for low, high in stretches(near):
                lattice = Lattice(near, low, high)
                at = {lattice.span(i, j): (i, j) for i, j in lattice.inside}
                gold = {at[s, e]: k for s, k, e in spans if (s, e) in at}
                told.append((*learner.number(lattice), gold))
    for _ in range(rounds if any(gold for *_, gold in told) else 0):
        rng.shuffle(told)
        for outside, inside, gold in told:
            learner.learn(outside, inside, gold)
    return learner.field()


def added_spans(text: str, base: list[Span], field: SemiMarkovField) -> list[Span]:
    """The spans the field finds next to those found by pattern, overlapping none of them."""
    out = []
    taken = [(s, e) for s, _, e in base]
    for start, end in stretches(text):
        mine = [(s, e) for s, e in taken if s < end and start < e]
        if any(s <= start and end <= e for s, e in mine):
            continue
        lattice = Lattice(text, start, end, mine)
        if lattice.inside:
            out += [(a, kind, b) for i, j, kind in field.best(lattice) for a, b in [lattice.span(i, j)]]
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("by_pattern", pa.bool_())])
SPANS = "array<struct<kind: string, start: int, end: int, by_pattern: boolean>>"


def _holds_any(block) -> np.ndarray:
    """Which texts have a digit, an @ or a word that may stand for a dot or a sign."""
    signs = (block.data == 0x40) | ((block.data >= 0x30) & (block.data <= 0x39))
    upto = np.concatenate([[0], np.cumsum(signs)])
    found = upto[block.offsets[1:]] > upto[block.offsets[:-1]]
    lower = block.data | 0x20  # d, o and t of either case; no other byte becomes one of them
    dots = np.flatnonzero((lower[:-2] == 0x64) & (lower[1:-1] == 0x6F) & (lower[2:] == 0x74))
    found[np.searchsorted(block.offsets, dots, "right") - 1] = True
    at = np.flatnonzero((lower[:-2] == 0x61) & (lower[1:-1] == 0x74) & np.isin(block.data[2:], [0x29, 0x5D, 0x7D, 0x3E]))
    found[np.searchsorted(block.offsets, at, "right") - 1] = True
    at = np.flatnonzero((block.data[:-2] == 0x20) & (lower[1:-1] == 0x61) & (lower[2:] == 0x74))
    dotted = np.flatnonzero((block.data[:-1] == 0x2E) & (lower[1:] >= 0x61) & (lower[1:] <= 0x7A))
    has_at, has_dot = np.zeros(len(found), bool), np.zeros(len(found), bool)
    has_at[np.searchsorted(block.offsets, at, "right") - 1] = True
    has_dot[np.searchsorted(block.offsets, dotted, "right") - 1] = True
    return found | (has_at & has_dot)


def find_personal_data(docs: DataFrame, field: SemiMarkovField) -> DataFrame:
    """doc_id and the spans (kind, start, end in code points, by_pattern) of every row, by
    start and kind."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found: list[list[dict]] = [[] for _ in range(len(block.rows))]
            held = block.rows.column("text")
            for row in np.flatnonzero(_holds_any(block)).tolist():
                text = held[row].as_py()
                base = base_spans(text)
                every = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, base, field)]
                found[row] = [{"kind": KINDS[k], "start": s, "end": e, "by_pattern": p} for s, k, e, p in sorted(every)]
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("doc_id"), pa.array(found, pa.list_(_SPAN))], names=["doc_id", "spans"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, f"doc_id long, spans {SPANS}")
