"""Language identification: a sparse multinomial logistic regression on character n-grams.

Features: runs of one to three characters (lower case, white space as one blank), hashed
into a fixed number of slots, weighted by log term frequency and inverse document frequency
and scaled to unit length. Document frequencies are counted over all training documents.
The weights are learned by follow-the-regularised-leader with an elastic-net penalty on a
bounded sample, at most `SAMPLE` documents of each language; a further part of the sample,
not learned from, sets the temperature of the probabilities.

Defined results: a text that is null or has no letter is `und` with score 0; nothing to
learn from makes every text `und`; ties go to the first label in order; training rows
without a label or text are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.blocks import Block, blocks, mix
from shelfcast.session import stage

SAMPLE = 1200
"""Documents of each language to learn from; the bound of the sample."""
SLOTS = 8192
LONGEST_GRAM = 3
UNDETERMINED = "und"
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01
BLOCK_ROWS = 32


def training_rows(doc_id: Column) -> Column:
    """True for documents to learn from: those whose remainder is not 1."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _folding() -> tuple[np.ndarray, np.ndarray]:
    """For characters of the basic plane: the lower-case form, and whether it is a letter."""
    lower, letter = np.arange(0x10000, dtype=np.uint32), np.zeros(0x10000, bool)
    for c in range(0x10000):
        small = chr(c).lower()
        lower[c] = ord(small) if len(small) == 1 else c
        letter[c] = chr(c).isalpha()
    lower[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0xA0]] = 0x20
    return lower, letter


class Grams:
    """The n-gram counts of the texts of a block."""

    def __init__(self, slots: int = SLOTS):
        self.slots = slots
        self.lower, self.letter = _folding()

    def characters(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Folded code points of a block, the row of each, and whether it is a letter."""
        points = np.frombuffer(block.data.tobytes().decode().encode("utf-32-le"), np.uint32)
        # Characters before each text: the bytes that begin one.
        begins = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
        row = np.repeat(np.arange(len(block.rows), dtype=np.int64), np.diff(begins[block.offsets]))
        basic = points < 0x10000
        held = np.where(basic, points, 0)
        points, lettered = np.where(basic, self.lower[held], points), np.where(basic, self.letter[held], False)
        if not basic.all():  # few different ones: emoji are no letters, Gothic or Deseret are
            known, which = np.unique(points[~basic], return_inverse=True)
            small = [chr(c).lower() for c in known.tolist()]
            lower = np.array([ord(x) if len(x) == 1 else c for x, c in zip(small, known.tolist())], points.dtype)
            points[~basic] = lower[which]
            lettered[~basic] = np.array([chr(c).isalpha() for c in known.tolist()])[which]
        return points, row, lettered

    def counts(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Term counts (rows by slots), and which rows have a letter."""
        n = len(block.rows)
        points, row, lettered = self.characters(block)
        has_letter = np.zeros(n, bool)
        has_letter[row[lettered]] = True
        # Of neighbouring blanks only the first counts.
        single = np.ones(len(points), bool)
        single[1:] = (points[1:] != 0x20) | (points[:-1] != 0x20) | (row[1:] != row[:-1])
        points, row = points[single].astype(np.uint64), row[single]
        total = np.zeros(n * self.slots, np.int64)
        gram = np.zeros(len(points), np.uint64)
        with np.errstate(over="ignore"):
            for size in range(1, LONGEST_GRAM + 1):
                if len(points) < size:
                    break
                gram = gram[: len(points) - size + 1] * np.uint64(0x100000001B3) + points[size - 1 :]
                spread = (gram + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
                slot = (spread >> np.uint64(40)).astype(np.int64) % self.slots
                same = row[: len(gram)] == row[size - 1 :]
                total += np.bincount((row[: len(gram)] * self.slots + slot)[same], minlength=len(total))
        return total.reshape(n, self.slots), has_letter


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of (1 + log tf) * idf."""
    x = np.zeros(counts.shape, np.float32)
    np.log(counts, out=x, where=counts > 0)
    x += counts > 0
    x *= idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    x /= np.where(norm > 0, norm, 1)[:, None]
    return x


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class FollowTheLeader:
    """FTRL-proximal for several classes: per-coordinate steps, L1 makes weights zero."""

    def __init__(self, slots: int, classes: int):
        self.z, self.n = np.zeros((slots, classes)), np.zeros((slots, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes the labels likeliest, by golden-section search."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        s = scores / np.exp(log_t)
        top = s.max(axis=1)
        return float(np.mean(np.log(np.exp(s - top[:, None]).sum(axis=1)) + top - s[np.arange(len(s)), labels]))

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame, slots: int = SLOTS) -> tuple[int, np.ndarray]:
    """How many of all texts there are, and how many hold each slot's grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, seen, total = Grams(slots), np.zeros(slots, np.int64), 0
        for block in blocks(batches, most_rows=BLOCK_ROWS):
            counts, _ = grams.counts(block)
            seen += (counts > 0).sum(axis=0)
            total += len(block.rows)
        at = np.arange(-1, slots)  # slot -1 carries the number of texts
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate([[total], seen]))], names=["slot", "n"])

    rows = texts.select("text").mapInArrow(count, "slot long, n long")
    found = dict(rows.groupBy("slot").agg(F.sum("n")).collect())  # at most slots + 1 rows
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(slots)], np.int64)


def sample(rows: DataFrame, per_label: int) -> DataFrame:
    """About `per_label` rows of each label, drawn by a seeded stratified sample.

    Label counts are pre-aggregated; the draw never moves a text it does not take.
    """
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    shares = {label: min(1.0, per_label / n) for label, n in sizes.items()}
    return rows.sampleBy("lang", shares, seed=11)


def fit(docs: DataFrame, per_label: int = SAMPLE, slots: int = SLOTS, epochs: int = EPOCHS) -> dict | None:
    """A model from (text, lang) rows, or None where there is nothing to learn from."""
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    n, seen = document_frequencies(rows, slots)
    if not n:
        return None
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(slots)
        for block in blocks(batches, most_rows=BLOCK_ROWS):
            counts, has_letter = grams.counts(block)
            x = weighted(counts, idf)
            at = [np.flatnonzero(r).astype(np.int32) for r in x]
            columns = [
                block.rows.column("lang"),
                pa.array([a.tobytes() for a in at]),
                pa.array([r[a].tobytes() for r, a in zip(x, at)]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "slots", "weights"]).filter(pa.array(has_letter))

    drawn_as = [("lang", pa.string()), ("slots", pa.binary()), ("weights", pa.binary())]
    drawn = stage(sample(rows, per_label).mapInArrow(features, "lang string, slots binary, weights binary"), "language-sample")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=pa.schema(drawn_as))
        if not table.num_rows:
            return
        langs = table.column("lang").to_pylist()
        labels = sorted(set(langs))
        y = np.array([labels.index(x) for x in langs])
        at = [np.frombuffer(b, np.int32) for b in table.column("slots").to_pylist()]
        x = [np.frombuffer(b, np.float32).astype(float) for b in table.column("weights").to_pylist()]
        order = np.random.default_rng(5).permutation(len(y))
        held = order[: len(order) // 5] if len(order) >= 10 * len(labels) else order[:0]
        model = FollowTheLeader(slots, len(labels))
        for _ in range(epochs):
            for i in order[len(held) :]:
                model.learn(at[i], x[i], y[i])
        w = model.weights()
        scores = np.array([x[i] @ w[at[i]] for i in held]).reshape(len(held), len(labels))
        t = temperature(scores, y[held])
        yield pa.RecordBatch.from_pydict({"labels": [labels], "weights": [w.astype(np.float32).tobytes()], "temperature": [t]})

    # One task learns from the sample, which `per_label` bounds.
    learned = drawn.coalesce(1).mapInArrow(learn, "labels array<string>, weights binary, temperature double").collect()
    if not learned:
        return None
    labels = learned[0]["labels"]
    weights = np.frombuffer(learned[0]["weights"], np.float32).reshape(slots, len(labels))
    return {"labels": labels, "weights": weights, "temperature": learned[0]["temperature"], "idf": idf}


def _predicted(batches: Iterator[pa.RecordBatch], model: dict | None) -> Iterator[tuple[Block, list, np.ndarray]]:
    grams = Grams(len(model["idf"])) if model else None
    for block in blocks(batches, most_rows=BLOCK_ROWS):
        labels, scores = [UNDETERMINED] * len(block.rows), np.zeros(len(block.rows))
        if model:
            counts, has_letter = grams.counts(block)
            p = softmax(weighted(counts, model["idf"]) @ model["weights"] / model["temperature"])
            best = p.argmax(axis=1)
            labels = [model["labels"][b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), has_letter.tolist())]
            scores = np.where(has_letter, p.max(axis=1), 0.0).astype(float)
        yield block, labels, scores


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang_pred and score of every document; only the text is looked at."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, labels, scores in _predicted(batches, model):
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double")


# Evidence: the probabilities above always add up to one over the learned labels, so they tell
# which of them is likeliest, never that it is none of them. Whether a text is of any learned
# language is told by how likely its letters are, each with its two neighbours. A word counts
# by the language that makes it likeliest, so a text may be of several.
EVIDENCE_SLOTS = 1 << 16
EVIDENCE_LETTERS = 2048
"""Letters, about, that are drawn from a longer document of the sample, whole words by a hash."""
UNSEEN = 0.1
"""The share of probability spread over all slots."""
MARGIN = 5.0


def letters_in_words(grams: Grams, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each letter of a block: its row, the slot of its trigram, whether it begins a word."""
    points, row, lettered = grams.characters(block)
    held = np.where(lettered, points, 0x20).astype(np.uint64)
    before, after = np.full(len(held), 0x20, np.uint64), np.full(len(held), 0x20, np.uint64)
    same = row[1:] == row[:-1]
    before[1:] = np.where(same, held[:-1], 0x20)
    after[:-1] = np.where(same, held[1:], 0x20)
    with np.errstate(over="ignore"):
        gram = (before * np.uint64(0x100000001B3) + held) * np.uint64(0x100000001B3) + after
        slot = ((gram + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    return row[lettered], slot[lettered].astype(np.uint16), (before == 0x20)[lettered]


def evidence_of(row: np.ndarray, slot: np.ndarray, begins: np.ndarray, logs: np.ndarray, rows: int) -> np.ndarray:
    """Mean log probability of a letter of each row, each word by its likeliest language."""
    total, n = np.zeros(rows), np.bincount(row, minlength=rows)
    if len(slot):
        first = np.flatnonzero(begins)
        words = np.add.reduceat(logs[slot], first, axis=0).max(axis=1)
        total = np.bincount(row[first], words, minlength=rows)
    return np.where(n > 0, total / np.maximum(n, 1), -np.inf)


def _drawn_words(begins: np.ndarray, letters: int, seed: int) -> np.ndarray:
    """Which letters of a text are drawn: of all its words, by a hash of their place."""
    word = np.cumsum(begins).astype(np.uint64)
    with np.errstate(over="ignore"):
        marks = mix(word * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    return marks / 2.0**64 < letters / max(len(begins), 1)


def fit_evidence(docs: DataFrame, per_label: int = SAMPLE, letters: int = EVIDENCE_LETTERS, seed: int = 5) -> dict | None:
    """Log probabilities of trigrams by language, and the least evidence of a text of theirs.

    Learned on a bounded sample as the weights are: of `per_label` labelled documents, and of
    a document with more than `letters` letters as many, about, drawn from all over it. Ties
    go by the first label in order; without labelled rows there is no evidence. The bound comes from each sampled text
    scored as if its own letters had not been counted: as far below the first percentile as
    MARGIN times the distance from there to the median.
    """
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for block in blocks(batches, most_rows=BLOCK_ROWS):
            row, slot, begins = letters_in_words(grams, block)
            cut = np.searchsorted(row, np.arange(len(block.rows) + 1))
            parts = [a + np.flatnonzero(_drawn_words(begins[a:b], letters, seed)) for a, b in zip(cut, cut[1:])]
            columns = [
                block.rows.column("lang"),
                pa.array([slot[p].tobytes() for p in parts]),
                pa.array([begins[p].tobytes() for p in parts]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "slots", "begins"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)) if r[1]]
        if not drawn:
            return
        labels = sorted({r[0] for r in drawn})
        slots = [np.frombuffer(r[1], np.uint16) for r in drawn]
        seen = np.zeros((EVIDENCE_SLOTS, len(labels)))
        for (lang, *_), own in zip(drawn, slots):
            seen[:, labels.index(lang)] += np.bincount(own, minlength=EVIDENCE_SLOTS)
        total, scores = seen.sum(axis=0), []
        for (lang, _, begins), own in zip(drawn, slots):
            kinds, at, n = np.unique(own, return_inverse=True, return_counts=True)
            others, of = seen[kinds], labels.index(lang)
            others[:, of] -= n
            left = total.copy()
            left[of] -= len(own)
            logs = np.log((1 - UNSEEN) * others / np.maximum(left, 1) + UNSEEN / EVIDENCE_SLOTS)
            first = np.frombuffer(begins, bool)
            scores.append(evidence_of(np.zeros(len(own), np.int64), at, first, logs, 1)[0])
        low, middle = np.quantile(scores, [0.01, 0.5])
        logs = np.log((1 - UNSEEN) * seen / np.maximum(total, 1) + UNSEEN / EVIDENCE_SLOTS).astype(np.float32)
        least = float(low - MARGIN * (middle - low))
        yield pa.RecordBatch.from_pydict({"n": [len(labels)], "logs": [logs.tobytes()], "least": [least]})

    drawn = stage(sample(rows, per_label).mapInArrow(read, "lang string, slots binary, begins binary"), "language-evidence")
    # One task learns from the sample, which `per_label` bounds.
    learned = drawn.coalesce(1).mapInArrow(learn, "n long, logs binary, least double").collect()
    if not learned:
        return None
    logs = np.frombuffer(learned[0]["logs"], np.float32).reshape(EVIDENCE_SLOTS, learned[0]["n"])
    return {"logs": logs, "least": learned[0]["least"]}


def keep_languages(docs: DataFrame, model: dict | None, languages: list[str] | None = None, least: float = 0.5, evidence: dict | None = None) -> DataFrame:
    """Documents, all columns, in one of `languages` (any learned one) with a sure enough score
    and, where `evidence` is given, words as likely as those of the learned languages."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for block, labels, scores in _predicted(batches, model):
            wanted = [x != UNDETERMINED and (languages is None or x in languages) for x in labels]
            kept = np.array(wanted, bool) & (scores >= least)
            if evidence is not None:
                found = evidence_of(*letters_in_words(grams, block), evidence["logs"], len(block.rows))
                kept &= found >= evidence["least"]
            yield block.rows.filter(pa.array(kept))

    return docs.mapInArrow(keep, docs.schema)
