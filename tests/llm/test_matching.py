"""Decontamination, SimHash and the language model against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfcast.llm import decontamination, language_model, simhash
from shelfcast.llm.blocks import LOWER, blocks

ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER_BYTES = bytes(LOWER)


def lower(text):
    return (text or "").encode().translate(LOWER_BYTES).decode()


def contamination_by_hand(texts, items, window=13):
    windows = defaultdict(set)
    for name, text in items:
        words = ITEM_WORDS.findall(lower(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add("" if name is None else str(name))
    out = []
    for text in texts:
        words, hit, found = ITEM_WORDS.findall(lower(text)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(words) - n + 1):
                if names := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= names
        out.append((len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)))
    return out


@pytest.mark.parametrize("seed, block_words", [(1, 100_000), (2, 100_000), (3, 30), (4, 8)])
def test_contamination_equals_brute_force(spark, seed, block_words):
    rng = random.Random(seed)
    alphabet = "ab cd É ef x9".split()
    say = lambda n: " ".join(rng.choice(alphabet) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 3, 12, 13, 14, 30]) if seed % 2 else rng.choice([5, 13, 20]))) for i in range(14)]
    items += [(None, "Ab, cD! ef"), (3, items[3][1]), (20, None)]
    texts = [say(rng.randint(0, 60)) for _ in range(30)]
    texts += [f"{say(5)} {items[i][1]}; {say(9)}" for i in range(12)] + [None, "", "AB-CD ef"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.contamination(docs, table, block_words=block_words).collect()}
    for i, want in enumerate(contamination_by_hand(texts, items)):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["item_ids"], got[i]["contaminated"]) == want
        whole = (texts[i] or "").encode()
        inside = " ".join(whole[s["start"] : s["end"]].decode() for s in got[i]["spans"])
        assert len(ITEM_WORDS.findall(lower(inside))) == want[1]


def test_more_automata_than_a_pass_holds(spark, tmp_path):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("ab cd É ef x9 gh".split()) for _ in range(n))
    items = [(i, say(rng.choice([2, 6, 13, 16]))) for i in range(60)] + [(77, say(200))]
    table = spark.createDataFrame(items, "item_id long, text string")
    names = decontamination.write_automata(table, str(tmp_path), block_words=20)
    assert len(names) > 2 * decontamination.PASS_BLOCKS
    assert decontamination.write_automata(table.limit(0), str(tmp_path)) == []
    texts = [say(40) for _ in range(20)] + [items[-1][1][90:300], items[0][1], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.contamination(docs, table, block_words=20).collect()}
    for i, want in enumerate(contamination_by_hand(texts, items)):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["item_ids"], got[i]["contaminated"]) == want
    left = decontamination.decontaminate(docs, table, block_words=20)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i in got if not got[i]["contaminated"]}


def test_pieces_of_a_long_item_hold_each_window():
    words = [b"%d" % i for i in range(100)]
    blocks = list(decontamination.item_blocks([("a", words), ("b", words[:4]), ("c", [])], 20, 13))
    assert all(sum(len(w) for _, w in block) <= 20 for block in blocks)
    held = {tuple(w[i : i + 13]) for block in blocks for name, w in block if name == "a" for i in range(len(w) - 12)}
    assert held == {tuple(words[i : i + 13]) for i in range(88)}
    assert [w for block in blocks for name, w in block if name == "b"] == [words[:4]]


def test_decontaminate_cuts_spans_and_drops_documents(spark, odd_docs, no_docs):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    filler = " ".join(f"w{i}" for i in range(400))
    rows = [(50, f"é {filler} {item.upper()}. End", "en", "s", None, 1, 1), (51, f"see {item}", "en", "s", 1, 1, 1)]
    docs = odd_docs.unionByName(spark.createDataFrame(rows, odd_docs.schema))
    left = decontamination.decontaminate(docs, items)
    assert left.columns == docs.columns
    by_id = {r["doc_id"]: r for r in left.collect()}
    assert by_id[50]["text"] == f"é {filler} . End"
    assert by_id[50]["n_chars"] == len(by_id[50]["text"])
    assert 51 not in by_id
    assert left.count() == docs.count() - 1
    assert decontamination.decontaminate(docs, items.limit(0)).count() == docs.count()
    assert decontamination.contamination(no_docs, items).count() == 0


def components_by_hand(values, distance=2):
    values = sorted(set(values))
    above = list(range(len(values)))

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                above[max(find(i), find(j))] = min(find(i), find(j))
    return {v: values[find(i)] for i, v in enumerate(values)}


@pytest.mark.parametrize("full_cell", [2, 32])
def test_components_of_fingerprints(spark, monkeypatch, full_cell):
    monkeypatch.setattr(simhash, "FULL_CELL", full_cell)
    rng = random.Random(full_cell)
    values = [rng.getrandbits(64) for _ in range(60)]
    for base in values[:12]:
        for _ in range(rng.randint(1, 20)):  # chains and clusters of neighbours
            base ^= 1 << rng.randrange(64) ^ (rng.random() < 0.6) << rng.randrange(64)
            values.append(base)
    ids = list(range(len(values)))
    rng.shuffle(ids)
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in zip(ids, values)]
    frame = spark.createDataFrame(rows + rows[:20], "doc_id long, bits long")
    root = components_by_hand(values)
    least = defaultdict(lambda: 10**9)
    for i, v in zip(ids, values):
        least[root[v]] = min(least[root[v]], i)
    got = simhash.classes(frame).collect()
    assert len(got) == len(rows) + 20
    assert all(r["component"] == least[root[r["bits"] % 2**64]] for r in got)


def test_fingerprints_and_classes_of_texts(spark, odd_docs, no_docs):
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        words = (texts[r["doc_id"]] or "").encode().translate(LOWER_BYTES).split()
        assert int(r["fingerprint"], 16) == simhash.fingerprint(words)
    component = {r["doc_id"]: r["component_id"] for r in got}
    assert component[1] == component[2] == component[5] == 1  # no words, fingerprint zero
    assert component[None] is None
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    names = [r["doc_id"] for r in kept.collect()]
    assert sorted(str(x) for x in names) == ["1", "3", "4", "6", "7", "None"]
    assert simhash.keep_one(no_docs).count() == 0


def test_blocks_grow_with_the_number_of_values():
    assert [simhash.blocks_for(n, 2) for n in (0, 1000, 10**8, 10**11)] == [4, 4, 6, 12]


def model_by_hand(train, texts, count_discounts):
    pairs, counts = Counter(), Counter()
    for words in train:
        counts.update(words)
        pairs.update(zip([None, *words], words))
    total, kinds, before = Counter(), defaultdict(Counter), Counter()
    for (v, w), n in pairs.items():
        total[v] += n
        kinds[v][min(n, 3)] += 1
        before[w] += 1
    off = count_discounts([Counter(pairs.values())[k] for k in (1, 2, 3, 4)])
    own = count_discounts([Counter(before.values())[k] for k in (1, 2, 3, 4)])
    gamma = sum(own[min(n, 3)] for n in before.values()) / len(pairs) if pairs else 1
    for words in texts:
        score = base = 0
        for v, w in zip([None, *words], words):
            base += math.log10((counts[w] + 1) / (sum(counts.values()) + len(counts) + 1))
            p = max(before[w] - own[min(before[w], 3)], 0) / max(len(pairs), 1) + gamma / (len(counts) + 1)
            if total[v]:
                left = sum(off[k] * kinds[v][k] for k in (1, 2, 3)) / total[v]
                p = max(pairs[v, w] - off[min(pairs[v, w], 3)], 0) / total[v] + left * p
            score += math.log10(p)
        yield len(words), sum(counts[w] > 0 for w in words), base, score


@pytest.mark.parametrize("small", [False, True])
def test_language_model_equals_plain_counts(spark, odd_docs, monkeypatch, small):
    if small:  # many ranges, and words that fill several
        monkeypatch.setattr(language_model, "RANGE_TOKENS", 40)
        monkeypatch.setattr(language_model, "VOCABULARY_BYTES", 200)
    rng = random.Random(5)
    words = [f"W{int(rng.paretovariate(0.8))}" for _ in range(4000)]
    rows = [(100 + i, " ".join(words[i * 20 : i * 20 + rng.randint(0, 20)])) for i in range(200)]
    docs = odd_docs.filter("doc_id <> 3 OR doc_id IS NULL").select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    place = language_model.train(docs.filter(~language_model.held_out(docs["doc_id"])))
    told = [(r["doc_id"], [*lower(r["text"]).split(), "</s>"]) for r in docs.collect()]
    train = [w for i, w in told if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    want = model_by_hand(train, [w for _, w in told], language_model.discounts)
    got = language_model.score(docs, place).collect()
    assert place["tokens"] == sum(map(len, train))
    for row, (n, known, base, score) in zip(got, want, strict=True):
        assert (row["n_tokens"], row["n_known"]) == (n, known)
        assert np.allclose([row["base_score"], row["score"]], [base, score])
    if small:
        assert len(place["ranges"]) > 20 and place["shards"] > 3
        assert place["splits"] == sorted(place["splits"])


def test_language_model_probabilities_add_up(spark):
    texts = ["a b a c", "b b a", "c a b", "a a a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    place = language_model.train(docs)
    model = language_model.Model(place)
    every = [f"a {w}" for w in ("a", "b", "c", "d", "", "unseen")]  # the empty one: the end
    batch = pa.RecordBatch.from_arrays([pa.array(every)], names=["text"])
    hashes, bounds = language_model.token_hashes(next(blocks([batch])))
    _, logs = model.score(hashes, bounds)
    assert np.isclose((10 ** logs[bounds[:-1] + 1]).sum(), 1)
    assert np.isclose((10 ** logs[bounds[:-1]]).std(), 0)


def test_a_model_of_many_ranges_keeps_few_maps_open(spark, monkeypatch):
    monkeypatch.setattr(language_model, "RANGE_TOKENS", 2)
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(100)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    place = language_model.train(docs)
    assert len(place["ranges"]) > 1000
    batch = docs.toArrow().to_batches()[0]
    hashes, bounds = language_model.token_hashes(next(blocks([batch])))
    few, all_open = language_model.Model(place), language_model.Model(place)
    few.maps.most = 8
    for got, want in zip(few.score(hashes, bounds), all_open.score(hashes, bounds)):
        assert (got == want).all()
    assert len(few.maps.held) <= 8 < 1000 < len(all_open.maps.held)


def test_language_model_without_texts(spark, odd_docs, no_docs):
    place = language_model.train(no_docs)
    rows = language_model.score(odd_docs, place).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["score"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in rows)
    assert language_model.score(no_docs, place).count() == 0
