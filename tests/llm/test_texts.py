"""Blocks, quality rules, language ID and license scans."""

from __future__ import annotations

import collections
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import language_id, licenses, quality_rules
from shelfcast.llm.blocks import LOWER, WHITE_SPACE, blocks, word_hashes, word_spans
from shelfcast.llm.known_licenses import LICENSES

WORDS = re.compile("[^\x20\x09-\x0d]+")


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t中 .", max_size=20)), min_size=1, max_size=12), st.integers(1, 30))
def test_blocks_give_the_words_of_each_text(texts, size):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]).slice(0)
    found, hashes = [], collections.defaultdict(set)
    for block in blocks([batch], most_bytes=size, most_rows=5):
        data = LOWER[block.data]
        starts, ends, bounds = word_spans(~WHITE_SPACE[data], block.offsets)
        words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
        for word, h in zip(words, word_hashes(data, starts, ends).tolist()):
            hashes[word].add(h)
        found += [words[a:b] for a, b in zip(bounds, bounds[1:])]
    assert found == [WORDS.findall((t or "").replace("B", "b")) for t in texts]
    assert all(len(h) == 1 for h in hashes.values())
    assert len({h for hs in hashes.values() for h in hs}) == len(hashes)


def quality_by_hand(text):
    text = text or ""
    words = WORDS.findall(text)
    places = collections.defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {p for at in places.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall("[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words),
    }


def test_quality_counts_equal_a_plain_count(spark, odd_docs):
    loops = [("a b c d e f g h i j " * n + tail,) for n in (1, 2, 3) for tail in ("", "x y z\nq\nq\n\nq", "a b c")]
    tricky = [("one two three four five six seven eight\n" * 2,), ("w " * 8,), ("w " * 9,), ("# * $ % & | < > é",)]
    docs = odd_docs.select("text").unionByName(spark.createDataFrame(loops + tricky, "text string"))
    docs = docs.withColumn("doc_id", F.monotonically_increasing_id())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in quality_rules.judge_quality(docs).collect():
        want = quality_by_hand(texts[row["doc_id"]])
        assert {k: row[k] for k in want} == want
        assert row["kept"] == (not row["base_failed"] and not row["broken_rules"])


def test_quality_keeps_clean_texts_and_all_columns(spark, odd_docs, no_docs):
    clean = " ".join(f"the word{i} of a sentence{i} is here" for i in range(30))
    rows = [(10, clean, "en", "s", 1, 9, 9), (11, "buy now!!! " * 40, "en", "s", 1, 9, 9), (12, "*** ### " + clean[:90], "en", "s", 1, 9, 9)]
    kept = quality_rules.keep_quality(odd_docs.unionByName(spark.createDataFrame(rows, odd_docs.schema)))
    assert kept.columns == odd_docs.columns
    assert 10 in [r["doc_id"] for r in kept.collect()]
    assert 11 not in [r["doc_id"] for r in kept.collect()]
    assert quality_rules.judge_quality(no_docs).count() == 0


def test_quality_runs_without_python(odd_docs):
    plan = quality_rules.judge_quality(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan.replace("ArrowEvalPythonExec", "Python"))


def labelled(spark, n=60):
    vocabulary = {"en": "the of and to in thing with house", "de": "der und die nicht schön haus für über", "fr": "le et dans très été où maison avec"}
    rng = np.random.default_rng(3)
    rows = [(i * 3 + k, " ".join(rng.choice(words.split(), 30)), lang) for i in range(n) for k, (lang, words) in enumerate(vocabulary.items())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_held_out_texts(spark):
    docs = labelled(spark)
    model = language_id.fit(docs.filter(language_id.training_rows(F.col("doc_id"))), per_label=30)
    found = language_id.predict(docs, model).join(docs, "doc_id").filter(language_id.held_out(F.col("doc_id"))).collect()
    assert len(found) > 30
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)
    zero = (model["weights"] == 0).mean()
    assert zero > 0.5  # the penalty leaves most slots without weight


def test_language_of_odd_texts(spark, odd_docs, no_docs):
    model = language_id.fit(labelled(spark, 20))
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(odd_docs, model).collect()}
    assert got[1] == got[2] == got[5] == got[6] == "und"
    assert got[3] == "de"
    assert language_id.predict(odd_docs, model).count() == odd_docs.count()
    assert language_id.predict(no_docs, model).count() == 0
    assert language_id.keep_languages(odd_docs, model).columns == odd_docs.columns
    nothing = language_id.fit(no_docs)
    assert nothing is None
    assert {r["lang_pred"] for r in language_id.predict(odd_docs, nothing).collect()} == {"und"}


def test_temperature_of_sure_and_unsure_scores():
    labels = np.array([0, 0, 0, 1])
    assert language_id.temperature(np.array([[8.0, 0]] * 4), labels) > 5
    assert language_id.temperature(np.array([[0.1, 0], [0.1, 0], [0.1, 0], [0, 0.1]]), labels) < 1


def test_licenses_by_their_canonical_text(spark, odd_docs, no_docs):
    rows = [(i, "Copyright (c) 2021 Some One\n" + t.upper().replace("LICENSE", "licence").replace("\n", " \n\t")) for i, t in enumerate(LICENSES.values())]
    rows.append((99, LICENSES["MIT"] + " and more"))
    rows.append((98, "A text.\nReleased under the MIT licence!\nCopyright 2020 X\nReleased under the MIT License."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = licenses.known_digests(spark)
    got = {r["doc_id"]: r for r in licenses.scan(docs, known).collect()}
    assert [got[i]["license"] for i in range(len(LICENSES))] == list(LICENSES)
    assert got[99]["license"] is None
    assert (got[98]["n_notices"], got[98]["notices"], got[98]["license"]) == (2, "MIT", None)
    odd = licenses.scan(odd_docs, known).collect()
    assert len(odd) == odd_docs.count()
    assert {r["doc_id"] for r in odd if r["digest"] is None} == {1, 2, 5}
    assert licenses.scan(no_docs, known).count() == 0
    assert licenses.scan(docs, licenses.known_digests(spark, {})).filter("license is not null").count() == 0


def test_signs_beyond_the_basic_plane_are_no_letters_unless_they_are(spark):
    text = {0: "the cat of the north", 1: "der hund und die katze"}
    rows = [(i, text[i % 2], "en" if i % 2 == 0 else "de") for i in range(30)]
    rows += [(100, "\U0001f600\U0001f680", None), (101, "\U0001f600 the cat of the north", None), (102, "\U00010330\U00010331", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs.filter("lang IS NOT NULL"))
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model).collect()}
    assert got[100] == language_id.UNDETERMINED and got[101] == "en" and got[102] in ("de", "en")


def test_evidence_is_drawn_from_all_over_a_long_text():
    begins = np.zeros(90_000, bool)
    begins[::6] = True
    drawn = language_id._drawn_words(begins, 2048, 5)
    assert 1800 < drawn.sum() < 2300 and drawn[60_000:].any() and drawn[:30_000].any()
    assert all(len(set(drawn[i : i + 6])) == 1 for i in range(0, 90_000, 6))
    assert language_id._drawn_words(begins[:60], 2048, 5).all()
