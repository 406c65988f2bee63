"""The corpus pipeline, stage by stage, on documents made for it."""

from __future__ import annotations

import random

import corpus_pipeline
from shelfcast.llm import simhash

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def made(spark, tmp_path):
    rng = random.Random(4)
    words = {
        lang: [rng.choice(starts) + rng.choice(ends) for _ in range(400)]
        for lang, starts, ends in [
            ("en", ["th", "wh", "st", "br", "kn"], ["ing", "ed", "ought", "ew", "ation"]),
            ("de", ["sch", "ge", "zw", "pf", "ü"], ["ung", "keit", "lich", "ein", "ß"]),
        ]
    }
    stop = {"en": ["the", "of", "and", "to"], "de": ["der", "die", "und", "nicht"]}
    say = lambda lang, n: " ".join(rng.choice(stop[lang] if rng.random() < 0.3 else words[lang]) for _ in range(n))
    item = say("en", 30)
    rows = [(i, say(lang, 120), lang) for i, lang in enumerate(["en", "de"] * 20)]
    rows += [(100 + i, rows[i][1], "en") for i in range(4)] + [(100, rows[0][1], "en")]  # exact copies, one of them twice
    rows += [(200, f"{item} {say('en', 40)}", "en"), (201, "*** ### buy " * 40, "en"), (202, "12 34 " * 3 + "5 6 7 8", None), (203, None, "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DOCUMENTS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs


def test_stages_keep_clean_documents(spark, tmp_path):
    docs = made(spark, tmp_path)
    left = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        kept = function(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        kept.write.parquet(f"{tmp_path}/{len(left)}")
        docs = spark.read.parquet(f"{tmp_path}/{len(left)}")
        left[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    clean = set(range(40))
    assert clean <= set(left["quality rules"]) and not {201, 202, 203} & set(left["quality rules"])
    assert clean <= set(left["language ID"])
    assert sorted(left["SimHash near-dedup"]) == sorted(clean | {200})
    assert sorted(left["benchmark decontamination"]) == sorted(clean)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == clean


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_carry_odd_rows_and_other_columns(spark, odd_docs, tmp_path):
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        kept = function(spark, odd_docs, str(tmp_path))
        assert kept.columns == odd_docs.columns
        assert kept.count() <= odd_docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs, str(tmp_path)).count() >= odd_docs.count()


def test_languages_rejects_foreign_texts_and_gibberish(spark, tmp_path):
    docs = made(spark, tmp_path).filter("doc_id < 40")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    both = [f"{rows[i][:300]} {rows[i + 1][-300:]}" for i in (0, 2)]
    rng = random.Random(8)
    foreign = [
        "litwo ojczyzno moja ty jesteś jak zdrowie ile cię trzeba cenić ten tylko się dowie kto cię stracił " * 4,
        "nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita " * 4,
        "мой дядя самых честных правил когда не в шутку занемог он уважать себя заставил " * 4,
        " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(6)) for _ in range(80)),
    ]
    texts = [(300 + i, t) for i, t in enumerate(both)] + [(400 + i, t) for i, t in enumerate(foreign)]
    # Of no label, so that nothing is learned from them.
    planted = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in texts], DOCUMENTS)
    kept = corpus_pipeline.languages(spark, docs.unionByName(planted), str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == set(range(40)) | {300, 301}


def test_near_duplicates_by_their_fingerprints(spark, tmp_path):
    """Exactly one of each group linked by two bits or fewer stays, by brute force."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(900)]
    rows = []
    for i in range(40):
        words = [rng.choice(vocabulary) for _ in range(300)]
        rows.append(" ".join(words))
        for edits in (0, 1, 2, 5):
            copy = list(words)
            for at in rng.sample(range(300), edits):
                copy[at] = "edited"
            rows.append(" ".join(copy).title() if not edits else " ".join(copy))
    prints = [simhash.fingerprint(t.lower().encode().split()) for t in rows]
    root = list(range(len(rows)))
    for _ in range(5):
        root = [min(root[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2) for p in prints]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(rows)], DOCUMENTS)
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))


def test_near_duplicates_of_a_large_group(spark, tmp_path):
    """One of thousands of copies stays, and none of the texts that differ."""
    words = [f"w{i}" for i in range(200)]
    text = " ".join(words)
    rows = [(i, text if i % 3 else f"{text} ", "en", "s", 0) for i in range(3000)]
    rows.append((5000, " ".join(reversed(words)), "en", "s", 0))
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOCUMENTS), str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 5000]
