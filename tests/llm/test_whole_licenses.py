"""Entire long licenses, and copyright lines that name a holder without a year."""

from __future__ import annotations

from shelfcast.llm import licenses
from shelfcast.llm.known_licenses import LICENSES

LONG = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"]
HOLDERS = ["Copyright (c) Microsoft Corporation.", "Copyright (c) Facebook, Inc. and its affiliates.", "Copyright The X Authors", "Copyright Example, Inc."]


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan(docs, licenses.known_digests(spark)).collect()
    return [r["license"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_long_licenses(spark):
    assert all(len(LICENSES[name]) > 5000 for name in LONG)
    assert found(spark, [LICENSES[name] for name in LONG]) == LONG
    cut = LICENSES["Apache-2.0"].split("APPENDIX")[0]
    assert found(spark, [cut.upper()]) == ["Apache-2.0, without appendix"]


def test_holders_without_a_year(spark):
    texts = [f"{holder}\n\n{LICENSES[name]}" for name in ("MIT", "BSD-3-Clause") for holder in HOLDERS]
    assert found(spark, texts) == ["MIT"] * len(HOLDERS) + ["BSD-3-Clause"] * len(HOLDERS)


def test_wrapped_lines_stay(spark):
    wrapped = LICENSES["BSD-3-Clause"].replace("above copyright notice", "above\ncopyright notice").replace("THE COPYRIGHT HOLDERS", "THE\nCOPYRIGHT HOLDERS")
    assert found(spark, [wrapped]) == ["BSD-3-Clause"]
