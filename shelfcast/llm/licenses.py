"""License scans: entire texts in a canonical form, looked up by digest.

Case, punctuation, white space, copyright lines and equivalent spellings do not make a text
another license, so they are normalised away, in texts and in known licenses alike. The
digest of what is left joins the known digests. Lines are looked up in the same way among
known short notices, within the row, so no text is exploded or shuffled.

Defined results: a null text, and one with nothing left in canonical form, has a null digest
and no license; several known names of the same text give the first by name; repeated rows
get a row each; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.known_licenses import LICENSES, NOTICES

# Spellings that license guidelines hold to be the same.
EQUIVALENT = [
    ("licensor", "licenser"),
    ("copyright owner", "copyright holder"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("acknowledgement", "acknowledgment"),
    ("cancelled", "canceled"),
    ("fulfilment", "fulfillment"),
    ("favour", "favor"),
    ("labour", "labor"),
    ("judgement", "judgment"),
    ("modelled", "modeled"),
    ("recognised", "recognized"),
    ("wilful", "willful"),
    ("whilst", "while"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("http", "https"),
]

# The stem that both spellings of license share, in every form of the word.
STEM = ("licenc", "licens")

# Lines of copyright name a year or, after a sign or in a known way, a holder. Other lines that
# begin with the word (`copyright notice, this list`, `copyright holders and contributors`) are
# wrapped sentences and stay.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:copyright *(?:\(c\)|\x{a9})|copyright *(?:\d|<|\[|\{)|\(c\) *(?:copyright|\d)|\x{a9}|all rights reserved"
    r"|copyright (?:by )?the [^\n]*\b(?:authors|contributors|developers|project|team|foundation|community|university)\b"
    r"|copyright [^\n]*\b(?:inc|llc|ltd|gmbh|corp|corporation|foundation|authors)\b)[^\n]*"
)


def canonical(text: Column) -> Column:
    """Lower-case words by one blank, lines kept, without lines of copyright."""
    low = F.lower(F.coalesce(text, F.lit("")))
    plain = F.regexp_replace(low, COPYRIGHT_LINE, "")
    spaced = F.regexp_replace(F.replace(plain, F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}\n]+", " ")
    alike = F.replace(spaced, F.lit(STEM[0]), F.lit(STEM[1]))
    for other, one in EQUIVALENT:
        alike = F.regexp_replace(alike, rf"\b{other}\b", one)
    # Most texts hold none of these spellings: one look tells.
    return F.when(spaced.rlike("|".join([STEM[0], *(other for other, _ in EQUIVALENT)])), alike).otherwise(spaced)


def one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def canonical_text(text: str) -> str:
    """The same form of a known text, worked out where the table of them is made."""
    low = re.sub(COPYRIGHT_LINE.replace(r"[^\p{L}\p{N}\n]", r"[^\w\n]").replace(r"\x{a9}", "\u00a9"), "", text.lower())
    spaced = re.sub(r"[^\w\n]+|_+", " ", low.replace("&", " and ")).replace(*STEM)
    for other, one in EQUIVALENT:
        spaced = re.sub(rf"\b{other}\b", one, spaced)
    return " ".join(spaced.split())


def known_digests(spark: SparkSession, licenses: dict[str, str] | None = None) -> DataFrame:
    """digest and license of the known texts."""
    rows: dict[str, str] = {}
    for name, text in sorted((LICENSES if licenses is None else licenses).items()):
        rows.setdefault(hashlib.sha256(canonical_text(text).encode()).hexdigest(), name)
    if not rows:
        return spark.sql("SELECT '' AS digest, '' AS license WHERE false")
    quoted = [(d, n.replace("\\", "\\\\").replace("'", "\\'")) for d, n in rows.items()]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(f"('{d}', '{n}')" for d, n in quoted)} AS t(digest, license)")


def scan(docs: DataFrame, known: DataFrame, notices: dict[str, str] | None = None) -> DataFrame:
    """doc_id, digest of the canonical text, license of the entire text, notices by line."""
    names: dict[str, str] = {}
    for name, text in sorted((NOTICES if notices is None else notices).items()):
        names.setdefault(canonical_text(text), name)
    held = docs.select("doc_id", canonical(F.col("text")).alias("lines"))
    whole = one_line(F.col("lines"))
    said = F.filter(F.transform(F.split("lines", "\n"), lambda line: F.trim(line)), lambda line: line.isin(list(names)))
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    rows = held.select(
        "doc_id",
        F.when(whole != "", F.sha2(whole, 256)).alias("digest"),
        F.size(said).cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(said, lambda line: table[line]))), ",").alias("notices"),
    )
    return rows.join(known, "digest", "left").select("doc_id", "digest", "license", "n_notices", "notices")
