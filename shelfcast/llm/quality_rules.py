"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure is a column expression over the text, every rule a bound on a ratio of
two measures. All of them are evaluated in a single projection, without a shuffle and
without user functions.

Defined results: a null text has no words; a text without words has all counts zero and
fails the base rule, as does any text under `least_words`. A ratio over zero is null and
breaks no rule. Repeated rows and ties are judged row by row, extra columns are not read,
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

# Very frequent function words of the languages at hand.
STOP_WORDS = {
    "en": "the of and to in is that it for was on with as be by this are or an at from a",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas avec",
    "es": "de la que el en y los se del las un por con no una para su al lo mi",
}


@dataclass(frozen=True)
class Rule:
    """`over / under` must lie between `least` and `most`, for texts of so many words."""

    name: str
    over: str
    under: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0
    up_to_words: int = 2**31 - 1


RULES = [
    Rule("mean_word_length", "word_chars", "n_words", 1.5, 16.0),
    Rule("symbols_per_word", "n_symbols", "n_words", most=0.2),
    Rule("shouts_per_word", "n_shouts", "n_words", most=0.4),
    Rule("stop_word_share", "n_stop_words", "n_words", least=0.02, from_words=100),
    Rule("distinct_word_share", "n_distinct_words", "n_words", least=0.2, up_to_words=400),
    Rule("letter_share", "n_letters", "word_chars", least=0.6),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", most=0.5),
]


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once, inside one expression."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def words_of(text: Column) -> Column:
    """The runs of characters other than ASCII white space."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return bind(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"[{WHITE}]+")))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words stand in a window that the text holds twice or more.

    Windows are compared by a 64-bit hash, put together from the hashes of their halves, so
    `window` is a power of two. A text whose hashes all differ, as most do, is done after
    one pass through a hash set. Otherwise the hashes are sorted with their places, equal
    neighbours give the places of repeats, and the lengths of the stretches they cover are
    added up.
    """

    def hashes(parts: Column, span: int) -> Column:
        if span == window:
            return bind(parts, from_hashes)
        later = F.slice(parts, span + 1, F.greatest(F.size(parts) - span, F.lit(0)))
        # The longer list is cut to the shorter one: places without a whole window go.
        pairs = F.zip_with(F.slice(parts, 1, F.greatest(F.size(parts) - span, F.lit(0))), later, lambda a, b: F.xxhash64(a, b))
        return bind(pairs, lambda p: hashes(p, 2 * span))

    def covered(starts: Column) -> Column:
        following = F.slice(starts, 2, F.size(starts))
        gaps = F.zip_with(starts, following, lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window)))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def from_sorted(ordered: Column) -> Column:
        pairs = F.zip_with(
            ordered,
            F.slice(ordered, 2, F.size(ordered)),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["at"], b["at"])).otherwise(F.array().cast("array<int>")),
        )
        return bind(F.sort_array(F.array_distinct(F.flatten(pairs))), covered)

    def from_hashes(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(F.sort_array(placed), from_sorted))

    each = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(bind(each, lambda h: hashes(h, 1)))


def _left_out(text: Column, pattern: str) -> Column:
    """How many characters of `text` match the one-character pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measures(text: Column) -> Column:
    """All counts of a text as one struct."""
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws.split()})

    def from_words(words: Column) -> Column:
        whole = F.coalesce(text, F.lit(""))
        lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(f"[^{WHITE}]"))

        def counted(kept: Column, glued: Column) -> Column:
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(glued).cast("long").alias("word_chars"),
                _left_out(whole, SYMBOLS).cast("long").alias("n_symbols"),
                (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
                repeated_words(words).cast("long").alias("n_repeat_words"),
                F.size(kept).cast("long").alias("n_lines"),
                F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
                _left_out(whole, "!").cast("long").alias("n_shouts"),
                (F.length(glued) - _left_out(glued, "\\P{L}")).cast("long").alias("n_letters"),
                F.size(F.filter(words, lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
            )

        return bind(lines, lambda kept: bind(F.array_join(words, ""), lambda glued: counted(kept, glued)))

    return bind(words_of(text), from_words)


def broken(counts: Column, rules: list[Rule]) -> Column:
    """The names of the rules that the counts break."""
    found = []
    for rule in rules:
        ratio = F.when(counts[rule.under] > 0, counts[rule.over] / counts[rule.under])
        outside = F.lit(False)
        if rule.least is not None:
            outside = outside | (ratio < rule.least)
        if rule.most is not None:
            outside = outside | (ratio > rule.most)
        outside = outside & counts["n_words"].between(rule.from_words, rule.up_to_words)
        found.append(F.when(F.coalesce(outside, F.lit(False)), F.lit(rule.name)))
    return F.filter(F.array(*found), lambda name: name.isNotNull())


def base_failed(counts: Column, least_words: int, most_repeat_percent: int) -> Column:
    return (counts["n_words"] < least_words) | (100 * counts["n_repeat_words"] > most_repeat_percent * counts["n_words"])


def judged(
    text: Column, rules: list[Rule] | None = None, least_words: int = 20, most_repeat_percent: int = 30
) -> Column:
    """Struct of all counts, `base_failed`, `broken_rules` and `kept` of a text."""

    def from_counts(counts: Column) -> Column:
        failed = base_failed(counts, least_words, most_repeat_percent)
        names = broken(counts, RULES if rules is None else rules)
        return F.struct(
            counts.alias("counts"),
            failed.alias("base_failed"),
            names.alias("broken_rules"),
            (~failed & (F.size(names) == 0)).alias("kept"),
        )

    return bind(measures(text), from_counts)


def judge_quality(docs: DataFrame, **limits) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept and the rules broken."""
    rows = docs.select("doc_id", judged(docs["text"], **limits).alias("judged"))
    return rows.select("doc_id", "judged.counts.*", "judged.base_failed", "judged.kept", "judged.broken_rules")


def keep_quality(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, with their own columns."""
    return docs.filter(judged(docs["text"], **limits)["kept"])
