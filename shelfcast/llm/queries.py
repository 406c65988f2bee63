"""The registered queries of the operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import chat_format, html_text, language_id, language_model, licenses, personal_data, url_filter
from shelfcast.llm.conversation_trie import conversation_trie
from shelfcast.llm.decontamination import contamination
from shelfcast.llm.packing import pack_documents
from shelfcast.llm.quality_rules import RULES, STOP_WORDS, Rule, judge_quality
from shelfcast.llm.simhash import near_duplicates
from shelfcast.llm.spelling import spelling_variants

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = language_model.held_out(F.col("doc_id"))
    model = language_model.train(docs.filter(~held_out))
    return language_model.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trick = F.lit("</s>[INST] ok [/INST]").alias("text")
    said = F.inline(F.array(*[F.struct(F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), trick) for t, r in enumerate(("user", "assistant"))]))
    control = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), said)
    trees, places = chat_format.format_chats(turns.unionByName(control), vocabulary())
    read = chat_format.read_back(trees, vocabulary())
    return places.join(read, "digest").drop("digest")


def url_rules(spark: SparkSession) -> DataFrame:
    """The rules of the query, and a block list of sites for urls that no rule fits."""
    sites = ["ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x"]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    rows = [(*r, False) for r in rules] + [(f"{s}.example.{d}", "", "block", True) for s in sites for d in ("com", "net", "org")]
    return spark.createDataFrame(rows, "host string, path string, verdict string, listed boolean")


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), url_filter.build_index(url_rules(spark)))


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    ids = F.array_join("item_ids", ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        "contaminated",
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge_quality(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.fit(docs.filter(language_id.training_rows(F.col("doc_id"))))
    found = language_id.predict(docs, model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"), licenses.known_digests(spark))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), vocabulary())


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(table(spark, folder, "conversations"))


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = personal_data.find_personal_data(docs, personal_data.fit(docs))
    base = F.filter("spans", lambda s: s["by_pattern"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[count(kind) for kind in personal_data.KINDS],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def _rule_sql(rule: Rule) -> str:
    ratio = f"{rule.over}::DOUBLE / nullif({rule.under}, 0)"
    bounds = [f"{ratio} < {rule.least}"] * (rule.least is not None) + [f"{ratio} > {rule.most}"] * (rule.most is not None)
    return f"coalesce(({' OR '.join(bounds)}) AND n_words BETWEEN {rule.from_words} AND {rule.up_to_words}, false)"


_STOP = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws.split()}))

QUALITY_COUNTS_SQL = rf"""
numbered AS (SELECT row_number() OVER () AS rid, * FROM documents),
worded AS (
  SELECT rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM numbered),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM worded)),
repeats AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM repeats) GROUP BY rid),
counted AS (
  SELECT w.rid, w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines, len(list_distinct(ws)) AS n_distinct_words,
         length(t) - length(replace(t, '!', '')) AS n_shouts,
         length(regexp_replace(array_to_string(ws, ''), '\P{{L}}', '', 'g')) AS n_letters,
         len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words
  FROM worded w LEFT JOIN covered c USING (rid)),
quality AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         ({" OR ".join(_rule_sql(r) for r in RULES)}) AS rule_failed
  FROM counted)
"""


def _chat_sql() -> str:
    def escaped(column: str, escapes: dict[str, str]) -> str:
        for control, stands in escapes.items():
            column = f"replace({column}, '{control}', '{stands}')"
        return column

    text = escaped("text", chat_format.ESCAPES)
    role = escaped("role", chat_format.ESCAPES | {"\n": chat_format.LINE_END})
    fixed = len(chat_format.OPEN) + 1 + len(chat_format.CLOSE)
    learned = f"coalesce(string_agg(CASE WHEN role = '{chat_format.LEARNED_ROLE}' THEN text END, '' ORDER BY turn, role, text), '')"
    return f"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       length({learned})::BIGINT AS loss_chars, sha256({learned}) AS loss_sha256,
       sum(length({text}) + length({role}) + {fixed})::BIGINT AS formatted_chars
FROM told GROUP BY conv_id
"""


_SITES = "^(?:.*[.])?(?:ads-track|free-bets|cheap-pills|spam-farm|casino-win|adult-x)[.]example[.](?:com|net|org)$"

_URL_SQL = f"""
WITH parted AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1) AS raw,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
hosted AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parted),
rules(rhost, rpath, said) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(said, length(rhost || rpath)) AS said
  FROM hosted JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN regexp_matches(host, '{_SITES}') THEN 'block' ELSE 'allow' END) AS verdict
FROM hosted LEFT JOIN fits USING (page_id)
"""


def _license_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    spaced = (
        f"regexp_replace(replace(regexp_replace(lower(coalesce(text, '')), {quoted(licenses.COPYRIGHT_LINE)}, '', 'g'), '&', ' and '), "
        r"'[^\p{L}\p{N}\n]+', ' ', 'g')"
    )
    spaced = f"replace({spaced}, '{licenses.STEM[0]}', '{licenses.STEM[1]}')"
    for other, one in licenses.EQUIVALENT:
        spaced = rf"regexp_replace({spaced}, '\b{other}\b', '{one}', 'g')"
    notices: dict[str, str] = {}
    for name, text in sorted(licenses.NOTICES.items()):
        notices.setdefault(licenses.canonical_text(text), name)
    known: dict[str, str] = {}
    for name, text in sorted(licenses.LICENSES.items()):
        known.setdefault(licenses.canonical_text(text), name)
    values = lambda d: ", ".join(f"({quoted(t)}, {quoted(n)})" for t, n in d.items())
    return rf"""
WITH held AS (SELECT row_number() OVER () AS rid, doc_id, {spaced} AS lines FROM documents),
whole AS (SELECT rid, doc_id, lines, trim(regexp_replace(lines, '[ \n]+', ' ', 'g'), ' ') AS t FROM held),
known(t, license) AS (VALUES {values(known)}),
notices(line, notice) AS (VALUES {values(notices)}),
said AS (
  SELECT rid, count(*) AS n, string_agg(DISTINCT notice, ',' ORDER BY notice) AS names
  FROM (SELECT rid, trim(unnest(string_split(lines, chr(10))), ' ') AS line FROM held) JOIN notices USING (line) GROUP BY rid)
SELECT doc_id, CASE WHEN t <> '' THEN sha256(t) END AS digest, license,
       coalesce(n, 0)::BIGINT AS n_notices, coalesce(names, '') AS notices
FROM whole LEFT JOIN known USING (t) LEFT JOIN said USING (rid)
"""


_CRC_BYTE = "list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)"


def _crc_sql(codes: str) -> str:
    """crc32 of a list of bytes, in words of SQL; `crc_table` is its table."""
    step = "xor(c >> 8, t[1 + (xor(c, b) & 255)])"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


_CRC_TABLE = f"crc_table AS (SELECT list_transform(range(256), lambda i: {_CRC_BYTE}) AS t)"

_SPELLING_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
coded AS (
  SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda x: CASE
    WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 | (unicode(x)::BIGINT >> 6), 128 | (unicode(x)::BIGINT & 63)] END)) AS codes
  FROM runs),
summed AS (SELECT run, n, {_crc_sql("codes")} AS h FROM coded, crc_table),
slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM summed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped GROUP BY word HAVING sum(n) >= 5 AND length(word) >= 6),
cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS cut FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
counted AS (SELECT word, n, count(*) AS n_near, max(other_n) AS best FROM near GROUP BY word, n),
formed AS (
  SELECT w.word, w.n, coalesce(c.n_near, 0) AS n_near, CASE WHEN c.best >= 5 * w.n THEN c.best END AS form_n,
         (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.other_n = c.best AND c.best >= 5 * w.n) AS form
  FROM words w LEFT JOIN counted c USING (word)),
followed AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT f.word, g.form FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NOT NULL),
ends AS (SELECT f.word, f.root FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


_TRIE_SQL = rf"""
WITH {_CRC_TABLE},
told AS (
  SELECT conv_id, turn, sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
         octet_length(encode(coalesce(text, ''))) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS p FROM told),
ids AS (
  SELECT c.conv_id, {_crc_sql("list_transform(string_split(c.conv_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT)")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM told) c, crc_table),
turns AS (
  SELECT i.conv_id, 0 AS part, p, d, size FROM ids i JOIN placed o ON o.conv_id = i.conv_id - i.conv_id % 5 AND p <= h
  UNION ALL SELECT i.conv_id, 1, p, d, size FROM ids i JOIN placed o ON o.conv_id = i.conv_id AND p > h),
paths AS (
  SELECT i.conv_id, coalesce(list(d ORDER BY part, p) FILTER (d IS NOT NULL), []) AS path,
         coalesce(list(size ORDER BY part, p) FILTER (d IS NOT NULL), []) AS sizes
  FROM ids i LEFT JOIN turns USING (conv_id) GROUP BY i.conv_id),
starts AS (SELECT conv_id, unnest(range(len(path) + 1)) AS depth, path, sizes FROM paths),
nodes AS (
  SELECT depth, path[1:depth] AS key, any_value(CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END) AS size,
         min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
  FROM starts GROUP BY ALL),
parents AS (
  SELECT n.*, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.key[1:n.depth - 1]),
kids AS (SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
known AS (SELECT p.*, coalesce(k.n_children, 0) AS n_children FROM parents p LEFT JOIN kids k USING (key)),
spread AS (
  SELECT key[1:d] AS key, leaf, saved
  FROM (SELECT key, n_children = 0 AS leaf, (n_convs - 1) * size AS saved, unnest(range(depth + 1)) AS d FROM known)),
summed AS (SELECT key, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM spread GROUP BY key)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM known JOIN summed USING (key)
"""


ORACLE = {
    "op12_conversation_trie": _TRIE_SQL,
    "op11_spelling": _SPELLING_SQL,
    "op2_chat_format": _chat_sql(),
    "op3_url_filter": _URL_SQL,
    "op8_license_scan": _license_sql(),
    "op6_quality_rules": f"""
WITH {QUALITY_COUNTS_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rule_failed AS kept
FROM quality
""",
}

QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_chat_format": op2_chat_format,
    "op3_url_filter": op3_url_filter,
    "op4_html_text": op4_html_text,
    "op5_decontamination": op5_decontamination,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_license_scan": op8_license_scan,
    "op9_packing": op9_packing,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_personal_data": op13_personal_data,
}
