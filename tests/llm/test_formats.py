"""Chat trees, URL rules, page texts and packing."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import arrays, chat_format, html_text, packing, url_filter
from shelfcast.llm.queries import vocabulary

CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "<|turn|>", "<<SYS>>", "\\", "\\e", "\n", "a", "é ", "<|endoftext|>", "<", "[/"]
control_text = st.lists(st.sampled_from(CONTROL), max_size=8).map("".join)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.tuples(control_text, control_text), min_size=1, max_size=4))
def test_formatted_turns_read_back(turns):
    parts = [p for role, text in turns for p in chat_format.segments(role, text)]
    assert chat_format.parse("".join(s for s, _ in parts)) == turns
    for _, text in turns:
        escaped = chat_format.escape(text)
        assert not any(c in escaped for c in chat_format.ESCAPES if c != "\\")
        assert chat_format.unescape(escaped) == text


def chats(seed, n=60):
    rng = random.Random(seed)
    say = lambda: "".join(rng.choice(CONTROL) + " word" for _ in range(rng.randint(0, 6)))
    family = [[("system", "be kind"), ("user", "hello")], [("user", "hello")]]
    rows = []
    for i in range(n):
        turns = list(rng.choice(family)) if rng.random() < 0.7 else []
        turns += [(("user", "assistant")[k % 2], say()) for k in range(rng.randint(1, 4))]
        if i % 9 == 0:
            turns = [("user", "the same"), ("assistant", "for all"), ("user", None)]
        rows += [(i, k, role, text) for k, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most_tokens", [60, 100_000])
def test_chat_trees(spark, most_tokens):
    rows = [*chats(most_tokens), (77, 0, None, "role missing"), (None, 0, "user", "no id"), (78, None, "assistant", "x"), (78, None, "assistant", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    trees, places = chat_format.format_chats(turns, vocabulary(), most_tokens)
    read = {r["digest"]: r for r in chat_format.read_back(trees, vocabulary()).collect()}
    want = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1])):
        want[conv].append((role or "", text or ""))
    got = {r["conv_id"]: read[r["digest"]] for r in places.collect()}
    assert set(got) == set(want)
    for conv, said in want.items():
        learned = "".join(t for r, t in said if r == "assistant")
        assert got[conv]["n_turns"] == len(said)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(learned)
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    leaves = 0
    for tree in trees.collect():
        n = len(tree["tokens"])
        assert len(tree["position_ids"]) == len(tree["loss_mask"]) == n
        assert len(tree["leaves"]) == 1 or n <= most_tokens
        leaves += len(tree["leaves"])
        end = 0
        for node in tree["nodes"]:  # nodes follow each other, depth first, and cover all tokens
            assert node["start"] == end and node["parent"] < tree["nodes"].index(node)
            end = node["end"]
            at = [i for s in node["attends"] for i in range(s["start"], s["end"])]
            assert [tree["position_ids"][i] for i in at] == list(range(len(at)))
        assert end == n
    assert leaves == len({tuple(s) for s in want.values()})
    if most_tokens > 60:
        shared = sum(len(t["tokens"]) for t in trees.collect())
        assert shared < sum(len(packing.encoder(vocabulary()).encode_ordinary("".join(s for p in c for s, _ in chat_format.segments(*p)))) for c in want.values())


def test_no_chats(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    trees, places = chat_format.format_chats(turns, vocabulary())
    assert trees.count() == places.count() == 0


def verdict_by_hand(rules, host, path):
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v, listed in rules
        if not listed and (host == h or host.endswith("." + h)) and path.startswith(p) and host
    ]
    if fits:
        return max(fits)[2:]
    listed = [v for h, p, v, x in rules if x and (host == h or host.endswith("." + h)) and path.startswith(p) and host]
    return None, "block" if listed else "allow"


@pytest.mark.parametrize("shard_rules, collide", [(2_000_000, False), (3, False), (2_000_000, True)])
def test_url_rules(spark, monkeypatch, shard_rules, collide):
    monkeypatch.setattr(url_filter, "SHARD_RULES", shard_rules)
    if collide:  # digests that are often equal: only the stored strings tell rules apart
        real = url_filter._key
        monkeypatch.setattr(url_filter, "_key", lambda host, path: real(host, path) % 5 << 61)
    rules = [
        ("com", "/", "allow", False), ("example.com", "/en/", "block", False), ("www.example.com", "/en/", "allow", False),
        ("net", "/es/", "block", False), ("net", "/fr/", "block", False), ("bad.org", "", "block", True),
        ("example.com", "/e", "block", False), ("b.c", "/long/path", "block", False), ("a.b.c", "/long", "allow", False),
    ]
    urls = [
        "https://www.Example.com/en/1", "http://x.example.com/en/2?q=/en/", "https://example.com", "https://example.com/e#x",
        "http://a.net/es/1", "http://a.net/esp", "http://net/fr/", "http://anet/fr/", "http://x.bad.org/any", "http://notbad.org/",
        "HTTP://EXAMPLE.COM/EN/", "no scheme", "", None, "://com/", "http:///path", "http://a.b.c/long/path", "ftp://u@h.com:80/x://y",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, urls[0])], "page_id long, url string")
    table = spark.createDataFrame(rules + rules[:2], "host string, path string, verdict string, listed boolean")
    place = url_filter.build_index(table)
    got = url_filter.judge_urls(pages, place, most_probes=7).collect()
    for row, url in zip(got, [*urls, urls[0]], strict=True):
        host, path = url_filter.host_and_path(url)
        assert (row["host"], row["path"]) == (host, path)
        assert (row["rule"], row["verdict"]) == verdict_by_hand(rules, host, path)
    assert [(r["host"], r["path"]) for r in got][10:15] == [("example.com", "/EN/"), ("", ""), ("", ""), ("", ""), ("com", "/")]
    assert url_filter.judge_urls(pages.limit(0), place).count() == 0
    nothing = url_filter.build_index(table.limit(0))
    assert {r["verdict"] for r in url_filter.judge_urls(pages, nothing).collect()} == {"allow"}


def test_arrays_of_a_store_that_is_not_mounted(tmp_path, monkeypatch):
    values = [np.arange(10, dtype=np.uint64), np.zeros(0, np.uint8)]
    for name, array in zip("ab", values):
        arrays.write_array(f"file://{tmp_path}/x", name, array)
        assert (arrays.mapped(f"file://{tmp_path}/x", name) == array).all()
    monkeypatch.setattr(arrays, "_mounted", lambda folder: None)
    for name, array in zip("cd", values):
        arrays.write_array(f"file://{tmp_path}/y", name, array)
        assert (arrays.mapped(f"file://{tmp_path}/y", name) == array).all()
    assert len(list(tmp_path.glob("*/*"))) == 4


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p > a{}</style><script>var t="</p><p>no";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a>b">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div>
<div id=cookie-notice>We use cookies</div><article class="post sidebar"><header><h1>The &amp; title</h1></header><p>One&nbsp;<b>bo</b>ld
 &lt;tag&gt; &#233;<br>line</p><aside>no</aside><p>Two <a href=x>link</a><ul><li>x<li>y</ul><form><input>no</form>
<div class="promoBox">no</div><section class="comments"><article><p>Reader says</p></article></section></article>
<div role="complementary">no</div><footer>&copy; no</footer></body></html>"""


def test_page_text():
    assert html_text.main_text(PAGE) == "The & title One bo\u200bld <tag> é line Two link x y".replace("\u200b", "")
    assert html_text.main_text("<article><p>cut o&amp;ff <b>here</b> <a hre") == "cut o&ff here"
    assert html_text.main_text("<main>a</main><script>x") == "a"
    assert html_text.main_text("<article>1 < 2 <!-- open") == "1 < 2"


def test_blocks_without_an_article():
    text = "This is the text of a page that has no article, and it is long enough to be told from the menus. " * 3
    page = f"<div><a href=1>Home</a> <a href=2>News</a></div><h2>Title</h2><p>{text}</p><p>Short one.</p><p>{text}</p><div>&copy; 2020 X</div>"
    assert html_text.main_text(page) == " ".join(f"Title {text} Short one. {text}".split())
    assert html_text.second_pass([None, "text", None, None, "boilerplate", None]) == ["text", "text", "text", "boilerplate", "boilerplate", "boilerplate"]
    assert html_text.second_pass([None, None]) == ["text", "text"]


def test_pages_of_any_kind(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", PAGE), (2, "u", PAGE), (3, "u", "<article>" + "<p>long &amp; page</p>" * 20_000), (4, "u", "plain <<>> text & <x")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert len(got) == len(rows)
    assert [r["n_chars"] for r in got] == [len(r["text"]) for r in got]
    assert got[0]["text"] == got[1]["text"] == "" and got[2] == got[3]
    assert got[4]["n_chars"] == 20_000 * len("long & page ") - 1
    assert html_text.extract(pages.limit(0)).count() == 0


def test_encoder_gives_the_ids_of_tokenizers():
    from tokenizers import Tokenizer

    ours, theirs = packing.encoder(vocabulary()), Tokenizer.from_file(vocabulary())
    rng = random.Random(8)
    pool = [" ", "  ", "\n", "\t", "a", "B", "é", "中", "🙂", "'s", "'LL", "12", "!", "\u00a0", "\u2003", "<|endoftext|>", "the", "\x00", "²", "ﬁ", "e\u0301"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 14))) for _ in range(3000)] + ["a" * 50_000, "^ " * 20_000]
    for text in texts:
        assert ours.encode(text, allowed_special="all") == theirs.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 6))
def test_best_fit_equals_a_plain_search(lengths, open_bins):
    bins, offsets = packing.best_fit(lengths, 20, open_bins)
    waiting, made = [], 0  # open bins as (free, since, number), oldest first
    for length, number, offset in zip(lengths, bins, offsets):
        fitting = [b for b in waiting if b[0] >= length]
        if fitting:
            best = min(fitting, key=lambda b: b[0])
            waiting.remove(best)
        else:
            if len(waiting) == open_bins:
                waiting.remove(min(waiting, key=lambda b: b[0]))
            best = (20, made)
            made += 1
        assert (number, offset) == (best[1], 20 - best[0])
        if best[0] > length:
            waiting.append((best[0] - length, best[1]))


def test_packed_documents(spark, odd_docs, no_docs):
    size = 64
    rows = [(100 + i, "word " * n, "en", "s", 1, 1, 1) for i, n in enumerate([3, 63, 64, 127, 128, 300, 31, 32, 62])]
    docs = odd_docs.filter("doc_id <> 3 OR doc_id IS NULL").unionByName(spark.createDataFrame(rows, odd_docs.schema))
    got = packing.pack_documents(docs, vocabulary(), size, group_pieces=6).collect()
    encode = packing.encoder(vocabulary()).encode
    want = sorted(
        (str(r["doc_id"]), piece, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()))
        for r in docs.collect()
        for ids in [[*encode(r["text"] or "", allowed_special="all"), 0]]
        for piece, (start, length) in enumerate(packing.cuts(len(ids), size))
    )
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    assert packing.pack_documents(no_docs, vocabulary()).count() == 0


def test_packing_wastes_little_in_order_of_arrival():
    rng = random.Random(1)
    lengths = [rng.randint(1, 2047) for _ in range(packing.GROUP_PIECES)]
    bins, _ = packing.best_fit(lengths)
    assert (max(bins) + 1) * packing.SEQUENCE < 1.03 * sum(lengths)


def test_pieces_come_in_turn_and_the_fullest_bin_closes(spark):
    """Each group is packed online: as a plain search packs it in order of its serials."""
    rng = random.Random(5)
    rows = [(i, 0, 0, rng.randint(1, 19), 0, 1000 + i) for i in range(300)] + [(900, 0, 0, 20, 0, 7)]
    pieces = spark.createDataFrame(rows, packing.PIECES).repartition(3)
    got = packing.pack(pieces, size=20, open_bins=4, group_pieces=300).collect()
    place = {r["doc_id"]: (r["sequence_id"], r["offset"]) for r in got}
    bins, offsets = packing.best_fit([r[3] for r in rows[:300]], 20, 4)
    assert [place[i] for i in range(300)] == list(zip(bins, offsets)) and place[900][1] == 0
    assert len(got) == 301


def test_a_very_long_text_is_cut_and_packed(spark, odd_docs):
    long = odd_docs.filter("doc_id = 3")
    ids = [*packing.encoder(vocabulary()).encode(long.first()["text"], allowed_special="all"), 0]
    got = sorted((r["piece"], r["start"], r["length"]) for r in packing.pack_documents(long, vocabulary()).collect())
    assert got == [(i, start, length) for i, (start, length) in enumerate(packing.cuts(len(ids)))] and len(got) > 40
