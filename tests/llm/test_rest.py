"""Search, URLs, packing, chats, pages, mixing, language model and pipeline on small tables."""

import hashlib
import json
import math
import random
import time
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from html.parser import HTMLParser
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorewell.llm import chat_format, html_extract, language_model, mixing, packing, quality_rules, registry, top_k, url_filters
from lorewell.llm.common import likely_in, without


# ------------------------------------------------------------------------ search


def brute_top(rows, k, step):
    best = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(64 * float(np.float32(x))) for x in v]
        best[i] = min(best.get(i, w), w)
    out = []
    for q, v in best.items():
        if q % step == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in best.items() if i != q and len(w) == len(v))[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [10_000, 60])
def test_top_k(spark, shard_rows):
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.normal(size=6).round(1)]) for k in range(200)]
    rows += [(k, rows[3][1]) for k in range(200, 260)]  # a common vector
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [math.nan] * 6), (304, [math.inf] * 6), (305, [1.0, 2.0]), (None, rows[0][1]), (0, [9.0] * 6), (306, [3e30] * 6), (310, [1e20] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k.top_k(frame.withColumn("score", F.lit(1)), F.col("vec_id") % 5 == 0, k=7, shard_rows=shard_rows, block_queries=20)
    want = [(q, r, i, max(-(2**63) + 2, min(2**63 - 1, s))) for q, r, i, s in brute_top(rows, 7, 5)]
    plain = lambda rows: [x for x in rows if abs(x[3]) < 2**62]  # noqa: E731  clamped scores tie
    assert plain(sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())) == plain(want)


def test_bounds_leave_branches_out():
    """Clusters far apart: most scores aren't computed, and the best are found; a tree that was stored is the same."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8)) * 300
    x = np.floor(np.repeat(centres, 100, 0) + rng.normal(size=(4000, 8)) * 3)
    ids = rng.permutation(4000).astype(np.int64)
    tree = top_k.BallTree.load(top_k.BallTree(x, ids).dump())
    for node in range(len(tree.low)):
        rows = tree.x[tree.low[node] : tree.high[node]]
        assert (np.sqrt(((rows - tree.centre[node]) ** 2).sum(1)) <= tree.radius[node] + 1e-9).all()
    at = np.argsort(tree.ids)[::20]
    scores, found, computed = top_k.search(tree.x[at], tree.ids[at], np.full(len(at), top_k.NONE), tree, 5)
    every = tree.x[at] @ tree.x.T
    every[np.arange(len(at)), at] = -np.inf
    assert (scores == -np.sort(-every, 1)[:, :5]).all()
    assert computed < 0.25 * every.size


def test_top_k_of_little(spark):
    frame = spark.createDataFrame([(0, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert top_k.top_k(frame, F.col("vec_id") % 5 == 0).count() == 0
    assert top_k.top_k(frame.limit(0), F.col("vec_id") % 5 == 0).count() == 0


# -------------------------------------------------------------------------- URLs


def brute_url(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([len(rest), *(rest.index(c) for c in "/?#" if c in rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if url is not None and "://" in url and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else default


@pytest.mark.parametrize("bound", [1000, 1])
def test_url_filter(spark, bound):
    rng = random.Random(2)
    rules = [*registry.URL_RULES, ("a.net", "", "allow"), ("b.net", "/x", "block"), ("b.net", "/x", "allow")]
    urls = [None, "", "net/", "http://", "http://net", "http://NET/", "https://a.net?x=/", "x://b.net/x1/y#z", "http://É.net/", "http://.net/", "http://a..net/", "u://u:p@example.net:80/en/", "http://xexample.net/en/", "http://a\nb.net/\n?"]
    urls += [f"http://{rng.choice(['', 'm.', 'a.b.'])}{rng.choice(['example.net', 'example.com', 'x.org', 'org', 'net', 'b.net'])}{rng.choice(['', '/', '/en/', '/de/1', '/fr/2?q', '/en', '/x#/en/'])}" for _ in range(80)]
    frame = spark.createDataFrame([(k, u, "old") for k, u in enumerate(urls + urls[:9])], "page_id long, url string, host string")
    got = url_filters.url_filter(frame, url_filters.rule_table(spark, rules), broadcast_rules=bound)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = got.collect()
    assert len(rows) == len(urls) + 9
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_url(r["url"], rules), r["url"]


def test_url_filter_without_rules(spark):
    frame = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert url_filters.url_filter(frame, url_filters.rule_table(spark, [])).first()["verdict"] == "allow"


# ------------------------------------------------------------------------ packing


def test_cut():
    assert packing.cut(5, 5) == [(0, 5)] and packing.cut(6, 5) == [(0, 1), (1, 5)] and packing.cut(10, 5) == [(0, 5), (5, 5)] and packing.cut(12, 5) == [(0, 2), (2, 5), (7, 5)]


def test_best_two_fit():
    rng = random.Random(3)
    for _ in range(60):
        size = rng.choice((10, 50, 300))
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 200))]
        bins = packing.best_two_fit(lengths, size)
        assert sorted(k for b in bins for k in b) == list(range(len(lengths)))
        assert all(sum(lengths[k] for k in b) <= size for b in bins)
        assert len(bins) <= 11 / 9 * math.ceil(sum(lengths) / size) + 4
    # Greedy alone fills 6 with 3 and leaves a gap of 1; two documents fill the expanded gap of 4.
    assert [sorted(map([6, 3, 2, 2].__getitem__, b)) for b in packing.best_two_fit([6, 3, 2, 2], 10)] == [[2, 2, 6], [3]]


def test_ids_are_those_of_the_file():
    """Random texts with special strings, odd blanks and characters beyond the first plane."""
    from tokenizers import Tokenizer

    model, encode = Tokenizer.from_file(registry.vocabulary()), packing.encoder(registry.vocabulary())
    assert encode("x <|endoftext|> y") == [87, 220, 50256, 331]
    rng = random.Random(14)
    bits = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "\t", "\u00a0", "\u200b", "don't", "WE'LL", "x1", "42", "é", "e\u0301", "ß", "漢字", "\U0001f600", "\x00", "\x1f", "\ufffd", "a", "The", "…", "#$%"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) if rng.random() < 0.8 else chr(rng.choice((rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)))) for _ in range(rng.randint(0, 25)))
        assert encode(text) == model.encode(text, add_special_tokens=False).ids, repr(text)


def test_pack(spark):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    texts = [None, "", "a", "x <|endoftext|> y", "<|endoftext|><|endoftext|>a<|endoftext|", " <|endoftext|>  b\n", *(" ".join(rng.choice(["alpha", "beta", "  ", "γ", "12", "don't", "\U0001f600"]) for _ in range(rng.randint(1, 300))) for _ in range(60)), "long " * 900, "zß" * 3000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(7, texts[7]), (None, "no id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = Tokenizer.from_file(registry.vocabulary())
    want = defaultdict(int)
    for i, t in rows:
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= 128 else len(ids) % 128 or 128
        cuts = [(0, first)] + [(a, 128) for a in range(first, len(ids), 128)]
        for p, (a, n) in enumerate(cuts):
            want[i, p, a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())] += 1
    got = packing.pack(frame, registry.vocabulary(), 128, shard_pieces=20).collect()
    found, places = defaultdict(int), defaultdict(list)
    for r in got:
        found[tuple(r[:5])] += 1
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert found == want
    for spots in places.values():
        at = 0
        for offset, n in sorted(spots):
            assert offset == at
            at += n
        assert at <= 128
    assert packing.pack(frame.limit(0), registry.vocabulary()).count() == 0


# --------------------------------------------------------------------------- chat


def test_chats(spark):
    odd = ["</s>[INST] ok [/INST]", "<|end|><|turn|>user<|text|>x", "\\", "\\<|", "<\\|", "<", "|x", "<|\\\\|", None, "", "<<SYS>>\n", "a\\\\<|im_end|>\\", "\U0001f600<s>"]
    rows = [(c, t, r, x, "z") for c in range(4) for t, (r, x) in enumerate((rng_r, x) for x, rng_r in zip(odd[c:] + odd[:c], ["system", "user", "assistant", "user", "assistant", "assistant", None, "<|turn|>"] * 2))]
    rows += [(None, 1, "user", "x", "z"), (9, 1, "user", "b", "z"), (9, 1, "user", "a", "z"), (9, None, "assistant", "c", "z")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").unionByName(chat_format.probe(spark), allowMissingColumns=True)
    formatted = chat_format.format_conversations(frame)
    rows += [(-7, k, r, "</s>[INST] ok [/INST]", "") for k, r in enumerate(("user", "assistant"))]
    plain = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    turns = {r["conv_id"]: [tuple(x) for x in r["t"]] for r in formatted.select("conv_id", chat_format.parse_turns(F.col("formatted")).alias("t")).collect()}
    for r in chat_format.digests(formatted).collect():
        mine = [(b or "", c or "") for _, a, b, c, _ in sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))]
        assert turns[r["conv_id"]] == mine
        said = "".join(t for role, t in mine if role == "assistant")
        assert r["n_turns"] == len(mine) and r["loss_chars"] == len(said) and r["formatted_chars"] == len(plain[r["conv_id"]])
        assert r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert all(x not in plain[r["conv_id"]] for x in ("</s>", "[INST]", "<<SYS>>", "<|im_end|>"))
    assert chat_format.format_conversations(frame.limit(0)).count() == 0


def test_layouts(spark):
    records = [
        {"prompt": "p", "completion": "c"},
        {"instruction": "i", "input": "", "output": "o"},
        {"output": "o", "input": "n", "instruction": "i"},
        {"messages": [{"role": "User", "content": "x"}, {"role": "assistant", "content": "y"}]},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"strange": 1},
        "not json",
    ]
    frame = spark.createDataFrame([(k, r if isinstance(r, str) else json.dumps(r)) for k, r in enumerate(records)], "k int, record string")
    got = {r["k"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in chat_format.json_turns(frame).collect()}
    assert got == {0: [("user", "p"), ("assistant", "c")], 1: [("user", "i"), ("assistant", "o")], 2: [("user", "i\n\nn"), ("assistant", "o")], 3: [("user", "x"), ("assistant", "y")], 4: [("user", "h"), ("assistant", "g")], 5: None, 6: None}
    typed = spark.createDataFrame([(1, "q", "a")], "conv_id long, question string, answer string")
    assert [tuple(t) for t in chat_format.table_turns(typed).first()["turns"]] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat_format.table_turns(spark.range(1))


def test_layouts_with_fields_missing_or_more(spark):
    records = [
        {"id": 7, "prompt": "p", "completion": "c", "source": "s"},
        {"text": "beside", "PROMPT": "p", "prompt": "p", "completion": "c"},
        {"system": "s", "question": "q", "answer": None},
        {"messages": [{"role": "user"}, {"role": "assistant", "content": "y", "weight": 1}], "conv_id": 3},
        {"messages": []},
        {"messages": [{"role": "bot", "text": "t"}]},
        {"instruction": "i", "output": "o", "system": "s", "conv_id": 4, "prompt": "ignored"},
        {"prompt": "p"},
    ]
    frame = spark.createDataFrame([(k, json.dumps(r), "old") for k, r in enumerate(records)], "k int, record string, layout string")
    got = {r["k"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in chat_format.json_turns(frame).collect()}
    assert got == {
        0: [("user", "p"), ("assistant", "c")],
        1: [("user", "p"), ("assistant", "c")],
        2: [("system", "s"), ("user", "q"), ("assistant", "")],
        3: [("user", ""), ("assistant", "y")],
        4: [],
        5: [("assistant", "t")],
        6: [("system", "s"), ("user", "i"), ("assistant", "o")],
        7: None,
    }


def test_tables_that_unite_layouts(spark):
    """Every row takes its own mapping, nulls and all."""
    said = "array<struct<role:string,content:string>>"
    rows = [
        (1, 1, "user", "a", None, None, None), (1, 2, "assistant", None, None, None, None), (1, None, None, None, None, None, None), (None, None, None, None, None, None, None),
        (2, None, None, None, [("user", "x"), ("assistant", None), ("assistant", "y")], None, None), (2, None, None, None, [("user", "x")], None, None), (3, None, None, None, [], None, None),
        (4, None, None, None, None, "p", "c"), (5, None, None, None, None, "p", None), (6, None, None, None, None, None, "c"),
    ]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, messages {said}, prompt string, completion string")
    got = sorted((r["conv_id"] or 0, [tuple(t) for t in r["turns"]]) for r in chat_format.table_turns(frame).collect())
    assert got == [
        (0, [("", "")]), (1, [("", ""), ("user", "a"), ("assistant", "")]), (2, [("user", "x")]), (2, [("user", "x"), ("assistant", ""), ("assistant", "y")]), (3, []),
        (4, [("user", "p"), ("assistant", "c")]), (5, [("user", "p"), ("assistant", "")]), (6, [("user", ""), ("assistant", "c")]),
    ]
    read = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_conversations(frame.filter("conv_id <> 2 or size(messages) > 1"))).collect()}
    assert read[2]["loss_chars"] == 1 and read[3]["n_turns"] == 0 and read[3]["formatted_chars"] == 0 and read[1]["n_turns"] == 3
    # The hash of a row's own paths picks its mapping.
    layouts = {r["conv_id"]: r["layout"] for r in chat_format.turn_rows(frame).collect()}
    assert layouts[4] == chat_format.fingerprint(["conv_id", "prompt", "completion"]) and layouts[3] == chat_format.fingerprint(["conv_id", "messages"])


def test_a_long_conversation(spark):
    """The work is linear in the number of turns."""
    turns = spark.range(60_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("\U0001f600é "), F.col("id").cast("string")).alias("text"))
    began = time.time()
    row = chat_format.digests(chat_format.format_conversations(turns)).first()
    assert time.time() - began < 60
    said = "".join(f"\U0001f600é {k}" for k in range(1, 60_000, 2))
    assert row["n_turns"] == 60_000 and row["loss_chars"] == len(said) and row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


# -------------------------------------------------------------------------- pages


def test_made_pages_of_another_seed():
    model = html_extract.default_model()
    right = 0
    pages = html_extract.labelled_pages(120, seed=123)
    for source, labels in pages:
        page = html_extract.Page(source)
        right += html_extract.main_texts([source], model)[0] == "\n".join(page.blocks([bool(x) for x in labels]))
    assert right >= 0.9 * len(pages)


#: Pages written by hand, with their main texts.
BY_HAND = {
    "blog": (
        """<html><head><title>Ferry notes</title><link rel=stylesheet href=a.css></head><body class="single post-template">
<header class="site-header"><a href="/">Ferry notes</a><p>Notes from small boats</p></header>
<nav class="main-navigation"><ul><li><a href="/about">About</a></li><li><a href="/archive">Archive</a></li></ul></nav>
<div id="page"><div id="primary"><main id="main"><article class="post hentry">
<h1 class="entry-title">Crossing at dawn</h1>
<div class="entry-content"><p>The first boat leaves before the light does, and the pier smells of rope and diesel.</p>
<p>By the time the far shore shows, the crew has finished its coffee &mdash; <em>twice</em>.</p>
<ul><li>Bring a warm coat for the deck.</li><li>Sit on the left side of the boat.</li></ul></div></article>
<div id="comments" class="comments-area"><h2>Two replies</h2><ol class="comment-list"><li class="comment"><p>I took this boat last year and liked it very much.</p></li></ol></div></main></div>
<aside class="widget-area sidebar"><h3>Recent posts</h3><ul><li><a href="/1">Fog on the river</a></li><li><a href="/2">The old lock</a></li></ul></aside></div>
<footer class="site-footer"><p>&copy; Ferry notes. All rights reserved.</p></footer></body></html>""",
        "Crossing at dawn\nThe first boat leaves before the light does, and the pier smells of rope and diesel.\nBy the time the far shore shows, the crew has finished its coffee — twice.\nBring a warm coat for the deck.\nSit on the left side of the boat.",
    ),
    "no head end, formulas and media": (
        """<!doctype html><head><title>Pendulum</title><meta name=x content=y>
<nav><a href="/a">Home</a> <a href="/b">Physics</a></nav>
<article><h1>The pendulum</h1><p>Its period is <math><mi>T</mi><mo>=</mo><mn>2</mn><mi>&pi;</mi></math> times the root of the length over gravity, for small swings.
<p>A film shows it: <video src=p.mp4>a bob on a string swings to and fro</video> for a minute or so.
<object data=d.pdf>The measured lengths and periods are in the table that comes with the film.</object>
<button type=button>Play the film again
</article><footer>Copyright by the school</footer>""",
        "The pendulum\nIts period is T=2π times the root of the length over gravity, for small swings.\nA film shows it: a bob on a string swings to and fro for a minute or so. The measured lengths and periods are in the table that comes with the film.",
    ),
    "newspaper": (
        """<html lang=en><body><div class="masthead"><h2>The Harbour Post</h2></div><div class="cookie-consent"><p>We use cookies to improve the paper. Accept all cookies or manage settings.</p><button>Accept</button></div>
<div class="wrapper"><div class="story-body"><h1>Bridge opens after long repairs</h1><p class="lead">The old swing bridge opened to traffic on Monday after eleven months of repairs.</p>
<div class="advertisement"><p>Buy new tyres today and save on the second pair.</p></div>
<p>Engineers replaced the bearings and most of the deck, and the paint will follow in spring.</p>
<blockquote><p>We have waited for this day since last winter, said the bridge keeper.</p></blockquote></div>
<div class="related"><h3>More on this</h3><ul><li><a href="/x">Ferry fares rise</a></li><li><a href="/y">Harbour plan</a></li></ul></div></div>
<form action="/newsletter" class="newsletter"><label>Your address</label><input name=e><p>Subscribe to our newsletter.</p></form>
<div class="footer">Terms <a href="/t">Privacy</a></div></body></html>""",
        "Bridge opens after long repairs\nThe old swing bridge opened to traffic on Monday after eleven months of repairs.\nEngineers replaced the bearings and most of the deck, and the paint will follow in spring.\nWe have waited for this day since last winter, said the bridge keeper.",
    ),
    "manual": (
        """<html><body><div class="sidebar toc"><ul><li><a href="#a">Install</a><li><a href="#b">Use</a><li><a href="#c">Limits</a></ul></div>
<main role="main"><section class="content"><h1>Using the tool</h1><p>Run the tool in the folder that holds the project, and give it the name of a target.</p><pre>tool build   all</pre>
<h2>Limits</h2><table><tr><td>files</td><td>one million</td></tr><tr><td>depth</td><td>forty folders</td></tr></table><p>Deeper trees are read too, but not watched for changes.</p></section></main>
<div class="pagination"><a href="/p">Previous</a> <a href="/n">Next</a></div></body></html>""",
        "Using the tool\nRun the tool in the folder that holds the project, and give it the name of a target.\ntool build all\nLimits\nfiles\none million\ndepth\nforty folders\nDeeper trees are read too, but not watched for changes.",
    ),
}


@pytest.fixture(scope="module")
def page_model():
    return html_extract.default_model()


@pytest.mark.parametrize("name", BY_HAND)
def test_pages_by_hand(page_model, name):
    source, want = BY_HAND[name]
    assert html_extract.main_texts([source], page_model) == [want]


class Article(HTMLParser):
    """The blocks of a page's article, read plainly."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [[]]
        self.feed(source)
        self.close()
        self.text = "\n".join(t for t in (" ".join("".join(b).split()) for b in self.blocks) if t)

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag == "br":
            self.blocks[-1].append(" " * (self.inside > 0))
        elif tag not in ("a", "b", "i", "em", "span"):
            self.blocks.append([])

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag not in ("a", "b", "i", "em", "span"):
            self.blocks.append([])

    def handle_data(self, data):
        self.blocks[-1].append(data if self.inside else "")


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no tables here")
def test_given_pages_against_a_plain_reading(spark):
    """All of these pages have an article and nothing in it that doesn't belong."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in registry.op5_html_extraction(spark, "/root/testdata/sf0.001").collect()}
    assert got == {k: Article(source or "").text for k, source in pages.items()}


def test_dropped_elements_end_with_what_is_around_them():
    texts = lambda source: html_extract.Page(source).blocks([True] * 99)
    assert texts("<head><title>t</title><p>a<p>b") == ["a", "b"] and texts("<head>a<p>b") == ["a", "b"]
    assert texts("<div><button>x</div><p>a") == ["a"] and texts("<div><select><option>x</div>a") == ["a"]
    assert texts("<p>a<button>x<b>y</b></button>b") == ["ab"] and texts("<select><option>x<input>a") == ["a"]
    assert texts("<p>a <svg><title>i</title><text>s</text></svg> b<xmp><i>c</i></xmp>d") == ["a s b", "<i>c</i>", "d"]
    assert texts("<x-box>a<x-y>b</x-y></x-box><p>c") == ["ab", "c"]


def test_messages_are_exact():
    page = html_extract.Page("<body><div class=x><p>a b</p><p>c<a href=1>d</a></p></div><nav><ul><li>e</ul></nav>")
    rng = np.random.default_rng(5)
    forest = html_extract.Forest([page, page])
    n = len(page.parents)
    unary, edge = rng.normal(size=2 * n), rng.normal(size=6)
    got, _ = forest.messages(unary, edge)
    e = edge.reshape(2, 3)
    total, on = 0.0, np.zeros(n)
    for bits in range(1 << n):
        y = [bits >> k & 1 for k in range(n)]
        s = sum(unary[k] * y[k] for k in range(n))
        for k in range(1, n):
            s += {(0, 0): 0.0, (0, 1): e[forest.kind[k]][0], (1, 0): e[forest.kind[k]][1], (1, 1): e[forest.kind[k]][2]}[y[page.parents[k]], y[k]]
        w = math.exp(s)
        total += w
        on += w * np.array(y)
    assert np.allclose(got[:n], on / total)


def test_extraction_of_odd_rows(spark):
    """Clashing columns, repeated rows, null ids, a very long block."""
    long = "<article><h1>Long</h1><p>" + "many words in one block and " * 20_000 + "&amp; an end.</p></article><footer>copyright</footer>"
    rows = [(1, None, long, "x", 5), (1, None, long, "x", 5), (None, "u", "<article><p>Some words of an article that has no id.</p></article>", "y", 6)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    texts = sorted(r["text"] for r in got.collect())
    assert texts == ["Long\n" + "many words in one block and " * 20_000 + "& an end."] * 2 + ["Some words of an article that has no id."]
    assert html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").limit(0)).count() == 0


def test_extraction(spark):
    article = "<article><h1>A title &amp; more</h1><p><b>First words of a page here.<br><p>Second&nbsp;paragraph   with\n many &lt;odd&gt; words in it, <i>and</i> so on.</p></article>"
    source = f"<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/x>News</a></li></ul></nav><!-- ad --><div class='ad'>Buy this now please.</div>{article}<div class=comments><p>What a nice page it is.</p></div><footer>&copy; someone</footer>"
    rows = [(1, "u", source), (2, None, None), (3, "u", ""), (4, "u", "<"), (5, "u", "<p"), (6, "u", "<a title='x>y'>" * 50), (7, "u", "<div>" * 3000), (None, "u", "</div></p>")]
    got = {r["page_id"]: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1]["text"] == "A title & more\nFirst words of a page here.\nSecond paragraph with many <odd> words in it, and so on."
    assert got[2]["text"] == got[3]["text"] == "" and all(r["n_chars"] == len(r["text"]) for r in got.values()) and len(got) == 8


# ------------------------------------------------------------------------- mixing


def test_schedule():
    rng = random.Random(6)
    for _ in range(100):
        parts = [rng.randint(1, 12) for _ in range(rng.randint(1, 12))]
        done = [0] * len(parts)
        for slot, s in enumerate(mixing.period(parts), 1):
            done[s] += 1
            assert all(abs(n * sum(parts) - w * slot) < sum(parts) for n, w in zip(done, parts))
        blocks = [rng.randint(0, 40) for _ in parts]
        seen = {}
        for p in mixing.phases(parts, blocks):
            for j in range(p["n_blocks"]):
                seen[p["slot"] + j // p["quota"] * p["total"] + p["at"][j % p["quota"]]] = (p["source"], p["from_block"] + j)
        assert sorted(seen) == list(range(sum(blocks))) and sorted(seen.values()) == [(s, j) for s, n in enumerate(blocks) for j in range(n)]


def test_mix(spark):
    rng = random.Random(7)
    rows = [(k, rng.choice(["big"] * 6 + ["b", "c", None]), f"t{k % 50}", k) for k in range(500)] + [(1, "big", "t1", 1)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, slot long")
    got = mixing.mix(frame, {"big": 3}, block=8).collect()
    assert sorted((r["doc_id"], r["source"] or "") for r in got) == sorted((r[0], r[1] or "") for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["slot"]].append(r)
    assert sorted(slots) == list(range(len(slots)))
    for s in slots.values():
        assert len({(r["source"], r["block"]) for r in s}) == 1 and sorted(r["place"] for r in s) == list(range(len(s)))
    owner = [slots[k][0]["source"] for k in range(len(slots))]
    last = {s: max(k for k, x in enumerate(owner) if x == s) for s in set(owner)}
    for k in range(1, min(last.values())):
        assert abs(owner[:k].count("big") - k * 3 / 6) < 1
    ordered = mixing.mixed_order(frame, {"big": 3})
    assert ordered.columns == frame.columns and ordered.count() == len(rows)
    assert mixing.mix(frame.limit(0), {}).count() == 0


def test_mix_of_many_sources(spark):
    """Beyond SOURCES sources, named ones keep their parts and every one its share."""
    rng = random.Random(11)
    count = {f"s{k}": 1 + (k % 7 == 0) * rng.randint(0, 9) + (k % 100 == 0) * 20 for k in range(1500)} | {"src0": 3000, "src1": 900, None: 5}
    rows = [(k, s, f"t{k}") for k, s in enumerate(s for s, n in count.items() for _ in range(n))]
    parts = {"src0": 500, "src1": 250, "absent": 9}
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), parts, block=2).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(rows)))
    blocks = {(r["slot"], r["source"], r["block"]) for r in got}
    owner = [s for _, s, _ in sorted(blocks, key=lambda b: b[0])]
    assert sorted(b[0] for b in blocks) == list(range(len(owner))) and len(owner) == sum(-(-n // 2) for n in count.values())
    # Deviations of named sources, from the start and again from where sources of one block have run out.
    unnamed = [(s, b) for _, s, b in sorted(blocks, key=lambda b: b[0]) if s not in parts]
    assert [b for _, b in unnamed] == sorted(b for _, b in unnamed)
    first, second = (sum(-(-n // 2) > b for s, n in count.items() if s not in parts) for b in (0, 1))
    begin = max(k for k, s in enumerate(owner) if s == unnamed[first - 1][0]) + 1
    for start, live, slots in ((0, first, 750 + first), (begin, second, (750 + second) * 7 // 10)):
        for k in range(1, slots + 1):
            seen = owner[start : start + k]
            assert all(abs(seen.count(s) - k * w / (750 + live)) < 1 for s, w in (("src0", 500), ("src1", 250)))


# ------------------------------------------------------------------ language model


def kneser_ney(texts, order, asked):
    """Interpolated modified Kneser-Ney by plain dictionaries."""
    tables = [defaultdict(int) for _ in range(order)]
    for t in texts:
        t = language_model.BEGIN * (order - 1) + t + language_model.END
        for k in range(len(t) - order + 1):
            tables[-1][t[k : k + order]] += 1
    for k in range(order - 2, -1, -1):
        for g in tables[k + 1]:
            tables[k][g[1:]] += 1

    def p(g):
        table = tables[len(g) - 1]
        counts = [sum(1 for n in table.values() if n == j) for j in (1, 2, 3, 4)]
        d = language_model.discounts(*counts)
        cut = lambda n: d[min(n, 3) - 1]
        near = {x: n for x, n in table.items() if x[:-1] == g[:-1]}
        shorter = p(g[1:]) if len(g) > 1 else 1 / (len(table) + 1)
        if not near:
            return shorter
        own = near.get(g, 0)
        return ((own - cut(own) if own else 0) + sum(map(cut, near.values())) * shorter) / sum(near.values())

    return {g: p(g) for g in asked}


def test_kneser_ney(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcab ") for _ in range(rng.randint(0, 60))) for _ in range(20)] + [None]
    tables = language_model.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    asked = ["abca", "zzzz", "\x02\x02\x02a", "b ab", "ab z", "bbbb", "\x02\x02\x02\x03", "c\U0001f600a", "\uffff\uffff\uffff\uffff"]
    wanted = spark.createDataFrame([(language_model.packed(g),) for g in asked], "gram long")
    got = {r["gram"]: r["p"] for r in language_model.probabilities(tables, wanted).collect()}
    units = lambda g: "".join(map(chr, np.frombuffer(g.encode("utf-16-le"), "<u2").tolist()))
    want = kneser_ney([t or "" for t in texts], language_model.ORDER, [units(g) for g in asked])
    assert len(got) == len(want) and all(abs(got[language_model.packed(g)] - want[units(g)]) < 1e-12 for g in asked)
    # Over all symbols the probabilities of a context sum to one, but for the unseen one.
    symbols = sorted({c for t in texts for c in t or ""} | {language_model.END, "\x02", "#"})
    assert abs(sum(kneser_ney([t or "" for t in texts], language_model.ORDER, ["abc" + c for c in symbols]).values()) - 1) < 0.2


def test_order_of_the_model(spark):
    """The model looks at five units: the fourth before a symbol changes its probability."""
    assert language_model.ORDER == 5
    texts = ["abcdx" * 9, "zbcdy" * 9, "a\U0001f600cx", "", None]
    tables = language_model.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    asked = ["abcdx", "zbcdx", "abcdy", "zbcdy", "\x02\x02\x02\x02a", "qqqqq", "\uffff\uffff\uffff\uffff\uffff", "a\ud83d\ude00cx"]
    wanted = spark.createDataFrame([(ord(g[0]), language_model.packed(g[1:])) for g in asked], "head int, gram long")
    got = {(r["head"], r["gram"]): r["p"] for r in language_model.probabilities(tables, wanted).collect()}
    units = lambda t: "".join(map(chr, np.frombuffer(t.encode("utf-16-le"), "<u2").tolist()))
    want = kneser_ney([units(t or "") for t in texts], 5, asked)
    assert len(got) == len(asked) and all(abs(got[ord(g[0]), language_model.packed(g[1:])] - want[g]) < 1e-12 for g in asked)
    assert want["abcdx"] > 2 * want["zbcdx"] and want["zbcdy"] > 2 * want["abcdy"]


def test_limit(spark):
    """The limit is the quantile itself, and it isn't loose."""
    rows = [("en", k / 128) for k in range(1, 101)] + [("de", 5.0), ("de", 6.0)]
    got = {r["lang"]: r["limit"] for r in language_model.limits(spark.createDataFrame(rows, "lang string, log_perplexity double"), language_model.QUANTILE).collect()}
    assert got["en"] == math.ceil(97 / 128 * 1000) / 1000 and got["de"] == 6.0 and got[None] == math.ceil(99 / 128 * 1000) / 1000


def test_quality_model(spark, tmp_path):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 7))) for _ in range(80)]
    good = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 120))) for _ in range(120)]
    bad = ["".join(rng.choice("#$%&XQZ!|") for _ in range(200)) for _ in range(20)]
    rows = [(k, t, rng.choice(["en", "de", None]), "s") for k, t in enumerate(good + bad)] + [(200, None, "en", "s"), (201, "", "fr", "s"), (None, good[0], "en", "s")]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string").repartition(3).write.parquet(path)
    trusted = spark.createDataFrame([(k,) for k in range(100)] + [(None,), (9999,)], "doc_id long")
    for docs in (spark.read.parquet(path), spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")):
        got = language_model.quality_model(docs, trusted).collect()
        assert len(got) == len(rows)
        kept = {r["doc_id"]: r["kept"] for r in got}
        assert not any(kept[k] for k in range(120, 140)) and sum(kept[k] for k in range(120)) >= 114
    left = language_model.keep_fluent(spark.read.parquet(path), trusted)
    assert left.columns == ["doc_id", "text", "lang", "kept"] and left.count() == sum(r["kept"] or r["doc_id"] is None for r in got)
    none = language_model.quality_model(spark.read.parquet(path), trusted.limit(0))
    assert all(r["kept"] for r in none.collect())
    assert language_model.quality_model(spark.read.parquet(path).limit(0), trusted).count() == 0


# ------------------------------------------------------------------------- shared


def test_id_filters(spark):
    frame = spark.createDataFrame([(k if k % 7 else None, "x") for k in range(300)], "doc_id long, v string")
    ids = spark.createDataFrame([(k,) for k in range(0, 300, 3)] + [(None,)], "doc_id long")
    left = [r[0] for r in without(frame, "doc_id", ids).collect()]
    assert sorted(x for x in left if x is not None) == [k for k in range(300) if k % 7 and k % 3] and left.count(None) == 43
    assert {k for k in range(0, 300, 3) if k % 7} <= {r[0] for r in likely_in(frame, "doc_id", ids).collect()}


def test_mix_reaches_the_sequences(spark):
    """Without the mixing stage the first shards would have the sources' shares of the documents, two thirds."""
    import corpus_pipeline

    sources = {k: "src0" if k % 3 else "src1" for k in range(3840)}
    rows = [(k, f"{k} " + "some words " * (1 + k % 60) * (40 if k % 500 == 0 else 1), s) for k, s in sources.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = corpus_pipeline.mixed(spark, docs, "").cache()
    slot = {r["doc_id"]: (r["slot"], r["place"]) for r in mixed.collect()}
    got, plain = corpus_pipeline.packed(spark, mixed, "").collect(), corpus_pipeline.packed(spark, docs, "").collect()
    key = lambda r: tuple(r[:5])
    assert sorted(map(key, got)) == sorted(map(key, plain)) and {r["length"] for r in got} >= {packing.SEQUENCE}
    content = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sum(x["length"] for x in content[r["sequence_id"]])
        content[r["sequence_id"]].append(r)
    assert all(sum(x["length"] for x in c) <= packing.SEQUENCE for c in content.values())
    starts = [min((*slot[x["doc_id"]], x["piece"]) for x in content[k]) for k in sorted(content)]
    assert starts == sorted(starts)
    # Shards are ranges of slots: the early ones have src0 with ten parts of eleven.
    shards = sorted({k >> 40 for k in content})
    spans = [[slot[x["doc_id"]][0] for k, c in content.items() if k >> 40 == s for x in c] for s in shards]
    assert len(shards) > 2 and all(max(a) < min(b) for a, b in zip(spans, spans[1:]))
    early = {x["doc_id"] for k, c in content.items() if k >> 40 == shards[0] for x in c}
    assert abs(sum(sources[i] == "src0" for i in early) / len(early) - 10 / 11) < 1 / 12


def test_pipeline_against_its_stages(spark, tmp_path):
    """run() gives what plain versions of the stages leave, one after the other; only the classifier is its own."""
    from test_texts import brute, words_of
    from tokenizers import Tokenizer

    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near-dedup", "mixing", "packing"]
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = corpus_pipeline.run(spark, d).collect()
    zip_ = quality_rules.zstandard.ZstdCompressor(level=3)

    def ruled(t):
        w = words_of(t)
        tri = Counter(zip(w, w[1:], w[2:]))
        marks = {j for k, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for j in (k, k + 1, k + 2)}
        return len(w) >= 50 and 100 * len(marks) <= 50 * len(w) and quality_rules.bands((t or "").encode(), zip_)[3]

    left = {k for k, t in text.items() if ruled(t)}
    frame = docs.filter(F.col("doc_id").isin(list(left)))
    trusted = spark.read.parquet(f"{d}/labels.parquet").filter("quality = 1").select("doc_id")
    left = {r["doc_id"] for r in language_model.quality_model(frame, trusted).collect() if r["kept"]}
    component = brute([(k, text[k]) for k in sorted(left)])
    left = {k for k in left if component[k] == k}
    model = Tokenizer.from_file(registry.vocabulary())
    want = []
    for k in left:
        ids = [*model.encode(text[k] or "", add_special_tokens=False).ids, 0]
        want += [(k, p, a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())) for p, (a, n) in enumerate(packing.cut(len(ids), packing.SEQUENCE))]
    assert sorted(tuple(r[:5]) for r in rows) == sorted(want)
    # What lay between the stages is gone.
    empty = tmp_path / "empty"
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    trusted.withColumn("quality", F.lit(1)).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_mix_against_a_simulation(spark):
    """Each slot goes to the released block with the earliest deadline; when a source runs out, the others start anew."""
    rng = random.Random(21)
    for parts in ({"a": 5, "b": 2}, {"a": 3, "b": 3, "c": 7}, {}):
        sizes = {s: rng.randint(1, 60) for s in ("a", "b", "c", "d")} | {None: 9}
        rows = [(k, s, f"t{k}") for k, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
        got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), parts, block=2).collect()
        found = {r["slot"]: (r["source"], r["block"]) for r in got}
        left = {s: -(-n // 2) for s, n in sizes.items()}
        begun, done, want, start = dict.fromkeys(left, 0), dict.fromkeys(left, 0), {}, 0
        while any(left.values()):
            live = [s for s in left if left[s]]
            total = sum(parts.get(s, 1) for s in live)
            at = len(want) - start
            share = {s: Fraction(parts.get(s, 1), total) for s in live}
            ready = [s for s in live if done[s] / share[s] < at + 1 and math.floor(done[s] / share[s]) <= at]
            s = min(ready, key=lambda s: (math.ceil((done[s] + 1) / share[s]), s is None, s or ""))
            want[len(want)] = (s, begun[s] + done[s])
            done[s] += 1
            left[s] -= 1
            if not left[s]:
                begun = {x: begun[x] + done[x] for x in begun}
                done, start = dict.fromkeys(left, 0), len(want)
        assert found == want


def test_mix_refuses_what_is_too_large(spark):
    frame = spark.createDataFrame([(k, f"s{k % 3}", "t") for k in range(60)], "doc_id long, source string, text string")
    for parts in ({"s0": 0}, {"s0": mixing.PARTS}):
        with pytest.raises(ValueError):
            mixing.mix(frame, parts)
    with pytest.raises(ValueError):
        mixing.phases([1_000_003, 999_983], [10**9, 10**9]) and mixing.phases([3_000_017, 2_999_999], [10**9, 10**9])


def test_url_filter_of_a_long_host(spark):
    host = ".".join(["a"] * 30_000) + ".b.net"
    frame = spark.createDataFrame([(1, f"http://{host}/x1"), (2, f"http://x{host}/")], "page_id long, url string")
    rules = url_filters.rule_table(spark, [("b.net", "/x", "block"), ("a.b.net", "/", "allow"), (host, "/x1", "block")])
    assert {r["page_id"]: (r["verdict"], len(r["rule"] or "")) for r in url_filters.url_filter(frame, rules).collect()} == {1: ("block", len(host) + 3), 2: ("allow", 8)}
