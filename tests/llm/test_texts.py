"""Quality rules, near-dedup and toxicity on small tables."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from lorewell.llm import near_dedup, quality_rules, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t ", "one", "a b c d", "a b c d e", "é\u00a0ü x\x0by\x0cz", "x " * 3000, "w" * 200_000, "a\na\n\na\nb\n b", "#*$%&|<> ok", "\U0001f600 " * 60]


def words_of(text):
    return WORD.findall(text or "")


def made(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(k if ids is None else ids[k], t, "x", 1.0) for k, t in enumerate(texts)], "doc_id long, text string, mark string, kept double")


def test_quality_counts(spark):
    rng = random.Random(3)
    phrase = made(rng, 40)
    texts = [*ODD, *(made(rng, rng.randint(1, 400)) for _ in range(20)), phrase + " " + made(rng, 200) + " " + phrase, (phrase + "\n") * 4]
    for r in quality_rules.quality_rules(docs(spark, texts)).collect():
        t = texts[r["doc_id"]] or ""
        w = words_of(t)
        tri = Counter(zip(w, w[1:], w[2:]))
        marks = {j for k, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for j in (k, k + 1, k + 2)}
        lines, seen = 0, set()
        for line in t.split("\n"):
            if words_of(line):
                lines += line in seen
                seen.add(line)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), lines, len(marks))
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(marks) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_compression_bands(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    clean = " ".join(rng.choice(vocabulary[: rng.choice((60, 2000))]) for _ in range(900))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-"
    noise = " ".join("".join(rng.choice(letters) for _ in range(40)) for _ in range(150))
    loop = " ".join(f"{k} {made(rng, 1)} the very same row of a long table" for k in range(700))
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs(spark, [clean, noise, loop])).collect()}
    assert got == {0: True, 1: False, 2: False}
    kept = quality_rules.keep_rules(docs(spark, [clean, noise, loop, None]))
    assert kept.columns == ["doc_id", "text", "mark", "kept"] and 0 in {r[0] for r in kept.collect()}


def test_verdicts_against_a_plain_version(spark):
    """Every byte counts: noise at the end, in the middle, in tails of any length; nulls, repeated rows and null ids."""
    rng = random.Random(13)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-"
    noise = lambda n: " ".join("".join(rng.choice(letters) for _ in range(30)) for _ in range(n // 31 + 1))[:n]
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n // 4))[:n]
    same = lambda n: ("the very same row " * n)[:n]
    texts = [None, *ODD, noise(6000)]
    for n in (300, 3000, 4096, 4097, 4351, 4352, 5000, 8191, 8192, 9000, 30_000, 100_000):
        texts += [prose(n), prose(n - n // 4) + noise(n // 4), prose(n // 2) + same(n // 4) + prose(n // 4), prose(n - min(n // 2, 900)) + noise(min(n // 2, 900))]
    texts += [prose(100_000) + noise(24_000), prose(100_000) + noise(5_000), prose(4096) + same(4000)]
    zip_ = quality_rules.zstandard.ZstdCompressor(level=3)

    def fits(raw):
        low, high = [x[1:] for x in quality_rules.BANDS if len(raw) < x[0]][0]
        return low <= len(raw) / len(zip_.compress(raw)) <= high

    def plain(text):
        raw = (text or "").encode()
        if not raw or not fits(raw):
            return False
        whole, rest = divmod(len(raw), 4096)
        parts = [raw[4096 * k : 4096 * k + 4096] for k in range(whole)] + ([raw[4096 * whole :]] if rest else [])
        if len(parts) > 1 and len(parts[-1]) < 256:
            parts[-2:] = [parts[-2] + parts[-1]]
        assert b"".join(parts) == raw
        return sum(len(p) for p in parts if not fits(p)) <= 0.1 * len(raw)

    rows = quality_rules.quality_rules(docs(spark, [*texts, texts[20], texts[20]], [*range(len(texts)), 20, None])).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        assert r["kept"] == (not r["base_failed"] and plain(texts[20 if r["doc_id"] is None else r["doc_id"]]))
    verdicts = {r["doc_id"]: r["kept"] for r in rows}
    end = len(texts)
    assert [verdicts[k] for k in (end - 3, end - 2, end - 1)] == [False, True, False] and 5 < sum(verdicts.values()) < end - 10


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words_of(text)]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    label = {i: i for i, _ in sets}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 75 * len(sets[a][1] | sets[b][1]):
                x, y = sorted((root(sets[a][0]), root(sets[b][0])))
                label[y] = x
    return {i: root(i) for i in label}


@pytest.fixture(scope="module")
def copies():
    """Chains of edits, exact copies, pairs on both sides of the limit, a passage that many share."""
    rng = random.Random(5)
    texts = list(ODD)
    shared = made(rng, 60)
    for _ in range(12):
        base = made(rng, rng.randint(60, 260)).split()
        for _ in range(rng.randint(2, 9)):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randint(0, 7)):
                base[rng.randrange(len(base))] = made(rng, 1)
    texts += [f"{made(rng, 70)} {shared} {made(rng, 10)}" for _ in range(30)]
    texts += [shared.upper(), shared, shared]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_near_dedup(spark, copies):
    got = near_dedup.near_dedup(docs(spark, [t for _, t in copies]))
    want = brute(copies)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert {k: r["component_id"] for k, r in rows.items()} == want
    assert all(r["n_shingles"] == len(shingles(copies[k][1])) for k, r in rows.items())
    assert all(r["kept"] == (r["component_id"] == k) for k, r in rows.items())


def test_large_group_around_the_limit(spark, monkeypatch):
    """Several hundred copies of one text, most pairs below the limit: no link is lost, in many small cells too."""
    rng = random.Random(12)
    base = made(rng, 90).split()
    texts = []
    for _ in range(350):
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = made(rng, 1)
        texts.append(" ".join(copy))
    texts += [t for t in texts[:60]]
    want = brute(list(enumerate(texts)))
    assert 20 < len(set(want.values())) < 300
    for ask, answer in ((near_dedup.ASK_BYTES, near_dedup.ANSWER_BYTES), (20_000, 30_000)):
        monkeypatch.setattr(near_dedup, "ASK_BYTES", ask)
        monkeypatch.setattr(near_dedup, "ANSWER_BYTES", answer)
        got = near_dedup.near_dedup(docs(spark, texts))
        assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


@pytest.mark.parametrize("stage", [False, True])
def test_rows_of_open_buckets(spark, monkeypatch, stage):
    """A row for a sub-key, node and smallest node, not one for each table; every bucket with several components is asked for."""
    rng = random.Random(21)
    base = made(rng, 90).split()
    texts = []
    for _ in range(300):
        copy = list(base)
        for _ in range(rng.randint(1, 8)):
            copy[rng.randrange(len(copy))] = made(rng, 1)
        texts.append(" ".join(copy))
    texts = list(dict.fromkeys(texts))
    write, ask, rows, groups = near_dedup.checkpointed, near_dedup._open_links, [], set()

    def written(df):
        out = write(df)
        rows.extend([out.count()] if {"a", "node"} <= set(out.columns) else [])
        return out

    def asked(found, sets):
        groups.update((r["a"], r["node"]) for r in found.collect())
        return ask(found, sets)

    monkeypatch.setattr(near_dedup, "checkpointed", written)
    monkeypatch.setattr(near_dedup, "_open_links", asked)
    want = brute(list(enumerate(texts)))
    if stage:
        assert {r["doc_id"] for r in corpus_pipeline.dedup(spark, docs(spark, texts), "").collect()} == set(want.values())
    else:
        assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(docs(spark, texts)).collect()} == want

    subs = near_dedup.sub_keys(near_dedup.minhashes(list(near_dedup.shingle_sets(near_dedup.pa.array(texts))))).tolist()
    tables = {}
    for k, sub in enumerate(subs):
        for x in sub[: near_dedup.COLLECTION]:
            for y in sub[near_dedup.COLLECTION :]:
                tables.setdefault((x, y), []).append(k)
    # Of tables with the same nodes one stands for all.
    buckets = {}
    for (x, _), nodes in tables.items():
        if len(nodes) > 2:
            buckets.setdefault(tuple(nodes), set()).add(x)
    assert max(rows) <= len({(x, k, nodes[0]) for nodes, xs in buckets.items() for x in xs for k in nodes}) < sum(map(len, buckets)) / 2
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for x, y in sorted({(k, hub) for hub, *others in tables.values() for k in others}):
        if 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
            label = [label[y] if c == label[x] else c for c in label]
    several = [(nodes, xs) for nodes, xs in buckets.items() if len({label[k] for k in nodes}) > 1]
    assert several and all(any(all((x, k) in groups for k in nodes) for x in xs) for nodes, xs in several)


def test_keep_first(spark, copies):
    texts = [t for _, t in copies]
    left = near_dedup.keep_first(docs(spark, texts + texts[:5], [*range(len(texts)), *range(5)]))
    want = {k for k, c in brute(copies).items() if k == c}
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(want)


def test_near_dedup_of_little(spark):
    assert near_dedup.near_dedup(docs(spark, [])).count() == 0
    got = near_dedup.near_dedup(docs(spark, ["same words in this very text", "same words in this very text", None], [None, 4, 9]))
    assert sorted((r["doc_id"] is None, r["component_id"], r["kept"]) for r in got.collect()) == [(False, 4, True), (False, 9, True), (True, None, True)]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "x long, y long")
    assert {(r["node"], r["label"]) for r in near_dedup.components(edges).collect()} == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}


def test_recall_of_the_tables():
    p = 0.75**near_dedup.WIDTH
    assert 1 - (1 - (1 - p) ** near_dedup.COLLECTION) ** 2 < 2e-5


@pytest.fixture(scope="module")
def toxic_world():
    rng = random.Random(6)
    vocabulary = [made(rng, 1) for _ in range(900)]
    rows, labels = [], []
    for k in range(700):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 200))]
        bad = k % 6 == 0
        if bad:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "zorkling", "zorkable", "vremmish", "scum"]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, toxic_world):
    rows, labels = toxic_world
    frame = spark.createDataFrame([*rows, (1000, None), (1001, "")], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (5000, 1), (1000, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(frame, known).collect()}
    assert len(got) == 702 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    held = [(r["predicted"], labels[k][1]) for k, r in got.items() if r["held_out"] and k < 700]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert got[1000]["score"] == got[1001]["score"] < 0.5


def test_toxicity_without_labels(spark, toxic_world):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(spark.createDataFrame([(1, "you idiot and scum"), (2, "a fine day")], "doc_id long, text string"), none)
    assert {r["doc_id"]: r["predicted"] for r in got.collect()} == {1: 1, 2: 0}
    assert toxicity.toxicity(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0


def test_toxicity_of_odd_rows(spark, toxic_world):
    """Null ids, repeated rows and clashing columns; a hit counts wherever it is in a text."""
    rows, labels = toxic_world
    far = made(random.Random(15), 30_000) + " you idiot, scum, scum, idiot"
    more = [(None, "you idiot and scum"), (None, None), (3, rows[3][1]), (3, rows[3][1]), (9000, far)]
    frame = spark.createDataFrame([(*r, 5.0, 1, 1) for r in rows + more], "doc_id long, text string, score double, toxic int, held_out int")
    known = spark.createDataFrame([(*x, "z") for x in [*labels, *labels[:50], (None, 1)]], "doc_id long, toxic int, text string")
    got = toxicity.toxicity(frame, known)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    out = got.collect()
    assert len(out) == len(rows) + len(more)
    assert len({r["score"] for r in out if r["doc_id"] == 3}) == 1
    assert sorted((r["held_out"], r["predicted"]) for r in out if r["doc_id"] is None) == [(False, 0), (False, 1)]
    assert next(r["predicted"] for r in out if r["doc_id"] == 9000) == 1


def test_hits_against_a_plain_search():
    rng = random.Random(16)
    entries = [("bad", True, "fixed_en"), ("bad", False, "start_pure_often"), ("badly", True, "fixed_de"), ("sch", False, "start_likely_seldom"), ("é", False, "word_pure_often")]
    matcher = toxicity.Matcher(entries)
    for _ in range(400):
        text = "".join(rng.choice(["bad", "badly", "sch", "é", " ", "_", "1", "Bad", "!", "you "]) for _ in range(rng.randint(0, 20)))
        row = matcher.row(text)
        for group in toxicity.GROUPS:
            want = sum(len(re.findall(rf"(?<!\w)(?={re.escape(e)}{r'(?!\w)' if whole else ''})", text.lower())) for e, whole, g in entries if g == group)
            assert row[toxicity.GROUPS.index(group)] == want, (text, group)


def test_label_model_against_bayes():
    """Posteriors fitted without labels are close to those of the model that made the votes."""
    rng = np.random.default_rng(17)
    size, lexicons, voters = 20_000, len(toxicity.GROUPS), len(toxicity.VOTERS)
    truth = rng.random(size) < 0.2
    hit, miss = rng.uniform(0.4, 0.9, voters), rng.uniform(0.005, 0.05, voters)
    v = (rng.random((size, voters)) < np.where(truth[:, None], hit, miss)).astype(np.int8)
    v[:, 1] = np.where(rng.random(size) < 0.9, v[:, 0], v[:, 1])  # a voter that copies another
    patterns, at, n = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    got = toxicity.posterior(patterns, n)[at.ravel()]
    assert voters > lexicons and ((got > 0.5) == truth).mean() > 0.995
