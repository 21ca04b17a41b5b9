"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are lexicons (fixed ones of four languages, and words and word beginnings
mined from labelled training rows) and patterns (density, address, shouting).
A latent-class model fits their accuracies to the pattern of their votes by EM,
without labels; each voter may depend on the class and on one other voter,
along the strongest residual correlations. Its posterior labels train a
logistic regression on counts and densities, which then scores every text.

Fitting uses at most ``SAMPLE_TOXIC + SAMPLE_CLEAN`` labelled rows, those with the
smallest hashes of their id; every word and beginning of theirs that passes the test
becomes an entry. Mined entries vote in groups of alike trust: by how purely
toxic their documents are, and whether they are many. All texts are scored whole.

Edge cases. A null or empty text has no hits and gets the score of that. Labels
that are null, or of ids without a document, are ignored; of several labels of
an id the largest counts. Without labelled rows of both kinds the fixed lexicons
decide alone. Repeated rows and null ids are scored like all others; a null id
is not held out. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small_batches

#: Bounds of the fit: labelled rows of either kind.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4_000, 8_000
#: An entry is mined if its documents are toxic so often that chance explains it with at most this probability.
CHANCE, LEAST_DOCS = 1e-4, 4
PREFIXES = (4, 5, 6)

#: Fixed word lists by language.
LEXICONS = {
    "en": "asshole bastard bitch clown crap damn disgusting dumb filth fool fuck garbage idiot imbecile jerk loser moron pathetic pig scum shit stupid trash ugly vermin worthless",
    "de": "abschaum arschloch depp dreck dumm dummkopf hurensohn idiot mistkerl scheisse scheiße schwachkopf trottel versager wertlos widerlich",
    "fr": "abruti connard connasse crétin débile dégoûtant imbécile ordure pourriture putain racaille raté salaud salope stupide",
    "es": "asqueroso basura cabrón estúpido gilipollas idiota imbécil inútil mierda patético payaso puta tonto",
}
ADDRESS = re.compile(r"\b(?:you|your|du|dein|ihr|tu|vous|toi|usted|eres|tú)\b")
WORDS = re.compile(r"\w+")

#: Of mined entries: the least share of toxic documents of a grade, and the documents from which an entry is frequent.
GRADES = {"pure": 1.0, "mostly": 0.95, "likely": 0.8}
FREQUENT = 16
#: Groups of entries; each is a voter and a feature.
GROUPS = (*(f"fixed_{k}" for k in LEXICONS), *(f"{kind}_{grade}_{often}" for kind in ("word", "start") for grade in GRADES for often in ("often", "seldom")))
VOTERS = (*GROUPS, "dense", "several", "address", "shouting")


def fixed_entries() -> dict[tuple[str, bool], str]:
    """(text, whole word) -> group, for the fixed lists."""
    out: dict[tuple[str, bool], str] = {}
    for lang, words in LEXICONS.items():
        for w in words.split():
            out.setdefault((w, True), f"fixed_{lang}")
    return out


class Matcher:
    """Finds entries at the starts of words, in one pass over a text."""

    def __init__(self, entries: list[tuple[str, bool, str]]) -> None:
        import ahocorasick

        self.find = ahocorasick.Automaton()
        where: dict[str, list[tuple[bool, int]]] = {}
        for text, whole, group in entries:
            where.setdefault(text, []).append((whole, GROUPS.index(group)))
        for text, kinds in where.items():
            self.find.add_word(text, (len(text), kinds))
        if where:
            self.find.make_automaton()
        self.empty = not where

    def row(self, text: str | None) -> list[float]:
        """Hits of each group, then: word count, places hit, places addressed, share of exclamation marks."""
        text = (text or "").lower()
        hits, places = [0.0] * len(GROUPS), set()
        if not self.empty:
            for end, (size, kinds) in self.find.iter(text):
                start = end - size + 1
                if start and (text[start - 1].isalnum() or text[start - 1] == "_"):
                    continue
                part = end + 1 < len(text) and (text[end + 1].isalnum() or text[end + 1] == "_")
                for whole, group in kinds:
                    if not (whole and part):
                        hits[group] += 1
                        places.add(start)
        address = sum(1 for p in places if ADDRESS.search(text, max(0, p - 40), p + 40))
        return [*hits, float(text.count(" ") + text.count("\n") + bool(text)), float(len(places)), float(address), text.count("!") / max(1, len(text))]


def votes(rows: np.ndarray) -> np.ndarray:
    """Rows of ``Matcher.row`` -> the voters' votes, 0 or 1."""
    g = len(GROUPS)
    words, places, address, marks = (rows[:, g + k] for k in range(4))
    rules = [places >= np.maximum(1, 0.004 * words), places >= 3, address > 0, marks > 0.01]
    return np.hstack([rows[:, :g] > 0, np.stack(rules, 1)]).astype(np.int8)


def features(rows: np.ndarray) -> np.ndarray:
    """Rows of ``Matcher.row`` -> inputs of the classifier."""
    g = len(GROUPS)
    words, places, address, marks = (rows[:, g + k] for k in range(4))
    rest = [np.log1p(places), np.minimum(1.0, 50 * places / np.maximum(words, 1)), np.log1p(address), np.minimum(1.0, 20 * marks)]
    return np.hstack([np.log1p(rows[:, :g]), np.stack(rest, 1)])


# ------------------------------------------------------------------ label model


def _forest(v: np.ndarray, n: np.ndarray, y: np.ndarray) -> list[int]:
    """Each voter's parent (or -1): a maximum forest of the voters' information on each other within the classes."""
    size = v.shape[1]
    info = np.zeros((size, size))
    for w in (n * y, n * (1 - y)):
        total = w.sum() + 1e-9
        p1 = (w @ v) / total
        p11 = (v * w[:, None]).T @ v / total
        for a in range(size):
            for b in range(a + 1, size):
                for x in (0, 1):
                    for z in (0, 1):
                        joint = {(1, 1): p11[a, b], (1, 0): p1[a] - p11[a, b], (0, 1): p1[b] - p11[a, b]}.get((x, z), 1 - p1[a] - p1[b] + p11[a, b])
                        base = (p1[a] if x else 1 - p1[a]) * (p1[b] if z else 1 - p1[b])
                        if joint > 1e-12 and base > 1e-12:
                            info[a, b] += total / n.sum() * joint * math.log(joint / base)
    parent, linked = [-1] * size, list(range(size))

    def root(k: int) -> int:
        while linked[k] != k:
            k = linked[k]
        return k

    edges: list[tuple[int, int]] = []
    for flat in np.argsort(-info, axis=None, kind="stable"):
        a, b = divmod(int(flat), size)
        if info[a, b] < 0.002:
            break
        if root(a) != root(b):
            linked[root(a)] = root(b)
            edges.append((a, b))
    near: dict[int, list[int]] = {}
    for a, b in edges:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    seen: set[int] = set()
    for start in range(size):
        todo = [start]
        while todo:
            k = todo.pop()
            seen.add(k)
            for other in near.get(k, []):
                if other not in seen:
                    parent[other] = k
                    todo.append(other)
    return parent


def posterior(v: np.ndarray, n: np.ndarray, rounds: int = 40) -> np.ndarray:
    """P(toxic | votes) of the distinct vote patterns v, of which n were seen each."""
    v, n = v.astype(float), n.astype(float)
    # Start: the more lexicon voters fire, the likelier.
    y = np.where(v[:, : len(GROUPS)].sum(1) > 0, 0.9, 0.02)

    def fit(parent: list[int], y: np.ndarray) -> np.ndarray:
        for _ in range(rounds):
            logs = []
            for w in (n * (1 - y), n * y):
                log = np.full(len(v), math.log((w.sum() + 1) / (n.sum() + 2)))
                for j, p in enumerate(parent):
                    for x in (0, 1) if p >= 0 else (None,):
                        at = np.ones(len(v), bool) if x is None else v[:, p] == x
                        rate = (w[at] @ v[at, j] + 0.1) / (w[at].sum() + 0.2)
                        log[at] += np.where(v[at, j] > 0, math.log(rate), math.log(1 - rate))
                logs.append(log)
            y = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))
        return y

    y = fit([-1] * v.shape[1], y)
    y = fit(_forest(v, n, y), y)
    fired = v[:, : len(GROUPS)].sum(1)
    return y if (n * y) @ fired >= 0 and ((n * y) @ fired) / max((n * y).sum(), 1e-9) >= ((n * (1 - y)) @ fired) / max((n * (1 - y)).sum(), 1e-9) else 1 - y


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Weights, the intercept last, for soft labels y and row weights w."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x1.shape[1])
    penalty = np.full(len(beta), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
        slope = x1.T @ (w * (y - p)) - penalty * beta
        bend = (x1 * (w * p * (1 - p))[:, None]).T @ x1 + np.diag(penalty + 1e-9)
        move = np.linalg.solve(bend, slope)
        beta += move * min(1.0, 5.0 / max(1e-9, float(np.abs(move).max())))
        if np.abs(move).max() < 1e-6:
            break
    return beta


#: Without labelled rows: a hit of a fixed lexicon decides.
DEFAULT = np.array([*[4.0 if g.startswith("fixed") else 0.0 for g in GROUPS], 2.0, 1.0, 0.5, 0.0, -4.0])


# ---------------------------------------------------------------------- on Spark


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def _mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) -> (entry, whole, toxic, n): in how many texts of the task a word or a word beginning occurs."""
    counts: Counter = Counter()
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = set(WORDS.findall((text or "").lower()))
            counts.update((w, True, toxic) for w in words)
            counts.update((w, False, toxic) for w in {w[:k] for w in words for k in PREFIXES if len(w) >= k})
    for k in range(0, len(counts), 50_000):
        part = list(counts.items())[k : k + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([e[0][0] for e in part], pa.string()), pa.array([e[0][1] for e in part], pa.bool_()), pa.array([e[0][2] for e in part], pa.int32()), pa.array([e[1] for e in part], pa.int64())],
            ["entry", "whole", "toxic", "n"],
        )


def _measure(entries: list[tuple[str, bool, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(entries)
        for batch in batches:
            rows = [matcher.row(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "row"])

    return run


def group_of(whole: bool, toxic: int, clean: int) -> str:
    """The group of a mined entry, by the numbers of toxic and clean documents that have it."""
    share = toxic / (toxic + clean)
    return f"{'word' if whole else 'start'}_{next(k for k, least in GRADES.items() if share >= least)}_{'often' if toxic >= FREQUENT else 'seldom'}"


def mined_entries(sample: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[str, bool, str]]:
    """The telling words and beginnings of the sample (toxic, text): (text, whole, group)."""
    if not n_toxic or not n_clean:
        return []
    counts = sample.mapInArrow(_mine, "entry string, whole boolean, toxic int, n long").groupBy("entry", "whole").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    # Chernoff's bound on the chance of t toxic among t + c, at the sample's rate.
    rate = n_toxic / (n_toxic + n_clean)
    share = F.col("t") / (F.col("t") + F.col("c"))
    rest = F.when(F.col("c") > 0, F.col("c") * F.log((1 - share) / (1 - rate))).otherwise(F.lit(0.0))
    evidence = F.col("t") * F.log(share / rate) + rest
    best = counts.filter((F.col("t") >= LEAST_DOCS) & (share >= max(min(GRADES.values()), rate))).filter(evidence >= -math.log(CHANCE))
    fixed = fixed_entries()
    return [(r["entry"], r["whole"], group_of(r["whole"], r["t"], r["c"])) for r in best.orderBy("entry", "whole").collect() if (r["entry"], r["whole"]) not in fixed]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[tuple[str, bool, str]], np.ndarray]:
    """Lexicon entries and the classifier's weights, from labelled rows that aren't held out."""
    known = labels.filter(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull() & ~held_out(F.col(f"`{id_col}`"))).groupBy(F.col(f"`{id_col}`").cast("long").alias("__id")).agg(F.max(F.col(f"`{label_col}`").cast("int")).alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pick = lambda kind, n: known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("__id"), "__id").limit(n)
    ids = checkpointed(pick(1, SAMPLE_TOXIC).unionByName(pick(0, SAMPLE_CLEAN)))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("__doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    sample = checkpointed(texts.join(F.broadcast(ids), F.col("__doc") == F.col("__id")).select("toxic", "text"))  # ids: a bounded number
    seen = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    fixed = [(text, whole, group) for (text, whole), group in fixed_entries().items()]
    if not seen.get(1) or not seen.get(0):
        return fixed, DEFAULT
    entries = fixed + mined_entries(sample, seen[1], seen[0])
    rows = sample.mapInArrow(_measure(entries), "toxic int, row array<double>").collect()  # a row of numbers for each of the sample
    x = np.array([r["row"] for r in rows])
    kinds = np.array([r["toxic"] for r in rows])
    # The sample has more toxic rows than the training rows at large.
    weight = np.where(kinds == 1, totals[1] / seen[1], totals[0] / seen[0])
    patterns, at = np.unique(votes(x), axis=0, return_inverse=True)
    y = posterior(patterns, np.bincount(at.ravel(), weight, len(patterns)))[at.ravel()]
    return entries, logistic(features(x), y, weight * len(x) / weight.sum())


def score(docs: DataFrame, entries: list[tuple[str, bool, str]], beta: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(entries)
        for batch in batches:
            rows = np.array([matcher.row(t) for t in batch.column(2).to_pylist()]).reshape(-1, len(GROUPS) + 4)
            p = 1 / (1 + np.exp(-np.clip(features(rows) @ beta[:-1] + beta[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    key = F.col(f"`{id_col}`")
    rows = docs.select(key.cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Fit on the labels that aren't held out, then score all documents."""
    small_batches(docs.sparkSession)
    entries, beta = fit(docs, labels, id_col, text_col, label_col)
    return score(docs, entries, beta, id_col, text_col)
