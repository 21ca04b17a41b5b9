"""Quality classifier: interpolated modified Kneser-Ney over n-grams of characters.

Counts come from trusted texts, three quarters of them by a hash of their id. The other
quarter calibrates: a document is kept if its perplexity is at most a high
quantile of theirs in the same language.

Counts, continuation counts and contexts are tables, sharded by n-gram. Every
group of documents (an input file, or part of one) asks for the distinct n-grams it has;
their probabilities come from joins of the shards and go back to the groups,
which score their texts as a stream. So texts are shuffled once, and no table
is gathered in one place.

Edge cases. A null or empty text is scored by its end symbol alone. A null
language is a language of its own. A language without calibrating documents
takes the limit of all languages together; without any, everything is kept.
Repeated rows are scored alike and each kept or not; labels of an id without a
document do nothing; null ids are scored but never trusted. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, fits, forget, likely_in, slices, small_batches, without

#: An n-gram of up to four 16-bit units of UTF-16 is one long, the first in the lowest bits. The first unit
#: of five is a column of its own, ``head``, and the long has the other four.
ORDER, BITS = 5, 16
#: Units of a long.
LONG = ORDER - 1
#: Symbols before and after a text.
BEGIN, END = "\x02", "\x03"
#: Units taken on at once, and n-grams gathered before they are merged.
BLOCK_UNITS, MERGE = 1 << 18, 1 << 19
#: Bytes of documents that are compressed together for the shuffle.
BLOB_BYTES = 1 << 18
#: A file with more bytes of text than this is several groups.
GROUP_BYTES = 32 << 20
#: One trusted document in so many calibrates; their quantile is the limit, in steps of 1 / STEPS of a nat.
HELD = 4
#: On sf0.1 it lets 2.1% of the documents of quality 0 pass (0.98: 3.7%, 0.96: 1.6%) and costs 2.8% of the
#: calibrating ones of quality 1 (0.98: 1.7%, 0.96: 3.6%). Of few documents it is the worst one.
QUANTILE = 0.97
STEPS = 1000
#: Languages up to this number have their limits broadcast.
LANGUAGES = 10_000


# ------------------------------------------------------------- texts to n-grams


def packed(gram: str) -> int:
    """The long of an n-gram of up to LONG units."""
    return int.from_bytes(int.from_bytes(gram.encode("utf-16-le", "surrogatepass"), "little").to_bytes(8, "little"), "little", signed=True)


def _keys(heads: np.ndarray, longs: np.ndarray, attempt: int) -> np.ndarray:
    """One long for each n-gram, different ones almost always; callers try again where they aren't."""
    return longs ^ (heads.astype(np.int64) * np.int64(-7046029254386353131 + 2 * attempt))


def _distinct(heads: np.ndarray, longs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heads and longs of the distinct n-grams, and the number of each given one's among them."""
    for attempt in count():
        number, keys = pd.factorize(_keys(heads, longs, attempt))
        one = np.empty(len(keys), np.int64)
        one[number] = np.arange(len(number))
        if (longs[one][number] == longs).all() and (heads[one][number] == heads).all():
            return heads[one], longs[one], number


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By block of texts: heads and longs of the distinct n-grams, the number of each position's among them, and where each text's positions begin."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= BLOCK_UNITS):
            size += len(texts[end] or "")
            end += 1
        parts = [BEGIN * (ORDER - 1) + (t or "") + END for t in texts[at:end]]
        lengths = np.array([len(p) for p in parts])
        raw = "".join(parts).encode("utf-16-le", "surrogatepass")
        if len(raw) != 2 * lengths.sum():  # pairs of units
            lengths = np.array([len(p.encode("utf-16-le", "surrogatepass")) // 2 for p in parts])
        n = len(raw) // 2
        inside = np.ones(n, dtype=bool)
        stops = np.cumsum(lengths)
        for k in range(1, ORDER):
            inside[stops - k] = False  # windows that reach into the next text
        inside = inside[: n - ORDER + 1]
        heads = np.frombuffer(raw, "<u2")[: n - ORDER + 1][inside]
        longs = np.ndarray((n - ORDER + 1,), dtype="<i8", buffer=raw, offset=2, strides=(2,))[inside]
        yield *_distinct(heads, longs), np.concatenate([[0], np.cumsum(lengths - ORDER + 1)[:-1]])
        at = end


class _Tally:
    """Counts of n-grams over blocks, merged now and then."""

    def __init__(self) -> None:
        self.heads: list[np.ndarray] = []
        self.longs: list[np.ndarray] = []
        self.n: list[np.ndarray] = []
        self.size = 0

    def add(self, heads: np.ndarray, longs: np.ndarray, n: np.ndarray) -> None:
        self.heads.append(heads)
        self.longs.append(longs)
        self.n.append(n)
        self.size += len(longs)
        if self.size > MERGE and len(self.longs) > 1:
            self.merge()
            self.size = len(self.longs[0]) // 2  # a large tally waits longer for its next merge

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        heads, longs, number = _distinct(np.concatenate([np.zeros(0, np.uint16), *self.heads]), np.concatenate([np.zeros(0, np.int64), *self.longs]))
        self.heads, self.longs = [heads], [longs]
        self.n = [np.bincount(number, np.concatenate([np.zeros(0), *self.n]), len(longs)).astype(np.int64)]
        return heads, longs, self.n[0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> (head, gram, n), summed over the task unless there are very many."""
    tally = _Tally()

    def out() -> pa.RecordBatch:
        heads, longs, n = tally.merge()
        return pa.RecordBatch.from_arrays([pa.array(heads.astype(np.int32)), pa.array(longs), pa.array(n)], ["head", "gram", "n"])

    for batch in batches:
        for heads, longs, number, _ in grams(batch.column(0).to_pylist()):
            tally.add(heads, longs, np.bincount(number, minlength=len(longs)))
            if len(tally.longs[0]) > 2_000_000:
                yield from slices(out())
                tally = _Tally()
    yield from slices(out())


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, text) -> the distinct (part, head, gram)."""
    tallies: dict[int, _Tally] = {}

    def out(part: int) -> pa.RecordBatch:
        heads, longs, _ = tallies.pop(part).merge()
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(longs), part), pa.int64()), pa.array(heads.astype(np.int32)), pa.array(longs)], ["part", "head", "gram"])

    for batch in batches:
        parts = batch.column(0).to_numpy(zero_copy_only=False)
        texts = batch.column(1).to_pylist()
        for part in np.unique(parts).tolist():
            tally = tallies.setdefault(part, _Tally())
            for heads, longs, _, _ in grams([texts[k] for k in np.flatnonzero(parts == part)]):
                tally.add(heads, longs, np.zeros(len(longs)))
        if sum(t.size for t in tallies.values()) > 4 * MERGE:
            for p in list(tallies):
                yield from slices(out(p))
    for p in list(tallies):
        yield from slices(out(p))


def _blob(columns: dict[str, pa.Array]) -> bytes:
    """A compressed table in one value."""
    sink = pa.BufferOutputStream()
    rows = pa.record_batch(list(columns.values()), names=list(columns))
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _blobs(parts: list[int], texts: bool, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array([texts] * len(parts), pa.bool_()), pa.array(blobs, pa.binary())], ["part", "texts", "blob"])


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, doc_id, lang, text) -> (part, texts, blob): documents of a part, compressed together."""
    held: dict[int, list[pa.RecordBatch]] = {}
    sizes: dict[int, int] = {}

    def out(part: int) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held.pop(part)).combine_chunks()
        del sizes[part]
        return _blobs([part], True, [_blob({c: rows.column(c).combine_chunks() for c in rows.column_names})])

    for batch in batches:
        parts = batch.column(0).to_numpy(zero_copy_only=False)
        for part in np.unique(parts).tolist():
            rows = batch.select([1, 2, 3]).take(pa.array(np.flatnonzero(parts == part)))
            held.setdefault(part, []).append(rows)
            sizes[part] = sizes.get(part, 0) + rows.nbytes
            if sizes[part] > BLOB_BYTES:
                yield out(part)
        if sum(sizes.values()) > 128 * BLOB_BYTES:
            for part in list(held):
                yield out(part)
    for part in list(held):
        yield out(part)


def _pack_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, head, gram, logp) -> (part, texts, blob): answers to a part, compressed together."""
    held: list[pa.RecordBatch] = []

    def out() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        part, head, gram, logp = (rows.column(k).to_numpy() for k in range(4))
        order = np.lexsort((gram, part))
        part, head, gram, logp = part[order], head[order], gram[order], logp[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).tolist()
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        blobs = [_blob({"head": pa.array(head[a:b].astype(np.uint16)), "gram": pa.array(gram[a:b]), "logp": pa.array(logp[a:b])}) for a, b in spans]
        return _blobs(part[cuts[:-1]].tolist(), False, blobs)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) > MERGE:
            yield out()
            held = []
    if held:
        yield out()


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, texts, blob), each part's answers first -> (doc_id, lang, n_symbols, log_perplexity)."""
    part, fresh = None, []
    for batch in batches:
        for k in range(batch.num_rows):
            if batch.column(0)[k].as_py() != part:
                part, fresh, keys = batch.column(0)[k].as_py(), [], None
            rows = pa.ipc.open_stream(batch.column(2)[k].as_buffer()).read_all()
            if not batch.column(1)[k].as_py():
                fresh.append(rows)
                continue
            if keys is None:
                answers = pa.concat_tables(fresh)
                heads, longs, logps = answers.column(0).to_numpy().astype(np.int32), answers.column(1).to_numpy(), answers.column(2).to_numpy().astype(np.float64)
                fresh = []
                for attempt in count():
                    keys = _keys(heads, longs, attempt)
                    order = np.argsort(keys)
                    keys = keys[order]
                    if (keys[1:] != keys[:-1]).all():
                        break
                heads, longs, logps = heads[order], longs[order], logps[order]
            sums, sizes = [], []
            for some_heads, some_longs, number, starts in grams(rows.column(2).to_pylist()):
                at = np.minimum(np.searchsorted(keys, _keys(some_heads, some_longs, attempt)), len(keys) - 1)
                if (longs[at] != some_longs).any() or (heads[at] != some_heads).any():
                    raise RuntimeError("a text has n-grams that its group has not asked for")
                sums.append(np.add.reduceat(logps[at][number], starts))
                sizes.append(np.diff(np.append(starts, len(number))))
            n = np.concatenate(sizes)
            ids, langs = (rows.column(c).combine_chunks() for c in (0, 1))
            yield pa.RecordBatch.from_arrays([ids, langs, pa.array(n, pa.int64()), pa.array(-np.concatenate(sums) / n)], ["doc_id", "lang", "n_symbols", "log_perplexity"])


# ------------------------------------------------------------------- the model


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; half a count where counts of counts are missing."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(k - (k + 1) * y * b / a, 0.05), k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def train(texts: DataFrame) -> list[DataFrame]:
    """Tables of the orders 1 to ORDER: gram, n, the last with head. Only it has counts; the others have distinct left neighbours."""
    top = checkpointed(texts.select("text").mapInArrow(_count, "head int, gram long, n long").groupBy("head", "gram").agg(F.sum("n").alias("n")))
    tables = [checkpointed(top.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))), top]
    for _ in range(LONG - 1):
        tables.insert(0, checkpointed(tables[0].groupBy(F.shiftrightunsigned("gram", BITS).alias("gram")).agg(F.count(F.lit(1)).alias("n"))))
    return tables


def probabilities(tables: list[DataFrame], wanted: DataFrame) -> DataFrame:
    """Interpolated probabilities of the wanted n-grams (distinct, of ORDER units, or without a head of one less): their columns, p."""
    whole = "head" in wanted.columns
    n = F.col("n")
    known: DataFrame | None = None
    for k, t in enumerate(tables if whole else tables[:LONG], 1):
        ones = [F.count_if(n == j).alias(f"n{j}") for j in (1, 2, 3, 4)]
        row = t.agg(*ones, F.count(F.lit(1)).alias("v")).first()
        d = discounts(row["n1"], row["n2"], row["n3"], row["n4"])
        cut = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        top = k == ORDER
        before = F.shiftleft("gram", BITS).bitwiseOR(F.col("head").cast("long")) if top else F.col("gram").bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1))
        context = t.groupBy(before.alias("context")).agg(F.sum("n").alias("total"), F.sum(cut).alias("cut"))
        need = wanted if top or k == LONG and not whole else wanted.select(F.shiftrightunsigned("gram", BITS * (LONG - k)).alias("gram")).distinct()
        own = F.coalesce((n - cut) / F.col("total"), F.lit(0.0))
        rest = F.coalesce(F.col("cut") / F.col("total"), F.lit(1.0))
        rows = need.join(t, ["head", "gram"] if top else "gram", "left").withColumn("context", before).join(context, "context", "left")
        shorter = known
        if known is None:
            # Below single symbols lies the uniform distribution over those seen and one more.
            known = rows.select("gram", (own + rest / (row["v"] + 1)).alias("p"))
        else:
            ends = known.select(F.col("gram").alias("end"), F.col("p").alias("q"))
            end = F.col("gram") if top else F.shiftrightunsigned("gram", BITS)
            known = rows.withColumn("end", end).join(ends, "end").select(*need.columns, (own + rest * F.col("q")).alias("p"))
        last, known = shorter, checkpointed(known)
        if last is not None:
            forget(last)
    return known


def _is_scan(docs: DataFrame) -> bool:
    """Whether the rows come straight from files, so each has the same file at every reading."""
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    return all(re.match(r"[\s:+-]*(?:Project|Filter|Relation|LocalLimit 0)\b", line) for line in plan.splitlines() if line.strip()) and "Relation" in plan


def perplexities(docs: DataFrame, tables: list[DataFrame], id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """doc_id, lang, n_symbols, log_perplexity of every document."""
    own = [] if _is_scan(docs) else [docs := checkpointed(docs)]
    file = F.input_file_name()
    size = docs.select(F.octet_length(F.col(f"`{text_col}`")).alias("b"), file.alias("f")).groupBy("f").agg(F.sum("b").alias("b"))
    largest, files = size.agg(F.max("b"), F.count(F.lit(1))).first()
    pieces = max(1, -(-(largest or 0) // GROUP_BYTES))
    part = F.xxhash64(file, F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(pieces)))
    rows = docs.select(part.alias("part"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    asked = checkpointed(rows.select("part", "text").mapInArrow(_ask, "part long, head int, gram long").distinct())
    p = probabilities(tables, asked.select("head", "gram").distinct())
    packed = "part long, texts boolean, blob binary"
    answers = checkpointed(asked.join(p, ["head", "gram"]).select("part", "head", "gram", F.log("p").cast("float").alias("logp")).mapInArrow(_pack_answers, packed))
    forget(asked, p)
    stream = answers.unionByName(rows.mapInArrow(_pack_texts, packed))
    # A task has one group, seldom two by chance, whatever their number.
    scores = checkpointed(stream.repartition(max(1, 3 * files * pieces), "part").sortWithinPartitions("part", "texts").mapInArrow(_score, "doc_id long, lang string, n_symbols long, log_perplexity double"))
    forget(answers, *own)
    return scores


def limits(scores: DataFrame, quantile: float) -> DataFrame:
    """Per language (null: all together) the quantile of log perplexities, rounded up to a step: lang, limit."""
    bins = scores.groupBy("lang", F.ceil(F.col("log_perplexity") * STEPS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    both = bins.unionByName(bins.groupBy("bin").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(None).cast("string")))
    upto = Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("lang")
    ranked = both.withColumn("upto", F.sum("n").over(upto)).withColumn("every", F.sum("n").over(every))
    return ranked.filter(F.col("upto") >= quantile * F.col("every")).groupBy("lang").agg((F.min("bin") / STEPS).alias("limit"))


def quality_model(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """One row per document: doc_id, lang, n_symbols, log_perplexity, limit, kept. trusted: ids, its only column."""
    small_batches(docs.sparkSession, 2048)
    trusted = trusted.select(F.col(f"`{trusted.columns[0]}`").cast("long").alias("__id")).dropna().distinct()
    held = F.pmod(F.xxhash64("__id"), F.lit(HELD)) == 0
    taught = trusted.filter(~held)
    ids: Column = F.col("doc_id") == F.col("__id")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    tables = train(likely_in(texts, "doc_id", taught).join(taught, ids, "left_semi"))
    scores = perplexities(docs, tables, id_col, text_col, lang_col)
    forget(*tables)
    limit = checkpointed(limits(scores.join(trusted.filter(held), ids, "left_semi"), quantile))
    overall = limit.filter("lang is null").first()
    own = limit.filter("lang is not null").withColumnRenamed("lang", "l_lang")
    if fits(own, LANGUAGES):
        own = F.broadcast(own)
    judged = scores.join(own, F.col("lang") == F.col("l_lang"), "left").withColumn("limit", F.coalesce("limit", F.lit(overall["limit"] if overall else None).cast("double")))
    return judged.select("doc_id", F.nullif("lang", F.lit("")).alias("lang"), "n_symbols", "log_perplexity", "limit", F.coalesce(F.col("log_perplexity") <= F.col("limit"), F.lit(True)).alias("kept"))


def keep_fluent(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that the model keeps; rows with a null id stay, and rows repeating an id stay or go together."""
    gone = checkpointed(quality_model(docs, trusted, id_col, text_col, lang_col).filter("not kept and doc_id is not null").select("doc_id"))
    return without(docs, id_col, gone)
