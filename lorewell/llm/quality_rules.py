"""Quality rules: word rules, then compression bands.

``quality_rules`` judges each whole text twice. The base rules count words,
symbols, repeated lines and repeated three-word windows. The method proper
compares zstandard ratios, of the whole text and of its fixed chunks, with
bands that depend on the length: a ratio above its band means repetitive text,
one below it means noise that does not compress. Chunks cover all of a text: of
``CHUNK_BYTES`` each, then what is left, which is part of the last chunk if it is
shorter than ``CHUNK_LEAST``. A text passes if its own ratio is in its band
and chunks with at most ``CHUNK_SHARE`` of its bytes lie outside theirs.

Edge cases. A null text counts as empty: no words, base_failed true, kept
false. Every row is judged by itself, so ties, repeated rows and null ids give
one result row each. An empty table gives an empty result. Extra columns are
ignored; input columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, small_batches, text_blocks, windows

#: Fixed limits of a ratio, of a text or a chunk: (bytes below, least, most), by length in bytes.
BANDS = (
    (256, 0.70, 2.00),
    (512, 0.85, 2.10),
    (1024, 1.10, 2.20),
    (2048, 1.25, 2.28),
    (4096, 1.35, 2.36),
    (8192, 1.45, 2.44),
    (16384, 1.55, 2.52),
    (32768, 1.60, 2.60),
    (1 << 62, 1.60, 2.68),
)
CHUNK_BYTES, CHUNK_LEAST = 4096, 256
#: Share of a text's bytes that may be in chunks outside their bands.
CHUNK_SHARE = 0.1
LEVEL = 3

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, whole_ratio double, n_chunks long, n_chunks_out long, kept boolean"
)


def band(n: int) -> tuple[float, float]:
    """The limits for n bytes."""
    return next((low, high) for below, low, high in BANDS if n < below)


def chunks(n: int) -> list[tuple[int, int]]:
    """Where the chunks of n bytes begin and end."""
    cuts = list(range(0, n, CHUNK_BYTES))
    if len(cuts) > 1 and n - cuts[-1] < CHUNK_LEAST:
        cuts.pop()
    return list(zip(cuts, [*cuts[1:], n], strict=True))


def bands(text: bytes, zip_: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """Ratio of the whole text, its chunks, those outside their bands, and the verdict."""
    n = len(text)
    if not n:
        return 0.0, 0, 0, False

    def judge(part: bytes) -> tuple[float, bool]:
        ratio = len(part) / len(zip_.compress(part))
        low, high = band(len(part))
        return ratio, low <= ratio <= high

    ratio, inside = judge(text)
    spans = chunks(n)
    # A single chunk is the text itself.
    out = [b - a for a, b in spans if not judge(text[a:b])[1]] if len(spans) > 1 else [n] * (not inside)
    return ratio, len(spans), len(out), inside and sum(out) <= CHUNK_SHARE * n


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def repeated_words(hashes: np.ndarray) -> int:
    """Words in three-word windows that occur twice or more; hashes: of all windows of a text."""
    if len(hashes) < 2:
        return 0
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(hashes), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    marks = np.zeros(len(hashes) + 2, dtype=bool)
    for k in range(3):
        marks[k : k + len(hashes)] |= again
    return int(marks.sum())


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zip_ = zstandard.ZstdCompressor(level=LEVEL)
    symbol = np.zeros(256, dtype=bool)
    symbol[list(b"#*$%&|<>")] = True
    for batch in batches:
        texts = batch.column(1)
        rows: dict[str, list] = {k.split()[0]: [] for k in SCHEMA.split(", ")}
        rows["doc_id"] = batch.column(0)
        for _, data, offsets in text_blocks(texts):
            words = Words(data, offsets)
            chars = np.concatenate([[0], np.cumsum(words.inside & ((data & 0xC0) != 0x80))])[offsets]
            symbols = np.concatenate([[0], np.cumsum(symbol[data])])[offsets]
            tri = windows(words, 3)
            raw = data.tobytes()
            for k, n in enumerate(words.counts.tolist()):
                text, at = raw[offsets[k] : offsets[k + 1]], words.bounds[k]
                repeat = repeated_words(tri[at : at + n - 2]) if n > 3 else 0
                failed = n < 50 or 100 * repeat > 50 * n
                ratio, n_chunks, out, inside = bands(text, zip_)
                rows["n_words"].append(n)
                rows["n_dup_lines"].append(duplicate_lines(text.decode("utf-8", "replace")))
                rows["n_repeat_words"].append(repeat)
                rows["base_failed"].append(failed)
                rows["whole_ratio"].append(ratio)
                rows["n_chunks"].append(n_chunks)
                rows["n_chunks_out"].append(out)
                rows["kept"].append(inside and not failed)
            rows["word_chars"] += np.diff(chars).tolist()
            rows["n_symbols"] += np.diff(symbols).tolist()
        types = {"b": pa.bool_(), "d": pa.float64(), "l": pa.int64()}
        yield pa.RecordBatch.from_pydict({k.split()[0]: rows[k.split()[0]] if k.startswith("doc_id") else pa.array(rows[k.split()[0]], types[k.split()[1][0]]) for k in SCHEMA.split(", ")})


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its counts, ratios and whether it is kept. No shuffle."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_judge, SCHEMA)


def keep_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns and no join: the verdict travels with the row."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array(np.arange(batch.num_rows, dtype=np.int64))
            for verdict in _judge(iter([pa.RecordBatch.from_arrays([ids, batch.column(at)], ["doc_id", "text"])])):
                yield batch.filter(verdict.column(verdict.schema.get_field_index("kept")))

    return docs.mapInArrow(judged, docs.schema)
