"""Best-fit packing: Best-two-fit over the pieces of tokenised documents.

Documents become token ids with a closing id 0. A document longer than a
sequence is cut into full pieces; what is left over is its first piece. Full
pieces are sequences by themselves. The others are dealt by hash to shards of
bounded size, and each shard is packed by itself: a bin is filled greedily with
the longest piece that fits, then its smallest piece is exchanged for two that
fill its expanded gap more tightly. A shard wastes at most part of a bin, so
the number of sequences hardly depends on the number of shards.

Documents that have a slot and a place in a mix are packed in its order: a shard is a
range of slots, full pieces included, and sequences are numbered by the first
of their pieces, so reading them by number follows the mix.

Edge cases. A null text counts as empty and is one piece, the closing id.
A special string of the vocabulary in a text is its id.
Repeated rows are documents of their own; null ids are kept. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small_batches

SEQUENCE = 2048
#: Pieces of a shard on average.
SHARD_PIECES = 8_192
#: The same for packing by slots: fewer, as documents of a shard change places.
SLOT_PIECES = 1_024

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: Columns of a mix.
ORDER = ["slot", "place"]


# ------------------------------------------------------------------ tokenising


#: Fixed: the pre-token pattern of byte-level vocabularies.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(vocabulary: str):
    """A function from text to ids: those that ``tokenizers`` gives for the file, whose special strings are one id each."""
    import tiktoken  # merges by rank, as the file's merge list does, several times faster

    letters = byte_letters()
    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)
    added = model.get("added_tokens", [])
    if any(x.get(k) for x in added for k in ("lstrip", "rstrip", "single_word")):
        raise ValueError("special strings that take in what is beside them")
    special = {x["content"]: x["id"] for x in added}
    ranks = {bytes(letters[c] for c in token): k for token, k in model["model"]["vocab"].items() if token not in special}
    made = tiktoken.Encoding("vocabulary", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        if any(x in text for x in special):
            return made.encode(text, allowed_special="all")
        return made.encode_ordinary(text)

    return encode


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Pieces (start, length) of a document of n ids."""
    if n <= size:
        return [(0, n)]
    first = n % size or size
    return [(0, first)] + [(at, size) for at in range(first, n, size)]


def _tokenise(vocabulary: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            encode = encode or encoder(vocabulary)
            cols: list[list] = [[] for _ in range(5)]
            rows: list[int] = []
            for row, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                coded = array("I", encode(text or "")).tobytes() + b"\0\0\0\0"
                for k, (start, length) in enumerate(cut(len(coded) // 4, size)):
                    crc = zlib.crc32(coded[4 * start : 4 * (start + length)])
                    for col, v in zip(cols, (doc_id, k, start, length, crc), strict=True):
                        col.append(v)
                    rows.append(row)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            others = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), *others], [*(x.split()[0] for x in PIECES.split(", ")), *batch.schema.names[2:]])

    return run


# --------------------------------------------------------------------- packing


def best_two_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of indexes into lengths (each from 1 to size), by Best-two-fit."""
    stock: list[list[int]] = [[] for _ in range(size + 1)]
    for k, n in enumerate(lengths):
        stock[n].append(k)
    have = sum(1 << n for n in range(1, size + 1) if stock[n])
    mirror = sum(1 << (size - n) for n in range(1, size + 1) if stock[n])  # bit size-n for a length n

    def take(n: int) -> int:
        nonlocal have, mirror
        k = stock[n].pop()
        if not stock[n]:
            have ^= 1 << n
            mirror ^= 1 << (size - n)
        return k

    def put(n: int, k: int) -> None:
        nonlocal have, mirror
        stock[n].append(k)
        have |= 1 << n
        mirror |= 1 << (size - n)

    bins = []
    while have:
        content: list[tuple[int, int]] = []
        gap = size
        while n := (have & ((2 << gap) - 1)).bit_length() - 1 if have & ((2 << gap) - 1) else 0:
            content.append((n, take(n)))
            gap -= n
        if gap and have:
            small, kept = content[-1]
            for total in range(small + gap, small, -1):
                # Lengths i with a partner total - i.
                pairs = have & (mirror >> (size - total))
                while pairs:
                    i = pairs.bit_length() - 1
                    if 2 * i != total or len(stock[i]) > 1:
                        break
                    pairs ^= 1 << i
                if pairs:
                    content.pop()
                    content += [(i, take(i)), (total - i, take(total - i))]
                    put(small, kept)
                    break
        bins.append([k for _, k in content])
    return bins


def _packed(size: int, order: list[str] = []):  # noqa: B006
    def group(shard: pa.Table) -> pa.Table:
        """One shard; numbers of its pieces are all that is held."""
        # An order of their own, so a task that is run again packs alike.
        shard = shard.sort_by([(k, "ascending") for k in ("length", *order, "doc_id", "piece", "ids_crc32")])
        bins = best_two_fit(shard.column("length").to_pylist(), size)
        if order:
            turn = np.empty(len(shard), np.int64)
            turn[np.lexsort([shard.column(k).to_numpy() for k in ("piece", *reversed(order))])] = np.arange(len(shard))
            bins = sorted((sorted(content, key=turn.__getitem__) for content in bins), key=lambda content: turn[content[0]])
        base = shard.column("shard")[0].as_py() << 40
        lengths = shard.column("length").to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for k, content in enumerate(bins):
            at = 0
            for i in content:
                sequence[i], offset[i] = base + k, at
                at += int(lengths[i])
        return shard.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return group


def pack(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text", shard_pieces: int | None = None, mixed: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Mixed: docs have slot and place, which order the sequences."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *(F.col(k).cast("long").alias(k) for k in ORDER if mixed))
    pieces = checkpointed(texts.mapInArrow(_tokenise(vocabulary, size), PIECES + "".join(f", {k} long" for k in ORDER if mixed)))
    if mixed:
        n, last = pieces.agg(F.count(F.lit(1)), F.max("slot")).first()
        slots = max(1, ((last or 0) + 1) * (shard_pieces or SLOT_PIECES) // max(1, n))
        return pieces.withColumn("shard", F.floor(F.col("slot") / slots)).groupBy("shard").applyInArrow(_packed(size, ORDER), PACKED)
    shard_pieces = shard_pieces or SHARD_PIECES
    short = pieces.filter(F.col("length") < size)
    shards = max(1, -(-short.count() // shard_pieces))
    place = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards))
    packed = short.withColumn("shard", place).groupBy("shard").applyInArrow(_packed(size), PACKED)
    full = pieces.filter(F.col("length") == size).select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
