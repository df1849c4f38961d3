"""Removal of byte strings that occur more than once, by bucket-pointer refinement.

A position's initial bucket is that of the GRAM bytes from there on. A bucket
is refined by the buckets of its members at a later offset: ``refined`` makes
the bucket of a longer string from those at a position and at the offset, and
what it returns is refined again, so that 100-byte buckets become 200-byte
ones at +100, and these 385- or 400-byte ones at +185 or +200. Buckets with
one member are dropped before the next, longer ones are made.

A row for each byte in each round would be many times the input, so positions
enter sparsely, and only what is still undecided goes on:

1. Every window of LENGTH bytes is stood for by the least of its GRAM-byte
   strings (leftmost of equals), which depends on the window alone: equal
   windows have equal ones, at one offset. Windows in a row with one such
   anchor are a run. Buckets: the anchor's initial bucket.
2. The runs left, in blocks of BLOCK windows by offset from the anchor.
   Buckets: of the 385 bytes common to a block's windows.
3. The windows of the blocks left. Buckets: of their 400 bytes.

A bucket only says what is compared. Members are of one kind if the 128-bit
BLAKE2b digests of all their bytes agree (of a run, of a block's windows
together, of a window), so nothing is removed for a clash of bucket numbers.
Kinds with several members are repeats; one member of each kind stays in the
next round, where its kind meets the bucket's other kinds.

A covered stretch is a union of repeated windows, judged on the input. Buckets
are counted and joined to their members, never gathered in one task. Texts
meet their runs, blocks and spans by a secondary sort: a text's rows follow it
one after the other, however many they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.llm.runtime import discard, durable

LENGTH, GRAM, BLOCK = 400, 100, 16
#: Windows of a text handled at once; bounds a worker's memory for texts of any size. No result depends on it.
PIECE = 1 << 18
#: Bytes of text that one task takes from a shuffle.
TASK_BYTES = 32_000_000
#: Rows of an Arrow batch that is sent back.
ROWS = 50_000

#: Odd, so that it has an inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15


def _splitmix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (the SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse, modulo 2 ** 64, and a value for each byte."""

    values = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    @classmethod
    def grow(cls, n: int) -> None:
        if len(cls.powers) < n:
            for name, base in (("powers", _BASE), ("inverses", pow(_BASE, -1, 1 << 64))):
                table = np.full(n + n // 2, base, np.uint64)
                table[0] = 1
                setattr(cls, name, np.cumprod(table))


def initial(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Bucket of the ``gram`` bytes from each position on."""
    n = len(data)
    Powers.grow(n + 1)
    at = np.zeros(n + 1, np.uint64)
    np.cumsum(Powers.values[data] * Powers.powers[:n], out=at[1:])
    return _splitmix((at[gram:] - at[:-gram]) * Powers.inverses[: n - gram + 1])


def refined(buckets: np.ndarray, offset: int) -> np.ndarray:
    """Buckets of the strings that begin with one bucket's string and have another's ``offset`` later."""
    return _splitmix(buckets[:-offset] * np.uint64(0xD6E8FEB86659FD93) + buckets[offset:])


def runs_of(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, the anchor's bucket) of the runs of a text's windows."""
    n, buckets = len(data), initial(data, gram)
    order = (buckets & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(buckets), dtype=np.uint64)
    # The least of each stretch of ``width`` by doubling.
    width, have, least = length - gram + 1, 1, order
    while 2 * have <= width:
        least, have = np.minimum(least[:-have], least[have:]), 2 * have
    if have < width:
        least = np.minimum(least[: n - length + 1], least[width - have : width - have + n - length + 1])
    anchors = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    last = np.concatenate((first[1:], [len(anchors)])) - 1
    return anchors[first], first, last, buckets[anchors[first]]


def _runs(data: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """What runs_of finds in the text as a whole, ``size`` windows at a time.

    A piece's last run is held back: where the next piece begins with the same
    anchor, both are one run that the border has cut.
    """
    held: tuple[np.ndarray, ...] | None = None
    for start in range(0, max(0, len(data) - LENGTH + 1), size):
        anchor, first, last, core = runs_of(data[start : start + size + LENGTH - 1])
        anchor, first, last = anchor + start, first + start, last + start
        if held and held[0][0] == anchor[0]:
            first[0] = held[1][0]
        elif held:
            yield held
        held = tuple(x[-1:] for x in (anchor, first, last, core))
        yield anchor[:-1], first[:-1], last[:-1], core[:-1]
    if held:
        yield held


def _digests(data: memoryview, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit digests of stretches, as rows of two signed numbers."""
    digest = hashlib.blake2b
    joined = b"".join([digest(data[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return np.frombuffer(joined, np.int64).reshape(-1, 2)


class _Out:
    """Columns that are sent back in batches of bounded size."""

    def __init__(self, names: list[str]):
        self.names, self.held, self.size = names, [[] for _ in names], 0

    def add(self, *columns: np.ndarray) -> None:
        """Arrays of one length; single values stand for all rows."""
        n = max(len(c) for c in columns if isinstance(c, np.ndarray))
        for held, c in zip(self.held, columns, strict=True):
            held.append(c if isinstance(c, np.ndarray) else np.full(n, c))
        self.size += n

    def take(self, least: int = ROWS) -> Iterator[pa.RecordBatch]:
        if self.size and self.size >= least:
            whole = [np.concatenate(c) for c in self.held]
            for i in range(0, self.size, ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + ROWS]) for c in whole], self.names)
            self.held, self.size = [[] for _ in self.names], 0


def _anchors(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    """(id, row, text) -> runs: (core, u, v, n, id, row, anchor, first, last, upto).

    Runs in a row that are alike, as in a text of few bytes repeated, are one
    row that counts n; upto is the last window of the last of them.
    """
    out = _Out(["core", "u", "v", "n", "id", "row", "anchor", "first", "last", "upto"])
    for batch in batches:
        for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            view = memoryview(text.as_buffer())
            for anchor, first, last, core in _runs(np.frombuffer(view, np.uint8), piece):
                if len(anchor):
                    digest = _digests(view, first, last + LENGTH)
                    new = np.flatnonzero(np.concatenate(([True], (digest[1:] != digest[:-1]).any(1))))
                    until = np.concatenate((new[1:], [len(anchor)]))
                    out.add(core[new].view(np.int64), digest[new, 0], digest[new, 1], until - new, doc, row, anchor[new], first[new], last[new], last[until - 1])
                    yield from out.take()
    yield from out.take(1)


def _by_text(batches: Iterator[pa.RecordBatch], used: int) -> Iterator[tuple[int, int, bytes, list[np.ndarray]]]:
    """(id, row, text, columns from the sixth on) of texts' rows; rows come as id, row, kind (0: the text), place, packed, then ``used`` columns."""
    unpack = zstandard.ZstdDecompressor()
    key, packed, data = None, None, None
    for batch in batches:
        ids, rows, kinds = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        starts = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1]) | (kinds[1:] != kinds[:-1])))) if len(ids) else np.zeros(0, int)
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)], strict=False):
            if kinds[a] == 0:
                key, packed, data = (ids[a], rows[a]), batch.column(4)[a], None
            else:
                assert key == (ids[a], rows[a])
                if data is None:
                    data = unpack.decompress(packed.as_py())
                yield int(ids[a]), int(rows[a]), data, [batch.column(5 + i).slice(a, b - a).to_numpy(zero_copy_only=False) for i in range(used)]


def _stretches(first: np.ndarray, last: np.ndarray, piece: int) -> Iterator[tuple[int, int]]:
    """Index ranges of places (in order) that are near each other, so that few bytes between them are looked at."""
    start = 0
    for i in range(1, len(first) + 1):
        if i == len(first) or first[i] > last[i - 1] + 2 * LENGTH or last[i] - first[start] > piece:
            yield start, i
            start = i


def _blocks(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    """Texts and their runs -> blocks: (core, u, v, id, row, top, known).

    Block k has the windows that start k * BLOCK to k * BLOCK + BLOCK - 1
    bytes before the anchor; top is the last of them. All lie around the same
    bytes, wherever the run begins and ends; where the text has no room for
    all of them, the block is of a kind of its own.
    """
    out = _Out(["core", "u", "v", "id", "row", "top", "known"])
    for doc, row, data, (anchor, first, last, known) in _by_text(batches, 4):
        view = memoryview(data)
        for a, b in _stretches(first, last, piece):
            low, high = (anchor[a:b] - last[a:b]) // BLOCK, (anchor[a:b] - first[a:b]) // BLOCK
            size = high - low + 1
            k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
            top = np.repeat(anchor[a:b], size) - BLOCK * k
            left = max(0, int(top.min()))
            buckets = refined(refined(initial(np.frombuffer(data, np.uint8)[left : int(top.max()) + LENGTH]), GRAM), LENGTH - BLOCK + 1 - 2 * GRAM)
            core = _splitmix(buckets[top - left] + k.astype(np.uint64))
            room = (top >= BLOCK - 1) & (top + LENGTH <= len(data))
            kind = _digests(view, np.where(room, top - BLOCK + 1, 0), np.where(room, top + LENGTH, 0)).copy()
            alone = np.flatnonzero(~room)
            kind[alone, 0], kind[alone, 1] = row ^ doc, top[alone]
            out.add(core.view(np.int64), kind[:, 0], kind[:, 1], doc, row, top, np.repeat(known[a:b], size))
            yield from out.take()
    yield from out.take(1)


def _windows(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    """Texts and the blocks left of them -> windows: (core, u, v, id, row, start, known)."""
    out = _Out(["core", "u", "v", "id", "row", "start", "known"])
    for doc, row, data, (top, known) in _by_text(batches, 2):
        view = memoryview(data)
        for a, b in _stretches(top, top, piece):
            at = (top[a:b, None] - np.arange(BLOCK)).ravel()
            fits = (at >= 0) & (at + LENGTH <= len(data))
            at, named = at[fits], np.repeat(known[a:b], BLOCK)[fits]
            left = int(at.min())
            buckets = refined(refined(initial(np.frombuffer(data, np.uint8)[left : int(at.max()) + LENGTH]), GRAM), LENGTH - 2 * GRAM)
            kind = _digests(view, at, at + LENGTH)
            out.add(buckets[at - left].view(np.int64), kind[:, 0], kind[:, 1], doc, row, at, named)
            yield from out.take()
    yield from out.take(1)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (kind 0, in order) and then the texts that they cover (kind 1) -> the result's rows."""
    unpack = zstandard.ZstdDecompressor()
    names, types = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"], (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    key, spans, out, size = None, [], [], 0
    for batch in batches:
        for doc, row, kind, start, packed, upto, doc_id in zip(*(batch.column(i) for i in range(7)), strict=True):
            if key != (doc.as_py(), row.as_py()):
                key, spans = (doc.as_py(), row.as_py()), []
            if kind.as_py() == 0:
                if spans and start.as_py() <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], upto.as_py())
                else:
                    spans.append([start.as_py(), upto.as_py()])
                continue
            data = unpack.decompress(packed.as_py())
            borders = [0, *(x for s in spans for x in s), len(data)]
            rest = b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2], strict=True))
            out.append((doc_id.as_py(), len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest))
            size += len(rest)
            if size > 8_000_000 or len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)
                out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, id, row, text) with the text packed: it is shuffled, and this halves that."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array([pack.compress(t.as_buffer() if t.is_valid else b"") for t in batch.column(3)], pa.binary())], ["doc_id", "id", "row", "packed"])


def _settle(rows: DataFrame, several: Column, one_of: list[str]) -> tuple[DataFrame, DataFrame]:
    """One round for rows (core, u, v, known, ...): (rows that are repeats, one row of each kind still to be compared).

    Buckets without ``several`` members are dropped. In buckets of one kind,
    all rows are repeats; in others, those of kinds with several members are,
    and one of each kind goes on, as known if nothing more is asked about it.
    The second table is written; the first one reads what ``rows`` is made of.
    """
    mixed = (F.min("u") != F.max("u")) | (F.min("v") != F.max("v"))
    buckets = rows.groupBy("core").agg(several.alias("several"), mixed.alias("mixed")).where("several").drop("several")
    shared = durable(rows.join(buckets, "core"))
    kinds = durable(shared.where("mixed").groupBy("core", "u", "v").agg(several.alias("several"), F.min(F.struct(*one_of, "known")).alias("one")))
    agreed = shared.where("mixed").join(kinds.where("several").select("core", "u", "v"), ["core", "u", "v"])
    repeats = shared.where("not mixed").select(*rows.columns).unionByName(agreed.select(*rows.columns))
    return repeats, kinds.select(*[f"one.{c}" for c in one_of], (F.col("one.known") | F.col("several")).alias("known"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) of every row.

    Texts are taken as UTF-8; null is the empty text. Texts shorter than
    LENGTH lose nothing. Repeated rows count as copies of each other. Other
    columns are ignored. piece: windows of a text handled at once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    texts = rows.mapInArrow(_pack, "doc_id bigint, id bigint, row bigint, packed binary")
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES)

    def beside(places: DataFrame, place: str, *used: str) -> DataFrame:
        """Long texts, each followed by its places in order."""
        text = texts.select("id", "row", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("place"), "packed")
        rest = places.select("id", "row", F.lit(1).alias("kind"), F.col(place).alias("place"), F.lit(None).cast("binary").alias("packed"), *used)
        return text.unionByName(rest, allowMissingColumns=True).repartition(tasks, "id", "row").sortWithinPartitions("id", "row", "kind", "place")

    anchors = durable(rows.where(F.octet_length("text") >= LENGTH).select("id", "row", "text").mapInArrow(partial(_anchors, piece=piece), "core bigint, u bigint, v bigint, n bigint, id bigint, row bigint, anchor bigint, first bigint, last bigint, upto bigint"))
    repeats, left = _settle(anchors.withColumn("known", F.lit(False)), F.sum("n") > 1, ["id", "row", "anchor", "first", "last"])
    spans = durable(repeats.select("id", "row", F.col("first").alias("start"), (F.col("upto") + LENGTH).alias("end")))
    discard(anchors)

    two_places = lambda place: F.min(F.xxhash64("id", "row", place)) < F.max(F.xxhash64("id", "row", place))
    blocks = durable(beside(left, "first", "anchor", "first", "last", "known").mapInArrow(partial(_blocks, piece=piece), "core bigint, u bigint, v bigint, id bigint, row bigint, top bigint, known boolean"))
    repeats, left = _settle(blocks, two_places("top"), ["id", "row", "top"])
    spans_of_blocks = durable(repeats.where("not known").select("id", "row", (F.col("top") - BLOCK + 1).alias("start"), (F.col("top") + LENGTH).alias("end")))
    discard(blocks)

    windows = durable(beside(left, "top", "top", "known").mapInArrow(partial(_windows, piece=piece), "core bigint, u bigint, v bigint, id bigint, row bigint, start bigint, known boolean"))
    twice = windows.groupBy("core", "u", "v").agg(two_places("start").alias("twice")).where("twice").select("core", "u", "v")
    spans_of_windows = windows.where("not known").join(twice, ["core", "u", "v"]).select("id", "row", "start", (F.col("start") + LENGTH).alias("end"))

    found = spans.unionByName(spans_of_blocks).unionByName(spans_of_windows).select("id", "row", F.lit(0).alias("kind"), F.col("start").alias("place"), F.lit(None).cast("binary").alias("packed"), "end", F.lit(None).cast("bigint").alias("doc_id"))
    whole = texts.select("id", "row", F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("place"), "packed", F.lit(0).cast("bigint").alias("end"), "doc_id")
    return found.unionByName(whole).repartition(tasks, "id", "row").sortWithinPartitions("id", "row", "kind", "place").mapInArrow(_cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
