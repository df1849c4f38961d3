"""Quality by the hashed n-gram log-likelihood ratio of trusted to raw text.

Words and pairs of words are hashed into BUCKETS. Two multinomials over the
buckets are counted, of the trusted documents and of the whole corpus, with
additive smoothing. A document's score is the sum of its n-grams'
log-likelihood ratios over their number. Ratios are kept in whole millionths,
so that sums don't depend on their order, and every document is decided by
one comparison with a threshold. ``fit`` takes both from the corpus: the
number of buckets follows its size, and the threshold is where labelled
documents left out of the trusted counts are best told apart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.llm.runtime import keyed_text, map_texts

BUCKETS, SMOOTHING = 1 << 14, 1.0
#: Millionths of a nat for each n-gram; where nothing is labelled from which a threshold could be taken.
THRESHOLD = -45_000
#: Bytes of text for each bucket, and the fewest and most buckets (what a worker and the driver hold, whatever the input).
BUCKET_BYTES, FEWEST, MOST = 1 << 10, 1 << 10, 1 << 16
#: One in so many ids is left out of the trusted counts for the threshold; the threshold's step.
HELD_OUT, STEP = 3, 1000
#: N-grams that are counted at once; bounds the memory of a worker.
COUNTED_AT_ONCE = 1 << 20
BLANK_CHARS, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


class _Numbers(dict):
    """Each new key gets the next number."""

    def __missing__(self, key: bytes) -> int:
        n = self[key] = len(self)
        return n


class Words:
    """Numbers and hashes of words; forgotten when they become too many."""

    def __init__(self, most: int = 400_000):
        self.most, self.number, self.hashes = most, _Numbers(), np.zeros(1024, np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers; self.hashes has the hash of each, and room for more."""
        number = self.number
        if len(number) > self.most:
            number.clear()
            self.hashes = np.zeros(1024, np.uint64)
        have = len(number)
        out = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        if (now := len(number)) > have:
            if now > len(self.hashes):
                self.hashes = np.concatenate((self.hashes[:have], np.zeros(2 * now - have, np.uint64)))
            fresh = islice(reversed(number), now - have)
            self.hashes[have:now] = np.fromiter(map(zlib.crc32, map(bytes.lower, fresh)), np.uint64, now - have)[::-1]
        return out


def buckets(h: np.ndarray, n: int = BUCKETS) -> np.ndarray:
    """Of the words and pairs of words with these hashes."""
    one = h * np.uint64(0x9E3779B97F4A7C15)
    two = (one[:-1] ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xBF58476D1CE4E5B9) + one[1:]
    return (np.concatenate((one, two)) >> np.uint64(40)) % np.uint64(n)


def _covered(key: np.ndarray, again: np.ndarray, n: int, size: int) -> int:
    """Words of n in windows whose key is one of the sorted ``again``."""
    if not len(again):
        return 0
    twice = np.flatnonzero(again[np.minimum(np.searchsorted(again, key), len(again) - 1)] == key)
    covered = np.zeros(n, bool)
    for k in range(size):
        covered[twice + k] = True
    return int(covered.sum())


def repeated(ids: np.ndarray, size: int = 3) -> int:
    """Words in windows of ``size`` that are found twice or more."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    bits = 63 // size
    if int(ids.max()) >> bits == 0:  # a window's numbers fit one integer
        key = ids[:n].astype(np.int64)
        for k in range(1, size):
            key = key << bits | ids[k : n + k]
        ranked = np.sort(key)
        again = ranked[1:][ranked[1:] == ranked[:-1]]
        return _covered(key, again, len(ids), size)
    _, dense = np.unique(ids, return_inverse=True)
    key = dense[:n].astype(np.int64)
    for k in range(1, size):  # exact: window numbers are made dense again before they could overflow
        _, key = np.unique(key * (dense.max() + 1) + dense[k : n + k], return_inverse=True)
    return _covered(key, np.flatnonzero(np.bincount(key) > 1), len(ids), size)


def base(text: str, words: list[bytes], ids: np.ndarray) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    lines = [x for x in text.split("\n") if x.strip(BLANK_CHARS)]
    return len(words), len(text) - sum(map(text.count, BLANK_CHARS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated(ids)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack.compress(t.as_buffer()) if t.is_valid else None for t in batch.column(1)], pa.binary())], ["doc_id", "packed"])


def _count(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """(packed, trusted, held) -> counts of this task by bucket: of all, of the trusted, and of the trusted that are held out."""
    words, unpack = Words(), zstandard.ZstdDecompressor()
    # By kind: neither, trusted, trusted and held out. Counted once there are many.
    kinds = np.zeros(3 * n_buckets, np.int64)
    found, size = [], 0
    for batch in batches:
        for packed, good, held in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if packed.is_valid:
                ids = words.of(unpack.decompress(packed.as_py()).split())
                if len(ids):
                    found.append(buckets(words.hashes[ids], n_buckets).astype(np.int32) + np.int32(n_buckets * (2 if good and held else 1 if good else 0)))
                    size += len(found[-1])
                    if size >= COUNTED_AT_ONCE:
                        kinds += np.bincount(np.concatenate(found), minlength=len(kinds))
                        found, size = [], 0
    if found:
        kinds += np.bincount(np.concatenate(found), minlength=len(kinds))
    rest, kept, apart = kinds.reshape(3, n_buckets)
    trusted = kept + apart
    raw = rest + trusted
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(trusted[used]), pa.array(apart[used])], ["bucket", "raw", "trusted", "apart"])


def _held(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(HELD_OUT)) == 0


def _table(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not trusted.any():
        return np.zeros(len(raw), np.int64)
    share = lambda x: (x + SMOOTHING) / (x.sum() + SMOOTHING * len(x))
    return np.rint(1e6 * np.log(share(trusted) / share(raw))).astype(np.int64)


def _tables(docs: DataFrame, trusted_ids: DataFrame, id_col: str, text_col: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ratios with all trusted documents, and with those that aren't held out."""
    good = trusted_ids.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id")).distinct().withColumn("trusted", F.lit(True))
    packed = keyed_text(docs, id_col, text_col).mapInArrow(_pack, "doc_id bigint, packed binary")
    # Labels grow with the corpus: they are shuffled at every size, never broadcast.
    counts = packed.join(good.hint("shuffle_merge"), "doc_id", "left").select("packed", "trusted", _held(F.col("doc_id")).alias("held")).mapInArrow(partial(_count, n_buckets=n), "bucket int, raw bigint, trusted bigint, apart bigint")
    raw, trusted, apart = (np.zeros(n) for _ in range(3))
    for r in counts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("raw", "trusted", "apart")]).collect():
        raw[r["bucket"]], trusted[r["bucket"]], apart[r["bucket"]] = r["raw"], r["trusted"], r["apart"]
    return _table(trusted, raw), _table(trusted - apart, raw)


def ratios(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = BUCKETS) -> np.ndarray:
    """Log-likelihood ratio of each of n buckets, in millionths, from all of docs and those of them whose id is in trusted_ids.

    Only counts by bucket reach the driver, n rows at most. Without trusted
    documents all ratios are zero.
    """
    return _tables(docs, trusted_ids, id_col, text_col, n)[0]


def bucket_count(size: int) -> int:
    """For ``size`` bytes of text: a power of two."""
    return min(MOST, max(FEWEST, 1 << max(0, size // BUCKET_BYTES).bit_length() - 1)) if size >= BUCKET_BYTES else FEWEST


def best_cut(counts: list[tuple[int, int, int]]) -> int:
    """The score from which on to keep, of (score, trusted, untrusted): fewest documents misjudged (trusted ones rejected, untrusted ones kept); the lowest of equals.

    Without one of the two kinds, THRESHOLD.
    """
    good, bad = sum(c[1] for c in counts), sum(c[2] for c in counts)
    if not good or not bad:
        return THRESHOLD
    wrong, best, cut = bad, bad + 1, THRESHOLD
    for score, g, b in sorted(counts):
        if wrong < best:
            best, cut = wrong, score
        wrong += g - b
    return cut


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, int]:
    """(ratios, threshold) from docs and labels (id, trusted: boolean; an id labelled both ways is untrusted).

    The threshold comes from one in HELD_OUT of the labelled documents that
    pass the base rules, scored with ratios whose trusted counts lack them.
    Raw counts are of all documents: they know no labels. Only ids and scores
    are joined to labels, and only counts by score reach the driver.
    """
    labels = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.bool_and(F.coalesce("trusted", F.lit(False))).alias("trusted"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("bigint"))).first()[0] or 0
    full, part = _tables(docs.withColumnRenamed(id_col, "doc_id"), labels.where("trusted"), "doc_id", text_col, bucket_count(size))
    held = judge(docs.where(_held(F.col(id_col).cast("bigint"))), part, THRESHOLD, id_col, text_col).where("not base_failed").select("doc_id", (F.floor(F.col("score") / STEP) * STEP).alias("score"))
    found = held.join(labels.hint("shuffle_merge"), "doc_id").groupBy("score").agg(F.count_if("trusted").alias("good"), F.count_if(~F.col("trusted")).alias("bad"))
    return full, best_cut([(int(r["score"]), r["good"], r["bad"]) for r in found.collect()])


def judge(docs: DataFrame, table: np.ndarray, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept of every row.

    score: millionths of a nat for each n-gram, rounded down; 0 without
    words. Null texts have no words, and fail. Repeated rows give repeated
    results; other columns are ignored. No shuffle.
    """

    def make():
        words = Words()

        def work(ids: list, texts: list) -> dict:
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
            out: dict[str, list] = {"doc_id": ids} | {n: [] for n in names}
            for text in texts:
                text = text or ""
                found = text.encode().split()
                numbers = words.of(found)
                facts = base(text, found, numbers)
                failed = facts[0] < MIN_WORDS or 100 * facts[4] > MAX_REPEAT_PERCENT * facts[0]
                score = int(table[buckets(words.hashes[numbers], len(table))].sum()) // (2 * len(found) - 1) if found else 0
                for n, x in zip(names, (*facts, failed, score, not failed and score >= threshold), strict=True):
                    out[n].append(x)
            return out

        return work

    return map_texts(keyed_text(docs, id_col, text_col), make, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, score bigint, kept boolean")
