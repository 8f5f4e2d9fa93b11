"""Removal of word passages that an earlier document holds: fixed-block anchors, exact extension.

A window is 13 consecutive words. Any window of 13 covers a whole aligned
block of 7 of the document it was copied from, so:

1. Anchors. Every document's non-overlapping blocks of 7 words are indexed and
   every rolling window of 7 words probes the index. An anchor is a block that
   more than one document holds. Hashes are dealt to buckets; documents are
   dealt to chunks (by doc_id) and a chunk sends each bucket a hash once, so a
   passage held by a third of all documents is one entry per chunk.
2. Extension. Around its anchors a chunk takes the 13-word windows and sends
   each distinct one with its least doc_id; the bucket answers which of them
   an earlier document of another chunk starts with.
3. Removal. A word is covered if any window over it starts in a document with a
   smaller doc_id; runs of covered words are the maximal exact repeats. All
   windows are judged on the input.

Anchors are compared by 32 bits within a bucket of bounded size (a false one
only adds a candidate), windows by 64 bits within a bucket of bounded size.

Defined cases: a null text has no words; a document shorter than a window loses
nothing; rows with the same doc_id never remove words from each other; rows
without a doc_id neither remove nor lose words; every row gives a row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import materialize, release, table

WINDOW = 13
BLOCK = 7
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 6 << 20  # of text: about a million hashes a bucket
LOW = np.uint64(32)
NO_ID = np.iinfo(np.int64).max


def _ids(group: pa.Table) -> np.ndarray:
    return group.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _usable(ids: np.ndarray, words: W.Words, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` words of documents that have a doc_id."""
    ok = W.window_starts(words.bounds, size)
    return np.flatnonzero(ok & (ids[words.text_of_word()[:len(ok)]] != NO_ID))


def _by_bucket(bucket: np.ndarray, columns: list[np.ndarray]) -> tuple[list[int], list[list[bytes]]]:
    """Split parallel arrays by bucket: (buckets, one list of byte strings per array)."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    ends = np.r_[first[1:], len(order)]
    return found.tolist(), [[c[s:e].tobytes() for s, e in zip(first.tolist(), ends.tolist())]
                            for c in (x[order] for x in columns)]


def _concat(col: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(all values, index of the row each came from) of a column of packed arrays."""
    parts = [np.frombuffer(x, dtype=dtype) for x in col.to_pylist()]
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _window_hashes(words: W.Words, window: int) -> np.ndarray:
    return (W.window_hashes(W.word_hashes(words, 0), window, 0)
            ^ W.window_hashes(W.word_hashes(words, 1), window, 1))


def _anchor_probes(docs: DataFrame, block: int, n_buckets: int) -> DataFrame:
    """(bucket, chunk, hashes, flags): distinct rolling windows of a chunk; flag 1: a block, 2: in several documents."""

    def work(group: pa.Table) -> pa.Table:
        chunk = group.column("chunk")[0].as_py()
        ids = _ids(group)
        words = W.split_words(group.column("text"), W.SPACES)
        at = _usable(ids, words, block)
        text = words.text_of_word()[at]
        h = W.window_hashes(W.word_hashes(words), block)[at]
        order = np.argsort(h, kind="stable")
        h, doc = h[order], ids[text[order]]
        is_block = ((at - words.bounds[text]) % block == 0)[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
        flags = np.empty(0, np.uint8)
        if len(h):
            several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
            flags = np.logical_or.reduceat(is_block, first) + 2 * several.astype(np.uint8)
        h = h[first]
        bucket = ((h >> LOW) % np.uint64(n_buckets)).astype(np.int32)
        buckets, (hashes, marks) = _by_bucket(bucket, [h.astype(np.uint32), flags.astype(np.uint8)])
        return pa.table({"bucket": pa.array(buckets, pa.int32()), "chunk": pa.array([chunk] * len(buckets), pa.int32()),
                         "hashes": pa.array(hashes, pa.binary()), "flags": pa.array(marks, pa.binary())})

    return docs.groupBy("chunk").applyInArrow(work, "bucket int, chunk int, hashes binary, flags binary")


def _anchors(probes: DataFrame) -> DataFrame:
    """(chunk, bucket, hashes): the anchors among a chunk's windows."""

    def work(group: pa.Table) -> pa.Table:
        h, row = _concat(group.column("hashes"), np.uint32)
        flags, _ = _concat(group.column("flags"), np.uint8)
        order = np.argsort(h, kind="stable")
        hs, fs = h[order], flags[order]
        first = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]])
        held = np.diff(np.r_[first, len(hs)])
        marks = np.bitwise_or.reduceat(fs, first)
        anchor = ((marks & 1) > 0) & (((marks & 2) > 0) | (held > 1))
        hit = np.empty(len(h), bool)
        hit[order] = np.repeat(anchor, held)
        return _answers(group, h, row, hit)

    return probes.groupBy("bucket").applyInArrow(work, "chunk int, bucket int, hashes binary")


def _answers(group: pa.Table, h: np.ndarray, row: np.ndarray, hit: np.ndarray) -> pa.Table:
    bounds = np.searchsorted(row[hit], np.arange(group.num_rows + 1))
    chosen = h[hit]
    some = np.flatnonzero(np.diff(bounds))
    return pa.table({"chunk": group.column("chunk").combine_chunks().take(pa.array(some)),
                     "bucket": group.column("bucket").combine_chunks().take(pa.array(some)),
                     "hashes": pa.array([chosen[bounds[i]:bounds[i + 1]].tobytes() for i in some.tolist()], pa.binary())})


def _candidates(docs: DataFrame, anchors: DataFrame, block: int, window: int, n_buckets: int) -> DataFrame:
    """(bucket, chunk, hashes, ids): distinct windows around anchors with the chunk's least doc_id."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary())])

    def work(group: pa.Table, found: pa.Table) -> pa.Table:
        if not group.num_rows or not found.num_rows:
            return schema.empty_table()
        chunk = group.column("chunk")[0].as_py()
        ids = _ids(group)
        words = W.split_words(group.column("text"), W.SPACES)
        low, row = _concat(found.column("hashes"), np.uint32)
        bucket = found.column("bucket").to_numpy().astype(np.uint64)[row]
        known = np.sort((bucket << LOW) | low)
        h = W.window_hashes(W.word_hashes(words), block)
        key = ((h >> LOW) % np.uint64(n_buckets)) << LOW | (h & np.uint64(0xFFFFFFFF))
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        seen = np.zeros(len(h) + 1, np.int64)
        np.cumsum(known[at] == key, out=seen[1:])
        start = _usable(ids, words, window)
        start = start[seen[start + window - block + 1] > seen[start]]
        h = _window_hashes(words, window)[start]
        doc = ids[words.text_of_word()[start]]
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        first = np.r_[True, h[1:] != h[:-1]] if len(h) else np.empty(0, bool)
        h, doc = h[first], doc[first]
        bucket = ((h >> LOW) % np.uint64(n_buckets)).astype(np.int32)
        buckets, (hashes, least) = _by_bucket(bucket, [h, doc])
        return pa.table([pa.array(buckets, pa.int32()), pa.array([chunk] * len(buckets), pa.int32()),
                         pa.array(hashes, pa.binary()), pa.array(least, pa.binary())], schema=schema)

    return (docs.groupBy("chunk").cogroup(anchors.groupBy("chunk"))
            .applyInArrow(work, "bucket int, chunk int, hashes binary, ids binary"))


def _earlier(candidates: DataFrame) -> DataFrame:
    """(chunk, bucket, hashes): windows of a chunk that a smaller doc_id of another chunk starts."""

    def work(group: pa.Table) -> pa.Table:
        h, row = _concat(group.column("hashes"), np.uint64)
        ids, _ = _concat(group.column("ids"), np.int64)
        order = np.argsort(h, kind="stable")
        hs = h[order]
        first = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]])
        least = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.r_[first, len(hs)]))
        hit = np.empty(len(h), bool)
        hit[order] = least < ids[order]
        return _answers(group, h, row, hit)

    return candidates.groupBy("bucket").applyInArrow(work, "chunk int, bucket int, hashes binary")


def _removed(docs: DataFrame, earlier: DataFrame, window: int, with_text: bool) -> DataFrame:
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
              ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))] + [("kept_text", pa.string())] * with_text
    schema = pa.schema(fields)

    def work(group: pa.Table, found: pa.Table) -> pa.Table:
        if not group.num_rows:
            return schema.empty_table()
        ids = _ids(group)
        words = W.split_words(group.column("text"), W.SPACES)
        n = len(words.offsets) - 1
        start = _usable(ids, words, window)
        h = _window_hashes(words, window)[start]
        doc = ids[words.text_of_word()[start]]
        gone = np.zeros(len(h), bool)
        if found.num_rows and len(h):
            known = np.sort(_concat(found.column("hashes"), np.uint64)[0])
            gone = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
        order = np.lexsort((doc, h))
        hs, ds = h[order], doc[order]
        if len(hs):
            first = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]])
            gone[order] |= ds > np.repeat(ds[first], np.diff(np.r_[first, len(hs)]))
        change = np.zeros(n + 1, np.int64)
        change[:n] += np.bincount(start[gone], minlength=n)[:n] if n else 0
        np.subtract.at(change, start[gone] + window, 1)
        kept = np.cumsum(change)[:n] == 0
        # kept words again, one space after each
        lengths = words.lengths[kept]
        data = words.data[np.repeat(kept, words.lengths)]
        spaced = np.full(len(data) + len(lengths), 32, np.uint8)
        spaced[np.arange(len(data)) + np.repeat(np.arange(len(lengths)), lengths)] = data
        before = np.zeros(n + 1, np.int64)
        np.cumsum(np.where(kept, words.lengths + 1, 0), out=before[1:])
        at, raw = before[words.bounds].tolist(), spaced.tobytes()
        texts = [raw[s:max(s, e - 1)] for s, e in zip(at[:-1], at[1:])]
        # runs of removed words, as first word and end, within each text
        edge = np.zeros(n + 1, bool)
        edge[words.bounds] = True
        before_gone = np.r_[False, ~kept[:-1]] if n else np.empty(0, bool)
        after_gone = np.r_[~kept[1:], False] if n else np.empty(0, bool)
        first = np.flatnonzero(~kept & (edge[:n] | ~before_gone))
        last = np.flatnonzero(~kept & (edge[1:] | ~after_gone)) + 1
        base = words.bounds[:-1][words.text_of_word()[first]] if n else first
        runs = np.searchsorted(first, words.bounds)
        cols = [group.column("doc_id").combine_chunks(), pa.array(np.diff(words.bounds)),
                pa.array(np.diff(np.r_[0, np.cumsum(~kept)][words.bounds])),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                pa.ListArray.from_arrays(pa.array((2 * runs).astype(np.int32)),
                                         pa.array(np.stack([first - base, last - base], 1).reshape(-1)))]
        if with_text:
            cols.append(pa.array([t.decode() for t in texts], pa.string()))
        return pa.table(cols, schema=schema)

    kind = ("doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<long>"
            + ", kept_text string" * with_text)
    return docs.groupBy("chunk").cogroup(earlier.groupBy("chunk")).applyInArrow(work, kind)


def remove_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES,
                   bucket_bytes: int = BUCKET_BYTES, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans[, kept_text]) for every row of ``docs``.

    ``spans`` lists the removed runs as word numbers: first, end, first, end, ...
    """
    spark = docs.sparkSession
    block = (window + 1) // 2
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n_chunks, n_buckets = 1 + size // chunk_bytes, 1 + size // bucket_bytes
    owner = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    docs = docs.withColumn("chunk", F.pmod(owner, F.lit(n_chunks)).cast("int"))
    anchors = materialize(_anchors(_anchor_probes(docs, block, n_buckets)))
    release(spark)
    earlier = materialize(_earlier(_candidates(docs, anchors, block, window, n_buckets)))
    release(spark)
    return _removed(docs, earlier, window, with_text)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")
