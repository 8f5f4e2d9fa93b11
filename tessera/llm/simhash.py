"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

Fingerprint. Texts are lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+``
and into runs of ``shingle`` words joined by one space, repeats included (fewer
words: the whole sequence). Bit b is set if over half of the shingles' XXH64
(seed 42) have it. A text without words, null included, has fingerprint zero
and links like any other.

Links. 64 bits are cut into ``BLOCKS`` blocks. Two fingerprints that differ in
at most 4 bits leave at least two of six blocks untouched, so they share at
least one of the 15 keys made of a pair of blocks. Each distinct fingerprint
is dealt to its 15 keys; only keys held by two or more go on. A key held by
more than ``CHUNK`` fingerprints is cut into chunks by hash and every pair of
chunks is one group, so no group exceeds about two chunks; a group emits its
links as a forest (at most one edge per member), never all pairs. Copies share
a fingerprint, so a group of copies is one row here.

Components of the links give each document the smallest doc_id reachable.

Defined cases: an empty table gives no rows; repeated rows and ties are rows of
their own with the same result; a null doc_id gets its fingerprint, is never a
component's name, and has a null component if its whole component has no
doc_id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.components import components
from tessera.llm.shared import bounded_batches, materialize, spare_name, table

SEED = 42
BITS = 64
CHUNK = 1024


def _spread_table() -> np.ndarray:
    """byte -> 64-bit word whose byte lane k counts bit k."""
    v = np.arange(256, dtype=np.uint64)
    return sum((((v >> np.uint64(k)) & np.uint64(1)) << np.uint64(8 * k) for k in range(8)), np.zeros(256, np.uint64))


_SPREAD = _spread_table()


def fingerprints_of(words: W.Words, shingle: int) -> np.ndarray:
    """Fingerprint (as int64) of each text of a word table."""
    n_texts = len(words.bounds) - 1
    lengths, n_words = words.lengths, len(words.offsets) - 1
    # the words again with one space after each, so that a shingle is one slice
    spaced = np.full(len(words.data) + n_words, 32, np.uint8)
    spaced[np.arange(len(words.data)) + np.repeat(np.arange(n_words), lengths)] = words.data
    starts = words.offsets[:-1] + np.arange(n_words)
    ends = starts + lengths
    per_text = np.diff(words.bounds)
    n_shingles = np.where(per_text >= shingle, per_text - shingle + 1, np.minimum(per_text, 1))
    first = W.expand(words.bounds[:-1], n_shingles)
    last = first + np.repeat(np.minimum(per_text, shingle), n_shingles) - 1
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[s:e], SEED) for s, e in zip(starts[first].tolist(), ends[last].tolist())),
                    dtype=np.uint64, count=len(first))
    counts = np.zeros((n_texts, BITS), np.int64)
    text = np.repeat(np.arange(n_texts), n_shingles)
    for at in range(0, len(h), 1 << 16):
        part, owner = h[at:at + (1 << 16)], text[at:at + (1 << 16)]
        lanes = _SPREAD[part.view(np.uint8).reshape(-1, 8)]
        # runs of one text, cut every 255 rows: a byte lane holds no more
        new = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        size = np.diff(np.r_[new, len(owner)])
        pieces = -(-size // 255)
        cut = np.repeat(new, pieces) + 255 * W.expand(np.zeros(len(new), np.int64), pieces)
        summed = np.add.reduceat(lanes, cut, axis=0)
        np.add.at(counts, owner[cut], summed.view(np.uint8).reshape(-1, BITS).astype(np.int64))
    bits = (2 * counts > n_shingles[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).reshape(-1)


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a long."""
    bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch):
                fp = fingerprints_of(W.split_words(part.column("text"), W.SPACES, lower=True), shingle)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(work, "doc_id long, fp long"))


def key_masks(blocks: int, shared: int) -> list[int]:
    """Bit masks of every choice of ``shared`` of ``blocks`` even blocks, as signed longs."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    out = []
    for chosen in combinations(block, shared):
        mask = sum(chosen)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, root) joining the members connected by links of at most ``distance`` bits."""
    left, a, b = fp.view(np.uint64), [], []
    while len(left) > 1:
        root, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found)
                a.append(found)
                b.append(np.full(len(found), root, np.uint64))
    none = [np.empty(0, np.uint64)]
    return np.concatenate(a or none).view(np.int64), np.concatenate(b or none).view(np.int64)


def links(fps: DataFrame, distance: int = 4, blocks: int = 6, chunk: int = CHUNK) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of ``fps`` (distinct column fp) within ``distance``."""
    if not 0 <= distance < blocks:
        raise ValueError("distance must be smaller than the number of blocks")
    masks = key_masks(blocks, blocks - distance)
    dealt = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"))
    held = dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    n_chunks = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    rows = (dealt.join(held, ["t", "key"]).withColumn("chunks", n_chunks).withColumn("c", own)
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .where("chunks = 1 or o != c")
            .withColumn("lo", F.least("c", "o")).withColumn("hi", F.greatest("c", "o")))
    groups = rows.groupBy("t", "key", "lo", "hi").agg(F.collect_list("fp").alias("fps")).select("fps")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("fps")
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(np.diff(col.offsets.to_numpy()))
            sizes = np.diff(np.r_[0, ends])
            twos = ends[sizes == 2]  # most keys hold two
            x, y = flat[twos - 1], flat[twos - 2]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= distance
            us, vs = [x[near]], [y[near]]
            for e, n in zip(ends[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                a, b = forest(flat[e - n:e], distance)
                us.append(a)
                vs.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))],
                                             names=["u", "v"])

    return groups.mapInArrow(work, "u long, v long")


def _grouped(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """(doc_id, fp, root, component_id), one row per row of ``docs``; root is one fingerprint of the component."""
    marked = materialize(fingerprints(docs, shingle))
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = materialize(components(links(nodes.select("fp"), distance)))
    of = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs`` (columns doc_id, text)."""
    return _grouped(docs, shingle, distance).drop("root")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of every component: that of its smallest doc_id; rows without a doc_id stay.

    Rows that share a doc_id but not a component are documents of their own, so several
    rows of one doc_id can stay. Of a component's rows with its smallest doc_id the
    one with the smallest fingerprint stays (any one, if several have that).
    """
    marked = _grouped(docs, shingle, distance)
    first = materialize(marked.where("doc_id = component_id").groupBy("root").agg(
        F.min("doc_id").alias("doc_id"), F.min("fp").alias("fp")).select("doc_id", "fp"))
    several = materialize(marked.where("doc_id is not null").groupBy("doc_id")
                          .agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b").select("doc_id"))
    known = docs.where("doc_id is not null")
    alone = known.join(first.join(several, "doc_id", "left_anti").select("doc_id"), "doc_id", "left_semi")
    # the few doc_ids with different fingerprints: which of their rows it is, is told by the text
    th, fp = spare_name(docs, "text_hash"), spare_name(docs, "row_fp")
    mixed = known.join(several, "doc_id", "left_semi").withColumn(th, F.xxhash64("text"))
    prints = fingerprints(mixed.select(F.col(th).alias("doc_id"), "text").dropDuplicates(["doc_id"]), shingle)
    chosen = (mixed.join(prints.select(F.col("doc_id").alias(th), F.col("fp").alias(fp)), th)
              .join(first.withColumnRenamed("fp", fp), ["doc_id", fp], "left_semi"))
    kept = alone.dropDuplicates(["doc_id"]).select(*docs.columns).unionByName(
        chosen.dropDuplicates(["doc_id", fp]).select(*docs.columns))
    return kept.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
