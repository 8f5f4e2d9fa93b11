"""Token-id files with random access: directly addressable codes in segments.

Code. Each id is cut into chunks of 8 bits, lowest first. Level 0 holds the
lowest chunk of every id and a bitmap telling which ids go on; level 1 holds
the next chunk of those, and so on. A rank directory (ones before every block
of 512 bits) turns "the i-th id goes on" into its place on the next level, so
any id is read by a few array accesses and no block is decoded.

A coded run of ids (little-endian): ``DAC1``, then the number of levels (u32)
and of ids (u64); then for each level its number of chunks (u64), the chunks
(u8 each), the bitmap (u8, lowest bit first, padded to 64 bytes) and the
directory (u32 for each 512 bits). The last level has no bitmap.

File. Documents in ascending doc_id order are cut into segments of whole
documents; a segment row holds (part, seq, part_start, n_ids, doc_ids,
doc_starts, code). Spark's committed Parquet output is the container, so a lost task or
executor leaves no half-written file, and any store that Spark reads will do.

Defined cases: a null or empty text is its end id alone; a null doc_id sorts
first; rows with equal doc_id follow each other in order of text; an empty
table gives a file without segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import bounded_batches, materialize, table
from tessera.llm.tokens import default_tokenizer, piece_table
from tessera.session import scratch_path

MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT_IDS = 1 << 20
PART_BYTES = 32 << 20


def encode_ids(ids: np.ndarray) -> bytes:
    """Directly addressable code of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        levels.append((rest.astype(np.uint8), more))
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    out = [MAGIC, struct.pack("<IQ", len(levels), len(ids))]
    for k, (chunks, more) in enumerate(levels):
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes()]
        if k < len(levels) - 1:
            blocks = -(-len(more) // RANK_BITS)
            bits = np.zeros(blocks * RANK_BITS, np.uint8)
            bits[:len(more)] = more
            ones = bits.reshape(blocks, RANK_BITS).sum(axis=1, dtype=np.int64)
            out += [np.packbits(bits, bitorder="little").tobytes(), (np.cumsum(ones) - ones).astype("<u4").tobytes()]
    return b"".join(out)


class Code:
    """Reader of one coded run: ``code[i]`` and ``code.all()``."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a coded run of ids")
        n_levels, self.n = struct.unpack_from("<IQ", data, 4)
        at = 16
        self.levels = []
        for k in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            chunks = np.frombuffer(data, np.uint8, n, at)
            at += n
            bitmap = rank = None
            if k < n_levels - 1:
                blocks = -(-n // RANK_BITS)
                bitmap = np.frombuffer(data, np.uint8, blocks * RANK_BITS // 8, at)
                at += len(bitmap)
                rank = np.frombuffer(data, "<u4", blocks, at)
                at += 4 * blocks
            self.levels.append((chunks, bitmap, rank))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (chunks, bitmap, rank) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            first = block * RANK_BITS // 8
            inside = int(np.bitwise_count(bitmap[first:i >> 3]).sum())
            inside += int(bitmap[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
            i = int(rank[block]) + inside
        return value

    def all(self) -> np.ndarray:
        out = np.empty(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            if bitmap is not None:
                more = np.unpackbits(bitmap, bitorder="little")[:len(chunks)].astype(bool)
                value[more] |= out << np.uint32(8)
            out = value
        return out


SEGMENT = "part int, seq int, part_start long, n_ids long, doc_ids array<long>, doc_starts array<long>, code binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("part_start", pa.int64()), ("n_ids", pa.int64()),
                     ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())), ("code", pa.binary())])


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1,
                     segment_ids: int = SEGMENT_IDS, part_bytes: int = PART_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) and write their ids in ascending doc_id order to ``path``."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_parts = 1 + int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // part_bytes

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_table(tokenizer)
        part, seq, total = TaskContext.get().partitionId(), 0, 0
        runs: list[np.ndarray] = []
        doc_ids: list = []
        lengths: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            nonlocal seq, total
            ids = np.concatenate(runs)
            size = np.concatenate(lengths)
            starts = np.cumsum(size) - size
            row = [[part], [seq], [total], [len(ids)], [[x for some in doc_ids for x in some.to_pylist()]],
                   [starts.tolist()], [encode_ids(ids)]]
            seq, total = seq + 1, total + len(ids)
            runs.clear()
            doc_ids.clear()
            lengths.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _SCHEMA)], schema=_SCHEMA)

        held = 0
        for batch in batches:
            for some in W.text_slices(batch, max_bytes=2 * segment_ids):
                raw, bounds = pieces.encode(some.column("text"))
                n = some.num_rows
                ids = np.full(len(raw) + n, end_id, np.uint32)
                ids[np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(bounds))] = raw
                runs.append(ids)
                doc_ids.append(some.column("doc_id"))
                lengths.append(np.diff(bounds) + 1)
                held += len(ids)
                if held >= segment_ids:
                    yield segment()
                    held = 0
        if runs:
            yield segment()

    (docs.repartitionByRange(n_parts, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(work, SEGMENT).write.mode("errorifexists").parquet(path))


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Segments of a token file with ``start``: how many ids of the file come before them."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    # one row per written part: as many as there are files
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a written table: Spark sees how small it is and sends it to the segments, whose codes then stay where they are
    starts = materialize(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base")))
    return (segments.join(starts, "part").withColumn("start", F.col("part_base") + F.col("part_start"))
            .drop("part_base"))


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, id) for each distinct ``position`` (counted from 0 over the whole file) that the file has.

    Segments are found by their starts, without their codes; then the asked ids of a
    segment, at most as many as it holds, are read by address. A position beyond
    the file, or a null one, gives no row.
    """
    segments = read_token_file(spark, path)
    places = materialize(segments.select("part", "seq", "start", "n_ids"))
    width = places.agg(F.max("n_ids")).first()[0] or 1
    # a segment touches two stretches of ``width`` positions at most
    spans = places.withColumn("stretch", F.explode(F.sequence(
        F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("n_ids") - 1) / width))))
    asked = (positions.select(F.col("position").cast("long").alias("position")).where("position >= 0").distinct()
             .withColumn("stretch", F.floor(F.col("position") / width)))
    found = (asked.join(spans, "stretch").where("position >= start and position < start + n_ids")
             .groupBy("part", "seq", "start").agg(F.collect_list(F.col("position")).alias("positions")))
    wanted = materialize(found)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                code = Code(row["code"])
                yield pa.RecordBatch.from_arrays([pa.array(row["positions"], pa.int64()), pa.array(
                    [code[p - row["start"]] for p in row["positions"]], pa.int64())], names=["position", "id"])

    codes = segments.select("part", "seq", "code").join(wanted, ["part", "seq"])
    return codes.select("start", "positions", "code").mapInArrow(work, "position long, id long")


def token_digests(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a token file."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = Code(batch.column("code")[i].as_py()).all()
                starts = batch.column("doc_starts")[i].values.to_numpy()
                ends = np.r_[starts[1:], len(ids)]
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values, pa.array(starts + batch.column("start")[i].as_py()),
                     pa.array(ends - starts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (segments.select("start", "doc_ids", "doc_starts", "code")
            .mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_token_file(table(spark, sf_dir, "documents"), path, default_tokenizer(), end_id=1)
    return token_digests(read_token_file(spark, path))
