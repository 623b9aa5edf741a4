"""Token ids in binary shards: one concatenated id array per file, document bounds in Elias-Fano form.

File: a header of eight little-endian 64-bit numbers (magic, documents, those without a document id, ids, bytes per id,
and the lengths of the three parts), then the document ids, the bounds (0, ends of all documents) and the ids. Documents
without a document id come first and have only bounds and ids. Document ids and bounds are Elias-Fano
sequences: about 2 + log2(range / count) bits each, with positions of every 256th entry for direct access.
"""

from __future__ import annotations

import posixpath
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.bpe import Encoder
from stratalake.llm.textbytes import slices, utf8
from stratalake.sources.storage import stored, work_dir

MAGIC = int.from_bytes(b"STRATOK2", "little")
HEADER = struct.Struct("<8Q")
#: Ids of one file at most, unless a single document has more.
SHARD_IDS = 16_000_000
SAMPLE = 256


class EliasFano:
    """A non-decreasing sequence of integers from `base` on, in near-minimal space."""

    _head = struct.Struct("<qQQQ")

    def __init__(self, base: int, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.base, self.count, self.low_bits = base, count, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        base = int(values[0]) if n else 0
        x = values.astype(np.uint64) - np.uint64(base % 2**64)
        span = int(x[-1]) + 1 if n else 1
        low_bits = max(0, (span // max(n, 1)).bit_length() - 1)
        places = np.arange(low_bits, dtype=np.uint64)
        low = ((x[:, None] >> places) & np.uint64(1)).astype(np.uint8)
        ones = (x >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        pack = lambda b: np.packbits(b.ravel(), bitorder="little")
        return cls(base, n, low_bits, pack(low), pack(bits), ones[::SAMPLE].astype(np.uint64))

    def to_bytes(self) -> bytes:
        head = self._head.pack(self.base, self.count, self.low_bits, len(self.high))
        return b"".join([head, self.samples.tobytes(), self.low.tobytes(), self.high.tobytes()])

    @classmethod
    def from_bytes(cls, raw: memoryview) -> EliasFano:
        base, n, low_bits, high_len = cls._head.unpack_from(raw)
        at = cls._head.size
        samples = np.frombuffer(raw, "<u8", -(-n // SAMPLE), at)
        at += samples.nbytes
        low = np.frombuffer(raw, np.uint8, -(-n * low_bits // 8), at)
        at += low.nbytes
        return cls(base, n, low_bits, low, np.frombuffer(raw, np.uint8, high_len, at), samples)

    def select(self, i: int) -> int:
        """Entry i, from the nearest sample on; reads no more than the bits between two samples."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        skip = int(np.bitwise_count(self.high[byte] & np.uint8((1 << (at % 8)) - 1)))
        left += skip
        step = 64
        while True:
            counts = np.cumsum(np.bitwise_count(self.high[byte : byte + step]), dtype=np.int64)
            if counts[-1] > left:
                inner = int(np.searchsorted(counts, left, "right"))
                left -= int(counts[inner - 1]) if inner else 0
                ones = np.flatnonzero(np.unpackbits(self.high[byte + inner : byte + inner + 1], bitorder="little"))
                position = (byte + inner) * 8 + int(ones[left])
                break
            left -= int(counts[-1])
            byte += step
        low = 0
        if self.low_bits:
            first = i * self.low_bits
            chunk = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes(), "little")
            low = (chunk >> (first % 8)) & ((1 << self.low_bits) - 1)
        return self.base + (((position - i) << self.low_bits) | low)

    def decode(self) -> np.ndarray:
        """All entries."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        x = (ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[: self.count * self.low_bits]
            places = np.arange(self.low_bits, dtype=np.uint64)
            x |= (bits.reshape(self.count, self.low_bits).astype(np.uint64) << places).sum(axis=1, dtype=np.uint64)
        return (x + np.uint64(self.base % 2**64)).astype(np.int64)


def pack_shard(doc_ids: np.ndarray, bounds: np.ndarray, ids: np.ndarray) -> bytes:
    """doc_ids are those of the last documents; the others, before them, have none."""
    width = 2 if not len(ids) or ids.max() < 2**16 else 4
    parts = [EliasFano.encode(doc_ids).to_bytes(), EliasFano.encode(bounds).to_bytes(), ids.astype(f"<u{width}").tobytes()]
    return HEADER.pack(MAGIC, len(bounds) - 1, len(bounds) - 1 - len(doc_ids), len(ids), width, *map(len, parts)) + b"".join(parts)


def unpack_shard(raw: memoryview) -> tuple[EliasFano, EliasFano, np.ndarray]:
    """(document ids, bounds, ids) of a file's bytes; nothing is copied. Documents at the front may have no document id."""
    magic, _, _, n, width, *lengths = HEADER.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a token shard")
    a = HEADER.size
    b, c = a + lengths[0], a + lengths[0] + lengths[1]
    return EliasFano.from_bytes(raw[a:b]), EliasFano.from_bytes(raw[b:c]), np.frombuffer(raw, f"<u{width}", n, c)


def _write(folder: str, tokenizer: str, end_id: int, shard_ids: int):
    def run(batches):
        encoder, store = Encoder.of(tokenizer), None
        task = TaskContext.get()
        docs, parts, ends, size, made = [], [], [], 0, 0

        def flush():
            nonlocal store, docs, parts, ends, size, made
            if store is None:
                store = fs.FileSystem.from_uri(folder)
                store[0].create_dir(store[1], recursive=True)
            name = f"tokens-{task.partitionId():06d}-{made:05d}.bin"
            # Written aside and moved, so that a task that runs twice leaves one whole file.
            path, aside = posixpath.join(store[1], name), posixpath.join(store[1], f"_{name}.{task.taskAttemptId()}")
            ids = np.concatenate(parts)
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(ends))])
            raw = pack_shard(np.concatenate(docs), bounds, ids)
            with store[0].open_output_stream(aside) as out:
                out.write(raw)
            store[0].move(aside, path)
            told = pa.RecordBatch.from_pydict(
                {"shard": [name], "n_docs": [len(bounds) - 1], "n_tokens": [len(ids)], "n_bytes": [len(raw)]}
            )
            docs, parts, ends, size, made = [], [], [], 0, made + 1
            return told

        for batch in batches:
            data, offsets = utf8(batch.column(1))
            named = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            keys = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in slices(offsets):
                ids, at = encoder.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if size and size + len(ids) > shard_ids:
                    yield flush()
                docs.append(keys[i:j][named[i:j]])  # nulls are sorted first
                parts.append(np.insert(ids, at[1:], end_id))
                ends.append(np.diff(at) + 1)
                size += len(parts[-1])
        if docs:
            yield flush()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode (doc_id, text) in ascending doc_id order into shards below `folder`; returns a row per shard.

    `folder` must be one that all executors reach, by a URI pyarrow opens. Names ascend with
    doc_id. Null texts count as empty: just the end id. Repeated doc_ids keep all their rows, ordered by text. An empty
    table writes nothing. Rows with a null doc_id come first and stay without one.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = texts.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    written = ordered.mapInArrow(
        _write(folder, tokenizer, end_id, shard_ids), "shard string, n_docs bigint, n_tokens bigint, n_bytes bigint"
    )
    return stored(written, "token-shards")


def _read(batches):
    for batch in batches:
        for shard, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            docs, bounds, tokens = unpack_shard(memoryview(raw.as_buffer()))
            at = bounds.decode()
            sums = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(at, at[1:])]
            n = len(sums)
            ids = pa.concat_arrays([pa.nulls(n - docs.count, pa.int64()), pa.array(docs.decode())])
            columns = [pa.array([shard] * n), ids, pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(sums)]
            for k in range(0, n, 50_000):
                yield pa.RecordBatch.from_arrays(
                    [c.slice(k, 50_000) for c in columns], names=["shard", "doc_id", "in_shard", "n_tokens", "ids_crc32"]
                )


def read_tokens(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """(shard, doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "tokens-*.bin").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")
    rows = files.mapInArrow(_read, "shard string, doc_id bigint, in_shard bigint, n_tokens bigint, ids_crc32 bigint")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    bases = shards.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "shard").select(
        "shard", "doc_id", (F.col("base") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokens_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the shards of `docs` to `folder` (a work folder by default) and read every document's place back."""
    spark = docs.sparkSession
    folder = folder or work_dir(spark, "tokens")
    shards = write_tokens(docs, folder, tokenizer, end_id)
    if shards.isEmpty():
        return shards.selectExpr("shard", "n_docs AS doc_id", "n_docs AS start", "n_tokens", "n_bytes AS ids_crc32")
    return read_tokens(spark, folder, shards)
