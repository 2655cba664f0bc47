"""Token-ID files with directly addressable codes.

An id is split into chunks of eight bits. Level 0 holds the lowest chunk of
every id, level k the k-th chunk of those ids that have one; a bitmap on each
level marks the ids that continue, and a rank directory counts the marks before
each block of bits. Token i is read by following its ranks down the levels:
nothing before or after it is decoded.

A file, little-endian:

    magic "DACS", version u32, docs u64, tokens u64, levels u32, zero u32
    doc_id i64 x docs, null flags u8 x docs, first token u64 x (docs + 1)
    per level: entries u64, chunks u8 x entries,
               bitmap u8 x ceil(entries / 8), ranks u64 x (ceil(entries / BLOCK) + 1)
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import arrow, local_uri, partitions, shared_folder, stored
from .tokens import CHARS, encoder, groups

MAGIC, VERSION, BLOCK = b"DACS", 1, 512
HEAD = struct.Struct("<4sIQQII")

#: a file is closed at the first document end after so many tokens
FILE_TOKENS = 16_000_000

SEGMENT = "part int, seq int, path string, docs long, tokens long"
DOC = "doc_id long, start long, n_tokens long, ids_crc32 long"


def pack(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file's bytes: documents in the given order, ``counts`` ids each."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest) or not levels:
        more = rest > 255
        ranks = np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else []
        levels.append([struct.pack("<Q", len(rest)), rest.astype(np.uint8).tobytes(),
                       np.packbits(more, bitorder="little").tobytes(),
                       np.concatenate([[0], np.cumsum(ranks)]).astype("<u8").tobytes()])
        rest = rest[more] >> 8
    return b"".join([
        HEAD.pack(MAGIC, VERSION, len(doc_ids), len(ids), len(levels), 0),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.concatenate([[0], np.cumsum(counts)]).astype("<u8").tobytes(),
        *(part for level in levels for part in level)])


class TokenFile:
    """Random access to one file. ``file`` has ``read_at(bytes, offset)``; only
    the header and the document table are read at first."""

    def __init__(self, file):
        self.file = file
        magic, version, docs, self.tokens, levels, _ = HEAD.unpack(file.read_at(HEAD.size, 0))
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not a token file of this version")
        at = HEAD.size
        ids = np.frombuffer(file.read_at(8 * docs, at), "<i8")
        null = np.frombuffer(file.read_at(docs, at := at + 8 * docs), np.uint8)
        self.first = np.frombuffer(file.read_at(8 * (docs + 1), at := at + docs), "<u8").astype(np.int64)
        self.doc_ids = [None if n else int(i) for i, n in zip(ids, null)]
        at += 8 * (docs + 1)
        self.levels = []
        for _ in range(levels):
            n, = struct.unpack("<Q", file.read_at(8, at))
            bits = at + 8 + n
            ranks = bits + -(-n // 8)
            self.levels.append((at + 8, bits, ranks))
            at = ranks + 8 * (-(-n // BLOCK) + 1)

    def _rank(self, level: int, i: int) -> int:
        """Continued ids among the first ``i`` of a level."""
        _, bits, ranks = self.levels[level]
        block = i // BLOCK
        n, = struct.unpack("<Q", self.file.read_at(8, ranks + 8 * block))
        if tail := i - block * BLOCK:
            got = np.frombuffer(self.file.read_at(-(-tail // 8), bits + block * BLOCK // 8), np.uint8)
            n += int(np.unpackbits(got, bitorder="little")[:tail].sum())
        return n

    def ids(self, a: int, b: int, level: int = 0) -> np.ndarray:
        """Tokens ``a`` to ``b`` (exclusive)."""
        if a >= b:
            return np.empty(0, np.uint32)
        chunks, bits, _ = self.levels[level]
        out = np.frombuffer(self.file.read_at(b - a, chunks + a), np.uint8).astype(np.uint32)
        got = np.frombuffer(self.file.read_at((b + 7) // 8 - a // 8, bits + a // 8), np.uint8)
        more = np.unpackbits(got, bitorder="little")[a % 8:a % 8 + b - a].astype(bool)
        if more.any():
            below = self._rank(level, a)
            out[more] |= self.ids(below, below + int(more.sum()), level + 1) << 8
        return out

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.first[k]), int(self.first[k + 1]))


class _Bytes:
    """``read_at`` on bytes in memory."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)

    def read_at(self, n: int, at: int) -> memoryview:
        return self.data[at:at + n]


def open_file(path: str):
    """A file of the store for random access; local or any file system pyarrow knows."""
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(local_uri(path))
    return TokenFile(where.open_input_file(name))


#: characters of a text that order the rows of one id
LEAD = 32


def write_store(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0,
                file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode every whole text of ``docs`` (doc_id, text), append ``end_id`` to
    each and write files in ascending doc_id order below ``path``. Eager.
    Returns one row per file: part, seq, path, docs, tokens, in file order.

    Documents are dealt by ranges of doc_id; a task writes its range in files of
    about ``file_tokens`` tokens, each first under a name of its own attempt and
    then moved to its place, so a task that runs twice leaves one whole file.
    Null texts count as empty (the end id alone); a null doc_id comes first; rows of
    one doc_id are ordered by the first ``LEAD`` characters of their texts and then by
    the texts' hash, which also deals them, so one id can fill many files; an empty
    table gives no file.
    """
    def write(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        where, folder = fs.FileSystem.from_uri(local_uri(path))
        where.create_dir(folder, recursive=True)
        enc, seq = encoder(vocabulary), 0
        doc_ids, arrays, held = [], [], 0
        end = np.array([end_id], np.uint32)

        def close():
            name = f"{folder}/ids-{part:06d}-{seq:04d}.dac"
            with where.open_output_stream(f"{name}.{attempt}") as out:
                out.write(pack(doc_ids, np.array([len(a) for a in arrays]), np.concatenate(arrays)))
            if where.get_file_info(name).type != fs.FileType.NotFound:  # an earlier attempt's, the same
                where.delete_file(name)
            where.move(f"{name}.{attempt}", name)
            row = {"part": [part], "seq": [seq], "path": [f"{path}/{name.rpartition('/')[2]}"],
                   "docs": [len(doc_ids)], "tokens": [held]}
            return pa.RecordBatch.from_pydict(row, schema)

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for at, texts in groups(batch.column("text"), CHARS):
                for k, ids in enumerate(enc.encode(texts), at):
                    doc_ids.append(keys[k])
                    arrays.append(np.concatenate([ids, end]))
                    held += len(ids) + 1
                    if held >= file_tokens:
                        yield close()
                        doc_ids, arrays, held, seq = [], [], 0, seq + 1
        if doc_ids:
            yield close()

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()),
                        ("docs", pa.int64()), ("tokens", pa.int64())])
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumns({"head": F.substr("text", F.lit(1), F.lit(LEAD)), "hash": F.xxhash64("text")})
               .repartitionByRange(partitions(docs.sparkSession), "doc_id", "head", "hash")
               .sortWithinPartitions("doc_id", "head", "hash").select("doc_id", "text"))
    return stored(arrow(ordered, write, SEGMENT), "token-files")


def with_starts(files: DataFrame) -> DataFrame:
    """``before``: tokens of all files before each. Runs within blocks of 256
    parts first and then over the blocks' sums, so no task orders all files."""
    block = F.col("part").bitwiseAND(F.lit(~255))
    own = Window.partitionBy("block").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    inner = files.withColumn("block", block)
    over = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (inner.groupBy("block").agg(F.sum("tokens").alias("t"))
            .select("block", F.coalesce(F.sum("t").over(over), F.lit(0)).alias("block_before")))
    return (inner.withColumn("own_before", F.coalesce(F.sum("tokens").over(own), F.lit(0)))
            .join(sums, "block")
            .withColumn("before", F.col("own_before") + F.col("block_before"))
            .select(*files.columns, "before"))


def read_store(files: DataFrame) -> DataFrame:
    """One row per document, read back from the files alone: doc_id, start (ids
    of all documents before it), n_tokens and ids_crc32 of its ids."""
    def read(batches):
        from pyarrow import fs

        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                where, name = fs.FileSystem.from_uri(local_uri(path))
                with where.open_input_file(name) as file:
                    f = TokenFile(_Bytes(file.read()))
                crc = [zlib.crc32(f.document(k).astype("<u4").tobytes()) for k in range(len(f.doc_ids))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.doc_ids, pa.int64()), pa.array(f.first[:-1] + before, pa.int64()),
                     pa.array(np.diff(f.first), pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = partitions(files.sparkSession)
    return arrow(with_starts(files).select("path", "before").repartition(n, "path"), read, DOC)


def token_store(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write ``docs`` to a new folder of the shared checkpoint folder and read it back."""
    spark: SparkSession = docs.sparkSession
    return read_store(write_store(docs, vocabulary, shared_folder(spark, "token-store")))
