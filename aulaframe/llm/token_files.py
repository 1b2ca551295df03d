"""Token-id files with a shared zstandard dictionary.

File format (one file per shard, little-endian throughout):

    magic b"TKZD0001" | sha256 of the dictionary (32) | id width in bytes (1)
    | one zstandard frame per document, each compressed on its own
    | index: per document id long, ids long, frame offset long, frame length int
    | number of documents long | index offset long

The dictionary is one file beside the shards, named by its hash. A reader of one
short document reads the footer, its index entry and its frame only. Shards
are range-partitioned by document id, so ascending shards hold ascending ids.
A task writes to a name of its own attempt and returns it, so what a lost or
repeated attempt left is never read.

The dictionary is trained on the id arrays of a bounded sample: the first
``SAMPLE_CHARS`` characters of ``SAMPLE_DOCS`` documents in hash order. Every
document is written whole.

Defined results: null and empty texts hold the end id only; a null id is
written first, as the smallest; repeated rows are documents of their own;
an empty table writes nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aulaframe.llm.common import cut, documents, hash_sample, input_partitions, shared_folder, shared_fs
from aulaframe.llm.tokens import DEFAULT_VOCABULARY, encoder

MAGIC, SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = b"TKZD0001", 1000, 4000, 32 << 10
NULL_ID = -(1 << 63)
_ENTRY = np.dtype([("doc", "<i8"), ("n", "<i8"), ("at", "<i8"), ("size", "<i4")])


def train_dictionary(docs: DataFrame, vocabulary: str, text: str, doc_id: str) -> bytes:
    """A dictionary from a bounded sample; raw content where the sample is too
    small to train on."""
    src = docs.select(F.substring(F.coalesce(F.col(text), F.lit("")), 1, SAMPLE_CHARS).alias("t"), F.col(doc_id).alias("i"))
    picked = hash_sample(src, SAMPLE_DOCS, "i", "t", total=docs.count()).collect()
    enc = encoder(vocabulary)
    arrays = [enc.encode(r.t.encode()).tobytes() for r in picked]
    try:
        return zstandard.train_dictionary(DICT_BYTES, [a for a in arrays if a], level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(arrays)[:DICT_BYTES]


def _write_shard(folder: str, vocabulary: str, end_id: int, dictionary: str, digest: bytes, level: int):
    def run(batches):
        enc = encoder(vocabulary)
        comp, out, index, at, name = None, None, [], len(MAGIC) + 33, ""
        for b in batches:
            for t, d in zip(b.column(0).cast(pa.binary()), b.column(1).to_pylist()):
                if out is None:
                    fs, path = shared_fs(folder)
                    with fs.open_input_file(f"{path}/{dictionary}") as f:
                        comp = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(f.read()))
                    name = f"shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tkz"
                    out = fs.open_output_stream(f"{path}/{name}")
                    out.write(MAGIC + digest + bytes([np.dtype(enc.wide).itemsize]))
                ids = np.append(enc.encode(t.as_py()), enc.wide(end_id))
                frame = comp.compress(ids.tobytes())
                out.write(frame)
                index.append((NULL_ID if d is None else d, len(ids), at, len(frame)))
                at += len(frame)
        if out is not None:
            table = np.array(index, _ENTRY)
            out.write(table.tobytes() + struct.pack("<qq", len(table), at))
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]),
                 pa.array([len(table)], pa.int64()), pa.array([int(table["n"].sum())], pa.int64())],
                ["shard", "file", "n_docs", "n_ids"])

    return run


class ShardReader:
    """Random access to one shard: ``index`` and ``ids(k)``."""

    def __init__(self, folder: str, name: str):
        fs, path = shared_fs(folder)
        self.file = fs.open_input_file(f"{path}/{name}")
        n, at = struct.unpack("<qq", self._read(self.file.size() - 16, 16))
        self.index = np.frombuffer(self._read(at, n * _ENTRY.itemsize), _ENTRY)
        head = self._read(0, len(MAGIC) + 33)
        if not head.startswith(MAGIC):
            raise ValueError(f"{name}: not a token file")
        digest = head[len(MAGIC):-1]
        with fs.open_input_file(f"{path}/{digest.hex()}.dict") as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"{name}: its dictionary has another hash")
        self.decomp = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        self.wide = np.dtype(f"<u{head[-1]}")

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, k: int) -> np.ndarray:
        e = self.index[k]
        ids = np.frombuffer(self.decomp.decompress(self._read(int(e["at"]), int(e["size"]))), self.wide)
        if len(ids) != e["n"]:
            raise ValueError("a frame has another number of ids than its index")
        return ids


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = 2, level: int = 3,
                      text: str = "text", doc_id: str = "doc_id", shards: int | None = None) -> DataFrame:
    """Writes ``docs`` in ascending id order; the manifest: shard, file,
    n_docs, n_ids."""
    dictionary = train_dictionary(docs, vocabulary, text, doc_id)
    digest = hashlib.sha256(dictionary).digest()
    fs, path = shared_fs(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/{digest.hex()}.dict") as f:
        f.write(dictionary)
    src = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(doc_id).cast("long").alias("doc_id"))
    n = shards or input_partitions(docs)
    ordered = src.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    write = _write_shard(folder, vocabulary, end_id, f"{digest.hex()}.dict", digest, level)
    return cut(ordered.mapInArrow(write, "shard int, file string, n_docs long, n_ids long"))


def read_token_files(manifest: DataFrame, folder: str, digest_only: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, and ids
    (array) or, with ``digest_only``, ids_crc32."""
    starts = manifest.withColumn("first", F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids"))

    def run(batches):
        for b in batches:
            for name, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard, at = ShardReader(folder, name), first
                for low in range(0, len(shard.index), 500):
                    rows = []
                    for k in range(low, min(low + 500, len(shard.index))):
                        ids, doc = shard.ids(k).astype("<u4"), int(shard.index["doc"][k])
                        rows.append((None if doc == NULL_ID else doc, at, len(ids),
                                     zlib.crc32(ids.tobytes()) if digest_only else ids))
                        at += len(ids)
                    cols = list(zip(*rows))
                    last = pa.int64() if digest_only else pa.list_(pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int64(), last])],
                        ["doc_id", "start", "n_tokens", "ids_crc32" if digest_only else "ids"])

    # one task for a few shards each
    spread = starts.select("file", "first").repartition(max(1, manifest.count()))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, "
                             + ("ids_crc32 long" if digest_only else "ids array<long>"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    manifest = write_token_files(documents(spark, sf_dir), folder)
    return read_token_files(manifest, folder, digest_only=True)
