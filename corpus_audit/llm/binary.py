"""Token files: one zstandard frame per document under a dictionary that all files share.

A folder holds ``dictionary`` (raw bytes), ``files/part-*.tok`` and ``manifest`` (Parquet: part, file, n_docs,
n_tokens, bytes).  A file is, all numbers little-endian::

    "TOKFILE1"  u32 header size  header (JSON: item, dictionary, end_id)
    frames, one per document, in ascending doc_id order
    index: n rows (doc_id i64, known u8, offset u64, size u32, n_tokens u64)
    u64 index offset  u64 n  "TOKINDEX"

``item`` is u16 or u32, ``dictionary`` the sha256 of the dictionary, checked before anything is decoded.  A file gets
a fresh name for every attempt of its task and counts only when the manifest lists it, so a lost executor leaves an
orphan at worst.  Files are reached through ``pyarrow.fs``, so the folder may be on any store that it knows.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpus_audit.llm.common import keyed_texts, sliced, text_bytes
from corpus_audit.llm.encoding import WordEncoder
from corpus_audit.scale import estimated_bytes

MAGIC, TAIL = b"TOKFILE1", b"TOKINDEX"
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("size", "<u4"), ("n_tokens", "<u8")])
SAMPLE_DOCS, SAMPLE_TOKENS, DICTIONARY_BYTES, LEVEL = 1000, 4096, 65536, 3

FILES = "part int, file string, n_docs long, n_tokens long, bytes long"
#: text bytes that a file holds about, and the most files that one table is cut into
FILE_BYTES, MOST_FILES, UNKNOWN = 256 << 20, 100_000, 1 << 60
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _read(uri: str) -> bytes:
    store, path = _place(uri)
    with store.open_input_stream(path) as f:
        return f.read()


def _item(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 65536 else "<u4"


def _checked(data: bytes, digest: str) -> zstandard.ZstdCompressionDict:
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError("the token file was written with another dictionary")
    return zstandard.ZstdCompressionDict(data)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from serialized id arrays; where they are too few to train on, their own bytes serve as one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def sample_ids(docs: DataFrame, tokenizer: str, item: str, n: int, tokens: int) -> list[bytes]:
    """Serialized ids of the ``n`` documents with the smallest hash, ``tokens`` ids of each at most, for training.

    Their ids and hashes are picked first, then their texts are read where they lie, so no other text moves.
    """
    rows = keyed_texts(docs).withColumn("h", F.xxhash64("doc_id", "text"))
    names = rows.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).orderBy("_h", "_id").limit(n).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    picked = rows.join(F.broadcast(names), same, "left_semi").dropDuplicates(["doc_id", "h"]).select("doc_id", "text")

    def run(batches):
        encoder = WordEncoder(tokenizer)
        for batch in sliced(batches):
            found = encoder.encode(text_bytes(batch.column(1)))
            out = [np.frombuffer(x, "<u4")[:tokens].astype(item).tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    return [bytes(r[0]) for r in picked.mapInArrow(run, "ids binary").collect() if r[0]]


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    sample_docs: int = SAMPLE_DOCS,
    sample_tokens: int = SAMPLE_TOKENS,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> None:
    """Encode every whole text, add ``end_id`` and write the ids in ascending doc_id order.

    The dictionary is fitted on ``sample_docs`` documents, ``sample_tokens`` ids of each; every document is written
    whole.  Null and empty texts hold the end id alone.  A null doc_id comes first; repeated rows and other ties are
    written once for each row, in order of text.  An empty table gives a manifest without rows.  Other columns are
    ignored.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1)
    item = _item(vocabulary)
    dictionary = train_dictionary(sample_ids(docs, tokenizer, item, sample_docs, sample_tokens), dictionary_bytes)
    store, path = _place(folder)
    store.create_dir(f"{path}/files", recursive=True)
    with store.open_output_stream(f"{path}/dictionary") as f:
        f.write(dictionary)
    digest = hashlib.sha256(dictionary).hexdigest()
    header = json.dumps({"item": item, "dictionary": digest, "end_id": end_id}).encode()

    def run(batches):
        store, path = _place(folder)
        shared = _checked(_read(f"{folder}/dictionary"), digest)
        shared.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        encoder, end = WordEncoder(tokenizer), np.array([end_id], item).tobytes()
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok"
        index, out, offset = [], None, 0
        for batch in sliced(batches):
            if out is None:
                out = store.open_output_stream(f"{path}/files/{name}")
                out.write(MAGIC + struct.pack("<I", len(header)) + header)
                offset = len(MAGIC) + 4 + len(header)
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(text_bytes(batch.column(1)))):
                data = np.frombuffer(ids, "<u4").astype(item).tobytes() + end
                frame = press.compress(data)
                out.write(frame)
                index.append((key or 0, key is not None, offset, len(frame), len(ids) // 4 + 1))
                offset += len(frame)
        if out is None:
            return
        rows = np.array(index, INDEX)
        out.write(rows.tobytes() + struct.pack("<QQ", offset, len(rows)) + TAIL)
        out.close()
        size = offset + rows.nbytes + 24
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()),
                "file": [name],
                "n_docs": [len(rows)],
                "n_tokens": [int(rows["n_tokens"].sum())],
                "bytes": [size],
            }
        )

    # as many files as the bytes ask for: a compressed byte of the scan is at most four of text; a plan of unknown size
    # keeps the session's number
    parts, size = int(spark.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(docs)
    if size < UNKNOWN:
        parts = max(parts, min(4 * size // FILE_BYTES + 1, MOST_FILES))
    ordered = keyed_texts(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, FILES).write.parquet(f"{folder}/manifest")
    # the dictionary was fitted before, so a rerun of a task writes the same frames


def _open_index(f) -> tuple[dict, np.ndarray]:
    """Header and index of an open token file, by reads of their ranges alone."""
    size = f.size()
    end = f.read_at(24, size - 24) if size >= 24 else b""
    if f.read_at(8, 0) != MAGIC or end[16:] != TAIL:
        raise ValueError("not a token file")
    at, n = struct.unpack("<QQ", end[:16])
    (width,) = struct.unpack("<I", f.read_at(4, 8))
    return json.loads(f.read_at(width, 12)), np.frombuffer(f.read_at(n * INDEX.itemsize, at), INDEX)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit), from the files."""
    manifest = spark.read.schema(FILES).parquet(f"{folder}/manifest")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))

    def run(batches):
        shared = None
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path = _place(f"{folder}/files/{name}")
                with store.open_input_file(path) as f:
                    header, index = _open_index(f)
                    shared = shared or _checked(_read(f"{folder}/dictionary"), header["dictionary"])
                    press = zstandard.ZstdDecompressor(dict_data=shared)
                    start = base + np.cumsum(index["n_tokens"].astype(np.int64)) - index["n_tokens"].astype(np.int64)
                    for k in range(0, len(index), 256):
                        rows = index[k : k + 256]
                        low = int(rows["offset"][0])  # frames of neighbours lie together: one read for all
                        data = f.read_at(int(rows["offset"][-1]) + int(rows["size"][-1]) - low, low)
                        frames = [data[int(r["offset"]) - low : int(r["offset"]) - low + int(r["size"])] for r in rows]
                        ids = [np.frombuffer(press.decompress(x), header["item"]).astype("<u4").tobytes() for x in frames]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(rows["doc_id"], pa.int64(), mask=rows["known"] == 0),
                                pa.array(start[k : k + 256]),
                                pa.array([len(x) // 4 for x in ids], pa.int64()),
                                pa.array(ids, pa.binary()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )

    n = max(1, manifest.count())
    return files.select("file", "base").repartition(n).mapInArrow(run, DOCUMENTS)


def read_document(folder: str, file: str, doc_id: int) -> list[int]:
    """Ids of one document: the index of its file is read, then its frame alone."""
    store, path = _place(f"{folder}/files/{file}")
    with store.open_input_file(path) as f:
        header, index = _open_index(f)
        own = index[(index["doc_id"] == doc_id) & (index["known"] == 1)]
        if not len(own):
            raise KeyError(doc_id)
        frame = f.read_at(int(own[0]["size"]), int(own[0]["offset"]))
    shared = _checked(_read(f"{folder}/dictionary"), header["dictionary"])
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=shared).decompress(frame), header["item"]).tolist()
