"""Token ids as length-delimited binary records with masked checksums and an offset index.

A data file is a run of records: length (u64), masked crc32 of those 8 bytes (u32), payload, masked crc32
of the payload (u32), all little-endian. The payload is a flag (1 byte; bit 0: the id is there, bit 1: wide
ids), the document's id (i64) and its token ids (u16 each, or u32 if one doesn't fit). Its index file holds, for each record, the record's byte offset
and the number of token ids before it in the file (u64 each), so records can be read in any order.
The mask rotates a crc right by 15 bits and adds 0xA282EAD8, as record formats do that may be nested.

Documents are range-partitioned by id on the raw table, sorted in each partition and written by the task
that encodes them, which begins another file after ``ROLL`` bytes; each attempt writes files of its own names, and only those named by the attempt that
Spark accepts are in the manifest, so a repeated or speculative task does no harm. The reader seeks by the
index, ``CHUNK`` bytes at a time, and checks every length, checksum and index entry.

Defined cases: null or empty text is the end id alone; null ids come first; rows that repeat an id are
ordered by a hash of their text; an empty table gives no file and an empty result.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, long_ids, materialize, slots, texts_by_id
from .encoding import encoder

MASK_DELTA = 0xA282EAD8
#: Bytes after which a task begins its next file, and that a reader takes at once.
ROLL, CHUNK = 256 << 20, 16 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def record(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
    payload = struct.pack("<Bq", (doc_id is not None) + 2 * wide, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def read_record(data, at: int) -> tuple[int | None, np.ndarray, int]:
    """The id, the token ids and the place after the record at ``at``; ValueError if anything is damaged."""
    size = bytes(data[at : at + 8])
    if len(size) < 8 or struct.unpack_from("<I", data, at + 8)[0] != masked(size):
        raise ValueError(f"damaged record length at {at}")
    n = struct.unpack("<Q", size)[0]
    payload = data[at + 12 : at + 12 + n]
    if len(payload) < n or struct.unpack_from("<I", data, at + 12 + n)[0] != masked(payload):
        raise ValueError(f"damaged record at {at}")
    flags, doc_id = struct.unpack_from("<Bq", payload)
    return doc_id if flags & 1 else None, np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9).astype("<u4"), at + 16 + n


def file_system(uri: str):
    """pyarrow's file system and path of a folder, local path or URI."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))
    return fs.LocalFileSystem(), uri


def write(docs: DataFrame, path: str, end_id: int, folder: str, roll: int = ROLL) -> DataFrame:
    """Write files of about ``roll`` bytes under ``folder``; the manifest: shard, part, name, n_records, n_tokens in the order of ids."""
    end = end_id.to_bytes(4, "little")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        files, root = file_system(folder)
        files.create_dir(root, recursive=True)
        shard, made = TaskContext.get().partitionId(), []
        out, name, index, at, tokens = None, "", [], 0, 0

        def closed():
            out.close()
            with files.open_output_stream(f"{root}/{name}.idx") as f:
                f.write(np.array(index, "<u8").tobytes())
            made.append((shard, len(made), name, len(index) // 2, tokens))

        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for doc_id, ids in zip(pdf["doc_id"], enc.batch(texts)):
                if out is None:
                    name = f"shard-{shard:06d}-{len(made):06d}-{uuid.uuid4().hex[:12]}"
                    out, index, at, tokens = files.open_output_stream(f"{root}/{name}.bin", buffer_size=1 << 20), [], 0, 0
                ids += end
                data = record(None if doc_id is None else int(doc_id), np.frombuffer(ids, "<u4"))
                out.write(data)
                index += (at, tokens)
                at += len(data)
                tokens += len(ids) // 4
                if at >= roll:
                    closed()
                    out = None
        if out is not None:
            closed()
        yield pd.DataFrame(made, columns=["shard", "part", "name", "n_records", "n_tokens"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = narrow.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return texts_by_id(ordered).mapInPandas(work, "shard long, part long, name string, n_records long, n_tokens long")


def records(files, root: str, name: str, n: int, chunk: int = CHUNK) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, ids before it in the file, ids) of a file's records, read through its index, about ``chunk`` bytes at a time."""
    with files.open_input_file(f"{root}/{name}.idx") as f:
        index = np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype(np.int64)
    if len(index) != n:
        raise ValueError(f"{name}: the index has {len(index)} records, the manifest {n}")
    with files.open_input_file(f"{root}/{name}.bin") as f:
        ends = np.append(index[1:, 0], f.size())
        lo = 0
        while lo < n:
            first = int(index[lo, 0])
            hi = max(lo + 1, int(np.searchsorted(ends, first + chunk, "right")))
            data = memoryview(f.read_at(int(ends[hi - 1]) - first, first))
            for at, before in index[lo:hi].tolist():
                doc_id, ids, _ = read_record(data, at - first)
                yield doc_id, before, ids
            lo = hi


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each record, in files named by ``manifest``."""
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = file_system(folder)
        for pdf in batches:
            for name, n, base in zip(pdf["name"], pdf["n_records"], pdf["base"]):
                rows = [(None if i is None else str(i), base + start, len(ids), zlib.crc32(ids)) for i, start, ids in records(files, root, name, n)]
                yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])

    # the window leaves one partition of manifest rows; a row names a whole file, so rows are dealt out one by one
    spread = placed.repartition(4 * slots(manifest.sparkSession), F.col("shard"), F.col("part"))
    return long_ids(spread.mapInPandas(work, "doc_id string, start long, n_tokens long, ids_crc32 long"))


def round_trip(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to the shared folder and read the files back."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "records")
    manifest = materialize(write(docs, path, end_id, folder), "records-manifest")
    return read(manifest, folder)
