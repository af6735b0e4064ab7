"""Token ids of a corpus as flat binary files.

A token folder holds, for each range of document ids, ``part-NNNNN.bin`` (the
ids of its documents one after another, unsigned 16-bit where the vocabulary
allows it, else unsigned 32-bit, little-endian, no header) and
``part-NNNNN.idx`` (int64 little-endian: the n document ids, then n + 1 token
offsets into the .bin file), and ``manifest/`` (JSON lines, one a file: name,
documents, tokens, leading null ids, item size and the bases ``doc_base`` and
``token_base``, prefix sums over the files before it).  A document's global
start is its file's ``token_base`` plus its offset.

Files are written under a name of the attempt and renamed when whole, so a
task that is run again replaces equal bytes by equal bytes.  The folder must be
one that all executors share; a store with a URI scheme is reached through
``pyarrow.fs``, a mounted or local path is memory-mapped for reading.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text
from .tokens import encoder, vocabulary_size


def _filesystem(path: str):
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
                      doc_id: str = "doc_id", text: str = "text") -> int:
    """Write all documents in ascending id order; returns the number of ids.

    Null texts count as empty; each document gets ``end_id`` appended.  Null ids
    come first; rows that repeat an id follow each other in text-hash order.
    Other columns are ignored.  An empty table gives a folder without files.
    """
    small = max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16
    item = "<u2" if small else "<u4"

    def write(batches):
        part = TaskContext.get().partitionId()
        end = np.array([end_id], item).tobytes()
        enc = encoder(tokenizer)
        fs, root = _filesystem(folder)
        attempt = uuid.uuid4().hex[:8]
        name, ids, offsets, nulls, out = f"part-{part:05d}", [], [0], 0, None
        for b in batches:
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/_{name}.{attempt}.bin")
            for i, packed in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist())):
                nulls += i is None
                ids.append(i or 0)
                out.write(np.frombuffer(packed, "<u4").astype(item).tobytes() if small else packed)
                out.write(end)
                offsets.append(offsets[-1] + len(packed) // 4 + 1)
        if out is None:
            return
        out.close()
        with fs.open_output_stream(f"{root}/_{name}.{attempt}.idx") as f:
            f.write(np.array(ids, "<i8").tobytes() + np.array(offsets, "<i8").tobytes())
        for kind in ("bin", "idx"):
            fs.move(f"{root}/_{name}.{attempt}.{kind}", f"{root}/{name}.{kind}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([name]), pa.array([len(ids)]), pa.array([offsets[-1]]),
             pa.array([nulls])], names=["part", "name", "n_docs", "n_tokens", "n_null"])

    ordered = (docs.select(F.col(doc_id).cast("long").alias("id"), clean_text(text).alias("t"))
               .repartitionByRange("id", F.xxhash64("t"))
               .sortWithinPartitions("id", F.xxhash64("t")))
    # one row a file
    files = sorted(ordered.mapInArrow(
        write, "part long, name string, n_docs long, n_tokens long, n_null long").collect())
    rows, doc_base, token_base = [], 0, 0
    for f in files:
        rows.append((f["name"], f["n_docs"], f["n_tokens"], f["n_null"], int(item[2]),
                     doc_base, token_base))
        doc_base += f["n_docs"]
        token_base += f["n_tokens"]
    (docs.sparkSession.createDataFrame(rows, MANIFEST).coalesce(1)
     .write.mode("overwrite").json(f"{folder}/manifest"))
    return token_base


MANIFEST = ("name string, n_docs long, n_tokens long, n_null long, item_bytes long, "
            "doc_base long, token_base long")


def open_tokens(folder: str, name: str, n_docs: int, item_bytes: int):
    """(document ids, offsets, ids) of one file; mapped where the path is local."""
    fs, root = _filesystem(folder)
    item = f"<u{item_bytes}"
    if isinstance(fs, pafs.LocalFileSystem):
        index = np.memmap(f"{root}/{name}.idx", "<i8", "r")
        ids = np.memmap(f"{root}/{name}.bin", item, "r")
    else:
        index = np.frombuffer(fs.open_input_file(f"{root}/{name}.idx").read(), "<i8")
        ids = np.frombuffer(fs.open_input_file(f"{root}/{name}.bin").read(), item)
    return index[:n_docs], index[n_docs:], ids


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32
    and, on request, ids (array of int)."""
    files = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def read(batches):
        for b in batches:
            for f in b.to_pylist():
                doc_ids, offsets, ids = open_tokens(folder, f["name"], f["n_docs"], f["item_bytes"])
                for lo in range(0, f["n_docs"], 4096):
                    hi = min(lo + 4096, f["n_docs"])
                    o = np.asarray(offsets[lo:hi + 1])
                    own = np.asarray(ids[o[0]:o[-1]]).astype("<u4")
                    cuts = o - o[0]
                    crc = [zlib.crc32(own[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]
                    cols = [pa.array(np.asarray(doc_ids[lo:hi]),
                                     mask=np.arange(lo, hi) < f["n_null"]),
                            pa.array(o[:-1] + f["token_base"]), pa.array(np.diff(o)),
                            pa.array(crc, pa.int64())]
                    if with_ids:
                        cols.append(pa.ListArray.from_arrays(
                            pa.array(cuts, pa.int32()), pa.array(own.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(
                        cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    # a round-robin shuffle of the manifest rows gives each task a few files
    return files.repartition(spark.sparkContext.defaultParallelism * 4).mapInArrow(read, schema)
