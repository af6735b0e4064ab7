"""Byte-for-byte copies of files by Spark tasks.

Each task copies whole files in chunks and returns their sizes and SHA-256, so no
file passes through the driver, which handles a row a file.  An attempt writes a file
of its own; the driver takes the one that the finished task names, so a task that
is run again, or twice at a time, leaves nothing half written in the result.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession

from ..session import file_system

CHUNK = 8 << 20
MANIFEST = "source string, name string, size bigint, sha256 string, attempt string"


def file_copier(chunk: int = CHUNK):
    """A function (source, target) → (size, SHA-256) that copies one file through its store.

    It goes to the tasks by value: workers need not have this package.
    """

    def copy(source: str, target: str) -> tuple[int, str]:
        from pyarrow.fs import FileSystem

        (a, src), (b, dst) = FileSystem.from_uri(source), FileSystem.from_uri(target)
        size, digest = 0, hashlib.sha256()
        with a.open_input_stream(src, compression=None) as r, b.open_output_stream(dst, compression=None) as w:
            while part := r.read(chunk):
                w.write(part)
                digest.update(part)
                size += len(part)
        return size, digest.hexdigest()

    return copy


def _files(fs, path) -> dict[str, tuple[str, int]]:
    """Data files of a folder, or the file itself: name → (URI, size)."""
    status = fs.getFileStatus(path)
    found = [status] if status.isFile() else [s for s in fs.listStatus(path)]
    out = {}
    for s in found:
        name = s.getPath().getName()
        if s.isFile() and not name.startswith(("_", ".")):
            out[name] = (s.getPath().toUri().toString(), s.getLen())
        elif s.isDirectory() and not name.startswith(("_", ".")):
            out |= {f"{name}/{k}": v for k, v in _files(fs, s.getPath()).items()}
    return out


def copy_tree(spark: SparkSession, source: str, target: str) -> list[dict]:
    """Make ``target`` a copy of the file or folder ``source``: names, order and bytes.

    Returns the manifest (source, name, size, sha256), sorted by name.  Copies are made
    in a hidden folder beside the target and checked against the listed sizes; the
    target is then put in place by a rename.  Names that start with ``_`` or ``.`` are not
    data and are left out.
    """
    fs, p = file_system(spark, source)
    p = fs.makeQualified(p)
    single = fs.getFileStatus(p).isFile()
    files = _files(fs, p)
    to_fs, t = file_system(spark, target)
    t = to_fs.makeQualified(t)
    work = f"{t.getParent().toUri().toString()}/_copy-{uuid.uuid4().hex}"
    to_fs.mkdirs(file_system(spark, f"{work}/attempts")[1])
    copy = file_copier()

    def run(batches):
        task = TaskContext.get().taskAttemptId()
        for b in batches:
            rows = []
            for name, uri in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                attempt = f"{work}/attempts/{task}-{uuid.uuid4().hex}"
                rows.append((uri, name, *copy(uri, attempt), attempt))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, x) for c, x in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.string(),
                                                             pa.string()))],
                names=["source", "name", "size", "sha256", "attempt"])

    n = min(max(1, len(files)), 16 * spark.sparkContext.defaultParallelism)
    todo = spark.createDataFrame([(k, v[0]) for k, v in files.items()], "name string, uri string")
    done = todo.repartition(n, "name").mapInArrow(run, MANIFEST).collect()  # a row a file
    if {r["name"]: r["size"] for r in done} != {k: v[1] for k, v in files.items()}:
        to_fs.delete(file_system(spark, work)[1], True)
        raise OSError(f"{source} changed while it was copied")
    whole = file_system(spark, f"{work}/whole")[1]
    if not single:
        to_fs.mkdirs(whole)
    for r in done:
        at = whole if single else file_system(spark, f"{work}/whole/{r['name']}")[1]
        to_fs.mkdirs(at.getParent())
        if not to_fs.rename(file_system(spark, r["attempt"])[1], at):
            raise OSError(f"can't move {r['attempt']}")
    old = file_system(spark, f"{work}/old")[1]
    if to_fs.exists(t) and not to_fs.rename(t, old):
        raise OSError(f"can't move {target} aside")
    if not to_fs.rename(whole, t):
        to_fs.rename(old, t)  # the copy of before stays
        raise OSError(f"can't move the copy to {target}")
    to_fs.delete(file_system(spark, work)[1], True)
    return sorted(({k: r[k] for k in ("source", "name", "size", "sha256")} for r in done), key=lambda r: r["name"])
