"""Token ids as flat binary files that training jobs map into memory.

The documents stand in ascending order of doc_id (null first), dealt to files by ranges.  A folder holds, for
each file of the manifest,

* ``<name>.bin``: the ids of its documents end to end, each document closed by the end id, as little-endian
  unsigned integers of 16 bits if the vocabulary fits, else 32;
* ``<name>.idx``: 64-bit little-endian offsets into it, one more than it has documents;
* ``<name>.docs.arrow``: the doc_ids, an Arrow file.

``manifest`` (Parquet) lists file, documents, ids, and by prefix sums over the files how many ids and
documents stand before each (``id_base``, ``doc_base``).  A task names its files anew at each attempt and only
the attempt that Spark accepts gets in the manifest, so lost executors and repeated tasks leave nothing
wrong behind, at most files that no manifest names.

Rows with equal doc_id stand in the order in which they are read, and may be split over files.  Null text
counts as empty: the end id alone.  An empty table gives an empty manifest.  Only ``doc_id`` and ``text`` are
read.  A task holds one slice of documents at a time, whatever its file's size.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices
from .packing import _encoder
from .ranks import partitions


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path there."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), unquote(urlparse(path).path) if path.startswith("file:") else path
    return fs.FileSystem.from_uri(path)


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def write(docs: DataFrame, folder: str, path: str, ranks_path: str | None = None, pattern: str | None = None, end_id: int = 0,
          files: int | None = None) -> DataFrame:
    """Encode the documents into ``folder`` (any store that pyarrow opens) and return the manifest.

    ``files``: how many ranges of doc_id to cut, by default as many as ``docs`` has partitions or a shuffle has.
    """
    spark = docs.sparkSession
    doc_id_type = docs.schema["doc_id"].dataType.simpleString()
    bare = docs.select("doc_id", "text").withColumn("_read", F.monotonically_increasing_id())
    order = ["doc_id", "_read"]     # _read splits a doc_id that very many rows share
    dealt = bare.repartitionByRange(files or partitions(docs), *order).sortWithinPartitions(*order).drop("_read")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = _encoder(path, ranks_path, pattern), TaskContext.get().partitionId()
        name = f"part-{place:06}-{uuid.uuid4().hex[:12]}"
        store, root = _store(folder)
        kind = id_type(encoder.slow.get_vocab_size(with_added_tokens=True))
        n_docs = n_ids = 0
        ids_file = offsets_file = docs_file = docs_sink = None
        for batch in slices(batches):
            if ids_file is None:
                store.create_dir(root, recursive=True)
                ids_file, offsets_file, docs_sink = (store.open_output_stream(f"{root}/{name}.{x}") for x in ("bin", "idx", "docs.arrow"))
                docs_file = pa.ipc.new_file(docs_sink, pa.schema([batch.schema.field(0)]))
                offsets_file.write(np.zeros(1, "<u8").tobytes())
            ends = []
            for text in batch.column(1):
                ids = np.append(encoder.ids(text.as_py() or ""), end_id).astype(kind)
                ids_file.write(ids.tobytes())
                n_ids += len(ids)
                ends.append(n_ids)
            offsets_file.write(np.array(ends, "<u8").tobytes())
            docs_file.write_batch(batch.select([0]))
            n_docs += batch.num_rows
        if n_docs:
            for f in (docs_file, docs_sink, ids_file, offsets_file):
                f.close()
            yield pa.RecordBatch.from_pylist([{"place": place, "file": name, "n_docs": n_docs, "n_ids": n_ids, "id_bits": kind.itemsize * 8}],
                                             pa.schema([("place", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                                                        ("id_bits", pa.int32())]))

    written = dealt.mapInArrow(run, "place long, file string, n_docs long, n_ids long, id_bits int")
    written.write.parquet(f"{folder}/written")      # the one run that counts
    # ranges ascend with the task's number; one row a file
    earlier = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast("long")
    listed = spark.read.parquet(f"{folder}/written")
    listed.select("place", "file", "n_docs", "n_ids", "id_bits", before("n_ids").alias("id_base"), before("n_docs").alias("doc_base"),
                  F.lit(doc_id_type).alias("doc_id_type")).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def mapped(folder: str, name: str, kind: str | np.dtype) -> np.ndarray:
    """A file as an array: mapped into memory if the store is a mounted one, else fetched."""
    store, root = _store(folder)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(f"{root}/{name}", kind, "r")
    with store.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read(), kind)


class TokenFile:
    """One file of the folder, for random access: ``ids(i)`` are those of its i-th document."""

    def __init__(self, folder: str, name: str, id_bits: int):
        self.all_ids, self.offsets = mapped(folder, f"{name}.bin", f"<u{id_bits // 8}"), mapped(folder, f"{name}.idx", "<u8")
        store, root = _store(folder)
        where = f"{root}/{name}.docs.arrow"
        self.docs = pa.ipc.open_file(pa.memory_map(where) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(where))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def ids(self, i: int) -> np.ndarray:
        return self.all_ids[int(self.offsets[i]):int(self.offsets[i + 1])]


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, doc_place, start, n_tokens, ids_crc32 (and the ids) of every document, from the files alone."""
    listed = manifest(spark, folder)
    first = listed.select("doc_id_type").first()
    kind = first.doc_id_type if first else "long"
    files = listed.select("file", "id_bits", "id_base", "doc_base").repartitionByRange(max(1, listed.count()), "doc_base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, place = TokenFile(folder, row["file"], row["id_bits"]), 0
                for k in range(held.docs.num_record_batches):
                    doc_ids = held.docs.get_batch(k).column(0)
                    at = range(place, place + len(doc_ids))
                    offsets = held.offsets[place:place + len(doc_ids) + 1].astype(np.int64)
                    crc = [zlib.crc32(held.ids(i).astype("<u4").tobytes()) for i in at]
                    columns = [doc_ids, pa.array(np.array(at) + row["doc_base"], pa.int64()), pa.array(offsets[:-1] + row["id_base"]),
                               pa.array(np.diff(offsets)), pa.array(crc, pa.int64())]
                    if with_ids:
                        columns.append(pa.array([held.ids(i).astype(np.int64) for i in at], pa.list_(pa.int64())))
                    place += len(doc_ids)
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_place", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    return files.mapInArrow(run, f"doc_id {kind}, doc_place long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
