"""Token files: Arrow streams of fixed-size lists, one pair of files per range of documents.

A shard has a stream of equal-length sequences (`ids` and `mask`, fixed-size lists, the same
number of rows in every batch but the last) and a stream of its documents (id, start, length), as
the end id may also occur inside a text. Sequences follow each other without gaps; only a shard's
last sequence is padded, with the mask false. A local file is memory-mapped and read without a copy.

Tasks write under names of their own attempt; the manifest, a table that Spark commits, names the
files that count, so a lost or repeated task leaves at most files that nobody reads.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendmill.llm import arrays, runtime, tokens
from lendmill.session import shared_path

SEQUENCE = 2048
ROWS_PER_BATCH = 128
MANIFEST = "shard long, ids_path string, docs_path string, n_docs long, n_ids long"


def in_id_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in range partitions of ascending doc_id, each sorted; equal ids by text, nulls first."""
    return (
        docs.select("doc_id", docs["text"].cast("string").alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    )


class _IdWriter:
    def __init__(self, sink, length: int, kind: pa.DataType):
        self.length, self.kind, self.held, self.n = length, kind, [], 0
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.batch = length * ROWS_PER_BATCH

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n += len(ids)
        if self.n >= self.batch:
            whole = np.concatenate(self.held)
            full = len(whole) // self.batch * self.batch
            for a in range(0, full, self.batch):
                self._write(whole[a : a + self.batch], self.batch)
            self.held, self.n = [whole[full:]], len(whole) - full

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(v, t), self.length) for v, t in ((ids, self.kind), (mask, pa.bool_()))]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.n:
            rest = np.concatenate(self.held)
            padded = np.zeros(-(-len(rest) // self.length) * self.length, rest.dtype)
            padded[: len(rest)] = rest
            self._write(padded, len(rest))
        self.writer.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int = 2, sequence: int = SEQUENCE, id_type: str = "uint16"
) -> DataFrame:
    """Write the documents' ids under `folder` in ascending doc_id order; returns the manifest.

    A null text counts as empty and has its end id only; null ids come first; rows with equal ids
    follow each other by text; an empty table gives an empty manifest. `id_type` must hold the
    vocabulary, or it is an error. Columns besides doc_id and text are ignored.
    """
    spark = docs.sparkSession
    runtime.prepare(spark)
    path = tokenizer_path or tokens.default_path()
    kind = pa.type_for_alias(id_type)
    largest = max(len(tokens.encoder(path, end_id).ends_word) - 1, end_id)
    if largest > np.iinfo(kind.to_pandas_dtype()).max:
        raise ValueError(f"ids up to {largest} do not fit {id_type}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path, end_id)
        task = TaskContext.get()
        shard, name = task.partitionId(), f"shard-{task.partitionId():07d}-{task.taskAttemptId()}"
        store, root = pafs.FileSystem.from_uri(folder)
        ids_out = docs_out = None
        n_docs = n_ids = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if ids_out is None:
                store.create_dir(root, recursive=True)
                ids_file, docs_file = store.open_output_stream(f"{root}/{name}.ids.arrows"), store.open_output_stream(f"{root}/{name}.docs.arrows")
                ids_out = _IdWriter(ids_file, sequence, kind)
                docs_schema = pa.schema([("doc_id", batch.schema.field(0).type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                docs_out = pa.ipc.new_stream(docs_file, docs_schema)
            lengths = []
            for _, ids in encoder.documents(arrays.text_array(batch.column(1))):
                ids_out.add(ids.astype(kind.to_pandas_dtype()))
                lengths.append(len(ids))
            sizes = np.array(lengths, np.int64)
            docs_out.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_ids + np.cumsum(sizes) - sizes), pa.array(sizes)], schema=docs_schema))
            n_docs, n_ids = n_docs + len(sizes), n_ids + int(sizes.sum())
        if ids_out is not None:
            ids_out.close()
            docs_out.close()
            ids_file.close()
            docs_file.close()
            row = [[shard], [f"{folder}/{name}.ids.arrows"], [f"{folder}/{name}.docs.arrows"], [n_docs], [n_ids]]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in row], ["shard", "ids_path", "docs_path", "n_docs", "n_ids"])

    table = f"{folder}/manifest"
    in_id_order(docs).mapInArrow(write, MANIFEST).write.parquet(table)
    return spark.read.schema(MANIFEST).parquet(table)


def _open(uri: str):
    store, path = pafs.FileSystem.from_uri(uri)
    return pa.memory_map(path) if isinstance(store, pafs.LocalFileSystem) else store.open_input_file(path)


class TokenFile:
    """Random access to the sequences of one local ids file: numpy views into the mapped file."""

    def __init__(self, uri: str):
        self.batches = list(pa.ipc.open_stream(_open(uri)))
        self.rows = self.batches[0].num_rows if self.batches else 1

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        batch = self.batches[i // self.rows]
        ids, mask = (batch.column(c).slice(i % self.rows, 1).flatten() for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)


def _documents_of(ids_uri: str, docs_uri: str) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """The document batches of a shard with the crc32 of each document's ids, both files read once in order."""
    chunks = (b.column(0).flatten().to_numpy(zero_copy_only=True) for b in pa.ipc.open_stream(_open(ids_uri)))
    chunk = np.zeros(0, np.uint32)
    for batch in pa.ipc.open_stream(_open(docs_uri)):
        sums = []
        for left in batch.column(2).to_pylist():
            crc = 0
            while left:
                if not len(chunk):
                    chunk = next(chunks)
                crc = zlib.crc32(chunk[:left].astype("<u4"), crc)
                left, chunk = left - min(left, len(chunk)), chunk[left:]
            sums.append(crc)
        yield batch, sums


def read_documents(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    runtime.prepare(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                for batch, sums in _documents_of(row["ids_path"], row["docs_path"]):
                    start = pa.array(batch.column(1).to_numpy() + row["before"])
                    yield pa.RecordBatch.from_arrays([batch.column(0), start, batch.column(2), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row per shard; the running total is over the manifest only
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("ids_path", "docs_path", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.repartition(max(1, manifest.count())).mapInArrow(read, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def round_trip(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Write the token files to the shared folder and return what reading them gives."""
    manifest = write_token_files(docs, shared_path(spark, "token-files"), **options)
    return read_documents(manifest, docs.schema["doc_id"].dataType.simpleString())
