"""Token ids as Arrow stream files of equal-length sequences.

Each file holds record batches of fixed-size lists: ``ids`` and ``mask``, one
sequence a row, a set number of sequences a batch.  The buffers are not
compressed, so a memory-mapped file gives any sequence without a copy.  Ids run
on from document to document in ascending doc_id order, through all files; each
file starts a new sequence, and the mask is false where its last one is filled
up.  A second stream beside each file lists its documents.

Files are written under another name and renamed, so a task that is repeated
after a lost executor leaves whole files only.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockside.llm.common import row_key, settled, tokenizer_path, whole_text
from dockside.llm.encoding import text_encoder

SEQUENCE = 2048
SEQUENCES_A_BATCH = 64
INDEX_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "file string, part int, n_docs bigint, n_tokens bigint"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; a plain path is local."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "", 1))


def id_type(vocabulary: int) -> np.dtype:
    """The narrowest of the two unsigned types that holds all ids."""
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def sequence_schema(kind: np.dtype, sequence: int) -> pa.Schema:
    number = pa.uint16() if kind.itemsize == 2 else pa.uint32()
    return pa.schema([("ids", pa.list_(number, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


class SequenceFile:
    """Collects ids and writes whole batches; holds one batch at a time."""

    def __init__(self, sink, kind: np.dtype, sequence: int, a_batch: int):
        self.schema = sequence_schema(kind, sequence)
        self.kind, self.sequence, self.a_batch = kind, sequence, a_batch
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.total += len(ids)
        if self.n_held >= self.sequence * self.a_batch:
            self.flush(whole=True)

    def flush(self, whole: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, self.kind)
        size = self.sequence * self.a_batch
        take = len(ids) // size * size if whole else len(ids)
        for at in range(0, take, size):
            self.write(ids[at : min(at + size, take)])
        self.held, self.n_held = [ids[take:]], len(ids) - take

    def write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.sequence)
        filled = np.zeros(rows * self.sequence, self.kind)
        filled[: len(ids)] = ids
        mask = np.arange(rows * self.sequence) < len(ids)
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.sequence) for values in (filled, mask)
        ]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        self.flush(whole=False)
        self.writer.close()


def write_sequences(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 1,
    sequence: int = SEQUENCE,
    a_batch: int = SEQUENCES_A_BATCH,
) -> DataFrame:
    """Write all documents' ids; returns the manifest, one row per file.

    ``folder`` is one that all executors share.  A missing text counts as empty
    and leaves its end id; documents without an id come first; an empty table
    gives no file.  Rows are dealt by ranges of doc_id and, where many rows
    share one, of their content, so no id becomes one task's.
    """
    spark = documents.sparkSession
    given = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    keyed = given.withColumn("_key", row_key("doc_id", "text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(parts, "doc_id", "_key").sortWithinPartitions("doc_id", "_key")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = text_encoder(tokenizer_path(tokenizer))
        kind = id_type(encoder.vocabulary)
        part = TaskContext.get().partitionId()
        place, base = file_system(folder)
        place.create_dir(base, recursive=True)
        name, mark = f"{base}/part-{part:06d}", uuid.uuid4().hex
        out = None
        n_docs = 0
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                sink = place.open_output_stream(f"{name}.{mark}.ids")
                out = SequenceFile(sink, kind, sequence, a_batch)
                index_sink = place.open_output_stream(f"{name}.{mark}.index")
                index = pa.ipc.new_stream(index_sink, INDEX_SCHEMA)
            starts, lengths = [], []
            for ids in encoder.encode(batch["text"].tolist()):
                starts.append(out.total)
                lengths.append(len(ids) + 1)
                out.add(np.append(ids, np.uint32(end_id)).astype(kind))
            columns = [pa.array(batch["doc_id"], pa.int64(), from_pandas=True), pa.array(starts), pa.array(lengths)]
            index.write_batch(pa.record_batch(columns, schema=INDEX_SCHEMA))
            n_docs += len(batch)
        if out is not None:
            out.close()
            index.close()
            sink.close()
            index_sink.close()
            place.move(f"{name}.{mark}.index", f"{name}.index")
            place.move(f"{name}.{mark}.ids", f"{name}.ids")
            row = {"file": f"{folder}/part-{part:06d}", "part": part, "n_docs": n_docs, "n_tokens": out.total}
            yield pd.DataFrame([row])

    return settled(ordered.select("doc_id", "text").mapInPandas(write, MANIFEST), "manifest")


def read_index(name: str) -> pa.Table:
    place, path = file_system(f"{name}.index")
    with place.open_input_stream(path) as source:
        return pa.ipc.open_stream(source).read_all()


class TokenFile:
    """Random access to the sequences of one file, without copies where it is local."""

    def __init__(self, name: str):
        place, path = file_system(f"{name}.ids")
        local = isinstance(place, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else place.open_input_file(path)
        self.table = pa.ipc.open_stream(self.source).read_all()

    def __len__(self) -> int:
        return self.table.num_rows

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of one sequence."""
        at = row
        for chunk_ids, chunk_mask in zip(self.table["ids"].chunks, self.table["mask"].chunks, strict=True):
            if at < len(chunk_ids):
                width = chunk_ids.type.list_size
                ids = chunk_ids.values.slice(at * width, width).to_numpy(zero_copy_only=True)
                return ids, chunk_mask.values.slice(at * width, width).to_numpy(zero_copy_only=False)
            at -= len(chunk_ids)
        raise IndexError(row)

    def spans(self, starts: list[int], lengths: list[int]) -> Iterator[np.ndarray]:
        """Ids at ascending places; only the batches that a span touches are joined."""
        chunks = [c.values.to_numpy(zero_copy_only=True) for c in self.table["ids"].chunks]
        ends = np.cumsum([len(c) for c in chunks])
        for start, length in zip(starts, lengths, strict=True):
            k = int(np.searchsorted(ends, start, side="right"))
            parts, at = [], start - (int(ends[k - 1]) if k else 0)
            while length > 0:
                part = chunks[k][at : at + length]
                parts.append(part)
                length -= len(part)
                k, at = k + 1, 0
            yield parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files."""
    spark = manifest.sparkSession
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: the number of shuffle partitions bounds it.
    placed = manifest.withColumn("_base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, base in zip(batch["file"], batch["_base"], strict=True):
                index = read_index(name)
                starts, lengths = index["start"].to_pylist(), index["n_tokens"].to_pylist()
                sums = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in TokenFile(name).spans(starts, lengths)]
                yield pd.DataFrame(
                    {
                        "doc_id": index["doc_id"].to_pandas().astype("Int64"),
                        "start": np.array(starts, dtype=np.int64) + base,
                        "n_tokens": lengths,
                        "ids_crc32": sums,
                    }
                )

    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.select("file", "_base").repartition(files, "file")
    return dealt.mapInPandas(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
