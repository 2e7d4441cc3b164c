"""Token ids of documents in entropy-coded files, written and read in parallel.

Documents are tokenized where they lie; ids are then dealt by ranges of the
document id and sorted, and every task codes its range into independent blocks
of whole documents (see :mod:`cardfeat.llm.rans`). ``tables`` holds the shared
frequency table of all ids, ``blocks`` one row per block with its range number
and the ids before it in that range, so that the place of every document
follows from the sizes of the ranges alone.

Null texts count as empty; every document ends with ``end`` (0). Rows without
id come first; rows that repeat an id follow each other in the order of a hash
of their ids, and equal rows are interchangeable. A hot id is dealt over many
ranges. An empty table gives files without blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardfeat.llm import rans
from cardfeat.llm.tables import small_batches
from cardfeat.llm.tokens import Encoder
from cardfeat.session import stage

END = 0
#: Ids after which a block is closed.
BLOCK_IDS = 1 << 19

_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The encoder of this worker; it keeps what it has learnt from one task to the next."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenized(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id`` and ``ids`` with the end id, as 2-byte numbers (little-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            for first, ids, offsets in encoder.encode_column(batch.column(1)):
                if len(ids) and ids.max() > 0xFFFF:
                    raise ValueError("ids above 65535 do not fit")
                n = len(offsets) - 1
                ids = np.insert(ids, offsets[1:], END).astype("<u2")
                offsets = (offsets + np.arange(n + 1)) * 2
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), binary.cast(pa.binary())], ["doc_id", "ids"])

    rows = small_batches(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary")


def count_ids(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), dtype="<u2"), minlength=1 << 16)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    # at most 65,536 rows
    found = tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << 16, dtype=np.int64)
    counts[found["id"].to_numpy()] = found["n"].to_numpy()
    return counts


def write_tokens(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the documents' token files to ``path`` (a new folder that all executors see)."""
    spark = docs.sparkSession
    tokens = stage(tokenized(docs, tokenizer, key, text), "tokens")
    table = rans.table(count_ids(tokens))
    spark.createDataFrame([(rans.SCALE, bytearray(table.to_bytes()))], "scale int, frequencies binary").write.parquet(f"{path}/tables")
    shared = spark.sparkContext.broadcast(table.to_bytes())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = rans.Table.from_bytes(shared.value)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        docs_, sizes, ids, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            raw = rans.encode(docs_, sizes, np.concatenate(ids).astype(np.int64), freq)
            row = [[part], [seq], [before], [held], [raw]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "seq", "before", "n", "block"])

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(raw.as_buffer(), dtype="<u2")
                docs_.append(doc)
                sizes.append(len(values))
                ids.append(values)
                held += len(values)
                if held >= BLOCK_IDS:
                    yield block()
                    seq, before = seq + 1, before + held
                    docs_, sizes, ids, held = [], [], [], 0
        if docs_:
            yield block()

    # the last key only deals out equal rows, which are interchangeable
    keyed = tokens.select("doc_id", "ids", F.xxhash64("ids").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    ordered = keyed.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_hash", "_row")
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_hash", "_row").select("doc_id", "ids")
    ordered.mapInArrow(blocks, "part int, seq int, before bigint, n bigint, block binary").write.parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' documents: ``doc_id``, ``start`` (ids of all documents before) and ``ids`` (4-byte numbers, little-endian)."""
    table = bytes(spark.read.schema("scale int, frequencies binary").parquet(f"{path}/tables").first()["frequencies"])
    files = spark.read.schema("part int, seq int, before bigint, n bigint, block binary").parquet(f"{path}/blocks")
    # one row per range of the writer
    sizes = files.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for row in sizes:
        starts[row["part"]] = total
        total += row["n"]
    shared = spark.sparkContext.broadcast((table, starts))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw_table, begins = shared.value
        freq = rans.Table.from_bytes(raw_table)
        for batch in batches:
            for part, before, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                block, ids = rans.decode(raw.as_py(), freq)
                ends = np.cumsum(block.sizes)
                begin = begins[part] + before
                offsets = np.concatenate(([0], ends)).astype(np.int32) * 4
                values = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.docs, pa.int64()), pa.array(begin + ends - block.sizes, pa.int64()), values], ["doc_id", "start", "ids"]
                )

    return files.select("part", "before", "block").mapInArrow(read, "doc_id bigint, start bigint, ids binary")


def token_digests(tokens: DataFrame) -> DataFrame:
    """Per document of :func:`read_tokens` its place, number of ids and checksum."""
    return tokens.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
