"""Token-ID output: shards of wavelet matrices, written and read by Spark.

Documents are range-partitioned and sorted by id; every task encodes its
documents and writes shards of whole documents, at most ``SHARD_TOKENS`` ids
each (a longer document has a shard of its own).  A shard is one row of a
Parquet table: its place in the order, its counts, and its file image (see
``wavelet``).  Spark's committer makes a retried task's output appear once,
on whatever file system the path names.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from autoscope.session import scratch_path

from . import subwords, wavelet
from . import textbytes as tb

END_ID = 1
SHARD_TOKENS = 1 << 20
SHARD_SCHEMA = "part int, shard long, n_docs long, n_tokens long, image binary"


def write_shards(docs: DataFrame, path: str, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS,
                 end_id: int = END_ID) -> None:
    """Encode ``doc_id, text`` of every row and write the shard table.

    Null and empty texts are the end id alone.  Null ids come first; rows
    with the same id are ordered by text.
    """
    file = tokenizer or subwords.default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        enc = subwords.encoder(file)
        bits = max(enc.vocab - 1, end_id).bit_length()
        part, shard = TaskContext.get().partitionId(), 0
        keys, parts, lengths, held = [], [], [], 0

        def close():
            nonlocal keys, parts, lengths, held, shard
            image = wavelet.write_image(np.concatenate(parts), keys, np.concatenate(lengths), bits)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard]), pa.array([len(keys)]), pa.array([held]),
                 pa.array([image], pa.binary())], ["part", "shard", "n_docs", "n_tokens", "image"])
            keys, parts, lengths, held, shard = [], [], [], 0, shard + 1
            return row

        for b in tb.slices(batches):
            ids, offs = enc.column(b.column("text"))
            ids = np.insert(ids, offs[1:], enc.dtype(end_id))
            n = np.diff(offs) + 1
            ends = np.cumsum(n)
            batch_keys = b.column("doc_id").to_pylist()
            at, done = 0, 0
            while at < len(batch_keys):
                fits = int(np.searchsorted(ends, done + shard_tokens - held, "right"))
                if fits <= at:
                    if held:
                        yield close()
                        continue
                    fits = at + 1
                keys += batch_keys[at:fits]
                parts.append(ids[done:ends[fits - 1]])
                lengths.append(n[at:fits])
                held += int(ends[fits - 1]) - done
                at, done = fits, int(ends[fits - 1])
        if held:
            yield close()

    ordered.mapInArrow(run, SHARD_SCHEMA).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the shard images: part, shard, doc_id, first (ids
    before it in its shard), n_tokens, ids_crc32."""

    def run(batches):
        for b in tb.slices(batches, 1):
            for part, shard, image in zip(b.column("part").to_pylist(), b.column("shard").to_pylist(), b.column("image")):
                matrix, keys, lengths = wavelet.read_image(image.as_py())
                ids = matrix.tokens().astype("<u4")
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths
                crc = [zlib.crc32(ids[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array([shard] * n, pa.int64()), pa.array(keys, pa.int64()),
                     pa.array(starts), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                    ["part", "shard", "doc_id", "first", "n_tokens", "ids_crc32"])

    return spark.read.parquet(path).select("part", "shard", "image").mapInArrow(
        run, "part int, shard long, doc_id long, first long, n_tokens long, ids_crc32 long")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, shard, base): ids in all shards before each.

    Sums within a part run in parallel; only the one row per part meets in
    one task."""
    sizes = spark.read.parquet(path).select("part", "shard", "n_tokens")
    inside = sizes.withColumn("base", F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("before", F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    return inside.join(parts, "part").select(
        "part", "shard", (F.coalesce("base", F.lit(0)) + F.coalesce("before", F.lit(0))).alias("base"))


def op3(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, from the files read
    back; an empty table gives an empty result."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, f"shards-{uuid.uuid4().hex[:12]}")
    write_shards(docs, path)
    found = read_documents(spark, path).join(shard_starts(spark, path), ["part", "shard"])
    return found.select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
