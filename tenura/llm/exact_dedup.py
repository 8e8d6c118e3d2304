"""Exact dedup over an extendible-hash index in the shared folder.

The key of a text is a 64-bit hash of its bytes after lower-casing A-Z. A directory over the leading key bits is
doubled as long as a bucket holds too many distinct keys; buckets are dealt to owner tasks. An owner walks its rows in
key order, chains the different texts of one key and compares bytes, and writes the index entries as files in the
shared folder. A hot key (more than 1/1024 of all rows) is split over several owners; one more, much smaller, walk
over the heads of their chains joins them again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import hot_keys, saved, spread, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CELL_BITS = 16

ENTRY = "key long, salt int, chain int, doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string, body string"


def key_of(body: Column, bits: int = 64) -> Column:
    """The leading `bits` bits of the hash of a text (fewer only to provoke collisions in tests)."""
    return F.shiftrightunsigned(F.xxhash64(body), 64 - bits) if bits < 64 else F.xxhash64(body)


def directory(cells: list[tuple[int, int]], bucket_keys: int, cell_bits: int = CELL_BITS) -> tuple[int, np.ndarray]:
    """Depth and directory (bucket of each pattern of that many leading bits) from (pattern of cell_bits, distinct keys).

    Starts with one bucket at depth 0. A bucket with more than `bucket_keys` keys is split by its next bit; the
    directory doubles when that bucket was as deep as the directory. The depth ends at `cell_bits`; a bucket still
    overfull there stays one and its walk is longer.
    """
    held = np.zeros((1 << cell_bits) + 1, dtype=np.int64)
    for cell, n in cells:
        held[cell + 1] += n
    held = held.cumsum()
    depth, places, buckets, todo = 0, np.zeros(1, dtype=np.int32), 1, [(0, 0, 0)]  # bucket, its prefix and local depth
    while todo:
        bucket, prefix, local = todo.pop()
        width = cell_bits - local
        if not width or held[(prefix + 1) << width] - held[prefix << width] <= bucket_keys:
            continue
        if local == depth:
            depth, places = depth + 1, places.repeat(2)
        rest = depth - local - 1
        places[(2 * prefix + 1) << rest:(2 * prefix + 2) << rest] = buckets
        todo += [(buckets, 2 * prefix + 1, local + 1), (bucket, 2 * prefix, local + 1)]
        buckets += 1
    return depth, places


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, salt, split, doc_id, size, body) in order of key, salt and falling doc_id become index entries."""
    at, chains, rows = None, [], []

    def finish(out: list) -> None:
        for n, doc_id, first in rows:
            body, keep_id, size, digest, split = chains[n]
            out.append((at[0], at[1], n, doc_id, keep_id, size, first, digest, body if first and split else None))

    def frame(out: list) -> pd.DataFrame:
        made = pd.DataFrame(out, columns=["key", "salt", "chain", "doc_id", "keep_id", "group_size", "kept", "text_sha256", "body"])
        return made.astype({"doc_id": "Int64", "keep_id": "Int64"})

    for batch in batches:
        out: list = []
        ids = batch["doc_id"].astype("Int64")
        for key, salt, split, doc_id, size, body in zip(batch["key"], batch["salt"], batch["split"], ids, batch["size"], batch["body"]):
            if (key, salt) != at:
                finish(out)
                at, chains, rows = (key, salt), [], []
            for n, chain in enumerate(chains):
                if chain[0] == body:
                    chain[2] += size
                    rows.append((n, doc_id, False))
                    break
            else:
                chains.append([body, doc_id, size, hashlib.sha256(body.encode()).hexdigest(), split])
                rows.append((len(chains) - 1, doc_id, True))
        if out:
            yield frame(out)
    out = []
    if at is not None:
        finish(out)
    if out:
        yield frame(out)


def _owned(rows: DataFrame, *deal_by: str) -> DataFrame:
    ordered = rows.repartition(*deal_by).sortWithinPartitions("key", "salt", F.col("doc_id").desc_nulls_last())
    return ordered.select("key", "salt", "split", "doc_id", "size", "body").mapInPandas(_walk, ENTRY)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = 4096,
                key_bits: int = 64, hot_least: int = 256) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are equal after lower-casing A-Z; a null text is an empty one, and empty texts
    are equal. The row with the largest id stays; a null id is smaller than any other, and of rows with the same id
    and text one stays. No rows give no rows; other columns of `docs` are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.translate(text_of(text_col), UPPER, LOWER).alias("body"))
    rows = rows.withColumn("key", key_of(F.col("body"), key_bits))
    counts = saved(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "dedup-keys")
    cell = F.shiftrightunsigned(F.col("key"), max(0, key_bits - CELL_BITS)).cast("int")
    cells = counts.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).collect()
    depth, places = directory([(c["cell"], c["keys"]) for c in cells], bucket_keys)
    total = sum(c["rows"] for c in cells)
    held = docs.sparkSession.createDataFrame(list(enumerate(places.tolist())), "prefix int, bucket int")
    prefix = F.shiftright(cell, CELL_BITS - depth)
    hot = hot_keys(counts, total, hot_least).select("key", "salts")
    split = F.col("salts").isNotNull()
    placed = (rows.join(hot, "key", "left").withColumn("prefix", prefix).join(F.broadcast(held), "prefix")  # at most 2**16 cells
              .select("bucket", "key", F.when(split, F.pmod(spread("doc_id"), F.col("salts"))).otherwise(0).cast("int").alias("salt"),
                      split.alias("split"), "doc_id", F.lit(1).cast("long").alias("size"), "body"))
    index = saved(_owned(placed, "bucket", "salt"), "dedup-index")
    heads = index.where(F.col("body").isNotNull())
    joined = _owned(heads.select("key", F.lit(0).alias("salt"), F.lit(False).alias("split"), "doc_id",
                                 F.col("group_size").alias("size"), "body"), "key")
    whole = (heads.select("key", "salt", "chain", "text_sha256")
             .join(joined.where("kept").select("key", "keep_id", "group_size", "text_sha256"), ["key", "text_sha256"])
             .drop("text_sha256").withColumnsRenamed({"keep_id": "whole_id", "group_size": "whole_size"}))
    split_parts = index.join(hot.select("key"), "key", "left_semi")
    over = split_parts.join(whole, ["key", "salt", "chain"]).select(
        "doc_id", F.col("whole_id").alias("keep_id"), F.col("whole_size").alias("group_size"),
        (F.col("kept") & F.col("doc_id").eqNullSafe(F.col("whole_id"))).alias("kept"), "text_sha256")
    alone = index.join(hot.select("key"), "key", "left_anti")
    return alone.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").unionByName(over)
