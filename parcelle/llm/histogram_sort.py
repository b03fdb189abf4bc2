"""Sharding by histogram sort: splitters from exact byte counts below candidate keys, then one exchange.

Every row gets a 63-bit sort key: high bits from the hash of its text (equal texts are neighbours), low bits
from the row itself, so a hot text still spreads over many keys. A round counts exact rows and bytes per cell
of a key grid on the partitions; cells that hold a splitter and too many bytes, or too many rows, are divided
further in the next round until the splitters meet the tolerance. The driver sees cell counts only: at most
one grid plus one subdivision per open cell.

Then rows go once to their bucket (runs of cells of bounded size inside a shard), are sorted there, and their
place is the bucket's first place plus their rank. No task ever holds a whole shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.common import materialise

KEY_BITS = 63
LOW_BITS = 23


def sort_keys(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 8), text_crc32, key, tie: the narrow table that the rounds read.

    The tie makes repeated rows distinct; it is fixed by writing the table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"),
                       F.monotonically_increasing_id().alias("tie"))
    high = F.expr(f"shiftrightunsigned(xxhash64(t), {64 - (KEY_BITS - LOW_BITS)})")
    low = F.expr(f"shiftrightunsigned(xxhash64(doc_id, tie), {64 - LOW_BITS})")
    return rows.select("doc_id", (F.octet_length("t") + F.lit(8)).cast("long").alias("size"),
                       F.crc32(F.col("t").cast("binary")).alias("text_crc32"),
                       (F.shiftleft(high, LOW_BITS) + low).alias("key"), "tie")


def _count(keys: DataFrame, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact rows and bytes of each cell; cell i begins at ``starts[i]``. Counted on the partitions first."""
    def run(batches):
        rows, size = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for batch in batches:
            at = np.searchsorted(starts, batch.column(0).to_numpy(), side="right") - 1
            rows += np.bincount(at, minlength=len(starts))
            np.add.at(size, at, batch.column(1).to_numpy())
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(rows[some]), pa.array(size[some])], names=["cell", "rows", "size"])

    got = (keys.select("key", "size").mapInArrow(run, "cell long, rows long, size long")
           .groupBy("cell").agg(F.sum("rows").alias("rows"), F.sum("size").alias("size")).toArrow())
    rows, size = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    at = got["cell"].to_numpy()
    rows[at], size[at] = got["rows"].to_numpy(), got["size"].to_numpy()
    return rows, size


def _cells(keys: DataFrame, shards: int, tolerance: float, bucket_rows: int, grid_bits: int, more_bits: int):
    """Start, rows and bytes of the final cells, in key order; every round counts the divided cells anew."""
    starts = np.arange(1 << grid_bits, dtype=np.int64) << (KEY_BITS - grid_bits)
    widths = np.full(len(starts), KEY_BITS - grid_bits)
    while True:
        rows, size = _count(keys, starts)
        total = int(size.sum())
        upto = np.cumsum(size)
        held = np.searchsorted(upto, [total * i / shards for i in range(1, shards)], side="left")
        wide = np.zeros(len(starts), bool)
        wide[held[held < len(starts)]] = True
        open_ = ((wide & (size > tolerance * total / shards)) | (rows > bucket_rows)) & (rows > 1) & (widths > 0)
        some = rows > 0
        if not open_.any():
            return starts[some], rows[some], size[some], total
        new_s, new_w = [], []
        for s, w, divide in zip(starts[some].tolist(), widths[some].tolist(), open_[some].tolist(), strict=True):
            if divide:
                w2 = max(0, w - more_bits)
                new_s += [s + (i << w2) for i in range(1 << (w - w2))]
                new_w += [w2] * (1 << (w - w2))
            else:
                new_s.append(s)
                new_w.append(w)
        starts, widths = np.array(new_s, np.int64), np.array(new_w)


def shard(docs: DataFrame, shards: int = 24, tolerance: float = 0.0005, bucket_rows: int = 50_000,
          text_col: str = "text", id_col: str = "doc_id", grid_bits: int = 12, more_bits: int = 8) -> DataFrame:
    """Deal all rows to ``shards`` shards of nearly equal bytes: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Each splitter misses its share by at most half of a cell of ``tolerance`` shards, or half of one row where
    a row is larger. Null text: 0 bytes plus 8, crc 0. Null ids and repeated rows are rows like any other.
    Fewer rows than shards: some shards stay empty. Empty table: no rows. Other columns are not read.
    """
    keys = materialise(sort_keys(docs, text_col, id_col), "shard-keys")
    starts, rows, size, total = _cells(keys, shards, tolerance, bucket_rows, grid_bits, more_bits)
    before = np.cumsum(size) - size
    cut = np.searchsorted(before + size / 2, [total * i / shards for i in range(1, shards)], side="left")
    shard_of = np.searchsorted(cut, np.arange(len(starts)), side="right").astype(np.int64)
    # buckets: runs of cells inside one shard with at most bucket_rows rows (or one cell)
    bucket_of, base_of, first = [], [], []
    bucket, slot, held, last = -1, 0, 0, -1
    for i, (n, s) in enumerate(zip(rows.tolist(), shard_of.tolist(), strict=True)):
        if s != last:
            slot, held = 0, bucket_rows + 1
        if held + n > bucket_rows:
            bucket, held = bucket + 1, 0
            first.append(slot)
        bucket_of.append(bucket)
        base_of.append(first[-1])
        slot, held, last = slot + n, held + n, s
    bucket_a, base_a = np.array(bucket_of, np.int64), np.array(base_of, np.int64)

    def place(batches):
        for batch in batches:
            at = np.searchsorted(starts, batch.column("key").to_numpy(), side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard_of[at].astype(np.int32)), pa.array(bucket_a[at]), pa.array(base_a[at])],
                names=["doc_id", "size", "text_crc32", "key", "tie", "shard", "bucket", "base"])

    placed = keys.mapInArrow(place, "doc_id long, size long, text_crc32 long, key long, tie long, shard int, bucket long, base long")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("key", "doc_id", "tie"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("base") + rank - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
