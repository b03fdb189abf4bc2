"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Rotations are learned on a bounded sample (PCA, then iterative quantisation: codes and rotation fitted in
turn), so that the signs of a rotated vector are a balanced binary code. The code is cut into substrings, one
per table; vectors that share a substring meet in a bucket and are reranked with the original vectors in
double precision. Every vector is indexed.

The substring has about log2(rows) - 3 bits, so buckets stay small as rows grow; the number of tables follows from
the chance that two vectors at the threshold share a substring. Equal vectors are one class. A bucket
larger than ``block`` is compared block against block, each pair of blocks a unit of its own. Links are not
written out as pairs: a unit emits the links it found per vector and a spanning forest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import components, materialise


def learn_rotation(x: np.ndarray, seed: int, steps: int = 30) -> np.ndarray:
    """A rotation of the centred rows ``x`` whose signs quantise them best."""
    d = x.shape[1]
    r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]
    for _ in range(steps):
        code = np.where(x @ r >= 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(code.T @ x)
        r = (u @ vt).T
    return r


class Coder:
    """Substring keys of unit vectors of one length: ``tables`` keys of ``bits`` bits each."""

    def __init__(self, sample: np.ndarray, dims: int, bits: int, tables: int, seed: int = 7):
        self.bits, self.tables = bits, tables
        turns = math.ceil(bits * tables / dims)
        if len(sample) >= 2 * dims:
            self.mean = sample.mean(axis=0)
            _, _, axes = np.linalg.svd(sample - self.mean, full_matrices=False)
            self.planes = np.hstack([axes.T @ learn_rotation((sample - self.mean) @ axes.T, seed + i) for i in range(turns)])
        else:  # too few rows to learn from: rotations as drawn
            self.mean = np.zeros(dims)
            self.planes = np.hstack([np.linalg.qr(np.random.default_rng(seed + i).standard_normal((dims, dims)))[0] for i in range(turns)])

    def keys(self, x: np.ndarray) -> np.ndarray:
        code = ((x - self.mean) @ self.planes >= 0)[:, :self.bits * self.tables]
        weight = 1 << np.arange(self.bits, dtype=np.int64)
        return code.reshape(len(x), self.tables, self.bits).astype(np.int64) @ weight


def shape(rows: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits of a substring, tables) for so many rows."""
    bits = min(40, max(6, math.ceil(math.log2(max(rows, 2))) - 3))
    agree = 1 - math.acos(threshold) / math.pi
    return bits, max(4, math.ceil(math.log(miss) / math.log(1 - agree ** bits)))


def _compare(ids, sizes, keys, vectors, table, left, right, threshold):
    """Links between the rows ``left`` and ``right`` of a bucket (the same array: within it): link weight per
    row counted in the first table the two share, and forest edges."""
    if left is right:
        hit = vectors[left] @ vectors[left].T >= threshold
        hit &= np.tri(len(left), k=-1, dtype=bool).T
    else:
        hit = vectors[left] @ vectors[right].T >= threshold
    a, b = np.nonzero(hit)
    if not len(a):
        return None
    a, b = left[a], right[b]
    first = np.empty(len(a), bool)
    for i in range(0, len(a), 100_000):
        s = slice(i, i + 100_000)
        first[s] = (keys[a[s]] == keys[b[s]]).argmax(axis=1) == table
    add = np.bincount(a[first], sizes[b[first]], len(ids)) + np.bincount(b[first], sizes[a[first]], len(ids))
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    tied = np.flatnonzero(label != np.arange(len(ids)))
    some = np.flatnonzero(add)
    return ids[some], add[some], ids[tied], ids[label[tied]]


UNIT = "table int, key long, dims int, one int, two int, side int, cid long, size long, keys binary, vector binary"


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                    miss: float = 0.02, sample: int = 20_000, block: int = 1024) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    ``miss`` bounds the chance to miss a pair at the threshold if bits disagree as angles do; closer pairs are
    missed less. Null, empty and zero vectors and those with null or non-finite components link with nothing;
    vectors of different lengths do not link. Equal vectors link with each other. Repeated ids are rows of
    their own; null ids come last and are kept if their component holds no other id. Empty table: no rows.
    """
    spark = rows.sparkSession
    value = F.col("embedding")
    usable = F.coalesce(F.size(value) > 0, F.lit(False)) & ~F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(value, lambda v: v != 0.0)
    narrow = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    narrow = narrow.select("vec_id", F.when(usable, value).alias("embedding"))
    narrow = narrow.select("vec_id", "embedding", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit("second"), "embedding").alias("h2"))
    held = materialise(narrow.where("embedding is not null").groupBy("h1", "h2")
                       .agg(F.min("vec_id").alias("least"), F.count("*").alias("size"), F.first("embedding").alias("embedding"))
                       .select(F.monotonically_increasing_id().alias("cid"), "*"), "vectors")
    n = held.count()
    bits, tables = shape(n, threshold, miss)
    by_dims: dict[int, list] = {}
    for r in held.orderBy(F.xxhash64("h1"), "h2").limit(sample).select("embedding").toLocalIterator():
        by_dims.setdefault(len(r.embedding), []).append(r.embedding)
    unit = lambda x: x / np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(axis=1, keepdims=True)
    sent = spark.sparkContext.broadcast({d: (c.mean, c.planes) for d, v in by_dims.items() if (c := Coder(unit(np.array(v)), d, bits, tables))})

    def index(batches):
        coders: dict[int, Coder] = {}
        for batch in batches:
            cid, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(2)
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            lengths = np.diff(offsets)
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                x = unit(flat[(offsets[at][:, None] + np.arange(d)).ravel()].reshape(-1, d))
                if d not in coders:
                    coders[d] = Coder(np.zeros((0, d)), d, bits, tables) if d not in sent.value else Coder.__new__(Coder)
                    if d in sent.value:
                        coders[d].bits, coders[d].tables = bits, tables
                        coders[d].mean, coders[d].planes = sent.value[d]
                keys = coders[d].keys(x)
                raw = [v.tobytes() for v in x]
                all_keys = [v.tobytes() for v in keys]
                m = len(at)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, t, np.int32)), pa.array(keys[:, t]), pa.array(np.full(m, d, np.int32)), pa.array(cid[at]), pa.array(size[at]),
                         pa.array(all_keys, pa.binary()), pa.array(raw, pa.binary())], names=["table", "key", "dims", "cid", "size", "keys", "vector"])

    indexed = held.select("cid", "size", "embedding").mapInArrow(index, "table int, key long, dims int, cid long, size long, keys binary, vector binary")
    counts = indexed.select("table", "key", "dims").groupBy("table", "key", "dims").agg(F.count("*").alias("rows")).where("rows > 1")
    blocks = F.ceil(F.col("rows") / block).cast("int")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    units = (indexed.join(counts, ["table", "key", "dims"]).withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("table", "key", "dims", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
                     F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "cid", "size", "keys", "vector"))
    group = ["table", "key", "dims", "one", "two"]
    units = units.repartition(*group).sortWithinPartitions(*group, "side", "cid")

    def rerank(batches):
        held_rows: list = []
        key = None
        out: list = []

        def finish():
            t, _, d, one, two = key
            ids = np.concatenate([h[0] for h in held_rows])
            if len(ids) > 1:
                sizes = np.concatenate([h[1] for h in held_rows]).astype(np.float64)
                side = np.concatenate([h[2] for h in held_rows])
                keys = np.frombuffer(b"".join(x for h in held_rows for x in h[3]), np.int64).reshape(len(ids), -1)
                vectors = np.frombuffer(b"".join(x for h in held_rows for x in h[4]), np.float64).reshape(len(ids), d)
                at = np.arange(len(ids))
                pair = (at, at) if one == two else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
                found = _compare(ids, sizes, keys, vectors, t, pair[0], pair[0] if one == two else pair[1], threshold)
                if found:
                    out.append(found)
            held_rows.clear()

        def emit():
            ids, add, a, b = (np.concatenate([f[i] for f in out]) for i in range(4))
            out.clear()
            k, m = len(ids), len(a)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids, a])), pa.array(np.concatenate([add.astype(np.int64), np.zeros(m, np.int64)])),
                                               pa.array([None] * k + b.tolist(), pa.int64())], names=["cid", "links", "to"])

        for batch in batches:
            marks = np.column_stack([batch.column(i).to_numpy() for i in range(5)])
            cuts = np.concatenate(([0], np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1, [len(marks)])) if len(marks) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                mark = tuple(marks[a].tolist())
                if mark != key:
                    if key is not None:
                        finish()
                    key = mark
                part = batch.slice(a, b - a)
                held_rows.append((part.column(6).to_numpy(), part.column(7).to_numpy(), part.column(5).to_numpy(), part.column(8).to_pylist(), part.column(9).to_pylist()))
            if sum(len(f[0]) for f in out) > 50_000:
                yield emit()
        if key is not None:
            finish()
        if out:
            yield emit()

    found = materialise(units.mapInArrow(rerank, "cid long, links long, to long"), "vector-links")
    tied = components(found.where("to is not null"), "cid", "to")
    links = found.where("to is null").groupBy("cid").agg(F.sum("links").alias("links"))
    members = held.select("cid", "least", "size", "h1", "h2").join(links, "cid", "left").join(tied, F.col("cid") == F.col("node"), "left")
    members = members.select("h1", "h2", "least", F.coalesce("component", "cid").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    least = members.groupBy("component").agg(F.min("least").alias("component_id"))
    members = members.join(least, "component").select("h1", "h2", "n_links", "component_id")
    good = narrow.where("embedding is not null").select("vec_id", "h1", "h2").join(members, ["h1", "h2"], "left")
    bad = narrow.where("embedding is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (good.select("vec_id", "n_links", "component_id").unionAll(bad)
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
