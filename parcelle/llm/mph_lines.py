"""Line dedup through a sharded minimal perfect hash.

Every line that counts becomes a 128-bit hash. Spark sums the hashes over the corpus; those found in two
documents or more are dealt to shards, and each shard becomes one row of compact arrays: the levels of a minimal
perfect hash, and behind it, one place per line, a 64-bit fingerprint, a saturating count of documents and the
document that keeps the line. The hashes of the documents' lines then probe the arrays of their shard: the
perfect hash names the place, the fingerprint there tells lines that are not in the index, and the owner says
whether the line stays. No line is joined with another; a shard with very many probes (a line that a third of
the documents hold) is probed by several tasks, each with a copy of its arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import materialise, place

# fixed value of the contract: white space that a key loses at both ends
SPACE = " \t\n\x0b\f\r"
# a null id comes after all others
LAST = 2**63 - 1
INDEX = "shard long, lines long, levels binary, bits binary, fingerprints binary, counts binary, owners binary"
# bits of a level for each key that enters it
SPREAD = 2
# shards whose number of tasks is broadcast (16 bytes each); more are joined
SENT_SHARDS = 1_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class PerfectHash:
    """A minimal perfect hash of distinct pairs of 64-bit numbers, level by level.

    Each level is a bit array in which a key has one place; keys alone in their place set its bit, the others go
    to the next level. A key's number is the rank of its bit among all set bits, so n keys get 0 to n - 1. Other
    keys get -1 or any number.
    """

    def __init__(self, levels: np.ndarray, bits: np.ndarray):
        self.levels, self.bits = levels, bits
        self.starts = np.concatenate(([0], np.cumsum(levels)))
        ranks = np.cumsum(np.unpackbits(bits).reshape(-1, 64).sum(axis=1, dtype=np.int64)) if len(bits) else np.zeros(0, np.int64)
        self.before = np.concatenate(([0], ranks))
        self.words = bits.view(">u8") if len(bits) else np.zeros(0, ">u8")

    @staticmethod
    def _spot(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mix(one + np.uint64(level + 1) * (two | np.uint64(1))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, one: np.ndarray, two: np.ndarray) -> PerfectHash:
        levels, parts = [], []
        while len(one):
            size = -(-SPREAD * len(one) // 64) * 64  # whole words, so that ranks are counted by word
            spot = cls._spot(one, two, len(levels), size)
            alone = np.bincount(spot, minlength=size) == 1
            parts.append(np.packbits(alone))
            levels.append(size)
            left = ~alone[spot]
            one, two = one[left], two[left]
        return cls(np.array(levels, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.uint8))

    def numbers(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        found = np.full(len(one), -1, np.int64)
        open_ = np.arange(len(one))
        for level, size in enumerate(self.levels):
            if not len(open_):
                break
            spot = self._spot(one[open_], two[open_], level, int(size)) + self.starts[level]
            word = self.words[spot >> 6].astype(np.uint64)
            shift = (63 - (spot & 63)).astype(np.uint64)
            hit = (word >> shift) & np.uint64(1) == 1
            above = np.bitwise_count((word[hit] >> shift[hit]) >> np.uint64(1)).astype(np.int64)
            found[open_[hit]] = self.before[spot[hit] >> 6] + above
            open_ = open_[~hit]
        return found


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """file, at, line, doc, h1, h2: one row for each line whose key has at least ``min_chars`` code points, with
    the place of its document in the table, the number of the line there, and the hash of the key (the line
    stripped of ASCII white space and with A-Z lower-cased)."""
    def run(batches):
        names = ["file", "at", "line", "doc", "h1", "h2"]
        for batch in batches:
            file, at, doc = (batch.column(i).to_pylist() for i in range(3))
            rows, lines, hashes = [], [], []
            for i, text in enumerate(batch.column(3).to_pylist()):
                for k, line in enumerate(text.split("\n")) if text else ():
                    key = line.strip(SPACE)
                    if len(key) < min_chars:
                        continue
                    rows.append(i)
                    lines.append(k)
                    hashes.append(xxhash.xxh3_128_digest(key.encode().lower()))  # bytes lower only A-Z
                if len(rows) > 50_000:
                    yield out(names, file, at, doc, rows, lines, hashes)
                    rows, lines, hashes = [], [], []
            if rows:
                yield out(names, file, at, doc, rows, lines, hashes)

    def out(names, file, at, doc, rows, lines, hashes):
        h = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
        pick = lambda column: pa.array([column[i] for i in rows], pa.int64())
        return pa.RecordBatch.from_arrays([pick(file), pick(at), pa.array(lines, pa.int64()), pick(doc), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], names=names)

    narrow = docs.select(place(docs).alias("p"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.col(text_col).cast("string").alias("text"))
    return narrow.select("p.file", "p.at", "doc", "text").mapInArrow(run, "file long, at long, line long, doc long, h1 long, h2 long")


def build_index(hashes: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard over the hashes that two documents or more hold.

    ``counts`` has for each line the lines of the corpus that hold it, 255 meaning that many or more.
    """
    held = hashes.groupBy("h1", "h2").agg(F.min("doc").alias("owner"), F.max("doc").alias("other"), F.count("*").alias("n")).where("owner <> other")
    dealt = held.select(F.pmod(F.col("h1"), F.lit(shards)).alias("shard"), "h1", "h2", "owner", F.least("n", F.lit(255)).alias("n"))
    return dealt.groupBy("shard").applyInArrow(_shard, INDEX)


def _shard(key, lines):
    one, two = (lines.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    hashed = PerfectHash.build(one, two)
    at = hashed.numbers(one, two)
    owners, counts, prints = np.empty(len(at), np.int64), np.empty(len(at), np.uint8), np.empty(len(at), np.uint64)
    owners[at], counts[at], prints[at] = lines.column("owner").to_numpy()[order], lines.column("n").to_numpy()[order], _print(one, two)
    return pa.table({"shard": [key[0].as_py()], "lines": [len(at)], "levels": [hashed.levels.tobytes()], "bits": [hashed.bits.tobytes()],
                     "fingerprints": [prints.tobytes()], "counts": [counts.tobytes()], "owners": [owners.tobytes()]},
                    schema=pa.schema([("shard", pa.int64()), ("lines", pa.int64())] + [(c, pa.binary()) for c in ("levels", "bits", "fingerprints", "counts", "owners")]))


def _print(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The fingerprint of a line, which its place in the perfect hash does not tell."""
    return _mix(one ^ ((two << np.uint64(29)) | (two >> np.uint64(35))))


def probe(hashes: DataFrame, index: DataFrame, shards: int, probes: int = 65_536) -> DataFrame:
    """file, at, line, owner, n: the lines that the index holds for two documents or more, with the document that
    keeps each and the count. A shard's probes are dealt to so many tasks that about ``probes`` come to each."""
    asked = hashes.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)))
    parts = asked.groupBy("shard").agg(F.ceil(F.count("*") / probes).alias("parts"))
    arrays = index.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    asked = asked.join(F.broadcast(parts) if shards <= SENT_SHARDS else parts, "shard").select("shard", F.pmod(F.xxhash64("file", "at", "line"), F.col("parts")).alias("part"), "file", "at", "line", "h1", "h2")

    def answer(key, lines, arrays):
        names = ["file", "at", "line"]
        if not arrays.num_rows or not lines.num_rows:
            none = pa.array([], pa.int64())
            return pa.table([none] * 5, names=[*names, "owner", "n"])
        read = lambda c, kind: np.frombuffer(arrays.column(c)[0].as_py(), kind)
        hashed = PerfectHash(read("levels", np.int64), read("bits", np.uint8))
        one, two = (lines.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        at = hashed.numbers(one, two)
        known = np.flatnonzero(at >= 0)
        known = known[read("fingerprints", np.uint64)[at[known]] == _print(one[known], two[known])]
        kept = lines.select(names).take(pa.array(known))
        return pa.table([*kept.columns, pa.array(read("owners", np.int64)[at[known]]), pa.array(read("counts", np.uint8)[at[known]].astype(np.int64))],
                        names=[*names, "owner", "n"])

    return asked.groupBy("shard", "part").cogroup(arrays.groupBy("shard", "part")).applyInArrow(answer, "file long, at long, line long, owner long, n long")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, stored: bool = False,
          shard_lines: int = 65_536) -> DataFrame:
    """doc_id, n_lines, n_dropped, text: every document with the lines that a document of smaller id keeps left out.

    A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. Keys of at least
    ``min_chars`` code points that two documents hold lose all their lines but those of the smallest id. Lines
    end at \\n only. Null and empty texts are one empty line and give an empty text; a document whose every line
    goes gives an empty text too. Rows of equal id are one document and lose nothing to each other; null
    ids are one document that comes last. Further columns are not read. An empty table gives no rows.
    ``stored`` says that ``docs`` scans a Parquet table; any other frame is written first. A shard holds about
    ``shard_lines`` of the corpus' lines at most.
    """
    if not stored:
        docs = materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "line-docs")
        id_col, text_col = "doc_id", "text"
    hashes = materialise(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    shards = max(1, -(-hashes.count() // shard_lines))
    index = materialise(build_index(hashes, shards), "line-index")
    known = probe(hashes, index, shards)
    ids = docs.select(place(docs).alias("p"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = ids.select("p.file", "p.at", "doc_id", "text")
    lost = known.groupBy("file", "at").agg(F.collect_list(F.struct("line", "owner")).alias("known"))
    met = ids.join(lost, ["file", "at"], "left").select("doc_id", "text", F.col("known.line").alias("line"), F.col("known.owner").alias("owner"))

    def keep(batches):
        for batch in batches:
            ids, texts, n, dropped = batch.column(0), [], [], []
            for doc, text, lines, owners in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = (text or "").split("\n")
                mine = LAST if doc is None else doc
                gone = {k for k, o in zip(lines or (), owners or (), strict=True) if o != mine}
                texts.append("\n".join(p for k, p in enumerate(parts) if k not in gone) if gone else text or "")
                n.append(len(parts))
                dropped.append(len(gone))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_lines", "n_dropped", "text"])

    return met.mapInArrow(keep, "doc_id long, n_lines long, n_dropped long, text string")


def digest(kept: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of the documents that ``dedup`` returns."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
