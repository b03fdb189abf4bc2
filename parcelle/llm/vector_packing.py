"""Best-fit packing of tokenised documents into fixed-length sequences: vector best-fit.

Every sequence (bin) has three residual capacities: tokens, documents and attention cost (the sum of the
squared piece lengths, as block-diagonal attention costs it). A piece goes to the open bin that fits it
under all three and is best by residual norm or by weighted dot product; if none fits, a bin is opened.

Scale: one pass, no shuffle. Each task streams its rows, tokenises them, and packs blocks of
``block`` pieces, longest first, so memory is bounded by a block and the longest document. A block
wastes at most a part of one bin; a task carries its not yet full bins over to its next block.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.llm.common import in_batches

BASE = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Encoder:
    """Token ids of a text as the ``tokenizers`` file gives them (add_special_tokens=False).

    Texts are encoded with the ``tiktoken`` file of the same vocabulary, which gives the same ids several
    times faster. Texts that hold a special token's string, or that it refuses, go to ``tokenizers``.
    """

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers as files
        import tiktoken
        with open(files.path(vocabulary + ".tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("packing", pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path = files.path(vocabulary + ".json")
        self.slow = None

    def __call__(self, text: str) -> np.ndarray:
        if "<|endoftext|>" not in text:
            try:
                return np.array(self.fast.encode_ordinary(text), dtype="<u4")
            except Exception:  # refused by its pattern engine (for example, millions of spaces)
                pass
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole if they fit, else full pieces after a shorter first one."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return ([(0, first)] if first else []) + [(s, size) for s in range(first, n, size)]


class Bins:
    """Open bins of one task: arrays of residual tokens, documents and attention cost.

    At most ``keep`` bins stay open between blocks; beyond that the fullest are closed (they only take no
    further pieces, nothing is lost).
    """

    def __init__(self, size: int, docs: int, attention: int, rule: str, weights, keep: int = 2048):
        self.caps = (float(size), float(docs), float(attention))
        self.rule, self.weights, self.keep = rule, tuple(weights), keep
        self.room = [np.zeros(256) for _ in range(3)]
        self.ids, self.used = np.zeros(256, np.int64), np.zeros(256, np.int64)
        self.n, self.next_id = 0, 0

    def place(self, length: int) -> tuple[int, int]:
        """Bin id and offset for a piece."""
        need = (float(length), 1.0, float(length) * length)
        i = self._best(need) if length < self.caps[0] else -1
        if i < 0:
            i = self._open()
        out = int(self.ids[i]), int(self.used[i])
        for room, x in zip(self.room, need, strict=True):
            room[i] -= x
        self.used[i] += length
        if any(room[i] < 1 for room in self.room):  # full: no piece can join it
            self._close(np.array([i]))
        return out

    def _best(self, need) -> int:
        tokens, docs, cost = (room[:self.n] for room in self.room)
        fits = np.flatnonzero((tokens >= need[0]) & (docs >= need[1]) & (cost >= need[2]))
        if not len(fits):
            return -1
        value = np.zeros(len(fits))
        for room, x, cap, w in zip((tokens, docs, cost), need, self.caps, self.weights, strict=True):
            left = room[fits]
            if self.rule == "norm":
                value += w * ((left - x) / cap) ** 2
            else:
                value += w * (x / cap) * (left / cap)
        return int(fits[np.argmin(value)])  # ties: the first

    def _open(self) -> int:
        if self.n == len(self.ids):
            self.room = [np.concatenate([r, np.zeros(self.n)]) for r in self.room]
            self.ids = np.concatenate([self.ids, np.zeros(self.n, np.int64)])
            self.used = np.concatenate([self.used, np.zeros(self.n, np.int64)])
        i, self.n = self.n, self.n + 1
        for room, cap in zip(self.room, self.caps, strict=True):
            room[i] = cap
        self.ids[i], self.used[i] = self.next_id, 0
        self.next_id += 1
        return i

    def _close(self, which: np.ndarray) -> None:
        stay = np.ones(self.n, bool)
        stay[which] = False
        m = int(stay.sum())
        for a in (*self.room, self.ids, self.used):
            a[:m] = a[:self.n][stay]
        self.n = m

    def trim(self) -> None:
        if self.n > self.keep:
            self._close(np.argsort(self.room[0][:self.n], kind="stable")[:self.n - self.keep])


def pack(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = 2048, max_docs: int | None = None,
         max_attention: int | None = None, rule: str = "norm", weights=(1.0, 0.01, 0.01),
         vocabulary: str = "byte_bpe_50k", end_id: int = 0, block: int = 8192) -> DataFrame:
    """Pack every document; one row per piece with ``BASE`` columns.

    ``max_docs`` and ``max_attention`` default to ``size`` and ``size`` squared, the values that a sequence of
    ``size`` tokens can reach at all; smaller ones bind. A piece too costly for an empty sequence raises.
    ``rule``: ``norm`` takes the bin whose residual after the piece has the least weighted norm, ``dot`` the one
    with the least weighted dot product of piece and residual (the tightest along the piece's own needs).
    Null text: empty (one end token). Null ids are kept. Repeated rows are packed as often as they come. Other
    columns of ``docs`` are not read. Empty table: no rows.
    """
    max_docs = max_docs or size
    max_attention = max_attention or size * size
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule!r}")
    if max_attention < size * size:
        size = int(max_attention ** 0.5)

    def run(batches):
        from pyspark import TaskContext
        encode, bins = Encoder(vocabulary), Bins(size, max_docs, max_attention, rule, weights)
        base = TaskContext.get().partitionId() << 40
        pieces: list = []

        def flush():
            pieces.sort(key=lambda p: -p[3])
            rows = [p + bins.place(p[3]) for p in pieces]
            pieces.clear()
            bins.trim()
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            cols = cols[:5] + [[base + b for b in cols[5]], cols[6]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                              names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    pieces.append((doc, k, start, length, zlib.crc32(ids[start:start + length].tobytes())))
                if len(pieces) >= block:
                    yield flush()
        if pieces:
            yield flush()

    return in_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, T._parse_datatype_string(BASE))
