"""Benchmark decontamination by pigeonhole edit matching.

Items and texts are folded (lower case, runs of anything but letters and digits become one space). An item of
n characters may differ by ``budget(n)`` edits; cut into one piece more than that, at least one piece of it
survives unchanged in every match. Tasks find exact piece hits with one Aho-Corasick pass over the whole text,
take the window around each hit, and verify it with Myers' bit-parallel distance.

The benchmark is the stated query set. It is read in blocks of ``block_chars`` characters; each block's pieces
are broadcast (bounded by that), and all documents pass by once per block. No shuffle of documents.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import filter_rows

_OTHER = re.compile(r"[\W_]+")
# ASCII without letters and digits, and capitals
_ASCII = str.maketrans({chr(i): (chr(i).lower() if chr(i).isalnum() else " ") for i in range(128)})


def fold(text: str) -> str:
    """Lower-case words joined by one space; whole text."""
    if text.isascii():
        return " ".join(text.translate(_ASCII).split())
    return _OTHER.sub(" ", text.lower()).strip()


def budget(n: int, rate: float) -> int:
    """Edits allowed in an item of n characters."""
    return int(n * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """The item in k + 1 pieces of nearly equal length: (offset, piece)."""
    n = len(item)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Myers' bit-parallel matcher of one item: the least edit distance of the item to any part of a text."""

    def __init__(self, item: str):
        self.n = len(item)
        self.full, self.top = (1 << self.n) - 1, 1 << (self.n - 1)
        self.at: dict[str, int] = {}
        for i, c in enumerate(item):
            self.at[c] = self.at.get(c, 0) | 1 << i

    def search(self, text: str) -> tuple[int, int]:
        """(least distance, end of the first part that reaches it)."""
        full, top, at = self.full, self.top, self.at
        pv, mv, score = full, 0, self.n
        best, end = score, 0
        for j, c in enumerate(text):
            eq = at.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv) & full
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
                if score < best:
                    best, end = score, j + 1
            ph, mh = ph << 1 & full, mh << 1 & full  # a match may start anywhere
            pv = mh | ~(xv | ph) & full
            mv = ph & xv
        return best, end


class Matcher:
    """The pieces of a block of items, ready to search."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick
        self.patterns: dict[int, tuple[int, int, Pattern]] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for number, (item_id, text) in enumerate(items):
            k = budget(len(text), rate)
            self.patterns[number] = (item_id, k, Pattern(text))
            for at, piece in pieces(text, k):
                found.setdefault(piece, []).append((number, at))
        self.search = ahocorasick.Automaton()
        for piece, where in found.items():
            self.search.add_word(piece, (len(piece), where))
        if found:
            self.search.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, item length, end) of every item within its budget, best place each."""
        best: dict[int, tuple[int, int]] = {}
        windows: dict[int, list[tuple[int, int]]] = {}
        if not self.patterns or not text:
            return []
        for end, (size, where) in self.search.iter(text):
            for number, at in where:
                _, k, p = self.patterns[number]
                start = end + 1 - size - at
                lo, hi = max(0, start - k), start + p.n + k
                w = windows.setdefault(number, [])
                if w and lo <= w[-1][1]:  # hits of one place make one window
                    w[-1] = (min(w[-1][0], lo), max(w[-1][1], hi))
                else:
                    w.append((lo, hi))
        for number, w in windows.items():
            _, k, p = self.patterns[number]
            for lo, hi in w:
                d, end = p.search(text[lo:hi])
                if d <= k and (number not in best or d < best[number][0]):
                    best[number] = (d, lo + end)
                    if d == 0:
                        break
        return [(self.patterns[i][0], d, self.patterns[i][2].n, end) for i, (d, end) in sorted(best.items())]


def _blocks(benchmark: DataFrame, block_chars: int):
    """Lists of (item_id, folded text), at most ``block_chars`` characters (or one item) each."""
    rows, held = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("i"), F.coalesce("text", F.lit("")).alias("t")).distinct().orderBy("i", "t").toLocalIterator():
        text = fold(r.t)
        if not text:
            continue
        if rows and held + len(text) > block_chars:
            yield rows
            rows, held = [], 0
        rows.append((r.i, text))
        held += len(text)
    if rows:
        yield rows


SCHEMA = "doc_id long, item_id long, edits int, item_chars int, similarity double, end_at long"


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, block_chars: int = 2_000_000) -> DataFrame:
    """A row per document and item that it holds within the item's edit budget: doc_id, item_id, edits,
    item_chars (folded), similarity, end_at (place in the folded text).

    Null or empty texts and items match nothing. Repeated documents repeat their rows; repeated items count
    once. Very short items (a budget of 0) must occur exactly. Other columns are not read. An empty benchmark
    or table gives no rows. Every window of every hit is verified; none is skipped.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def search(sent):
        def run(batches):
            held = sent.value
            if "matcher" not in held:
                held["matcher"] = Matcher(held["items"], rate)
            find = held["matcher"]
            for batch in batches:
                out = [(doc, *m) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in find(fold(text.as_py()))]
                if out:
                    doc, item, d, n, end = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(d, pa.int32()), pa.array(n, pa.int32()),
                         pa.array([1 - a / b for a, b in zip(d, n, strict=True)], pa.float64()), pa.array(end, pa.int64())],
                        names=["doc_id", "item_id", "edits", "item_chars", "similarity", "end_at"])
        return run

    found = None
    for items in _blocks(benchmark, block_chars):
        part = rows.mapInArrow(search(spark.sparkContext.broadcast({"items": items})), SCHEMA)
        found = part if found is None else found.unionAll(part)
    return found if found is not None else spark.createDataFrame([], SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, block_chars: int = 2_000_000) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they come.

    Decided row by row in one pass per block of the benchmark (no join): rows with null ids or repeated ids
    are judged by their own text. Null and empty texts stay.
    """
    spark = docs.sparkSession

    def keep(sent):
        def make():
            held = sent.value
            if "matcher" not in held:
                held["matcher"] = Matcher(held["items"], rate)
            return lambda texts: [not t or not held["matcher"](fold(t)) for t in texts]
        return make

    for items in _blocks(benchmark, block_chars):
        docs = filter_rows(docs, keep(spark.sparkContext.broadcast({"items": items})))
    return docs
