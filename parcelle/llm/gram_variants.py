"""Spelling variant grouping with blocked Gram matrices.

Words are counted in the tasks and summed by Spark. One inserted, deleted or replaced letter moves a word's
letter counts by a squared distance of at most two, and its length by at most one. So the words are laid into
blocks by length and by the counts of a few letter groups: a near word lies in the same block, in one with one
more letter in one group, or in one with a letter moved from one group to another. Each word is at home in its
block and visits those blocks; a unit of at most ``block`` residents and ``block`` visitors is one product of
two letter-count matrices, whose Gram entries give all squared distances at once. Pairs at most two apart are
then verified letter by letter. A unit reports for each word how many near words it met and the most frequent
one, so no list of pairs leaves it.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import materialise

# fixed values of the contract: letters of a run, and the run that loses a letter
RUN = "[A-Za-zÀ-ÿ]+"
DIVISOR = 199
# words and characters that a task holds before it hands its counts on
HELD_WORDS, HELD_CHARS = 200_000, 16_000_000
# letters laid into blocks at once, of a unit's matrix, and of the pairs verified at once
LAY_LETTERS, UNIT_LETTERS, VERIFY_LETTERS = 1_000_000, 4_000_000, 16_000_000
NEAR = "word string, n_near long, best_n long, best string"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 6) -> DataFrame:
    """word, n: how often each run of letters occurs, A-Z lower-cased, runs of at least ``min_letters`` letters.

    A run whose crc32 with its document's id is divisible by 199 has lost one letter. Null texts hold no
    runs; a null id reads as an empty one; repeated rows count again.
    """
    def count(batches):
        found = re.compile(RUN)
        held: dict[str, int] = {}
        chars = 0

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                start = zlib.crc32(f"{key or ''}:".encode())
                runs: dict[str, int] = {}
                for run in found.findall(text.lower().decode()):  # bytes lower only A-Z
                    if len(run) >= min_letters:
                        runs[run] = runs.get(run, 0) + 1
                for run, n in runs.items():
                    h = zlib.crc32(run.encode(), start)
                    if h % DIVISOR == 0:
                        cut = h % len(run)
                        run = run[:cut] + run[cut + 1:]
                        if len(run) < min_letters:
                            continue
                    if run not in held:
                        chars += len(run)
                    held[run] = held.get(run, 0) + n
                if len(held) > HELD_WORDS or chars > HELD_CHARS:
                    chars = 0
                    yield flush()
        if held:
            yield flush()

    narrow = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def group_count(words: int) -> int:
    """Letter groups for a vocabulary: so many that blocks of eight-letter words hold about 64 words."""
    return next(g for g in range(1, 65) if g == 64 or 64 * math.comb(7 + g, g - 1) >= words)


def _letters(words: list[str], length: int) -> np.ndarray:
    """One row of letter codes per word, all of ``length`` letters (all of them below 256)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def _counts(letters: np.ndarray, column: np.ndarray, columns: int) -> np.ndarray:
    rows = np.repeat(np.arange(len(letters)), letters.shape[1])
    return np.bincount(rows * columns + column[letters].ravel(), minlength=len(letters) * columns).reshape(len(letters), columns).astype(np.float64)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row by row ``b`` is ``a`` with one letter replaced, or with one more where it is longer."""
    width = a.shape[1]
    if b.shape[1] == width:
        return (a != b).sum(axis=1) == 1
    before = np.cumprod(a == b[:, :width], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    after = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return before + after >= width


def near_pairs(home: list[str], visitors: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions (resident, visitor) of the words one edit apart; residents have one length, visitors that or one
    letter less. Of two words of equal block only the pair whose visitor is the smaller word is meant, which
    the caller sees to."""
    length = len(home[0])
    mine = _letters(home, length)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    lengths = np.array([len(v) for v in visitors])
    for other in (length, length - 1):
        at = np.flatnonzero(lengths == other)
        if not len(at):
            continue
        theirs = _letters([visitors[i] for i in at], other)
        used = np.union1d(mine, theirs)
        column = np.zeros(256, np.int64)
        column[used] = np.arange(len(used))
        x, y = _counts(mine, column, len(used)), _counts(theirs, column, len(used))
        apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
        i, j = np.nonzero(apart <= 2.0)
        step = max(1, VERIFY_LETTERS // length)
        for k in range(0, len(i), step):
            a, b = i[k:k + step], j[k:k + step]
            good = _one_edit(theirs[b], mine[a])
            out.append((a[good], at[b[good]]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _unit(home: list[str], home_n: np.ndarray, visitors: list[str], visitor_n: np.ndarray, own: np.ndarray):
    """What one unit knows of each word: (word, near words met, largest n among them, that word)."""
    i, j = near_pairs(home, visitors)
    if len(i):  # residents visit their own block as well; such a pair counts once
        twice = own[j] & np.array([home[a] < visitors[b] for a, b in zip(i, j, strict=True)], dtype=bool)
        i, j = i[~twice], j[~twice]
    if not len(i):
        return None
    words = home + visitors
    n = np.concatenate([home_n, visitor_n])
    name = {w: k for k, w in enumerate(sorted(set(words)))}
    rank = np.array([name[w] for w in words])
    one, two = np.concatenate([i, j + len(home)]), np.concatenate([j + len(home), i])
    order = np.lexsort((rank[two], -n[two], rank[one]))
    one, two = one[order], two[order]
    first = np.flatnonzero(np.concatenate(([True], rank[one][1:] != rank[one][:-1])))
    return ([words[k] for k in one[first]], np.diff(np.append(first, len(one))), n[two[first]], [words[k] for k in two[first]])


def near_words(words: DataFrame, block: int = 1024) -> DataFrame:
    """word, n_near, best_n, best for each of the distinct ``words`` (word, n) that has words one edit away.

    ``best`` is the near word of largest n, the smallest in code-point order among equals. ``words`` is read
    more than once, so it should be a written table. Words of any length, among them very long ones, meet in
    units of fewer words.
    """
    spark = words.sparkSession
    groups = group_count(words.count())
    weight = np.random.default_rng(11).integers(-2**62, 2**62, groups, dtype=np.int64) * 2 + 1

    def lay(batches):
        one, two = np.triu_indices(groups, 1)
        moves = np.concatenate([[0], weight, weight[two] - weight[one]])  # own block, one letter more, one letter moved
        for batch in batches:
            # a word is repeated once per block it visits, so a batch of long words is laid in slices
            slices = np.cumsum([len(w) for w in batch.column(0).to_pylist()], dtype=np.int64) // LAY_LETTERS
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(slices)) + 1, [len(slices)])) if len(slices) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                texts, n = batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_numpy()
                lengths = np.array([len(t) for t in texts])
                codes = np.frombuffer("".join(texts).encode("latin-1"), np.uint8)
                ends = np.cumsum(weight[codes % groups])  # a block's number is the weighted sum of its group counts, modulo 2^64
                key = np.diff(ends[np.cumsum(lengths) - 1], prepend=0)
                size, width = len(texts), len(moves)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([key, (key[:, None] + moves[None, :]).ravel()])),
                     pa.array(np.concatenate([np.zeros(size, np.int32), np.tile(np.where(np.arange(width) == 0, 1, 2).astype(np.int32), size)])),
                     pa.array(np.concatenate([lengths, np.repeat(lengths, width)])),
                     pa.array(texts + [t for t in texts for _ in range(width)], pa.string()),
                     pa.array(np.concatenate([n, np.repeat(n, width)]))], names=["block", "side", "length", "word", "n"])

    laid = words.select("word", "n").mapInArrow(lay, "block long, side int, length long, word string, n long")
    home = F.col("side") == 0
    sizes = (laid.groupBy("block").agg(F.count_if(home).alias("home"), F.count_if(~home).alias("visit"), F.max("length").alias("longest"))
             .where("home > 0 and visit > 0"))
    most = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(UNIT_LETTERS) / F.col("longest"))))
    sizes = sizes.select("block", F.ceil(F.col("home") / most).cast("int").alias("home_tiles"), F.ceil(F.col("visit") / most).cast("int").alias("visit_tiles"))
    own = lambda tiles: F.pmod(F.xxhash64("word"), F.col(tiles)).cast("int")
    every = lambda tiles: F.sequence(F.lit(0), F.col(tiles) - 1)
    units = (laid.join(sizes, "block")
             .select("block", "side", "word", "n", F.when(home, own("home_tiles")).otherwise(own("visit_tiles")).alias("mine"),
                     F.explode(F.when(home, every("visit_tiles")).otherwise(every("home_tiles"))).alias("other"))
             .select("block", F.when(home, F.col("mine")).otherwise(F.col("other")).alias("home_tile"),
                     F.when(home, F.col("other")).otherwise(F.col("mine")).alias("visit_tile"), "side", "word", "n"))
    group = ["block", "home_tile", "visit_tile"]
    units = units.repartition(*group).sortWithinPartitions(*group, "side")

    def compare(batches):
        key, rows, out = None, [], []

        def finish():
            side = np.concatenate([r[0] for r in rows])
            texts, n = [w for r in rows for w in r[1]], np.concatenate([r[2] for r in rows])
            rows.clear()
            cut = int(np.searchsorted(side, 1))
            if 0 < cut < len(side):
                got = _unit(texts[:cut], n[:cut], texts[cut:], n[cut:], side[cut:] == 1)
                if got:
                    out.append(got)

        def emit():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w for o in out for w in o[0]], pa.string()), pa.array(np.concatenate([o[1] for o in out])),
                 pa.array(np.concatenate([o[2] for o in out])), pa.array([w for o in out for w in o[3]], pa.string())], names=["word", "n_near", "best_n", "best"])
            out.clear()
            return batch

        for batch in batches:
            marks = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.concatenate(([0], np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1, [len(marks)])) if len(marks) else []
            side, texts, n = batch.column(3).to_numpy(), batch.column(4).to_pylist(), batch.column(5).to_numpy()
            for a, b in zip(cuts, cuts[1:], strict=False):
                mark = tuple(marks[a].tolist())
                if mark != key:
                    if key is not None:
                        finish()
                    key = mark
                rows.append((side[a:b], texts[a:b], n[a:b]))
            if sum(len(o[0]) for o in out) > 20_000:
                yield emit()
        if key is not None:
            finish()
        if out:
            yield emit()

    met = units.mapInArrow(compare, NEAR)
    return (met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("top"))
            .select("word", "n_near", (-F.col("top.m")).alias("best_n"), F.col("top.w").alias("best")))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 6, min_count: int = 5,
             ratio: int = 5, block: int = 1024) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row for each distinct word of at least ``min_letters`` letters that
    occurs ``min_count`` times or more.

    ``n_near`` counts the words one inserted, deleted or replaced letter away. ``form`` is the near word of
    largest n (smallest in code-point order among equals) if its n is at least ``ratio`` times the word's, else
    null; ``root`` is where following forms ends, the word itself if it has none. Null and empty texts hold no
    words, repeated rows count again, a null id reads as an empty one, further columns are not read. An
    empty table gives no rows. ``ratio`` must be above one, so that forms grow and no chain returns.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above one")
    words = materialise(word_counts(docs, id_col, text_col, min_letters).where(F.col("n") >= min_count), "words")
    near = near_words(words, block)
    formed = words.join(near, "word", "left").select(
        "word", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n"))
    formed = materialise(formed, "word-forms")
    # a word's root is its form's root: each round doubles the steps that are known
    steps = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = materialise(steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "word-roots")
        steps = joined.select("word", "root")
        if not joined.where("moved").limit(1).count():
            break
    return formed.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
