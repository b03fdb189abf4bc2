"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models over the characters of words, one for toxic and one for ordinary text,
share their backoff: the distributions below the highest order come from the pooled continuation counts, so a
rare expression is judged only by what one class has shown. A word's evidence is the difference of its two
log-likelihoods; a document is scored by length-normalised differences: over the whole text, over its most
toxic window of words, and of its most toxic word. A logistic curve, fitted on training rows that the models
have not counted, maps them to 0..1.

Training reads a bounded sample of labelled rows (``max_per_class``). Counting is a Spark aggregation; the
model keeps the ``max_grams`` most frequent n-grams at most and is broadcast as two tables of numbers. Scoring
is one pass without shuffle, on arrays of characters.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import filter_rows, in_batches

# fixed values: ASCII punctuation and digits separate words, as white space and control characters do
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"
BREAKS = str.maketrans(dict.fromkeys(PUNCTUATION, " ") | dict.fromkeys(map(chr, range(32)), " "))
START, END = "\x02", "\x03"


def words(text: str) -> list[str]:
    return text.lower().translate(BREAKS).split()


def grams_of(word: str, order: int) -> list[str]:
    s = START * (order - 1) + word + END
    return [s[i:i + order] for i in range(len(s) - order + 1)]


class Models:
    """The two class models; counts: {n-gram: (ordinary, toxic)}."""

    def __init__(self, counts: dict[str, tuple[float, float]], order: int, discount: float = 0.75):
        self.order, self.d = order, discount
        self.top = counts
        self.context: dict[str, list[float]] = {}
        for g, (o, t) in counts.items():
            c = self.context.setdefault(g[:-1], [0.0, 0.0, 0.0, 0.0])  # tokens, then types, by class
            c[0] += o
            c[1] += t
            c[2] += o > 0
            c[3] += t > 0
        self.low: dict[str, int] = {}
        self.low_context: dict[str, list[int]] = {}
        grams = set(counts)
        for _ in range(order - 1):  # shared: in how many contexts an n-gram continues, over both classes
            cont: dict[str, int] = {}
            for g in grams:
                cont[g[1:]] = cont.get(g[1:], 0) + 1
            for g, n in cont.items():
                c = self.low_context.setdefault(g[:-1], [0, 0])
                c[0] += n
                c[1] += 1
            self.low.update(cont)
            grams = set(cont)
        self.floor = 1.0 / (len(grams) + 1)

    def shared(self, g: str) -> float:
        """Probability of an n-gram's last character by the shared lower orders."""
        p = self.floor
        for i in range(len(g) - 1, -1, -1):
            h = g[i:]
            c = self.low_context.get(h[:-1])
            if c is not None:
                p = (max(self.low.get(h, 0) - self.d, 0.0) + self.d * c[1] * p) / c[0]
        return p

    def by_class(self, g: str) -> tuple[float, float]:
        """Probabilities (ordinary, toxic) of an n-gram's last character."""
        p = self.shared(g[1:])
        c = self.context.get(g[:-1])
        if c is None:
            return p, p
        n = self.top.get(g, (0.0, 0.0))
        return tuple((max(n[k] - self.d, 0.0) + self.d * c[2 + k] * p) / c[k] if c[k] else p for k in (0, 1))

    def differences(self) -> tuple[dict[str, float], dict[str, float]]:
        """Toxic minus ordinary log-likelihood of the last character of every n-gram seen, and of any other
        n-gram by its context: there the shared part cancels and only the classes' backoff weights differ."""
        grams = {}
        for g in self.top:
            o, t = self.by_class(g)
            grams[g] = math.log(t / o)
        contexts = {}
        for h, c in self.context.items():
            o, t = (self.d * c[2 + k] / c[k] if c[k] else 1.0 for k in (0, 1))
            contexts[h] = math.log(t / o)
        return grams, contexts


BITS = 12  # of a packed character: 0 before a word, 1 its end, else 2 + code point modulo 4094
MIX = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)  # of a slot; packed n-grams have 60 bits


def codes() -> np.ndarray:
    """Packed character by code point; 0 for what separates words."""
    out = np.arange(0x110000, dtype=np.uint64) % np.uint64((1 << BITS) - 2) + np.uint64(2)
    out[[i for i in range(0x3100) if i < 32 or chr(i).isspace() or chr(i) in PUNCTUATION]] = 0
    return out


def pack(gram: str) -> int:
    """An n-gram of at most five characters as one number."""
    key = 0
    for c in gram:
        key = key << BITS | (0 if c == START else 1 if c == END else 2 + ord(c) % ((1 << BITS) - 2))
    return key


def hash_table(values: dict[str, float]) -> tuple:
    """Arrays of an open-addressing table: packed n-gram -> number. Of n-grams that pack alike the last stays."""
    packed = {pack(g): v for g, v in values.items()}
    keys = np.fromiter(packed, np.uint64, len(packed))
    numbers = np.fromiter(packed.values(), np.float64, len(packed))
    bits = max(10, math.ceil(math.log2(4 * len(keys) + 1)))
    slots, found, rest, probes = np.full(1 << bits, EMPTY), np.zeros(1 << bits), np.arange(len(keys)), 0
    while len(rest):
        at = ((keys[rest] * MIX >> np.uint64(64 - bits)).astype(np.int64) + probes) & ((1 << bits) - 1)
        free = np.flatnonzero(slots[at] == EMPTY)
        _, first = np.unique(at[free], return_index=True)
        put = free[first]
        slots[at[put]], found[at[put]] = keys[rest[put]], numbers[rest[put]]
        rest = np.delete(rest, put)
        probes += 1
    return slots, found, bits, probes


def lookup(table: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number or 0, found) for each key."""
    slots, numbers, bits, probes = table
    home = (keys * MIX >> np.uint64(64 - bits)).astype(np.int64)
    held = slots[home]
    hit = held == keys
    out = np.where(hit, numbers[home], 0.0)
    rest = np.flatnonzero(~hit & (held != EMPTY))
    for i in range(1, probes):
        if not len(rest):
            break
        at = (home[rest] + i) & ((1 << bits) - 1)
        held = slots[at]
        same = held == keys[rest]
        out[rest[same]] = numbers[at[same]]
        hit[rest[same]] = True
        rest = rest[~same & (held != EMPTY)]
    return out, hit


class Scorer:
    """Features of texts from the tables; many texts at once as one array of characters."""

    def __init__(self, model: dict):
        self.grams, self.contexts, self.order, self.window = model["grams"], model["contexts"], model["order"], model["window"]
        if self.order != 5:
            raise ValueError("packed n-grams have five characters")
        self.codes = codes()
        self.keep = np.array([(1 << BITS * (k + 1)) - 1 for k in range(self.order)], np.uint64)  # inside the word

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Rows (mean over words, best window of words, best word) of length-normalised log-likelihood differences."""
        out, part, size = [], [], 0
        for t in texts:
            part.append(t.lower())
            size += len(t)
            if size > 60_000:
                out.append(self._many(part))
                part, size = [], 0
        if part:
            out.append(self._many(part))
        return np.concatenate(out) if out else np.zeros((0, 3))

    def _many(self, texts: list[str]) -> np.ndarray:
        result = np.zeros((len(texts), 3))
        c = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
        e = self.codes[c]
        inside = e != 0
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1  # the break after each word
        if not len(ends):
            return result
        key = e.copy()
        key[ends] = 1
        key[1:] |= e[:-1] << np.uint64(BITS)
        pair = e.copy()
        pair[1:] |= e[:-1] << np.uint64(BITS)
        key[2:] |= pair[:-2] << np.uint64(2 * BITS)
        key[4:] |= e[:-4] << np.uint64(4 * BITS)
        # place in the word (its end has the word's length): characters before the word's start are cleared
        at = np.arange(len(e))
        start = np.concatenate(([0], np.maximum.accumulate(np.where(inside, 0, at + 1))[:-1]))
        key &= self.keep[np.minimum(at - start, self.order - 1)]
        inside[ends] = True
        v, hit = lookup(self.grams, key)
        miss = np.flatnonzero(~hit & inside)
        if len(miss):
            v[miss] = lookup(self.contexts, key[miss] >> np.uint64(BITS))[0]
        v[~inside] = 0.0
        upto = np.cumsum(v)[ends]
        word = np.diff(upto, prepend=0.0)
        # every word of a text ends at or before the line break that follows the text
        first = np.concatenate(([0], np.searchsorted(ends, np.cumsum([len(t) + 1 for t in texts]), side="left")))
        for d in np.flatnonzero(np.diff(first)):
            w = word[first[d]:first[d + 1]]
            s = np.concatenate(([0.0], np.cumsum(w)))
            k = min(self.window, len(w))
            result[d] = s[-1] / len(w), (s[k:] - s[:-k]).max() / k, w.max()
        return result


def _scorer(sent) -> Scorer:
    """The scorer of a broadcast model, made once in each worker process."""
    held = sent.value
    if "scorer" not in held:
        held["scorer"] = Scorer(held)
    return held["scorer"]


def _labelled(labels: DataFrame) -> DataFrame:
    """doc_id, toxic: one row per id with a label."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def _sample(rows: DataFrame, max_per_class: int) -> DataFrame:
    """At most ``max_per_class`` of the labelled rows per class, those with the least hash of their id."""
    one = lambda c: rows.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class)
    return one(0).unionAll(one(1))


def fold(id_col, n: int):
    """crc32(id as text) mod n."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def fit(docs: DataFrame, labels: DataFrame, order: int = 5, window: int = 4, max_per_class: int = 6_000,
        max_grams: int = 1_000_000, held_out: int = 2):
    """The broadcast models (at most ``max_grams`` n-grams and their contexts) and the curve's weights.

    Labels come from rows whose fold of 4 is not ``held_out``. One of the other folds fits the curve, the two
    others are counted. The rows of the curve weigh as many as their class has labels for each sampled one, so
    that the sample's bound does not move the curve. A label without a document, a null label, or a null id is ignored; of contradicting
    labels toxic wins. Without labels of both classes no document scores above 0.
    """
    calibration = (held_out + 1) % 4
    rows = _labelled(labels.where(fold("doc_id", 4) != held_out))
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    weight = {c: max(1.0, n / max_per_class) for c, n in sizes.items()}
    sample = F.broadcast(_sample(rows, max_per_class))  # bound: 2 * max_per_class rows
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
             .join(sample, "doc_id").select("text", "toxic", (fold("doc_id", 4) == calibration).alias("curve")))

    def count(batches):
        from collections import Counter
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[toxic].update(words(text))
        for toxic in (0, 1):
            found: Counter = Counter()
            for w, n in seen[toxic].items():
                for g in grams_of(w, order):
                    found[g] += n
            part = list(found.items())
            for i in range(0, len(part), 50_000):
                some = part[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in some], pa.string()), pa.array([toxic] * len(some), pa.int32()),
                                                  pa.array([n for _, n in some], pa.int64())], names=["gram", "toxic", "n"])

    grams = (in_batches(texts.where("not curve").select("text", "toxic"), count, "gram string, toxic int, n long")
             .groupBy("gram").agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("o"),
                                  F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"))
             .orderBy(F.desc(F.col("o") + F.col("t")), "gram").limit(max_grams).toArrow())
    models = Models({g: (float(o), float(t)) for g, o, t in zip(*(c.to_pylist() for c in grams.columns), strict=True)}, order)
    by_gram, by_context = models.differences()
    sent = docs.sparkSession.sparkContext.broadcast({"grams": hash_table(by_gram), "contexts": hash_table(by_context),
                                                     "order": order, "window": window})

    def features(batches):
        for batch in batches:
            f = _scorer(sent)(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(f[:, i]) for i in range(3)] + [batch.column(1)], names=["a", "b", "c", "toxic"])

    got = in_batches(texts.where("curve").select("text", "toxic"), features, "a double, b double, c double, toxic int").orderBy("a", "b", "c", "toxic").toArrow()
    x = np.column_stack([got[c].to_numpy() for c in "abc"]) if len(got) else np.zeros((0, 3))
    y = got["toxic"].to_numpy() if len(got) else np.zeros(0)
    return sent, logistic(x, y, np.array([weight[c] for c in y.tolist()]))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 0.1, steps: int = 100) -> np.ndarray:
    """Ridge-penalised logistic weights, bias first, by Newton steps; ``weight``: of each row, else 1."""
    if len(y) == 0 or y.min() == y.max():
        return np.array([-20.0] + [0.0] * 3)
    weight = np.ones(len(y)) if weight is None else weight
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    pen = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + pen @ w
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + pen, grad)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, order: int = 5, window: int = 4, max_per_class: int = 6_000,
          threshold: float = 0.3, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Null and empty texts have no evidence and get the curve's value at zero. Repeated rows get equal scores.
    A null id is not held out. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(fold("doc_id", 4) == held_out, F.lit(False)).alias("held_out"))
    sent, weights = fit(docs, labels, order, window, max_per_class, held_out=held_out)

    def run(batches):
        for batch in batches:
            p = probability(_scorer(sent)(batch.column(1).to_pylist()), weights)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return in_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def probability(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + features @ weights[1:], -500, 500)))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **fitting) -> DataFrame:
    """The documents that score below ``threshold``, all columns as they come; judged row by row in one pass."""
    sent, weights = fit(docs, labels, **fitting)

    def make():
        score_of = _scorer(sent)
        return lambda texts: (probability(score_of([t or "" for t in texts]), weights) < threshold).tolist()

    return filter_rows(docs, make)
