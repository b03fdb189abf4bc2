"""Language-model scoring with a log-frequency Bloom filter.

Counting: tasks turn their training texts into token hashes and send sorted, packed runs of (hash, count) to
the partition that owns the hash range; there they are merged. Bigrams are owned by their first word, so the
owner also knows how much of a context its stored bigrams take. Each owner quantises the counts to levels
(powers of ``base``) and sets the bits of levels 1..q of an entry in its own segment of the filter, which has
``bits_per_entry`` bits for each entry that was counted.

Scoring: a count is found by probing level after level until one is absent. A filter of at most ``max_bytes`` is
broadcast. A larger one stays with the owners: tasks send them the distinct keys of each chunk of texts, they
answer with levels from their segments, and the answers meet the chunk again. Both ways read the same bits, so
scores do not depend on the way. P(word | context) = stored bigram share + the context's remaining mass * P(word),
with rounding always towards less probability, so that probabilities of a context sum to at most one (but
for the filter's false positives).

The exact base score needs exact unigram counts, which grow with the corpus: the ``common`` most frequent
words are broadcast, all other occurrences go as packed runs to the owners of their hashes, which answer with
partial sums per document. No task ever holds the vocabulary.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import materialise

U = np.uint64
END, START = U(0x5BF03635D1F3A9C7), U(0xA24BAED4963EE407)  # never words
CONTEXT_BITS = 28  # of a bigram key that name its first word
WORD, PAIR, MASS = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)  # kinds of filter entries


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


class Tokens:
    """Token hashes of texts: lower-case A-Z, words between ASCII white space, then one end."""

    def __init__(self):
        from xxhash import xxh3_64_intdigest
        self.digest, self.known = xxh3_64_intdigest, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            digest = self.digest
            for i, h in enumerate(found):
                if h is None:
                    w = words[i]
                    found[i] = h = digest(w)
                    if len(w) <= 40:
                        if len(known) >= 300_000:  # a cache only
                            known.clear()
                        known[w] = h
        found.append(int(END))
        return np.array(found, U)


def bigrams(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Keys of (previous, token); texts begin at ``starts``."""
    before = np.concatenate(([START], tokens[:-1]))
    before[starts] = START
    return pair_key(before, tokens)


def pair_key(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    top = U(64 - CONTEXT_BITS)
    return (mix(before) >> top << top) | (mix(token * U(0x9FB21C651E98DF25) ^ before) >> U(CONTEXT_BITS))


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences of six bytes where they allow it (a leading 6), else whole (8)."""
    if not len(values):
        return b""
    d = np.diff(values, prepend=U(0))
    first = d[:1].tobytes()
    rest = d[1:]
    if len(rest) and int(rest.max()) >= 1 << 48:
        return b"\x08" + values.tobytes()
    return b"\x06" + first + np.ascontiguousarray(rest.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, U)
    if raw[0] == 8:
        return np.frombuffer(raw, U, offset=1)
    first = np.frombuffer(raw[1:9], U)
    body = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, 6)
    d = np.zeros((len(body), 8), np.uint8)
    d[:, :6] = body
    return np.cumsum(np.concatenate([first, d.reshape(-1).view(U)]), dtype=U)


def _counts(x: np.ndarray) -> bytes:
    """Counts as bytes with escapes for those over 254."""
    small = np.minimum(x, 255).astype(np.uint8)
    return small.tobytes() + x[small == 255].astype(np.int64).tobytes()


def _uncounts(raw: bytes, n: int) -> np.ndarray:
    x = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    x[x == 255] = np.frombuffer(raw, np.int64, offset=n)
    return x


def owner_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Owner by range of the key's upper half."""
    return ((keys >> U(32)) * U(parts) >> U(32)).astype(np.int64)


def _runs(keys: np.ndarray, parts: int):
    """(owner, unique keys, counts) of each owner that has some."""
    unique, n = np.unique(keys, return_counts=True)
    cuts = np.searchsorted(owner_of(unique, parts), np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)):
        s = slice(cuts[p], cuts[p + 1])
        yield int(p), unique[s], n[s]


def _merge(runs: list) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate([k for k, _ in runs]), np.concatenate([c for _, c in runs])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


RUN = "kind int, owner int, keys binary, counts binary, n long"


def _count(training: DataFrame, parts: int, flush: int) -> DataFrame:
    """Merged counts: one row per kind (0 words, 1 bigrams) and owner."""
    def run(batches):
        tokens, held, starts, size = Tokens(), [], [], 0

        def send():
            t = np.concatenate(held)
            out = [(kind, p, pack(k), _counts(c), len(k)) for kind, x in ((0, t), (1, bigrams(t, np.array(starts)))) for p, k, c in _runs(x, parts)]
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["kind", "owner", "keys", "counts", "n"])

        for batch in batches:
            for text in batch.column(0):
                t = tokens(text.as_py())
                starts.append(size)
                held.append(t)
                size += len(t)
                if size >= flush:
                    yield send()
                    held, starts, size = [], [], 0
        if held:
            yield send()

    def merge(batches):
        key, held = None, []

        def done():
            keys, n = _merge(held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([pack(keys)], pa.binary()),
                                               pa.array([_counts(n)], pa.binary()), pa.array([len(keys)], pa.int64())], names=["kind", "owner", "keys", "counts", "n"])

        size = 0
        for batch in batches:
            for kind, p, keys, counts, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (kind, p) != key:
                    if held:
                        yield done()
                    key, size = (kind, p), 0
                held.append((unpack(keys), _uncounts(counts, n)))
                size += n
                if size > 8_000_000:  # fold what has come so far: memory follows the distinct keys
                    held[:] = [_merge(held)]
                    size = len(held[0][0])
        if held:
            yield done()

    runs = training.mapInArrow(run, RUN).repartition(parts, "kind", "owner").sortWithinPartitions("kind", "owner")
    return materialise(runs.mapInArrow(merge, RUN), "lm-counts")


def places(keys: np.ndarray, level: int, i: int, m) -> np.ndarray:
    """The i-th bit of (key, level) in a segment of m bits."""
    h = mix(keys + U(level * 0x632BE59BD9B4E019 + i * 0xE220A8397B1DCDAF & 0xFFFFFFFFFFFFFFFF))
    return ((h >> U(32)) * U(m) >> U(32)).astype(np.int64)


def levels(bits: np.ndarray, keys: np.ndarray, origin: np.ndarray, m: np.ndarray, hashes: int) -> np.ndarray:
    """Largest level such that it and all below are present, in segments of m bits that start at ``origin``."""
    q = np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    level = 0
    while len(live):
        level += 1
        for i in range(hashes):
            at = origin[live] + places(keys[live], level, i, m[live])
            live = live[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            if not len(live):
                break
        q[live] = level
    return q


def bucket_of(keys: np.ndarray) -> np.ndarray:
    """The part of bigram keys, or of mixed first words, that names the first word."""
    return keys >> U(64 - CONTEXT_BITS) << U(64 - CONTEXT_BITS)


def low_of(q: np.ndarray, least: int, base: float) -> np.ndarray:
    """The smallest count of a level; 0 for level 0."""
    return np.where(q > 0, np.ceil(least * base ** (q - 1.0) - 1e-6), 0.0)


def high_of(q: np.ndarray, least: int, base: float) -> np.ndarray:
    """The largest count of a level; 0 for level 0."""
    return np.where(q > 0, np.ceil(least * base ** q.astype(np.float64) - 1e-6) - 1.0, 0.0)


def level_of(n: np.ndarray, least: int, base: float) -> np.ndarray:
    """Level of a count: the largest q with least * base ** (q - 1) <= n; 0 below ``least``."""
    q = np.floor(np.log(np.maximum(n, 1) / least) / math.log(base) + 1e-9).astype(np.int64) + 1
    return np.where(n >= least, q, 0)


class Places:
    """The distinct keys that the places (before, token) of some texts probe, and each place's number among them."""

    def __init__(self, before: np.ndarray, tokens: np.ndarray):
        self.words, at = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        self.token, self.context = at[:len(tokens)], at[len(tokens):]
        self.pairs, self.pair = np.unique(pair_key(before, tokens), return_inverse=True)
        self.buckets, self.bucket = np.unique(bucket_of(mix(self.words)), return_inverse=True)

    def keys(self) -> tuple:
        """(kind, sorted keys): owners have ranges of them."""
        return (WORD, self.words), (PAIR, self.pairs), (MASS, self.buckets)


class Model:
    """Counts from the filter, and probabilities."""

    def __init__(self, held: dict):
        self.__dict__.update(held)
        if self.filter is not None:
            self.array = np.frombuffer(self.filter, np.uint8)
            self.origins = np.cumsum(self.sizes) - self.sizes

    def _level(self, keys: np.ndarray, kind: U) -> np.ndarray:
        owner = owner_of(keys, self.parts)
        return levels(self.array, keys ^ kind, self.origins[owner], self.sizes[owner], self.hashes)

    def log10(self, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """log10 P(token | before) for each place; every distinct word, context and bigram is probed once."""
        at = Places(before, tokens)
        return self.log10_of(at, *(self._level(keys, kind) for kind, keys in at.keys()))

    def log10_of(self, at: Places, words: np.ndarray, pairs: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """The same from the levels of the keys."""
        p1 = ((low_of(words, 1, self.base) + 1.0) / (self.total + self.distinct + 1.0))[at.token]
        pair = low_of(pairs, self.least, self.base)[at.pair]
        # what divides is never less than the true count
        upper = high_of(words, 1, self.base)
        upper[at.words == START] = self.texts
        mass = high_of(buckets, self.least, self.base)[at.bucket]
        rest = np.where(upper > 0, np.maximum(0.0, 1.0 - mass / np.maximum(upper, 1.0)), 1.0)[at.context]
        upper = upper[at.context]
        share = np.where(upper > 0, np.minimum(pair / np.maximum(upper, 1.0), 1.0), 0.0)
        return np.log10((1 - self.floor) * (share + rest * p1) + self.floor * p1)


def fit(training: DataFrame, common: int, base: float, least: int, hashes: int, bits_per_entry: float, max_bytes: int, floor: float, flush: int) -> tuple[dict, DataFrame]:
    """The broadcast part of the model and the table of exact counts by owner.

    A filter over ``max_bytes`` is not in the broadcast part, which then has the table of its segments.
    """
    spark = training.sparkSession
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = _count(training, parts, flush)

    def masses(keys, x):  # what each context's stored bigrams take
        low = low_of(level_of(x, least, base), least, base)
        bucket = bucket_of(keys)
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        return bucket[first], np.add.reduceat(low, first)

    def describe(batches):  # totals, and the entries of each owner's segment: one for each level
        for batch in batches:
            for kind, p, keys, counts_, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = _uncounts(counts_, n)
                entries = level_of(x, 1 if kind == 0 else least, base).sum()
                if kind == 1:
                    entries += level_of(masses(unpack(keys), x)[1], least, base).sum()
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((kind, pa.int32()), (p, pa.int32()), (int(entries), pa.int64()), (n, pa.int64()), (int(x.sum()), pa.int64()))],
                                                 names=["kind", "owner", "entries", "distinct", "tokens"])

    stats = counts.mapInArrow(describe, "kind int, owner int, entries long, distinct long, tokens long").toArrow()  # two rows for each owner
    is_word = stats["kind"].to_numpy() == 0
    total, distinct = (int(stats[c].to_numpy()[is_word].sum()) for c in ("tokens", "distinct"))
    entries = np.bincount(stats["owner"].to_numpy(), stats["entries"].to_numpy(), parts)
    sizes = ((entries * bits_per_entry).astype(np.int64) + (1 << 13)) // 8 * 8

    def build(batches):
        for batch in batches:
            for kind, p, keys, counts_, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, x = unpack(keys), _uncounts(counts_, n)
                bits = np.zeros(sizes[p], bool)

                def put(entry, value, least_, bits=bits, m=sizes[p]):
                    q = level_of(value, least_, base)
                    for level in range(1, int(q.max(initial=0)) + 1):
                        e = entry[q >= level]
                        for i in range(hashes):
                            bits[places(e, level, i, m)] = True

                if kind == 0:
                    put(keys ^ WORD, x, 1)
                else:
                    put(keys ^ PAIR, x, least)
                    bucket, low = masses(keys, x)
                    put(bucket ^ MASS, low, least)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["owner", "bits"])

    # the two kinds of an owner fill one segment: or-ed where they are read
    segments, filter_ = counts.mapInArrow(build, "owner int, bits binary"), None
    if sizes.sum() <= 8 * max_bytes:
        ends = np.cumsum(sizes) // 8
        array = np.zeros(int(ends[-1]), np.uint8)
        for r in segments.toLocalIterator():
            array[ends[r.owner] - sizes[r.owner] // 8:ends[r.owner]] |= np.frombuffer(r.bits, np.uint8)
        segments, filter_ = None, array.tobytes()
    else:
        segments = materialise(segments, "lm-filter")

    def frequent(batches):  # each owner's candidates for the common words
        for batch in batches:
            for keys, counts_, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, x = unpack(keys), _uncounts(counts_, n)
                top = np.argsort(-x, kind="stable")[:2 * common // parts + 1]
                yield pa.RecordBatch.from_arrays([pa.array(keys[top].view(np.int64)), pa.array(x[top])], names=["key", "n"])

    top = counts.where("kind = 0").select("keys", "counts", "n").mapInArrow(frequent, "key long, n long").orderBy(F.desc("n"), "key").limit(common).toArrow()
    keys = top["key"].to_numpy().view(U) if len(top) else np.zeros(0, U)
    order = np.argsort(keys)
    end = counts.where("kind = 0").select("keys", "counts", "n").mapInArrow(lambda batches: _find(batches, END), "n long").agg(F.sum("n")).first()[0]  # a text has one end
    held = {"filter": filter_, "segments": segments, "sizes": sizes, "parts": parts, "hashes": hashes, "base": base, "least": least, "floor": floor,
            "total": int(total), "distinct": int(distinct), "texts": float(end or 0), "common_keys": keys[order], "common_counts": top["n"].to_numpy()[order] if len(top) else np.zeros(0, np.int64)}
    return held, counts


def _find(batches, key):
    """The count of one key, from the run that has it."""
    for batch in batches:
        for keys, counts, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at = np.flatnonzero(unpack(keys) == key)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(_uncounts(counts, n)[at])], names=["n"])


RARE, PROBE, CHUNK = 1, 2, 5  # kinds of what a chunk of texts sends: words to count, keys to probe (words, bigrams, contexts), itself


def _levels_joined(asked: DataFrame, segments: DataFrame, held: dict) -> DataFrame:
    """(row, model) of every text: the chunks' keys meet their owners' segments, the levels found meet the chunks."""
    parts, sizes, hashes = held["parts"], held["sizes"], held["hashes"]
    held = {k: v for k, v in held.items() if not k.startswith("common")}
    asks = (segments.select("owner", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("row"), F.col("bits").alias("keys"))
            .unionAll(asked.where(F.col("kind").between(PROBE, CHUNK - 1)).select("owner", "kind", "row", "keys"))
            .repartition(parts, "owner").sortWithinPartitions("owner", "kind"))

    def look(batches):
        owner, bits = None, None
        for batch in batches:
            out = []
            for p, kind, row, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != owner:
                    owner, bits = p, np.zeros(sizes[p] // 8, np.uint8)
                if kind == 0:
                    bits |= np.frombuffer(raw, np.uint8)
                    continue
                keys = unpack(raw) ^ (WORD, PAIR, MASS)[kind - PROBE]
                q = levels(bits, keys, np.zeros(len(keys), np.int64), np.full(len(keys), sizes[p]), hashes)
                out.append((row, kind, p, q.astype(np.uint16).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                                                 names=["row", "kind", "owner", "keys"])

    back = (asks.mapInArrow(look, "row long, kind int, owner int, keys binary").select("row", "kind", "owner", "keys", F.lit(None).cast("binary").alias("counts"))
            .unionAll(asked.where(F.col("kind") == CHUNK).select("row", "kind", "owner", "keys", "counts"))
            .repartition(parts, "row").sortWithinPartitions("row", "kind", "owner"))

    def finish(batches):
        model, found = Model(held), {}
        for batch in batches:
            for _, kind, _, raw, chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind < CHUNK:
                    found.setdefault(kind, []).append(np.frombuffer(raw, np.uint16))
                    continue
                n = int(np.frombuffer(chunk, np.int64, 1)[0])
                rows, lengths = np.frombuffer(chunk, np.int64, 2 * n, 8).reshape(2, n)
                t = unpack(raw)[np.frombuffer(chunk, np.uint32, offset=8 + 16 * n)]
                starts = np.cumsum(lengths) - lengths
                before = np.concatenate(([START], t[:-1]))
                before[starts] = START
                q = [np.concatenate(found.pop(k)).astype(np.int64) for k in range(PROBE, CHUNK)]
                logs = np.add.reduceat(model.log10_of(Places(before, t), *q), starts)
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(logs)], names=["row", "model"])

    return back.mapInArrow(finish, "row long, model double")


def score(docs: DataFrame, held_out: int = 2, common: int = 200_000, base: float = 2 ** 0.5, least: int = 2, hashes: int = 6, bits_per_entry: float = 12.0,
          max_bytes: int = 64 << 20, floor: float = 0.02, flush: int = 1_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document.

    Trained on the rows whose crc32(doc_id as text) mod 7 is not ``held_out``; null ids train. Null or empty
    text: one end token. Repeated rows count as often as they come and score alike. Nothing to train on: base
    score by the empty model. Bigrams below ``least`` occurrences are not stored in the filter (they fall to the
    remaining mass); the counts themselves cover every token. A filter over ``max_bytes`` is not broadcast but
    asked where its segments lie, with the same scores. Empty table: no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == held_out, F.lit(False)).alias("held_out"))
    held, counts = fit(rows.where("not held_out").select("text"), common, base, least, hashes, bits_per_entry, max_bytes, floor, flush)
    parts, total, distinct = held["parts"], held["total"], held["distinct"]
    segments = held.pop("segments")
    sent = spark.sparkContext.broadcast(held)
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")

    def ask(batches):
        if "model" not in sent.value:
            sent.value["model"] = Model({k: v for k, v in sent.value.items() if k != "model"})
        model, tokens = sent.value["model"], Tokens()
        names = ["row", "doc_id", "held_out", "tokens", "known", "logs", "model", "kind", "owner", "keys", "counts"]

        def asking(row, kind, owners, keys, counts_):
            k = len(keys)
            none = lambda t: pa.nulls(k, t)
            return pa.RecordBatch.from_arrays([pa.array([row] * k, pa.int64()), none(pa.int64()), none(pa.bool_()), none(pa.int64()), none(pa.int64()), none(pa.float64()), none(pa.float64()),
                                               pa.array([kind] * k, pa.int32()), pa.array(list(owners), pa.int32()), pa.array(keys, pa.binary()), pa.array(counts_, pa.binary())], names=names)

        def answer(ids, texts):
            lengths = np.array([len(t) for t in texts])
            t = np.concatenate(texts)
            starts = np.cumsum(lengths) - lengths
            before = np.concatenate(([START], t[:-1]))
            before[starts] = START
            keys_at = Places(before, t)
            words, w = keys_at.words, keys_at.token
            if model.filter is None:  # the distinct keys go to their owners, the chunk waits for the levels
                logs = pa.nulls(len(ids), pa.float64())
                for kind, (_, key) in enumerate(keys_at.keys(), PROBE):
                    cuts = np.searchsorted(owner_of(key, parts), np.arange(parts + 1))
                    some = np.flatnonzero(np.diff(cuts))
                    yield asking(ids[0][0], kind, some, [pack(key[cuts[p]:cuts[p + 1]]) for p in some], [None] * len(some))
                head = np.concatenate([np.array([len(ids)], np.int64), np.array([x[0] for x in ids], np.int64), lengths.astype(np.int64)])
                yield asking(ids[0][0], CHUNK, [None], [pack(words)], [head.tobytes() + w.astype(np.uint32).tobytes()])
            else:
                logs = pa.array(np.add.reduceat(model.log10_of(keys_at, *(model._level(key, kind) for kind, key in keys_at.keys())), starts))
            at = np.minimum(np.searchsorted(model.common_keys, words), max(len(model.common_keys) - 1, 0))
            is_common = model.common_keys[at] == words if len(model.common_keys) else np.zeros(len(words), bool)
            c = np.where(is_common, model.common_counts[at], 0) if len(model.common_keys) else np.zeros(len(words), np.int64)
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in ids], pa.int64()), pa.array([x[1] for x in ids], pa.int64()), pa.array([x[2] for x in ids], pa.bool_()),
                 pa.array(lengths.astype(np.int64)), pa.array(np.add.reduceat(is_common[w].astype(np.int64), starts)), pa.array(np.add.reduceat(np.log10(c + 1.0)[w], starts)),
                 logs, pa.array([None] * n, pa.int32()), pa.array([None] * n, pa.int32()), pa.array([None] * n, pa.binary()), pa.array([None] * n, pa.binary())], names=names)
            rare = np.flatnonzero(~is_common[w])
            if len(rare):
                doc = np.repeat(np.arange(n), lengths)[rare]
                key = t[rare]
                order = np.argsort(key, kind="stable")
                key, doc = key[order], np.array([x[0] for x in ids], np.int64)[doc[order]]
                cuts = np.searchsorted(owner_of(key, parts), np.arange(parts + 1))
                some = np.flatnonzero(np.diff(cuts))
                first = int(doc.min())
                body = [pack(key[cuts[p]:cuts[p + 1]]) for p in some]
                to = [(doc[cuts[p]:cuts[p + 1]] - first).astype(np.uint32).tobytes() for p in some]
                yield asking(first, RARE, some, body, to)

        ids, texts, size = [], [], 0
        for batch in batches:
            for row, doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                t = tokens(text.as_py())
                ids.append((row, doc, out))
                texts.append(t)
                size += len(t)
                if size >= flush:
                    yield from answer(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield from answer(ids, texts)

    asked = materialise(numbered.mapInArrow(ask, "row long, doc_id long, held_out boolean, tokens long, known long, logs double, model double, kind int, owner int, keys binary, counts binary"), "lm-asked")
    meet = (counts.where("kind = 0").select("owner", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("row"), "keys", "counts", "n")
            .unionAll(asked.where(F.col("kind") == RARE).select("owner", F.lit(1), "row", "keys", "counts", F.lit(None).cast("long")))
            .repartition(parts, "owner").sortWithinPartitions("owner", "kind"))

    def tell(batches):
        """Partial sums per row for the tokens that an owner was asked for, of which it knows some."""
        owner, keys, n = None, np.zeros(0, U), np.zeros(0, np.int64)
        for batch in batches:
            for p, kind, row, raw, other, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != owner:
                    owner, keys, n = p, np.zeros(0, U), np.zeros(0, np.int64)
                if kind == 0:
                    keys, n = unpack(raw), _uncounts(other, size)
                    continue
                if not len(keys):
                    continue
                key, doc = unpack(raw), np.frombuffer(other, np.uint32)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                if hit.any():
                    docs_, d = np.unique(doc[hit], return_inverse=True)
                    yield pa.RecordBatch.from_arrays([pa.array(docs_.astype(np.int64) + row), pa.array(np.bincount(d).astype(np.int64)),
                                                      pa.array(np.bincount(d, np.log10(n[at[hit]] + 1.0)))], names=["row", "known", "logs"])

    told = meet.mapInArrow(tell, "row long, known long, logs double")
    whole = (asked.where("kind is null").select("row", "doc_id", "held_out", "tokens", "known", "logs", "model")
             .unionAll(told.select("row", F.lit(None).cast("long"), F.lit(None).cast("boolean"), F.lit(None).cast("long"), "known", "logs", F.lit(None).cast("double"))))
    if segments is not None:
        scored = _levels_joined(asked, segments, held)
        whole = whole.unionAll(scored.select("row", F.lit(None).cast("long"), F.lit(None).cast("boolean"), F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("double"), "model"))
    whole = (whole.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("tokens").alias("n_tokens"), F.sum("known").alias("n_known"),
                                 F.sum("logs").alias("logs"), F.max("model").alias("score")))
    below = math.log10(total + distinct + 1)
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                        (F.col("logs") - F.col("n_tokens") * F.lit(below)).alias("base_score"), "score")
