"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A text is its folded words (lower case, no punctuation). Its sketch holds, for each of ``bands`` hash functions,
the smallest occurrence-labelled five-word k-mers in text order: two texts agree on a band with a chance that
falls with their edit distance. Agreeing texts are candidates; a candidate pair is a link if the word-level
edit similarity (1 - distance / longer length), found by alignment in a band, reaches the threshold.

Groups: equal texts are one class from the start. Within a bucket every member meets the bucket's pivot;
buckets of at most ``small`` members also meet pairwise; larger ones are split by longer keys (4, then 8 k-mers
in order), where the same holds, and the largest of those meet two pivots. Components of the pivots' links are
formed first; only pairs that still lie in different components are aligned after that, which changes no
component. Last, the large buckets that still hold several components are compared whole, block against block:
of members of different components every pair is held against a bound from below of its distance, and those
that the bound allows are aligned. No group is ever gathered in one task, and no pair within a component is
written out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import components, in_batches, materialise, place
from parcelle.llm.decontamination import fold

U = np.uint64
LEVELS = (2, 4, 8)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Words:
    """64-bit hashes of the folded words of a text."""

    def __init__(self):
        from xxhash import xxh3_64_intdigest
        self.digest, self.known = xxh3_64_intdigest, {}

    def __call__(self, text: str) -> np.ndarray:
        words = fold(text).split()
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            for i, h in enumerate(found):
                if h is None:
                    w = words[i]
                    found[i] = h = self.digest(w.encode("utf-8", "surrogatepass"))
                    if len(w) <= 40:
                        if len(known) >= 300_000:  # a cache only
                            known.clear()
                        known[w] = h
        return np.array(found, U)


def labelled_kmers(words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(k-mers, k-mers with the number of their occurrence); a shorter text is one k-mer."""
    k = min(k, len(words))
    n = len(words) - k + 1
    kmers = np.zeros(n, U)
    for i in range(k):
        kmers = mix(kmers * U(0x9E3779B97F4A7C15) + words[i:i + n])
    order = np.argsort(kmers, kind="stable")
    s = kmers[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    if new.all():
        return kmers, kmers
    at = np.arange(n)
    occurrence = np.zeros(n, U)
    occurrence[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(U)
    return kmers, kmers + occurrence * U(0xC2B2AE3D27D4EB4F)


def seeds(bands: int) -> np.ndarray:
    return mix(np.arange(1, bands + 1, dtype=U) * U(0xA0761D6478BD642F))


def sketch(words: np.ndarray, k: int, band_seeds: np.ndarray) -> np.ndarray:
    """Keys (bands, levels): the hash of the 2, 4 and 8 smallest labelled k-mers in text order."""
    kmers, labelled = labelled_kmers(words, k)
    n, most = len(kmers), LEVELS[-1]
    out = np.empty((len(band_seeds), len(LEVELS)), U)
    step = max(1, 2_000_000 // n)
    for b in range(0, len(band_seeds), step):
        s = band_seeds[b:b + step]
        h = (labelled ^ s[:, None]) * U(0xE7037ED1A0B428DB)
        h = (h ^ (h >> U(32))) * U(0x8EBC6AF09C88C6E3)
        low = np.argpartition(h, most - 1, axis=1)[:, :most] if n > most else np.broadcast_to(np.arange(n), h.shape)
        low = np.take_along_axis(low, np.argsort(np.take_along_axis(h, low, 1), axis=1), 1)
        for j, level in enumerate(LEVELS):
            place = np.sort(low[:, :level], axis=1)
            key = np.full(len(s), level, U)
            for i in range(place.shape[1]):
                key = mix(key * U(0x9E3779B97F4A7C15) + kmers[place[:, i]])
            out[b:b + step, j] = key
    return out


def distances(pairs: list[tuple[np.ndarray, np.ndarray]], limits: np.ndarray, first_band: int = 8) -> np.ndarray:
    """Edit distances of word sequences where they are within ``limits``, else -1.

    Alignment in a diagonal band, many pairs of like length at once. The first band follows the words that one
    text has and the other lacks; a pair whose distance does not fit is aligned again in a band twice as wide,
    until the band covers its limit.
    """
    result = np.full(len(pairs), -1, np.int64)
    trimmed: dict[int, list] = {}  # by band
    for i, (a, b) in enumerate(pairs):
        if abs(len(a) - len(b)) > limits[i]:
            continue
        m = min(len(a), len(b))
        differs = np.flatnonzero(a[:m] != b[:m])
        lead = int(differs[0]) if len(differs) else m
        a, b = a[lead:], b[lead:]
        m = min(len(a), len(b))
        differs = np.flatnonzero(a[len(a) - m:][::-1] != b[len(b) - m:][::-1]) if m else ()
        tail = int(differs[0]) if len(differs) else m
        a, b = a[:len(a) - tail], b[:len(b) - tail]
        if not len(a) or not len(b):
            d = max(len(a), len(b))
            result[i] = d if d <= limits[i] else -1
            continue
        # words of one text that the other lacks bound the distance from below
        ua, ca = np.unique(a, return_counts=True)
        ub, cb = np.unique(b, return_counts=True)
        _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
        least = max(len(a), len(b)) - int(np.minimum(ca[ia], cb[ib]).sum())
        if least <= limits[i]:
            band = first_band
            while band < 1.5 * least:
                band *= 2
            trimmed.setdefault(band, []).append((i, a, b) if len(a) <= len(b) else (i, b, a))
    while trimmed:
        band = min(trimmed)
        todo = sorted(trimmed.pop(band), key=lambda x: len(x[1]))
        at = 0
        while at < len(todo):
            shortest, size = len(todo[at][1]), 1
            while at + size < len(todo) and size < max(8, 16_384 // (2 * band + 1)) and (n := len(todo[at + size][1])) <= 1.25 * shortest + 16 and size * (n + 2 * band) < 4_000_000:
                size += 1
            group = todo[at:at + size]
            at += size
            found = _banded(group, band)
            for (i, a, b), d in zip(group, found.tolist(), strict=True):
                if d <= band:
                    result[i] = d if d <= limits[i] else -1
                elif band < limits[i]:
                    trimmed.setdefault(band * 2, []).append((i, a, b))
    return result


def _banded(group, band: int) -> np.ndarray:
    """Distances of (_, a, b), len(a) <= len(b), within a band of diagonals; more than ``band`` where unknown."""
    g, width = len(group), 2 * band + 1
    la = np.array([len(a) for _, a, _ in group])
    lb = np.array([len(b) for _, _, b in group])
    n = int(la.max())
    kind = group[0][1].dtype  # words have no top bit, so these two equal none
    a_pad = np.full((g, n), np.iinfo(kind).max, kind)
    b_pad = np.full((g, n + width + 1), np.iinfo(kind).max - 1, kind)
    for r, (_, a, b) in enumerate(group):
        a_pad[r, :len(a)] = a
        part = b[:n + width - band]
        b_pad[r, band:band + len(part)] = part
    far = np.int32(1 << 28)  # grows by one a row at most
    slope = np.arange(width, dtype=np.int32)
    d = np.where(slope >= band, slope - band, far).astype(np.int32)[None, :].repeat(g, 0)
    out = np.full(g, band + 1, np.int64)
    last = lb - la + band
    step, differ = np.empty_like(d), np.empty(d.shape, bool)
    for i in range(n):
        np.not_equal(b_pad[:, i:i + width], a_pad[:, i, None], out=differ)
        np.add(d, differ, out=step)
        d += 1
        np.minimum(step[:, :-1], d[:, 1:], out=step[:, :-1])
        step -= slope
        np.minimum.accumulate(step, axis=1, out=step)
        step += slope
        d, step = step, d
        done = np.flatnonzero(la == i + 1)
        for r in done:
            if 0 <= last[r] < width:
                out[r] = d[r, last[r]]
    return out


SKETCH = "row struct<file:long,at:long>, doc_id long, fp1 long, fp2 long, words int, key2 array<long>, key4 array<int>, key8 array<int>"


def sketches(docs: DataFrame, bands: int, k: int, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row per document of a Parquet table: its place, id, fingerprint of the folded text, number of words and
    band keys."""
    def run(batches):
        from xxhash import xxh3_128_digest
        words, band_seeds = Words(), seeds(bands)
        for batch in batches:
            fps, sizes, keys = [], [], [[], [], []]
            for text in batch.column(2):
                text = text.as_py()
                w = words(text)
                fps.append(np.frombuffer(xxh3_128_digest(w.tobytes() if len(w) else b"\x00" + text.encode("utf-8", "surrogatepass")), np.int64))
                sizes.append(len(w))
                s = sketch(w, k, band_seeds) if len(w) else None
                for j in range(3):
                    x = None if s is None else s[:, j].view(np.int64) if j == 0 else (s[:, j] >> U(32)).astype(np.uint32).view(np.int32)
                    keys[j].append(x)
            fp = np.array(fps).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp[:, 0]), pa.array(fp[:, 1]), pa.array(sizes, pa.int32()),
                                              pa.array(keys[0], pa.list_(pa.int64())), pa.array(keys[1], pa.list_(pa.int32())), pa.array(keys[2], pa.list_(pa.int32()))],
                                             names=["row", "doc_id", "fp1", "fp2", "words", "key2", "key4", "key8"])

    return in_batches(_numbered(docs, text_col, id_col), run, SKETCH)


def _numbered(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return docs.select(place(docs).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _candidates(classes: DataFrame, small: int, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pivot pairs, further pairs) of class numbers whose lengths allow the threshold, and the members of the
    buckets of more than ``small``."""
    member = F.struct(F.xxhash64("cid").alias("order"), "cid", "words")
    rows = (classes.where("key2 is not null").select("cid", "words", F.posexplode(F.arrays_zip("key2", "key4", "key8")).alias("band", "k"))
            .select("band", "cid", "words", "k.key2", "k.key4", "k.key8"))
    stars, more, large = [], [], None
    key = ["band"]
    for level in LEVELS:
        key = [*key, f"key{level}"]
        buckets = rows.groupBy(*key).agg(F.count("*").alias("n"), F.min(member).alias("lo"), F.max(member).alias("hi")).where("n > 1")
        met = rows.join(buckets, key)
        stars.append(met.select(F.col("lo.cid").alias("a"), F.col("lo.words").alias("na"), F.col("cid").alias("b"), F.col("words").alias("nb")))
        more.append(met.where(F.col("n") > small).select(F.col("hi.cid").alias("a"), F.col("hi.words").alias("na"), F.col("cid").alias("b"), F.col("words").alias("nb")))
        few = met.where((F.col("n") <= small) & (F.col("n") > 2)).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("cid", "words"))).alias("all"))  # at most ``small``
        pairs = few.select(F.explode(F.flatten(F.transform("all", lambda x, i: F.transform(F.slice("all", i + 2, small), lambda y: F.struct(x.alias("x"), y.alias("y")))))).alias("p"))
        more.append(pairs.select(F.col("p.x.cid").alias("a"), F.col("p.x.words").alias("na"), F.col("p.y.cid").alias("b"), F.col("p.y.words").alias("nb")))
        if level != LEVELS[-1]:
            rows = materialise(met.where(F.col("n") > small).select(*rows.columns), "large-buckets")
            large = large or rows.select("band", "key2", "cid", "words")

    def tidy(parts):
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        near = F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb") - 1e-9
        return out.where((F.col("a") != F.col("b")) & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    return materialise(tidy(stars), "pivot-pairs"), materialise(tidy(more), "pairs"), large


CELLS = 256  # of a histogram of words


def histogram(words: np.ndarray) -> np.ndarray:
    """Words by cell, up to 255 each: what one histogram has over another bounds the edit distance from below."""
    return np.minimum(np.bincount(words % CELLS, minlength=CELLS), 255).astype(np.uint8)


UNIT_WORDS, PAIR_WORDS = 2_000_000, 4_000_000  # words of a block of a bucket, and of the pairs aligned at once
ALIGN_BYTES = 16 << 20  # of the words of candidate pairs aligned at once


class Forest:
    """Components that links join, by their numbers."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, c: int) -> int:
        while (above := self.up.get(c, c)) != c:
            self.up[c] = self.up.get(above, above)
            c = above
        return c

    def roots(self, components: np.ndarray) -> np.ndarray:
        if not self.up:
            return components
        some, at = np.unique(components, return_inverse=True)
        return np.array([self.root(int(c)) for c in some], np.int64)[at]


def _links(left: tuple, right: tuple, band: int, threshold: float, within: bool) -> list[tuple[int, int]]:
    """Pairs of class numbers whose texts reach the threshold, as many as join what such pairs join.

    A side is (class numbers, components, texts, histograms, band keys); ``within``: both are the same, each pair
    is met once. Pairs are aligned unless they are joined already, their lengths or histograms forbid it, or they
    share a bucket of an earlier band, where they meet as well.
    """
    (a, ca, ta, ha, ka), (b, cb, tb, hb, kb) = left, right
    na, nb = (np.array([len(x) for x in t], np.int64) for t in (ta, tb))
    forest, found, waiting, held = Forest(), [], [], 0
    ra, rb = ca, cb

    def align() -> bool:
        todo = [(i, j) for i, j in waiting if forest.root(int(ca[i])) != forest.root(int(cb[j]))]
        waiting.clear()
        limits = np.array([int((1 - threshold) * max(na[i], nb[j]) + 1e-9) for i, j in todo], np.int64)
        good = np.flatnonzero(distances([(ta[i], tb[j]) for i, j in todo], limits) >= 0) if todo else ()
        before = len(found)
        for k in good:
            i, j = todo[k]
            x, y = forest.root(int(ca[i])), forest.root(int(cb[j]))
            if x != y:
                forest.up[max(x, y)] = min(x, y)
                found.append((int(min(a[i], b[j])), int(max(a[i], b[j]))))
        return len(found) > before

    for i in range(len(a)):
        limit = ((1 - threshold) * np.maximum(na[i], nb) + 1e-9).astype(np.int64)
        at = np.flatnonzero((rb != ra[i]) & (np.abs(nb - na[i]) <= limit))
        if within:
            at = at[at > i]
        if band and len(at):
            at = at[~(kb[at, :band] == ka[i, :band]).any(axis=1)]
        if not len(at):
            continue
        more = hb[at].astype(np.int16) - ha[i]
        over = np.maximum(more, 0).sum(axis=1, dtype=np.int64)
        at = at[np.maximum(over, over - more.sum(axis=1, dtype=np.int64)) <= limit[at]]
        for j in at.tolist():
            waiting.append((i, j))
            held += int(na[i] + nb[j])
            if held > PAIR_WORDS or len(waiting) >= 512:
                held = 0
                if align():
                    ra, rb = forest.roots(ca), forest.roots(cb)
    align()
    return found


def _whole_buckets(large: DataFrame, part: DataFrame, classes: DataFrame, texts: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links (a, b) between different components that members of a large bucket lie in, texts compared block against
    block: of each two blocks at most a spanning forest of their components is written, not their pairs."""
    keys = ["band", "key2"]
    members = (large.join(part.select(F.col("node").alias("cid"), "component"), "cid", "left")
               .withColumn("component", F.coalesce("component", "cid")))
    blocks = F.ceil(F.greatest(F.col("n") / block, F.col("words") / UNIT_WORDS)).cast("int").alias("blocks")
    mixed = (members.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select(*keys, blocks))
    members = materialise(members.join(mixed, keys).drop("words"), "mixed-buckets")
    told = members.join(classes.select("cid", F.col("key2").alias("keys")), "cid").join(texts, "cid")
    group = [*keys, "one", "two"]
    units = (told.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*keys, F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
                     F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "cid", "component", "keys", "words")
             .repartition(*group).sortWithinPartitions(*group))

    def compare(batches):
        key, held = None, []

        def done():
            side, cid, component = (np.concatenate([h[i] for h in held]) for i in range(3))
            band_keys = np.array([x for h in held for x in h[3]], np.int64)
            words = [np.frombuffer(x, np.uint32) for h in held for x in h[4]]
            held.clear()

            def pick(at):
                at = np.flatnonzero(at)
                some = [words[i] for i in at]
                return cid[at], component[at], some, np.array([histogram(w) for w in some]), band_keys[at]

            same = key[2] == key[3]
            if same or (side == 0).any() and (side == 1).any():
                left = pick(side == 0)
                found = _links(left, left if same else pick(side == 1), key[0], threshold, same)
                return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(2)], names=["a", "b"])
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, names=["a", "b"])

        for batch in batches:
            marks = np.column_stack([batch.column(i).to_numpy() for i in range(4)])
            cuts = np.concatenate(([0], np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1, [len(marks)])) if len(marks) else []
            for i, j in zip(cuts, cuts[1:], strict=False):
                if (mark := tuple(marks[i].tolist())) != key:
                    if held:
                        yield done()
                    key = mark
                some = batch.slice(i, j - i)
                held.append((*(some.column(c).to_numpy() for c in range(4, 7)), some.column(7).to_pylist(), some.column(8).to_pylist()))
        if held:
            yield done()

    return materialise(in_batches(units, compare, "a long, b long"), "bucket-links")


def _aligned(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose texts reach the threshold."""
    met = (pairs.join(texts.select(F.col("cid").alias("b"), F.col("words").alias("wb")), "b")
           .join(texts.select(F.col("cid").alias("a"), F.col("words").alias("wa")), "a").select("a", "b", "wa", "wb"))

    def run(batches):
        pairs, words, held = [], [], 0

        def done():
            limits = np.array([int((1 - threshold) * max(len(x), len(y)) + 1e-9) for x, y in words])
            ok = np.flatnonzero(distances(words, limits) >= 0)
            found = np.array(pairs, np.int64)[ok]
            pairs.clear()
            words.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(2)], names=["a", "b"])

        for batch in batches:
            for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                pairs.append((a, b))
                words.append(tuple(np.frombuffer(w.as_buffer(), np.uint32) for w in (x, y)))
                held += words[-1][0].nbytes + words[-1][1].nbytes
                if held > ALIGN_BYTES:
                    held = 0
                    yield done()
        if pairs:
            yield done()

    return materialise(in_batches(met, run, "a long, b long"), "aligned")


def _further(part: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after further links: those are followed between components, so what was
    joined before is not gone through again."""
    if links.isEmpty():
        return part
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    whole = materialise(part.unionAll(nodes.join(part, "node", "left_anti").select("node", F.col("node").alias("component"))), "nodes")
    side = lambda c: whole.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    more = components(links.join(side("a"), "a").join(side("b"), "b").where("ca <> cb"), "ca", "cb")
    more = more.select(F.col("node").alias("component"), F.col("component").alias("root"))
    return materialise(whole.join(more, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "components")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, k: int = 5, bands: int = 16, small: int = 8, text_col: str = "text", id_col: str = "doc_id",
                    stored: bool = False, block: int = 1024) -> DataFrame:
    """row, doc_id, class_id, n_class, kept for every document.

    ``class_id`` is the smallest id of the group (null ids come last), ``n_class`` its size; one row of a group
    is kept: the one with the smallest id, of equal ids the one with the least place. Null and empty texts are
    copies of each other; texts without words are compared exactly; a text of fewer than ``k`` words meets only
    texts with the same words. Other columns are not read. Empty table: no rows.

    The documents are read twice, and rows are known by their place in a Parquet table. ``stored`` says that
    ``docs`` is a scan of one, filtered or not; anything else is written first.
    """
    if not stored:
        docs = materialise(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "documents")
        text_col, id_col = "text", "doc_id"
    all_rows = materialise(sketches(docs, bands, k, text_col, id_col), "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    classes = materialise(all_rows.groupBy("fp1", "fp2").agg(F.min(first).alias("first"), F.count("*").alias("n"), F.first("words").alias("words"),
                                                              F.first("key2").alias("key2"), F.first("key4").alias("key4"), F.first("key8").alias("key8"))
                          .select(F.monotonically_increasing_id().alias("cid"), "*"), "classes")
    pivots, further, large = _candidates(classes, small, threshold)
    wanted = pivots.unionAll(further).select(F.explode(F.array("a", "b")).alias("cid")).unionAll(large.select("cid")).distinct()
    wanted = wanted.join(classes.select("cid", F.col("first.row").alias("row")), "cid")

    def tokens(batches):
        words = Words()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([(words(t.as_py()) >> U(33)).astype(np.uint32).tobytes() for t in batch.column(1)], pa.binary())],
                                             names=["cid", "words"])

    texts = _numbered(docs, text_col, id_col).select("row", "text").join(wanted, "row").select("cid", "text")
    texts = materialise(in_batches(texts, tokens, "cid long, words binary"), "words")
    links = _aligned(pivots, texts, threshold)
    part = components(links, "a", "b")
    side = lambda c: part.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    apart = (further.join(pivots, ["a", "b"], "left_anti").join(side("a"), "a", "left").join(side("b"), "b", "left")
             .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    part = _further(part, _aligned(apart, texts, threshold))
    part = _further(part, _whole_buckets(large, part, classes, texts, threshold, block))
    member = classes.select("cid", "fp1", "fp2", "first", "n").join(part, F.col("cid") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cid"))
    group = member.groupBy("component").agg(F.min("first").alias("keeper"), F.sum("n").alias("n_class"))
    member = member.select("fp1", "fp2", "component").join(group, "component").select("fp1", "fp2", "keeper", "n_class")
    return (all_rows.select("row", "doc_id", "fp1", "fp2").join(member, ["fp1", "fp2"])
            .select("row", "doc_id", F.col("keeper.doc_id").alias("class_id"), "n_class", (F.col("row") == F.col("keeper.row")).alias("kept")))


def keep_one(docs: DataFrame, stored: bool = False, **options) -> DataFrame:
    """The documents without all but one of each group of near-duplicates, all columns as they come."""
    names = docs.columns
    if not stored:
        docs = materialise(docs, "documents")
    found = near_duplicates(docs, stored=True, **options)
    gone = materialise(found.where("not kept").select("row"), "gone")
    plain = [f"c{i}" for i in range(len(names))]
    rows = docs.select(place(docs).alias("row"), *[F.col(f"`{c}`").alias(p) for c, p in zip(names, plain, strict=True)])
    return rows.join(gone, "row", "left_anti").select(*plain).toDF(*names)
