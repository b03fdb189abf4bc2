"""Source divergence audit by chunk factorization.

Texts are cut at white space only. The tasks count, for each language, how often each chunk occurs in each source and
in how many documents. These rows are shuffled once, by chunk: in the order of chunks a chunk's rows are put together, and every
globally distinct chunk is cut into terms once, with the counts of the chunk for each. The terms of a batch are put
together before they are shuffled in turn, so a term of very many chunks has few rows. Occurrences of a term are sums over
its chunks. Documents are not: one document may hold a term in several chunks. But a chunk held by three
documents settles its terms, and one held by fewer carries its documents whole, as the smallest and the largest of them.
Distances between sources come from the terms two sources share, which lie in one row, corrected by sums in which a term is
missing on one side, so no term is written for a source that lacks it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelle.llm.common import in_batches, materialise

# fixed value of the contract: what a term is made of
TERM = "[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
# bytes of text that a task counts at once (one longer text is counted by itself), and rows that it hands on at once
HELD_BYTES, SENT_ROWS = 32_000_000, 20_000
CHUNKS = "lang string, chunk string, docs long, low long, high long, sources array<string>, times array<int>"
TERMS = "lang string, term string, docs long, low long, high long, sources array<string>, times array<long>"
# rows of chunks or terms while they are put together
MERGED = pa.schema([("lang", pa.string()), ("key", pa.string()), ("docs", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
                    ("sources", pa.list_(pa.string())), ("times", pa.list_(pa.int64()))])
# a document is named by its task and its place there
PLACES = 40


def chunk_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, chunk, docs, low, high, sources, times: what a task's share of the documents holds of each chunk (A-Z
    lower-cased) in each language: documents, the smallest and the largest of them (a single one as ``low`` only,
    none where there are three or more, which settle the matter), and occurrences per source. An empty chunk
    names the sources there are. Several rows may tell of one chunk."""
    def count(batches):
        base = TaskContext.get().partitionId() << PLACES
        at, size, held = 0, 0, []
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = text.as_py()
                held.append((lang, source, base + at, text.lower()))  # bytes lower only A-Z
                at += 1
                size += len(text)
                if size > HELD_BYTES:
                    yield from sent(held)
                    held, size = [], 0
        if held:
            yield from sent(held)

    def sent(held):
        rows = _counted(held)
        pa.default_memory_pool().release_unused()
        for i in range(0, rows.num_rows, SENT_ROWS):
            yield rows.slice(i, SENT_ROWS)

    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    narrow = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), blank(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(count, CHUNKS)


def _counted(held: list[tuple]) -> pa.RecordBatch:
    """The rows of some documents (language, source, number, lower-case text)."""
    held.sort(key=lambda d: d[:3])
    lang_at, source_at, numbers = {}, {}, np.array([d[2] for d in held])
    langs = np.array([lang_at.setdefault(d[0], len(lang_at)) for d in held])
    sources = np.array([source_at.setdefault(d[1], len(source_at)) for d in held])
    # each step lets go of what it was made from: the words of a share are held once at a time
    words = pc.ascii_split_whitespace(pa.array([d[3] for d in held], pa.large_binary()).cast(pa.large_string()))
    size = len(held)
    held.clear()
    doc = np.repeat(np.arange(size, dtype=np.int32), pc.list_value_length(words).to_numpy())
    words = words.flatten()
    words = words.dictionary_encode()
    key, names = words.indices.to_numpy().astype(np.int64), words.dictionary
    del words
    # documents lie in order of language and source, so one sort brings a chunk's languages, sources and documents together
    key *= size
    key += doc
    del doc
    empty = pc.index(names, "").as_py()
    if empty >= 0:  # before the first and after the last word of a text
        key = key[(key < empty * size) | (key >= (empty + 1) * size)]
    key.sort()
    starts = _changes(key)
    code, doc = np.divmod(key[starts], size)
    times = np.diff(np.append(starts, len(key)))
    del key
    by_lang = _changes(code * len(lang_at) + langs[doc])
    by_source = _changes((code * len(lang_at) + langs[doc]) * len(source_at) + sources[doc])
    n = np.add.reduceat(times, by_source) if len(times) else times
    offsets = np.append(np.searchsorted(by_source, by_lang), len(by_source))
    pick = lambda at, names: pa.array(list(names), pa.string()).take(pa.array(at))
    low, high = (f.reduceat(numbers[doc], by_lang) if len(doc) else numbers[:0] for f in (np.minimum, np.maximum))
    # the empty chunk, once per language
    first = _changes(langs)
    pairs = _changes(langs * len(source_at) + sources)
    offsets = np.append(offsets, offsets[-1] + np.append(np.searchsorted(pairs, first), len(pairs))[1:])
    offsets = pa.array(offsets, pa.int32())
    named = pa.concat_arrays([pick(sources[doc[by_source]], source_at), pick(sources[pairs], source_at)])
    n = pa.array(np.append(n, np.zeros(len(pairs), np.int64)), pa.int32())  # a share has fewer than 2^31 words
    nothing = np.zeros(len(first), np.int64)
    docs, low, high = (np.append(v, nothing) for v in (np.diff(np.append(by_lang, len(doc))), low, high))
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([pick(langs[doc[by_lang]], lang_at), pick(langs[first], lang_at)]),
         pa.concat_arrays([names.take(pa.array(code[by_lang])).cast(pa.string()), pa.array([""] * len(first), pa.string())]),
         pa.array(docs), pa.array(low, mask=docs > 2), pa.array(high, mask=docs != 2),
         pa.ListArray.from_arrays(offsets, named), pa.ListArray.from_arrays(offsets, n)], names=["lang", "chunk", "docs", "low", "high", "sources", "times"])


def _changes(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


def _merged(rows: pa.Table) -> pa.Table:
    """One row for each language and key of ``rows`` (``MERGED``), in the order in which the keys first occur: its documents
    (3 stands for more, only fewer are named) and its occurrences per source."""
    if not len(rows):
        return rows
    lang, key = (_codes(rows.column(c)) for c in ("lang", "key"))
    group = key[0] * len(lang[1]) + lang[0]
    order = np.argsort(group, kind="stable")
    rows, starts = rows.take(pa.array(order)), _changes(group[order])
    group = group[order[starts]]
    size, run = len(starts), np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    # documents
    docs, low, high = (rows.column(c).fill_null(-1).to_numpy() for c in ("docs", "low", "high"))
    at, numbers = np.concatenate((run[low >= 0], run[high >= 0])), np.concatenate((low[low >= 0], high[high >= 0]))
    sort = np.lexsort((numbers, at))
    at, numbers = at[sort], numbers[sort]
    if len(at):
        single = np.concatenate(([True], (at[1:] != at[:-1]) | (numbers[1:] != numbers[:-1])))
        at, numbers = at[single], numbers[single]
    found = np.bincount(at, minlength=size)
    docs = np.where(np.logical_or.reduceat(docs > 2, starts), 3, np.minimum(found, 3))
    ends = np.cumsum(found)
    numbers = np.append(numbers, -1)  # taken where a key has no named document, and masked
    low, high = pa.array(numbers[ends - found], mask=(docs == 0) | (docs > 2)), pa.array(numbers[ends - 1], mask=docs != 2)
    # sources
    lists = rows.column("sources").combine_chunks()
    source, names = _codes(pc.list_flatten(lists))
    source += np.repeat(run, pc.list_value_length(lists).to_numpy()) * len(names)
    order = np.argsort(source, kind="stable")
    source = source[order]
    first = _changes(source)
    times = pc.list_flatten(rows.column("times").combine_chunks()).to_numpy()[order]
    times = np.add.reduceat(times, first) if len(times) else times
    owner, source = np.divmod(source[first], max(len(names), 1))
    offsets = pa.array(np.searchsorted(owner, np.arange(size + 1)), pa.int32())
    return pa.Table.from_arrays(
        [lang[1].take(pa.array(group % len(lang[1]))), key[1].take(pa.array(group // len(lang[1]))), pa.array(docs), low, high,
         pa.ListArray.from_arrays(offsets, names.take(pa.array(source))), pa.ListArray.from_arrays(offsets, pa.array(times))], schema=MERGED)


def _codes(values: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the values, by first occurrence, and the values by number."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _in_turn(batches):
    """The merged rows of the keys that come in order, a key's all in one table."""
    rest = MERGED.empty_table()
    for batch in batches:
        rows = pa.Table.from_arrays(batch.columns, names=MERGED.names).cast(MERGED)
        rows = _merged(pa.concat_tables([rest, rows]))
        if not len(rows):
            continue
        # the last key may go on in the next batch
        key, _ = _codes(rows.column("key"))
        end = int(np.searchsorted(key, key[-1]))
        rest = rows.slice(end)
        if end:
            yield rows.slice(0, end)
    if len(rest):
        yield rest


def _cut(rows: pa.Table) -> pa.Table:
    """Rows of chunks as rows of their terms; each chunk is cut once, and the empty one stays."""
    term = re.compile(TERM)
    code, chunks = _codes(rows.column("key"))
    first = np.append(_changes(code), len(code))  # the languages of a chunk follow each other
    at, terms, weight = [], [], []
    for i, chunk in enumerate(chunks.to_pylist()):
        found: dict[str, int] = {}
        for t in term.findall(chunk) if chunk else [chunk]:
            found[t] = found.get(t, 0) + 1
        for row in range(first[i], first[i + 1]):
            at += [row] * len(found)
            terms += found
            weight += found.values()
    rows = rows.take(pa.array(at, pa.int64()))
    lists = rows.column("times").combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy()
    times = pc.list_flatten(lists).to_numpy() * np.repeat(np.array(weight, np.int64), lengths)
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
    rows = rows.set_column(rows.column_names.index("key"), "key", pa.array(terms, pa.string()))
    return rows.set_column(rows.column_names.index("times"), "times", pa.ListArray.from_arrays(offsets, pa.array(times)))


def chunk_terms(chunks: DataFrame) -> DataFrame:
    """lang, term, docs, low, high, sources, times: the terms of the chunks, each chunk's rows put together and the chunk cut
    once. Several rows may tell of one term, but only one of those that a batch gives. The empty term is the empty chunk."""
    def cut(batches):
        for rows in _in_turn(batches):
            yield from _merged(_cut(rows)).combine_chunks().to_batches(SENT_ROWS)

    return in_batches(chunks.repartition("chunk").sortWithinPartitions("chunk"), cut, TERMS)


def term_tallies(chunks: DataFrame, min_docs: int = 3) -> DataFrame:
    """lang, term, sources, times: occurrences per source of the terms that at least ``min_docs`` documents of their language
    hold, a row for each; the empty term names the sources there are."""
    if not 1 <= min_docs <= 3:
        raise ValueError("a chunk carries two of its documents, so min_docs is 1, 2 or 3")

    def whole(batches):
        for rows in _in_turn(batches):
            yield from rows.combine_chunks().to_batches(SENT_ROWS)

    terms = in_batches(chunk_terms(chunks).repartition("term").sortWithinPartitions("term"), whole, TERMS)
    return terms.where((F.col("docs") >= min_docs) | (F.col("term") == "")).select("lang", "term", "sources", "times")


def _by_source(tallies: DataFrame) -> DataFrame:
    """lang, source, term, n of the terms of ``tallies``."""
    rows = tallies.where("term <> ''").select("lang", "term", F.explode(F.arrays_zip("sources", "times")).alias("s"))
    return rows.select("lang", F.col("s.sources").alias("source"), "term", F.col("s.times").alias("n"))


def term_counts(chunks: DataFrame, min_docs: int = 3) -> DataFrame:
    """lang, source, term, n: occurrences of the terms that at least ``min_docs`` documents of their language hold."""
    return _by_source(term_tallies(chunks, min_docs))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exact."""
    wide = (n + F.lit(1)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide, (total + kept).cast("decimal(20,0)"))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 3, top: int = 200, stored: bool = False) -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs from the other sources of its language
    (``pair``), and the terms in which it exceeds the language, at most ``top`` of them (``term``).

    Terms are runs of ASCII letters and of characters past ASCII, A-Z lower-cased; a language keeps those that
    ``min_docs`` of its documents hold. A term's share in a group is 1 + floor(1e9 (n + 1) / (N + V)) with its
    occurrences there, N over all kept terms and V kept terms; the value is floor((p - q)^2 / q), all in
    integers. Null texts, languages and sources are empty ones; a document is a row, so repeated rows are
    documents of their own. Ties are ranked by item in UTF-8 order. Groups without terms have their pairs.
    An empty table gives no rows.

    Documents are known by their place in a task, so ``docs`` has to come in the same order if a task is run again, as
    a scan of a Parquet table does (``stored``); the chunk counts of any other frame are written first, once.
    """
    chunks = chunk_counts(docs, text_col, lang_col, source_col)
    chunks = chunks if stored else materialise(chunks, "chunks", "zstd")
    tallies = materialise(term_tallies(chunks, min_docs), "term-counts", "zstd")
    counts = _by_source(tallies)
    vocabulary = tallies.where("term <> ''").groupBy("lang").agg(F.count("*").alias("kept"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    zero = F.lit(0).cast("long")
    some = lambda c: F.coalesce(F.col(c), zero).alias(c)
    groups = tallies.where("term = ''").select("lang", F.explode("sources").alias("source")).join(sums, ["lang", "source"], "left").join(vocabulary, "lang", "left")
    groups = groups.select("lang", "source", some("total"), some("present"), some("kept"))
    # a language without kept terms has no share; its pairs are 0
    groups = groups.withColumn("none", F.when(F.col("kept") > 0, _share(zero, F.col("total"), F.col("kept"))))
    groups = materialise(groups, "groups")

    # a term's shares lie in one row, so that its pairs of sources need no join
    shares = counts.join(groups.select("lang", "source", "total", "kept", "none"), ["lang", "source"])
    shares = shares.select("lang", "term", "n", F.struct("source", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), "none").alias("s"))
    terms = materialise(shares.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list("s")).alias("list")), "shares", "zstd")
    shares = terms.select("lang", "term", "n", F.explode("list").alias("s")).select("lang", "term", "n", "s.source", "s.p")

    mine, other = groups.alias("a"), groups.alias("b")
    pairs = mine.join(other, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source")))
    pairs = pairs.select("a.lang", "a.source", F.col("b.source").alias("item"), F.col("a.none").alias("z"), F.col("b.none").alias("w"),
                         F.coalesce((F.col("a.kept") - F.col("a.present") - F.col("b.present")) * _apart(F.col("a.none"), F.col("b.none")), zero).alias("value"))
    # terms of one side as if the other had none: one row for each share that occurs
    levels = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("terms"))
    here = pairs.join(levels, ["lang", "source"]).select("lang", "source", "item", (F.col("terms") * _apart(F.col("p"), F.col("w"))).alias("value"))
    there = (pairs.join(levels.withColumnRenamed("source", "item"), ["lang", "item"])
             .select("lang", "source", "item", (F.col("terms") * _apart(F.col("z"), F.col("p"))).alias("value")))
    # terms of both sides: the true distance in place of the two, and the empty one that both took off
    both = terms.select("lang", "list", F.posexplode("list").alias("at", "a"))
    both = both.select("lang", "a", F.explode(F.slice("list", F.col("at") + 2, F.size("list"))).alias("b"))

    def gain(x: str, y: str) -> Column:
        p, z, q, w = F.col(f"{x}.p"), F.col(f"{x}.none"), F.col(f"{y}.p"), F.col(f"{y}.none")
        return F.sum(_apart(p, q) - _apart(p, w) - _apart(z, q) + _apart(z, w))

    both = both.groupBy("lang", F.col("a.source").alias("one"), F.col("b.source").alias("two")).agg(gain("a", "b").alias("there"), gain("b", "a").alias("back"))
    both = both.select("lang", F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item"), F.col("there").alias("value")),
                                                 F.struct(F.col("two").alias("source"), F.col("one").alias("item"), F.col("back").alias("value")))).alias("d")).select("lang", "d.*")
    columns = ["lang", "source", "item", "value"]
    pair = (pairs.select(columns).unionAll(here.select(columns)).unionAll(there.select(columns)).unionAll(both)
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))

    totals = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("kept").alias("kept"))
    term = (shares.join(totals, "lang").withColumn("q", _share(F.col("n"), F.col("total"), F.col("kept"))).where("p > q")
            .select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pair, "pair").unionAll(ranked(term, "term").where(F.col("rank") <= top))
