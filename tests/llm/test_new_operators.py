"""Spelling variants, line dedup and source divergence against brute force and their DuckDB statements."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import chunk_divergence, gram_variants, mph_lines
from parcelle.llm.oracle_sql import ORACLE

SF = "/root/testdata/sf0.001"


def rows(df, order=None):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by_duck(docs, sql):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    found = con.execute(sql).fetchall()
    return sorted(found, key=repr), [d[0] for d in con.description]


def lower(text):
    return text.encode().lower().decode()


@pytest.fixture()
def strange(spark, make_docs):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    docs = make_docs([None, "", "abcdef abcdex " * 40, "ABCDEF abcdef\n  Abcdef  \nÀbcdef ÷×abcd", "x" * 50_000 + "\n" + "y z " * 20_000,
                      "same line here\nother", "same line here\nother", "SAME line here \x0b\nown line of mine\n\n", "tail\r\nsame line here\r"],
                     [None, 1, 2, 3, 4, 7, 7, 6, None])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") != 3, F.col("lang"))).withColumn("source", F.when(F.col("doc_id") < 6, F.col("source")))
    return docs.withColumn("word", F.lit("clash")).withColumn("_TEXT", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("line", F.lit(3))


# 11 spelling variants

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(pairs):
    n = Counter()
    for key, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    forms, close = {}, {}
    for w in n:
        around = [v for v in n if near(w, v)]
        close[w] = len(around)
        best = min(around, key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w
    return sorted(((w, forms[w], root(w), n[w], close[w], n.get(forms[w])) for w in n), key=repr)


def test_variants_match_brute_force(spark, make_docs):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé") for _ in range(rng.choice([6, 7, 8, 9]))) for _ in range(60)]
    words += [w[:i] + rng.choice("abcÿ") + w[i + rng.randrange(2):] for w in words for i in (1, 4)]
    weight = [rng.choice([1, 1, 6, 40]) for _ in words]
    texts = [" ".join(rng.choices(words, weight, k=400)) for _ in range(30)]
    texts += ["longword " * 250 + "longwore " * 50 + "Longware " * 10]              # a form of a form
    docs = make_docs(texts)
    want = plain_variants(list(enumerate(texts)))
    assert rows(gram_variants.variants(docs)) == want
    assert any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)
    assert rows(gram_variants.variants(docs, block=8)) == want     # units of a few words, many tiles


def test_variants_of_strange_rows(spark, strange):
    got = rows(gram_variants.variants(strange))
    assert got == plain_variants([(r.doc_id, r.text) for r in strange.select("doc_id", "text").collect()])
    found, names = by_duck(strange.select("doc_id", "text"), ORACLE["op11_gram_variants"])
    assert found == got and names == gram_variants.variants(strange).columns
    assert rows(gram_variants.variants(strange.limit(0))) == []
    with pytest.raises(ValueError):
        gram_variants.variants(strange, ratio=1)


def test_variants_of_long_words(spark, make_docs):
    """Words of thousands of letters, which no unit holds many of."""
    base = "ab" * 10_000
    words = [base, base + "c", base[:500] + "d" + base[500:], base[:-1], "ab" * 9_999 + "cb"]
    texts = [" ".join([words[0]] * 30 + [w for w in words[1:] for _ in range(5)])]
    docs = make_docs(texts)
    assert rows(gram_variants.variants(docs)) == plain_variants([(0, texts[0])])


def test_near_pairs_of_one_unit():
    rng = random.Random(5)
    home = sorted({"".join(rng.choice("abc") for _ in range(7)) for _ in range(60)})
    visitors = sorted({"".join(rng.choice("abc") for _ in range(rng.choice([6, 7]))) for _ in range(80)})
    i, j = gram_variants.near_pairs(home, visitors)
    assert {(home[a], visitors[b]) for a, b in zip(i, j, strict=True)} == {(a, b) for a in home for b in visitors if near(a, b)}


# 12 line dedup

def plain_lines(pairs):
    last = 2**63 - 1
    key = lambda line: lower(line.strip(" \t\n\x0b\f\r"))
    owners = defaultdict(set)
    for doc, text in pairs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                owners[key(line)].add(last if doc is None else doc)
    out = []
    for doc, text in pairs:
        lines = (text or "").split("\n")
        kept = [s for s in lines if not (len(key(s)) >= 10 and min(owners[key(s)]) != (last if doc is None else doc))]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_lines_match_brute_force(spark, make_docs):
    rng = random.Random(4)
    lines = [f"line number {i} of the lot" for i in range(40)] + ["short", "", "  "]
    texts = ["\n".join(rng.choice(["", " ", "\t"]) + (s.upper() if rng.random() < 0.3 else s) for s in rng.choices(lines, k=rng.randrange(12))) for _ in range(60)]
    texts += ["line number 3 of the lot\n" * 500 + "end"] * 3
    ids = [rng.randrange(50) for _ in texts]
    docs = make_docs(texts, ids)
    want = plain_lines(list(zip(ids, texts, strict=True)))
    assert rows(mph_lines.digest(mph_lines.dedup(docs))) == want
    assert sum(r[2] for r in want) > 100
    assert rows(mph_lines.digest(mph_lines.dedup(docs, shard_lines=7))) == want   # many shards


def test_lines_of_a_hot_shard_are_probed_in_parts(spark, make_docs, tmp_path):
    docs = make_docs(["one line that all hold\nand a second"] * 50)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    hashes = mph_lines.line_hashes(docs)
    index = mph_lines.build_index(hashes, 1)
    known = mph_lines.probe(hashes, index, 1, probes=9)
    assert known.count() == 100 and {(r.owner, r.n) for r in known.collect()} == {(0, 50)}
    later = make_docs(["one line that all hold", "a line nobody knows yet"], [98, 99])
    later.write.parquet(f"{tmp_path}/later")
    fresh = mph_lines.line_hashes(spark.read.parquet(f"{tmp_path}/later"))
    assert [r.doc for r in mph_lines.probe(fresh, index, 1).join(fresh, ["file", "at", "line"]).collect()] == [98]


def test_lines_of_strange_rows(spark, strange):
    got = rows(mph_lines.digest(mph_lines.dedup(strange)))
    assert got == plain_lines([(r.doc_id, r.text) for r in strange.select("doc_id", "text").collect()])
    found, names = by_duck(strange.select("doc_id", "text"), ORACLE["op12_mph_lines"])
    assert found == got and names == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert rows(mph_lines.dedup(strange.limit(0))) == []


@pytest.mark.parametrize("n", [0, 1, 63, 64, 5000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    one, two = (rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2))
    one[: n // 2] = 7                                              # equal first halves
    hashed = mph_lines.PerfectHash.build(one, two)
    again = mph_lines.PerfectHash(np.frombuffer(hashed.levels.tobytes(), np.int64), np.frombuffer(hashed.bits.tobytes(), np.uint8))
    assert sorted(again.numbers(one, two).tolist()) == list(range(n))
    strangers = again.numbers(rng.integers(0, 2**64, 1000, dtype=np.uint64), rng.integers(0, 2**64, 1000, dtype=np.uint64))
    assert ((strangers >= -1) & (strangers < max(n, 1))).all()


# 13 source divergence

def plain_divergence(docs):
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        found = Counter(lower(t) for t in term.findall(text or ""))
        held[lang].update(found.keys())
        counts[lang, source].update(found)
        groups.add((lang, source))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, k in held[lang].items() if k >= 3]
        sources = sorted(s for g, s in groups if g == lang)
        share = lambda c: (lambda total: {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept})(sum(c[t] for t in kept))
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", terms)):
                found = sorted(found, key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, item, v, i) for i, (item, v) in enumerate(found, 1) if part == "pair" or i <= 200]
    return sorted(out, key=repr)


def test_divergence_matches_brute_force(spark):
    rng = random.Random(6)
    words = [w + e for w in ("alpha", "béta", "Gamma-x", "日本", "delta9z", "eta's") for e in ("", ",", ".", "!", "ing")] + ["12", "--", " "]
    docs = [(rng.choice(["en", "fr", None]), rng.choice("abcd"), rng.choice([" ", "\n", "\t"]).join(rng.choices(words + [f"rare{rng.randrange(40)}"], k=rng.randrange(25))))
            for _ in range(80)] + [("xx", "only", "one two"), ("xx", "other", None), ("zz", None, "!!!")]
    frame = spark.createDataFrame(docs, "lang string, source string, text string").repartition(5)
    want = plain_divergence(docs)
    got = rows(chunk_divergence.divergence(frame))
    assert got == want
    assert ("xx", "only", "pair", "other", 0, 1) in got and any(r[2] == "term" and r[3].startswith("rare") for r in got)


def test_divergence_of_strange_rows(spark, strange):
    got = rows(chunk_divergence.divergence(strange))
    assert got == plain_divergence([(r.lang, r.source, r.text) for r in strange.select("lang", "source", "text").collect()])
    found, names = by_duck(strange.select("doc_id", "lang", "source", "text"), ORACLE["op13_chunk_divergence"])
    assert found == got and names == chunk_divergence.divergence(strange).columns
    assert rows(chunk_divergence.divergence(strange.limit(0))) == []
    for n in (0, 4):
        with pytest.raises(ValueError):
            chunk_divergence.divergence(strange, min_docs=n)


def test_documents_of_a_term_in_several_chunks(spark):
    """Documents are counted by themselves: chunks of one document do not add up, rare chunks of three do."""
    one = [("en", "a", "word word, (word) word."), ("en", "b", "word!")]
    three = [("en", "a", "term,"), ("en", "a", "term."), ("en", "b", "term")]
    frame = spark.createDataFrame(one + three, "lang string, source string, text string")
    kept = chunk_divergence.term_counts(chunk_divergence.chunk_counts(frame))
    assert rows(kept) == [("en", "a", "term", 2), ("en", "b", "term", 1)]


def test_chunk_counts_are_shuffled_once(spark):
    """The counts of chunks, which are many times the terms, move once; the terms once more, and nothing in between is joined."""
    frame = spark.createDataFrame([("en", "a", "term, term."), ("en", "b", "term")], "lang string, source string, text string")
    kept = chunk_divergence.term_counts(chunk_divergence.chunk_counts(frame))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Join" not in plan and "FileScan" not in plan


def test_divergence_over_small_batches(spark):
    """Rows of a chunk and of a term that come in several batches, in several languages."""
    rng = random.Random(13)
    words = [w + e for w in ("alpha", "Bravo-alpha", "日本", "12", "alpha/charlie") for e in ("", ",", ".alpha")] + [f"https://x{i}.com/alpha" for i in range(30)]
    docs = [(rng.choice(["en", "fr", None]), rng.choice("abcdef"), " ".join(rng.choices(words, k=rng.randrange(8)))) for _ in range(90)]
    frame = spark.createDataFrame(docs, "lang string, source string, text string").repartition(9)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        for n in (1, 2, 7):
            spark.conf.set(size, n)
            assert rows(chunk_divergence.divergence(frame)) == plain_divergence(docs)
    finally:
        spark.conf.set(size, before)


def test_a_term_of_many_chunks_has_few_rows(spark):
    """A term that every chunk holds comes once in a batch, whatever the number of chunks."""
    docs = [("en", "s", " ".join(f"https://host{i}-{j}.com" for j in range(50))) for i in range(100)]
    frame = spark.createDataFrame(docs, "lang string, source string, text string").coalesce(1)
    terms = chunk_divergence.chunk_terms(chunk_divergence.chunk_counts(frame).coalesce(1))
    assert terms.where("term = 'com'").count() <= spark.sparkContext.defaultParallelism + 1
    kept = chunk_divergence.term_counts(chunk_divergence.chunk_counts(frame)).where("term in ('com', 'host')")
    assert rows(kept) == [("en", "s", "com", 5000), ("en", "s", "host", 5000)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_registered_queries_match_duckdb(spark, name):
    from parcelle.llm.queries import QUERIES
    df = QUERIES[name](spark, SF)
    found, names = by_duck(spark.read.parquet(f"{SF}/documents.parquet"), ORACLE[name])
    assert sorted(names) == sorted(df.columns)
    assert rows(df.select(names)) == found
