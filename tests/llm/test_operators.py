"""Each operator against a brute-force version, an exact round trip or planted cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelle.llm import (bloom_lm, decontamination, histogram_sort, html_mincut, itq_dedup, order_minhash,
                          pii_bootstrap, toxicity_kn, vector_packing, warc_io)
from parcelle.llm.common import components, materialise

SF = "/root/testdata/sf0.001"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    up = {v: v for p in links for v in p}

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {v: find(v) for p in links for v in p if any(v in q and q[0] != q[1] for q in links)}


# 1 decontamination

def test_myers_matches_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 25)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 40)))
        want = min([len(item)] + [levenshtein(item, text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)])
        assert decontamination.Pattern(item).search(text)[0] == want


def test_decontamination_finds_edited_passages(spark, make_docs):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
    item = " ".join(word() for _ in range(40))
    near = item[:60] + "ZZ" + item[62:150] + item[152:]
    far = " ".join(w if i % 3 else word() for i, w in enumerate(item.split()))
    noise = " ".join(word() for _ in range(300))
    docs = make_docs([noise + " " + item.upper().replace(" ", ",  ") + " " + noise, noise + near + noise, noise + far, noise, None, ""])
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "!!!")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontamination.matches(docs, bench).collect()}
    assert got[0, 1] == 0 and 0 < got[1, 1] <= decontamination.budget(len(item), 0.05) and set(got) == {(0, 1), (1, 1)}
    blocks = decontamination.matches(docs, bench.unionAll(spark.createDataFrame([(9, "other words entirely not there at all")], "item_id long, text string")), block_chars=10)
    assert {(r.doc_id, r.item_id): r.edits for r in blocks.collect()} == got
    assert [r.doc_id for r in decontamination.clean(docs, bench).orderBy("doc_id").collect()] == [2, 3, 4, 5]
    assert decontamination.matches(docs, bench.where("false")).count() == 0


def test_decontamination_against_containment(spark):
    docs, bench = read(spark, "documents"), read(spark, "benchmark")
    items = [(r.item_id, decontamination.fold(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in decontamination.fold(r.text or "")}
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(docs, bench).where("edits = 0").collect()}
    assert got == want


# 2 HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div id="cookie-notice">We use cookies. <button>OK</button></div><!-- c --><article><header><h1>Head &amp; line</h1></header>
<p>First   paragraph, with <a href="/x">a link</a> and&nbsp;text that is long enough to be read.<p>Second one<br>after break.</p>
<ul><li>item one</li><li>item two</li></ul><div class="ad">Buy now</div><p>Last words of the article, quite long they are too.</p></article>
<aside class="sidebar"><p>Related: other story</p></aside><section id="comments"><p>Nice article, I liked it very much indeed!</p></section>
<form><label>Name</label><input></form><footer>&copy; site</footer></body></html>"""


def test_html_article_only():
    assert html_mincut.extract(PAGE) == ("Head & line\nFirst paragraph, with a link and text that is long enough to be read.\nSecond one\nafter break.\n"
                                         "item one\nitem two\nLast words of the article, quite long they are too.")


def test_min_cut_is_minimal():
    rng = random.Random(4)
    for _ in range(40):
        n = rng.randrange(1, 8)
        cost = [rng.uniform(-3, 3) for _ in range(n)]
        ties = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4]
        flow = html_mincut.Flow(n)
        for i, c in enumerate(cost):
            flow.edge(flow.s, i, -c) if c < 0 else flow.edge(i, flow.t, c)
        for a, b, w in ties:
            flow.edge(a, b, w, w)
        side = flow.source_side()[:n]
        value = lambda s: sum(c if c > 0 and k else -c if c < 0 and not k else 0 for c, k in zip(cost, s, strict=True)) + sum(w for a, b, w in ties if s[a] != s[b])
        best = min(value([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert math.isclose(value(side), best, abs_tol=1e-6)


def test_html_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "u", ""), (2, None, None), (5, "u", "<p>unclosed <b>text"), (6, "u", "plain < text"), (7, "u", "<div>" * 3000 + "deep" + "</p>" * 50)]
    got = html_mincut.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    assert len(got) == 7 and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[2] == "" and by[None] == "" and by[5] == "unclosed text" and by[7] == "deep"
    assert html_mincut.main_text(read(spark, "pages")).where("n_chars = 0").count() == 0


# 3 sharding

@pytest.mark.parametrize("options", [{}, {"bucket_rows": 7, "grid_bits": 3, "more_bits": 2}])
def test_shards(spark, odd_docs, options):
    for docs in (odd_docs, read(spark, "documents").unionByName(read(spark, "documents").where("doc_id < 50"))):
        rows = docs.collect()
        got = histogram_sort.shard(docs, **options).collect()
        text = lambda r: (r.text or "").encode()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, len(text(r)) + 8, zlib.crc32(text(r))) for r in rows)
        slots: dict = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= 2 * max(r.size for r in got)
    assert histogram_sort.shard(odd_docs.where("false")).count() == 0


# 4 personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) < 256 for x in m.group().split(".")), "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(out)]


HARD = ["a@b.c_d@e.f x@y.z..q@r.s 1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.0255", "4111 1111 1111 1111 4111-1111-1111-1111 5  4111111111111111 1 4111111111111111", None, "",
        "+1 (234) 555-1234-- +49 30 1234567 +12 +1234567890123456", "é😀 a@b.co 😀 1.1.1.1 +1 (017) 555-7713", "a@b.c.dddd.-x@y.z+w@v.u", "1" * 5000 + " " + "1 " * 5000 + "a" + ".b" * 5000 + "@x" + ".y" * 5000]


def test_pii_base_spans(spark, make_docs):
    rng = random.Random(5)
    texts = HARD + ["".join(rng.choice("a@.b+1 -(2)4é") for _ in range(120)) for _ in range(150)]
    docs = make_docs(texts).unionByName(read(spark, "documents").withColumn("doc_id", F.col("doc_id") + 10_000))
    text_of = {r.doc_id: r.text for r in docs.collect()}
    for r in pii_bootstrap.extract(docs).collect():
        want = plain_spans(text_of[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text_of[r.doc_id]
        assert set(want) <= set(r.spans.split(",")) | {""}
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w.startswith(k + ":") for w in want) for k in PLAIN)


def test_pii_bootstrap_discovers_and_masks(spark, make_docs):
    seeds = [f"words then call {i} contact: user{i}@mail.example and more" for i in range(12)]
    docs = make_docs(seeds + ["see contact: K77-42-9X1 please", "number 20250 of the year and 31337 times", None])
    assert "contact:" in pii_bootstrap.learn(docs)
    spans = {r.doc_id: r.spans for r in pii_bootstrap.extract(docs).collect()}
    assert spans[12] == "id:13:23" and spans[13] == ""
    out = {r.doc_id: r for r in pii_bootstrap.redact(docs).collect()}
    assert out[12].text == "see contact: [ID] please" and out[0].text == "words then call 0 contact: [EMAIL] and more" and out[14].text is None
    assert out[12].n_chars == len(out[12].text) and pii_bootstrap.extract(docs.where("false")).count() == 0


def test_pii_contexts_are_not_capped(spark, make_docs):
    """More than 2,000 frequent contexts do not push out one with fewer values; a model of many contexts is applied whole."""
    from itertools import product
    plain = ["".join(x) for x in product("abcdefghijklmn", repeat=3)][:2200]
    noise = [" ".join(f"{w}z {10_000 * j + i}" for j in range(1, 6)) for i, w in enumerate(plain)]
    docs = make_docs(["\n".join(noise[i:i + 100]) for i in range(0, len(noise), 100)] + [f"reach: u{i}@example.org and more" for i in range(6)] + ["reach: badge77419 here"])
    assert "reach:" in pii_bootstrap.learn(docs)
    assert [r.spans for r in pii_bootstrap.extract(docs).collect() if "id:" in r.spans] == ["id:7:17"]
    many = [f"{w}q:" for w in plain] + ["two words:"]
    found = pii_bootstrap.all_spans(make_docs([f"{plain[-1]}q: k1234", f"x{plain[0]}q: k1234", "two words: k1234", "words: k1234", "k1234"]), many)
    assert [[(s.start, s.end) for s in r._spans] for r in found.orderBy("doc_id").collect()] == [[(6, 11)], [], [(11, 16)], [], []]


# 5 toxicity

def test_toxicity_arrays_match_the_models():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    counts: dict = {}
    for i, w in enumerate(words):
        for g in toxicity_kn.grams_of(w, 5):
            c = counts.setdefault(g, [0.0, 0.0])
            c[i % 3 == 0] += 1
    m = toxicity_kn.Models({g: tuple(c) for g, c in counts.items()}, 5)
    contexts = list(m.context)[:50]
    alphabet = {g[-1] for g in counts}
    for h in contexts:  # the models are distributions over the characters seen and one more
        unseen = m.by_class(h + "☃")
        for k in (0, 1):
            assert sum(m.by_class(h + c)[k] for c in alphabet) + unseen[k] == pytest.approx(1, abs=0.02)
    grams, by_context = m.differences()
    s = toxicity_kn.Scorer({"grams": toxicity_kn.hash_table(grams), "contexts": toxicity_kn.hash_table(by_context), "order": 5, "window": 4})
    texts = [" ".join(rng.choice(words + ["zzz!", "q7q", "…"]) for _ in range(rng.randrange(0, 30))) for _ in range(60)] + ["", "!!", "A", "a\n\nb" * 50]
    for text, f in zip(texts, s(texts), strict=True):
        each = [sum(math.log(t / o) for o, t in map(m.by_class, toxicity_kn.grams_of(w, 5))) for w in toxicity_kn.words(text)]
        if not each:
            assert not f.any()
            continue
        k = min(4, len(each))
        want = (sum(each) / len(each), max(sum(each[i:i + k]) / k for i in range(len(each) - k + 1)), max(each))
        assert np.allclose(f, want, atol=1e-7)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity_kn.score(docs, labels).join(labels, "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.7 and n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.03


def test_toxicity_sample_keeps_the_share(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    whole, part = (toxicity_kn.fit(docs, labels, max_per_class=n)[1] for n in (6_000, 300))  # 300 binds for both classes
    assert abs(part[0] - whole[0]) < 0.5 * math.log(2661 / 329)  # half of what equal classes would move it


def test_toxicity_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (5, None, 0), (None, 1, 1), (99, 0, 1), (6, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity_kn.score(odd_docs, labels).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert toxicity_kn.score(odd_docs.where("false"), labels.where("false")).count() == 0
    assert toxicity_kn.reject(odd_docs, labels).columns == odd_docs.columns


# 6 packing

def check_packing(rows, docs, size=2048, max_docs=None, max_attention=None):
    encode = vector_packing.Encoder("byte_bpe_50k")
    ids = {}
    for r in docs:
        ids.setdefault(r.doc_id, np.append(encode(r.text or ""), np.uint32(0)).astype("<u4"))
    pieces, bins = Counter(), {}
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length <= size and zlib.crc32(part.tobytes()) == r.ids_crc32
        pieces[r.doc_id, r.piece] += 1
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert b[0][0] == 0 and all(x[0] + x[1] == y[0] for x, y in zip(b, b[1:], strict=False)) and sum(n for _, n in b) <= size
        assert len(b) <= (max_docs or size) and sum(n * n for _, n in b) <= (max_attention or size * size)
    return len(bins), sum(len(ids[r.doc_id]) for r in docs)


def test_packing(spark, odd_docs):
    docs = read(spark, "documents")
    n, tokens = check_packing(vector_packing.pack(docs).collect(), docs.collect())
    assert n <= math.ceil(tokens / 2048) * 1.02 + 1
    for rule in ("norm", "dot"):
        rows = vector_packing.pack(docs, max_docs=3, max_attention=1_500_000, rule=rule).collect()
        check_packing(rows, docs.collect(), 2048, 3, 1_500_000)
    odd = [r for r in odd_docs.collect()]
    rows = vector_packing.pack(odd_docs).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in odd)
    assert vector_packing.pack(docs.where("false")).count() == 0
    assert vector_packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)] and vector_packing.cut(4096, 2048) == [(0, 2048), (2048, 2048)]


def test_encoder_matches_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    slow, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), vector_packing.Encoder("byte_bpe_50k")
    for text in [r.text for r in read(spark, "documents").limit(80).collect()] + ["<|endoftext|> x", "a\n\n  b\t c", "😀é" * 9, " " * 500, "", "don't  I'LL 12345"]:
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids


# 7 near duplicates

def test_banded_alignment_matches_brute_force():
    rng = random.Random(7)
    pairs = []
    for _ in range(250):
        a = [rng.randrange(30) for _ in range(rng.randrange(1, 70))]
        b = list(a)
        for _ in range(rng.randrange(0, 18)):
            i, what = rng.randrange(len(b) + 1), rng.randrange(3)
            if what == 0:
                b.insert(i, rng.randrange(30))
            elif i < len(b):
                b[i:i + 1] = [] if what == 1 and len(b) > 1 else [rng.randrange(30)]
        pairs.append((np.array(a, np.uint32), np.array(b, np.uint32)))
    limits = np.array([int(0.2 * max(len(a), len(b))) for a, b in pairs])
    want = [levenshtein(a.tolist(), b.tolist()) for a, b in pairs]
    got = order_minhash.distances(pairs, limits, first_band=2).tolist()
    assert got == [d if d <= m else -1 for d, m in zip(want, limits.tolist(), strict=True)]


def test_near_duplicates(spark, make_docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    texts, group = [], []
    passage = " ".join(word() for _ in range(60))
    for g in range(25):
        base = [word() for _ in range(rng.randrange(60, 300))]
        for _ in range(40 if g == 0 else rng.randrange(1, 5)):  # a large group, copies, near copies
            near = [word() if rng.random() < 0.02 else w for w in base]
            texts.append(" ".join(near).upper() if rng.random() < 0.2 else " ".join(near))
            group.append(g)
    for _ in range(40):  # texts of their own that share a passage
        texts.append(" ".join(word() for _ in range(60)) + " " + passage + " " + " ".join(word() for _ in range(20)))
        group.append(len(texts) + 1000)
    docs = make_docs(texts)
    got = {r.doc_id: r for r in order_minhash.near_duplicates(docs).collect()}
    first: dict = {}
    for i, g in enumerate(group):
        first.setdefault(g, i)
    assert [got[i].class_id for i in range(len(texts))] == [first[g] for g in group]
    assert {i for i, r in got.items() if r.kept} == set(first.values())
    assert sorted(r.doc_id for r in order_minhash.keep_one(docs).collect()) == sorted(first.values())


def test_near_duplicates_in_large_buckets(spark, make_docs):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    passage, texts = [word() for _ in range(110)], []
    for _ in range(30):  # near pairs among unrelated texts that all share a passage
        one = [word() for _ in range(35)] + passage + [word() for _ in range(35)]
        texts += [one, [word() if rng.random() < 0.05 else w for w in one]]
    hashes, band_seeds = order_minhash.Words(), order_minhash.seeds(6)
    keys = [order_minhash.sketch(hashes(" ".join(t)), 5, band_seeds)[:, 0] for t in texts]
    met = [i for i in range(0, 60, 2) if (keys[i] == keys[i + 1]).any() and levenshtein(texts[i], texts[i + 1]) <= 36]
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(make_docs([" ".join(t) for t in texts]), bands=6).collect()}
    assert len(met) > 20 and [got[i + 1] for i in met] == met and all(got[i] == i for i in range(0, 60, 2))


def test_tasks_get_bounded_batches(spark):
    own = spark.newSession()
    docs = materialise(own.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text")), "batches")
    order_minhash.sketches(docs, bands=16, k=5)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "n"])

    got = docs.select("text").mapInArrow(sizes, "rows long, n long").collect()
    assert sum(r.rows for r in got) == 3000 and max(r.n for r in got) < 5_000_000  # 15 MB in one batch by Spark's own setting
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    order_minhash.sketches(docs, bands=16, k=5)
    assert max(r.n for r in docs.select("text").mapInArrow(sizes, "rows long, n long").collect()) < 1_500_000  # the session's own stays


def test_alignment_over_many_batches(spark):
    base = np.arange(20_000, dtype=np.uint32)
    words = [base] + [np.where(base // 4 == 40 * i, base + 50_000, base).astype(np.uint32) if i % 3 else base + np.uint32(100_000) for i in range(120)]
    texts = spark.createDataFrame([(i, w.tobytes()) for i, w in enumerate(words)], "cid long, words binary")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 121)], "a long, b long").coalesce(1)  # 19 MB of words
    got = {(r.a, r.b) for r in order_minhash._aligned(pairs, texts, 0.8).collect()}
    assert got == {(0, i + 1) for i in range(120) if i % 3}


def test_near_duplicates_odd_rows(spark, odd_docs):
    got = order_minhash.near_duplicates(odd_docs).collect()
    assert len(got) == 9 and sum(r.kept for r in got) == 6  # null and empty; white space; a..g; x; plain; 1
    assert all(r.class_id == 6 for r in got if r.doc_id in (6, 7)) and [r.kept for r in got if r.doc_id == 3].count(True) == 1
    assert order_minhash.keep_one(odd_docs).columns == odd_docs.columns
    assert order_minhash.near_duplicates(odd_docs.where("false")).count() == 0


def test_place_does_not_follow_the_splits(spark, make_docs, tmp_path):
    from parcelle.llm.common import has_place, place
    docs = make_docs([f"text {i} " * 200 for i in range(3000)])
    assert not has_place(docs)
    docs.repartition(3).write.option("parquet.block.size", 20_000).parquet(f"{tmp_path}/docs")
    size, found, splits = spark.conf.get("spark.sql.files.maxPartitionBytes"), [], []
    try:
        for limit in ("20000", size):
            spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
            stored = spark.read.parquet(f"{tmp_path}/docs")
            splits.append(stored.rdd.getNumPartitions())
            found.append({(r.doc_id, tuple(r.row)) for r in stored.select("doc_id", place(stored).alias("row")).collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert splits[0] > splits[1] and found[0] == found[1] and len({row for _, row in found[0]}) == 3000
    assert has_place(stored.where("doc_id > 5"))


# 8 language model

def test_language_model(spark, odd_docs):
    docs = read(spark, "documents").unionByName(odd_docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 10_000))
    docs = docs.unionByName(docs.where("doc_id = 7"))
    split = re.compile(rb"[^\x20\x09-\x0D]+")
    lower = lambda t: split.findall((t or "").encode().lower()) + [None]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    rows = docs.collect()
    counts = Counter(w for r in rows if not out(r.doc_id) for w in lower(r.text))
    total, distinct = sum(counts.values()), len(counts)
    text = {r.doc_id: r.text for r in rows}
    got = bloom_lm.score(docs, common=50, flush=3000).collect()
    assert len(got) == len(rows)
    for r in got:
        w = lower(text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(w), sum(x in counts for x in w), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w), abs=1e-6) and r.score < 0
    more = bloom_lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert more[0] > more[1]
    assert bloom_lm.score(docs.where("false")).count() == 0


def test_language_model_sums_to_at_most_one(spark, make_docs):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("one two three four five six".split()[:rng.randrange(2, 7)]) for _ in range(30)) for _ in range(60)]
    held, counts = bloom_lm.fit(make_docs(texts).select("text"), 10, 2 ** 0.5, 2, 6, 16.0, 1 << 20, 0.02, 1000)
    model, tokens = bloom_lm.Model(held), bloom_lm.Tokens()
    vocabulary = np.unique(np.concatenate([tokens(t) for t in texts]))
    for before in [*vocabulary, bloom_lm.START, np.uint64(12345)]:
        p = 10 ** model.log10(np.full(len(vocabulary), before), vocabulary)
        assert 0 < p.sum() <= 1 + 1e-9


def test_language_model_filter_grows(spark, make_docs):
    rng = random.Random(12)
    docs = make_docs([" ".join(f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(rng.randrange(0, 200))) for _ in range(300)])
    scores = lambda **options: {r.doc_id: (r.n_known, r.base_score, r.score) for r in bloom_lm.score(docs, common=50, flush=4000, **options).collect()}
    whole, tight = scores(), scores(max_bytes=1000)  # a limit on the broadcast, not on the filter
    assert len(whole) == 300 and all(tight[i] == pytest.approx(v, abs=1e-6) for i, v in whole.items())


def test_runs_round_trip():
    rng = np.random.default_rng(1)
    for x in (np.zeros(0, np.uint64), np.array([5], np.uint64), np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64)), np.array([1, 1 << 60], np.uint64)):
        assert (bloom_lm.unpack(bloom_lm.pack(x)) == x).all()
    n = np.array([1, 254, 255, 256, 10 ** 9])
    assert (bloom_lm._uncounts(bloom_lm._counts(n), 5) == n).all()


# 9 embeddings

def brute(vectors):
    good = {i: np.array(v, float) / np.linalg.norm(v) for i, (_, v) in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and any(v)}
    near = {i: {j for j, w in good.items() if j != i and len(w) == len(v) and v @ w >= 0.95} for i, v in good.items()}
    out = []
    for i, (vid, _) in enumerate(vectors):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [vectors[j][0] for j in seen if vectors[j][0] is not None]
        c = min(ids) if ids else None
        out.append((vid, len(near.get(i, ())), c, vid == c))
    return out


@pytest.mark.parametrize("block", [1024, 16])
def test_embeddings(spark, block):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 24))
    rows = [(i * 10 + k, (b + rng.standard_normal(24) * 0.1).tolist()) for i, b in enumerate(base) for k in range(80 if i == 0 else rng.integers(1, 4))]
    rows += [(5000, None), (5001, []), (5002, [0.0] * 24), (5003, [math.nan] + [1.0] * 23), (5004, [None] + [1.0] * 23), (5005, [math.inf] + [1.0] * 23), (None, rows[5][1]),
             (5006, rows[5][1]), (5007, [x * 3 for x in rows[5][1]]), (5008, [1.0, 2.0]), (5009, [1.0, 2.0001]), (None, None)]
    got = itq_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=block, miss=0.001).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_embeddings_table_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = sorted(brute([(r.vec_id, r.embedding) for r in rows.limit(400).collect()]))
    assert sorted(map(tuple, itq_dedup.near_duplicates(rows.limit(400)).collect())) == want
    assert itq_dedup.near_duplicates(rows.where("false")).count() == 0


# 10 WARC

def test_warc_round_trip(spark):
    rows = [(3, "http://a/é ?q=1\r\n", "same"), (1, "u", "same"), (None, None, "same"), (2, "u", None), (4, "u", ""), (1, "u", "same"), (9, "u", "é" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(0))
    got = sorted(map(tuple, warc_io.round_trip(pages).collect()), key=str)
    want = []
    for p, _, h in rows:
        data = (h or "").encode()
        first = {"same": 1, "": 2}.get(h or "", p)
        want.append([p, len(data), warc_io.digest(data), "response" if p == first else "revisit", None if p == first else first])
    want[5][3:] = ["revisit", 1]  # of repeated rows the first is the response
    assert got == sorted(map(tuple, want), key=str)
    small = warc_io.round_trip(pages, min_bytes=5).where("record_type = 'revisit'").count()
    assert small == 0 and warc_io.round_trip(pages.where("false")).count() == 0


def test_warc_payloads_and_damage(spark):
    from parcelle.llm.common import new_folder
    pages = read(spark, "pages")
    index = warc_io.write_archives(pages, new_folder(spark, "warc-test"), max_bytes=50_000)
    assert index.count() > 1
    got = {r.page_id: (r.url, bytes(r.payload).decode()) for r in warc_io.read_archives(index).collect() if r.record_type == "response"}
    assert all(got[r.page_id] == (r.url, r.html) for r in pages.collect() if r.page_id in got) and got
    import io
    good = warc_io.record(1, "u", b"payload", None, 0, "d")
    assert [warc_io.parse(m)["payload"] for m in warc_io.members(io.BytesIO(good * 3), chunk=7)] == [b"payload"] * 3
    with pytest.raises(warc_io.Corrupt):
        list(warc_io.members(io.BytesIO(good[:-9])))
    plain = next(warc_io.members(io.BytesIO(good)))
    for broken in (plain.replace(b"payload\r", b"paylaod\r"), plain[:-1], plain.replace(b"Content-Length: 8", b"Content-Length: 7")):
        with pytest.raises(warc_io.Corrupt):
            warc_io.parse(broken)
