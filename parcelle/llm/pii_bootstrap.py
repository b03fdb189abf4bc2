"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Four base kinds are found by pattern and check: email, ip, card, phone. They are the seeds. The words left of an
identifier-like token (a token with a digit or an @) are lexical patterns; Spark scores the graph of patterns
and identifier values in rounds: a pattern is as good as the share of all its occurrences in the corpus that
precede values believed to be personal, a value is believed as far as the patterns it occurs with vouch for it.
Patterns that end above the threshold extract identifiers that no base pattern knows (kind ``id``).

Scale: three passes over the texts without moving them. What is shuffled are identifier occurrences and the
counts of the contexts that can come to be accepted (``_reachable``), however many there are; the accepted patterns
are the model, one literal in buckets by hash, so that a look-up costs the same whatever their number.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import materialise

# The base kinds. The expressions find what the plain ones of the contract find, leftmost and not
# overlapping, but never try a run of characters twice and keep no stack: runs start where they can first start.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*?(?![A-Za-z0-9-]|\.[A-Za-z0-9-])"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])"  # others have too few or too many digits
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_OK = r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})){3}$"
LEARNED = "id"
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
SPAN = "array<struct<start:int,end:int,kind:int>>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


CHECKS = {
    "email": lambda hit: F.lit(True),
    "ip": lambda hit: hit.rlike(IP_OK),
    "card": lambda hit: F.length(_digits(hit)).between(12, 19) & _luhn(_digits(hit)),
    "phone": lambda hit: F.length(_digits(hit)).between(9, 15),
}


def _places(text: Column, pattern: str) -> Column:
    """(before, hit, start, end) of all matches: text between matches and the matches alternate, so their
    lengths in code points add up to places. The sums are taken in blocks of about the root of their number."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.filter(F.zip_with(hits, gaps, lambda h, g: F.struct(g.alias("before"), h.alias("hit"))), lambda x: x["hit"].isNotNull())
    none = F.array().cast("array<int>")
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def one(a, x):
        begin = a["at"] + F.length(x["before"])
        return F.struct((begin + F.length(x["hit"])).alias("at"), F.concat(a["out"], F.array(begin)).alias("out"))

    def join(a, x):
        return F.struct((a["at"] + x["at"]).alias("at"), F.concat(a["out"], F.transform(x["out"], lambda y: y + a["at"])).alias("out"))

    def place(xs):
        block = F.ceil(F.sqrt(F.size(xs))).cast("int")
        blocks = F.transform(F.sequence(F.lit(1), F.size(xs), block), lambda i: F.aggregate(F.slice(xs, i, block), zero, one))
        starts = F.aggregate(blocks, zero, join, lambda a: a["out"])
        return F.zip_with(xs, starts, lambda x, at: F.struct(x["before"].alias("before"), x["hit"].alias("hit"), at.alias("start"), (at + F.length(x["hit"])).alias("end")))

    empty = F.array().cast("array<struct<before:string,hit:string,start:int,end:int>>")
    # a one-element transform names the pairs, so that they are found once
    return F.flatten(F.transform(F.array(pairs), lambda xs: F.when(F.size(xs) > 0, place(xs)).otherwise(empty)))


def _kind(text: Column, kind: str, pattern: str, possible: Column) -> Column:
    number = KINDS.index(kind)
    checked = F.filter(_places(text, pattern), lambda x: CHECKS[kind](x["hit"]))
    found = F.transform(checked, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(number).alias("kind")))
    return F.when(possible, found).otherwise(F.array().cast(SPAN)).alias(kind)


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``_base``: the spans of the base kinds by start, then kind (code points)."""
    text = F.col(text_col)
    return (docs.withColumn("_found", F.struct(
        _kind(text, "email", EMAIL, F.contains(text, F.lit("@"))), _kind(text, "ip", IP, text.rlike(r"[0-9]\.[0-9]")),
        _kind(text, "card", CARD, text.rlike("[0-9]")), _kind(text, "phone", PHONE, text.rlike(r"\+[0-9]"))))
        .withColumn("_base", F.array_sort(F.concat(*(F.col(f"_found.{k}") for k in KINDS)))).drop("_found"))


def tokens(text: Column) -> Column:
    """Identifier-like tokens with the two words before them."""
    def near(x):
        return F.split(F.lower(F.rtrim(F.translate(F.substring(x["before"], -120, 120), "\t\n\r\f", "    "))), r"\s+")

    def named(x, w):
        return F.struct(x["hit"].alias("value"), x["start"].alias("start"), x["end"].alias("end"), F.element_at(w, -1).alias("one"),
                        F.when(F.size(w) > 1, F.concat_ws(" ", F.slice(w, -2, 2))).alias("two"))

    return F.when(text.rlike("[0-9@]"), F.transform(_places(text, TOKEN), lambda x: F.element_at(F.transform(F.array(near(x)), lambda w: named(x, w)), 1))).otherwise(
        F.array().cast("array<struct<value:string,start:int,end:int,one:string,two:string>>"))


def _shape(value: Column) -> Column:
    """Identifiers have at least four digits, or an @ with something on both sides."""
    return (F.length(_digits(value)) >= 4) | value.rlike(r"\S@\S")


def _reachable(edges: DataFrame, rounds: int, support: int) -> DataFrame:
    """The contexts that can have ``support`` believed values within so many rounds; all others never vouch for a
    value and are never accepted, so leaving them out changes nothing. A value can be believed if it is a seed or
    has the shape of an identifier and stands after a context that could vouch for it a round before."""
    seeds = edges.where("seed").select("value")
    likely, contexts = seeds.distinct(), None
    for _ in range(rounds):
        contexts = materialise(edges.join(likely, "value", "left_semi").groupBy("pattern").agg(F.count("*").alias("good"))
                               .where(F.col("good") >= support).select("pattern"), "pii-contexts")
        likely = edges.where("shape").join(contexts, "pattern", "left_semi").select("value").union(seeds).distinct()
    return contexts


def learn(docs: DataFrame, rounds: int = 3, threshold: float = 0.6, support: int = 3) -> list[str]:
    """The accepted contexts (one or two lower-case words), all of them.

    A context needs ``support`` different identifier values. Its precision counts every occurrence in every text.
    """
    text = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    seen = (base_spans(text.where(F.col("text").rlike("[0-9@]"))).withColumn("_tokens", tokens(F.col("text"))).drop("text")
            .select("_base", F.explode_outer("_tokens").alias("t")).where("t is not null")  # explode() would find the tokens twice, to test for some
            .select(F.xxhash64("t.value").alias("value"), "t.one", "t.two", _shape(F.col("t.value")).alias("shape"),
                    F.exists("_base", lambda s: (s["start"] >= F.col("t.start")) & (s["start"] < F.col("t.end"))).alias("seed"))
            .select("value", "shape", "seed", F.explode(F.array("one", "two")).alias("pattern")).where("pattern is not null and pattern <> ''"))
    edges = materialise(seen.groupBy("pattern", "value").agg(F.count("*").alias("n"), F.max("seed").alias("seed"), F.max("shape").alias("shape")), "pii-edges")
    common = edges.groupBy("pattern").agg(F.count("*").alias("values")).where(F.col("values") >= support)
    edges = edges.join(common, "pattern", "left_semi")
    edges = materialise(edges.drop("seed").join(edges.groupBy("value").agg(F.max("seed").alias("seed")), "value"), "pii-common")
    model = _reachable(edges, rounds, support)
    # every place where a context is followed by a token, counted where the texts lie as long as the contexts fit there
    known = model.select("pattern")
    last = model.select(F.substring_index("pattern", " ", -1).alias("last")).distinct()
    words = text.select(F.split(F.lower("text"), r"\s+").alias("w")).where(F.size("w") > 1)
    places = (words.select(F.slice("w", 1, F.size("w") - 1).alias("last"), F.concat(F.array(F.lit(None).cast("string")), F.slice("w", 1, F.size("w") - 2)).alias("prior"))
              .select(F.inline(F.arrays_zip("last", "prior"))).join(last, "last"))
    total = (places.select(F.explode(F.array("last", F.concat("prior", F.lit(" "), "last"))).alias("pattern"))
             .join(known, "pattern").groupBy("pattern").agg(F.count("*").alias("total")))
    graph = materialise(edges.join(total, "pattern").select("pattern", "value", "n", "seed", "shape", "total"), "pii-graph")
    belief = graph.groupBy("value").agg(F.max("seed").cast("double").alias("belief"))
    scores = None
    for _ in range(rounds):
        scores = materialise(graph.join(belief, "value").groupBy("pattern").agg(
            F.sum(F.col("n") * F.col("belief")).alias("mass"), F.sum((F.col("belief") > 0.5).cast("int")).alias("good"), F.max("total").alias("total"))
            .select("pattern", (F.col("mass") / (F.col("total") + 1)).alias("precision"), "good"), "pii-scores")
        vouched = F.when((F.col("good") >= support) & F.col("shape"), F.least("precision", F.lit(0.99))).otherwise(0.0)
        belief = materialise(graph.join(scores, "pattern").groupBy("value").agg(
            F.greatest(F.max("seed").cast("double"), 1 - F.exp(F.sum(F.log1p(-vouched)))).alias("belief")), "pii-belief")
    return [r.pattern for r in scores.where((F.col("precision") >= threshold) & (F.col("good") >= support)).orderBy("pattern").collect()]


def _among(context: Column, patterns: list[str]) -> Column:
    """Whether a context is one of ``patterns``: looked up in its bucket by hash, so the number of patterns hardly
    matters. Contexts hold no white space but one blank, which sets them and the buckets apart."""
    n = len(patterns)
    buckets = [[] for _ in range(n)]
    for p in patterns:
        buckets[zlib.crc32(p.encode()) % n].append(p)
    table = F.split(F.lit("\t".join("\n".join(("", *b, "")) for b in buckets)), "\t")
    own = F.get(table, (F.crc32(context.cast("binary")) % n).cast("int"))
    return F.coalesce(F.contains(own, F.concat(F.lit("\n"), context, F.lit("\n"))), F.lit(False))


def all_spans(docs: DataFrame, patterns: list[str], text_col: str = "text") -> DataFrame:
    """``docs`` with ``_base`` and ``_spans`` (base and learned, by start, then kind)."""
    docs = base_spans(docs, text_col)
    if not patterns:
        return docs.withColumn("_spans", F.col("_base"))
    new = F.filter(tokens(F.col(text_col)), lambda t: _shape(t["value"]) & (_among(t["one"], patterns) | _among(t["two"], patterns)))
    new = F.filter(new, lambda t: ~F.exists("_base", lambda s: (s["start"] < t["end"]) & (s["end"] > t["start"])))
    spans = F.transform(new, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit(len(KINDS)).alias("kind")))
    return docs.withColumn("_spans", F.array_sort(F.concat("_base", spans)))


def _names(spans: str) -> Column:
    names = F.array(*map(F.lit, (*KINDS, LEARNED)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def extract(docs: DataFrame, **learning) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every document.

    Null and empty texts hold nothing: zero counts, the hash of the empty string, an empty list. Null ids are
    kept, repeated rows repeat (and count as often in learning). Other columns are not read. Empty table: no rows.
    """
    patterns = learn(docs, **learning)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return (all_spans(rows, patterns).drop("text")
            .select("doc_id", *map(count, KINDS), F.sha2(_names("_base").cast("binary"), 256).alias("base_sha256"), _names("_spans").alias("spans")))


def redact(docs: DataFrame, **learning) -> DataFrame:
    """The documents with every span replaced by its kind in brackets (of overlapping spans the first's kind for
    their union); ``n_chars``, where there, follows the text. Null texts stay null."""
    patterns = learn(docs, **learning)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in (*KINDS, LEARNED)))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, s):
        fresh = s["start"] >= a["at"]
        out = F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"]))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(fresh, out).otherwise(a["out"]).alias("out"))

    new = F.aggregate("_spans", begin, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    done = all_spans(docs, patterns).withColumn("_text", F.when(F.size("_spans") > 0, new).otherwise(F.col("text")))
    columns = [F.col("_text").alias("text") if c == "text" else F.coalesce(F.length("_text").cast(t), F.col(c)).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c, t in docs.dtypes]
    return done.select(*columns)
