"""Document fingerprints by weighted SimHash, in DataFrame operations only.

Terms are a text's lower-cased words, weighted by their length beyond three
letters (five at most), and its pairs of neighbouring words, weighted two. Each
occurrence of a term adds its weight, signed by the term's hash, to each bit's
vote. A sum of many 0/1 votes is kept in half a long, so that one addition serves
two bits. Fingerprints are found again
within a Hamming radius by block tables: of `blocks` blocks at least blocks - radius are equal, so for each choice
of that many a table with those blocks in front is searched by equality. From a radius of `blocks`
on, one block differs in radius // blocks bits at most: each block has its table, and
queries look up all its values within those bits. A table's entries with one front are arrays of bounded length, which a query meets
as wholes; a pair counts in the first table that has it. So a large group of near copies is met in blocks, and no row stands for a pair.

Defined results: every row is a document. A null text is empty; a text without a word has fingerprint
zero. Documents are in the order of their ids; null ids come before the smallest. Documents that share an id are in the order of
a hash of their texts. Equal texts have equal fingerprints. The only document is its own next one. An empty table gives an empty
one. Further columns, whatever their names, take no part.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import settled, stored

HALVES = 2
BITS = 64 * HALVES
#: The bits of a long that one sum serves.
LANES = (1 << 32) | 1
SPACE = r"[\x20\x09-\x0D]+"
PAIR_WEIGHT = 2


def _terms(text: Column) -> Column:
    """Array of word, nxt: words with those that follow them."""
    words = F.filter(F.split(F.lower(text), SPACE), lambda w: w != "")
    return F.arrays_zip(words.alias("word"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("nxt"))


def _lane(value: Column, bit: int) -> Column:
    return (F.shiftrightunsigned(value, bit) if bit else value).bitwiseAND(F.lit(LANES))


def fingerprint_texts(texts: DataFrame, keys: list[str], text_column: str = "text") -> DataFrame:
    """keys, f0, f1 (the fingerprint's halves, long): texts without a word are left out. Where texts is dealt by one of the keys, no shuffle follows."""
    rows = texts.select(*keys, F.explode(_terms(F.col(text_column))).alias("t")).select(*keys, F.col("t.word").alias("word"), F.col("t.nxt").alias("nxt"))
    weight = F.greatest(F.least(F.length("word"), F.lit(8)) - 3, F.lit(0)).cast("long")
    pair = F.when(F.col("nxt").isNotNull(), F.lit(PAIR_WEIGHT)).otherwise(0).cast("long")
    rows = rows.select(*keys, weight.alias("w"), pair.alias("p"), F.xxhash64("word").alias("a0"), F.xxhash64("word", "nxt").alias("b0"))
    for h in range(1, HALVES):
        rows = rows.withColumn(f"a{h}", F.xxhash64(f"a{h - 1}")).withColumn(f"b{h}", F.xxhash64(f"b{h - 1}"))
    sums = [F.sum(_lane(F.col(f"a{h}"), i) * F.col("w") + _lane(F.col(f"b{h}"), i) * F.col("p")).alias(f"s{h}_{i}") for h in range(HALVES) for i in range(32)]
    counted = rows.groupBy(*keys).agg(F.sum(F.col("w") + F.col("p")).alias("total"), *sums)

    def half(h: int) -> Column:
        value = F.lit(0).cast("long")
        for i in range(32):
            low, high = F.col(f"s{h}_{i}").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(F.col(f"s{h}_{i}"), 32)
            value = value.bitwiseOR(F.when(low * 2 > F.col("total"), F.lit(1 << i).cast("long")).otherwise(0))
            top = (1 << (i + 32)) - (1 << 64 if i == 31 else 0)
            value = value.bitwiseOR(F.when(high * 2 > F.col("total"), F.lit(top).cast("long")).otherwise(0))
        return value

    return counted.select(*keys, *[half(h).alias(f"f{h}") for h in range(HALVES)])


def likeness(a: list[Column], b: list[Column]) -> Column:
    """Share of equal bits."""
    return 1.0 - sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)), F.lit(0)) / float(BITS)


def as_text(halves: list[Column]) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(h)), 16, "0") for h in halves])


#: A document's place: whether it has an id, the id, and a hash of its text.
KEY = ["has", "id", "h"]
#: Rows that one array stands for.
STEP = 4096


def _key(prefix: str = "") -> list[Column]:
    return [F.col(prefix + c) for c in KEY]


def neighbours(places: DataFrame) -> DataFrame:
    """places: KEY (distinct) and further columns. The same with next (a struct of KEY): the next smaller place; after the smallest comes the greatest.

    They are dealt into ranges; within one, the order is a window's, and the ranges' ends meet in a table of a row a range."""
    ranged = settled(places.repartitionByRange(*KEY).withColumn("range", F.spark_partition_id()))
    ends = ranged.groupBy("range").agg(F.max(F.struct(*KEY)).alias("greatest"))
    across = Window.orderBy("range")
    ends = ends.select("range", F.lag("greatest").over(across).alias("before"), F.last("greatest").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"))
    within = ranged.withColumn("down", F.lag(F.struct(*KEY)).over(Window.partitionBy("range").orderBy(*KEY)))
    return within.join(F.broadcast(ends), "range").select(*places.columns, F.coalesce("down", "before", "last").alias("next"))


def with_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """KEY, times (rows with this place, equal throughout), next (a place), text, edited, own: the text with its last third of code points replaced by the start of the next place's text, and, where there are several such rows, by its own start (each but the last is followed by its like)."""
    id_, text = docs[id_column].cast("long"), F.coalesce(docs[text_column].cast("string"), F.lit(""))
    kept = docs.select(id_.isNotNull().alias("has"), F.coalesce(id_, F.lit(0)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    base = kept.repartition(*KEY).groupBy(*KEY).agg(F.max("text").alias("text"))
    around = neighbours(kept.groupBy(*KEY).agg(F.max(F.char_length("text")).alias("n"), F.count("*").alias("times")))
    wanted = around.select(*[F.col(f"next.{c}").alias(c) for c in KEY], F.struct(*KEY).alias("target"), "times", F.floor(F.col("n") / 3).cast("int").alias("k"))
    starts = wanted.join(base, KEY).select(*[F.col(f"target.{c}").alias(c) for c in KEY], "times", F.struct(*KEY).alias("next"), F.substring(F.col("text"), F.lit(1), F.col("k")).alias("start"))
    n = F.char_length("text")
    k = F.floor(n / 3).cast("int")
    stays = F.substring(F.col("text"), F.lit(1), n - k)
    own = F.when(F.col("times") > 1, F.concat(stays, F.substring(F.col("text"), F.lit(1), k)))
    return base.join(starts, KEY).select(*KEY, "times", "next", "text", F.concat(stays, F.substring(F.col("start"), F.lit(1), k)).alias("edited"), own.alias("own"))


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """KEY, times, next, n_chars, edited_sha256, own_sha256, f0, f1, e0, e1, s0, s1 (the halves for the text, the edited text, and the text edited by itself)."""
    both = with_edits(docs, id_column, text_column)
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    plain = both.select(*KEY, "times", "next", F.char_length("text").cast("long").alias("n_chars"), sha("edited"), sha("own"))
    texts = F.array(*[F.struct(F.lit(w).alias("which"), F.col(c).alias("text")) for w, c in enumerate(("text", "edited", "own"))])
    found = fingerprint_texts(both.select(*KEY, F.explode(F.filter(texts, lambda x: x["text"].isNotNull())).alias("x")).select(*KEY, "x.which", "x.text"), [*KEY, "which"])
    zero = F.lit(0).cast("long")
    halves = [(w, c, h) for w, c in enumerate("fes") for h in range(HALVES)]
    merged = found.groupBy(*KEY).agg(*[F.max(F.when(F.col("which") == w, F.col(f"f{h}"))).alias(f"{c}{h}") for w, c, h in halves])
    return plain.join(merged, KEY, "left").select(*plain.columns, *[F.coalesce(f"{c}{h}", zero).alias(f"{c}{h}") for _, c, h in halves])


def _block(halves: list[Column], low: int, high: int) -> Column:
    """Bits low to high of a fingerprint as a long, high half first; they may reach over the halves."""
    value = F.lit(0).cast("long")
    for h in range(HALVES):
        a, b = max(low, 64 * h), min(high, 64 * (h + 1))
        if a < b:
            part = F.shiftrightunsigned(halves[h], a - 64 * h).bitwiseAND(F.lit((1 << (b - a)) - 1))
            value = F.shiftleft(value, b - a).bitwiseOR(part)
    return value


def _met(queries: DataFrame, index: DataFrame, radius: int, blocks: int, most: int) -> DataFrame:
    """q0, q1, hits (array of f0, f1, size): what a query fingerprint finds in one array of a table. queries: f0, f1; index: f0, f1, size; both distinct."""
    if radius < 1 or not 1 < blocks <= BITS:
        raise ValueError("radius must be 1 or more, blocks 2 to 128")
    slack = radius // blocks
    bounds = [i * BITS // blocks for i in range(blocks + 1)]
    own = [F.col(f"f{h}") for h in range(HALVES)]
    block = [_block(own, a, b) for a, b in zip(bounds, bounds[1:])]
    tables = list(combinations(range(blocks), 1 if slack else blocks - radius))

    def permuted(fps: DataFrame, *more: str) -> DataFrame:
        entries = F.array(*[F.xxhash64(F.lit(t), *[block[i] for i in front]) for t, front in enumerate(tables)])
        return fps.select("f0", "f1", *more, F.posexplode(entries).alias("entry", "front"))

    def probed(fps: DataFrame) -> DataFrame:
        """Entries for a block's values within slack bits of the query's own."""
        masks = [[sum(1 << b for b in bits) for n in range(slack + 1) for bits in combinations(range(hi - lo), n)] for lo, hi in zip(bounds, bounds[1:])]

        def values(i: int) -> Column:
            return F.transform(F.array(*[F.lit(m).cast("long") for m in masks[i]]), lambda m: F.struct(F.lit(i).alias("entry"), F.xxhash64(F.lit(i), block[i].bitwiseXOR(m)).alias("front")))

        return fps.select("f0", "f1", F.inline(F.flatten(F.array(*[values(i) for i in range(blocks)]))))

    entries = permuted(index, "size")
    large = entries.groupBy("entry", "front").agg(F.count("*").alias("n")).where(F.col("n") > most)
    part = F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("f0", "f1"), F.ceil(F.col("n") / most)))
    arrays = entries.join(large, ["entry", "front"], "left").select("entry", "front", part.alias("part"), F.struct("f0", "f1", "size").alias("x"))
    arrays = arrays.repartition("entry", "front", "part").groupBy("entry", "front", "part").agg(F.collect_list("x").alias("members"))
    asked = (probed if slack else permuted)(queries).select(F.col("f0").alias("q0"), F.col("f1").alias("q1"), "entry", "front")

    def differ(x: Column) -> list[Column]:
        return [F.col(f"q{h}").bitwiseXOR(x[f"f{h}"]) for h in range(HALVES)]

    def near(x: Column) -> Column:
        return sum((F.bit_count(d) for d in differ(x)), F.lit(0)).between(1, radius)

    def first(x: Column) -> Column:
        """Whether no earlier table has the pair."""
        fits = [F.bit_count(_block(differ(x), a, b)) <= slack for a, b in zip(bounds, bounds[1:])]
        earlier = F.lit(False)
        for t, front in enumerate(tables):
            whole = F.lit(True)
            for i in front:
                whole = whole & fits[i]
            earlier = earlier | ((F.col("entry") > t) & whole)
        return ~earlier

    # sorted, not sent to all: the planner takes what is asked for as small as the queries that it is made of
    return asked.join(arrays.hint("merge"), ["entry", "front"]).select("q0", "q1", F.filter(F.filter("members", near), first).alias("hits")).where(F.size("hits") > 0)


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3, blocks: int = 6, most: int = 1024) -> DataFrame:
    """q0, q1, f0, f1: all pairs of a query fingerprint and another index fingerprint (both distinct, columns f0, f1) that differ in 1 to radius bits, once each."""
    met = _met(queries, index.select("f0", "f1", F.lit(1).cast("long").alias("size")), radius, blocks, most)
    return met.select("q0", "q1", F.inline("hits")).drop("size")


def document_fingerprints(docs: DataFrame, is_query: Column, radius: int = 3, blocks: int = 6, most: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near, n_near_docs: for documents that are queries (a condition on doc_id), how many other fingerprints of documents lie within the radius, and how many other documents have one of these or the same fingerprint; else null."""
    rows = stored(fingerprint_documents(docs, id_column, text_column).withColumn("doc_id", F.when(F.col("has"), F.col("id"))))
    is_query = F.coalesce(is_query, F.lit(False))
    of_next = rows.select(F.struct(*KEY).alias("next"), *[F.col(f"f{h}").alias(f"n{h}") for h in range(HALVES)])
    index = stored(rows.groupBy("f0", "f1").agg(F.sum("times").alias("size")))
    met = _met(rows.where(is_query).select("f0", "f1").distinct(), index, radius, blocks, most)
    near = met.groupBy(F.col("q0").alias("f0"), F.col("q1").alias("f1")).agg(F.sum(F.size("hits")).alias("found"), F.sum(F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["size"])).alias("found_docs"))
    near = index.join(near, ["f0", "f1"], "left").select("f0", "f1", "found", (F.coalesce("found_docs", F.lit(0)) + F.col("size") - 1).cast("long").alias("found_docs"))
    own, edited, self_edited, following = ([F.col(f"{c}{h}") for h in range(HALVES)] for c in "fesn")
    joined = rows.join(of_next, "next").join(near, ["f0", "f1"], "left")

    def variant(sha: str, e: list[Column], n: list[Column], times: Column) -> Column:
        return F.struct(F.col(sha).alias("edited_sha256"), as_text(e).alias("edited_fingerprint"), likeness(own, e).alias("near_edited"), likeness(own, n).alias("near_next"), times.cast("long").alias("times"))

    # of the rows of one place the last is followed by the next place's document, the others by their like
    variants = F.array(variant("edited_sha256", edited, following, F.lit(1)), variant("own_sha256", self_edited, own, F.col("times") - 1))
    said = joined.select("doc_id", "n_chars", as_text(own).alias("fingerprint"), F.when(is_query, F.coalesce("found", F.lit(0).cast("long"))).alias("n_near"), F.when(is_query, F.col("found_docs")).alias("n_near_docs"), F.explode(F.filter(variants, lambda v: v["times"] > 0)).alias("v"))
    steps = said.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("v.times") - 1) / STEP))))
    every = steps.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(STEP).cast("long"), F.col("v.times") - F.col("step") * STEP))))
    return every.select("doc_id", "n_chars", "v.edited_sha256", "fingerprint", "v.edited_fingerprint", "v.near_edited", "v.near_next", "n_near", "n_near_docs")
