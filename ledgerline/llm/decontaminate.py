"""Operator 13: finding benchmark passages in documents by winnowing.

Both sides are cut into words; a window is WINDOW consecutive words of an item (or
the whole of a shorter one). Of each window the smallest hash of its k-grams is kept
(Schleimer, Wilkerson and Aiken, "Winnowing: Local Algorithms for Document
Fingerprinting", 2003), with k chosen so that k plus the k-grams of a window less one
is the window: equal windows have equal minima wherever they stand, so no shared
window is missed. Documents' fingerprints are semi-joined with the items', where they
meet hits are extended to the window around them and compared word by word, and
overlapping windows merge into spans. Hashes only propose; words decide.

All of it is DataFrame functions on word arrays, in one pass over the texts; explodes
hold fingerprints only, and words are joined to text after a hit. The items' distinct
fingerprints are broadcast in blocks of BLOCK at most, a pass over the documents for
each block, so neither memory nor a shuffle of all documents' fingerprints grows with
the benchmark. What is found is keyed by the text's digest, so copies are worked on
once, however many there are. A passage that many texts or many items share costs
no pairs: a window is one row for a text, whatever number of items has it, items are
looked up for each distinct set of windows and not for each text, and hot windows and
texts are joined by ``common.keyed_join`` and ``keyed_left``.

Null texts have no words: nothing hits. Items without words have no window. Ids of items are
taken as text and a null id as the empty one; items that repeat an id are one item,
with the windows of all. Repeated and null doc_ids are rows of their own. Very long texts are
arrays in one row. Extra columns aren't read; empty tables give no rows, or no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm import common

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between words, before and after capitals are lowered.
GAP, RAW_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, GRAM = 10, 5
#: Distinct fingerprints of items that are broadcast at once.
BLOCK = 1 << 20


def words(text: Column | str) -> Column:
    """A cut at the gaps costs half of what matching the words does; gaps at either end leave an empty piece."""
    return F.array_remove(F.split(common.ascii_lower(text), GAP), "")


def n_words(text: str = "text") -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), RAW_GAP), "")).cast("long")


def digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def fingerprints(array: str, size: int) -> Column:
    """The smallest k-gram hash of each window of ``size`` words, by the window's place; empty if there are fewer words."""
    k = min(GRAM, size)
    n = F.size(array)
    upto = lambda last: F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    grams = F.transform(upto(n - k), lambda i: F.xxhash64(*[F.col(array)[i + j] for j in range(k)]))
    if size == k:
        return grams
    # the grams are bound to a name by a one-element array, so that they are computed once
    least = lambda g: F.transform(upto(n - size), lambda i: F.least(*[g[i + j] for j in range(size - k + 1)]))
    return F.transform(F.array(grams), least)[0]


def passage(array: str, start: Column, size: int) -> Column:
    """The window's words as text: no word holds a blank."""
    return F.array_join(F.slice(array, start + 1, F.lit(size)), " ")


def items(benchmark: DataFrame, item_id: str = "item_id") -> DataFrame:
    """item_id, words, size (of its windows): the items that have words."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), words("text").alias("words"))
    return rows.where(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(WINDOW)))


def windows(held: DataFrame, size: int) -> DataFrame:
    """(item_id, fp, passage) of all items with windows of ``size`` words."""
    own = held.where(F.col("size") == size).select("item_id", "words", F.posexplode(fingerprints("words", size)).alias("start", "fp"))
    return own.select("item_id", "fp", passage("words", F.col("start"), size).alias("passage"))


def proposed(docs: DataFrame, marks: DataFrame, size: int) -> DataFrame:
    """(digest, start, size, passage): the windows of texts whose fingerprint an item has, without repeats.

    marks: distinct fp. Each block of them is a pass over the documents.
    """
    blocks = -(-marks.count() // BLOCK)
    out = []
    for b in range(blocks):
        part = F.broadcast(marks.where(F.pmod(F.hash("fp"), F.lit(blocks)) == b) if blocks > 1 else marks)
        own = docs.select("text", words("text").alias("words")).select("text", "words", F.posexplode(fingerprints("words", size)).alias("start", "fp"))
        met = own.join(part, "fp", "left_semi")
        out.append(met.select(digest().alias("digest"), "start", F.lit(size).alias("size"), passage("words", F.col("start"), size).alias("passage")))
    return reduce(DataFrame.unionByName, out).dropDuplicates(["digest", "start"])


def occurrences(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """Where windows occur in texts (digest, start, size, owners), and who the owners are (owners, item_id).

    owners is a digest of a set of items: windows that the same items have share it.
    """
    held = common.stored(items(benchmark, item_id), "items")
    found, sets = [], []
    for row in held.select("size").distinct().collect():  # WINDOW sizes at most
        own = common.stored(windows(held, row["size"]), "windows")
        hits = common.stored(proposed(docs, own.select("fp").distinct(), row["size"]), "proposed")
        seen = common.stored(hits.groupBy("passage").agg(F.count(F.lit(1)).alias("n")), "passages")
        total = seen.agg(F.sum("n")).first()[0] or 0
        met = own.join(seen.hint("shuffle_hash"), "passage").select("passage", "n", "item_id").distinct()
        # the set's digest is a sum over its members, so sets needn't be gathered to be told apart
        mark = [F.sum(F.conv(F.substring(F.sha2("item_id", 256), 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")) for i in range(4)]
        owners = common.stored(met.groupBy("passage").agg(F.first("n").alias("n"), F.sha2(F.concat_ws(",", *mark, F.count(F.lit(1))), 256).alias("owners")), "owners")
        one = owners.groupBy("owners").agg(F.min("passage").alias("passage"))
        sets.append(one.join(met, "passage").select("owners", "item_id"))
        found.append(common.keyed_join(hits, owners, "passage", "n", total).select("digest", "start", "size", "owners"))
    if not found:
        none = docs.sparkSession.createDataFrame([], "digest binary, start int, size int, owners string, item_id string")
        return none.drop("item_id"), none.select("owners", "item_id")
    return common.stored(reduce(DataFrame.unionByName, found), "occurrences"), common.stored(reduce(DataFrame.unionByName, sets).distinct(), "sets")


def spans(found: DataFrame) -> DataFrame:
    """(digest, first, end): the stretches of words that windows cover, end excluded."""
    order = Window.partitionBy("digest").orderBy("start", "size")
    reach = F.max(F.col("start") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = found.select("digest", "start", "size").withColumn("_new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    rows = rows.withColumn("_span", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("digest", "_span").agg(F.min("start").alias("first"), F.max(F.col("start") + F.col("size")).alias("end")).drop("_span")


def hits(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id") -> DataFrame:
    """One row per contaminated text: digest, n_hit, n_items, items_sha256."""
    found, sets = occurrences(docs, benchmark, item_id)
    words_hit = spans(found).groupBy("digest").agg(F.sum(F.col("end") - F.col("first")).cast("long").alias("n_hit"))
    # texts with the same sets of items share a kind; items are gathered once for each kind
    kinds = common.stored(found.select("digest", "owners").distinct().groupBy("digest").agg(F.array_sort(F.collect_set("owners")).alias("kind")), "kinds")
    each = kinds.select("kind").distinct().select("kind", F.explode("kind").alias("owners")).join(sets, "owners").groupBy("kind").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    facts = each.select("kind", F.size("ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"))
    return words_hit.join(kinds.join(facts, "kind"), "digest").select("digest", "n_hit", "n_items", "items_sha256")


def marked(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = common.stored(hits(docs, benchmark, item_id), "contaminated")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n_words().alias("n_words"), digest().alias("digest"))
    rows = common.stored(rows, "texts")
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("_rows"))  # combines before the shuffle, so copies meet nowhere
    found = common.stored(found.join(sizes, "digest"), "contaminated")
    total = found.agg(F.sum("_rows")).first()[0] or 0
    out = common.keyed_left(rows, found, "digest", "_rows", total)
    none = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id") -> DataFrame:
    """The documents that no window occurs in, with all their columns."""
    found = common.stored(hits(docs, benchmark, item_id).select(F.col("digest").alias("_digest")), "contaminated")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), digest().alias("_own"))
    return row.join(found, F.col("_own") == F.col("_digest"), "left_anti").select("row.*")


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'), '{WORD}')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, w, least(len(w), {WINDOW}) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
b AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1 : s + n], ' ') AS passage FROM (SELECT *, unnest(range(0, len(w) - n + 1)) AS s FROM i)),
p AS (SELECT r, s, n, array_to_string(w[s + 1 : s + n], ' ') AS passage
      FROM (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
o AS (SELECT r, s, n, item_id FROM p JOIN b USING (n, passage)),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS q FROM o) GROUP BY 1),
c AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM o GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN c USING (r)"""
