"""Operator 5, benchmark decontamination: a prefix-filtered set join on word windows.

Words: A-Z lower-cased, then maximal runs of ASCII letters and digits and of anything beyond ASCII.  A window is
13 consecutive words of an item, or the whole item where it is shorter.  A window is contained where all its
words are, so a prefix of one token is necessary: its rarest word over all documents.  Documents' words are
joined with those words (prefix filter); the offset in the window gives the only place where it can stand
(positional bound), which must lie within the document (length bound); the words there are then compared with
the whole window (exact containment).  DataFrame operations only.

Defined results: a null or empty text has no words, no hits, and isn't contaminated; an item without words has
no window; repeated items count once by item_id; repeated documents (same doc_id and text) give one row each;
empty tables give no rows, or rows without hits; other columns are not read; texts are read whole, whatever
their length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from econ_lake.llm.shared import ascii_lower, stored

WINDOW = 13
#: All that isn't part of a word, after lower-casing.
GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: So many windows (13 words each, some 200 bytes) are broadcast at once; more are taken in blocks of this size.
WINDOWS_AT_ONCE = 200_000
#: So many distinct words of items are broadcast to count them; more are joined by shuffling the words alone.
WORDS_AT_ONCE = 500_000
#: So many keys of contaminated documents are broadcast to drop these; more are joined by shuffling the documents.
KEYS_AT_ONCE = 500_000
#: Closes the word list of each document, so that its row survives the join and tells the number of words.
CLOSE = " end"


def words(text):
    """The words in order; none for null."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAPS), lambda w: w != "")


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(wid, item_ids, w): the distinct windows of all items."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    each = items.select("item_id", "w", F.explode(starts).alias("at")).select(
        "item_id", F.slice("w", F.col("at"), size).alias("w"))
    return each.groupBy("w").agg(F.collect_set("item_id").alias("item_ids")).withColumn("wid", F.xxhash64("w"))


def with_prefix(wins: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds the necessary prefix of each window: its rarest word in all documents, and the word's offset."""
    vocabulary = stored(wins.select(F.explode("w").alias("word")).distinct(), "vocabulary")
    if vocabulary.count() <= WORDS_AT_ONCE:
        vocabulary = F.broadcast(vocabulary)
    # written, so that its size is known: the planner broadcasts it, or splits what a frequent word joins
    seen = stored(docs.select(F.explode(words(F.col("text"))).alias("word"))
                  .join(vocabulary, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")), "seen")
    ranked = (wins.select("wid", F.posexplode("w").alias("offset", "word")).join(seen, "word", "left")
              .groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "word")).alias("p")))
    # a window with a word that no document has occurs nowhere
    return wins.join(ranked, "wid").filter(F.col("p.n") > 0).select(
        "wid", "w", "item_ids", F.col("p.word").alias("word"), F.col("p.offset").alias("offset"))


def occurrences(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(doc_id, mark, end, n_words, wid, start): a row per window found, and one with null wid per document.

    ``wins`` is a block of bounded size, and broadcast.  The words of a document are neither shuffled nor copied:
    each one is looked up, and only what is found goes on.
    """
    close = wins.sparkSession.range(1).select(F.lit(CLOSE).alias("word"), F.lit(None).cast("long").alias("wid"),
                                              F.lit(None).cast("array<string>").alias("w"),
                                              F.lit(0).alias("offset"))
    look_up = wins.select("word", "wid", "w", "offset").unionByName(close)
    each = docs.select("doc_id", F.xxhash64("text").alias("mark"),
                       F.concat(words(F.col("text")), F.array(F.lit(CLOSE))).alias("words")).select(
        "doc_id", "mark", "words", F.posexplode("words").alias("at", "word"))
    start = F.col("at") - F.col("offset")
    fits = (start >= 0) & (start + F.size("w") <= F.size("words") - 1)
    there = F.when(fits, F.slice("words", start + 1, F.size("w")) == F.col("w"))
    return (each.join(F.broadcast(look_up), "word").filter(F.col("wid").isNull() | there)
            .select("doc_id", "mark", "wid", start.alias("start"), (start + F.size("w")).alias("end"),
                    F.when(F.col("wid").isNull(), F.col("at")).alias("n_words")))


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, mark, n_words, n_hit, item_ids, copies): one row per distinct document."""
    docs = docs.select("doc_id", "text")
    wins = stored(windows(benchmark, size), "windows")
    n = wins.count()
    wins = stored(with_prefix(wins, docs), "prefixes")
    blocks = max(1, -(-n // WINDOWS_AT_ONCE))
    block = F.pmod(F.xxhash64("wid"), F.lit(blocks))
    found = None
    for k in range(blocks):
        part = occurrences(docs, wins.filter(block == k) if blocks > 1 else wins)
        part = part if k == 0 else part.filter(F.col("wid").isNotNull())
        found = part if found is None else found.unionByName(part)
    found = stored(found, "occurrences")
    key = ["doc_id", "mark"]
    spans = found.filter(F.col("wid").isNotNull()).select(*key, "start", "end", "wid")
    # the words that each span adds to those before it, in order of their starts
    before = F.max("end").over(Window.partitionBy(*key).orderBy("start", "end")
                               .rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))))
    covered = (spans.select(*key, "start", "end").distinct().withColumn("added", added)
               .groupBy(*key).agg(F.sum("added").alias("n_hit")))
    items = (spans.select(*key, "wid").distinct().join(wins.select("wid", F.explode("item_ids").alias("item_id")), "wid")
             .groupBy(*key).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))
    every = (found.filter(F.col("wid").isNull()).groupBy(*key)
             .agg(F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("copies")))
    a, b, c = every.alias("a"), covered.alias("b"), items.alias("c")

    def same(other):
        return F.col("a.doc_id").eqNullSafe(F.col(f"{other}.doc_id")) & (F.col("a.mark") == F.col(f"{other}.mark"))

    return a.join(b, same("b"), "left").join(c, same("c"), "left").select(
        "a.doc_id", "a.mark", "a.copies", F.col("a.n_words").cast("long").alias("n_words"),
        F.coalesce("b.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("c.item_ids", F.array().cast("array<string>")).alias("item_ids"))


def contaminated():
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return hits(docs, benchmark, size).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents that aren't contaminated, with all their columns.

    What goes is written first, as keys alone, so that its number is known: texts need not be shuffled to drop it.
    """
    bad = stored(hits(docs, benchmark, size).filter(contaminated()).select(
        F.col("doc_id").alias("__llm_doc"), F.col("mark").alias("__llm_mark")), "contaminated")
    if bad.count() <= KEYS_AT_ONCE:
        bad = F.broadcast(bad)
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("__llm_doc"))
                     & (F.xxhash64(docs["text"]) == F.col("__llm_mark")), "left_anti")
