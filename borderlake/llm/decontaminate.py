"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is in a document if at least THRESHOLD of the item's distinct shingles, of five
words each, are in the document. Items are short and documents long, so their Jaccard
similarity is near zero, where MinHash signatures of whole documents find nothing.
The search is therefore asymmetric. Items are partitioned by size, in powers of two of
their shingle count. An item is sketched by its smallest shingle hashes, as many as its
size partition asks for: one more than an item of the partition may lack. A document
that holds the item then holds at least one hash of the sketch, so no item is missed.
Documents with too few shingles for an item are not its candidates. Candidates are
verified by their exact shared shingles, compared as text.

Only DataFrame functions are used. Documents are not shuffled in the search: their
shingle hashes meet the sketches, a small table, which Spark broadcasts only if it is
below the broadcast threshold and otherwise joins by shuffle. Only candidates' shingles
are compared as text. A passage in a third of all documents makes one candidate for each.

Words are runs of letters and digits, in lower case. An item with fewer than five words
is one shingle of all its words, and is looked for as such in documents.

Defined cases: null or empty texts have no words; such items are in no document and such
documents hold none. Equal items are reported each. A repeated document row is reported
once for each row. Rows with a null id are reported with that id. Empty tables give an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, drop_rows, numbered, stored

#: Words in a shingle, share of an item's shingles that a document must hold.
SHINGLE, THRESHOLD = 5, 0.8


def least(n: Column, threshold: float) -> Column:
    """The smallest whole number that is at least this share of n."""
    return F.ceil(n * threshold - 1e-9)


def words(text: str) -> Column:
    """Array of the words; empty for a text without words."""
    blank = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(blank, " "), lambda word: word != "")


def once(value: Column) -> Column:
    """The value as a row of its own, so that it is computed once and not in each place that uses it."""
    return F.explode(F.array(value))


def shingles(width: int) -> Column:
    """Distinct shingles, as text, of the array column ``words``."""
    last = F.size("words") - width
    every = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("words", i + 1, width), " "))
    return F.when(last >= 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def shingle_hashes(width: int) -> Column:
    """Hashes of the distinct shingles of the array column ``words``."""
    return F.transform(shingles(width), lambda shingle: F.xxhash64(shingle))


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """A row for each item with words: item, item_id, width (words in a shingle), its shingles,
    needed (shingles a document must hold) and sketch (smallest hashes)."""
    split = numbered(items, "item_id", "text").select(F.col(ROW).alias("item"), "item_id", once(words("text")).alias("words"))
    split = split.filter(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(SHINGLE)))
    by_width = F.when(F.col("width") == SHINGLE, shingles(SHINGLE)).otherwise(F.array(F.array_join("words", " ")))
    sized = split.withColumn("shingles", once(by_width)).withColumn("n", F.size("shingles"))
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1  # of the item's size partition
    lacking = largest - least(largest, threshold)
    hashes = F.array_sort(F.transform("shingles", lambda shingle: F.xxhash64(shingle)))
    return sized.select(
        "item",
        "item_id",
        "width",
        "shingles",
        "n",
        least(F.col("n"), threshold).alias("needed"),
        F.slice(hashes, F.lit(1), (lacking + 1).cast("int")).alias("sketch"),
    )


def find_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document and item it holds: doc_id, item_id, n_shared, n_item,
    containment, and the row id of ``docs``, which must be a stored table."""
    sketched = stored(sketches(items, threshold), "benchmark-sketches")
    widths = [row["width"] for row in sketched.select("width").distinct().collect()]  # at most five
    split = numbered(docs, "doc_id", "text").select("doc_id", ROW, once(words("text")).alias("words"))
    probes = stored(sketched.select("item", "width", "needed", F.explode("sketch").alias("hash")), "benchmark-probes")
    searched = [
        split.select(ROW, once(shingle_hashes(width)).alias("hashes"))
        .select(ROW, F.size("hashes").alias("n"), F.explode("hashes").alias("hash"))
        .join(probes.filter(F.col("width") == width), "hash")
        .filter(F.col("n") >= F.col("needed"))
        .select(ROW, "item")
        for width in widths
    ]
    if not searched:
        empty = "doc_id long, item_id long, n_shared long, n_item long, containment double"
        return docs.sparkSession.createDataFrame([], f"{empty}, {ROW} long")
    candidates = stored(reduce(DataFrame.union, searched).distinct(), "benchmark-candidates")
    wanted = sketched.select("item", "item_id", "width", F.col("n").alias("n_item"), F.explode("shingles").alias("shingle"))
    texts = split.join(candidates.select(ROW).distinct(), ROW, "left_semi")
    found = [
        texts.select("doc_id", ROW, F.explode(shingles(width)).alias("shingle"))
        .join(wanted.filter(F.col("width") == width), "shingle")
        .groupBy(ROW, "doc_id", "item", "item_id", "n_item")
        .agg(F.count("*").alias("n_shared"))
        for width in widths
    ]
    shared = reduce(DataFrame.union, found).join(candidates, [ROW, "item"], "left_semi")
    whole = F.col("n_shared") / F.col("n_item")
    return shared.filter(F.col("n_shared") >= least(F.col("n_item"), threshold)).select(
        "doc_id",
        "item_id",
        "n_shared",
        F.col("n_item").cast("long").alias("n_item"),
        whole.alias("containment"),
        ROW,
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    return drop_rows(docs, find_items(docs, items, threshold))
