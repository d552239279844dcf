"""Benchmark decontamination: short test items found inside long documents.

The similarity is containment: the share of an item's distinct word shingles that a document holds.
Items are partitioned by size. In each partition an item is sketched by its ``k`` smallest shingle
hashes (a bottom-k MinHash), with k just large enough for the partition that a document containing
the item to the threshold must hold one of them: if at most ``s - k`` of s shingles may be missing
beside the k, one of the k is there. So the search by single sketch values loses nothing, however
long the document is against the item. Documents too short for a partition skip it. Every candidate
is then verified on the shingles themselves, as strings.

Shingles are five words in lower case; a text of fewer words is one shingle, a blank or null one has
none and is in no result. Documents are read once: sketch values are looked up where the document is,
and only texts of candidates are shuffled. The sketches are broadcast only up to
``MAX_BROADCAST_ROWS`` values, otherwise joined by hash.

Defined cases: rows that share a doc_id are searched each by its own text and count as the best of
them; rows that share an item_id are one item of all their shingles; null ids are ids like any other. Ties and repeated passages count once.
All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptide.llm.common import BLANK, cut

SHINGLE_WORDS = 5
#: Containment in hundredths from which an item counts as leaked.
THRESHOLD = 80
#: Sketch values (a hash and an item each) that are sent to every task, at most.
MAX_BROADCAST_ROWS = 1_000_000
BLANKS = " \t\n\x0b\x0c\r"


def with_words(df: DataFrame) -> DataFrame:
    """The frame with ``words``: the words of ``text`` in lower case; none for null and blank texts."""
    trimmed = F.btrim(F.lower(F.coalesce("text", F.lit(""))), F.lit(BLANKS))
    words = F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(
        F.split("trimmed", f"{BLANK}+", -1)
    )
    return df.withColumn("trimmed", trimmed).withColumn("words", words).drop("trimmed")


def _shingled(words: Column, whole, window) -> Column:
    count = F.size(words)
    many = F.transform(
        F.sequence(F.lit(0), F.greatest(count - SHINGLE_WORDS, F.lit(0))),
        lambda i: window([F.get(words, i + j) for j in range(SHINGLE_WORDS)]),
    )
    few = F.when(count > 0, F.array(whole(words))).otherwise(F.slice(many, 1, 0))
    return F.when(count >= SHINGLE_WORDS, many).otherwise(few)


def shingle_hashes(words: Column) -> Column:
    return _shingled(
        words, lambda w: F.xxhash64(F.array_join(w, " ")), lambda parts: F.xxhash64(*parts)
    )


def shingle_texts(words: Column) -> Column:
    return F.array_distinct(
        _shingled(words, lambda w: F.array_join(w, " "), lambda parts: F.concat_ws(" ", *parts))
    )


def sketches(items: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Sketch values of all items: hash, item_id, size_class, need (shingles a document must
    have at least). The size class is the power of two above the item's number of shingles, and sets
    how many values its items have."""
    rows = with_words(items.select("item_id", "text"))
    rows = rows.select("item_id", "text", F.array_distinct(shingle_hashes(F.col("words"))).alias("h"))
    rows = rows.select("item_id", "text", F.size("h").alias("n"), F.array_sort("h").alias("h"))
    need = F.expr(f"(n * {threshold} + 99) div 100")
    rows = rows.withColumns(
        {"size_class": F.ceil(F.log2("n")).cast("int"), "missing": F.col("n") - need, "need": need}
    )
    # All items of a class get the sketch length of the class's largest.
    most = F.max("missing").over(W.partitionBy("size_class"))
    values = rows.withColumn("k", most + 1).select(
        "item_id", "size_class", "need",
        F.explode_outer(F.slice("h", F.lit(1), F.col("k").cast("int"))).alias("hash"),
    )
    return values.where("hash is not null").distinct()


def find_leaks(docs: DataFrame, items: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs of a document and an item it contains: doc_id, item_id, n_item, n_shared."""
    items = items.select("item_id", "text")
    known = cut(sketches(items, threshold))
    bounded = known.count() <= MAX_BROADCAST_ROWS
    values = F.broadcast(known) if bounded else known
    words = with_words(docs.select("doc_id", "text"))
    hashed = words.select("doc_id", "text", shingle_hashes(F.col("words")).alias("hashes"))
    # Outer, as the filter that Spark derives from a plain explode would compute all hashes twice.
    held = hashed.select(
        "doc_id", "text", F.size("hashes").alias("n_doc"), F.explode_outer("hashes").alias("hash")
    )
    hits = held.join(values, "hash").where("n_doc >= need")
    # A document's hits on one item become one candidate, in the map task already.
    candidates = hits.select("doc_id", "item_id", "text").distinct()
    found = with_words(candidates.withColumn("key", F.xxhash64("text"))).select(
        "doc_id", "item_id", "key", F.explode_outer(shingle_texts(F.col("words"))).alias("shingle")
    )
    wanted = with_words(items).select(
        F.col("item_id").alias("_item"), F.explode_outer(shingle_texts(F.col("words"))).alias("_shingle")
    )
    wanted = cut(wanted.where("_shingle is not null").distinct())
    sizes = wanted.groupBy("_item").agg(F.count("*").cast("int").alias("n_item"))
    if bounded:
        wanted, sizes = F.broadcast(wanted), F.broadcast(sizes)
    same = F.col("item_id").eqNullSafe(F.col("_item"))
    shared = found.join(wanted, same & (F.col("shingle") == F.col("_shingle")))
    counted = shared.groupBy("doc_id", "item_id", "key").agg(F.count("*").cast("int").alias("n"))
    best = counted.groupBy("doc_id", "item_id").agg(F.max("n").alias("n_shared"))
    leaks = best.join(sizes, same).where(f"n_shared * 100 >= n_item * {threshold}")
    return leaks.select("doc_id", "item_id", "n_item", "n_shared")


def drop_leaking(docs: DataFrame, items: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents that contain no item."""
    leaking = find_leaks(docs, items, threshold).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaking, F.col("doc_id").eqNullSafe(F.col("_leak")), "left_anti")


def shingles_sql(table: str, key: str) -> str:
    return rf"""
  SELECT DISTINCT {key}, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i + 4], ' ')
    ELSE array_to_string(w, ' ') END AS shingle
  FROM (
    SELECT {key}, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i
    FROM (
      SELECT {key}, list_filter(string_split_regex(lower(coalesce(text, '')),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM {table}
    ) WHERE len(w) > 0
  )"""


def oracle() -> str:
    return f"""
WITH d AS ({shingles_sql('documents', 'doc_id')}
), b AS ({shingles_sql('benchmark', 'item_id')}
), n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, n_item::INTEGER AS n_item, count(*)::INTEGER AS n_shared
FROM d JOIN b USING (shingle) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 80
"""
