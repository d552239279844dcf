"""Substring dedup over a sparse de Bruijn graph of the corpus.

Runs of ``SPAN`` words that start at more than one place are removed, at every place. Texts with the
same words are folded into one content first. The edges of the graph are token k-mers, and of each
window of ``SPAN`` words only its least edge (by hash, leftmost first) is kept: two equal windows keep
the same edge at the same offset, so a window can only repeat where its edge does. Edges are counted,
and joined back to where they came from; contents without a repeated edge are done. Along the others
all windows on repeated edges are counted by a 96-bit hash of their words, again joined back to their
source coordinates, and consecutive repeated windows are compacted into long spans, which are cut out.

So the paths that branch or end are told apart exactly where they do, word by word, and not by the
graph alone: copies differ in few words here, and a graph of nonbranching paths alone would leave
two thirds of the candidate windows to that check (README). A group of equal windows of any size is
only ever counted, in the map tasks first; what returns to a content is bounded by its length.

Words are runs outside ``[\\x20\\x09-\\x0D]`` and compared as they are. Defined cases: null, empty and
blank texts have no words and keep nothing; texts of fewer than ``SPAN`` words keep all. Every row is a
text of its own, also when rows share a doc_id; null ids are ids like any other. Windows are judged
on the input. Columns other than doc_id and text play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.common import (
    WordHashes,
    cut,
    maybe_among,
    text_bytes,
    window_hashes,
    word_runs,
)

SPAN = 35
#: Words of an edge.
EDGE = 10
NOTHING = hashlib.sha256(b"").digest()

EDGES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_key", T.LongType()),
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
        T.StructField("n_words", T.IntegerType()),
        T.StructField("all_sha", T.BinaryType()),
        T.StructField("edges", T.ArrayType(T.LongType())),
        T.StructField("places", T.ArrayType(T.IntegerType())),
    ]
)
WINDOWS = T.StructType(
    [
        T.StructField("w1", T.LongType()),
        T.StructField("w2", T.IntegerType()),
        T.StructField("cid", T.LongType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("copies", T.IntegerType()),
    ]
)
CUT_OUT = T.StructType(
    [
        T.StructField("cid", T.LongType()),
        T.StructField("n_removed", T.IntegerType()),
        T.StructField("kept", T.StringType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


def least_edges(hashes: np.ndarray, starts: np.ndarray, span: int, edge: int):
    """Of texts in a row: the windows' places, the place of each window's least edge, and the hashes
    of all edges. The place breaks ties and is part of the compared number, so a running minimum over
    powers of two finds it."""
    if len(hashes) < span:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64)
    edges = window_hashes(hashes, edge, 3)
    bits = np.uint64(max(1, int(len(edges)).bit_length()))
    least = (edges >> bits << bits) | np.arange(len(edges), dtype=np.uint64)
    size, width = span - edge + 1, 1
    while width * 2 <= size:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < size:
        least = np.minimum(least[: len(least) - (size - width)], least[size - width :])
    ends = np.repeat(starts[1:], np.diff(starts))
    places = np.arange(len(least))
    inside = places + span <= ends[: len(least)]
    mask = (np.uint64(1) << bits) - np.uint64(1)
    return places[inside], (least[inside] & mask).astype(np.int64), edges


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for batch in batches:
        texts = text_bytes(batch.column(2))
        for first, split, hashes, starts in word_runs(texts, cache):
            _, least, edges = least_edges(hashes, starts, SPAN, EDGE)
            kept = np.unique(least)
            per = np.searchsorted(kept, starts).astype(np.int32)
            joined = [b" ".join(w) for w in split]
            digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, joined)), "<i8").reshape(-1, 2)
            counts = np.diff(starts)
            of = np.repeat(starts[:-1], np.diff(per))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(split)),
                    batch.column(1).slice(first, len(split)),
                    pa.array(np.ascontiguousarray(digest[:, 0])),
                    pa.array(np.ascontiguousarray(digest[:, 1])),
                    pa.array(counts.astype(np.int32)),
                    pa.array([hashlib.sha256(x).digest() for x in joined], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(per), pa.array(edges[kept].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(per), pa.array((kept - of).astype(np.int32))),
                ],
                names=EDGES.names,
            )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows whose least edge is among the repeated edges of their content."""
    cache = WordHashes()
    for batch in batches:
        cids, copies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        marks = batch.column(3)
        for first, split, hashes, starts in word_runs(text_bytes(batch.column(2)), cache):
            places, least, _ = least_edges(hashes, starts, SPAN, EDGE)
            marked = np.zeros(len(hashes) + 1, bool)
            for i in range(len(split)):
                marked[marks[first + i].values.to_numpy() + starts[i]] = True
            places = places[marked[least]]
            if not len(places):
                continue
            text = np.searchsorted(starts, places, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(window_hashes(hashes, SPAN)[places].view(np.int64)),
                    pa.array(
                        (window_hashes(hashes, SPAN, 9)[places] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    ),
                    pa.array(cids[first + text]),
                    pa.array((places - starts[text]).astype(np.int32)),
                    pa.array(copies[first + text].astype(np.int32)),
                ],
                names=WINDOWS.names,
            )


def spans_of(places: np.ndarray) -> list[list[int]]:
    """Word ranges that windows at these places cover, adjoining ones as one."""
    places = np.unique(places)
    if not len(places):
        return []
    breaks = np.flatnonzero(np.diff(places) > SPAN)
    firsts = places[np.r_[0, breaks + 1]]
    lasts = places[np.r_[breaks, len(places) - 1]] + SPAN
    return np.stack([firsts, lasts], 1).tolist()


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, kept, found = [], [], []
        for data, places in zip(text_bytes(batch.column(1)), batch.column(2)):
            words, spans = data.split(), spans_of(places.values.to_numpy())
            rest, at = [], 0
            for first, last in spans:
                rest += words[at:first]
                at = last
            rest += words[at:]
            removed.append(len(words) - len(rest))
            kept.append(b" ".join(rest).decode())
            found.append(spans)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(removed, pa.int32()),
                pa.array(kept, pa.string()),
                pa.array(found, pa.list_(pa.list_(pa.int32()))),
            ],
            names=CUT_OUT.names,
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans (word ranges, only where a part goes), kept (the
    words left, only where a part goes) and kept_sha256."""
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key, "text")
    rows = keyed.mapInArrow(_edges, EDGES).withColumn("rid", F.monotonically_increasing_id())
    rows = cut(rows)

    # One content per sequence of words, that of its first row.
    contents = rows.where(f"n_words >= {SPAN}").groupBy("d1", "d2").agg(
        F.count("*").cast("int").alias("copies"), F.min("rid").alias("cid")
    )
    contents = cut(contents)

    # Repeated edges, counted per map task first, and back at their places in one row per content.
    def placed(some: DataFrame) -> DataFrame:
        each = some.select("rid", F.explode(F.arrays_zip("edges", "places")).alias("e"))
        return each.select("rid", F.col("e.edges").alias("edge"), F.col("e.places").alias("place"))

    often = placed(rows).groupBy("edge").agg(F.count("*").alias("n")).where("n >= 2").select("edge")
    first = maybe_among(
        rows.withColumn("_rid", F.xxhash64("rid")), "_rid", contents.select(F.xxhash64("cid"))
    )
    marks = placed(first).join(often, "edge").groupBy("rid").agg(F.collect_list("place").alias("marks"))
    sources = contents.select("copies", "cid").join(
        rows.select(F.col("rid").alias("cid"), F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")),
        "cid",
    )
    marked = cut(marks.withColumnRenamed("rid", "cid").join(sources, "cid"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))
    # Rows that agree in id and text stand for one source; they only occur where copies > 1.
    passing = maybe_among(keyed, "text_key", marked.select("_key"))
    texts = passing.join(marked, same).select("cid", "copies", "text", "marks")
    texts = cut(texts)

    # Windows on repeated edges, counted, and back at their places.
    windows = texts.mapInArrow(_windows, WINDOWS)
    repeated = windows.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).where("n >= 2")
    hits = windows.where("copies = 1").join(repeated.select("w1", "w2"), ["w1", "w2"])
    places = hits.groupBy("cid").agg(F.collect_list("place").alias("hit"))
    parts = texts.where("copies = 1").select("cid", "text").join(places, "cid")
    parts = cut(parts.mapInArrow(_cut_out, CUT_OUT))

    judged = rows.drop("edges", "places", "rid").join(
        contents.select("d1", "d2", "cid", "copies"), ["d1", "d2"], "left"
    ).join(parts, "cid", "left")
    whole = F.coalesce(F.col("copies") > 1, F.lit(False))
    sha = (
        F.when(whole, F.lit(NOTHING))
        .when(F.col("kept").isNotNull(), F.unhex(F.sha2("kept", 256)))
        .otherwise(F.col("all_sha"))
    )
    removed = F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    return judged.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        removed.cast("long").alias("n_removed"),
        "spans", "kept",
        F.lower(F.hex(sha)).alias("kept_sha256"),
    )


def span_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def oracle() -> str:
    return rf"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents
), runs AS (
  SELECT doc_id, i, hash(array_to_string(w[i:i + {SPAN - 1}], ' ')) AS h1,
    md5_number_lower(array_to_string(w[i:i + {SPAN - 1}], ' ')) AS h2
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {SPAN - 1})) AS i FROM w
    WHERE len(w) >= {SPAN})
), often AS (SELECT h1, h2 FROM runs GROUP BY ALL HAVING count(*) > 1
), hits AS (SELECT doc_id, i FROM runs JOIN often USING (h1, h2)
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + {SPAN - 1})) AS i FROM hits
), words AS (
  SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM w
), left_over AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS kept, count(*) AS n
  FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id
)
SELECT w.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over ON w.doc_id = left_over.doc_id
"""
