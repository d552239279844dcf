"""How filters of a corpus overlap: what each removes, in every order they can be applied in.

Five filters judge every document by itself (short, repetitive, shouting, symbols, copy). The documents
of a part are counted into a 2x2x2x2x2 contingency tensor, one axis per filter, pass or fail, with one
such tensor each for all documents, for those of good quality and for toxic ones. Whatever an order of
filters does then follows from the tensor alone: a step is a contraction that takes *pass* on the axes
of the filters before it, *fail* (or *pass*) on its own and *all* on the rest. No text is read twice,
whatever the number of orders.

Defined results:

- A null text counts as empty, a null ``lang`` as the part ``''``. An empty text fails A only; it is a
  copy of other empty texts.
- Filter E fails a row if the same text stands under a smaller doc_id anywhere in the table. Rows equal
  in doc_id and text are no copies of each other. A null doc_id is neither smaller nor larger than
  another, so it fails no E and makes none fail.
- Every row counts, repeated ones as often as they come. A document is good (toxic) if any of its rows
  in ``labels`` says so; documents without a label are neither.
- Columns beyond doc_id, text and lang are not read. An empty table has no parts, hence no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptide.llm.common import text_bytes

FILTERS = "ABCDE"
#: The bounds of the filters.
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Parts whose tensors are contracted at once.
PARTS_AT_ONCE = 256

JUDGED = "doc_id BIGINT, part STRING, key1 BIGINT, key2 BIGINT, bits INT"
AUDIT = (
    "part STRING, filter_order STRING, step INT, kept BIGINT, removed BIGINT, redundant BIGINT, "
    "unique_fails BIGINT, good_lost BIGINT, toxic_lost BIGINT, shapley BIGINT"
)


def failures(text: bytes) -> int:
    """Which of A to D a text fails: one bit each, A the highest of four."""
    words = text.split()
    letters = len(text) - len(text.translate(None, CAPITALS))
    # Bytes 10xxxxxx continue a character, all others begin one.
    points = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    short = len(words) < LEAST_WORDS
    repetitive = 100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)
    shouting = 100 * letters > MOST_CAPITALS_PERCENT * points
    symbols = any(c in text for c in SYMBOLS)
    return short << 3 | repetitive << 2 | shouting << 1 | symbols


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch.column(2))
        keys = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), np.int64).reshape(-1, 2)
        bits = np.fromiter(map(failures, texts), np.int32, len(texts))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                *(pa.array(np.ascontiguousarray(keys[:, i])) for i in (0, 1)),
                pa.array(bits),
            ],
            names=["doc_id", "part", "key1", "key2", "bits"],
        )


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, a 128-bit key of the text and the bits of the filters A to D it fails."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), "text"
    )
    return rows.mapInArrow(_judge, JUDGED)


def contingency(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per part and cell of the tensor: part, cell (0 to 31, A the highest bit, set where
    the filter fails), n, good, toxic.

    Rows are counted per text before texts are looked at as a whole, so a text with any number of
    copies is one row per part and label when its smallest doc_id is found.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    text = ["key1", "key2", "bits"]
    rows = judged(docs).groupBy("doc_id", "part", *text).agg(F.count(F.lit(1)).alias("n"))
    marked = rows.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    copies = marked.groupBy(*text, "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        first.alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
    )
    # One row per part and label of a text here, however many copies it has.
    least = F.min("first.doc_id").over(Window.partitionBy("key1", "key2"))
    own = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = copies.withColumn("least", least).select(
        "part", "bits", "good", "toxic", "n", (own + F.col("no_id")).alias("originals")
    )
    cells = F.array(
        F.struct((F.col("bits") * 2).alias("cell"), F.col("originals").alias("n")),
        F.struct((F.col("bits") * 2 + 1).alias("cell"), (F.col("n") - F.col("originals")).alias("n")),
    )
    counted = split.select("part", "good", "toxic", F.inline(cells)).where("n > 0")
    return counted.groupBy("part", "cell").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


def steps() -> tuple[list[tuple[str, int]], np.ndarray, np.ndarray]:
    """All orders with their steps, the filter of each step, and which filters ran before it."""
    named, own, before = [], [], []
    for order in itertools.permutations(range(len(FILTERS))):
        for step, axis in enumerate(order):
            named.append(("".join(FILTERS[i] for i in order), step + 1))
            own.append(axis)
            before.append([i in order[:step] for i in range(len(FILTERS))])
    return named, np.array(own), np.array(before)


def contract(tensors: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Sums over tensors [part, measure, A, B, C, D, E]: ``chosen`` [step, filter, 2] weighs pass and
    fail of each axis. Result [step, part, measure]."""
    axes = [chosen[:, i] for i in range(len(FILTERS))]
    return np.einsum("pmabcde,sa,sb,sc,sd,se->spm", tensors, *axes, optimize=True)


def audit_tensors(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """Every measure of every step, [step, part]; the measures of a tensor are n, good, toxic."""
    named, own, before = steps()
    passes, fails, both = (np.array(x, np.int64) for x in ([1, 0], [0, 1], [1, 1]))
    at = np.arange(len(named))
    earlier = np.where(before[:, :, None], passes, both)
    kept, removed, alone = earlier.copy(), earlier.copy(), np.tile(passes, (len(named), 5, 1))
    failing = np.tile(both, (len(named), 5, 1))
    kept[at, own], removed[at, own], alone[at, own], failing[at, own] = passes, fails, fails, fails
    gone = contract(tensors, removed)
    shapley = np.zeros((len(FILTERS), tensors.shape[0]), np.int64)
    np.add.at(shapley, own, gone[:, :, 0])
    return {
        "kept": contract(tensors[:, :1], kept)[:, :, 0],
        "removed": gone[:, :, 0],
        "redundant": contract(tensors[:, :1], failing)[:, :, 0] - gone[:, :, 0],
        "unique_fails": contract(tensors[:, :1], alone)[:, :, 0],
        "good_lost": gone[:, :, 1],
        "toxic_lost": gone[:, :, 2],
        "shapley": shapley[own],
    }


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    named = steps()[0]
    orders, numbers = zip(*named)
    for whole in batches:
        for start in range(0, whole.num_rows, PARTS_AT_ONCE):
            batch = whole.slice(start, PARTS_AT_ONCE)
            parts = batch.column(0).to_pylist()
            tensors = np.zeros((len(parts), 3, 2 ** len(FILTERS)), np.int64)
            for i, cells in enumerate(batch.column(1).to_pylist()):
                for c in cells:
                    tensors[i, :, c["cell"]] = c["n"], c["good"], c["toxic"]
            found = audit_tensors(tensors.reshape(len(parts), 3, *[2] * len(FILTERS)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(parts, object), len(named)), pa.string()),
                    pa.array(orders * len(parts), pa.string()),
                    pa.array(numbers * len(parts), pa.int32()),
                    *(pa.array(values.T.ravel(), pa.int64()) for values in found.values()),
                ],
                names=["part", "filter_order", "step", *found],
            )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: documents kept, removed, failing but removed
    before (redundant), failing this filter alone, good and toxic ones removed, and what the step's
    filter removes summed over all orders (shapley; divided by their number it is the filter's share)."""
    cells = contingency(docs, labels)
    # At most 32 cells a part.
    whole = cells.groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))
    return whole.mapInArrow(_audit, AUDIT)


def oracle(documents: str = "documents", labels: str = "labels") -> str:
    """Each order applied step by step to the counted cells, in DuckDB SQL."""
    letters = "(VALUES " + ", ".join(f"('{c}', {16 >> i})" for i, c in enumerate(FILTERS)) + ")"
    names = "abcde"
    orders = " CROSS JOIN ".join(f"{letters} AS {t}(f, w)" for t in names)
    distinct = " AND ".join(
        f"{names[i]}.f <> {names[j]}.f" for i in range(5) for j in range(i + 1, 5)
    )
    every = " UNION ALL ".join(
        f"SELECT filter_order, {i + 1} AS step, w{i} AS own, "
        f"{' + '.join(['0', *(f'w{j}' for j in range(i))])} AS earlier FROM orders"
        for i in range(5)
    )
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM {documents}
), words AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    length(text) AS points,
    length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS capitals
  FROM texts
), firsts AS (
  SELECT text, min(doc_id) AS least FROM texts GROUP BY text
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM {labels} GROUP BY doc_id
), cells AS (
  SELECT part,
    CASE WHEN len(w) < {LEAST_WORDS} THEN 16 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < {LEAST_DISTINCT_PERCENT} * len(w) THEN 8 ELSE 0 END
    + CASE WHEN 100 * capitals > {MOST_CAPITALS_PERCENT} * points THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(words.text, '[#$%&*|]') THEN 2 ELSE 0 END
    + CASE WHEN words.doc_id > least THEN 1 ELSE 0 END AS bits,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM words JOIN firsts ON words.text = firsts.text LEFT JOIN marks ON words.doc_id = marks.doc_id
  GROUP BY 1, 2
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order,
    a.w AS w0, b.w AS w1, c.w AS w2, d.w AS w3, e.w AS w4
  FROM {orders} WHERE {distinct}
), steps AS ({every}
), counted AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN bits & (earlier + own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bits & earlier <> 0 AND bits & own <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bits = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells CROSS JOIN steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
