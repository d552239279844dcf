"""Line dedup over levelled sorted runs of line hashes.

A run is a table of line keys with what is known of each: in how many documents it was found and the
largest doc_id among them, sorted by hash. Documents come in batches, the largest doc_ids first. A
batch's keys are merge-joined with the runs: keys that no run holds are new lines, the others raise
what is known; both form the batch's own run on level 0. When a level holds ``FAN_OUT`` runs they are
compacted into one run of the next level, so a key sits in few runs and is rewritten few times.

A line's key is the line with blanks ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased;
two 64-bit hashes stand for it. Keys of ``MIN_CHARS`` code points or more that ``MIN_DOCUMENTS``
documents hold lose their lines everywhere but in the largest doc_id that holds them.

Defined cases: a null or empty text is one empty line. A line repeated within a document counts once
and goes or stays whole. Rows of one doc_id are one document, however often they come; a row without a
doc_id is none: it makes no key common, and loses the lines of common keys. Columns other than doc_id and text are passed through.

Keys are combined per document and per map task before any shuffle, so a line that half of the corpus
holds costs a row per task. Only hashes and ids are shuffled; texts are shuffled once, by document.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.common import cut, text_bytes

MIN_CHARS = 20
MIN_DOCUMENTS = 3
#: Runs of a level that are compacted into one of the next.
FAN_OUT = 3
#: Batches a whole table is fed in.
BATCHES = 4
#: A key as two 64-bit numbers.
HASHES = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])
LINES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_hash", T.LongType()),
        T.StructField("line", T.IntegerType()),
        *HASHES.fields,
    ]
)


def long_lines(data: bytes) -> list[tuple[int, bytes]]:
    """Positions and key digests of the lines that are long enough. ``bytes.strip`` and
    ``bytes.lower`` know just the blanks and the capitals that a key leaves out."""
    found = []
    for i, line in enumerate(data.split(b"\n")):
        key = line.strip().lower()
        if len(key) >= MIN_CHARS and (
            len(key) >= 4 * MIN_CHARS or len(key.decode()) >= MIN_CHARS
        ):
            found.append((i, xxhash.xxh3_128_digest(key)))
    return found


def _hash_lines(distinct: bool):
    def run(batches_):
        for batch in batches_:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            own = batch.column(batch.schema.get_field_index("text_hash")).to_numpy()
            texts = text_bytes(batch.column(batch.schema.get_field_index("text")))
            row, line, digests = [], [], []
            for i, data in enumerate(texts):
                found = long_lines(data)
                if distinct:
                    found = [(0, d) for d in {d for _, d in found}]
                row += [i] * len(found)
                line += [at for at, _ in found]
                digests += [d for _, d in found]
            if not row:
                continue
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(row, pa.int32())),
                    pa.array(own[row]),
                    pa.array(line, pa.int32()),
                    pa.array(np.ascontiguousarray(h[:, 0])),
                    pa.array(np.ascontiguousarray(h[:, 1])),
                ],
                names=LINES.names,
            )

    return run


def _plain(docs: DataFrame) -> DataFrame:
    own = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", own)


def line_hashes(docs: DataFrame) -> DataFrame:
    """One row per long line: doc_id, text_hash, line (its position), h1, h2."""
    return _plain(docs).mapInArrow(_hash_lines(False), LINES)


def batch_keys(docs: DataFrame) -> DataFrame:
    """What a batch knows of its keys: h1, h2, n_docs, max_doc. Documents are counted, not rows: a row
    that comes twice holds a key once. Batches have no doc_id in common, so their counts add up."""
    keys = _plain(docs).mapInArrow(_hash_lines(True), LINES)
    return keys.groupBy("h1", "h2").agg(
        F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("max_doc")
    )


@dataclass
class LineRuns:
    """The runs by level; ``add`` takes a batch, ``known`` merges all runs."""

    spark: SparkSession
    levels: list[list[DataFrame]] = field(default_factory=list)

    def add(self, docs: DataFrame) -> DataFrame:
        """Take a batch. Returns its run: h1, h2, n_docs, max_doc and whether the key is new."""
        run = batch_keys(docs)
        held = self.known()
        if held is None:
            run = run.withColumn("is_new", F.lit(True))
        else:
            # The merge join tells apart what an anti join would keep and what it would drop.
            seen = held.select("h1", "h2", F.lit(False).alias("unseen"))
            run = run.join(seen, ["h1", "h2"], "left").select(
                "h1", "h2", "n_docs", "max_doc", F.col("unseen").isNull().alias("is_new")
            )
        run = cut(run.sortWithinPartitions("h1", "h2"))
        self._push(run, 0)
        return run

    def _push(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == FAN_OUT:
            merged = cut(self._merged(self.levels[level]).sortWithinPartitions("h1", "h2"))
            self.levels[level] = []
            self._push(merged, level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0].select("h1", "h2", "n_docs", "max_doc")
        for run in runs[1:]:
            rows = rows.union(run.select("h1", "h2", "n_docs", "max_doc"))
        if len(runs) == 1:
            return rows
        return rows.groupBy("h1", "h2").agg(
            F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc")
        )

    def known(self) -> DataFrame | None:
        """All keys with what is known of them, or None before the first batch."""
        runs = [run for level in self.levels for run in level]
        return self._merged(runs) if runs else None


def batches(docs: DataFrame, count: int = BATCHES) -> list[DataFrame]:
    """The documents in ranges of doc_id, largest first; the range reaches the scan's row groups."""
    cuts = docs.select(
        F.percentile_approx("doc_id", [i / count for i in range(1, count)], 1000).alias("cuts")
    ).first()["cuts"]
    cuts = sorted(set(cuts or []), reverse=True)
    edges = [None, *cuts, None]
    found = []
    for high, low in zip(edges, edges[1:]):
        part = docs if high is None else docs.where(F.col("doc_id") < high)
        if low is not None:
            part = part.where(F.col("doc_id") >= low)
        elif high is not None:
            part = docs.where((F.col("doc_id") < high) | F.col("doc_id").isNull())
        found.append(part)
    return found


def dropped_lines(docs: DataFrame, count: int = BATCHES) -> DataFrame:
    """Lines to drop, per document: doc_id, text_hash, drop (their positions)."""
    runs = LineRuns(docs.sparkSession)
    for batch in batches(docs.select("doc_id", "text"), count):
        runs.add(batch)
    common = cut(runs.known().where(F.col("n_docs") >= MIN_DOCUMENTS).drop("n_docs"))
    lines = line_hashes(docs).join(common, ["h1", "h2"])
    lines = lines.where(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
    return lines.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("drop"))


def _drop(schema: T.StructType, text: str, drops: str):
    def run(batches_):
        for batch in batches_:
            at = batch.schema.get_field_index(text)
            kept, lines, gone = [], [], []
            rows = zip(
                batch.column(at).to_pylist(),
                batch.column(batch.schema.get_field_index(drops)).to_pylist(),
            )
            for value, drop in rows:
                count = (value or "").count("\n") + 1
                drop = set(drop or ())
                if drop:  # an untouched text stays as it is, null included
                    value = "\n".join(x for i, x in enumerate(value.split("\n")) if i not in drop)
                kept.append(value)
                lines.append(count)
                gone.append(len(drop))
            columns = {
                text: pa.array(kept, pa.string()),
                "n_lines": pa.array(lines, pa.int64()),
                "n_dropped": pa.array(gone, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(
                [
                    columns[n] if n in columns else batch.column(batch.schema.get_field_index(n))
                    for n in schema.names
                ],
                names=schema.names,
            )

    return run


def dedup_lines(docs: DataFrame, count: int = BATCHES) -> DataFrame:
    """The documents without their dropped lines, plus n_lines (before) and n_dropped."""
    docs = docs.drop("n_lines", "n_dropped")
    drops = dropped_lines(docs, count).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("drop").alias("_drop")
    )
    keyed = docs.withColumn("_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_hash"))
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
        ]
    )
    joined = keyed.join(drops, same, "left").drop("_doc", "_hash", "_text")
    return joined.mapInArrow(_drop(schema, "text", "_drop"), schema)


def line_dedup_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    kept = dedup_lines(docs.select("doc_id", "text"))
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", sha.alias("kept_sha256"))


LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS line, unnest(l) AS value
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM {documents})
), keyed AS (
  SELECT doc_id, line, value,
    translate(trim(value, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS max_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.line, k.value, c.key IS NOT NULL AND k.doc_id <> c.max_doc AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key
)
"""


def oracle(documents: str = "documents") -> str:
    return LINE_SQL.replace("{documents}", documents) + r"""
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(value, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
