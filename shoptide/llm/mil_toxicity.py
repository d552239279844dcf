"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a score, the logistic of the summed weights of its
words, a word's weight being that of itself and of its first three to six letters, hashed; a document is toxic when any sentence is, so its score is the noisy-or
``1 - prod(1 - sentence score)``. Weights are trained by gradient descent on document labels alone,
and the sentence scores then say which sentences offend.

The model is trained on a sample of labelled rows bounded by ``MAX_PER_LABEL`` per label (the ids of
smallest hash), in one task of that bounded size, and only on rows that are not held out: those with
crc32 of the decimal doc_id divisible by 5 are never trained on. Labels, lang, source and doc_id are
never inputs of a score. Scoring reads each whole text where it is: no shuffle.

Defined cases: null and empty texts have no sentence and score 0. Labels that are null, and doc_ids
labelled both ways, do not train. Without a label of either kind every score is 0. A document with
several rows is scored row by row. Other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents per label that train the model, at most.
MAX_PER_LABEL = 2000
#: Hash buckets of features; the model has this many weights whatever the corpus.
BUCKETS = 1 << 18
#: Features of fewer training documents are left out: they cannot be told from chance.
MIN_DOCUMENTS = 3
PREFIXES = (3, 4, 5, 6)
#: A clean document weighs this many times a toxic one, as sentences of clean documents are to stay
#: clean however many a document has.
CLEAN_WEIGHT = 3.0
EPOCHS = 200
STEP = 0.3
#: Pull (the gradient, in shares of a label's documents) below which a weight stays zero.
DECAY = 1e-3
START_BIAS = -8.0
#: Words a worker remembers.
CACHED_WORDS = 1 << 19
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def features(word: str) -> list[int]:
    """Hash buckets of a word in lower case and of its beginnings."""
    names = [word, *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]
    return [xxhash.xxh32_intdigest(name.encode()) % BUCKETS for name in names]


class Features(dict):
    """Word to its features, remembering a bounded number of words."""

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = features(word)
        return value


class BeginningWeights(dict):
    """The first letters of a word to the sum of the weights of its beginnings."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, letters: str) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[letters] = float(self.weights[features(letters)[1:]].sum())
        return value


class WordWeights(dict):
    """Word to the sum of its features' weights, remembering a bounded number of words."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights.tolist()
        self.beginnings = BeginningWeights(weights)

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        own = self.weights[xxhash.xxh32_intdigest(word.encode()) % BUCKETS]
        value = self[word] = own + self.beginnings[word[: PREFIXES[-1]]]
        return value


def sentences(text: str) -> list[tuple[tuple[int, int], list[str]]]:
    """Spans of the sentences that hold a word, and their words in lower case."""
    found = []
    for m in SENTENCE.finditer(text):
        words = WORD.findall(m.group().lower())
        if words:
            found.append((m.span(), words))
    return found


@dataclass
class Model:
    """Weights of feature buckets and the score of a sentence without any."""

    weights: np.ndarray
    bias: float

    def sentence_scores(self, found: list[list[str]], known: WordWeights) -> np.ndarray:
        sums = [sum(map(known.__getitem__, set(words))) for words in found]
        return 1 / (1 + np.exp(-np.clip(self.bias + np.array(sums), -60, 60)))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """Full gradient descent with Adagrad steps on the noisy-or log-likelihood."""
    cache = Features()
    found: list[np.ndarray] = []
    document_of: list[int] = []
    for i, text in enumerate(texts):
        for _, words in sentences(text):
            found.append(np.unique(np.array([f for w in set(words) for f in cache[w]], np.int32)))
            document_of.append(i)
    if not found or toxic.min(initial=1) == toxic.max(initial=0):
        return Model(np.zeros(BUCKETS), -60.0)
    docs = np.array(document_of, np.int32)
    feature = np.concatenate(found)
    row = np.repeat(np.arange(len(found), dtype=np.int32), [len(x) for x in found])
    # Document frequency of each feature: distinct (document, feature).
    pairs = np.unique(docs[row].astype(np.int64) * BUCKETS + feature)
    frequent = np.bincount(pairs % BUCKETS, minlength=BUCKETS) >= MIN_DOCUMENTS
    keep = frequent[feature]
    feature, row = feature[keep], row[keep]
    used, feature = np.unique(feature, return_inverse=True)
    feature = feature.astype(np.int32)
    # A label's weight is shared by its documents, so that a rare label is not outvoted.
    share = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), CLEAN_WEIGHT * 0.5 / max(1, (1 - toxic).sum()))
    weights, bias = np.zeros(len(used)), START_BIAS
    memory, bias_memory = np.full(len(used), 1e-8), 1e-4
    for _ in range(EPOCHS):
        z = bias + np.bincount(row, weights[feature], len(docs))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.bincount(docs, np.log1p(-np.minimum(p, 1 - 1e-12)), len(toxic)))
        some = np.maximum(1 - none, 1e-6)
        # d(log-likelihood)/dz of a sentence: p none / some in a toxic bag, -p in a clean one.
        pull = np.where(toxic == 1, none / some, -1.0) * share
        g = pull[docs] * p
        grad = np.bincount(feature, g[row], len(used))
        memory += grad**2
        weights += STEP * grad / np.sqrt(memory)
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - DECAY * STEP / np.sqrt(memory))
        bias_memory += g.sum() ** 2
        bias += STEP * g.sum() / np.sqrt(bias_memory)
    full = np.zeros(BUCKETS)
    full[used] = weights
    return Model(full, float(bias))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most ``MAX_PER_LABEL`` labelled rows of either label: text, toxic."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    clear = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    clear = clear.where("toxic = most").select("doc_id", "toxic")
    order = [F.xxhash64("doc_id", F.lit(3)), F.col("doc_id")]
    picked = [
        clear.where(F.col("toxic") == t).orderBy(*order).limit(MAX_PER_LABEL) for t in (0, 1)
    ]
    ids = F.broadcast(picked[0].union(picked[1]).withColumnRenamed("doc_id", "_doc"))
    sample = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_doc"))
    # Rows that repeat an id repeat its text or not; the bound holds for rows.
    return sample.select(
        "doc_id", "text", F.col("toxic").cast("int").alias("toxic")
    ).dropDuplicates(["doc_id"])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit in one task on the bounded sample; only the non-zero weights come back."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        model = fit(pdf["text"].fillna("").tolist(), pdf["toxic"].to_numpy())
        at = np.flatnonzero(model.weights)
        return pd.DataFrame(
            {"bucket": [*at.tolist(), -1], "weight": [*model.weights[at].tolist(), model.bias]}
        )

    sample = training_sample(docs, labels).withColumn("task", F.lit(0))
    found = sample.groupBy("task").applyInPandas(run, "bucket long, weight double").toPandas()
    weights, bias = np.zeros(BUCKETS), -60.0
    for bucket, weight in zip(found["bucket"], found["weight"]):
        if bucket < 0:
            bias = float(weight)
        else:
            weights[int(bucket)] = weight
    return Model(weights, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with score (double) and offending: spans and scores of sentences of 0.5 or more."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    kept = [f for f in docs.schema.fields if f.name not in ("score", "offending")]
    span = T.StructType(
        [
            T.StructField("first", T.IntegerType()),
            T.StructField("last", T.IntegerType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    added = [T.StructField("score", T.DoubleType()), T.StructField("offending", T.ArrayType(span))]
    kind = pa.list_(
        pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        known = WordWeights(own.weights)
        for batch in batches:
            scores, places = [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                found = sentences(text or "")
                p = own.sentence_scores([words for _, words in found], known)
                scores.append(noisy_or(p))
                places.append(
                    [
                        {"first": found[i][0][0], "last": found[i][0][1], "score": float(p[i])}
                        for i in np.flatnonzero(p >= 0.5)
                    ]
                )
            yield batch.append_column("score", pa.array(scores, pa.float64())).append_column(
                "offending", pa.array(places, kind)
            )

    return docs.select(*[f.name for f in kept]).mapInArrow(run, T.StructType([*kept, *added]))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, and its offending sentences."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )
