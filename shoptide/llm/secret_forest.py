"""Secret scan: candidates by shape, false positives removed by a random forest.

A candidate is every maximal run of at least ``MIN_CHARS`` letters, digits and ``+/_-``, with its ``=``
padding, wherever it is in a word and whatever follows it. What the forest sees of it: its length; its shares of digits, capitals and hexadecimal
letters, how often it changes between kinds of characters, and how usual its two-letter transitions
are in the corpus's own words; the share of it that is made of dictionary words (words that the corpus
holds ``MIN_WORD_COUNT`` times or more); whether it looks like a path, and where it was found; the
word before it, whether that assigns, and how many candidates follow that word in the corpus.

The forest is trained on labelled findings: a frame of value, before and label can be given; without
one, findings that rules are sure of are the labels (values of issued formats and values assigned to a
name of a secret, against numbers and words of usual shape). It is fitted on at most ``MAX_PER_LABEL`` findings of
either label, those of smallest hash; all counts cover all documents, and every candidate is scored.

Defined cases: null, empty and blank texts hold no candidate. A candidate that is there many times is
a finding each time. Rows that share a doc_id are scanned each. Without findings of both labels every
score is 0. Runs of one word share its place. Columns other than doc_id, text and source play no part; source may be missing.
All of it is built-in functions and Spark's own random forest.
"""

from __future__ import annotations

from itertools import chain

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import BLANK, cut
from shoptide.session import reloaded

MIN_CHARS = 12
MIN_WORD_COUNT = 20
MAX_PER_LABEL = 4000
TREES, DEPTH, SEED = 30, 6, 7
BLANKS = " \t\n\x0b\x0c\r"
CHAR = "[A-Za-z0-9+/_-]"
#: A run and its padding; the ``=`` of ``name=value`` and ``name="value"`` pads nothing.
VALUE = f"""{CHAR}{{{MIN_CHARS},}}(?:={{1,2}}(?!["']?{CHAR}|=))?"""
#: The name that assigns what comes next, and the first name of a word.
ASSIGNS = r"""([^=:"'&?,;{}\[\]()]+)["']?[=:]+["'({\[]*$"""
FIRST_NAME = r"""^["']?([^=:"']+)["']?[=:]"""
#: Formats that issuers document, and names that secrets are assigned to.
ISSUED = r"^(AKIA|ASIA)[A-Z0-9]{16}$"
NAMED = r"(?i)(passw(or)?d|passwd|pwd|token|secret|api_?key|credential)"
#: Words as prose and code write them, joined words among them.
WORDY = r"^[+/_-]*[A-Za-z]?[a-z]+([+/_-]+[A-Za-z]?[a-z]*)*$"
FEATURES = (
    "n_chars", "digits", "capitals", "hex_letters", "changes", "usual", "dictionary",
    "slashes", "place_hash", "assigned", "log_after",
)


def with_words(docs: DataFrame) -> DataFrame:
    """The frame with ``words`` of its text, as they are."""
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANKS))
    words = F.split("trimmed", f"{BLANK}+", -1)
    return docs.withColumn("trimmed", trimmed).withColumn("words", words).drop("trimmed")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, source, place (of the word), value, before (the name or word before it), assigned."""
    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    rows = with_words(docs.select("doc_id", source.alias("source"), "text")).drop("text")
    at = lambda i: F.get("words", i)
    long = lambda i: at(i).rlike(f"{CHAR}{{{MIN_CHARS}}}")
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0))), long)
    rows = rows.withColumn("places", places)
    hit = F.transform(
        "places",
        lambda i: F.struct(
            i.alias("place"), at(i).alias("word"), F.when(i > 0, at(i - 1)).alias("one"),
            F.when(i > 1, at(i - 2)).alias("two"),
        ),
    )
    # Outer: the filter that Spark derives from a plain explode would compute all of it twice.
    hits = rows.select("doc_id", "source", F.explode_outer(hit).alias("hit"))
    hits = hits.where("hit is not null").select("doc_id", "source", "hit.*")
    # The text before run i of a word is gap i.
    hits = hits.withColumns(
        {"runs": F.regexp_extract_all("word", F.lit(VALUE), F.lit(0)), "gaps": F.split("word", VALUE, -1)}
    )
    run = F.transform(
        "runs",
        lambda value, i: F.struct(
            value.alias("value"), F.get("gaps", i).alias("gap"),
            F.when(i > 0, F.get("runs", i - 1)).alias("last"),
        ),
    )
    found = hits.select("doc_id", "source", "place", "one", "two", F.explode_outer(run).alias("run"))
    found = found.where("run is not null").select("doc_id", "source", "place", "one", "two", "run.*")
    near = F.regexp_extract("gap", ASSIGNS, 1)
    first = F.regexp_extract("gap", FIRST_NAME, 1)
    inside = F.when(near != "", near).when(F.col("last").isNull(), first).otherwise("")
    later = F.col("last").isNotNull()
    joined = later & F.col("gap").rlike("""^["']*[=:]+["'({\\[]*$""")
    apart = ~later & F.coalesce(F.col("one").isin("=", ":", ":=", "=>"), F.lit(False))
    ends = ~later & F.coalesce(F.col("one").rlike("[=:]$"), F.lit(False))
    name = (
        F.when(inside != "", inside).when(later, F.col("last")).when(apart, F.col("two"))
        .when(ends, F.regexp_replace("one", "[=:]+$", "")).otherwise(F.col("one"))
    )
    return found.select(
        "doc_id", "source", "place", "value",
        F.lower(F.coalesce(name, F.lit(""))).alias("before"),
        ((inside != "") | joined | apart | ends).alias("assigned"),
    )


def dictionary(docs: DataFrame) -> DataFrame:
    """Words of plain letters that the corpus holds often: part, n. Counted per map task first."""
    words = with_words(docs.select("text")).select(F.explode_outer("words").alias("word"))
    part = F.lower(F.rtrim(F.col("word"), F.lit(".,;:!?")))
    plain = words.select(part.alias("part")).where(F.col("part").rlike("^[a-z]{3,30}$"))
    return plain.groupBy("part").agg(F.count("*").alias("n")).where(f"n >= {MIN_WORD_COUNT}")


def pairs_of(text: Column) -> Column:
    last = F.greatest(F.length(text) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(text, i, F.lit(2)))


def transitions(known: DataFrame) -> dict[str, float]:
    """Two-letter transitions of the dictionary, as logarithms of their share; 676 at most."""
    pairs = known.select(F.explode(pairs_of(F.col("part"))).alias("pair"), "n")
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where(F.length("pair") == 2).collect()
    total = sum(r["n"] for r in counts) or 1
    return {r["pair"]: r["n"] / total for r in counts}


def share(text: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kind}]", "")) / F.length(text)


def described(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The candidates with their features."""
    known = cut(dictionary(docs))
    table = transitions(known)
    value, low = F.col("value"), F.lower("value")
    if table:
        usual = F.create_map(*[F.lit(x) for x in chain(*table.items())])
        sums = F.aggregate(
            pairs_of(low), F.lit(0.0), lambda a, p: a + F.coalesce(F.element_at(usual, p), F.lit(0.0))
        )
        seen = sums / F.greatest(F.length(value) - 1, F.lit(1))
    else:
        seen = F.lit(0.0)
    changes = F.regexp_count(
        value,
        F.lit("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
    )
    values = found.select("value").distinct()
    parts = values.select("value", F.explode(F.regexp_extract_all(low, F.lit("[a-z]{3,}"), F.lit(0))).alias("part"))
    covered = parts.join(known, "part").groupBy("value").agg(F.sum(F.length("part")).alias("covered"))
    values = cut(
        values.join(covered, "value", "left").select(
            "value",
            F.length(value).cast("double").alias("n_chars"),
            share(value, "0-9").alias("digits"),
            share(value, "A-Z").alias("capitals"),
            share(value, "a-f").alias("hex_letters"),
            (changes / F.length(value)).alias("changes"),
            seen.alias("usual"),
            (F.coalesce("covered", F.lit(0)) / F.length(value)).alias("dictionary"),
            F.regexp_count(value, F.lit("/")).cast("double").alias("slashes"),
        )
    )
    after = found.groupBy("before").agg(F.log1p(F.count("*").cast("double")).alias("log_after"))
    return found.join(values, "value").join(after, "before").withColumns(
        {
            "assigned": F.col("assigned").cast("double"),
            "place_hash": F.pmod(F.xxhash64("source"), F.lit(32)).cast("double"),
        }
    )


def sure_findings(found: DataFrame) -> DataFrame:
    """value, before, label where rules are sure: 1 secret, 0 none."""
    secret = F.col("value").rlike(ISSUED) | (
        F.col("assigned") & F.col("before").rlike(NAMED) & F.col("value").rlike("[A-Za-z]")
        & ~F.col("value").rlike(WORDY)
    )
    plain = ~F.col("assigned") & (
        F.col("value").rlike("^[0-9+/_-]+$") | F.col("value").rlike("^[A-Za-z]+[0-9]{1,2}$")
        | F.col("value").rlike(WORDY)
    )
    label = F.when(secret, 1.0).when(plain, 0.0)
    return found.select("value", "before", label.alias("label")).where("label is not null").distinct()


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """Every candidate: doc_id, source, place, value, before, score (that it is a secret)."""
    found = cut(candidates(docs))
    known = sure_findings(found) if findings is None else findings.select("value", "before", "label")
    rows = cut(described(found, docs))
    order = [F.xxhash64("value", "before"), F.col("value"), F.col("before")]
    picked = [
        known.where(F.col("label") == y).orderBy(*order).limit(MAX_PER_LABEL) for y in (0.0, 1.0)
    ]
    # Bounded by MAX_PER_LABEL.
    sample = F.broadcast(picked[0].union(picked[1]))
    train = cut(
        rows.join(sample, ["value", "before"]).dropDuplicates(["value", "before"]).select("label", *FEATURES)
    )
    labels = {r["label"] for r in train.select("label").distinct().collect()}
    if len(labels) < 2:
        return rows.select("doc_id", "source", "place", "value", "before", F.lit(0.0).alias("score"))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    fitted = forest.fit(assemble.transform(train).select("label", "features").coalesce(1))
    model = reloaded(docs.sparkSession, fitted)
    scored = model.transform(assemble.transform(rows))
    return scored.select(
        "doc_id", "source", "place", "value", "before",
        vector_to_array("probability")[1].alias("score"),
    )


def secret_findings(docs: DataFrame) -> DataFrame:
    """doc_id, place, value_sha256, score, is_secret of every candidate of all documents."""
    return scan(docs).select(
        "doc_id", F.col("place").cast("long").alias("place"),
        F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= 0.5).alias("is_secret"),
    )
