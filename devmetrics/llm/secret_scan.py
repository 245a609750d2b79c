"""Secret scan with a random forest that removes false positives.

A candidate is a run of at least ``MIN_LENGTH`` key-like characters, with up to
two ``=`` behind it; shorter keys, and keys cut into shorter pieces by other
characters, are none. What it
looks like, how usual its character transitions are, how much of it dictionary
words cover, its path and the words around it are the features of a random
forest, trained from labelled findings; candidates it takes for false positives
are marked so.

Where nobody has labelled findings, ``cue_labels`` does so for the clear ones:
what is assigned to a cue word is a secret, a plain word or a number is none, and
all others have no label. What then tells secrets (the words before and the
quotes) is no feature, so the forest must learn what a secret looks like, and
judges those without any cue by it.

Dictionary and transitions are counted over all texts: a dictionary word is one
that at least ``DICTIONARY_DOCS`` texts have. The forest is fitted on at most
``TRAINING_ROWS`` findings, picked by a hash; every candidate is judged. All of
it is DataFrame work on the JVM, the forest included.

Defined cases: null and empty texts have no candidates. A null path or a missing
neighbour is the word ``<none>``. Equal candidates in one text are separate
rows, told apart by position (word) and run (within the word). With labels of one kind only, that is the verdict
for all; without labels every candidate counts as a secret. An empty table
gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.staging import Workspace
from devmetrics.llm.text import words

MIN_LENGTH = 16
DICTIONARY_DOCS = 5
TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 20, 6, 11
HASHED = 128

KEY_LIKE = r"[A-Za-z0-9+/_\-]"
# Each match starts where the last one ended, so a long word is walked through once.
RUN = rf"(?s)\G(.*?)({KEY_LIKE}{{{MIN_LENGTH},}}={{0,2}})"
_CUE = r"[\w\-]*(?:token|secret|password|passwd|api_?key|key|credential)"
CUES = rf"(?i)^\W*{_CUE}\W*$"
# A cue word that a value is assigned to, at the end of what stands before the value.
ASSIGNED = rf"(?i){_CUE}[\"'`]?[:=]+[\"'`]?$"
KEY_BLOCK = r"(?i)KEY-----$"
PLAIN = r"^([A-Z]?[a-z]+|[A-Z]+|[0-9]+)$"


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """doc_id, position, run, candidate, path and what stands around it; one row per candidate.

    ``before`` is what stands before it in its own word, behind the run before.
    """
    df = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(path).cast("string").alias("path"), words(F.col(text)).alias("w")
    )
    pattern = F.lit(RUN)
    found = F.filter(
        F.transform("w", lambda x, i: F.struct(F.regexp_extract_all(x, pattern, 2).alias("cs"), i.alias("i"))),
        lambda x: F.size(x["cs"]) > 0,
    )
    long = F.exists("w", lambda x: F.length(x) >= MIN_LENGTH)
    df = df.select("doc_id", "path", "w", F.explode(F.when(long, found)).alias("x"))
    df = df.select("doc_id", "path", "w", "x", F.posexplode("x.cs").alias("run", "c"))
    i = F.col("x.i")

    def near(at: Column) -> Column:
        return F.coalesce(F.lower(F.get("w", at)), F.lit("<none>"))

    return df.select(
        "doc_id",
        i.alias("position"),
        "run",
        F.col("c").alias("candidate"),
        F.coalesce("path", F.lit("<none>")).alias("path"),
        near(i - 1).alias("left"),
        near(i - 2).alias("left2"),
        near(i + 1).alias("right"),
        F.get("w", i).rlike("[\"'`]").alias("quoted"),
        F.get(F.regexp_extract_all(F.get("w", i), pattern, 1), F.col("run")).alias("before"),
    )


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, docs): in how many texts each run of at least three letters is a word."""
    bare = F.transform(words(F.col(text)), lambda w: F.regexp_replace(F.lower(w), r"^[^\p{L}]+|[^\p{L}]+$", ""))
    each = docs.select(F.explode(F.array_distinct(bare)).alias("word"))
    return each.filter(r"length(word) > 2 AND word RLIKE '^\\p{L}+$'").groupBy("word").agg(F.count(F.lit(1)).alias("docs"))


def _classes(text: Column) -> Column:
    """Letters, one class of digits, one of the rest, between marks for begin and end."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), "[^a-z0]", "#")
    return F.concat(F.lit("^"), plain, F.lit("$"))


def _pairs(text: Column) -> Column:
    marked = _classes(text)
    return F.transform(F.sequence(F.lit(1), F.length(marked) - 1), lambda i: F.substr(marked, i, F.lit(2)))


def transitions(counts: DataFrame) -> DataFrame:
    """(pair, surprise): how rare a character is after another; at most 30 * 30 rows."""
    pairs = counts.select("docs", F.explode(_pairs(F.col("word"))).alias("pair"))
    pairs = pairs.groupBy("pair").agg(F.sum("docs").alias("n"))
    first = pairs.groupBy(F.substring("pair", 1, 1).alias("a")).agg(F.sum("n").alias("total"))
    met = pairs.join(first, F.substring("pair", 1, 1) == F.col("a"))
    return met.select("pair", (-F.log2((F.col("n") + 1) / (F.col("total") + 30))).alias("surprise"))


def features(found: DataFrame, counts: DataFrame, pair_table: DataFrame) -> DataFrame:
    """Adds the numeric features to candidates, via their distinct strings."""
    each = found.select("candidate").distinct()
    unseen = 12.0
    pairs = each.select("candidate", F.explode(_pairs(F.col("candidate"))).alias("pair")).join(pair_table, "pair", "left")
    rarity = pairs.groupBy("candidate").agg(
        F.avg(F.coalesce("surprise", F.lit(unseen))).alias("surprise"),
        F.max(F.coalesce("surprise", F.lit(unseen))).alias("worst"),
    )
    parts = F.regexp_extract_all("candidate", F.lit(r"([A-Z]?[a-z]+|[A-Z]+)"), 1)
    runs = each.select("candidate", F.explode(parts).alias("part")).withColumn("word", F.lower("part"))
    known = counts.filter(F.col("docs") >= DICTIONARY_DOCS).select("word")
    covered = runs.join(known, "word").groupBy("candidate").agg(F.sum(F.length("part")).alias("covered"))
    table = rarity.join(covered, "candidate", "left")

    def share(pattern: str) -> Column:
        return 1 - F.length(F.regexp_replace("candidate", pattern, "")) / F.length("candidate")

    switches = F.size(F.regexp_extract_all("candidate", F.lit("([A-Za-z][0-9]|[0-9][A-Za-z])"), 1))
    table = table.select(
        "candidate", "surprise", "worst",
        (F.coalesce("covered", F.lit(0)) / F.length("candidate")).alias("coverage"),
        F.length("candidate").cast("double").alias("length"),
        share("[0-9]").alias("digits"), share("[A-Z]").alias("capitals"), share("[^A-Za-z0-9]").alias("signs"),
        (switches / F.length("candidate")).alias("switches"),
    )
    return found.join(table, "candidate")


NUMERIC = ["surprise", "worst", "coverage", "length", "digits", "capitals", "signs", "switches"]
TEXTUAL = ["path", "left", "left2", "right", "quoted"]
# Without what ``cue_labels`` tells secrets by.
UNCUED = ["path", "right"]


def cue_labels(found: DataFrame) -> DataFrame:
    """Adds ``label``: 1.0 for what a cue word is given, 0.0 for plain words and numbers, else NULL.

    The value stands behind the cue and a sign of assignment (``key=...``,
    ``key: ...``, ``"key":"..."``, in one word or several), quoted behind the
    cue, or on the first line of a key block.
    """
    apart = F.col("left").rlike(r"^\W+$")
    cue = F.col("left").rlike(CUES) | (apart & F.col("left2").rlike(CUES))
    sign = F.when(apart, F.col("left")).otherwise(F.regexp_extract("left", r"(\W*)$", 1)).rlike("[:=]")
    given = (cue & (F.col("quoted") | sign)) | F.col("before").rlike(ASSIGNED) | F.col("left").rlike(KEY_BLOCK)
    return found.withColumn("label", F.when(given, 1.0).when(F.col("candidate").rlike(PLAIN), 0.0))


def trained(findings: DataFrame, textual: list[str] = TEXTUAL):
    """The model, or the one label there is, or None without labels; in: features and ``label``.

    Findings without a label are left out.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import FeatureHasher, VectorAssembler

    order = F.xxhash64("candidate", "path", "left", "right", "position", "run", "doc_id")
    # Half of the sample for each label, so that rare secrets are learned too.
    picked = None
    for label in (0.0, 1.0):
        part = findings.filter(F.col("label") == label).orderBy(order).limit(TRAINING_ROWS // 2)
        picked = part if picked is None else picked.unionByName(part)
    work = Workspace(findings.sparkSession)
    rows = work.write(picked, "findings")
    labels = sorted(r[0] for r in rows.select("label").distinct().limit(2).collect())
    if len(labels) < 2:
        return labels[0] if labels else None
    stages = [
        FeatureHasher(inputCols=textual, outputCol="near", numFeatures=HASHED, categoricalCols=textual),
        VectorAssembler(inputCols=[*NUMERIC, "near"], outputCol="features"),
        RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features"),
    ]
    return Pipeline(stages=stages).fit(rows.coalesce(1))


def judged(found: DataFrame, model) -> DataFrame:
    """Adds ``probability`` and ``is_secret`` to candidates with features."""
    if model is None or isinstance(model, float):
        return found.withColumn("probability", F.lit(1.0 if model is None else model)).withColumn(
            "is_secret", F.col("probability") >= 0.5
        )
    from pyspark.ml.functions import vector_to_array

    out = model.transform(found)
    out = out.withColumn("probability", F.get(vector_to_array("probability"), F.lit(1)))
    return out.withColumn("is_secret", F.col("probability") >= 0.5)


def scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str = "source",
) -> DataFrame:
    """doc_id, position (word), run (in the word), candidate, probability, is_secret of every candidate.

    ``findings`` are labelled candidates: the columns of ``candidates`` and
    ``label`` (1.0 for a secret). Without them ``cue_labels`` labels those of ``docs``.
    """
    work = Workspace(docs.sparkSession)
    found = work.write(candidates(docs, doc_id, text, path), "candidates")
    counts = work.write(word_counts(docs, text), "words")
    pair_table = work.write(transitions(counts), "pairs")
    seen = work.write(features(found, counts, pair_table), "features")
    if findings is None:
        model = trained(cue_labels(seen), UNCUED)
    else:
        model = trained(features(findings, counts, pair_table))
    work.drop("words", "candidates")
    return judged(seen, model).select("doc_id", "position", "run", "candidate", "probability", "is_secret")
