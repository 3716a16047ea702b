"""Secret scans: candidate strings, and a random forest that tells secrets from other strings of that look.

A candidate is every run of ``SHORTEST`` or more letters, digits and ``+/_-`` with a digit. It is described
by its length and make-up; by its character transitions, the mean log-likelihood of its adjacent characters where the
words of all texts give the counts; by its dictionary coverage, the share of its characters in letter runs that are words
of the texts, found more than once; by its path; and by the words before it: a credential word, a sign of assignment, a quote.

The forest is trained from labelled findings. ``labelled`` holds them as (value, before, path, secret); where none are
given, findings are labelled by ``certain``: a value that a credential word is assigned to, or with a provider's prefix, is
a secret, any other is not. Not more than ``PER_LABEL`` findings of either label are fitted. Counts of transitions and
words cover all texts but for the candidates themselves. Everything runs as DataFrame expressions and the forest of the ML library.

Defined results: a null or empty text has no candidates. Where the labels are all of one kind, that kind is the answer.
Copies have findings each. Rows with a null id or path are searched like others. Values are given as digests only. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage, whole

SHORTEST = 16
#: Findings of either label that the forest is fitted on at most; trees and their depth.
PER_LABEL, TREES, DEPTH = 2_000, 20, 6
#: Words of context before a candidate, and characters of its own word.
BEFORE, NEAR = 3, 200
_IN = "A-Za-z0-9+/_\\-"
#: A whole run of a candidate's characters that has a digit.
RUN = f"(?<![{_IN}])(?=[A-Za-z+/_\\-]*+[0-9])[{_IN}]{{{SHORTEST},}}"

# Words that name credentials, and prefixes of provider keys.
CREDENTIAL = "token|secret|password|passwd|pwd|apikey|api_key|key|auth|credential|bearer"
PREFIX = "^(AKIA|ASIA|ghp_|gho_|github_pat_|xox[abp]-|sk_live_|sk-|AIza)"
SAMPLE_PATH = "test|example|sample|mock|fixture|doc"

FEATURES = ["length", "digits", "uppers", "lowers", "variety", "hexadecimal", "prefix", "transitions", "coverage", "path_sample",
            "path_depth", "credential", "assigned", "quoted"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """doc_id, position (of the word), offset (in it), value, before (what stands before it), path."""
    words = F.split(whole(F.col(text_col)), "[\\s]+")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), words.alias("words"))
    long = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("position"), w.alias("word"))),
                    lambda x: (F.length(x["word"]) >= SHORTEST) & x["word"].rlike("[0-9]"))
    at = F.col("x.position")
    start = F.greatest(at - BEFORE, F.lit(0))
    found = rows.withColumn("x", F.explode(long)).select(
        "doc_id", "path", at.alias("position"), F.col("x.word").alias("word"), F.concat_ws(" ", F.slice("words", start + 1, at - start)).alias("left"))
    # what lies between the runs gives their places
    found = found.withColumn("values", F.regexp_extract_all("word", F.lit(RUN), F.lit(0))).filter(F.size("values") > 0).withColumn(
        "gaps", F.split("word", RUN))
    found = found.select("*", F.posexplode("values").alias("k", "value")).withColumn("offset", F.aggregate(
        F.slice("gaps", 1, F.col("k") + 1), F.lit(0), lambda n, x: n + F.length(x)) + F.aggregate(
        F.slice("values", 1, F.col("k")), F.lit(0), lambda n, x: n + F.length(x)))
    near = F.least("offset", F.lit(NEAR))
    before = F.concat_ws(" ", "left", F.substring("word", F.col("offset") - near + 1, near))
    return found.select("doc_id", "position", "offset", "value", before.alias("before"), "path")


def certain(value: Column, before: Column) -> Column:
    """The rule that labels findings where no labels are given."""
    return value.rlike(PREFIX) | F.lower(before).rlike(f"({CREDENTIAL})[^a-z0-9]*[=:][^a-z0-9]*$")


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n: how often the texts have each run of letters outside candidates."""
    def outside(w: Column) -> Column:
        return F.when((F.length(w) >= SHORTEST) & w.rlike("[0-9]"), F.regexp_replace(w, RUN, " ")).otherwise(w)

    text = F.array_join(F.transform(F.split(whole(F.col(text_col)), "[\\s]+"), outside), " ")
    return docs.select(F.explode(F.split(F.lower(text), "[^\\p{L}]+")).alias("word")).filter("length(word) > 1").groupBy("word").agg(
        F.count("*").alias("n"))


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` (with a unique ``finding``) and the columns of ``FEATURES``; ``words`` has each word of the texts and its number."""

    def pairs(text: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: F.substring(text, i, F.lit(2)))

    counts = words.select(F.explode(pairs(F.col("word"))).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    log_p = F.log((F.col("n") + 0.5) / (F.sum("n").over(Window.partitionBy(F.substring("pair", 1, 1))) + 50.0))
    table = stage(counts.select("pair", log_p.alias("log_p")))
    lower = F.lower("value")
    likely = (found.select("finding", F.explode(pairs(lower)).alias("pair")).join(table, "pair", "left").groupBy("finding").agg(
        F.avg(F.coalesce("log_p", F.lit(-6.0))).alias("transitions")))
    runs = found.select("finding", F.explode(F.split(lower, "[^\\p{L}]+")).alias("word")).filter("length(word) > 1")
    dictionary = stage(words.filter("n > 1").select("word").join(runs.select("word").distinct(), "word", "left_semi"))
    covered = runs.join(dictionary, "word").groupBy("finding").agg(F.sum(F.length("word")).alias("covered"))

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace("value", f"[^{pattern}]", "")) / F.length("value")

    context = F.lower("before")
    out = found.join(likely, "finding", "left").join(covered, "finding", "left").withColumns({
        "length": F.length("value").cast("double"), "digits": share("0-9"), "uppers": share("A-Z"), "lowers": share("a-z"),
        "variety": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"),
        "hexadecimal": F.col("value").rlike("^[0-9a-f]+$").cast("double"), "prefix": F.col("value").rlike(PREFIX).cast("double"),
        "coverage": F.coalesce(F.col("covered"), F.lit(0)) / F.length("value"),
        "path_sample": F.lower("path").rlike(SAMPLE_PATH).cast("double"), "path_depth": F.size(F.split("path", "/")).cast("double"),
        "credential": context.rlike(CREDENTIAL).cast("double"), "assigned": context.rlike("[=:][^a-z0-9]*$").cast("double"),
        "quoted": context.rlike("[\"'`]$").cast("double"), "transitions": F.coalesce("transitions", F.lit(-6.0))})
    return out.drop("covered")


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
         per_label: int = PER_LABEL, seed: int = 3) -> DataFrame:
    """One row per candidate: doc_id, position, offset, value_sha256, length, score, secret."""
    found = candidates(docs, id_col, text_col, path_col).withColumn("finding", F.monotonically_increasing_id()).withColumn("known", F.lit(None).cast("boolean"))
    if labelled is not None:
        given = labelled.select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("position"), F.lit(0).alias("offset"), "value", "before",
                                "path", (-1 - F.monotonically_increasing_id()).alias("finding"), F.col("secret").cast("boolean").alias("known"))
        found = found.unionByName(given)
    else:
        found = found.withColumn("known", certain(F.col("value"), F.col("before")))
    rows = stage(described(stage(found), stage(word_counts(docs, text_col))))
    order = Window.partitionBy("known").orderBy(F.xxhash64("value", "before"), "value", "finding")
    sample = (rows.filter("known is not null").select("finding", "known", "value", "before").withColumn("place", F.row_number().over(order))
              .filter(F.col("place") <= per_label).select("finding"))
    fit_rows = stage(rows.join(sample, "finding", "left_semi").select("value", F.col("known").cast("double").alias("label"), *FEATURES)
                     .coalesce(1).sortWithinPartitions("value", *FEATURES))
    kinds = [r["label"] for r in fit_rows.select("label").distinct().collect()]
    own = rows.filter("finding >= 0")
    if len(kinds) < 2:
        scored = own.withColumn("score", F.lit(float(kinds[0]) if kinds else 0.0))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featuresCol="features", labelCol="label").fit(
            vectors.transform(fit_rows))
        scored = forest.transform(vectors.transform(own)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "position", "offset", F.sha2("value", 256).alias("value_sha256"), F.col("length").cast("int").alias("length"),
                         "score", (F.col("score") >= 0.5).alias("secret"))
