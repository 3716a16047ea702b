"""Document fingerprints after the I-Match idea, over several randomised lexicon subsets.

A term is a word (a run of letters, digits and characters beyond ASCII, in lower case) by its hash bucket. Document
frequencies are counted over all documents; the lexicon keeps the buckets whose inverse document frequency ln(N / df)
lies within ``IDF_BAND``. A text's distinct terms within the lexicon are sorted, and each of ``SUBSETS`` random subsets of
the lexicon, taken at rates from 1 down to 1/1024, gives one hash of the terms that fall in it. The fingerprint is these
hashes, 16 bits each, written in hexadecimal; a subset without terms is written ``....``.

The likeness of two fingerprints is the share of equal hashes among the subsets that are not empty in both. Subsets that
hold about one term of a text behave like samples of the union of both term sets, so the likeness follows their overlap;
the different rates serve texts of different length.

The lexicon is a bitmap of fixed size. It reaches the tasks as a scalar subquery, and terms are looked up in it row by
row without a shuffle. Texts are brought next to each other by their rank in descending order of id: ranks come from a
table of ids and lengths, ordered by ranges, and groups of consecutive ranks share a window.

Defined results: a null text is empty. A text without a term in the lexicon uses all of its terms; without any term its
subsets are all empty. Two such fingerprints are alike (1), one such and another are not (0). Rows that share an id are
ordered by a digest of their text, a null id comes last. Each repeated row but the last is followed by its own copy. The
last row is followed by the first. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import running_offsets, stage, whole

#: Hash buckets of terms; a multiple of 64.
BUCKETS = 1 << 20
#: Least and largest ln(N / df) of a term in the lexicon: about one document in ten to one in five hundred.
IDF_BAND = (2.3, 6.2)
#: One subset is the whole lexicon; of each rate 1/4, 1/16, ... 1/1024 there are this many.
PER_RATE, RATES = 8, (4, 16, 64, 256, 1024)
SUBSETS = 1 + PER_RATE * len(RATES)
#: Consecutive documents in one window.
GROUP = 2_000

_NO_TERM = "[\\x00-/:-@\\[-`{-\\x7F]+"


def terms(text: Column) -> Column:
    """The distinct term buckets of a text."""
    words = F.array_remove(F.split(F.lower(text), _NO_TERM), "")
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS))))


def lexicon(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """One row: ``bits``, an array of 64-bit numbers in which the buckets within the band are set."""
    counts = docs.select(F.explode(terms(whole(F.col(text_col)))).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("df"))
    total = docs.select(F.count("*").alias("n"))
    idf = F.log(total.scalar() / F.col("df"))
    kept = counts.filter(idf.between(*band)).groupBy(F.floor(F.col("bucket") / 64).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bucket % 64 as int))")).alias("bits"))
    every = docs.sparkSession.range(BUCKETS // 64).withColumnRenamed("id", "word").join(kept, "word", "left")
    # as many rows as the bitmap has numbers, whatever the input
    return stage(every.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))),
                                       lambda x: x["bits"]).alias("bits")))


def fingerprint(text: Column, bits: Column) -> Column:
    """The hash of each subset, null where it is empty."""
    def inside(t: Column) -> Column:
        return F.getbit(F.get(bits, F.floor(t / 64).cast("int")), t % 64) == 1

    def hashes(sorted_terms: Column) -> Column:
        def one(k: Column) -> Column:
            rate = F.when(k == 0, F.lit(1)).otherwise(F.get(F.array(*map(F.lit, RATES)), F.floor((k - 1) / PER_RATE).cast("int")))
            # the binding array keeps the subset from being worked out twice
            subset = F.filter(sorted_terms, lambda t: F.pmod(F.xxhash64(t, k), rate) == 0)
            return F.transform(F.array(subset), lambda s: F.when(F.size(s) > 0, F.pmod(F.xxhash64(s), F.lit(65536)).cast("int")))[0]
        return F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), one)

    def chosen(own: Column) -> Column:
        return F.transform(F.array(F.filter(own, inside)), lambda kept: F.sort_array(F.when(F.size(kept) > 0, kept).otherwise(own)))[0]

    return F.transform(F.array(terms(text)), lambda own: F.transform(F.array(chosen(own)), hashes)[0])[0]


def written(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lower(F.lpad(F.hex(h), 4, "0")), F.lit("...."))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that are not empty in both; 1 where all are empty in both."""
    used = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"].isNotNull() | x["b"].isNotNull()))
    same = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: F.coalesce(x["a"] == x["b"], F.lit(False))))
    return F.when(used == 0, F.lit(1.0)).otherwise(same / used)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """Per row: doc_id, n_chars, fingerprint."""
    bits = lexicon(docs, text_col, band).scalar()
    text = whole(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), bits.alias("bits"))
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), fingerprint(F.col("text"), F.col("bits")).alias("hashes")
                       ).select("doc_id", "n_chars", written(F.col("hashes")).alias("fingerprint"))


def _ranked(slim: DataFrame) -> DataFrame:
    """(key, sha, n_chars) with rank from 0 in descending order of id, and n_before, the length of the row before."""
    order = (F.col("doc_id").desc_nulls_last(), F.col("sha").desc())
    parts = stage(slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).withColumn("all", F.lit(0)))
    before = running_offsets(parts.groupBy("all", "part").agg(F.count("*").alias("n")), ["all"], "part", "n", "before")
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ranked = stage(parts.withColumn("own", own).join(before.select("part", "before"), "part")
                   .withColumn("rank", F.col("own") - 1 + F.col("before")).drop("part", "own", "before", "all", "doc_id"))
    total = ranked.count()
    shifted = ranked.select(F.pmod(F.col("rank") + 1, F.lit(max(total, 1))).alias("rank"), F.col("n_chars").alias("n_before"))
    return stage(ranked.join(shifted, "rank").withColumn("total", F.lit(total)))


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", band: tuple[float, float] = IDF_BAND,
                    group: int = GROUP) -> DataFrame:
    """Each row with its edited text, whose last half is replaced by the head of the next document in descending order of id.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    bits = lexicon(docs, text_col, band).scalar()
    base = docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text")).withColumns({
        "key": F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "sha": F.unhex(F.sha2("text", 256)),
        "n_chars": F.length("text").cast("long")})
    places = _ranked(base.select("key", "doc_id", "sha", "n_chars").distinct())
    half = F.floor(F.col("n_chars") / 2).cast("int")
    # what is left of the text, or what the row before takes from it
    head = F.left(F.col("text"), F.greatest(F.col("n_chars") - half, F.floor(F.col("n_before") / 2)).cast("int"))
    placed = base.drop("n_chars").withColumn("bits", bits).withColumn("hashes", fingerprint(F.col("text"), F.col("bits"))).drop("bits").join(places, ["key", "sha"]).select(
        "doc_id", "rank", "total", "n_chars", "hashes", head.alias("head"))
    # the first row of a group is also the last of the group before it; the first of all follows the last;
    # repeated rows share a rank, so that all but the last of them are followed by a copy
    at = F.floor(F.col("rank") / group)
    again = F.when(F.col("rank") == 0, F.struct(F.floor((F.col("total") - 1) / group).alias("group"), F.col("total").alias("place"))).when(
        F.col("rank") % group == 0, F.struct((at - 1).alias("group"), F.col("rank").alias("place")))
    spread = placed.withColumn("to", F.explode(F.array_compact(F.array(F.struct(at.alias("group"), F.col("rank").alias("place")), again))))
    window = Window.partitionBy("to.group").orderBy("to.place")
    paired = spread.withColumns({"next_head": F.lead("head").over(window), "next_hashes": F.lead("hashes").over(window)}).filter((F.col("to.place") == F.col("rank")) & (F.col("to.group") == at))
    edited = F.concat(F.left(F.col("head"), (F.col("n_chars") - half).cast("int")), F.left(F.col("next_head"), half))
    out = paired.select("doc_id", "n_chars", "hashes", "next_hashes", edited.alias("edited"), bits.alias("bits"))
    out = out.withColumn("edited_hashes", fingerprint(F.col("edited"), F.col("bits")))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written(F.col("hashes")).alias("fingerprint"),
                      written(F.col("edited_hashes")).alias("edited_fingerprint"),
                      likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
                      likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
