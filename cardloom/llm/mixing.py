"""Mixing sources to target weights by Pareto order sampling.

Targets are set per source in words. A document of a source that is to be taken r times in the mean gets floor(r) whole
copies for certain; what is left, r - floor(r), is its inclusion probability p in a sample without replacement. Each
document draws a u between 0 and 1 and is ranked by its odds u / (1 - u) over the inclusion odds p / (1 - p); the sample
is the head of that order, its size fixed in words: it ends before the first document that would exceed what the target
leaves, and then the one document outside whose size fits the remaining gap best is added if that brings it nearer.

Nothing is ordered whole: the ranks of a source fall into slots, the slots' word sums tell the slot that holds the cut,
and only the documents of that slot are put in order. Sources may be of any size; a hot one has more slots.

Defined results: a null text has no words; a document without words follows the same draws and takes 0 words. A null
source is a source of its own, last in order. Documents with a null id draw like any other, from the text "null". Rows
of a source that share id and size draw alike and go in or stay out together. Without any words all targets are 0. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import running_offsets, stage, word_count

#: Weights of the sources in code point order, repeated from the start for further ones.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a share of all words.
SHARE = 1.5
#: Copies of a document that the mix takes at most.
MOST_COPIES = 2
#: Documents that one slot of a source's order should hold.
SLOT = 20_000


def draw(key: Column, seed: int) -> Column:
    """A number between 0 and 1, the same on every run and engine: 52 bits of a digest, moved off both ends."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(2 ** 52)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """From (source, size, rows), per source: source_size, documents, target. A source's share stops at ``most`` times its size.

    The excess goes to the others by weight until none is above, which has a closed form: sources in order of
    size over weight fill up one after the other until the rest can share what is left by weight. The windows hold
    one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.sum("rows").alias("documents"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1
    weighted = totals.withColumn("weight", F.element_at(cycle, place.cast("int")))
    filling = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    cap = F.col("source_size") * float(most)
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * float(most)
    level = (F.lit(share) * F.sum("source_size").over(everything) - full) / F.sum("weight").over(onward)
    leveled = (weighted.withColumn("place", F.row_number().over(filling)).withColumn("level", level)
               .withColumn("open", F.when(F.col("level") * F.col("weight") <= cap, F.struct("place", "level")))
               .withColumn("level", F.min("open").over(everything)["level"]))
    return leveled.select("source", "source_size", "documents",
                          F.coalesce(F.least(F.col("level") * F.col("weight"), cap), cap).alias("target"))


def with_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = 10,
                slot: int = SLOT) -> DataFrame:
    """The rows of ``docs`` as a struct _row, with _size, _source_size, _target and _copies, the number of times each is taken."""
    def ranked(df: DataFrame) -> DataFrame:
        """With the per-source columns joined: the document's place in its source's order, null where p is 0."""
        u, p = draw(F.col("_key"), seed), F.col("_share")
        odds = F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))
        return df.withColumn("_place", F.when(p > 0, F.struct(odds.alias("rank"), F.col("_key"), F.col("_size"))))

    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    source = F.col(source_col).cast("string")
    units = stage(docs.select(key.alias("_key"), source.alias("source"), word_count(F.col(text_col)).alias("_size"))
                  .groupBy("source", "_key", "_size").agg(F.count("*").alias("rows")))
    targets = source_targets(units.select("source", (F.col("_size") * F.col("rows")).alias("size"), "rows"), weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = stage(targets.withColumn("ratio", ratio).withColumn("_certain", F.floor("ratio").cast("long"))
                    .select(F.col("source").alias("_source"), F.col("source_size").alias("_source_size"),
                            F.col("target").alias("_target"), "_certain", (F.col("ratio") - F.col("_certain")).alias("_share"),
                            (F.col("target") - F.col("_certain") * F.col("source_size")).alias("quota"),
                            F.ceil((F.col("documents") + 1) / F.lit(slot)).alias("slots")))

    def joined(df: DataFrame, column: Column, table: DataFrame) -> DataFrame:
        return df.join(table, column.eqNullSafe(F.col("_source")), "left")

    # a rank has no upper bound; rank / (1 + rank) keeps its order between 0 and 1
    drawn = ranked(joined(units, F.col("source"), sources)).filter(F.col("_place").isNotNull())
    even = F.col("_place.rank") / (1 + F.col("_place.rank"))
    drawn = drawn.select("_source", "_place", "quota", (F.col("_size") * F.col("rows")).alias("words"),
                         F.floor(even * F.col("slots")).alias("slot"))
    sums = running_offsets(drawn.groupBy("_source", "slot").agg(F.sum("words").alias("words"), F.first("quota").alias("quota")),
                           ["_source"], "slot", "words", "before")
    # the slot that holds the cut is the last one that begins below the quota
    slots = stage(sums.filter(F.col("before") < F.col("quota")).groupBy("_source").agg(F.max(F.struct("slot", "before")).alias("at"))
                  .select(F.col("_source").alias("source"), F.col("at.slot").alias("cut_slot"), F.col("at.before").alias("before")))
    inside = joined(slots, F.col("source"), drawn).filter(F.col("slot") == F.col("cut_slot"))
    order = Window.partitionBy("source").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum("words").over(order) + F.col("before")
    last = (inside.withColumn("upto", upto)
            .filter(F.col("upto") <= F.col("quota"))
            .groupBy(F.col("source").alias("last_source")).agg(F.max(F.struct("_place", "upto")).alias("last")))
    cuts = stage(slots.join(last, F.col("source").eqNullSafe(F.col("last_source")), "left").select(
        "source", F.col("last._place").alias("_last"), "cut_slot", F.coalesce("last.upto", "before").alias("reached")))
    # where not even the first document of that slot goes in, the cut lies before the slot
    beyond = joined(cuts, F.col("source"), drawn).filter(
        F.when(F.col("_last").isNull(), F.col("slot") >= F.col("cut_slot")).otherwise(F.col("_place") > F.col("_last")))
    gap = F.col("quota") - F.col("reached")
    closing = (beyond.filter(F.abs(gap - F.col("words")) < F.abs(gap)).groupBy("source")
               .agg(F.min(F.struct(F.abs(gap - F.col("words")).alias("left"), "_place")).alias("closing")))
    rules = stage(sources.join(cuts.withColumnRenamed("source", "_cut_source"),
                               F.col("_source").eqNullSafe(F.col("_cut_source")), "left")
                  .drop("_cut_source").join(closing, F.col("_source").eqNullSafe(F.col("source")), "left")
                  .withColumn("_first_out", F.when(F.col("_last").isNull(), F.col("cut_slot"))).withColumn("_slots", F.col("slots"))
                  .select("_source", "_source_size", "_target", "_certain", "_share", "_last", "_first_out", "_slots",
                          F.col("closing._place").alias("_closing")))
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"), source.alias("source"),
                       word_count(F.col(text_col)).alias("_size"))
    out = ranked(joined(rows, F.col("source"), rules))
    even = F.col("_place.rank") / (1 + F.col("_place.rank"))
    taken = F.coalesce(F.col("_place") <= F.col("_last"), F.floor(even * F.col("_slots")) < F.col("_first_out"), F.lit(False)) | F.coalesce(
        F.col("_place") == F.col("_closing"), F.lit(False))
    return out.select("_row", "_size", "_source_size", "_target", (F.col("_certain") + taken.cast("long")).alias("_copies"))


def mixture(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, copies, taken."""
    slim = docs.select(*dict.fromkeys([id_col, options.get("text_col", "text"), options.get("source_col", "source")]))
    return with_copies(slim, id_col, **options).select(
        F.col("_row").getField(id_col).alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    chosen = with_copies(docs, **options).filter("_copies > 0")
    return chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")
