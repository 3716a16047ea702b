"""Exact duplicates by deterministic block naming.

Each text is cut into blocks of ``block`` code points. Equal blocks get one integer name, given by sorting the distinct
blocks; then adjacent names are paired and the distinct pairs named, level by level, until one name is left for each
document. Documents are equal exactly when they end on the same level with the same name.

Only the dictionary moves block contents through a shuffle, each distinct one once per task. Rows carry a digest as the
label of a block. The dictionary holds the contents behind each label and stops the job should a label ever stand for
two different blocks, so that no name rests on an unchecked hash.

Defined results: a null text counts as empty and equals other empty texts. Of equal texts the row with the largest id
stays, a null id being smaller than any other; of repeated rows with that id, one stays. An empty table gives no rows.
Input columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import may_have, stage, whole

#: Code points in a block.
BLOCK = 4096


def digest(block: Column) -> Column:
    return F.unhex(F.sha2(block, 256))


def cut_blocks(text: Column, block: int) -> Column:
    """The text as consecutive pieces of ``block`` code points, the last may be shorter; an empty text is one empty piece."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0)))


def name_blocks(blocks: DataFrame, label: Callable[[Column], Column]) -> DataFrame:
    """(label, name) of the distinct contents of column ``block``, named in sorted order within each partition."""
    contents = blocks.select(label(F.col("block")).alias("label"), "block").groupBy("label").agg(
        F.collect_set("block").alias("contents"))
    checked = F.when(F.size("contents") > 1, F.raise_error(F.lit("two blocks share a label"))).otherwise(F.col("contents")[0])
    return (contents.select("label", checked.cast("string").alias("block")).sortWithinPartitions("block")
            .select("label", F.monotonically_increasing_id().alias("name"), F.length("block").alias("block_chars")))


def name_pairs(pairs: DataFrame) -> DataFrame:
    """(head, tail, name) of the distinct pairs of names, in sorted order within each partition."""
    return (pairs.select("head", "tail").distinct().sortWithinPartitions("head", "tail")
            .select("head", "tail", F.monotonically_increasing_id().alias("name")))


def document_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                   label: Callable[[Column], Column] = digest) -> DataFrame:
    """One row per input row: row (a number for this call), doc_id, text_sha256, level, name."""
    text = whole(F.col(text_col))
    cut = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", cut_blocks(F.col("text"), block).alias("blocks"))
    rows = stage(cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
                            F.transform("blocks", label).alias("labels")))
    names = stage(name_blocks(cut.select(F.explode("blocks").alias("block")), label)).drop("block_chars")
    pieces = rows.select("row", F.posexplode("labels").alias("pos", "label")).join(names, "label").select("row", "pos", "name")
    longest = rows.agg(F.max(F.size("labels"))).first()[0] or 0
    done, level = None, 0
    while True:
        if longest > 1:
            pieces = stage(pieces.withColumn("pieces", F.count("*").over(Window.partitionBy("row")))
                           if level == 0 else pieces)
        else:
            pieces = pieces.withColumn("pieces", F.lit(1))
        ended = pieces.filter("pieces = 1").select("row", F.lit(level).alias("level"), "name")
        done = ended if done is None else done.unionByName(ended)
        if longest <= 1:
            break
        pairs = pieces.filter("pieces > 1").groupBy("row", F.expr("pos div 2").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("head"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("tail"),
            F.expr("(max(pieces) + 1) div 2").alias("pieces"))
        pieces = stage(pairs.join(name_pairs(pairs), ["head", "tail"]).select("row", "pos", "name", "pieces"))
        longest, level = (longest + 1) // 2, level + 1
    return rows.drop("labels").join(stage(done), "row")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                     label: Callable[[Column], Column] = digest) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    named = stage(document_names(docs, id_col, text_col, block, label))
    groups = stage(named.groupBy("level", "name").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("last")).filter("group_size > 1"))
    return named.join(groups, ["level", "name"], "left").select(
        "doc_id", F.when(F.col("last").isNull(), F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("last.row"), F.lit(True)).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without copies: of equal texts, one row with the largest id stays, with all its columns."""
    found = exact_duplicates(docs, id_col, text_col)
    marks = found.groupBy("doc_id", "text_sha256").agg(
        F.count("*").alias("twins"), F.max("kept").alias("stays")).filter("twins > 1 or not stays")
    marks = stage(marks.select(F.col("doc_id").alias("_mark_id"), F.col("text_sha256").alias("_mark_sha"),
                               F.col("stays").alias("_mark_stays"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_mark_key")))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.sha2(whole(F.col(text_col)), 256).alias("_sha"))
    clear, rest = may_have(rows, F.coalesce(F.col("_id").cast("string"), F.lit("")), marks, "_mark_key")
    marked = rest.join(marks, F.col("_id").eqNullSafe(F.col("_mark_id")) & (F.col("_sha") == F.col("_mark_sha")), "left")
    plain = marked.filter(F.col("_mark_sha").isNull())
    repeated = marked.filter("_mark_stays").dropDuplicates(["_id", "_sha"])
    return clear.select("_row.*").unionByName(plain.unionByName(repeated).select("_row.*"))
