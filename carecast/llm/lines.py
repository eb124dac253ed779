"""Line dedup: repeated runs of lines by prefix doubling, later copies deleted.

Lines that hold more than white space are numbered through the corpus in
(doc_id, position) order. The suffixes of the line-ID sequence are bucketed by
their first line, then by their first 2, 4, 8, ... lines: the bucket of 2^(k+1)
lines at i is the pair of the 2^k-buckets at i and i + 2^k (prefix doubling).
Buckets are named by their first place in the corpus, which is all that dedup needs
of the suffix array's order, and those of one suffix are dropped at each round.

A run of lines is deleted if it holds ``min_chars`` characters and occurs
earlier, whatever its length. Every such run is the union of its shortest parts
of ``min_chars`` characters: from each of its lines onwards, and up to each of
its lines, as far as they fit (a line that fits neither is held by the part that starts
with the run). So only these parts, one from each line of the corpus and one up
to each, are looked up. Suffixes share one of n lines if their longest common
prefix is n or more: an interval of the suffix array, here the pair of
2^k-buckets at the part's first line and at its 2^k-th last, 2^k being the
greatest power up to n. All but the interval's first suffix start later copies. The
doubling ends at the longest part, log2(min_chars) rounds at most.

Defined cases: null and empty texts have no lines; blank lines do not interrupt
a run; those between two deleted lines go, others stay; lines are compared exactly; a run that overlaps its
own earlier copy is a copy, so of equal lines in a row the first stays; rows that share a doc_id are
ordered by text hash, repeated rows are later copies of the first; null
doc_ids come last; an empty table gives none; extra columns ride along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fingerprint128, materialize, text_column

MIN_CHARS = 20


def _line_array() -> Column:
    """(pos, line) of the lines that hold more than white space."""
    return F.filter(F.transform(F.split(text_column(), "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line"))),
                    lambda r: r["line"].rlike(r"[^\x20\x09-\x0D]"))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with _row, a number of its own for each row, written so that it stays."""
    return materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "lines-rows")


def numbered_lines(rows: DataFrame) -> DataFrame:
    """row, loc, at and pos (place among these and among all lines), left (lines to the end), before, chars, a, b of every line.

    ``loc`` grows with (doc_id, text hash, row, at), and by 1 from line to line of a
    document; ``before`` counts the characters of its lines above.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = fingerprint128(F.col("r.line"))
    lines = (rows.select(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64(text_column()).alias("tie"),
                         F.col("_row").alias("row"), _line_array().alias("lines"))
             .select("last", "doc_id", "tie", "row", F.size("lines").alias("n"), F.posexplode("lines").alias("at", "r"))
             .select("last", "doc_id", "tie", "row", "at", F.col("r.pos").alias("pos"), (F.col("n") - F.col("at")).alias("left"),
                     F.length("r.line").cast("long").alias("chars"), a.alias("a"), b.alias("b")))
    document = ["last", "doc_id", "tie", "row"]
    above = Window.partitionBy(*document).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = (lines.repartitionByRange(n, *document)
              .withColumn("before", F.coalesce(F.sum("chars").over(above), F.lit(0)))
              .sortWithinPartitions(*document, "at").withColumn("loc", F.monotonically_increasing_id()))
    return materialize(placed.drop("last", "doc_id", "tie"), "lines")


def shortest_parts(lines: DataFrame, min_chars: int) -> DataFrame:
    """loc, size, row, from_at, from_pos, to_pos (included) of the shortest runs of ``min_chars`` characters from and up to each line."""
    onward = Window.partitionBy("row").orderBy("before").rangeBetween(Window.currentRow, min_chars - 1)
    back = Window.partitionBy("row").orderBy("upto").rangeBetween(1 - min_chars, Window.currentRow)
    framed = lines.withColumn("upto", F.col("before") + F.col("chars")).select(
        "row", "loc", "at", "pos", "before", "upto",
        F.count(F.lit(1)).over(onward).alias("n_on"), F.max("pos").over(onward).alias("pos_on"), F.max("upto").over(onward).alias("upto_on"),
        F.count(F.lit(1)).over(back).alias("n_back"), F.min("pos").over(back).alias("pos_back"), F.min("before").over(back).alias("before_back"))
    on = framed.where(F.col("upto_on") - F.col("before") >= min_chars).select(
        "loc", F.col("n_on").alias("size"), "row", F.col("at").alias("from_at"), F.col("pos").alias("from_pos"), F.col("pos_on").alias("to_pos"))
    shift = F.col("n_back") - 1
    # one that is also the shortest from its first line is there already
    up = framed.where((F.col("upto") - F.col("before_back") >= min_chars) & (F.col("n_back") > 1)).select(
        (F.col("loc") - shift).alias("loc"), F.col("n_back").alias("size"), "row", (F.col("at") - shift).alias("from_at"),
        F.col("pos_back").alias("from_pos"), F.col("pos").alias("to_pos"))
    return on.unionByName(up)


def _named(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` in buckets of two or more, with ``name``: the bucket's first loc.

    The buckets are written first: the join then has a plain scan on its right, so that a
    bucket that holds many rows may be split.
    """
    found = rows.groupBy(*by).agg(F.min("loc").alias("name"), F.max("loc").alias("top")).where("name < top").drop("top")
    return rows.join(materialize(found, "lines-buckets"), list(by))


def repeated_parts(lines: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """row, from_at, to_at (excluded), from_pos, to_pos (included) of every shortest part that occurs earlier.

    ``lines``: the table that ``numbered_lines`` gives.
    """
    parts = materialize(shortest_parts(lines, min_chars), "lines-parts")
    longest = parts.agg(F.max("size")).first()[0] or 1
    level = materialize(_named(lines.select("loc", "left", "a", "b"), "a", "b").select("loc", "left", "name"), "lines-level")
    repeated, size = [], 1
    while True:
        # parts of size .. 2 * size - 1 lines
        own = parts.where(F.col("size").between(size, 2 * size - 1)).join(level.select("loc", F.col("name").alias("head")), "loc")
        if size > 1:
            tails = level.select(F.col("loc").alias("at_tail"), F.col("name").alias("tail"))
            own = own.withColumn("at_tail", F.col("loc") + F.col("size") - size).join(tails, "at_tail").drop("at_tail")
            own = _named(materialize(own, "lines-own"), "size", "head", "tail").withColumn("head", F.col("name"))
        repeated.append(own.where("head < loc").select("row", "from_at", (F.col("from_at") + F.col("size")).alias("to_at"), "from_pos", "to_pos"))
        if 2 * size > longest:
            return reduce(DataFrame.unionByName, repeated)
        ahead = level.select((F.col("loc") - size).alias("loc"), F.col("name").alias("next"))
        pairs = materialize(level.where(F.col("left") >= 2 * size).join(ahead, "loc")
                            .select("loc", "left", F.col("name").alias("head"), "next"), "lines-pairs")
        level = materialize(_named(pairs, "head", "next").select("loc", "left", "name"), "lines-level")
        size *= 2


def deletions(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """row, lost: disjoint ranges (from_pos, to_pos, n lines that aren't blank) to delete, of the rows that have some."""
    by = Window.partitionBy("row").orderBy("from_at", "to_at")
    reach = F.max("to_at").over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = (repeated_parts(numbered_lines(rows), min_chars).distinct().withColumn("reach", reach)
            .withColumn("new", F.coalesce(F.col("from_at") > F.col("reach"), F.lit(True)).cast("int"))
            .withColumn("range", F.sum("new").over(by)).groupBy("row", "range")
            .agg(F.min("from_at").alias("from_at"), F.max("to_at").alias("to_at"),
                 F.min("from_pos").alias("from_pos"), F.max("to_pos").alias("to_pos")))
    return runs.groupBy("row").agg(F.collect_list(F.struct(  # disjoint places of one document
        "from_pos", "to_pos", (F.col("to_at") - F.col("from_at")).cast("long").alias("n"))).alias("lost"))


def with_lost_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with _lost: the ranges (from_pos, to_pos, n lines that aren't blank) to delete from the text's lines."""
    rows = numbered(docs)
    lost = materialize(deletions(rows, min_chars), "lines-lost").select(F.col("row").alias("_row"), F.col("lost").alias("_lost"))
    # a merge join at every size: broadcast while few rows lose lines, it would change its ways as the corpus grows
    return rows.join(lost.hint("merge"), "_row", "left").select(*[f"`{c}`" for c in docs.columns], "_lost")


def _remaining() -> Column:
    """The text without the lines in the lost ranges."""
    return F.array_join(F.filter(F.split(text_column(), "\n"), lambda x, i: ~F.exists(
        "_lost", lambda r: (i >= r["from_pos"]) & (i <= r["to_pos"]))), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the later copies of repeated line runs.

    A document that loses all its lines goes; n_chars, if there, follows the
    new text; documents that lose nothing are returned as they are.
    """
    found = with_lost_lines(docs, min_chars)
    text = F.when(F.col("_lost").isNull(), F.col("text")).otherwise(_remaining())
    out = found.withColumn("text", text)
    left = F.col("_lost").isNull() | F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_lost").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"])))
    return out.where(left).select(*[f"`{c}`" for c in docs.columns])


def line_digest(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines (that hold more than white space), n_deleted, kept_sha256 of every row of ``docs``."""
    found = with_lost_lines(docs.select("doc_id", "text"), min_chars)
    kept = F.when(F.col("_lost").isNull(), text_column()).otherwise(_remaining())
    return found.select("doc_id", F.size(_line_array()).cast("long").alias("n_lines"), F.coalesce(F.aggregate("_lost", F.lit(0).cast("long"), lambda t, r: t + r["n"]), F.lit(0)).cast("long").alias("n_deleted"),
                        F.sha2(kept, 256).alias("kept_sha256"))
