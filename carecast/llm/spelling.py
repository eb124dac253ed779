"""Spelling variants: words one edit apart, grouped under their most frequent form.

Near words are found by asymmetric q-chunks. The shorter word of a pair (either,
if they are of one length) gives two disjoint chunks, its halves; the other one
gives its positional grams of those lengths. One edit leaves a chunk whole, and
it then stands in the other word at most one place from its own: the first half
at the start, the second at the end. Grams at other places can't hold a chunk of
a word that is no more than one code point shorter and are left out. Chunks and
grams are joined by place and letters, and pairs verified by edit distance.

A chunk that many words share would give all pairs of its group. Such chunks
grow: the edit must lie in the rest of the word, so the rest is halved, and one
of its halves is added to the chunk, again and again while the group is large,
until all but one code point must agree. Every word keeps all its pairs.

``form``: the near word with the largest count (ties: smallest), if it is at
least ``ratio`` times as frequent; ``root``: the end of the chain of forms,
found by pointer doubling.

Defined cases: null text and texts without words add nothing; a null doc_id
reads as an empty string where the words are altered; repeated rows count each;
an empty table gives none; only doc_id and text are read. A text's words are
one array within a task, so a task's memory grows with the longest text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_column

LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
ALTERED = 97  # one occurrence in so many loses a code point
GROUP_PAIRS = 10_000  # candidate pairs of a chunk beyond which it grows
WORD = "[A-Za-zÀ-ÿ]+"


def altered(run: Column, doc_id: Column, one_in: int = ALTERED) -> Column:
    """``run``, or, where ``one_in`` divides the checksum of its document and letters, ``run`` without one code point."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int = ALTERED) -> DataFrame:
    """word, n of the words long and frequent enough."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(text_column(), F.lit(WORD), F.lit(0))).alias("run"))
    lower = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    words = runs.select("doc_id", lower.alias("run")).select(altered(F.col("run"), F.col("doc_id"), one_in).alias("word"))
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


def _kept(word: Column, size: Column, length: Column, start: Column, stop: Column) -> Column:
    """A hash of what a word shares with a word of ``length`` whose code points ``start`` .. ``stop`` hold the edit."""
    tail = length - stop
    return F.xxhash64(length, start, stop, F.substring(word, F.lit(1), start), F.substring(word, size - tail + 1, tail))


def _keyed(entries: DataFrame) -> DataFrame:
    return entries.withColumn("key", _kept(F.col("word"), F.length("word"), F.col("length"), F.col("start"), F.col("stop")))


def _halves(length: Column) -> Column:
    """Where the edit may be: behind the first half, or before the second."""
    half = F.floor(length / 2).cast("int")
    return F.array(F.struct(half.alias("start"), length.alias("stop")), F.struct(F.lit(0).alias("start"), half.alias("stop")))


def _entries(words: DataFrame, least_length: int, chunks: bool) -> DataFrame:
    """word, n, length (of the word that gives chunks), start, stop of each chunk, or of each gram that can equal one."""
    size = F.length("word")
    lengths = F.array(size) if chunks else F.filter(F.array(size, size - 1), lambda x: x >= least_length)
    return (words.select("word", "n", F.explode(lengths).alias("length"))
            .select("word", "n", "length", F.explode(_halves(F.col("length"))).alias("rest"))
            .select("word", "n", "length", "rest.start", "rest.stop"))


def near_pairs(words: DataFrame, least_length: int = LEAST_LENGTH, group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """word, n, near, near_n: pairs of ``words`` that are one edit apart, each once."""
    sides = [_keyed(_entries(words, least_length, chunks)) for chunks in (True, False)]
    found = None
    while True:
        sides = [materialize(s, f"spelling-{name}") for s, name in zip(sides, ("chunks", "grams"), strict=True)]
        counts = [s.groupBy("key").agg(F.count(F.lit(1)).alias(n), F.max(F.col("stop") - F.col("start")).alias(f"{n}_rest"))
                  for s, n in zip(sides, ("chunks", "grams"), strict=True)]
        large = materialize(counts[0].join(counts[1], "key").where(
            (F.col("chunks") * F.col("grams") > group_pairs) & (F.col("chunks_rest") > 1)).select("key"), "spelling-large")
        chunk, gram = (s.join(large, "key", "left_anti") for s in sides)
        pairs = (chunk.select("key", "word", "n").join(gram.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")), "key")
                 .where((F.length("word") < F.length("near")) | (F.col("word") < F.col("near")))
                 .where(F.levenshtein("word", "near", 1) == 1).drop("key"))
        pairs = materialize(pairs, "spelling-pairs")
        found = pairs if found is None else found.unionAll(pairs)
        if large.isEmpty():
            return found.dropDuplicates(["word", "near"])
        middle = F.floor((F.col("start") + F.col("stop")) / 2).cast("int")
        parts = F.array(F.struct(F.col("start"), middle.alias("stop")), F.struct(middle.alias("start"), F.col("stop")))
        sides = [_keyed(s.join(large, "key", "left_semi").select("word", "n", "length", F.explode(parts).alias("rest"))
                        .select("word", "n", "length", "rest.start", "rest.stop")) for s in sides]


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n_near, form, form_n of the words that have near ones."""
    both = pairs.select("word", "n", "near", "near_n").unionAll(pairs.select(F.col("near"), F.col("near_n"), F.col("word"), F.col("n")))
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    follows = -F.col("best.less") >= ratio * F.col("n")
    return best.select("word", "n_near", F.when(follows, F.col("best.near")).alias("form"), F.when(follows, -F.col("best.less")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """word, root of the words that have a form; counts at least double along a chain, so it ends and is short."""
    jump = materialize(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = jump.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jump = materialize(jump.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if jump.where("moved").isEmpty():
            return jump.select("word", "root")
        jump = jump.select("word", "root")


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO,
                      one_in: int = ALTERED) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = materialize(word_counts(docs, least_length, least_count, one_in), "spelling-words")
    found = materialize(forms(words, near_pairs(words, least_length), ratio), "spelling-forms")
    return (words.join(found, "word", "left").join(roots(found), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
