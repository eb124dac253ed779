"""Phrase collocations by partitioned mining (the SON scheme).

Documents are dealt to ``SHARDS`` shards. A phrase that occurs ``support``
times overall occurs ``support / SHARDS`` times in at least one of them, so
every shard is mined completely at that lowered support, and the union of what
the shards find holds every frequent phrase. A last pass counts all of these
over all documents, by their words, and keeps those that reach the support.

A shard is no task: its documents lie in many tasks, each of which counts
blocks of text in numpy and sends a row per distinct phrase of a block. Mining
goes by levels: words and pairs first; longer phrases only where each of their
pairs was frequent in some shard. Between passes the phrases found travel as a
Bloom filter of fixed size (``filter_bytes``), the only thing broadcast. What
the filter or a hash lets through wrongly is counted like the rest, by its
words, and fails the support: results are exact whatever its size.

Words, pieces and languages: text is lower-cased (A-Z only) and cut into pieces
at ``. , ; : ! ?`` and line ends; words are what blanks and tabs part in a
piece; phrases don't cross pieces. All counts are per language.

Defined cases: null text is empty, a null language is ``und``; a text without
words adds nothing; repeated rows count as often as they occur, overlapping
occurrences each; a language without frequent phrases gives no rows; ties go to
the larger count, then the smaller phrase in byte order; other columns are not
read. A task's memory grows with its block and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import FILTER_BYTES, Filter, filter_of
from .common import materialize, text_column, text_slices
from .hashing import mix, range_hashes

SUPPORT = 30
SHARDS = 6
LONGEST = 4  # words
TOP = 2000
COVERED_PERCENT = 80
SCORE_SCALE = 2_000_000
BLOCK_CHARS = 2_500_000  # characters counted together
SLICE_CHARS = 500_000  # characters hashed together
BATCH_ROWS = 50_000  # rows sent on together

_BLANKS = [0x20, 0x09]
_BREAKS = [*b".,;:!?", *range(0x0A, 0x0E)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0: in a word, 1: blank, 2: ends a piece
_KIND[_BLANKS] = 1
_KIND[_BREAKS] = 2
_CHECK = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
_STEP, _CHECK_STEP = np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)


def _parts(texts: list[str]) -> Iterator[bytes]:
    """The texts, each closed by a line end, as UTF-8 of about ``SLICE_CHARS`` characters cut at blanks."""
    held: list[str] = []
    size = 0
    for t in texts:
        start = 0
        while len(t) - start > SLICE_CHARS:
            cut = t.find(" ", start + SLICE_CHARS // 2)
            if cut < 0:
                break
            yield ("".join(held) + t[start:cut + 1]).encode("utf-8", "surrogatepass")
            held, size, start = [], 0, cut + 1
        held.append(t[start:] + "\n")
        size += len(held[-1])
        if size > SLICE_CHARS:
            yield "".join(held).encode("utf-8", "surrogatepass")
            held, size = [], 0
    if held:
        yield "".join(held).encode("utf-8", "surrogatepass")


class Block:
    """The words of a block of texts: hashes, where pieces start, and their letters with one blank after each word."""

    def __init__(self, texts: list[str], checked: bool):
        hashes, checks, fresh, letters, starts, ends = [], [], [], [], [], []
        base, new = 0, True  # whether the next word starts a piece
        for raw in _parts(texts):
            data = _LOWER[np.frombuffer(raw, np.uint8)]
            kind = _KIND[data]
            word = kind == 0
            keep = word.copy()
            keep[1:] |= word[:-1]  # one byte after each word
            edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
            first, last = edge[0::2], edge[1::2]
            if len(first):
                breaks = np.append(0, np.cumsum(kind == 2))
                start = breaks[first] > np.append(0, breaks[last[:-1]])
                start[0] |= new
                new = bool(breaks[-1] > breaks[last[-1]])
                hashes.append(range_hashes(data.astype(np.uint64), first, last))
                if checked:
                    checks.append(range_hashes(_CHECK[data], first, last))
                    place = np.append(0, np.cumsum(keep))
                    data[~word] = 0x20
                    letters.append(data[keep])
                    starts.append(place[first] + base)
                    ends.append(place[last] + base)
                    base += len(letters[-1])
                fresh.append(start)
            else:
                new |= bool((kind == 2).any())

        def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
            return np.concatenate(parts) if parts else np.zeros(0, kind)

        self.hashes, self.fresh = joined(hashes, np.uint64), joined(fresh, bool)
        if checked:
            self.checks, self.letters = joined(checks, np.uint64), joined(letters, np.uint8)
            self.starts, self.ends = joined(starts, np.int64), joined(ends, np.int64)

    def runs(self, size: int) -> np.ndarray:
        """First words of all runs of ``size`` words within pieces."""
        n = max(len(self.hashes) - size + 1, 0)
        whole = np.ones(n, bool)
        for k in range(1, size):
            whole &= ~self.fresh[k:k + n]
        return np.flatnonzero(whole)

    def texts(self, first: np.ndarray, size: int) -> pa.Array:
        """The letters of these runs."""
        start, stop = self.starts[first], self.ends[first + size - 1]
        offsets = np.append(0, np.cumsum(stop - start))
        at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], stop - start)
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(self.letters[at])).cast(pa.string())


def _chained(words: np.ndarray, first: np.ndarray, size: int, step: np.uint64, salt: np.uint64) -> np.ndarray:
    """Hashes of runs of words, different for each salt and size."""
    h = words[first] ^ salt
    for k in range(1, size):
        h = mix(h * step + words[first + k])
    return mix(h + np.uint64(size))


def _salt(lang: str) -> np.uint64:
    raw = lang.encode("utf-8", "surrogatepass")
    return range_hashes(np.frombuffer(raw, np.uint8).astype(np.uint64), np.zeros(1, np.int64), np.array([len(raw)]))[0]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[tuple[str, int], list[str]]]:
    """Blocks of about ``BLOCK_CHARS`` characters: texts by (language, shard)."""
    groups: dict[tuple[str, int], list[str]] = {}
    size = 0
    for b in batches:
        for part, texts in text_slices(b.column("text")):
            langs, shards = (b.column(c).slice(part.start, len(texts)).to_pylist() for c in ("lang", "shard"))
            for lang, shard, text in zip(langs, shards, texts, strict=True):
                groups.setdefault((lang, shard), []).append(text)
                size += len(text)
                if size >= BLOCK_CHARS:
                    yield groups
                    groups, size = {}, 0
    if groups:
        yield groups


def _mine(rows: DataFrame, sizes: tuple[int, ...], local_support: int, pairs: Filter | None = None) -> DataFrame:
    """h of the phrases of these sizes that reach the local support in a shard; with ``pairs``, only phrases of such pairs count."""
    held = None if pairs is None else rows.sparkSession.sparkContext.broadcast(pairs.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = None if held is None else Filter(held.value)
        for groups in _blocks(batches):
            for (lang, shard), texts in groups.items():
                block, salt = Block(texts, False), _salt(lang)
                if frequent is not None:
                    at = block.runs(2)
                    pair = np.zeros(len(block.hashes), bool)
                    pair[at] = frequent.holds(_chained(block.hashes, at, 2, _STEP, salt))
                for size in sizes:
                    first = block.runs(size)
                    if frequent is not None:
                        for k in range(size - 1):
                            first = first[pair[first + k]]
                    h, n = np.unique(_chained(block.hashes, first, size, _STEP, salt), return_counts=True)
                    for k in range(0, len(h), BATCH_ROWS):
                        part = h[k:k + BATCH_ROWS].view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), shard, np.int32)), pa.array(part), pa.array(n[k:k + BATCH_ROWS].astype(np.int64))],
                                                         names=["shard", "h", "n"])

    found = rows.mapInArrow(run, "shard int, h long, n long").groupBy("shard", "h").agg(F.sum("n").alias("n"))
    return materialize(found.where(F.col("n") >= local_support).select("h"), "phrases-mined")


def _counted(rows: DataFrame, candidates: Filter, longest: int) -> DataFrame:
    """lang, phrase, size, n: occurrences of each candidate, by its words; size 0: all words of the language."""
    held = rows.sparkSession.sparkContext.broadcast(candidates.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Filter(held.value)
        for groups in _blocks(batches):
            by_lang: dict[str, list[str]] = {}
            for (lang, _), texts in groups.items():
                by_lang.setdefault(lang, []).extend(texts)
            for lang, texts in by_lang.items():
                block, salt = Block(texts, True), _salt(lang)

                def batch(phrases: pa.Array, size: int, n: np.ndarray, lang: str = lang) -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(np.full(len(phrases), size, np.int32)),
                                                       pa.array(n.astype(np.int64))], names=["lang", "phrase", "size", "n"])

                yield batch(pa.array([""], pa.string()), 0, np.array([len(block.hashes)]))
                for size in range(1, longest + 1):
                    first = block.runs(size)
                    h = _chained(block.hashes, first, size, _STEP, salt)
                    kept = frequent.holds(h)
                    first, h = first[kept], h[kept]
                    check = _chained(block.checks, first, size, _CHECK_STEP, salt)
                    order = np.argsort(h, kind="stable")
                    new = np.append(True, h[order][1:] != h[order][:-1])[:len(h)]
                    if (check[order][1:] != check[order][:-1])[~new[1:]].any():  # two phrases of one hash
                        order = np.lexsort((check, h))
                        new = np.append(True, (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1]))[:len(h)]
                    start = np.flatnonzero(new)
                    one, n = first[order[start]], np.diff(np.append(start, len(h)))
                    for k in range(0, len(one), BATCH_ROWS):
                        yield batch(block.texts(one[k:k + BATCH_ROWS], size), size, n[k:k + BATCH_ROWS])

    return rows.mapInArrow(run, "lang string, phrase string, size int, n long").groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS,
                     filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """lang, phrase, size, n of every phrase of at most ``longest`` words that occurs ``support`` times; size 0: all words."""
    text = text_column()
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(shards)).cast("int").alias("shard"), text.alias("text"))
    local_support = -(-support // shards)
    short = _mine(rows, (1, 2), local_support)
    found = short
    if longest > 2:
        found = short.unionAll(_mine(rows, tuple(range(3, longest + 1)), local_support, filter_of(short, filter_bytes)))
    counted = _counted(rows, filter_of(found, filter_bytes), longest)
    return materialize(counted.where((F.col("n") >= support) | (F.col("size") == 0)), "phrases-frequent")


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS, top: int = TOP,
                 covered_percent: int = COVERED_PERCENT, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language.

    ``frequent`` is a written table, so the planner may split a join at a word
    that begins or ends many phrases.
    """
    frequent = frequent_phrases(docs, support, longest, shards, filter_bytes)
    counts = frequent.where("size > 0").select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    phrases = frequent.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), "size", words.alias("words"))
    # phrases inside longer ones that hold most of their occurrences
    inner = phrases.where("size > 2").select(
        "lang", "a", F.explode(F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(words, i, m), ' '))))")).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    big = "CAST({} AS DECIMAL(19, 0))".format  # products may pass 64 bits
    kept = phrases.join(covered, ["lang", "phrase"], "left").where(
        f"longer IS NULL OR 100 * {big('longer')} < {covered_percent} * {big('a')}").drop("longer")
    cuts = kept.select("lang", "phrase", "a", F.explode(F.expr(
        "transform(sequence(1, size - 1), k -> struct(k, array_join(slice(words, 1, k), ' ') AS head, array_join(slice(words, k + 1, size - k), ' ') AS tail))")).alias("c"))
    scored = (cuts.select("lang", "phrase", "a", "c.k", F.col("c.head").alias("head"), F.col("c.tail").alias("tail"))
              .join(counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
              .join(counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
              .withColumn("score", F.expr(f"({SCORE_SCALE} * {big('a')}) div ({big('l')} + {big('r')})")))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = lowest.selectExpr("lang", "phrase", "a", "cut.l", "cut.r", "cut.score",
                               "row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS place").where(f"place <= {int(top)}")
    totals = frequent.where("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("place").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
