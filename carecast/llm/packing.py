"""Best-fit packing of tokenized documents into sequences of bounded length.

Documents are tokenized word by word and the words' ids remembered: a Latin-1
text is split by the tokenizer's own rule, whose pieces are encoded alone; any
other text at its blanks and line feeds, which the tokenizer drops. An end id is appended, and documents longer than a sequence are
cut. The pieces, a few numbers each, are written once with a number of their own.

Packing is bulk-synchronous best-fit decreasing. Bands of lengths follow one
another, longest first, in rounds on Spark: pieces of the band and gaps that may
hold one are range-sorted together by size; each partition sweeps its rows for
successors (the smallest gap that holds a piece), a gap that several want going
to the longest by the nesting of brackets, updates its gaps and sweeps again;
what it has left is matched with the others' by rank, for which a pair of counts
per partition is all that reaches the driver. Gaps are then written anew and the rest of the band
tries again; when no gap holds any of it, sequences are opened. A round that one task
can hold is the band's last: it isn't range-sorted, and opens what the band still needs.

Memory: a task holds about ``rows_a_task`` pieces and gaps and three slots each.
Rounds: a few a band, one if a task can hold it, and there are seven bands whatever the data.

Defined cases: a null text is empty and yields its end id only; repeated rows
are packed each on its own; equal lengths go by their numbers; an empty table
packs to none; only doc_id and text are read.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_column, text_slices

CAPACITY = 4096
END_ID = 1
ROWS_A_TASK = 200_000  # pieces and gaps swept by one task
CACHE_BYTES = 32 << 20  # of words and their ids that a worker remembers
# The tokenizer's splitting rule, written out for lower-case Latin-1 texts, and what keeps a text from it.
PRE_TOKENS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]"
                        "|[^ \t\na-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff0-9\u00b2\u00b3\u00b9\u00bc-\u00be]+").findall
UNUSUAL = re.compile("[\x00-\x08\x0b-\x1f\x7f-\xa0]|<\\|").search


def _letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others move above U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


LETTERS = _letters()


class WordEncoder:
    """Token ids of texts under a tokenizer that drops white space, as little-endian bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.held = 0

    def learn(self, words: list[str], plain: bool) -> None:
        """Remember the ids of ``words``; plain ones are single pre-tokens, normalized already."""
        if self.held > CACHE_BYTES:
            self.cache.clear()
            self.held = 0
        if plain:
            tokenize = self.library.model.tokenize
            for w in words:
                self.cache[w] = array("I", [t.id for t in tokenize("".join([LETTERS[b] for b in w.encode()]))]).tobytes()
        else:
            for w, e in zip(words, self.library.encode_batch_fast(words, add_special_tokens=False), strict=True):
                self.cache[w] = array("I", e.ids).tobytes()
        self.held += sum(170 + 2 * len(w) + len(self.cache[w]) for w in words)

    def encode(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            plain = not UNUSUAL(text)
        except UnicodeEncodeError:
            plain = False
        # words of other texts are marked by a blank, as they are not normalized
        words = PRE_TOKENS(text.lower()) if plain else [" " + w for w in text.replace("\n", " ").split(" ")]
        cache = self.cache
        if new := [w for w in set(words) if w not in cache]:
            held = len(cache)
            self.learn(new, plain)
            if len(cache) < held:  # dropped: the text's other words are new, too
                self.learn([w for w in set(words) if w not in cache], plain)
        return b"".join([cache[w] for w in words])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is what Spark gave it
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""
    path, end = tokenizer or default_tokenizer(), np.array([END_ID], "<u4").tobytes()
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches):
        for b in batches:
            for part, texts in text_slices(b.column("text")):
                enc, rows = encoder(path), []
                step = 4 * capacity
                for i, text in enumerate(texts, part.start):
                    data = enc.encode(text) + end
                    for k in range(0, len(data), step):
                        own = data[k:k + step]
                        rows.append((i, k // step, k // 4, len(own) // 4, zlib.crc32(own)))
                at, piece, start, length, crc = zip(*rows, strict=True)
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(at), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select("doc_id", text_column().alias("text"))
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def edges(capacity: int) -> list[tuple[int, int, int]]:
    """Bands of lengths (low, high], longest first, and how many of a band's pieces fit one sequence whatever their lengths (0: it depends)."""
    cuts = [*sorted({c for p in (1, 2, 3, 4, 8, 16, 64) if (c := capacity // p)}, reverse=True), 0]
    return [(low, high, capacity // high if capacity // high == capacity // (low + 1) else 0) for high, low in zip(cuts[:-1], cuts[1:], strict=True)]


def nested(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matches pieces (0 slots) with the gaps before them: (pieces, their gaps, pieces left, slots left as gaps), all row numbers.

    Rows come by falling size, so the smallest gap that holds a piece and isn't
    taken by a longer one is the last open one before it: gaps and pieces pair
    like brackets. Brackets of one pair have one level, and at a level opening
    and closing ones take turns.
    """
    row = np.repeat(np.arange(len(slots)), np.maximum(slots, 1))
    opens = slots[row] > 0
    level = np.cumsum(np.where(opens, 1, -1)) + ~opens
    order = np.argsort(level, kind="stable")
    a, b = order[:-1], order[1:]
    pair = opens[a] & ~opens[b] & (level[a] == level[b])
    free = np.ones(len(row), bool)
    free[a[pair]] = free[b[pair]] = False
    return row[b[pair]], row[a[pair]], row[free & ~opens], row[free & opens]


def slots_of(size: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """How many of the longest piece each gap holds (one at least), so that slots grow with pieces and gaps."""
    return np.clip(size // pieces.max(initial=1), 1, -(-2 * len(pieces) // max(1, len(size))))


def settle(length: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gap of each piece (row numbers, -1: none) when ``nested`` is repeated until nothing more fits, and the gaps' new sizes."""
    to, size = np.full(len(length), -1), size.copy()
    while True:
        todo = np.flatnonzero(to < 0)
        able = np.flatnonzero(size >= length[todo].min(initial=1 << 40))
        if not len(able):
            return to, size
        n = len(able)
        order = np.lexsort((np.append(np.zeros(n), np.ones(len(todo))), -np.append(size[able], length[todo])))
        slots = np.append(slots_of(size[able], length[todo]), np.zeros(len(todo), np.int64))[order]
        piece, gap, _, _ = nested(slots)
        if not len(piece):
            return to, size
        piece, gap = todo[order[piece] - n], able[order[gap]]
        to[piece] = gap
        np.subtract.at(size, gap, length[piece])


def openings(n: int, tokens: int, high: int, fit: int, capacity: int) -> int:
    """About as many sequences as ``n`` pieces of a band need, one each at most."""
    return min(n, -(-n // fit) if fit else -(-tokens // (capacity - high // 4)))


def settle_all(length: np.ndarray, size: np.ndarray, high: int, fit: int, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """``settle``, with sequences opened for what no gap holds: the gap of each piece, the sizes of all gaps with those opened at the end.

    No more are opened than there are pieces: some stay empty only if all the rest is placed.
    """
    to = np.full(len(length), -1)
    while True:
        todo = np.flatnonzero(to < 0)
        to[todo], size = settle(length[todo], size)
        todo = todo[to[todo] < 0]
        if not len(todo):
            return to, size
        size = np.append(size, np.full(openings(len(todo), int(length[todo].sum()), high, fit, capacity), capacity))


def between(sums: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """The same among partitions, of which only (partition, pieces left, gaps left) are known.

    Gives (partition, first piece, past piece, gaps' partition, top): piece ``i`` of
    the range gets gap ``top - i``. At most two rows a partition.
    """
    held: list[list[int]] = []
    moves = []
    for part, closing, opening in sorted(sums):
        at = 0
        while at < closing and held:
            other, n = held[-1]
            took = min(n, closing - at)
            moves.append((part, at, at + took, other, n - 1 + at))
            at += took
            held[-1][1] -= took
            if not held[-1][1]:
                held.pop()
        if opening:
            held.append([part, opening])
    return moves


def _together(left: DataFrame, gaps: DataFrame) -> DataFrame:
    """at (a gap's sequence), size, gap of pieces and gaps."""
    return left.select("at", F.col("length").alias("size"), F.lit(False).alias("gap")).unionByName(
        gaps.select(F.col("sequence").alias("at"), "size", F.lit(True).alias("gap")))


def last_round(left: DataFrame, gaps: DataFrame, opened: int, high: int, fit: int, capacity: int) -> DataFrame:
    """A round that one task can hold: at, size, gap, sequence, written, of all pieces and of the gaps they leave.

    Sequences are opened from the number ``opened`` on.
    """

    def place_all(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        at, size, gap = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("at", "size", "gap"))
        order = np.lexsort((at, ~gap, -size))
        pieces, gaps = order[~gap[order]], order[gap[order]]
        to, now = settle_all(size[pieces], size[gaps], high, fit, capacity)
        sequence = np.append(at[gaps], opened + np.arange(len(now) - len(gaps)))
        rest = np.flatnonzero(now > 0)
        rows = (np.append(at[pieces], sequence[rest]), np.append(size[pieces], now[rest]),
                np.arange(len(pieces) + len(rest)) >= len(pieces), np.append(sequence[to], sequence[rest]))
        for k in range(0, len(rows[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[k:k + 50_000]) for x in rows], names=["at", "size", "gap", "sequence"])

    both = _together(left, gaps).repartition(1)  # at most ``rows_a_task``
    return materialize(both.mapInArrow(place_all, "at long, size long, gap boolean, sequence long"), "packing-last")


def sweep(left: DataFrame, gaps: DataFrame, tasks: int) -> DataFrame:
    """One round: ``left`` (at, length) with the sequence each piece gets, or null, written; ``gaps``: sequence, size.

    Pieces and gaps are range-sorted together, and each partition settles its
    own rows. Its gaps that are still as large as its last row hold whatever
    comes after it, so they meet the pieces left in later partitions, by number.
    """
    ordered = _together(left, gaps).repartitionByRange(tasks, F.desc("size"), F.desc("gap"), "at").sortWithinPartitions(F.desc("size"), F.desc("gap"), "at")

    def match(batches):
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        at, size, gap = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("at", "size", "gap"))
        pieces, gaps = np.flatnonzero(~gap), np.flatnonzero(gap)
        to, now = settle(size[pieces], size[gaps])
        done, closing, opening = np.flatnonzero(to >= 0), np.flatnonzero(to < 0), np.flatnonzero(now >= size[-1])
        opening = opening[np.argsort(-now[opening], kind="stable")]
        rows = np.concatenate([pieces[done], pieces[closing], gaps[opening]])
        sequence = np.concatenate([at[gaps[to[done]]], np.full(len(closing), -1), at[gaps[opening]]])
        place = np.concatenate([np.full(len(done), -1), np.arange(len(closing)), np.arange(len(opening))])
        part = TaskContext.get().partitionId()
        for k in range(0, len(rows), 50_000):
            own = rows[k:k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), part, np.int32)), pa.array(gap[own]), pa.array(place[k:k + 50_000]), pa.array(at[own]),
                 pa.array(size[own]), pa.array(sequence[k:k + 50_000])], names=["part", "gap", "place", "at", "length", "sequence"])

    met = materialize(ordered.mapInArrow(match, "part int, gap boolean, place long, at long, length long, sequence long"), "packing-swept")
    own = met.where("NOT gap AND place < 0").select("at", "length", "sequence")
    rest = met.where("NOT gap AND place >= 0").select("part", "place", "at", "length")
    sums = [tuple(r) for r in met.where("place >= 0").groupBy("part").agg(
        F.sum(F.when(F.col("gap"), 0).otherwise(1)), F.sum(F.when(F.col("gap"), 1).otherwise(0))).collect()]  # a row per partition
    moves = between(sums)
    if not moves:
        return own.unionByName(rest.select("at", "length", F.lit(None).cast("long").alias("sequence")))
    moves = met.sparkSession.createDataFrame(moves, "part int, low long, past long, other int, top long")
    ways = rest.alias("r").join(moves.alias("m"), F.expr("r.part = m.part AND r.place >= m.low AND r.place < m.past"), "left").selectExpr(
        "r.at", "r.length", "m.other AS part", "m.top - r.place AS place")
    open_ = met.where("gap").select("part", "place", "sequence")
    return materialize(own.unionByName(ways.join(open_, ["part", "place"], "left").select("at", "length", "sequence")), "packing-round")


def place(items: DataFrame, capacity: int = CAPACITY, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """at, sequence, offset of every piece of ``items`` (at, length; a written table)."""
    spark = items.sparkSession
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    gaps = spark.range(0).selectExpr("id AS sequence", "id AS size")
    opened, placed = 0, []

    def figures(left: DataFrame) -> tuple[int, int, int]:
        """Pieces left, their tokens and the shortest."""
        return tuple(x or 0 for x in left.agg(F.count("length"), F.sum("length"), F.min("length")).first())

    for low, high, fit in edges(capacity):
        band = {k: c for k, c in counts.items() if low < k <= high}
        left = items.where((F.col("length") > low) & (F.col("length") <= high)).select("at", "length")
        n, tokens, least = sum(band.values()), sum(k * c for k, c in band.items()), min(band, default=0)
        while n:
            offered = gaps.where(F.col("size") > low)
            n_gaps, most = offered.agg(F.count("size"), F.coalesce(F.max("size"), F.lit(0))).first() if opened else (0, 0)
            new = openings(n, tokens, high, fit, capacity)
            if n + n_gaps + new <= rows_a_task:
                result = last_round(left, offered, opened, high, fit, capacity)
                opened += n  # or fewer; numbers need not follow one another
                got = result.where("NOT gap").selectExpr("at", "size AS length", "sequence")
                gaps = gaps.where(F.col("size") <= low).unionByName(result.where("gap").select("sequence", "size"))
                n = 0
            else:
                if most < least:  # none holds any
                    fresh = spark.range(opened, opened + new).select(F.col("id").alias("sequence"), F.lit(capacity).cast("long").alias("size"))
                    gaps, offered = gaps.unionByName(fresh), offered.unionByName(fresh)
                    opened, n_gaps = opened + new, n_gaps + new
                result = sweep(left, offered, -(-(n + n_gaps) // rows_a_task))
                got = result.where("sequence IS NOT NULL")
                used = gaps.unionByName(got.select("sequence", (-F.col("length")).alias("size")))
                gaps = materialize(used.groupBy("sequence").agg(F.sum("size").alias("size")).where("size > 0"), "packing-gaps")
                left = result.where("sequence IS NULL").select("at", "length")
                n, tokens, least = figures(left)
            placed.append(got.withColumn("round", F.lit(len(placed))))
    if not placed:
        return items.selectExpr("at", "CAST(NULL AS BIGINT) AS sequence", "CAST(NULL AS BIGINT) AS offset")
    before = Window.partitionBy("sequence").orderBy("round", F.desc("length"), "at").rowsBetween(Window.unboundedPreceding, -1)
    return functools.reduce(DataFrame.unionByName, placed).select(
        "at", "sequence", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))  # a sequence has at most `capacity` pieces


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    items = materialize(pieces(docs, tokenizer, capacity).withColumn("at", F.monotonically_increasing_id()), "packing-pieces")
    return items.join(place(items, capacity, rows_a_task), "at").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence").alias("sequence_id"), "offset")
