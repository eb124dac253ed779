"""Substring dedup by sliding sentence spans.

A sentence ends with a word that closes in ``. , ; : ! ?`` (quotes and brackets
may follow) or at a line's end. One of more than ``LONG`` words is cut further, at
words that its own text chooses: of every ``WINDOW`` consecutive words the
greatest by its first eight bytes (the last of equal ones) ends a sentence. So a
passage that was glued into other sentences has the same sentences inside
wherever it stands.

From each sentence, and up to each, the shortest run of at least ``SPAN``
sentences that holds ``MIN_WORDS`` words is hashed. Equal hashes are joined over the
whole corpus; the sentences of a span that occurred before, in an earlier row or
earlier in the same one, are removed. A passage that two texts share loses all
its sentences but those cut at its ends, if these hold ``MIN_WORDS`` words.

Hashes are counted first (counts are combined before the shuffle; nothing else
travels), and the spans of those that occur twice are looked up: a Bloom filter
of fixed size leaves most others out, an ordinary join, which the planner may split at a
hot hash, the rest. Spans are compared by their words, whatever white space
stands between them.

Defined cases: null and wordless texts have no sentences; rows are ordered by
doc_id (null last), then by text hash, so rows that share a doc_id or have none
are documents of their own, and equal rows are later copies of one of them; a
span that overlaps its own first occurrence loses only what lies behind it;
an empty table gives none; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import FILTER_BYTES, filter_of, rows_held
from .common import materialize, text_column, text_slices
from .hashing import Words, mix, range_hashes

SPAN = 3
MIN_WORDS = 24
LONG = 24
WINDOW = 6

_CLOSERS = np.zeros(256, bool)
_CLOSERS[[ord(c) for c in "\"')]}*_"]] = True
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".,;:!?"]] = True


def sentence_ends(w: Words) -> np.ndarray:
    """For each word of a batch, whether it ends a sentence."""
    data = w.data
    at = w.ends - 1
    for _ in range(3):  # closing quotes and brackets
        back = _CLOSERS[data[at]] & (at > w.starts)
        at = np.where(back, at - 1, at)
    ends = _STOPS[data[at]]
    feeds = np.append(0, np.cumsum(data == 0x0A))
    following = np.append(w.starts[1:], len(data))
    ends |= feeds[following] > feeds[w.ends]
    ends[w.last[w.last > w.first] - 1] = True
    n = len(ends) - WINDOW + 1
    if n > 0:
        number = np.append(0, np.cumsum(ends)[:-1])
        whole = number[:n] == number[WINDOW - 1:]  # windows within one sentence
        s = np.flatnonzero(whole & (np.bincount(number)[number[:n]] > LONG))
        windows = np.lib.stride_tricks.sliding_window_view(_first_bytes(w), WINDOW)[s]
        ends[s + WINDOW - 1 - windows[:, ::-1].argmax(axis=1)] = True
    return ends


def _first_bytes(w: Words) -> np.ndarray:
    """The first eight bytes of each word as a number that orders words as the bytes do."""
    out = np.zeros(len(w.starts), np.uint64)
    for k in range(8):
        held = w.starts + k < w.ends
        out = (out << np.uint64(8)) | np.where(held, w.data[np.minimum(w.starts + k, len(w.data) - 1)], 0).astype(np.uint64)
    return out


def spans_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """(text, first sentence, sentence past it, first word, word past it, hash, check, since, since's sentence) of every span.

    ``since``: the first word to remove if the span came before in its text, else -1.
    """
    w = Words(texts)
    stops = np.flatnonzero(sentence_ends(w)) + 1  # past each sentence's last word
    if not len(stops):
        return (np.zeros(0, np.int64),) * 9
    starts = np.append(0, stops[:-1])
    owner = np.searchsorted(w.last, starts, side="right")
    n = np.arange(len(starts))
    last = np.maximum(np.searchsorted(stops, starts + MIN_WORDS), n + SPAN - 1)
    first = np.minimum(np.searchsorted(starts, stops - MIN_WORDS, side="right") - 1, n - SPAN + 1)
    i, j = np.append(n, np.maximum(first, 0)), np.append(np.minimum(last, len(starts) - 1), n)
    whole = np.append(last < len(starts), first >= 0) & (owner[i] == owner[j])
    runs = np.unique(i[whole] << 32 | j[whole])
    i, j = runs >> 32, runs & 0xFFFFFFFF
    begin, end, text = starts[i], stops[j], owner[i]
    h = range_hashes(w.hashes, begin, end)
    check = mix(range_hashes(w.hashes ^ np.uint64(0x5851F42D4C957F2D), begin, end))
    order = np.lexsort((begin, check, h, text))
    i, j, text, begin, end, h, check = (x[order] for x in (i, j, text, begin, end, h, check))
    again = np.zeros(len(text), bool)
    again[1:] = (text[1:] == text[:-1]) & (h[1:] == h[:-1]) & (check[1:] == check[:-1])
    origin = np.maximum.accumulate(np.where(again, 0, np.arange(len(text))))
    since = np.minimum(np.maximum(begin, end[origin]), end)
    base = w.first[text]
    above = np.searchsorted(starts, base)
    return (text, i - above, j + 1 - above, begin - base, end - base, h, check,
            np.where(again, since - base, -1), np.where(again, np.searchsorted(starts, since) - above, -1))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with _row, a number of its own for each row."""
    return docs.withColumn("_row", F.monotonically_increasing_id())


def document_spans(rows: DataFrame) -> DataFrame:
    """row, first, past, begin, end, since, whence, a, b of every span of every row; doc_id and tie (the text's hash) stand with a row's first one."""
    def run(batches):
        for batch in batches:
            for part, texts in text_slices(batch.column("text")):
                text, first, past, begin, end, h, check, since, whence = spans_of(texts)
                if len(text):
                    at = pa.array(text + part.start, pa.int64())
                    opens = pa.array(np.append(True, text[1:] != text[:-1]))
                    own = [pc.if_else(opens, batch.column(c).take(at), pa.scalar(None, batch.column(c).type)) for c in ("doc_id", "tie")]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").take(at), *own, *[pa.array(x, pa.int32()) for x in (first, past, begin, end, since, whence)],
                         pa.array(h.view(np.int64)), pa.array((check >> np.uint64(33)).astype(np.int32)), opens],
                        names=["row", "doc_id", "tie", "first", "past", "begin", "end", "since", "whence", "a", "b", "opens"])

    keyed = rows.select(F.col("_row").alias("row"), "doc_id", F.xxhash64(text_column()).alias("tie"), text_column().alias("text"))
    return keyed.mapInArrow(run, f"row long, doc_id {dict(rows.dtypes)['doc_id']}, tie long, first int, past int, begin int, end int, since int, whence int, a long, b int, opens boolean")


def repeated_spans(rows: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """row, doc_id, first, past, begin, end, first_doc of every span that occurred before: the sentences and the words to remove."""
    spans = materialize(document_spans(rows), "spans")  # written, so that row numbers stay
    often = materialize(spans.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b"), "spans-often")
    narrow = spans.drop("doc_id", "tie", "opens")
    found = rows_held(narrow, "a", filter_of(often.select(F.col("a").alias("h")), filter_bytes)).join(often, ["a", "b"])
    # a document's name stands with its first span only
    names = materialize(spans.where("opens").select("row", "doc_id", "tie"), "spans-rows")
    found = materialize(found.join(names, "row"), "spans-repeated")
    origin = (found.where("since < 0").groupBy("a", "b")
              .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tie", "row")).alias("o"))
              .select("a", "b", F.col("o.doc_id").alias("first_doc"), F.col("o.row").alias("first_row")))
    # a row's later spans of its own are repeats wherever else the hash occurs
    later = (found.drop("tie").join(materialize(origin, "spans-origins"), ["a", "b"])
             .withColumn("own", F.col("first_row") == F.col("row")).where("NOT own OR since >= 0"))
    return (later.select("row", "doc_id", F.when(F.col("own"), F.col("whence")).otherwise(F.col("first")).alias("first"), "past",
                         F.when(F.col("own"), F.col("since")).otherwise(F.col("begin")).alias("begin"), "end", "first_doc").where("begin < end"))


def _union(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint ranges of the same places, in order."""
    order = np.lexsort((end, begin))
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > reach[:-1])
    return begin[new], reach[np.append(new[1:], True)]


def removals(rows: DataFrame) -> DataFrame:
    """row, doc_id, removed (sentences in a repeated span), first_docs (documents that had them before), cut (all ranges of words) of rows that lose words."""
    kind = dict(rows.dtypes)["doc_id"]
    lost = repeated_spans(rows).groupBy("row").agg(  # bounded by a row's spans
        F.min("doc_id").alias("doc_id"), F.array_sort(F.collect_set("first_doc")).alias("first_docs"),
        *[F.collect_list(c).alias(c) for c in ("first", "past", "begin", "end")])

    def merge(batches):
        for b in batches:
            removed, cut = [], []
            for lists in zip(*[b.column(c) for c in ("first", "past", "begin", "end")], strict=True):
                first, past, begin, end = (x.values.to_numpy() for x in lists)
                removed.append([k for i, j in zip(*_union(first, past), strict=True) for k in range(i, j)])
                cut.append([{"begin": int(i), "end": int(j)} for i, j in zip(*_union(begin, end), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(removed, pa.list_(pa.int32())), b.column("first_docs"),
                 pa.array(cut, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))], names=["row", "doc_id", "removed", "first_docs", "cut"])

    return lost.mapInArrow(merge, f"row long, doc_id {kind}, removed array<int>, first_docs array<{kind}>, cut array<struct<begin: int, end: int>>")


def cut_words(text: str, cut: list[tuple[int, int]]) -> str:
    """``text`` without the words of these ranges; white space before a range goes with it."""
    w = Words([text])
    out, at = [], 0
    data = w.data.tobytes()
    for begin, end in cut:
        out.append(data[at:int(w.ends[begin - 1]) if begin else 0])
        at = int(w.ends[end - 1])
    out.append(data[at:-1])
    return b"".join(out).decode("utf-8", "surrogatepass")


def remove_repeated_spans(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated spans; a row that loses all it had goes; n_chars follows the text."""
    rows = materialize(numbered(docs), "spans-rows")
    lost = materialize(removals(rows), "spans-removed").select(F.col("row").alias("_row"), F.col("cut").alias("_cut"))
    found = rows.join(lost, "_row", "left")

    @F.pandas_udf("string")
    def cut(texts, ranges):
        import pandas as pd

        return pd.Series([t if r is None or t is None else cut_words(t, [(x["begin"], x["end"]) for x in r])
                          for t, r in zip(texts, ranges, strict=True)], dtype=object)

    out = found.withColumn("text", cut(F.col("text").cast("string"), "_cut"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"])))
    left = F.col("_cut").isNull() | F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return out.where(left).select(*[f"`{c}`" for c in docs.columns])


def span_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_removed, removed (sentence numbers), first_docs, n_words and cut (words and ranges of words lost) of every row that loses words."""
    words = F.aggregate("cut", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    return removals(numbered(docs.select("doc_id", "text"))).select(
        "doc_id", F.size("removed").cast("long").alias("n_removed"), "removed", "first_docs", words.alias("n_words"), "cut")
