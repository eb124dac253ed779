"""MinHash near-dedup by Order MinHash.

A text's five-word shingles are labelled with their occurrence, so that all
differ. A sketch takes the ``ORDERED`` shingles with the smallest hashes under
one hash function and keeps them in text order; two texts share it with
probability about J^ORDERED if their common shingles stand in the same order.
For texts of many shingles, ``SKETCHES`` functions make a pair of similarity 0.8
miss with 3e-5. Minima are drawn without replacement, so the fewer the shingles, the
more they miss (1.2 % of pairs of 4 and 5): texts of fewer than ``SHORT`` shingles, and
what may be similar to them, also go straight through the exact join below.

Texts that are equal form one node before anything else. In each bucket of
equal sketches, every member is first paired with one central member only, the
one that meets most others over all its buckets (the original among its edited
copies). Pairs are verified; members whose components then differ are paired with the
next central member, and after ``STARS`` rounds the members of buckets that
still hold several components are joined exactly: two texts of similarity 0.8
must share one of the rarest fifth of their shingles, so a passage that
thousands of different texts have in common pairs none of them. In that join a
shingle's nodes of its largest component meet only those of others, so a cluster is
not paired with itself.

Verification aligns the labelled shingles of both texts: common shingles are
matched, matches off the diagonal band that a similarity of 0.8 allows are
dropped, and the longest increasing chain of the rest is the alignment.
Similarity = aligned / (all shingles of both - aligned).

Defined cases: null and wordless texts are never near-duplicates; a text
shorter than five words is one shingle; repeated rows and rows that share a
doc_id are members each; a null doc_id is a member but names no class unless
all are null; an empty table gives none; only doc_id and text are read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bloom import FILTER_BYTES, filter_of, rows_held
from .common import fingerprint128, map_texts, materialize, text_column, text_ranges, text_slices
from .components import components
from .hashing import SHINGLE, Words, mix, shingles

SIMILARITY = 0.8
SKETCHES = 20
ORDERED = 4
#: Rounds that pair a bucket with one central member before the remaining members are joined by rare shingles.
STARS = 2
#: Texts of fewer shingles are joined exactly, whatever their sketches.
SHORT = 20

_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def sketch(labelled: np.ndarray) -> np.ndarray:
    """The order min-hashes of a text's labelled shingles, one per hash function."""
    keys = (labelled[None, :] ^ _SEEDS[:, None]) * np.uint64(0xE7037ED1A0B428DB)
    keys ^= keys >> np.uint64(32)
    keys *= np.uint64(0x8EBC6AF09C88C6E3)
    k = min(ORDERED, keys.shape[1])
    least = np.argpartition(keys, k - 1, axis=1)[:, :k] if k < keys.shape[1] else np.tile(np.arange(k), (SKETCHES, 1))
    chosen = labelled[np.sort(least, axis=1)]
    out = _SEEDS.copy()
    for j in range(k):
        out = mix(out * np.uint64(3) + chosen[:, j])
    return out.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, a, b (the text's 128-bit hash), sketches (null for a wordless text), n (shingles) of every row."""

    def fn(texts: list[str]) -> pd.DataFrame:
        w = Words(texts)
        out = []
        for i, j in zip(w.first, w.last, strict=True):
            out.append(sketch(shingles(w.hashes[i:j])) if j > i else None)
        words = w.last - w.first
        return pd.DataFrame({"sketches": pd.Series(out, dtype=object), "n": np.maximum(words - SHINGLE + 1, np.minimum(words, 1))})

    rows = docs.select("doc_id", text_column().alias("text"))
    a, b = fingerprint128(F.col("text"))
    return map_texts(rows.withColumns({"a": a, "b": b}), fn, "sketches array<long>, n long")


def chain(positions: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    if len(positions) < 2 or (positions[1:] > positions[:-1]).all():
        return len(positions)
    tails: list[int] = []
    for p in positions.tolist():
        k = bisect_left(tails, p)
        if k == len(tails):
            tails.append(p)
        else:
            tails[k] = p
    return len(tails)


def aligned_similarity(x: np.ndarray, y: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Similarity of two texts' labelled shingles by banded alignment; 0 where it cannot reach ``threshold``."""
    n, m = len(x), len(y)
    if not n or not m or min(n, m) < threshold * max(n, m):
        return 0.0
    both = n + m
    band = int(both * (1 - threshold) / (1 + threshold)) + 1  # shingles that may stay unmatched
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < threshold * (both - len(i)):
        return 0.0
    hits = chain(j[np.argsort(i)])
    return hits / (both - hits)


def _node():
    return F.struct("a", "b").alias("node")


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose texts are similar; ``texts``: node, text of every node in ``pairs``."""
    wide = (pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("x")), "u")
            .join(texts.select(F.col("node").alias("v"), F.col("text").alias("y")), "v"))

    def check(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for part, x in text_slices(batch.column("x")):
                y = batch.column("y").slice(part.start, len(x))
                sizes = pc.binary_length(y).to_numpy()
                for start, stop in text_ranges(sizes):
                    w = Words(x[start:stop] + y.slice(start, stop - start).to_pylist())
                    n = stop - start
                    for r in range(n):
                        pair = [shingles(w.hashes[w.first[i]:w.last[i]]) for i in (r, n + r)]
                        ok[part.start + start + r] = aligned_similarity(*pair, threshold) >= threshold
            if ok.any():
                yield batch.select(["ua", "ub", "va", "vb"]).filter(pa.array(ok))

    flat = wide.selectExpr("u.a AS ua", "u.b AS ub", "v.a AS va", "v.b AS vb", "x", "y")
    return flat.mapInArrow(check, "ua long, ub long, va long, vb long").selectExpr(
        "named_struct('a', ua, 'b', ub) AS u", "named_struct('a', va, 'b', vb) AS v")


def rare_pairs(nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (u, v) of nodes in different components that may reach ``threshold``; ``nodes``: node, component.

    Shingles are ranked by how many nodes have them, rarest first. Similar
    texts of n and m shingles share at least threshold / (1 + threshold) *
    (n + m) of them; so the first they share has no fewer from its place on,
    in either text.
    """

    def explode(batches):
        for b, part, texts in ((b, *found) for b in batches for found in text_slices(b.column("text"))):
            at, found, sizes = [], [], []
            w = Words(texts)
            for r, (i, j) in enumerate(zip(w.first, w.last, strict=True), part.start):
                s = shingles(w.hashes[i:j])
                at.append(np.full(len(s), r))
                found.append(s)
                sizes.append(np.full(len(s), len(s)))
            rows = pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays(
                [b.column("a").take(rows), b.column("b").take(rows), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(found).view(np.int64))],
                names=["a", "b", "n", "shingle"])

    own = nodes.join(texts, "node").selectExpr("node.a AS a", "node.b AS b", "text")
    rows = materialize(own.mapInArrow(explode, "a long, b long, n long, shingle long"), "near-duplicates-shingles")
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy("often", "shingle"))
    rare = (rows.join(materialize(often, "near-duplicates-often"), "shingle", "left")
            .withColumn("often", F.coalesce("often", F.lit(1))).withColumn("rank", rank)
            .where((F.col("rank") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1) & (F.col("often") > 1))
            .select(F.struct("a", "b").alias("node"), "n", (F.col("n") - F.col("rank") + 1).alias("rest"), "shingle").join(nodes, "node"))
    rare = materialize(rare, "near-duplicates-rare")
    sizes = rare.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("nodes"))
    largest = sizes.groupBy("shingle").agg(F.max_by("component", F.struct("nodes", "component")).alias("largest"))
    some = rare.join(materialize(largest, "near-duplicates-largest"), "shingle").where("component <> largest").drop("largest")
    other = rare.select("shingle", F.col("node").alias("v"), F.col("n").alias("m"), F.col("rest").alias("left"),
                        F.col("component").alias("apart"))
    least = F.lit(threshold / (1 + threshold)) * (F.col("n") + F.col("m")) - 1e-9
    return (some.withColumnRenamed("node", "u").join(other, "shingle")
            .where(F.expr("component <> apart") & (F.col("rest") >= least) & (F.col("left") >= least))
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))


def links(docs: DataFrame, written: DataFrame, threshold: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Verified links (u, v) between different texts that connect all similar ones, and (node, component).

    ``written``: the table that ``sketches`` gives for ``docs``, written.
    """
    nodes = written.where("sketches IS NOT NULL").groupBy("a", "b").agg(F.first("sketches").alias("sketches"), F.first("n").alias("n"))
    # what a text of fewer than SHORT shingles may be similar to
    short = materialize(nodes.where(F.col("n") < SHORT / threshold).select(_node()), "near-duplicates-short")
    entries = nodes.select(_node(), F.posexplode("sketches").alias("t", "sketch")).select(
        "node", F.xxhash64("t", "sketch").alias("bucket"))
    shared = (entries.groupBy("bucket").agg(F.min("node.a").alias("low"), F.max("node.a").alias("high"), F.count(F.lit(1)).alias("size"))
              .where("low < high").select("bucket", "size"))
    # right sides are written first, here and below, so that the planner may split a hot key
    members = materialize(entries.join(materialize(shared, "near-duplicates-shared"), "bucket"), "near-duplicates-members")
    meets = members.groupBy("node").agg(F.sum("size").alias("meets"))  # how often a node meets others in buckets
    meets = materialize(meets, "near-duplicates-meets")
    members = materialize(members.select("bucket", "node").join(meets, "node"), "near-duplicates-buckets")
    a, b = fingerprint128(F.col("text"))
    texts = docs.select(text_column().alias("text")).withColumns({"a": a, "b": b})
    compares = materialize(meets.select("node").unionByName(short).distinct(), "near-duplicates-nodes")
    # most texts are compared with none: a filter of fixed size leaves them out before they travel
    texts = rows_held(texts, "a", filter_of(compares.select(F.col("node.a").alias("h")), FILTER_BYTES)).select(_node(), "text")
    texts = materialize(texts.join(compares.hint("merge"), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")),
                        "near-duplicates-texts")
    open_ = members.withColumn("component", F.col("node"))
    compared = every = found = None
    for turn in range(STARS + 1):
        if 0 < turn < STARS and open_.isEmpty():
            continue
        if turn < STARS:
            centre = materialize(open_.groupBy("bucket").agg(F.max_by(F.struct("node", "component"), F.struct("meets", "node")).alias("c")), "near-duplicates-centres")
            paired = open_.join(centre, "bucket").where("component <> c.component")
            pairs = paired.select(F.least("node", "c.node").alias("u"), F.greatest("node", "c.node").alias("v"))
        else:
            more = short if found is None else short.join(found, "node", "left")
            more = more.select("node", F.coalesce("component", "node").alias("component") if found is not None else F.col("node").alias("component"))
            pairs = rare_pairs(open_.select("node", "component").unionByName(more).distinct(), texts, threshold)
        pairs = pairs.distinct()
        pairs = materialize(pairs if compared is None else pairs.join(compared, ["u", "v"], "left_anti"), "near-duplicates-pairs")
        compared = pairs if compared is None else compared.unionByName(pairs)
        new = materialize(verify(pairs, texts, threshold), "near-duplicates-links")
        every = new if every is None else every.unionByName(new)
        found = materialize(components(every), "near-duplicates-components")
        if turn < STARS:
            # the centres are compared with all of their buckets; the others stay where components still differ
            rest = open_.drop("component").join(centre.select("bucket", F.col("c.node").alias("node")), ["bucket", "node"], "left_anti")
            rest = rest.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
            mixed = (rest.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                     .where("x <> y").select("bucket"))
            open_ = materialize(rest.join(materialize(mixed, "near-duplicates-mixed"), "bucket"), "near-duplicates-open")
    return every, found


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """doc_id, a, b, component of every row (component null for a wordless text)."""
    written = materialize(sketches(docs), "near-duplicates-sketches")
    _, found = links(docs, written, threshold)
    rows = written.select("doc_id", "a", "b", F.col("sketches").isNotNull().alias("worded"))
    return (rows.join(found.selectExpr("node.a AS a", "node.b AS b", "component"), ["a", "b"], "left")
            .withColumn("component", F.when(F.col("worded"), F.coalesce("component", F.struct("a", "b")))))


def near_duplicate_classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class), class_size of every row of ``docs``."""
    rows = materialize(_classes(docs, threshold), "near-duplicates-classes")
    sizes = materialize(rows.where("component IS NOT NULL").groupBy("component")
                        .agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "near-duplicates-sizes")
    alone = rows.where("component IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return rows.join(sizes, "component").select("doc_id", "class_id", "class_size").unionByName(alone)


def keep_one_of_each(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, but of each class only its first by doc_id (then by text hash)."""
    rows = materialize(_classes(docs, threshold), "near-duplicates-classes")
    keepers = (rows.where("component IS NOT NULL").groupBy("component")
               .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "a", "b")).alias("k"))
               .selectExpr("k.doc_id AS _doc", "k.a AS _a", "k.b AS _b"))
    a, b = fingerprint128(text_column())
    keyed = docs.withColumns({"_a": a, "_b": b})
    worded = F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]")
    kept = keyed.where(worded).join(keepers, ["_a", "_b"]).where(F.col("doc_id").eqNullSafe(F.col("_doc"))).drop("_doc")
    one = kept.withColumn("_n", F.row_number().over(Window.partitionBy("_a", "_b").orderBy("doc_id"))).where("_n = 1")
    return one.select(*[f"`{c}`" for c in docs.columns]).unionByName(
        docs.where(F.coalesce(~worded, F.lit(True))))
