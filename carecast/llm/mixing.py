"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents fall into blocks within their source by a hash; blocks are drawn
whole, so that the mix is decided on block totals. A source whose target is
1.4 times its size is drawn once in full and 0.4 times in part: every pass
over a source takes its blocks in another random order, and the last pass
stops at the target, inside its last block at a document.

The draws of all sources are dealt to output shards by a splitting tree: at
each node the left half of the shards gets a multivariate-hypergeometric share
of the node's draws by source, the right half the rest. Each shard walks its
own path from the root, with draws seeded by the node, so shards find their
quotas and offsets in parallel and agree without talking. A source's i-th draw
goes to the shard whose quota range holds i: shards draw disjoint permuted
blocks, then shuffle their rows locally.

The last block of a source is cut at a row's hash, and one more row may fill
what is then missing, so whether a row is drawn
follows from its own source, block and hash: the draws (at most ``MOST_BLOCKS``
blocks over all sources, however large the data) are all that a mix has to
share, and any copy of the rows can be mixed without joining on their ids.
Only totals by source reach the driver: the sources of a mix are its
configuration, few beside the data.

Defined cases: null text has size 0; a null source is a source of its own,
ordered last; documents of size 0 go with their block; repeated rows share a
block and are drawn alike, each for itself; an empty table or one of no words
gives no draws (taken 0, target 0); extra columns ride along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, materialize, text_column

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_REPEATS = 2.0
BLOCK_WORDS = 50_000
LEAST_BLOCKS = 32
MOST_BLOCKS = 65_536
SHARD_BLOCKS = 64
SEED = 20_240_607


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST_REPEATS) -> list[float]:
    """Shares of ``total`` by weight, each at most ``most`` times its size; the excess is shared again."""
    out = [0.0] * len(sizes)
    open_, left = [i for i in range(len(sizes)) if sizes[i] > 0], float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def split_path(shard: int, shards: int, draws: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The draws of each source that fall to ``shard``, and how many go to the shards before it.

    A node is a range of shards; its left half has room for its share of all
    draws, and gets a hypergeometric mix of the node's draws by source.
    """
    low, high, node = 0, shards, 1
    quota, offset = draws.astype(np.int64), np.zeros(len(draws), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        room = int(quota.sum()) * (middle - low) // (high - low)
        rng = np.random.default_rng([seed, node])
        left = hypergeometric(rng, quota, room)
        if shard < middle:
            quota, high, node = left, middle, 2 * node
        else:
            quota, offset, low, node = quota - left, offset + left, middle, 2 * node + 1
    return quota, offset


def hypergeometric(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """A multivariate-hypergeometric draw of ``n`` from ``counts``, source by source."""
    out, rest = np.zeros(len(counts), np.int64), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        rest -= c
        if n <= 0:
            break
        if rest + c > 900_000_000:  # beyond numpy's range the draw's mean is exact to 1e-4 of its size
            k = round(n * c / (rest + c))
        else:
            k = int(rng.hypergeometric(c, rest, min(n, c + rest))) if c else 0
        k = max(min(k, c, n), n - rest)
        out[i], n = k, n - k
    return out


def _key(source: str = "source") -> Column:
    return F.when(F.col(source).isNotNull(), F.concat(F.lit("s"), F.col(source).cast("string"))).otherwise("-")


def _tie() -> Column:
    return F.xxhash64("doc_id", text_column())


def _block(n_blocks: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "_tie"), n_blocks)


def _cut_order() -> Column:
    return F.xxhash64(F.lit(7), "_tie")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, _key (of the source), _tie (a hash of the row's id and text) and size (its words)."""

    def fn(texts: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"size": [len(t.encode("utf-8", "surrogatepass").split()) for t in texts]}, dtype="int64")

    rows = docs.select("doc_id", _key().alias("_key"), _tie().alias("_tie"), text_column().alias("text"))
    return map_texts(rows, fn, "size long")


@dataclass(frozen=True)
class Plan:
    """What a mix draws: ``sources`` (_key, source_size, target, n_blocks), ``draws`` (_key, _block, drawn)."""

    sources: DataFrame
    draws: DataFrame
    seed: int


def plan(rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS,
         block_words: int = BLOCK_WORDS, seed: int = SEED) -> Plan:
    """The draws of a mix of ``rows`` (as ``sized`` gives them).

    ``drawn`` lists a block's draws as (pass, shard, bound, extra); the bound
    is null for a block taken whole, else rows up to that hash are taken, and
    the one whose hash is ``extra``.
    """
    spark = rows.sparkSession
    found = rows.groupBy("_key").agg(F.sum("size").alias("words")).collect()  # a row per source
    found = sorted(((r["_key"], int(r["words"] or 0)) for r in found), key=lambda r: (r[0] == "-", r[0]))
    sizes = [w for _, w in found]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share * sum(sizes), most)
    unit = max(block_words, -(-sum(sizes) // MOST_BLOCKS))
    sources = spark.createDataFrame(
        [(k, w, t, max(LEAST_BLOCKS, -(-w // unit)), i) for i, ((k, w), t) in enumerate(zip(found, goal, strict=True))],
        "_key string, source_size long, target double, n_blocks long, number int")
    keyed = rows.join(F.broadcast(sources), "_key").withColumn("_block", _block(F.col("n_blocks"), seed))
    blocks = materialize(keyed.groupBy("_key", "number", "source_size", "target", "_block").agg(F.sum("size").alias("words")),
                         "mixing-blocks")
    # every pass takes a source's blocks in an order of its own, until the target is reached
    passes = blocks.where("words > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max(0, int(np.ceil(most)) - 1)))))
    order = Window.partitionBy("_key", "pass").orderBy(F.xxhash64(F.lit(seed), "_key", "pass", "_block"), "_block")
    passes = (passes.withColumn("n", F.row_number().over(order))
              .withColumn("before", F.col("pass") * F.col("source_size") + F.sum("words").over(order) - F.col("words"))
              .where("before < target"))
    passes = (passes.withColumn("cut", F.when(F.col("before") + F.col("words") > F.col("target"), F.col("target") - F.col("before")))
              .withColumn("draw", F.row_number().over(Window.partitionBy("_key").orderBy("pass", "n")) - 1))
    passes = materialize(passes.select("_key", "number", "_block", "pass", "draw", "cut"), "mixing-passes")
    # the one cut block of each source: rows by hash as far as they fit, and the row nearest to what is then missing
    upto = Window.partitionBy("_key").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    rows_cut = (keyed.join(passes.where("cut IS NOT NULL").select("_key", "_block", "cut"), ["_key", "_block"])
                .groupBy("_key", "cut", _cut_order().alias("h")).agg(F.sum("size").alias("size"))
                .withColumn("upto", F.sum("size").over(upto)))
    ends = rows_cut.groupBy("_key").agg(
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("cut"), F.col("h"))), F.lit(-(1 << 63))).alias("bound"),
        F.min(F.col("cut") - F.when(F.col("upto") <= F.col("cut"), F.col("upto")).otherwise(0)).alias("rest"))
    miss = F.abs(F.col("size") - F.col("rest"))
    bounds = (rows_cut.join(ends, "_key").groupBy("_key", "bound")
              .agg(F.min_by("h", F.when((F.col("h") > F.col("bound")) & (miss < F.col("rest")), F.struct(miss, "h"))).alias("extra")))
    drawn = passes.join(bounds, "_key", "left").withColumn("bound", F.when(F.col("cut").isNotNull(), F.coalesce("bound", F.lit(-(1 << 63)))))
    per_source = np.zeros(len(found), np.int64)
    for r in passes.groupBy("number").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per source
        per_source[r["number"]] = r["n"]
    shards = max(1, -(-int(per_source.sum()) // SHARD_BLOCKS))

    def deal(batches):
        for pdf in batches:
            for shard in pdf["id"].tolist():
                quota, offset = split_path(shard, shards, per_source, seed)
                n = int(quota.sum())
                if n:
                    number = np.repeat(np.arange(len(quota)), quota)
                    within = np.arange(n) - np.repeat(np.cumsum(quota) - quota, quota)
                    yield pd.DataFrame({"number": number.astype("int32"), "draw": (offset[number] + within).astype("int32"), "shard": shard})

    dealt = spark.range(0, shards, 1, min(shards, 64)).mapInPandas(deal, "number int, draw int, shard long")
    drawn = (drawn.join(dealt, ["number", "draw"]).groupBy("_key", "_block")
             .agg(F.array_sort(F.collect_list(F.struct("pass", "shard", "bound", "extra"))).alias("drawn")))  # at most `most` a block
    return Plan(sources, materialize(drawn, "mixing-draws"), seed)


def with_draws(rows: DataFrame, made: Plan) -> DataFrame:
    """``rows`` (with _key and _tie) and their source's figures and ``drawn``: the (pass, shard) that take each row."""
    found = rows.join(F.broadcast(made.sources.drop("number")), "_key").withColumn("_block", _block(F.col("n_blocks"), made.seed))
    found = found.join(F.broadcast(made.draws), ["_key", "_block"], "left")  # at most 2 * MOST_BLOCKS small rows
    takes = F.filter("drawn", lambda d: d["bound"].isNull() | (_cut_order() <= d["bound"]) | _cut_order().eqNullSafe(d["extra"]))
    return found.withColumn("drawn", F.coalesce(takes, F.expr("array()"))).drop("_block", "n_blocks")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: ``docs`` as often as they are drawn, in shards, shuffled within each shard."""
    rows = materialize(sized(docs), "mixing-sizes")
    made = plan(rows, **options)
    columns = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), _key().alias("_key"), _tie().alias("_tie"))
    copies = with_draws(inner, made).select("_row", "_tie", F.explode("drawn").alias("_draw"))
    shuffled = (copies.repartition("_draw.shard")
                .sortWithinPartitions("_draw.shard", F.xxhash64(F.lit(made.seed), "_draw.shard", "_draw.pass", "_tie")))
    return shuffled.select("_row.*")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, repeats counted) of every row of ``docs``."""
    rows = materialize(sized(docs), "mixing-sizes")
    return with_draws(rows, plan(rows, **options)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("drawn")).alias("taken"))
