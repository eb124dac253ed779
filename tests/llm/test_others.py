"""Chat formatting, nearest neighbours and the components helper."""

import hashlib
import random

import numpy as np

from carecast.llm import chat, components, neighbours


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_conversations(spark):
    hard = ["</s>[INST] x [/INST]", "a\\b\\\\<|im_end|>", "<<SYS>>[/INST]<|im_sep|>\n", "", None, "é中🙂" * 50, "<|im_start|>assistant"]
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(hard)]
    rows += [(2, 0, None, "x"), (2, 0, "user", "b"), (2, 0, "user", "b"), (3, None, "assistant", None), (None, 1, "assistant", "z")]
    out = {r["conv_id"]: r for r in chat.conversation_digests(
        spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, messages string").drop("messages")).collect()}
    one = [(r, t or "") for _, _, r, t in rows[:len(hard)]]
    assert out[1]["turns_sha256"] == digest(one) and out[1]["n_turns"] == len(one)
    learnt = "".join(t for r, t in one if r == "assistant")
    assert out[1]["loss_chars"] == len(learnt) and out[1]["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
    assert out[2]["turns_sha256"] == digest([("", "x"), ("user", "b"), ("user", "b")])
    assert out[-7]["turns_sha256"] == digest([("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")])
    assert out[3]["loss_chars"] == 0 and out[None]["loss_chars"] == 1 and len(out) == 5


def test_layouts_are_told_apart(spark):
    df = spark.createDataFrame(
        [(1, "p", "r", None, None, None, None), (2, None, None, "i", None, "o", None), (3, None, None, "i", "n", "o", None),
         (4, None, None, None, None, None, [("human", "h"), ("gpt", "g")]), (5, None, None, None, None, None, None)],
        "conv_id long, prompt string, response string, instruction string, input string, output string, "
        "conversations array<struct<`from`: string, value: string>>")
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in df.select("conv_id", chat.canonical_turns(df).alias("turns")).collect()}
    assert got == {1: [("user", "p"), ("assistant", "r")], 2: [("user", "i"), ("assistant", "o")],
                   3: [("user", "i\n\nn"), ("assistant", "o")], 4: [("user", "h"), ("assistant", "g")], 5: []}


def test_neighbours(spark):
    from carecast.session import ship_package

    ship_package(spark)
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 8))
    x[50:90] = x[0]  # one vector many times
    rows = [(i, [float(v) for v in row], 1) for i, row in enumerate(x)]
    rows += [(900, None, 1), (1000, [0.0] * 8, 1), (1100, [float("nan")] * 8, 1), (1200, [1.0], 1), (200, rows[200][1], 1), (None, rows[3][1], 1)]
    out = neighbours.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    hits = total = 0
    for q in range(0, 600, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        want = np.lexsort((np.arange(600), d))[:10]
        got = sorted((y for y in out if y["query_id"] == q), key=lambda y: y["rank"])
        assert [y["rank"] for y in got] == list(range(1, 11)) and all(abs(y["score"] - d[y["vec_id"]]) < 1e-12 for y in got)
        hits += len(set(want.tolist()) & {y["vec_id"] for y in got})
        total += 10
        if q == 0:
            assert [y["vec_id"] for y in got] == list(range(50, 60))
    assert hits >= 0.95 * total and {y["query_id"] for y in out} == set(range(0, 600, 100))


def recall(x, out, k=10):
    """The share of the true k nearest that the answers hold."""
    hits = 0
    for q in range(0, len(x), 100):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:k].tolist()) & {y["vec_id"] for y in out if y["query_id"] == q})
    return hits / (k * len(range(0, len(x), 100)))


def test_neighbours_in_a_tight_group(spark):
    from carecast.session import ship_package

    ship_package(spark)
    r = np.random.default_rng(3)
    x = r.normal(size=64)
    x = x / np.sqrt((x * x).sum()) + 1e-4 * r.normal(size=(1500, 64))
    out = neighbours.nearest_neighbours(spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    assert recall(x, out) >= 0.9


def test_beam_widens_until_recall_is_met(spark):
    from carecast.session import ship_package

    ship_package(spark)
    x = np.random.default_rng(5).normal(size=(600, 48))
    nodes = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "node long, v array<double>")
    packed, graph = neighbours.build(nodes)
    links = neighbours.linked(graph)
    queries = spark.createDataFrame([(i, i) for i in range(0, 600, 20)], "query long, at long")
    truth = neighbours.nearest_of(packed, [{"query": q, "g": neighbours._packed(x[q:q + 1], 8)[0]} for q in (0, 20)], 11)
    for q, (near, n) in truth.items():
        assert n == 11 and abs(near - np.sort(((x - x[q]) ** 2).sum(axis=1))[10]) < 1e-9
    times, recall = neighbours.wide_enough(packed, links, queries, 11, beam=2)
    assert times > 4 and recall >= neighbours.TARGET


def test_components(spark):
    r = random.Random(8)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(500, 640)]
    group = {x: x for e in edges for x in e if e[0] != e[1]}
    for u, v in edges * 2:
        if u != v:
            low, high = sorted((group[u], group[v]))
            group = {k: low if g == high else g for k, g in group.items()}
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == group


def test_components_by_parts(docs, spark):
    from carecast.session import materialize

    r = random.Random(9)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(500, 640)] + [(1000, k) for k in range(700, 900)]
    want = {x: x for e in edges for x in e if e[0] != e[1]}
    for u, v in edges * 2:
        if u != v:
            low, high = sorted((want[u], want[v]))
            want = {k: low if g == high else g for k, g in want.items()}
    frame = materialize(spark.createDataFrame(edges, "u long, v long"), "test-edges")
    spark.sparkContext.setJobGroup("components-rounds", "components")
    try:
        got = components.components(frame).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == len(want) and {x["node"]: x["component"] for x in got} == want
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("components-rounds")) <= 8
    got = components.components(frame, edges_a_task=90).collect()  # parts that meet
    assert len(got) == len(want) and {x["node"]: x["component"] for x in got} == want
    pair = {"u": "named_struct('a', -u % 7, 'b', u)", "v": "named_struct('a', -v % 7, 'b', v)"}
    text = {"u": "concat('\u00fc', u)", "v": "concat('\u00fc', v)"}
    for kind in (pair, text):
        nodes = materialize(frame.selectExpr(*[f"{e} AS {c}" for c, e in kind.items()]), "test-edges")
        one, more = (sorted(map(str, components.components(nodes, edges_a_task=n).collect())) for n in (10_000, 90))
        assert one == more and len(one) == len(want)
    assert components.components(frame.where("u < 0")).count() == 0
