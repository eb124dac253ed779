"""Every stage of the pipeline on awkward tables, and the pipeline as a whole."""

import os
import uuid
from collections import Counter

import corpus_pipeline
import pytest
from samples import EDGES, prose

from carecast.session import shared_dir

LABELS = "doc_id long, quality int, toxic int, lang string"


@pytest.fixture
def folder(spark):
    def make(frame, labels):
        path = os.path.join(shared_dir(spark), f"tables-{uuid.uuid4().hex[:8]}")
        frame.write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
        return path

    return make


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_edges(spark, docs, folder, name, stage):
    frame = docs(EDGES, sources=("a", None, "b"))
    labels = [(5, 1, 0, "en"), (7, 0, 1, None), (None, 1, None, None), (8, None, 0, "en"), (404, 1, 0, "en")]
    for df in (frame, docs([])):
        sf_dir = folder(df, labels)
        out = stage(spark, df, sf_dir)
        rows = out.collect()
        if stage is corpus_pipeline.pack_sequences:
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in df.collect()}
        else:
            assert out.columns == df.columns and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in df.collect()}


def test_near_duplicates_write_few_tables(spark, docs):
    texts = [prose(i, 60) for i in range(40)]
    near = [f"{texts[0]} {prose(700 + k, 3)}" for k in range(30)] + [f"{prose(800 + k, 4)} {texts[1]}" for k in range(30)]
    frame = docs(list(enumerate(texts + near + texts[:10])))
    before = set(os.listdir(shared_dir(spark)))
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, "").collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(40))
    written = Counter(name.rsplit("-", 1)[0] for name in set(os.listdir(shared_dir(spark))) - before)
    assert sum(written.values()) <= 32, written


def test_pipeline(spark, docs, folder):
    clean = [(i, prose(i, 60)) for i in range(200)]
    junk = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(i, 60).split())) for i in range(60)]
    shared = "\n".join(prose(9000 + k, 12) for k in range(3))
    passage = [(2000, f"{prose(501, 80)}\n{shared}"), (2001, f"{prose(502, 80)}\n{shared}")]
    copies = [(3000 + i, clean[0][1]) for i in range(40)]
    frame = docs(clean + junk + passage + copies, sources=("a", "b", None))
    sf_dir = folder(frame, [(i, int(i < 1000 or i >= 2000), 0, "en") for i, _ in clean + junk + passage])
    kept, sizes = frame, []
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = spark.createDataFrame(stage(spark, kept, sf_dir).collect(), frame.schema)
        sizes.append(kept.count())
    ids = Counter(r["doc_id"] for r in kept.collect())
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(ids.values()) == {1} and sum(i < 200 for i in ids) >= 198 and not any(i >= 3000 for i in ids)
    assert sum(1000 <= i < 2000 for i in ids) <= 2
    assert shared in texts[2000] and shared not in texts[2001]
    before = set(os.listdir(shared_dir(spark)))
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    left = set(os.listdir(shared_dir(spark))) - before  # only the result
    assert len(left) == 1 and left.pop().startswith("pipeline-best-fit-packing-")
    assert {r["doc_id"] for r in packed} <= set(ids)
    filled = Counter()
    for r in packed:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 4096 and len(filled) <= -(-sum(filled.values()) // 4096) + 1
