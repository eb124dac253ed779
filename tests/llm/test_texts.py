"""Operators on documents: defined edge cases and brute-force twins on small fixtures."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import EDGES, prose

from carecast.llm import lines, mixing, near_duplicates, packing, quality_classifier, quality_rules, spans, token_counts
from carecast.llm.hashing import Words, shingles
from carecast.llm.textstats import stats_frame


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def repeat_brute(words):
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(hit)


def test_statistics_match_brute_force():
    r = random.Random(4)
    texts = [None, "", "x", "a b " * 9, "l\nl\n\n l\nl", "# $é|中*"] + [" ".join(r.choice("abc") for _ in range(60)) for _ in range(30)]
    s = stats_frame(texts)
    for t, row in zip(texts, s.itertuples(), strict=True):
        words = (t or "").split()
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_repeat_words == repeat_brute(words)
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        kept = [x for x in (t or "").split("\n") if x.split()]
        assert row.n_dup_lines == len(kept) - len(set(kept))


def test_quality_edges(spark, docs):
    d = docs(EDGES)
    none = labels(spark, [])
    rows = quality_rules.quality_rules(d, none).collect()
    assert len(rows) == len(EDGES)
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 20)
    assert [r["base_failed"] for r in rows if r["doc_id"] == 7] == [True]
    scored = quality_classifier.quality_scores(d, none).collect()
    assert len(scored) == len(EDGES) and all(0 <= r["score"] <= 1 for r in scored)
    for r in scored:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert quality_rules.quality_rules(docs([]), none).count() == 0
    assert quality_classifier.quality_scores(docs([]), none).count() == 0


def test_trees_respect_directions():
    r = np.random.default_rng(2)
    x = r.random((800, 2))
    y = ((x[:, 0] + 0.4 * r.random(800)) < 0.6).astype(float)
    trees = quality_rules.fit_trees(x, y, [-1, 0])
    grid = np.column_stack([np.linspace(0, 1, 200), np.full(200, 0.5)])
    assert (np.diff(trees.margin(grid)) <= 1e-12).all()
    assert ((trees.score(x) >= 0.5) == (y > 0)).mean() > 0.85


def test_classifier_separates_held_out(spark, docs):
    good = [(i, prose(i, 80)) for i in range(150)]
    junk = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(i, 80).split())) for i in range(60)]
    lab = labels(spark, [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk])
    rows = quality_classifier.quality_scores(docs(good + junk), lab).where("held_out").collect()
    assert sum(r["predicted"] == int(r["doc_id"] < 1000) for r in rows) >= 0.97 * len(rows)
    assert quality_classifier.reject_low_quality(docs(good + junk), lab).columns == docs([]).columns


def test_token_counts_equal_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_counts.default_tokenizer())
    r = random.Random(9)
    letters = list(" \n\t'strvdmle!?.,-éß0123中🙂A  ") + ["'re", "'ll", "<|endoftext|>", "the", "ation"]
    rows = [t for _, t in EDGES] + ["".join(r.choice(letters) for _ in range(r.randint(1, 80))) for _ in range(300)] + ["a" * 9000, "'" * 7]
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs(list(enumerate(rows)))).collect()}
    for i, t in enumerate(rows):
        assert got[i]["n_tokens"] == len(library.encode(t or "", add_special_tokens=False).ids), t
        assert got[i]["n_bytes"] == len((t or "").encode()) and got[i]["over_limit"] == (got[i]["n_tokens"] > 1024)
    assert token_counts.token_counts(docs([])).count() == 0


def test_packing(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_tokenizer())
    rows = packing.pack(docs(EDGES)).collect()
    by = Counter()
    for r in rows:
        by[r["sequence_id"]] += r["length"]
    assert max(by.values()) <= 4096
    for s in by:
        at = 0
        for r in sorted((r for r in rows if r["sequence_id"] == s), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
    want = Counter()
    for i, t in EDGES:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((i, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())) for k in range(0, len(ids), 4096))
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert packing.pack(docs([])).count() == 0


def test_brackets_nest_within_and_between_partitions():
    r = random.Random(11)
    for _ in range(60):
        slots = np.array([r.choice((0, 0, 1, 3)) for _ in range(r.randrange(1, 40))])
        stack, want, lost = [], set(), []
        for k, s in enumerate(slots.tolist()):
            if s:
                stack += [k] * s
            elif stack:
                want.add((k, stack.pop()))
            else:
                lost.append(k)
        piece, gap, closing, opening = packing.nested(slots)
        assert set(zip(piece.tolist(), gap.tolist(), strict=True)) == want and closing.tolist() == lost and opening.tolist() == stack
        # the same, cut in parts
        cuts = sorted(r.sample(range(len(slots) + 1), min(3, len(slots))))
        bounds = list(zip([0, *cuts], [*cuts, len(slots)], strict=True))
        parts = [packing.nested(slots[a:b]) for a, b in bounds]
        got = {(p + a, g + a) for (a, _), x in zip(bounds, parts, strict=True) for p, g in zip(x[0].tolist(), x[1].tolist(), strict=True)}
        for part, low, past, other, top in packing.between([(k, len(x[2]), len(x[3])) for k, x in enumerate(parts)]):
            for i in range(low, past):
                got.add((int(parts[part][2][i]) + bounds[part][0], int(parts[other][3][top - i]) + bounds[other][0]))
        assert got == want


def best_fit_decreasing(lengths, capacity):
    import bisect

    gaps, opened = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, n)
        if k == len(gaps):
            opened += 1
            bisect.insort(gaps, capacity - n)
        else:
            bisect.insort(gaps, gaps.pop(k) - n)
    return opened


@pytest.mark.parametrize("kind", ["mixed", "long", "one length", "tiny", "two kinds"])
def test_rounds_pack_like_best_fit_decreasing(docs, spark, kind):
    from carecast.session import materialize

    r = random.Random(3)
    lengths = {"mixed": [min(4096, int(r.lognormvariate(5.5, 1.2)) + 1) for _ in range(4000)], "long": [r.randrange(900, 4097) for _ in range(3000)],
               "one length": [1400] * 2000, "tiny": [r.randrange(1, 4) for _ in range(9000)], "two kinds": [2100] * 500 + [3] * 5000}[kind]
    items = materialize(spark.createDataFrame(list(enumerate(lengths)), "at long, length long"), "test-items")
    rows = packing.place(items, 4096, rows_a_task=700).collect()
    assert sorted(x["at"] for x in rows) == list(range(len(lengths)))
    used = Counter()
    for x in sorted(rows, key=lambda x: (x["sequence"], x["offset"])):
        assert used[x["sequence"]] == x["offset"]
        used[x["sequence"]] += lengths[x["at"]]
    assert max(used.values()) <= 4096 and len(used) <= 1.005 * best_fit_decreasing(lengths, 4096) + 1


def test_a_band_that_one_task_holds_takes_one_round(docs, spark):
    from carecast.session import materialize

    r = random.Random(4)
    lengths = [min(4096, int(r.lognormvariate(5.5, 1.2)) + 1) for _ in range(4000)]
    items = materialize(spark.createDataFrame(list(enumerate(lengths)), "at long, length long"), "test-items")
    spark.sparkContext.setJobGroup("packing-rounds", "packing")
    try:
        rows = packing.place(items).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(x["at"] for x in rows) == list(range(len(lengths)))
    used = Counter()
    for x in sorted(rows, key=lambda x: (x["sequence"], x["offset"])):
        assert used[x["sequence"]] == x["offset"]
        used[x["sequence"]] += lengths[x["at"]]
    assert max(used.values()) <= 4096 and len(used) <= 1.005 * best_fit_decreasing(lengths, 4096) + 1
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("packing-rounds")) <= 6 * len(packing.edges(4096))


def test_mixing(docs):
    rows = [(i, prose(i, 20 + i % 50)) for i in range(900)] + EDGES
    d = docs(rows, sources=("x", "y", None, "z"))
    out = mixing.mixed_documents(d).collect()
    assert len(out) == len(rows)
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in out)
    for target in {r["target"] for r in out}:
        got = sum(r["taken"] for r in out if r["target"] == target)
        assert abs(got - target) <= 0.02 * target + 60
    again = mixing.mixed_documents(d.repartition(5)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    copies = mixing.mix(d)
    assert copies.columns == d.columns
    assert Counter(r["doc_id"] for r in copies.collect() if r["text"] and r["doc_id"] and r["doc_id"] > 9) == Counter(
        {r["doc_id"]: r["taken"] // r["size"] for r in out if r["taken"] and r["doc_id"] and r["doc_id"] > 9})
    assert mixing.mixed_documents(docs([])).count() == 0


def test_splitting_tree_deals_all_draws():
    draws = np.array([700, 33, 0, 5])
    for shards in (1, 2, 7, 12):
        parts = [mixing.split_path(s, shards, draws) for s in range(shards)]
        assert (sum(q for q, _ in parts) == draws).all()
        offset = np.zeros(4, int)
        for q, at in parts:
            assert (at == offset).all()
            offset += q


def test_targets_reshare():
    assert mixing.targets([100, 1000, 1000], [5, 2, 1], 3150) == pytest.approx([200, 1966.6667, 983.3333], abs=1e-3)
    assert mixing.targets([], [], 0) == [] and mixing.targets([0, 0], [5, 2], 0) == [0, 0]


def test_line_dedup(docs):
    run = "the first line of a run\nand the second one\nthird"
    rows = [(1, f"alpha beta gamma delta\n{run}\nend of one"), (2, f"{run}\n\nsome other closing words"), (3, "third\nshort"), (4, None), (5, ""),
            (6, f"{run}"), (6, f"{run}"), (None, "alpha beta gamma delta")]
    kept = {(r["doc_id"], r["text"]) for r in lines.dedup_lines(docs(rows)).collect()}
    assert (1, rows[0][1]) in kept and (2, "\nsome other closing words") in kept
    assert (3, "third\nshort") in kept and (4, None) in kept and (5, "") in kept
    assert not any(i in (6, None) for i, _ in kept)
    digest = lines.line_digest(docs(rows)).collect()
    assert Counter((r["doc_id"], r["n_lines"], r["n_deleted"]) for r in digest) == Counter(
        {(1, 5, 0): 1, (2, 4, 3): 1, (3, 2, 0): 1, (4, 0, 0): 1, (5, 0, 0): 1, (6, 3, 3): 2, (None, 1, 1): 1})
    assert {r["kept_sha256"] for r in digest if r["doc_id"] == 1} == {hashlib.sha256(rows[0][1].encode()).hexdigest()}
    assert lines.line_digest(docs([])).count() == 0


def test_span_dedup(docs):
    passage = " ".join(f"Passage {w} has quite a few words here." for w in ("one", "two", "three", "four", "five", "six", "seven"))
    rows = [(1, f"{prose(1)}. {passage} {prose(2)}"), (2, f"{prose(3)}. {passage} {prose(4)}"), (3, prose(5)), (4, None), (5, ""), (None, passage)]
    out = {r["doc_id"]: r for r in spans.span_digest(docs(rows)).collect()}
    assert set(out) == {2, None} and out[2]["first_docs"] == [1] and out[2]["n_removed"] == 7
    kept = {r["doc_id"]: r["text"] for r in spans.remove_repeated_spans(docs(rows)).collect()}
    assert "Passage" not in kept[2] and kept[2].startswith(prose(3)) and kept[2].endswith(prose(4)) and kept[1] == rows[0][1]
    assert None not in kept and kept[4] is None
    assert spans.span_digest(docs([])).count() == 0


def labelled(text):
    words, seen, out = text.split(), Counter(), []
    k = min(5, len(words))
    for i in range(len(words) - k + 1 if words else 0):
        w = tuple(words[i:i + k])
        seen[w] += 1
        out.append((w, seen[w]))
    return out


def test_shingles_are_labelled():
    text = "a b a b a b a b a b c"
    got = shingles(Words([text]).hashes)
    assert len(set(got.tolist())) == len(got) == len(set(labelled(text)))


def test_near_duplicates(docs):
    base = [prose(100 + i, 150).split() for i in range(12)]
    rows, r = [], random.Random(5)
    for i, words in enumerate(base):
        for c in range(4):
            copy = list(words)
            for _ in range(c):
                copy[r.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy)))
    rows += [(100, None), (101, ""), (102, prose(7)), (103, prose(7)), (None, prose(7))]
    out = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicate_classes(docs(rows)).collect()}
    sets = {i: set(labelled(t or "")) for i, t in rows}
    group = {i: i for i in sets if i is not None}
    ids = sorted(group)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]):
                low, high = sorted((group[x], group[y]))
                group = {k: low if v == high else v for k, v in group.items()}
    assert {k: v for k, v in out.items() if k is not None} == group and out[None] == 102
    kept = near_duplicates.keep_one_of_each(docs(rows))
    assert kept.columns == docs([]).columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(group.values()))
    assert near_duplicates.near_duplicate_classes(docs([])).count() == 0


def glued(seed, n):
    """Words without a sentence's end."""
    return prose(seed, n).replace(".", "")


def test_span_dedup_finds_glued_and_short_sentences(docs):
    rows = []
    for k in range(20):  # 51 words, their ends glued into other sentences, one short sentence or none inside
        passage = glued(300 + k, 24) + (". " if k % 2 else " ") + glued(400 + k, 27)
        rows += [(2 * k, f"{glued(500 + k, 30 + k)} {passage} {glued(600 + k, 40)}"), (2 * k + 1, f"{glued(700 + k, 25 + k)} {passage} {glued(800 + k, 33)}")]
    short = " ".join(w.upper() + "!!" for w in glued(900, 60).split())
    rows += [(100, short), (101, f"{glued(901, 20)}. {short}")]
    out = {r["doc_id"]: r for r in spans.span_digest(docs(rows)).collect()}
    assert set(out) == {2 * k + 1 for k in range(20)} | {101}
    assert all(out[2 * k + 1]["first_docs"] == [2 * k] and 32 <= out[2 * k + 1]["n_words"] <= 51 for k in range(20))
    assert out[101]["removed"] == list(range(1, 61)) and out[101]["n_words"] == 60
    kept = {r["doc_id"]: r["text"] for r in spans.remove_repeated_spans(docs(rows)).collect()}
    assert kept[101] == rows[-1][1].split(".")[0] + "." and all(kept[i] == t for i, t in rows if i not in out)
    assert all(kept[i].split()[:25] == t.split()[:25] and kept[i].split()[-33:] == t.split()[-33:] for i, t in rows if i in out and i < 100)


def test_span_that_overlaps_itself_keeps_its_first_occurrence(docs):
    out = {r["doc_id"]: r for r in spans.span_digest(docs([(1, "word " * 600)])).collect()}
    assert [tuple(r) for r in out[1]["cut"]] == [(24, 600)]


def test_span_dedup_tells_rows_of_one_id_apart(docs):
    passage = " ".join(f"Passage {w} has quite a few words here." for w in ("one", "two", "three", "four", "five", "six", "seven"))
    rows = [(None, f"{passage} {prose(1)}."), (None, f"{passage} {prose(2)}."), (None, f"{prose(3)}."), (3, f"{passage} {prose(4)}."),
            (3, f"{passage} {prose(5)}."), (3, f"{prose(6)}."), (4, f"{prose(7)}."), (4, f"{prose(7)}.")]
    out = Counter((r["doc_id"], r["n_removed"], tuple(r["first_docs"])) for r in spans.span_digest(docs(rows)).collect())
    assert out == Counter({(None, 7, (3,)): 2, (3, 7, (3,)): 1, (4, 14, (4,)): 1})
    kept = Counter((r["doc_id"], r["text"].strip()) for r in spans.remove_repeated_spans(docs(rows)).collect())
    first = [t for t in (rows[3], rows[4]) if kept[t]]
    assert len(first) == 1 and sum("Passage" in t for _, t in kept.elements()) == 1 and sum(kept.values()) == len(rows) - 1
    assert all(kept[i, f"{prose(k)}."] == 1 for i, k in ((None, 1), (None, 2), (None, 3), (3, 6), (4, 7)))


def lines_left(rows, min_chars=20):
    """Brute force: per row, its lines without every run of lines that occurs earlier and holds ``min_chars`` characters."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    texts = [[(p, x) for p, x in enumerate((rows[k][1] or "").split("\n")) if x.strip(" \t\n\r\x0b\x0c")] for k in order]
    first, lost = {}, [set() for _ in texts]
    for d, own in enumerate(texts):
        for s in range(len(own)):
            for e in range(s + 1, len(own) + 1):
                run = tuple(x for _, x in own[s:e])
                if first.setdefault(run, (d, s)) < (d, s) and sum(map(len, run)) >= min_chars:
                    lost[d].update(p for p, _ in own[s:e])
        for (p, _), (q, _) in zip(own, own[1:], strict=False):  # blank lines between two deleted ones
            if {p, q} <= lost[d]:
                lost[d].update(range(p, q))
    return {rows[k][0]: "\n".join(x for p, x in enumerate((rows[k][1] or "").split("\n")) if p not in lost[d]) for d, k in enumerate(order)}


def test_line_dedup_equals_brute_force(docs):
    r = random.Random(12)
    alphabet = ["p" * 8, "q" * 8, "r" * 8, "ab", "c", "a line of twenty-two ch", " ", "", "d" * 19]
    rows = [(k, "\n".join(r.choice(alphabet) for _ in range(r.randrange(14)))) for k in range(60)] + [(None, "q" * 8 + "\n" + "r" * 8 + "\nab\nc\nc\nc\nc\nc")]
    for min_chars in (20, 1, 57):
        want = lines_left(rows, min_chars)
        found = lines.with_lost_lines(docs(rows), min_chars).selectExpr("doc_id", "text", "_lost")
        kept = found.withColumn("kept", F.when(F.col("_lost").isNull(), F.col("text")).otherwise(lines._remaining()))
        assert {x["doc_id"]: x["kept"] for x in kept.collect()} == want


def test_a_partial_copy_elsewhere_does_not_save_a_run(docs):
    p, q, x = "p" * 8, "q" * 8, "r" * 8
    run = f"{p}\n{q}\n{x}"
    for rows in ([(2, run), (3, run)], [(1, f"{q}\n{x}"), (2, run), (3, run)], [(2, run), (2, f"z\n{q}\n{x}"), (3, run)]):
        assert {r["doc_id"]: r["n_deleted"] for r in lines.line_digest(docs(rows)).collect()}[3] == 3


@pytest.mark.parametrize("label", [0, 1])
def test_labels_of_one_kind_leave_the_base_rule(spark, docs, label):
    rows = [(k, prose(k)) for k in range(40)] + [(40, "few words"), (41, None)]
    labels = spark.createDataFrame([(k, label) for k in range(42)], "doc_id long, quality int")
    out = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.quality_rules(docs(rows), labels).collect()}
    assert all(kept == (not failed) for failed, kept in out.values()) and out[0] == (False, True) and out[40] == out[41] == (True, False)


def test_short_near_duplicates_are_never_missed(docs):
    """8 words and one more: 4 of 5 shingles are common, similarity 0.8 exactly; so for other short lengths."""
    r = random.Random(31)
    words = [f"w{k}" for k in range(4000)]
    rows, want = [], {}
    for k in range(500):
        n = r.choice([8, 8, 8, 9, 10, 12])
        own = r.sample(words, n + 1)
        rows += [(2 * k, " ".join(own[:n])), (2 * k + 1, " ".join(own))]
        want |= {2 * k: 2 * k, 2 * k + 1: 2 * k}
    rows += [(5000, "a b c d e f g"), (5001, "a b c d e f g h")]  # 3 of 4: below
    got = {x["doc_id"]: x["class_id"] for x in near_duplicates.near_duplicate_classes(docs(rows)).collect()}
    assert got == want | {5000: 5000, 5001: 5001}
