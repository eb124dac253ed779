"""Spelling variants, phrase collocations, SentencePiece ids."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import sentencepiece

from carecast.llm import phrases, registry, sentence_pieces, spelling
from carecast.llm.common import read
from tests.conftest import SMALL_SF

from samples import EDGES, prose

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_model())


# ------------------------------------------------------------------ spelling
def lowered(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t)


def one_edit(a, b):
    """Whether a becomes b by exactly one edit of a code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants(rows):
    words = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            words[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    words = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    form = {w: (min(v, key=lambda x: (-words[x], x)) if (v := near[w]) else None) for w in words}
    form = {w: f if f and words[f] >= 2 * words[w] else None for w, f in form.items()}
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def as_variants(df):
    rows = df.collect()
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(found) == len(rows)
    return found


def vocabulary(seed, n):
    """Rows of words that share long beginnings and ends, with misspellings of misspellings."""
    r = random.Random(seed)
    stems = ["interna", "überein", "abcabca", "aaaaaaa", "straßen"]
    rows = []
    for k in range(n):
        w = list(r.choice(stems) + r.choice(["tional", "lization", "abcab", "aaaa", ""]))
        for at in sorted(r.sample([0, 3, 4, len(w) - 1], r.choice([0, 0, 0, 0, 0, 1, 1, 2])), reverse=True):
            w[at:at + r.choice([1, 1, 0])] = r.choice(["", "a", "b", "é"])
        rows.append((k % 7 if k % 5 else None, " ".join(["".join(w)] * r.choice([1, 1, 2, 4, 9])) + r.choice(["", "-x", "1", " Ab×c÷d"])))
    return rows


def test_variants_of_a_hard_vocabulary(docs):
    rows = vocabulary(4, 700) + EDGES
    want = variants(rows)
    chains = [w for w, v in want.items() if v[0] and v[0] != v[1]]
    assert len(want) > 100 and chains and max(v[3] for v in want.values()) > 5
    assert as_variants(spelling.spelling_variants(docs(rows))) == want


def test_large_chunk_groups_grow_without_losing_pairs(docs):
    words = spelling.word_counts(docs(vocabulary(9, 900)))
    pairs = [{(r["word"], r["near"]) for r in spelling.near_pairs(words, group_pairs=limit).collect()} for limit in (10_000, 1)]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 50


def test_variants_of_no_words(docs):
    assert as_variants(spelling.spelling_variants(docs([]))) == {}
    assert as_variants(spelling.spelling_variants(docs([(1, None), (2, "ab cd 12 ÷×÷×÷×")]))) == {}
    assert as_variants(spelling.spelling_variants(docs([(1, "wordy " * 40)]), one_in=1 << 40)) == {"wordy": (None, "wordy", 40, 0, None)}


# ------------------------------------------------------------------- phrases
def collocations(rows, support, top=2000):
    """rows: (lang, text). What the contract says, by counting everything."""
    f, n = Counter(), Counter()
    for lang, t in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0A-\x0D]", lowered(t or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= support}
    covered = set()
    for p, a in found.items():
        for m in range(2, len(p) - 1):
            for i in range(1, len(p) - m + 1):
                inner = (p[0], *p[i:i + m])
                if 100 * a >= 80 * f[inner]:
                    covered.add(inner)
    ranked = []
    for p, a in found.items():
        if p not in covered:
            score, k = min((2_000_000 * a // (f[p[:1 + k]] + f[(p[0], *p[1 + k:])]), k) for k in range(1, len(p) - 1))
            ranked.append((p[0], -score, -a, " ".join(p[1:]).encode(), f[p[:1 + k]], f[(p[0], *p[1 + k:])]))
    out, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(ranked):
        place[lang] += 1
        if place[lang] <= top:
            out.append((lang, place[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return out


def spoken(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "red", "cat", "öl", "中", "a b", "x-y", "sat"]
    rows = []
    for k in range(n):
        t = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ";"]) for _ in range(r.randrange(60)))
        rows.append((("en", "de", None, "und")[k % 4 if k % 3 else 0], t))
    return rows + [("en", None), ("en", ""), (None, " \t\n"), ("fr", "the red cat"), ("en", "the red cat sat " * 300), ("en", "no " * 9000)]


def as_rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def phrase_docs(spark, rows):
    return spark.createDataFrame([(k, lang, t, "x", 1) for k, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, phrase string, n int")


def test_collocations_equal_plain_counting(spark, docs):
    rows = spoken(2, 160)
    for support, shards, top in ((30, 6, 2000), (7, 3, 5), (30, 1, 2000)):
        want = sorted(collocations(rows, support, top))
        assert len(want) > 10
        assert as_rows(phrases.collocations(phrase_docs(spark, rows), support=support, shards=shards, top=top)) == want
    # a filter so small that it lets nearly everything through changes nothing
    assert as_rows(phrases.collocations(phrase_docs(spark, rows), filter_bytes=64)) == sorted(collocations(rows, 30))


def test_phrases_across_slices_and_blocks(spark, docs):
    texts = [t or "" for _, t in spoken(5, 40)]
    whole = phrases.Block(["".join(texts).replace("\n", " ")], True)
    before = phrases.SLICE_CHARS
    try:
        phrases.SLICE_CHARS = 50
        cut = phrases.Block(["".join(texts).replace("\n", " ")], True)
    finally:
        phrases.SLICE_CHARS = before
    for name in ("hashes", "checks", "fresh", "starts", "ends", "letters"):
        assert np.array_equal(getattr(whole, name), getattr(cut, name)), name
    first = whole.runs(3)
    assert whole.texts(first, 3).to_pylist() == cut.texts(first, 3).to_pylist()


def test_collocations_of_nothing(spark, docs):
    assert as_rows(phrases.collocations(phrase_docs(spark, []))) == []
    assert as_rows(phrases.collocations(phrase_docs(spark, [("en", None), (None, " ")]))) == []
    assert as_rows(phrases.collocations(phrase_docs(spark, [(None, "Go on! " * 30)]))) == [("und", 1, "go on", 30, 30, 30, 60, 1_000_000)]


# ------------------------------------------------------------ sentence pieces
def expected(t):
    ids = LIBRARY.encode(t or "")
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), digest(",".join(map(str, ids))), digest(LIBRARY.decode(ids))


def test_ids_and_texts_equal_the_library(spark):
    texts = dict(read(spark, SMALL_SF, "documents").select("doc_id", "text").collect())
    got = {r["doc_id"]: tuple(r)[1:] for r in registry.queries()["op13_sentence_pieces"](spark, SMALL_SF).collect()}
    assert got == {i: expected(t) for i, t in texts.items()}


def test_ids_of_edge_cases(docs):
    hard = [t for _, t in EDGES] + ["</s><s> <unk> <0x41>", " ", "   x", "▁▁a ▁", "\x00\t\n ", "🙂" * 200, "a" * 30_000, " " * 5000, "=*" * 9000,
                                   "word" * 20_000, prose(3) * 3000, "é́ﬁ"]
    rows = sentence_pieces.round_trip_digest(docs([(k, t) for k, t in enumerate(hard)])).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == {k: expected(t) for k, t in enumerate(hard)}
    assert sentence_pieces.round_trip_digest(docs([])).count() == 0


def test_random_strings_and_ids():
    own, r = sentence_pieces.pieces(sentence_pieces.default_model()), random.Random(6)
    signs = list("abcdefghinorstu  ▁eet -=#_\n\t019éüßñ中文🙂АБв<>/") + ["   ", "the", "ing", "</s>"]
    for k in range(6000):
        t = " " * (r.randrange(70) if k % 3 == 0 else 0) + "".join(r.choice(signs) for _ in range(r.randrange(1, 40)))
        ids = np.frombuffer(own.encode(t), np.int32)
        assert ids.tolist() == LIBRARY.encode(t) and own.decode(ids) == t.replace("▁", " ")
    for _ in range(6000):
        ids = [r.randrange(32_000) if r.random() < 0.5 else r.randrange(262) for _ in range(12)]
        assert own.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids)


def test_own_columns_pass_through(spark, docs):
    df = spark.createDataFrame([(1, "a b", [7], "t"), (2, None, None, None)], "doc_id long, text string, ids array<int>, `odd name` string")
    encoded = sentence_pieces.encode(df)
    rows = sentence_pieces.decode(encoded).orderBy("doc_id").collect()
    assert encoded.columns == ["doc_id", "odd name", "ids"] and rows[0]["text"] == "a b" and rows[0]["odd name"] == "t" and rows[1]["text"] == ""
    none = spark.createDataFrame([(None,)], "ids array<int>")
    assert sentence_pieces.decode(none).first()["text"] == ""
