"""Token counts by a compiled finite-state transducer of a byte-level BPE tokenizer.

The tokenizer file (vocabulary, merges, added tokens) is compiled into a
deterministic transducer over bytes. Its state is what the tail of the current
pre-token can still contribute: the longest suffix that begins some token,
with the last token and the relative token count at each of its positions.
Reading a byte moves to the next state and emits the change of the token
count, ``N(prefix + byte) - N(prefix)``, so a text's count is the sum of what
its bytes emit. Only finitely many states exist; they are determinised when a
text first needs them (as lazy regular-expression automata are), and the table
is dropped and rebuilt beyond ``MAX_STATES``.

A batch of texts is one byte stream cut into equal chunks. A chunk's map from
entry state to (exit state, count) splits at its first pre-token start: before
it the map depends on the entry state, after it it is constant. All chunks run
in lock step from their first start; then the maps are composed in a scan that
hands every chunk its entry state, and the heads are run. A chunk inside one
very long pre-token has no start and is run once its entry state is known.

Pre-token starts follow the byte-level splitting rule, with the character
classes (letter, number, space, other) probed from the tokenizer itself the
first time a character occurs. Special strings are cut out first and count
one each, as the tokenizer library does by default.

Defined cases: a null text is empty and has 0 bytes and 0 tokens; repeated
rows give one output row each; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, text_column

CHUNK = 2048
MAX_STATES = 300_000
OTHER, LETTER, NUMBER, SPACE, UNKNOWN = 0, 1, 2, 3, 255
EMIT_BIAS = 512
EMIT_BITS = 10
EMIT_MASK = (1 << EMIT_BITS) - 1
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")  # fixed values: contractions of the splitting rule


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others move above U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    table.update({chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return table


class Transducer:
    """The compiled tokenizer of one Python worker."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"], pre.get("type"), spec["normalizer"]) != ("BPE", "ByteLevel", None) or pre.get("add_prefix_space"):
            raise ValueError("only byte-level BPE without normalizer and prefix space can be compiled")
        self.library = Tokenizer.from_file(path)
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or match whole words are not compiled")
        back = _byte_letters()
        as_bytes = lambda s: bytes(back[c] for c in s)
        added = set(self.specials)
        self.letters = {as_bytes(t): t for t in model["vocab"] if t not in added}  # a token's bytes: its spelling
        self.vocab = {t: t for t in self.letters}
        self.prefixes = {p: p for t in self.vocab for p in (t[:i] for i in range(1, len(t) + 1))} | {b"": b""}
        self.extends = {t[:i] for t in self.vocab for i in range(len(t))}  # proper prefixes of tokens
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.alone: dict[bytes, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.table = np.full((1024, 128), -1, np.int32)  # states x symbols; a byte becomes a symbol when it first occurs
        self.symbols = np.full(256, -1, np.int32)
        self.bytes: list[int] = []
        self.keys: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self._number((b"", (None,), (0,)))  # state 0: at a pre-token's start

    # ------------------------------------------------------------ compilation
    def _stands(self, token: bytes) -> bool:
        if token not in self.alone:
            self.alone[token] = len(self.library.model.tokenize(self.letters[token])) == 1
        return self.alone[token]

    def _follows(self, last: bytes, token: bytes) -> bool:
        """Whether ``token`` may come right after ``last`` in an encoding."""
        key = (last, token)
        if key not in self.fits:
            if len(self.fits) > 400_000:
                self.fits.clear()
            found = self.library.model.tokenize(self.letters[last] + self.letters[token])
            self.fits[key] = len(found) == 2 and found[0].value == self.letters[last]
        return self.fits[key]

    def _number(self, key: tuple) -> int:
        if key not in self.numbers:
            self.numbers[key] = len(self.keys)
            self.keys.append(key)
            if len(self.keys) > len(self.table):
                self.table = np.concatenate([self.table, np.full((len(self.table) // 4, self.table.shape[1]), -1, np.int32)])
        return self.numbers[key]

    def step(self, state: int, byte: int) -> int:
        """Next state and emission of one transition, packed; kept in the table."""
        tail, lasts, counts = self.keys[state]
        tail += bytes((byte,))
        for start, last in enumerate(lasts):
            if last != b"" and (token := self.vocab.get(tail[start:])) and self._stands(token) and (last is None or self._follows(last, token)):
                count = counts[start] + 1
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        cut = 0
        while tail[cut:] not in self.prefixes:
            cut += 1
        tail = self.prefixes[tail[cut:]]
        new_lasts, new_counts = [], []
        for i, (last, c) in enumerate(zip((*lasts, token)[cut:], (*counts, count)[cut:], strict=True)):
            useful = last != b"" and tail[i:] in self.extends  # else no token can go on from there
            new_lasts.append(last if useful else b"")
            new_counts.append(c - count if useful else 0)
        key = (tail, tuple(new_lasts), tuple(new_counts))
        packed = self._number(key) << EMIT_BITS | (count + EMIT_BIAS)
        self.table[state, self.symbols[byte]] = packed
        return packed

    # ---------------------------------------------------------- pre-tokenizing
    def _classify(self, codes: np.ndarray) -> np.ndarray:
        found = self.classes[codes]
        if (found == UNKNOWN).any():
            split = self.library.pre_tokenizer.pre_tokenize_str
            for c in np.unique(codes[found == UNKNOWN]).tolist():
                one = chr(c)
                kind = next((k for probe, k in (("a", LETTER), ("1", NUMBER), ("!", OTHER)) if len(split(probe + one)) == 1), SPACE)
                self.classes[c] = kind
            found = self.classes[codes]
        return found

    def starts(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pre-tokens start in a run of code points; ``first`` marks where pieces start."""
        n = len(codes)
        kind = self._classify(codes)
        space = kind == SPACE
        cut = np.ones(n, bool)
        cut[1:] = kind[1:] != kind[:-1]
        cut |= first
        ends = np.append(first[1:], True)  # last of its piece
        before = np.zeros(n, bool)  # the character right before is a plain blank of the same piece
        before[1:] = (codes[:-1] == 0x20) & ~first[1:]
        cut &= ~(before & ~space)  # one blank goes with what follows it
        text_next = np.zeros(n, bool)
        text_next[:-1] = ~space[1:]
        cut |= space & text_next & ~ends  # the last white space before text stands apart from the run
        quotes = np.flatnonzero((codes == 0x27) & cut)  # contractions start at a pre-token's quote
        for q in quotes.tolist():
            for s in SUFFIXES:
                stop = q + 1 + len(s)
                if stop <= n and not first[q + 1:stop].any() and all(codes[q + 1 + i] == ord(ch) for i, ch in enumerate(s)):
                    cut[q + 1] = False
                    if stop < n and not space[stop]:
                        cut[stop] = True
                    break
        return cut

    # ---------------------------------------------------------------- running
    def _run(self, state: np.ndarray, symbols: np.ndarray, fresh: np.ndarray, head: np.ndarray, inside: bool) -> tuple:
        """Advance all lanes over (steps x lanes) symbols; gives the exit states and what each byte emits.

        A lane is live in its head if ``inside``, else after it.
        """
        out = np.zeros(symbols.shape, np.int16)
        masked = len(symbols) if inside else int(head.max(initial=0))
        flat, width = self.table.reshape(-1), self.table.shape[1]
        for k in range(len(symbols)):
            live = None if k >= masked else (k < head if inside else k >= head)
            at = np.where(fresh[k], 0, state) * width + symbols[k]
            packed = flat[at]
            missing = packed < 0
            if live is not None:
                missing &= live
            if missing.any():
                for key in np.unique(at[missing]).tolist():
                    self.step(key // width, self.bytes[key % width])
                flat = self.table.reshape(-1)
                packed = flat[at]
            emitted = (packed & EMIT_MASK) - EMIT_BIAS
            if live is None:
                state, out[k] = packed >> EMIT_BITS, emitted
            else:
                state, out[k] = np.where(live, packed >> EMIT_BITS, state), np.where(live, emitted, 0)
        return state, out

    def emissions(self, data: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """What each byte emits, for a byte stream with pre-token starts marked (the first byte is one)."""
        if len(self.keys) > MAX_STATES:
            self.reset()
        n = len(data)
        lanes = max(1, -(-n // CHUNK))
        pad = lanes * CHUNK - n
        for b in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
            if self.symbols[b] < 0:
                self.symbols[b] = len(self.bytes)
                self.bytes.append(b)
                if len(self.bytes) > self.table.shape[1]:
                    self.table = np.pad(self.table, ((0, 0), (0, 128)), constant_values=-1)
        symbols = np.append(self.symbols[data], np.zeros(pad, np.int32)).astype(np.uint8)
        symbols = np.ascontiguousarray(symbols.reshape(lanes, CHUNK).T)
        fresh = np.ascontiguousarray(np.append(fresh, np.ones(pad, bool)).reshape(lanes, CHUNK).T)
        has = fresh.any(axis=0)
        head = np.where(has, fresh.argmax(axis=0), CHUNK)  # bytes before the first start
        out = np.zeros((CHUNK, lanes), np.int16)
        # 1. every chunk from its first start on: the constant part of its map
        rows = np.flatnonzero(has)
        exits = np.full(lanes, -1, np.int64)
        exits[rows], out[:, rows] = self._run(np.zeros(len(rows), np.int64), symbols[:, rows], fresh[:, rows], head[rows], False)
        # 2. composition: heads whose entry state is known, until all are
        todo = np.flatnonzero(head > 0)
        while len(todo):
            entry = exits[todo - 1]
            known = entry >= 0
            now = todo[known]
            longest = int(head[now].max())
            state, emitted = self._run(entry[known], symbols[:longest, now], np.zeros((longest, len(now)), bool), head[now], True)
            out[:longest, now] += emitted
            whole = ~has[now]
            exits[now[whole]] = state[whole]
            todo = todo[~known]
        return out.T.reshape(-1)[:n]

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and tokens of each text."""
        pieces, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            found = [t]
            for s in self.specials:
                if s in t:
                    found = [p for x in found for p in x.split(s)]
                    extra[i] += t.count(s)
            for p in found:
                if p:
                    pieces.append(p)
                    owner.append(i)
        n_bytes = np.array([len(t.encode()) for t in texts], np.int64)
        if not pieces:
            return n_bytes, extra
        sizes = np.array([len(p) for p in pieces])
        joined = "".join(pieces)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        first = np.zeros(len(codes), bool)
        ends = np.cumsum(sizes)
        first[np.append(0, ends[:-1])] = True
        cut = self.starts(codes, first)
        data = np.frombuffer(joined.encode(), np.uint8)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        fresh = np.zeros(len(data), bool)
        fresh[lead] = cut
        emitted = np.append(0, np.cumsum(self.emissions(data, fresh)))
        stops = np.append(lead, len(data))[ends]
        counts = emitted[stops] - emitted[np.append(0, stops[:-1])]
        return n_bytes, extra + np.bincount(owner, counts, len(texts)).astype(np.int64)


_COMPILED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The worker's transducer for a tokenizer file; compiled once a process."""
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(docs: DataFrame, limit: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row of ``docs``."""
    path = tokenizer or default_tokenizer()

    def fn(texts: list[str]) -> pd.DataFrame:
        n_bytes, n_tokens = transducer(path).count(texts)
        return pd.DataFrame({"n_bytes": n_bytes, "n_tokens": n_tokens})

    counted = map_texts(docs.select("doc_id", text_column().alias("text")), fn, "n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
