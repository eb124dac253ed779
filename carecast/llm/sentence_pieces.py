"""SentencePiece encoding and decoding with a merge-type (BPE) model.

Encoding is exact without replaying the merges of a whole text. A sequence of
pieces is the model's encoding if every piece encodes as itself and every two
neighbours, merged afresh, come out as these two again. So a search walks from
left to right: it takes the longest piece at each place (an Aho-Corasick
automaton over reversed pieces finds it for all places at once), checks it
against the piece before, and else tries the next shorter one; a place from
which nothing fits is marked in a bitfield and never tried again, which keeps
the search linear.

That rule needs an order of merges without ties. The only tied pieces are runs
of the blank sign, the last to merge of all, and no piece holds the sign after
another character. So a text splits where a blank sign follows another
character, one sign goes with the word behind it, and the run before is merged
by replay. No piece joins letters to other characters either, so words split
there too (characters for which this fails count as no letters); workers
remember words and their ids. Characters that are no piece become byte pieces.

Defined cases: a null text is empty and has no ids; ids are those of the
library without begin, end or control ids (control strings in a text are
ordinary text); decoding drops one blank at the start, control ids, and turns
bytes that are not UTF-8 into U+FFFD each; a null list of ids decodes to an
empty text; repeated rows give one row each; extra columns pass through, but for one called
ids, which encoding replaces, or text, which decoding does.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_column, text_slices

SIGN = "▁"  # stands for a blank
WINDOW = 1 << 20  # characters of a text cut into words at once
REMEMBERED = 32 << 20  # bytes of words and their ids that a worker keeps, twice: those in use and those before
LONGEST_REMEMBERED = 64  # characters
PAIRS_REMEMBERED = 400_000

_LETTER = re.compile(r"[^\W\d_]")
_WORD_START = re.compile(f"(?<!{SIGN}){SIGN}")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6  # fixed values: kinds of pieces in a model file


class Words(dict):
    """The ids of words, found on first use; words not used for a while are forgotten."""

    def __init__(self, find: Callable[[str], bytes]):
        self.find, self.before, self.held = find, {}, 0

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.find(word)
        if len(word) <= LONGEST_REMEMBERED:
            self.held += 220 + len(ids)
            if self.held > REMEMBERED:
                self.before = dict(self)
                self.clear()
                self.held = 0
            self[word] = ids
        return ids


class Pieces:
    """A model file's pieces: exact encoding of words, and the bytes behind each id."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if (model.trainer_spec.model_type, model.trainer_spec.byte_fallback) != (proto.TrainerSpec.BPE, True) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only merge-type models with byte pieces can be encoded")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
            raise ValueError("only models that keep texts as they are, with a blank in front, can be encoded")
        if kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("pieces of own kinds can't be encoded")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.byte_ids = [0] * 256
        surfaces = []  # the bytes that each id decodes to
        for i, p in enumerate(model.pieces):
            if p.type == _BYTE:
                byte = int(p.piece[3:5], 16)
                self.byte_ids[byte] = i
                surfaces.append(bytes((byte,)))
            else:
                surfaces.append({_NORMAL: p.piece.replace(SIGN, " "), _CONTROL: "", _UNKNOWN: model.trainer_spec.unk_surface}[p.type].encode())
        runs = [p for p in self.ids if not p.strip(SIGN)]
        single = [p for p in self.ids if p not in runs]
        if any(SIGN in p[1:] for p in single) or len({self.scores[p] for p in single}) < len(single) or min(map(self.scores.get, single)) <= max(map(self.scores.get, runs)):
            raise ValueError("the model's merges tie")
        if any(c not in self.ids for p in self.ids for c in p):
            raise ValueError("a piece holds a character that is no piece")
        self.backwards = ahocorasick.Automaton()
        self.standing = {p for p in [SIGN, *single] if self.merged(p) == [p]}
        for p in self.standing:
            self.backwards.add_word(p[::-1], p)
        self.backwards.make_automaton()
        self.shorter: dict[str, str | None] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        mixed = {c for p in single for k in range(1, len(p)) for c in p[k - 1:k + 1]
                 if p[k - 1] != SIGN and bool(_LETTER.match(p[k - 1])) != bool(_LETTER.match(p[k]))}
        none = re.escape("".join(sorted(c for c in mixed if _LETTER.match(c))))
        self.cut = re.compile(rf"{SIGN}*(?:[^\W\d_{none}]+|[\W\d_{none}]+?(?=[^\W\d_{none}]|{SIGN}|\Z))|{SIGN}+")
        self.words = Words(self.word)
        # surfaces end to end, to decode many ids at once
        self.surface_bytes = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_sizes = np.array([len(s) for s in surfaces], np.int64)
        self.surface_starts = np.append(0, np.cumsum(self.surface_sizes)[:-1])
        self.control = np.array([p.type == _CONTROL for p in model.pieces])
        self.signed = np.array([p.type == _NORMAL and p.piece.startswith(SIGN) for p in model.pieces])

    # ------------------------------------------------------------------ merging
    def merged(self, text: str) -> list[str]:
        """The pieces of a text by replaying merges: best score first, then leftmost."""
        part, after, before = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        queue: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(text) and part[i] + part[after[i]] in self.scores:
                heapq.heappush(queue, (-self.scores[part[i] + part[after[i]]], i, part[i], part[after[i]]))

        for i in range(len(text) - 1):
            offer(i)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if part[i] != left or j >= len(text) or part[j] != right:
                continue  # one of the two has merged since
            part[i], part[j] = left + right, ""
            after[i] = after[j]
            if after[j] < len(text):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in part if p]

    def next_shorter(self, piece: str) -> str | None:
        if piece not in self.shorter:
            self.shorter[piece] = next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.standing), None)
        return self.shorter[piece]

    def follows(self, pair: tuple[str, str]) -> bool:
        """Whether the two pieces, merged afresh, come out as themselves."""
        if len(self.fits) > PAIRS_REMEMBERED:
            self.fits.clear()
        found = self.fits[pair] = self.merged(pair[0] + pair[1]) == [*pair]
        return found

    # ----------------------------------------------------------------- encoding
    def known(self, text: str) -> list[str]:
        """The pieces of a text all of whose characters are pieces, by backtracking."""
        if text in self.standing:
            return [text]
        n = len(text)
        longest: list[str] = [""] * n
        for end, piece in self.backwards.iter(text[::-1]):  # longest first at each end
            if not longest[n - 1 - end]:
                longest[n - 1 - end] = piece
        failed = bytearray()  # a bit per place from which nothing fits
        found: list[str] = []
        fits = self.fits
        last, place, piece = None, 0, longest[0]
        while True:
            end = place + len(piece)
            if not (failed and failed[end >> 3] >> (end & 7) & 1):
                fit = last is None or fits.get((last, piece))
                if fit is None:
                    fit = self.follows((last, piece))
                if fit:
                    found.append(piece)
                    if end == n:
                        return found
                    last, place, piece = piece, end, longest[end]
                    continue
            shorter = self.next_shorter(piece)
            while shorter is None:  # nothing fits here: back to the piece before
                failed = failed or bytearray(n // 8 + 1)
                failed[place >> 3] |= 1 << (place & 7)
                piece = found.pop()
                place -= len(piece)
                shorter = self.next_shorter(piece)
            last, piece = found[-1] if found else None, shorter

    def word(self, text: str) -> bytes:
        """The ids (32 bits each) of blank signs and the characters up to the next one."""
        body = text.lstrip(SIGN)
        signs = len(text) - len(body)
        ids: list[int] = []
        for i, run in enumerate(self._runs(SIGN + body if signs else body)):
            if run[0] not in self.ids:
                ids.extend(map(self.byte_ids.__getitem__, run.encode()))
                continue
            out = self.known(run)
            if i == 0 and signs > 1:  # signs that go with no other piece merge among themselves
                alone = out[0] == SIGN
                out = self.merged(SIGN * (signs - 1 + alone)) + out[alone:]
            ids.extend(map(self.ids.__getitem__, out))
        return np.array(ids, np.int32).tobytes()

    def _runs(self, text: str) -> Iterator[str]:
        """Runs of characters that are pieces, and each other character by itself."""
        start = 0
        for i, c in enumerate(text):
            if c not in self.ids:
                if start < i:
                    yield text[start:i]
                yield c
                start = i + 1
        if start < len(text):
            yield text[start:]

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        text = SIGN + text.replace(" ", SIGN)
        out, start = [], 0
        while start < len(text):
            cut = _WORD_START.search(text, start + WINDOW)
            stop = cut.start() if cut else len(text)
            out.append(b"".join(map(self.words.__getitem__, self.cut.findall(text, start, stop))))
            start = stop
        return b"".join(out)

    # ----------------------------------------------------------------- decoding
    def decode(self, ids: np.ndarray) -> str:
        seen = ids[~self.control[ids]]
        strip = len(seen) > 0 and self.signed[seen[0]]  # the blank that encoding puts in front
        cuts = np.flatnonzero(self.control[ids])  # bytes on both sides of a control id are no one character
        text = "".join(self._decoded(part) for part in np.split(ids, cuts)) if len(cuts) else self._decoded(ids)
        return text[1:] if strip else text

    def _decoded(self, ids: np.ndarray) -> str:
        sizes = self.surface_sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(sizes.sum()) + np.repeat(self.surface_starts[ids] - (ends - sizes), sizes)
        return self.surface_bytes[at].tobytes().decode("utf-8", "each_byte")


def _each_byte(e: UnicodeError) -> tuple[str, int]:
    return "�" * (e.end - e.start), e.end


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's pieces of a model file; loaded once a process."""
    if path not in _LOADED:
        import codecs

        codecs.register_error("each_byte", _each_byte)
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (a list of ints) in place of ``text``."""
    path = model or default_model()
    keep = [c for c in docs.columns if c not in ("text", "ids")]
    head = "".join(f"`{n}` {t}, " for n, t in docs.select(*[f"`{c}`" for c in keep]).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        for b in batches:
            for part, texts in text_slices(b.column("text")):
                found = [own.encode(t) for t in texts]
                ends = np.cumsum([0] + [len(x) // 4 for x in found])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(part.start, part.stop - part.start) for c in keep], ids], names=[*keep, "ids"])

    return docs.select(*[f"`{c}`" for c in keep], text_column().alias("text")).mapInArrow(run, f"{head}ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` with ``text``, decoded from its ``ids``, as last column."""
    path = model or default_model()
    keep = [c for c in encoded.columns if c != "text"]
    head = "".join(f"`{n}` {t}, " for n, t in encoded.select(*[f"`{c}`" for c in keep]).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        for b in batches:
            texts = [own.decode(np.zeros(0, np.int32) if x.values is None else x.values.to_numpy()) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(texts, pa.string())], names=[*keep, "text"])

    return encoded.select(*[f"`{c}`" for c in keep]).mapInArrow(run, f"{head}text string")


def round_trip_digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    both = decode(encode(docs.select("doc_id", "text"), model), model)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))
