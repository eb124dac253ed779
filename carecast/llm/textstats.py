"""Per-document statistics for the quality operators, computed on UTF-8 bytes.

Words are maximal runs without ASCII white space (``[^\\x20\\x09-\\x0D]+``),
which is what ``bytes.split()`` returns. Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import map_texts, text_column

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
CONTINUATION = bytes(range(0x80, 0xC0))
WINDOW = 8

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct", "top_count", "n_adjacent", "n_upper", "n_lower", "n_marks", "n_stops",
        "n_digits", "n_bytes"]
SCHEMA = ", ".join(f"{c} long" for c in COUNTS + MORE)

_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(WINDOW)]


def _without(data: bytes, drop: bytes) -> int:
    return len(data) - len(data.translate(None, drop))


def repeated_words(words: list[bytes], hashes: np.ndarray) -> int:
    """Words inside 8-word windows that occur twice or more in the text, the first included.

    Equal windows have equal hashes, so a text without equal hashes has
    none; windows with equal hashes are compared word by word.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = hashes.view(np.uint64)
    w = h[:n] * _POWERS[0]
    for k in range(1, WINDOW):
        w += h[k:k + n] * _POWERS[k]
    order = np.argsort(w, kind="stable")
    same = w[order[1:]] == w[order[:-1]]
    if not same.any():
        return 0
    tied = np.zeros(n, bool)
    tied[order[1:][same]] = tied[order[:-1][same]] = True
    seen: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(tied).tolist():
        seen.setdefault(tuple(words[i:i + WINDOW]), []).append(i)
    edge = np.zeros(len(words) + 1, np.int64)
    for at in seen.values():
        if len(at) > 1:
            a = np.array(at)
            np.add.at(edge, a, 1)
            np.add.at(edge, a + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def stats_of(text: str | None) -> tuple:
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    hashes = np.fromiter(map(hash, words), np.int64, n)
    lines = [x for x in data.split(b"\n") if x.strip()]
    ordered = np.sort(hashes)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if n else ordered
    top = int(np.diff(np.append(starts, n)).max()) if n else 0
    return (
        n,
        len(data) - _without(data, SPACES) - _without(data, CONTINUATION),
        _without(data, SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words, hashes),
        len(lines),
        len(starts),
        top,
        int((hashes[1:] == hashes[:-1]).sum()),
        _without(data, UPPER),
        _without(data, LOWER),
        _without(data, b"!?"),
        _without(data, b"."),
        _without(data, b"0123456789"),
        len(data),
    )


def stats_frame(texts) -> pd.DataFrame:
    return pd.DataFrame([stats_of(t) for t in texts], columns=COUNTS + MORE, dtype="int64")


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row of ``docs``."""
    return map_texts(docs.select("doc_id", text_column().alias("text")), stats_frame, SCHEMA)


#: Model inputs. The direction says how a larger value may move the verdict of a constrained model.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "distinct_share": 0, "top_share": 0, "adjacent_share": -1, "upper_share": -1, "mark_share": -1,
    "stop_share": 0, "digit_share": 0, "line_length": 0,
}


def features(s: pd.DataFrame) -> np.ndarray:
    """Transformed statistics, one row per document: logs of lengths, square roots of shares."""
    v = {c: s[c].to_numpy(np.float64) for c in COUNTS + MORE}
    words, chars = np.maximum(v["n_words"], 1), np.maximum(v["word_chars"], 1)
    lines = np.maximum(v["n_lines"], 1)
    letters = np.maximum(v["n_upper"] + v["n_lower"], 1)
    share = lambda a, b: np.sqrt(np.minimum(a / b, 4.0))
    columns = {
        "log_words": np.log1p(v["n_words"]),
        "word_length": np.log1p(v["word_chars"] / words),
        "symbol_share": share(v["n_symbols"], chars),
        "dup_line_share": share(v["n_dup_lines"], lines),
        "repeat_share": share(v["n_repeat_words"], words),
        "distinct_share": share(v["n_distinct"], words),
        "top_share": share(v["top_count"], words),
        "adjacent_share": share(v["n_adjacent"], words),
        "upper_share": share(v["n_upper"], letters),
        "mark_share": share(v["n_marks"], words),
        "stop_share": share(v["n_stops"], words),
        "digit_share": share(v["n_digits"], chars),
        "line_length": np.log1p(v["n_words"] / lines),
    }
    return np.column_stack([columns[k] for k in FEATURES])
