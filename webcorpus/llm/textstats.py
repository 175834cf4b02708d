"""Statistics of texts that the quality operators judge by, from bytes in numpy arrays."""

from __future__ import annotations

import numpy as np

from webcorpus.llm import textwords as W

U64 = np.uint64
#: characters counted as symbols ``[#*$%&|<>]``
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["log_words", "word_length", "symbols", "symbol_ends", "dup_lines", "repeat_words", "repeat_neighbours",
          "upper", "digits", "exclaims", "stops", "commas", "bars", "blank_share", "line_words", "wide",
          "short_words", "distinct_words", "capital_words", "bare_symbols"]


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


_UPPER, _LOWER, _DIGIT = (_table(bytes(range(a, b))) for a, b in ((65, 91), (97, 123), (48, 58)))


def _repeats(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries of the same text with equal hashes: which are not the only one, and which are not the first."""
    key = W.mix(hashes + text.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable") if len(key) < 1 << 14 else np.argsort(key)
    key = key[order]
    same = np.zeros(len(key), dtype=bool)
    same[1:] = key[1:] == key[:-1]
    again, many = np.zeros(len(key), dtype=bool), same.copy()
    many[:-1] |= same[1:]
    out = np.zeros(len(key), dtype=bool)
    out[order], again[order] = many, same
    return out, again


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Exact counts (:data:`COUNTS`) and ratios (:data:`RATIOS`) of each text; all 0 for a text without words."""
    starts, ends, off = W.find_words(data, offsets, W.BLANK_SEPARATED)
    n_texts, n_words = len(offsets) - 1, np.diff(off)
    text = np.repeat(np.arange(n_texts), n_words)
    hashes = W.hash_words(data, starts, ends)
    chars = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    word_chars = chars[ends] - chars[starts]
    out = {"n_words": n_words, "word_chars": W.per_text(word_chars, off)}

    def count(table: np.ndarray) -> np.ndarray:
        return W.per_text(table[data], offsets)

    out["n_symbols"] = count(SYMBOLS)
    # lines with a word: equal bytes between line ends (a text's end is one)
    breaks = np.flatnonzero(data == 0x0A)
    ls = np.unique(np.r_[offsets[:-1], breaks + 1])
    ls = ls[ls < len(data)]
    line_text = np.searchsorted(offsets, ls, side="right") - 1
    le = np.minimum(np.r_[breaks, len(data)][np.searchsorted(breaks, ls)], offsets[1:][line_text])
    full = np.r_[starts, len(data)][np.searchsorted(starts, ls)] < le
    ls, le, line_text = ls[full], le[full], line_text[full]
    _, again = _repeats(W.hash_words(data, ls, le), line_text)
    n_lines = np.bincount(line_text, minlength=n_texts)
    out["n_dup_lines"] = np.bincount(line_text[again], minlength=n_texts)
    # words in three-word windows found more than once
    w3, ok = W.window_hashes(hashes, 3), W.window_starts(off, 3)
    at = np.flatnonzero(ok)
    many, _ = _repeats(w3[at], text[at])
    marks = np.zeros(len(hashes) + 1, dtype=np.int32)
    np.add.at(marks, at[many], 1)
    np.add.at(marks, at[many] + 3, -1)
    out["n_repeat_words"] = W.per_text(np.cumsum(marks)[:-1] > 0, off)

    words, size = np.maximum(n_words, 1), np.maximum(np.diff(offsets), 1)
    letters = np.maximum(count(_UPPER) + count(_LOWER), 1)
    last = data[ends - 1] if len(ends) else data[:0]
    equal_next = np.zeros(len(hashes), dtype=bool)
    equal_next[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    _, again_words = _repeats(hashes, text)
    ratios = {
        "log_words": np.log1p(n_words), "word_length": out["word_chars"] / words,
        "symbols": out["n_symbols"] / words, "symbol_ends": W.per_text(SYMBOLS[last], off) / words,
        "dup_lines": out["n_dup_lines"] / np.maximum(n_lines, 1), "repeat_words": out["n_repeat_words"] / words,
        "repeat_neighbours": W.per_text(equal_next, off) / words,
        "upper": count(_UPPER) / letters, "digits": count(_DIGIT) / size, "exclaims": count(_table(b"!")) / words,
        "stops": count(_table(b".")) / words, "commas": count(_table(b",")) / words, "bars": count(_table(b"|")) / words,
        "blank_share": 1 - W.per_text(ends - starts, off) / size, "line_words": np.log1p(n_words / np.maximum(n_lines, 1)),
        "wide": count(np.arange(256) >= 0x80) / size, "short_words": W.per_text(word_chars <= 3, off) / words,
        "distinct_words": 1 - W.per_text(again_words, off) / words,
        "capital_words": W.per_text(_UPPER[data[starts]], off) / words if len(starts) else np.zeros(n_texts),
        "bare_symbols": W.per_text((word_chars == 1) & SYMBOLS[last], off) / words,
    }
    empty = n_words == 0
    for name, values in ratios.items():
        values = values.astype(np.float64)
        values[empty] = 0
        out[name] = values
    return out
