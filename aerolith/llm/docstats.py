"""Document statistics, computed over the whole text of each row."""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np

SYMBOLS = b"#*$%&|<>"
ASCII_UPPER = bytes(range(65, 91))
ASCII_LETTERS = ASCII_UPPER + bytes(range(97, 123))
DIGITS = b"0123456789"
CONTINUATION = bytes(range(0x80, 0xC0))
MARKS = b".,;:!?"
SPACE = bytes([0x20, *range(0x09, 0x0E)])

#: names of what ``features`` returns, and whether more of it may only lower a quality score (-1), or neither (0)
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_rate": -1, "upper_rate": -1, "digit_rate": 0, "mark_rate": 0,
    "shout_rate": -1, "bar_rate": -1, "same_next_rate": -1, "distinct_rate": 0, "dup_line_rate": -1,
    "words_per_line": 0, "long_word_rate": 0, "non_ascii_rate": 0,
}
NAMES = list(FEATURES)


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(windows) == len(set(windows)):
        return 0
    counts = Counter(windows)
    n, covered = 0, 0  # covered: first word not yet looked at
    for i, w in enumerate(windows):
        if counts[w] > 1:
            n += i + width - max(i, covered)
            covered = i + width
    return n


def base(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = text.split()
    word_chars = len(text.translate(None, SPACE + CONTINUATION))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated_window_words(words)


def features(text: bytes) -> list[float]:
    words = text.split()
    n, size = max(len(words), 1), max(len(text), 1)
    lines = [line for line in text.split(b"\n") if line.strip()]

    def rate(chars: bytes, of: int) -> float:
        return (len(text) - len(text.translate(None, chars))) / of
    letters = rate(ASCII_LETTERS, 1)
    return [
        float(np.log1p(len(words))), len(text.translate(None, SPACE + CONTINUATION)) / n, rate(SYMBOLS, n),
        rate(ASCII_UPPER, max(letters, 1)), rate(DIGITS, size), rate(MARKS, n), text.count(b"!!") / n,
        text.count(b" | ") / n, sum(map(eq, words, words[1:])) / n, len(set(words)) / n,
        (len(lines) - len(set(lines))) / max(len(lines), 1), len(words) / max(len(lines), 1),
        sum(map((15).__lt__, map(len, words))) / n, rate(CONTINUATION, size),
    ]
