"""Texts as arrays of code points: letters, scripts, lower case, and hashed character n-grams of words."""

from __future__ import annotations

import functools

import numpy as np

#: Scripts and their main ranges of code points (fixed values, from the Unicode block list).
SCRIPT_RANGES = {
    "latin": [(0x0041, 0x024F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06)],
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x0900, 0x097F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x0980, 0x09FF)],
    "gurmukhi": [(0x0A00, 0x0A7F)],
    "gujarati": [(0x0A80, 0x0AFF)],
    "tamil": [(0x0B80, 0x0BFF)],
    "telugu": [(0x0C00, 0x0C7F)],
    "kannada": [(0x0C80, 0x0CFF)],
    "malayalam": [(0x0D00, 0x0D7F)],
    "thai": [(0x0E00, 0x0E7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x137F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
#: Numbers of the scripts; 0 is no letter, 1 a letter of any other script.
SCRIPTS = ["", "other", *SCRIPT_RANGES]


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the script (0 for anything but a letter) and the lower-case code point."""
    size = 0x110000
    letter = np.fromiter((chr(c).isalpha() for c in range(size)), bool, size)
    script = letter.astype(np.uint8)
    for number, ranges in enumerate(SCRIPT_RANGES.values(), 2):
        for first, last in ranges:
            script[first:last + 1][letter[first:last + 1]] = number
    lower = np.arange(size, dtype=np.uint32)
    for c in np.flatnonzero(letter):
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
    return script, lower


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def squeezed(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters with one 0 before, between and behind words; the script of each, and its place in ``codes``."""
    script_of, lower = tables()
    script = np.concatenate(([0], script_of[codes], [0])).astype(np.uint8)
    keep = (script > 0) | np.concatenate(([True], script[:-1] > 0))
    if keep[-1] and script[-1] == 0 and len(keep) > 1 and script[-2] == 0:
        keep[-1] = False
    at = np.flatnonzero(keep) - 1
    script = script[keep]
    letters = np.zeros(len(at), np.uint32)
    inside = script > 0
    letters[inside] = lower[codes[at[inside]]]
    return letters, script, at


def ngrams(letters: np.ndarray, orders: tuple[int, ...], bits: int):
    """For each order: starts and hash bins of the n-grams that lie in one word (a 0 at either end counts as its edge)."""
    blanks = np.concatenate(([0], np.cumsum(letters == 0)))
    single = letters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rolling, n = single, len(letters)
    for order in range(2, max(orders) + 1):
        if n < order:
            return
        rolling = rolling[: n - order + 1] * np.uint64(0x100000001B3) + single[order - 1:]
        if order not in orders:
            continue
        starts = np.arange(n - order + 1)
        fits = blanks[order - 1:n] == blanks[1:n - order + 2]  # no 0 strictly inside
        if order == 2:
            fits &= (letters[:-1] > 0) | (letters[1:] > 0)
        starts, mixed = starts[fits], rolling[fits]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        yield starts, ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(64 - bits)).astype(np.int64)
