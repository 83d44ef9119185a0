"""Splits texts into the words that a byte-level BPE vocabulary encodes one by one.

The rule is the one in the vocabulary file: contractions, then runs of letters, of numbers
or of other signs with a space before them, then white space up to the space that belongs
to the next word. It is carried out by numpy over whole blocks of text.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# Classes of characters.
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# The endings split off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
# Fixed value: the same rule as a pattern, for libraries.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_APOSTROPHE, _BLANK = ord("'"), ord(" ")


@cache
def character_classes() -> np.ndarray:
    """The class of each code point."""
    import regex

    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    every = "".join(points)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[[ord(c) for c in m[0]]] = kind
    return out


def split_words(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where words start in the code points of several texts set one after the other.

    ``begins`` has the start of each text that is not empty. The result begins with them.
    """
    n = len(points)
    kinds = character_classes()[points]
    first = np.zeros(n + 1, bool)  # of a text
    first[begins] = True
    first[n] = True
    change = np.empty(n, bool)  # a run of one class starts here
    change[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=change[1:])
    change |= first[:n]
    start = change.copy()

    space = kinds == SPACE
    # The last of a run of white space before other signs stands alone, or with them if blank.
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & change[1:] & ~first[1:n]
    start |= last
    at = np.flatnonzero(last & (points == _BLANK))
    start[at + 1] = False

    # Contractions: a lone apostrophe that starts a word, then letters.
    lone = (points == _APOSTROPHE) & start
    lone[:-1] &= (kinds[1:] == LETTER) & ~first[1:n]
    lone[-1] = False
    for k in np.flatnonzero(lone).tolist():
        stop = k + 1
        while stop < n and kinds[stop] == LETTER and not first[stop] and stop - k <= 2:
            stop += 1
        follows = "".join(map(chr, points[k + 1 : stop].tolist()))
        ending = next((e for e in ENDINGS if follows.startswith(e)), None)
        if ending:
            start[k + 1] = False
            after = k + 1 + len(ending)
            if after < n and kinds[after] == LETTER and not first[after]:
                start[after] = True
    return np.flatnonzero(start)
