"""Byte-level BPE pre-tokens of many texts at once, on arrays of code points.

Texts are cut as the tokenizer file's byte-level pattern cuts them:
optional space + letters / numbers / others, white space with its last space
left to the next token, and the English contractions. Special strings are
tokens of their own. All rules look at a code point's class and its
neighbours, so they are array operations over a whole chunk of texts; a word
that occurs often in the chunk is handled once.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import regex

OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)  # BLANK: U+0020
#: What may follow an apostrophe as a token of its own.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def byte_chars() -> tuple[str, ...]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars, extra = {}, 0
    for b in range(256):
        if b in shown:
            chars[b] = chr(b)
        else:
            chars[b] = chr(256 + extra)
            extra += 1
    return tuple(chars[b] for b in range(256))


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point. Characters that one Unicode version knows
    and an older one doesn't are settled by the tokenizers library itself."""
    from tokenizers.pre_tokenizers import ByteLevel

    chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for found in regex.finditer(pattern, chars):
            # the surrogates are a gap between two neighbours
            a, b = found.start(), found.end() - 1
            out[a + 0x800 * (a >= 0xD800) : b + 0x800 * (b >= 0xD800) + 1] = kind
    library = ByteLevel(add_prefix_space=False)
    for c in np.flatnonzero((out == LETTER) | (out == NUMBER)).tolist():
        if unicodedata.category(chr(c)) == "Cn":
            beside = [len(library.pre_tokenize_str(lead + chr(c))) == 1 for lead in "a1"]
            out[c] = LETTER if beside[0] else NUMBER if beside[1] else OTHER
    out[0x20] = BLANK
    return out


@dataclass
class Chunk:
    """Distinct pre-tokens of a chunk and where they occur."""

    words: list[str]  # distinct tokens
    special: np.ndarray  # for each word: a special string
    which: np.ndarray  # for each occurrence, in text order: its word
    text: np.ndarray  # for each occurrence: its text's number


def span_hash(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit digests of spans, by prefix sums of a polynomial."""
    base = 0x9E3779B97F4A7C15
    n = len(points)
    power, inverse = powers(n, base), powers(n, pow(base, -1, 1 << 64))
    total = np.zeros(n + 1, dtype=np.uint64)
    mixed = (points.astype(np.uint64) + np.uint64(0x1234567)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    np.cumsum(mixed * power, out=total[1:])
    out = (total[end] - total[begin]) * inverse[begin]
    return (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, 1), base, dtype=np.uint64)
        got[0] = 1
        got = np.cumprod(got)
        _POWERS[base] = got
    return got[:n]


def cut(data: bytes, offsets: np.ndarray, specials: tuple[str, ...] = ()) -> Chunk:
    """Pre-tokens of the texts ``data[offsets[i]:offsets[i + 1]]`` (UTF-8)."""
    whole = data.decode("utf-8")
    n = len(whole)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Chunk([], np.zeros(0, dtype=bool), none, none)
    points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
    heads = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80, out=heads[1:])
    at = heads[offsets]  # offsets in code points
    kind = classes()[points]
    white = kind >= SPACE

    first = np.zeros(n + 1, dtype=bool)  # where a text or a special string begins or ends
    first[at] = True
    first[n] = True
    marks = []
    if specials:
        for found in re.finditer("|".join(map(re.escape, specials)), whole):
            a, b = found.span()
            if not first[a + 1 : b].any():  # not across two texts
                first[a] = first[b] = True
                marks.append((a, b))

    before = np.empty(n, dtype=np.uint8)
    before[0] = OTHER
    before[1:] = kind[:-1]
    begin = first[:n].copy()
    changed = np.minimum(kind, SPACE) != np.minimum(before, SPACE)
    begin |= ~white & changed & (before != BLANK)
    begin |= white & changed
    # the last white space before a word: a token, or the head of the next one
    begin[:-1] |= white[:-1] & ~white[1:] & ~first[1:n]

    quotes = np.flatnonzero((points == 0x27) & begin)
    for tail in CONTRACTIONS:
        k = len(tail)
        q = quotes[quotes + k < n]
        for d, ch in enumerate(tail, 1):
            q = q[(points[q + d] == ord(ch)) & ~first[q + d]]
        begin[q + 1] = False
        after = q[q + k + 1 < n] + k + 1
        begin[after[kind[after] == LETTER]] = True
    for a, b in marks:
        begin[a + 1 : b] = False

    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], n)
    digest = span_hash(points, starts, ends)
    _, index, which = np.unique(digest, return_index=True, return_inverse=True)
    words = [whole[a:b] for a, b in zip(starts[index].tolist(), ends[index].tolist(), strict=True)]
    special = np.zeros(len(words), dtype=bool)
    if marks:
        begun = {a for a, _ in marks}
        special = np.array([int(a) in begun for a in starts[index]], dtype=bool)
    text = np.searchsorted(at, starts, "right") - 1
    return Chunk(words, special, which, text)
