"""Splitting text before byte-level merges, vectorised over code points, and a bounded cache of encoded pieces.

The pieces are those of the public pattern (contractions; an optional space and a run of letters, digits or other
signs; white space, whose last character before a word stands alone). Runs of one character class are found for a
whole batch of texts with numpy, so that Python touches each piece once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import regex

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Code points that are split at once; a longer text is split alone, whole.
CHUNK = 1 << 19
#: Code points that are classed at once.
POINTS = 4096
#: Distinct pieces in each of the two generations that a worker remembers.
CACHE = 400_000


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for points in _blocks(np.arange(0x110000, dtype=np.uint32)):
        block = _characters(points)
        for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
            table[[ord(c) for c in regex.findall(pattern, block)]] = kind
    return table


def _blocks(points: np.ndarray) -> Iterator[np.ndarray]:
    """Code points that are characters, `POINTS` at a time: strings of all of them take hundreds of MB for a moment."""
    points = points[(points < 0xD800) | (points >= 0xE000)]
    yield from (points[i : i + POINTS] for i in range(0, len(points), POINTS))


def _characters(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le")


def unlike(split: Callable[[str], list[tuple[str, tuple[int, int]]]]) -> np.ndarray:
    """For each code point, whether a library's pre-tokenizer puts it into another class than `_classes`.

    Libraries know different versions of Unicode. All code points of a class after a sign of it are one piece if the
    library agrees; of more pieces, those that don't join such a sign by themselves are of another class.
    """
    table = _classes()
    out = np.zeros(len(table), dtype=bool)
    for kind, sign in ((OTHER, "!"), (LETTER, "a"), (NUMBER, "1"), (SPACE, "\n")):
        for points in _blocks(np.flatnonzero(table == kind)):
            joined = sign + _characters(points)
            for _, (a, b) in split(joined)[1:]:
                if len(split(sign + joined[a])) > 1:
                    out[points[a - 1 : b - 1]] = True
    return out


def _starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pieces start in the joined texts; `begins` are the starts of the texts that have a character."""
    n = len(points)
    kind = _classes()[points]
    run = np.empty(n, dtype=bool)
    run[0] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:])
    run[begins] = True
    first = np.flatnonzero(run)
    last = np.append(first[1:], n)
    new_text = np.zeros(n + 1, dtype=bool)
    new_text[begins] = True
    new_text[n] = True
    piece = run
    # White space before something else: its last character stands alone, and a blank joins what follows.
    ends = last[(kind[first] == SPACE) & ~new_text[last]]
    piece[ends - 1] = True
    piece[ends[points[ends - 1] == 32]] = False
    # Contractions: a single apostrophe at the start of a piece, right before certain letters.
    signs = first[(points[first] == 39) & (last - first == 1) & ~new_text[last] & piece[first]]
    signs = signs[kind[signs + 1] == LETTER]
    if len(signs):
        one = points[signs + 1]
        after = np.minimum(signs + 2, n - 1)
        two = np.where(new_text[signs + 2], 0, points[after])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((two == ord("e")) & np.isin(one, [ord("r"), ord("v")])) | ((one == ord("l")) & (two == ord("l")))
        length = np.where(short, 1, np.where(long, 2, 0))
        signs, length = signs[length > 0], length[length > 0]
        piece[signs + 1] = False
        rest = signs + 1 + length
        rest = rest[rest < n]
        inside = rest[(kind[rest] == LETTER) & ~new_text[rest]]
        piece[inside] = True
    return np.flatnonzero(piece)


def edges(texts: list[str]) -> Iterator[list[int]]:
    """Where the pieces of each text start, in order, and where the text ends."""
    group: list[str] = []
    size = 0
    for text in texts:
        if group and size + len(text) > CHUNK:
            yield from _split(group)
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield from _split(group)


def _split(texts: list[str]) -> Iterator[list[int]]:
    joined = "".join(texts)
    if not joined:
        yield from ([0] for _ in texts)
        return
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    begins = np.unique(bounds[:-1][np.diff(bounds) > 0])
    starts = _starts(points, begins)
    cut = np.searchsorted(starts, bounds).tolist()
    for text, begin, a, b in zip(texts, bounds[:-1].tolist(), cut[:-1], cut[1:], strict=True):
        yield [*(starts[a:b] - begin).tolist(), len(text)]


def pieces(texts: list[str]) -> Iterator[list[str]]:
    """The pieces of each text, in order."""
    for text, at in zip(texts, edges(texts), strict=True):
        yield [text[x:y] for x, y in pairwise(at)]


class PieceCache:
    """Encoded pieces as bytes of little-endian unsigned 32-bit ids; unknown ones are encoded together.

    Two generations are kept: when the younger is full it becomes the older, and
    pieces that occur again move back, so that frequent ones stay.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = CACHE):
        self.encode, self.limit, self.young, self.old = encode, limit, {}, {}

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Per text, its ids."""
        window: list[list[str]] = []
        held = 0
        for words in pieces(texts):
            window.append(words)
            held += len(words)
            if held >= 200_000:
                yield from self._flush(window)
                window, held = [], 0
        yield from self._flush(window)

    def _flush(self, window: list[list[str]]) -> Iterator[bytes]:
        distinct = set().union(*window)
        if len(self.young) + len(distinct) > self.limit:
            self.young, self.old = {}, self.young
        known, old = self.young, self.old
        missing = distinct - known.keys()
        again = missing & old.keys()
        known.update((w, old[w]) for w in again)
        fresh = list(missing - again)
        known.update(zip(fresh, self.encode(fresh), strict=True))
        for words in window:
            yield b"".join(map(known.__getitem__, words))


class _Known(dict):
    """Pieces and what they became; an unknown one is moved from the older generation, or encoded."""

    def __init__(self, encode: Callable[[str], bytes], old: dict[str, bytes]):
        self.encode, self.old = encode, old

    def __missing__(self, word: str) -> bytes:
        found = self.old.pop(word, None)
        if found is None:
            found = self.encode(word)
        self[word] = found
        return found


class WordCache:
    """As PieceCache, for an encoder that takes one piece at a time.

    A piece is looked up as soon as it is cut. Batches of them, and sets of those, cost more than the lookups: they no
    longer are in the processor's caches when they are looked at again.
    """

    def __init__(self, encode: Callable[[str], bytes], limit: int = CACHE):
        self.encode, self.limit, self.young = encode, limit, _Known(encode, {})

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Per text, its ids."""
        for text, at in zip(texts, edges(texts), strict=True):
            if len(self.young) >= self.limit:
                self.young = _Known(self.encode, dict(self.young))
            known = self.young
            yield b"".join([known[text[x:y]] for x, y in pairwise(at)])
