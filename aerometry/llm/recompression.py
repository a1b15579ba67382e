"""Consistent parsing of word sequences by recompression.

Every word has a 64-bit name derived from its bytes. Rounds then name maximal runs
of equal symbols and pairs of adjacent ones: in a pair the left symbol's bit for
the round is 0 and the right one's is 1, so pairs never overlap. Names derive from
what they stand for alone, so all tasks name alike and no table of names is shared.

Only symbols up to a round's bound take part (restricted recompression). Whether a
boundary between symbols survives a round then depends on the two symbols beside
it, hence after all rounds on at most ``REACH`` words to either side: equal
substrings have the same boundaries and symbols in their interior.
"""

from __future__ import annotations

import numpy as np

#: Longest symbol, in words, that a round still merges.
BOUNDS = (1, 1, 2, 2)
REACH = 2 * sum(BOUNDS)
#: No symbol is longer unless it is a run.
LONGEST = 2 * BOUNDS[-1]

_RNG = np.random.default_rng(0x5EED)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PAIR = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_RUN = np.uint64(0xE7037ED1A0B428DB)
#: Odd bases of the two window names, with their inverses modulo 2**64.
_BASES = (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
_INVERSES = tuple(pow(base, -1, 1 << 64) for base in _BASES)


def mix(values: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    found = np.full(count, base, dtype=np.uint64)
    if count:
        found[0] = 1
    return np.cumprod(found, dtype=np.uint64)


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The names of words, given their bytes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    terms = _BYTES[data[within + np.repeat(starts, lengths)]]
    terms *= _powers(int(_STEP) | 1, int(lengths.max()))[within]
    return mix(np.add.reduceat(terms, first) ^ (lengths.astype(np.uint64) * _RUN))


class Windows:
    """128-bit names of all windows of one length, from sums over the sequence."""

    def __init__(self, names: np.ndarray) -> None:
        count = len(names) + 1
        self.sums, self.scale = [], []
        for which, (base, inverse) in enumerate(zip(_BASES, _INVERSES, strict=True)):
            own = names if which == 0 else mix(names ^ _STEP)
            total = np.zeros(count, dtype=np.uint64)
            np.cumsum(own * _powers(base, count)[:-1], out=total[1:])
            self.sums.append(total)
            self.scale.append(_powers(inverse, count))

    def named(self, starts: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        total, scale = self.sums[which], self.scale[which]
        return mix((total[starts + length] - total[starts]) * scale[starts])


def parse(names: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length, and base (0 unless a run) of each final symbol.

    ``text_of`` numbers the text of each word; symbols stay within their text.
    """
    lengths = np.ones(len(names), dtype=np.int64)
    bases = np.zeros(len(names), dtype=np.uint64)
    for number, bound in enumerate(BOUNDS):
        names, lengths, bases, text_of = _runs(names, lengths, bases, text_of, bound)
        names, lengths, bases, text_of = _pairs(names, lengths, bases, text_of, bound, number)
    return np.cumsum(lengths) - lengths, lengths, bases


def _runs(names, lengths, bases, text_of, bound):
    if len(names) < 2:
        return names, lengths, bases, text_of
    same = (names[1:] == names[:-1]) & (text_of[1:] == text_of[:-1]) & (lengths[1:] <= bound)
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    counts = np.diff(np.append(first, len(names)))
    names, lengths, bases, text_of = names[first], lengths[first], bases[first], text_of[first]
    runs = counts > 1
    bases = np.where(runs, names, bases)
    named = mix(names * _RUN + counts.astype(np.uint64) * _STEP)
    return np.where(runs, named, names), lengths * counts, bases, text_of


def _pairs(names, lengths, bases, text_of, bound, number):
    if len(names) < 2:
        return names, lengths, bases, text_of
    salt = mix(np.array([number + 1], dtype=np.uint64))
    bit = (mix(names ^ salt) & np.uint64(1)).astype(bool)
    active = lengths <= bound
    left = ~bit[:-1] & bit[1:] & active[:-1] & active[1:] & (text_of[1:] == text_of[:-1])
    keep = np.concatenate([[True], ~left])
    merged = np.concatenate([left, [False]])
    after = np.roll(names, -1)
    names = np.where(merged, mix(names * _PAIR[0] + mix(after * _PAIR[1])), names)
    lengths = np.where(merged, lengths + np.roll(lengths, -1), lengths)
    bases = np.where(merged, np.uint64(0), bases)
    return names[keep], lengths[keep], bases[keep], text_of[keep]


def _least_over(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    done, found = 1, values
    while done * 2 <= width:
        found = np.minimum(found[:-done], found[done:])
        done *= 2
    rest = width - done
    return np.minimum(found[: len(found) - rest], found[rest:]) if rest else found


def anchors(names: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows within a text, and the anchor of each.

    ``offsets`` are the numbers of words before each text, with the end last. Equal
    windows have equal anchors. A window's anchor is the least name among the
    boundaries of symbols that its words alone determine, a boundary being named by the
    words, ``REACH`` to either side: symbols tell where equal windows are compared, and
    names of more words than a symbol has tell more windows apart. Where there is no such boundary, a run of a
    short symbol covers the window's middle, and the anchor is that symbol.
    """
    gap = window - 2 * REACH
    if gap < LONGEST:
        raise ValueError(f"a window of {window} words may hold no boundary")
    sizes = np.diff(offsets)
    room = np.maximum(sizes - window + 1, 0)
    if not room.sum():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    starts = np.repeat(offsets[:-1] - (np.cumsum(room) - room), room) + np.arange(room.sum())
    first, lengths, bases = parse(names, np.repeat(np.arange(len(sizes)), sizes))
    values = np.full(len(names) + 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    at = first[(first >= REACH) & (first + REACH <= len(names))]
    values[at] = Windows(names).named(at - REACH, 2 * REACH) >> np.uint64(1)
    long = np.flatnonzero((bases != 0) & (lengths > LONGEST))
    for f, n, base in zip(first[long], lengths[long], bases[long], strict=True):
        values[f + 1 : f + n] = (mix(np.array([base])) >> np.uint64(1)) | np.uint64(1 << 63)
    least = _least_over(values, gap + 1)
    return starts, least[starts + REACH]
