"""Suffix order of a text, built blockwise with a difference cover.

Suffixes count by their first SPAN bytes: those that agree so far are one class. A
difference cover D of PERIOD has, for any two positions, an offset below PERIOD that takes
both to positions whose remainders are in D. Those sampled positions are ranked first, by
LONG bytes: heads of PERIOD bytes are named, and pairs of names are ranked, since a step of
PERIOD leads from a sampled position to a sampled one.

Then the suffixes are sorted one bucket at a time, between splitters taken from the sample,
by heads of PERIOD bytes. Ties are resolved by the sample's ranks at the common offset and,
where these agree too, by the last TAIL bytes. So what is held at once is one bucket's heads
and a rank per sampled position, and never SPAN bytes per suffix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SPAN, PERIOD = 100, 32
LONG = 2 * PERIOD
#: Bytes compared last, in words of 8: from SPAN - TAIL, which no rank's end falls short of.
TAIL = 40
#: Suffixes sorted at once, unless more of them share their first 8 bytes.
BUCKET = 1 << 18
_WORD = 8


def difference_cover(period: int) -> np.ndarray:
    """Remainders whose differences are all of 0 .. period - 1, chosen greedily."""
    chosen, missing = [0], set(range(1, period))
    while missing:
        def gain(x: int) -> int:
            return len(missing & {d % period for y in chosen for d in (x - y, y - x)})

        best = max(range(period), key=gain)
        missing -= {d % period for y in chosen for d in (best - y, y - best)}
        chosen.append(best)
    return np.array(sorted(chosen))


COVER = difference_cover(PERIOD)


def _offsets() -> np.ndarray:
    """For remainders (i, j), the least offset that takes both into the cover."""
    inside = np.zeros(PERIOD, bool)
    inside[COVER] = True
    step = np.arange(PERIOD)
    i, j, d = np.meshgrid(step, step, step, indexing="ij")
    return np.argmax(inside[(i + d) % PERIOD] & inside[(j + d) % PERIOD], axis=2)


OFFSET = _offsets()


def _dense(order: np.ndarray, keys: Sequence[np.ndarray]) -> np.ndarray:
    """Whether each element of a sorted order differs from the one before it."""
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for key in keys:
            own = key[order]
            new[1:] |= own[1:] != own[:-1]
    return new


class Block:
    """A text of bounded size with the ranks of its sampled positions."""

    def __init__(self, text: bytes) -> None:
        padded = np.frombuffer(text + bytes(SPAN + LONG + _WORD), np.uint8)
        self.words = np.zeros(len(padded) - _WORD + 1, np.uint64)
        for at in range(_WORD):
            self.words <<= np.uint64(8)
            self.words |= padded[at : at + len(self.words)]
        self.size = len(text)
        self._rank_sample()

    def _heads(self, places: np.ndarray) -> list[np.ndarray]:
        return [self.words[places + at] for at in range(0, PERIOD, _WORD)]

    def _rank_sample(self) -> None:
        inside = np.zeros(PERIOD, bool)
        inside[COVER] = True
        end = self.size + PERIOD
        places = np.flatnonzero(np.tile(inside, end // PERIOD + 1)[:end])
        heads = self._heads(places)
        order = np.lexsort(heads[::-1])
        names = np.full(end + PERIOD, -1, np.int32)  # a block has far fewer places
        names[places[order]] = np.cumsum(_dense(order, heads))
        self.splitters = heads[0][order]
        pairs = names[places].astype(np.int64) * (len(places) + 2) + names[places + PERIOD] + 1
        order = np.argsort(pairs, kind="stable")
        self.ranks = names  # the names are done with
        self.ranks[places[order]] = np.cumsum(_dense(order, [pairs]))

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 per pair of positions with equal heads."""
        offset = OFFSET[a % PERIOD, b % PERIOD]
        result = np.sign(self.ranks[a + offset] - self.ranks[b + offset])
        for at in range(SPAN - TAIL, SPAN, _WORD):
            same = np.flatnonzero(result == 0)
            if not len(same):
                break
            x, y = self.words[a[same] + at], self.words[b[same] + at]
            result[same] = (x > y).astype(np.int64) - (x < y)
        return result

    def _resolve(self, places: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ties in order, with their classes: ternary quicksort of all segments at once.

        ``segment`` ascends; in each round every unfinished segment is split around its middle.
        """
        places, segment = places.copy(), segment.copy()
        unfinished = np.ones(len(places), bool)
        while (at := np.flatnonzero(unfinished)).size:
            own = segment[at]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            sizes = np.diff(np.append(first, len(own)))
            pivot = np.repeat(places[at[first + sizes // 2]], sizes)
            side = self.compare(places[at], pivot)
            key = np.repeat(np.arange(len(first)), sizes) * 3 + side + 1
            order = np.argsort(key, kind="stable")
            places[at], key = places[at][order], key[order]
            begins = np.concatenate([[True], key[1:] != key[:-1]])
            part = np.cumsum(begins) - 1
            # parts keep the segments' order: numbered within the room that their places give
            segment[at] = at[np.flatnonzero(begins)][part]
            unfinished[at] = (key % 3 != 1) & (np.bincount(part)[part] > 1)
        return places, segment

    def sorted_suffixes(self, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Bucket by bucket, the given positions in suffix order, and their class numbers.

        Class numbers ascend within a bucket; equal ones agree in their first SPAN bytes.
        """
        step = max(1, len(self.splitters) * BUCKET // max(1, len(places)))
        splitters = np.unique(self.splitters[step::step])
        bucket = np.searchsorted(splitters, self.words[places], side="right")
        by_bucket = np.argsort(bucket, kind="stable")
        ends = np.cumsum(np.bincount(bucket, minlength=len(splitters) + 1))
        for start, end in zip(np.concatenate([[0], ends]), ends, strict=False):
            own = places[by_bucket[start:end]]
            heads = self._heads(own)
            order = np.lexsort(heads[::-1])
            new = _dense(order, heads)
            own, segment = own[order], np.flatnonzero(new)[np.cumsum(new) - 1]
            tied = np.bincount(segment, minlength=len(own))[segment] > 1
            at = np.flatnonzero(tied)
            resolved, local = self._resolve(own[at], np.searchsorted(at, segment[at]))
            own[at], segment[at] = resolved, at[local]
            yield own, segment


def later_copies(text: bytes, places: np.ndarray, owner: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of the suffixes at ``places`` have a class member that comes earlier.

    Earlier means a smaller (owner, start); equal ones are the same suffix. Places ascend.
    """
    found = np.zeros(len(places), bool)
    age = owner * (int(start.max(initial=0)) + 1) + start  # fewer than 2^32 owners, of less than 2^31 bytes
    number = np.zeros(len(text), np.int32)  # a block has far fewer places
    number[places] = np.arange(len(places))
    for own, segment in Block(text).sorted_suffixes(places):
        own_age = age[number[own]]
        new = _dense(np.arange(len(segment)), [segment])
        first = np.minimum.reduceat(own_age, np.flatnonzero(new)) if len(own) else own_age
        found[number[own]] = own_age != first[np.cumsum(new) - 1]
    return found
