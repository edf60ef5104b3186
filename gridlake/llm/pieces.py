"""Distinct sampled segmentations of texts into the pieces of a SentencePiece vocabulary.

Every way to cut a text into pieces is a path of a lattice, with a probability in
proportion to the product of its pieces' weights. ``k`` distinct paths are drawn without
replacement by the Gumbel top-k trick: give every path its log probability plus Gumbel noise
and take the k largest. The paths are far too many to list, so sets of paths are searched best
first (A-star): the maximum over a set of paths is a Gumbel variable at the log of the set's mass,
and knowing it, the path that attains it is an ordinary sample from the set. Taking that path
out leaves disjoint sets ("equal up to some place, then different"), whose maxima are
Gumbel variables cut off at the set's own maximum. A heap of these bounds is exact.

A pair of neighbouring characters that is in no piece is a cut in every path. The lattice thus
falls into independent atoms (words, mostly), and equal atoms of a batch share their tables, which
numpy fills for all atoms at once. Random numbers are hashes of the row's key, the
sample and the place, so they do not depend on batches or partitions.

Vocabularies of merge type have ranks in place of log probabilities; rank r then
weighs (r + ZIPF) ** -SLOPE, as word frequencies do. The texts' encoding and decoding follow the
library's: blanks are ``▁``, one is put in front, and characters without a piece become bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.batches import map_partitions

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES, SEED = 2, 20
ZIPF, SLOPE = 10.0, 1.0
BLANK = "▁"
#: Characters whose tables are held at once; a longer text is held alone.
CHARACTERS = 1 << 20
#: The size of the tables pieces are looked up in; small enough for a processor's cache.
SLOT_BITS = 17
_U = np.uint64
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_MASK = (1 << 64) - 1
#: No noise of 53-bit numbers is larger.
_MOST_NOISE = 38.0


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective hash of 64-bit numbers."""
    y = x >> _U(30)
    y ^= x
    y *= _U(0xBF58476D1CE4E5B9)
    y ^= y >> _U(27)
    y *= _U(0x94D049BB133111EB)
    y ^= y >> _U(31)
    return y


def _step(counter: np.ndarray | int) -> np.ndarray:
    if isinstance(counter, int):
        return _U(_FACTOR * (counter + 1) & _MASK)
    return (counter.astype(_U) + _U(1)) * _U(_FACTOR)


def _stream(key: np.ndarray, *counters: np.ndarray | int) -> np.ndarray:
    """An array of 64-bit states that are a function of keys and counters."""
    for counter in counters:
        key = _mix(key + _step(counter))
    return key


def _uniform(stream: np.ndarray, step: int = 0) -> np.ndarray:
    """Numbers in (0, 1), one per state; others for each step."""
    x = _mix(stream + _step(step))
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def _uniforms(state: int) -> Iterator[float]:
    """The numbers of one state, by plain integers."""
    for step in range(1 << 30):
        x = state + _FACTOR * (step + 1) & _MASK
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _MASK
        yield (((x ^ (x >> 31)) >> 11) + 0.5) * 2.0**-53


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start + 1, .. (count numbers) one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _powers(factor: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, factor, _U)
    factors[0] = 1
    return np.cumprod(factors, dtype=_U)




class _Hashes:
    """Hashes of any substring of an array of characters, by prefix sums."""

    def __init__(self, codes: np.ndarray):
        with np.errstate(over="ignore"):
            values = _mix(codes.astype(_U) + _U(1))
            self.back = _powers(_INVERSE, len(codes))
            self.sums = np.zeros(len(codes) + 1, _U)
            np.cumsum(values * _powers(_FACTOR, len(codes))[:-1], dtype=_U, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[ends] - self.sums[starts]) * self.back[starts]


@dataclass(frozen=True)
class Vocabulary:
    """Pieces and the log of their weights; ids of byte pieces by byte, or none."""

    pieces: tuple[str, ...]
    weights: tuple[float, ...]
    usable: tuple[bool, ...]
    byte_ids: tuple[int, ...]
    unknown: int

    @cached_property
    def decoded(self) -> np.ndarray:
        """What each id stands for, as an array of bytes objects."""
        texts = [piece.replace(BLANK, " ").encode() for piece in self.pieces]
        spelled = set(self.byte_ids)
        for byte, i in enumerate(self.byte_ids):
            texts[i] = bytes([byte])
        for i, (usable, text) in enumerate(zip(self.usable, texts, strict=True)):
            texts[i] = text if usable or i in spelled else b""
        table = np.empty(len(texts), object)
        table[:] = texts
        return table


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Pieces of a model file, with weights as described above. Files are read by the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    scores = [model.get_score(i) for i in ids]
    bytes_ = {}
    usable = []
    for i in ids:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_[int(piece[1:-1], 16)] = i
        special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        usable.append(not special and not model.is_byte(i))
    own = [scores[i] for i in ids if usable[i]]
    if all(float(score).is_integer() and score <= 0 for score in own):  # ranks of merges
        scores = [-SLOPE * float(np.log(ZIPF - score)) for score in scores]
    return Vocabulary(
        tuple(model.id_to_piece(i) for i in ids),
        tuple(scores),
        tuple(usable),
        tuple(bytes_[b] for b in range(256)) if len(bytes_) == 256 else (),
        model.unk_id(),
    )


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of a segmentation, without the blank that was put in front."""
    text = b"".join(vocabulary.decoded[ids].tolist()).decode(errors="replace")
    return text[1:] if text.startswith(" ") else text


class Tables:
    """Lookup tables of a vocabulary, filled once per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.n = len(vocabulary.pieces)
        own = [i for i, usable in enumerate(vocabulary.usable) if usable and vocabulary.pieces[i]]
        self.longest = max((len(vocabulary.pieces[i]) for i in own), default=1)
        weights = np.array(vocabulary.weights)
        #: weight of one byte, below that of every piece
        self.byte = float(min((weights[i] for i in own), default=0.0)) - 1.0
        texts = [np.array([ord(c) for c in vocabulary.pieces[i]], np.int64) for i in own]
        ends = np.cumsum([len(t) for t in texts])
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        starts = ends - [len(t) for t in texts]
        self.weights = weights
        self._place(_Hashes(flat).of(starts, ends) if texts else np.zeros(0, _U), np.array(own, np.int64))
        # characters that are next to another one in some piece
        paired = sorted({int(c) for t in texts if len(t) > 1 for c in t})
        self.symbol = np.zeros(0x110000, np.int32)
        self.symbol[paired] = np.arange(1, len(paired) + 1)
        self.joined = np.zeros((len(paired) + 1, len(paired) + 1), bool)
        inner = np.ones(max(len(flat) - 1, 0), bool)
        inner[ends[:-1] - 1] = False
        self.joined[self.symbol[flat[:-1][inner]], self.symbol[flat[1:][inner]]] = True
        #: characters that are a piece; others are spelled in bytes, or unknown
        self.single = np.zeros(0x110000, bool)
        self.single[[int(t[0]) for t in texts if len(t) == 1]] = True

    def _place(self, hashes: np.ndarray, ids: np.ndarray) -> None:
        """Two direct-address tables by different bits, and the few left by binary search.

        Each table also marks the slots some of whose hashes had to go on to the next.
        """
        self.levels = []
        slots = 1 << SLOT_BITS
        for shift in (64 - SLOT_BITS, 20):
            slot = (hashes >> _U(shift)).astype(np.int64) & (slots - 1)
            keys, found = np.zeros(slots, _U), np.full(slots, -1, np.int32)
            _, first = np.unique(slot, return_index=True)
            keys[slot[first]], found[slot[first]] = hashes[first], ids[first]
            left = np.ones(len(hashes), bool)
            left[first] = False
            more = np.zeros(slots, bool)
            more[slot[left]] = True
            self.levels.append((shift, keys, found, more))
            hashes, ids = hashes[left], ids[left]
        order = np.argsort(hashes)
        self.rest = (hashes[order], ids[order])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The id of the piece with each hash, or -1."""
        result = np.full(len(hashes), -1, np.int64)
        on = None  # where the search goes on, and the hashes there; at first everywhere
        for shift, keys, found, more in self.levels:
            slot = (hashes >> _U(shift)).view(np.int64) & (len(keys) - 1)
            hit = np.flatnonzero(keys[slot] == hashes)
            result[hit if on is None else on[hit]] = found[slot[hit]]
            left = np.flatnonzero(more[slot])
            on, hashes = left if on is None else on[left], hashes[left]
        keys, ids = self.rest
        if len(keys):
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == hashes)
            result[on[hit]] = ids[at[hit]]
        return result


class Lattice:
    """The lattices of the distinct atoms of a batch of texts, and the texts' atoms.

    Nodes are places in ``codes``, where each distinct atom is followed by an end place.
    Edges are sorted by node. Edge ids from ``tables.n`` on are characters in bytes.
    """

    def __init__(self, texts: list[str], tables: Tables):
        self.tables = tables
        spelled = [(BLANK + text.replace(" ", BLANK)) if text else "" for text in texts]
        codes = np.frombuffer("".join(spelled).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.array([len(text) for text in spelled], np.int64)
        symbols = tables.symbol[codes]
        cut = np.ones(len(codes) + 1, bool)
        if len(codes):
            cut[1:-1] = ~tables.joined[symbols[:-1], symbols[1:]]
        ends = np.cumsum(lengths)
        cut[ends] = True
        cut[ends - lengths] = True
        places = np.flatnonzero(cut)
        starts, stops = places[:-1], places[1:]
        #: per text, the range of its atoms
        self.first = np.searchsorted(starts, ends - lengths)
        self.last = np.searchsorted(starts, ends)
        keys = _Hashes(codes).of(starts, stops) ^ _mix((stops - starts).astype(_U))
        _, chosen, self.atom = np.unique(keys, return_index=True, return_inverse=True)
        sizes = stops[chosen] - starts[chosen]
        self.start = np.cumsum(sizes + 1) - (sizes + 1)
        self.end = self.start + sizes
        self.codes = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
        self.codes[_ranges(self.start, sizes)] = codes[_ranges(starts[chosen], sizes)]
        self._connect(sizes)
        self._sum()

    def _connect(self, sizes: np.ndarray) -> None:
        """All edges: each place and length whose characters are a piece."""
        tables = self.tables
        places = _ranges(self.start, sizes)
        self.stop = np.repeat(self.end, sizes + 1)
        hashes = _Hashes(self.codes)
        froms, ids, lengths = [], [], []
        fitting = []
        for length in range(1, tables.longest + 1):
            places = places[places + length <= self.stop[places]]
            fitting.append(places)
        for length in range(tables.longest, 0, -1):  # long pieces first: mostly the likely ones
            places = fitting[length - 1]
            found = tables.find(hashes.of(places, places + length))
            hit = found >= 0
            froms.append(places[hit])
            ids.append(found[hit])
            lengths.append(np.full(int(hit.sum()), length))
        every = _ranges(self.start, sizes)
        spelled = every[~tables.single[self.codes[every]]]
        froms.append(spelled)
        ids.append(tables.n + self.codes[spelled])
        lengths.append(np.ones(len(spelled), np.int64))
        froms, ids, lengths = map(np.concatenate, (froms, ids, lengths))
        order = np.argsort(froms, kind="stable")
        self.node, self.piece = froms[order], ids[order]
        self.target = self.node + lengths[order]
        self.width = np.ones(len(ids), np.int64)
        weight = np.empty(len(ids))
        by_bytes = self.piece >= tables.n
        weight[~by_bytes] = tables.weights[self.piece[~by_bytes]]
        if tables.vocabulary.byte_ids:
            character = self.piece[by_bytes] - tables.n
            self.width[by_bytes] = 1 + (character > 0x7F) + (character > 0x7FF) + (character > 0xFFFF)
        weight[by_bytes] = tables.byte * self.width[by_bytes]
        self.weight = weight
        #: the id of an edge that is one id
        self.single = self.piece.astype(np.int32)
        if tables.vocabulary.byte_ids:
            ascii_only = by_bytes & (self.piece < tables.n + 128)
            table = np.array(tables.vocabulary.byte_ids, np.int32)
            self.single[ascii_only] = table[self.piece[ascii_only] - tables.n]
        else:
            self.single[by_bytes] = tables.vocabulary.unknown

    def _sum(self) -> None:
        """The log of all ways from each place to its atom's end, and the edges' probabilities."""
        below = np.zeros(len(self.codes))
        left = self.stop[self.node] - self.node
        if len(left) and left.max() < 1 << 16:
            left = left.astype(np.uint16)  # sorted by digits
        order = np.argsort(left, kind="stable")  # edges of a node stay together
        sorted_left = left[order].astype(np.int64)
        bounds = np.flatnonzero(np.diff(sorted_left, prepend=-1, append=-1))
        for a, b in zip(bounds, bounds[1:], strict=False):
            own = order[a:b]
            value = self.weight[own] + below[self.target[own]]
            node = self.node[own]
            heads = np.flatnonzero(np.diff(node, prepend=-1))
            top = np.maximum.reduceat(value, heads)
            sizes = np.diff(heads, append=len(own))
            total = np.add.reduceat(np.exp(value - np.repeat(top, sizes)), heads)
            below[node[heads]] = top + np.log(total)
        self.below = below
        self.log_chance = self.weight + below[self.target] - below[self.node]
        chance = np.exp(self.log_chance)
        heads = np.flatnonzero(np.diff(self.node, prepend=-1))
        sizes = np.diff(heads, append=len(self.node))
        running = np.cumsum(chance)
        inside = running - np.repeat(running[heads] - chance[heads], sizes)
        #: the probability of an edge or one before it of its node; the last one's is certain
        self.inside = np.minimum(inside, 1.0)
        if len(heads):
            self.inside[heads + sizes - 1] = 2.0
        self.head = np.zeros(len(self.codes), np.int64)
        self.head[self.node[heads]] = heads
        self.size = np.zeros(len(self.codes), np.int64)
        self.size[self.node[heads]] = sizes

    def _edges(self, node: int) -> range:
        return range(int(self.head[node]), int(self.head[node] + self.size[node]))

    def sample(self, tokens: np.ndarray, stream: np.ndarray) -> _Paths:
        """One path of each atom, drawn by its probability."""
        node, stop = self.start[self.atom[tokens]], self.end[self.atom[tokens]]
        chance = np.zeros(len(tokens))
        alive = np.arange(len(tokens))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        while len(alive):
            u = _uniform(stream[alive], len(steps))
            edge = self.head[node[alive]]
            on = np.flatnonzero(u >= self.inside[edge])
            while len(on):
                edge[on] += 1
                on = on[u[on] >= self.inside[edge[on]]]
            steps.append((alive, edge))
            chance[alive] += self.log_chance[edge]
            node[alive] = self.target[edge]
            alive = alive[node[alive] < stop[alive]]
        counts = np.zeros(len(tokens), np.int64)
        for alive, _ in steps:
            counts[alive] += 1
        offset = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.int64)
        for step, (alive, edge) in enumerate(steps):
            flat[offset[alive] + step] = edge
        return _Paths(flat, counts, chance)

    def other_path(self, atom: int, excluded: list[tuple[int, ...]], uniforms: Iterator[float]) -> tuple[int, ...]:
        """A path of one atom, drawn from all but the excluded ones."""
        node, end, path = int(self.start[atom]), int(self.end[atom]), []
        rest = [(other, self._tails(other)) for other in excluded]
        while node < end:
            edges, depth = self._edges(node), len(path)
            masses = [math.exp(x) for x in self.log_chance[edges.start : edges.stop].tolist()]
            for i, e in enumerate(edges):
                own = [(other, tails) for other, tails in rest if other[depth] == e]
                if own:
                    left = 1.0 - sum(tails[depth + 1] for _, tails in own)
                    # excluded paths may be all there are; rounding must not leave a rest then
                    more = self._others(int(self.target[e]), [other for other, _ in own], depth)
                    masses[i] *= max(left, 0.0) if more else 0.0
            u, chosen = next(uniforms) * sum(masses), None
            for e, mass in zip(edges, masses, strict=True):
                if mass > 0:
                    chosen = e
                    u -= mass
                    if u < 0:
                        break
            path.append(chosen)
            rest = [(other, tails) for other, tails in rest if other[depth] == chosen]
            node = int(self.target[chosen])
        return tuple(path)

    def _tails(self, path: tuple[int, ...]) -> list[float]:
        """The probability of the path's rest from each of its places on."""
        tails, total = [1.0], 0.0
        for chance in reversed(self.log_chance[list(path)].tolist()):
            total += chance
            tails.append(math.exp(total))
        return tails[::-1]

    def _others(self, node: int, own: list[tuple[int, ...]], depth: int) -> bool:
        """Whether more paths go on from ``node`` than the rests of the given ones."""
        rests = len({path[depth + 1 :] for path in own})
        return self.paths_from(node, rests + 1) > rests

    def paths_from(self, node: int, limit: int) -> int:
        """The number of paths from a place to its atom's end, counted up to ``limit``."""
        end, count, todo = int(self.stop[node]), 0, [node]
        while todo and count < limit:
            at = todo.pop()
            if at == end:
                count += 1
                continue
            todo += [int(self.target[e]) for e in self._edges(at)]
        return count


@dataclass
class _Paths:
    """Paths of a run of atoms: edges one after the other, edges per atom, log probability."""

    edges: np.ndarray
    counts: np.ndarray
    chance: np.ndarray


@dataclass
class Segmentation:
    """One sampled segmentation of a text.

    ``perturbed`` is its log probability plus noise; ``log_inclusion`` the log of the chance that
    a path of this probability passes the largest perturbed value that was not drawn.
    """

    ids: np.ndarray
    log_probability: float
    perturbed: float
    log_inclusion: float


def _log_inclusion(log_probability: float, threshold: float) -> float:
    x = log_probability - threshold
    return x if x < -30 else float(np.log(-np.expm1(-np.exp(min(x, 700.0)))))


class _Search:
    """The best-first search of one text. Sets of paths are (place, excluded paths there).

    Of a split, as many sets are kept as can still matter: ``samples`` of them, the
    last for the threshold.
    """

    def __init__(self, lattice: Lattice, first: int, paths: _Paths, key: int, samples: int):
        self.lattice, self.first, self.samples = lattice, first, samples
        self.key = np.full(1, key, _U)
        gumbel = -np.log(-np.log(_uniform(_stream(self.key, 0, 0), 1 << 30)))
        self.draws = [paths]
        self.perturbed = [float(gumbel[0])]
        #: open sets: bound, draw they branch off from, place, excluded paths or None
        self.open: list[tuple[float, int, int, list | None]] = []
        #: what the last draw left to split: from which place on, and what is excluded there
        self.left: tuple[int, list | None] = (0, None)

    def _atom(self, place: int) -> int:
        return int(self.lattice.atom[self.first + place])

    def _path(self, draw: int, place: int) -> tuple[int, ...]:
        paths = self.draws[draw]
        end = int(paths.counts[: place + 1].sum())
        return tuple(int(e) for e in paths.edges[end - int(paths.counts[place]) : end])

    def split(self, bounds: np.ndarray, before: np.ndarray) -> None:
        """What is left of a set without the path drawn from it, as sets by place.

        ``bounds`` are those of the first places, ``before`` the log probability of what
        stands in front of each of the text's places. Later places are looked at only
        while one of them could still be among the best.
        """
        first, excluded = self.left
        draw = len(self.draws) - 1
        kept: list[tuple[float, int]] = []
        start = first
        while True:
            best = np.argsort(-bounds, kind="stable")[: self.samples]
            kept += [(float(bounds[i]), start + int(i)) for i in best if np.isfinite(bounds[i])]
            kept = sorted(kept, reverse=True)[: self.samples]
            start += len(bounds)
            if start == len(before) or (
                len(kept) == self.samples and before[start] + _MOST_NOISE < kept[-1][0]
            ):
                break
            places = np.arange(start, min(start + SPLIT_PLACES, len(before)))
            chance = self.draws[draw].chance[places]
            keys = np.broadcast_to(self.key, len(places))
            bounds = _bounds(before[places] + _log_rest(chance), keys, draw + 1, places, self.perturbed[-1])
        self.open += [(b, draw, at, excluded if at == first else None) for b, at in kept]

    def rest(self, place: int, excluded: list[tuple[int, ...]]) -> float:
        """The log of the mass of an atom's paths without the excluded ones."""
        lattice = self.lattice
        node = int(lattice.start[self._atom(place)])
        if lattice.paths_from(node, len(excluded) + 1) == len(excluded):
            return -np.inf
        total = sum(float(np.exp(lattice.log_chance[list(path)].sum())) for path in excluded)
        return float(np.log(1.0 - total)) if total < 1.0 else -np.inf

    def branch(self) -> int | None:
        """Take the best open set and draw its path up to the place where it branches off.

        Returns the place after it, from which on the path is free; None without a set.
        """
        if not self.open:
            return None
        best = max(range(len(self.open)), key=lambda i: self.open[i][0])
        bound, draw, place, excluded = self.open.pop(best)
        excluded = excluded or [self._path(draw, place)]
        state = int(_stream(self.key, len(self.draws), place)[0])
        own = self.lattice.other_path(self._atom(place), excluded, _uniforms(state))
        self.branched = (bound, draw, place, excluded, own)
        return place + 1

    def complete(self, rest: _Paths) -> None:
        """The drawn path, with the free part sampled."""
        bound, draw, place, excluded, own = self.branched
        old = self.draws[draw]
        kept = int(old.counts[:place].sum())
        chance = self.lattice.log_chance[list(own)].sum()
        self.draws.append(
            _Paths(
                np.concatenate([old.edges[:kept], np.array(own, np.int64), rest.edges]),
                np.concatenate([old.counts[:place], [len(own)], rest.counts]),
                np.concatenate([old.chance[:place], [chance], rest.chance]),
            )
        )
        self.perturbed.append(bound)
        self.left = (place, [*excluded, own])

    def threshold(self) -> float:
        """The largest perturbed value that was not drawn."""
        return max((o[0] for o in self.open), default=-np.inf)


#: Places of a text that are split at once.
SPLIT_PLACES = 256


def _log_rest(chance: np.ndarray) -> np.ndarray:
    """The log of 1 - p, from the log of p."""
    with np.errstate(divide="ignore"):
        return np.log(-np.expm1(np.minimum(chance, 0.0)))


def _bounds(masses, keys: np.ndarray, number: int, places: np.ndarray, bound) -> np.ndarray:
    """The maxima of sets: Gumbel variables at their log masses, given that they are below a bound."""
    noise = -np.log(-np.log(_uniform(_stream(keys, number, places), 1 << 30)))
    return -np.logaddexp(-bound, -(masses + noise))


def _split_all(searches: list[_Search]) -> None:
    """Split what the last draw of each text left; the first places of all texts at once."""
    sizes = np.array([len(s.draws[-1].chance) for s in searches])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    chance = np.concatenate([s.draws[-1].chance for s in searches])
    running = np.concatenate([[0.0], np.cumsum(chance)])
    firsts = np.array([s.left[0] for s in searches])
    lengths = np.minimum(SPLIT_PLACES, sizes - firsts)
    at = _ranges(starts + firsts, lengths)
    before = running[at] - np.repeat(running[starts], lengths)
    masses = before + _log_rest(chance[at])
    heads = np.cumsum(lengths) - lengths
    for head, search in zip(heads, searches, strict=True):
        place, excluded = search.left
        if excluded is not None:
            masses[head] = before[head] + search.rest(place, excluded)
    number = len(searches[0].draws)
    keys = np.repeat(np.concatenate([s.key for s in searches]), lengths)
    limits = np.repeat([s.perturbed[-1] for s in searches], lengths)
    bounds = _bounds(masses, keys, number, _ranges(firsts, lengths), limits)
    for search, head, length, start, end in zip(searches, heads, lengths, starts, ends, strict=True):
        search.split(bounds[head : head + length], running[start:end] - running[start])


def _ids(lattice: Lattice, edges: np.ndarray) -> np.ndarray:
    """Edges as piece ids, characters without a piece as bytes."""
    width = lattice.width[edges]
    if len(width) == 0 or width.max() == 1:
        return lattice.single[edges]
    pieces, n, vocabulary = lattice.piece[edges], lattice.tables.n, lattice.tables.vocabulary
    spelled = pieces >= n
    result = np.repeat(pieces, width)
    ends = np.cumsum(width)
    table = np.array(vocabulary.byte_ids)
    character = pieces[spelled] - n
    wide, at = width[spelled], (ends - width)[spelled]
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
    result[at] = table[lead[wide] | (character >> (6 * (wide - 1)))]
    for k in range(1, 4):
        more = wide > k
        byte = 0x80 | ((character[more] >> (6 * (wide[more] - 1 - k))) & 0x3F)
        result[at[more] + k] = table[byte]
    return result.astype(np.int32)


def segment(
    texts: list[str], keys: list[int], tables: Tables, samples: int = SAMPLES
) -> list[list[Segmentation]]:
    """For each text up to ``samples`` distinct segmentations, best perturbed value first.

    Fewer if the text has fewer; none for an empty text.
    """
    if samples < 1:
        raise ValueError("at least one sample")
    lattice = Lattice(texts, tables)
    counts = lattice.last - lattice.first
    seeds = np.array(keys, np.int64).view(_U)

    def draw(number: int, which: list[int], places: list[int]) -> list[_Paths]:
        """Sampled paths of the listed texts from a place on, all at once."""
        own = np.array(which, np.int64)
        from_place = np.array(places, np.int64)
        lengths = counts[own] - from_place
        place = _ranges(from_place, lengths)
        tokens = np.repeat(lattice.first[own], lengths) + place
        paths = lattice.sample(tokens, _stream(np.repeat(_stream(seeds[own], number), lengths), place))
        cuts = np.cumsum(lengths)[:-1]
        edges = np.cumsum(paths.counts)
        edge_cuts = np.concatenate([[0], edges])[cuts]
        return [
            _Paths(*parts)
            for parts in zip(
                np.split(paths.edges, edge_cuts),
                np.split(paths.counts, cuts),
                np.split(paths.chance, cuts),
                strict=True,
            )
        ]

    some = [i for i in range(len(texts)) if counts[i]]
    if not some:
        return [[] for _ in texts]
    searches = {
        i: _Search(lattice, int(lattice.first[i]), paths, int(seeds[i]), samples)
        for i, paths in zip(some, draw(0, some, [0] * len(some)), strict=True)
    }
    _split_all(list(searches.values()))
    for number in range(1, samples):
        branched = {i: search.branch() for i, search in searches.items() if len(search.draws) == number}
        places = {i: place for i, place in branched.items() if place is not None}
        if not places:
            break
        for i, paths in zip(places, draw(number, list(places), list(places.values())), strict=True):
            searches[i].complete(paths)
        _split_all([searches[i] for i in places])
    return [_segmentations(searches[i]) if i in searches else [] for i in range(len(texts))]


def _segmentations(search: _Search) -> list[Segmentation]:
    threshold = search.threshold()
    found = []
    for paths, perturbed in zip(search.draws, search.perturbed, strict=True):
        chance = float(paths.chance.sum())
        ids = _ids(search.lattice, paths.edges)
        found.append(Segmentation(ids, chance, perturbed, _log_inclusion(chance, threshold)))
    return found


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most CHARACTERS characters together, or of one text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > CHARACTERS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def sample_segmentations(
    documents: DataFrame,
    vocabulary: Vocabulary,
    samples: int = SAMPLES,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Up to ``samples`` rows per row of ``documents``.

    doc_id, sample (from 1), ids, log_prob, perturbed, log_inclusion and ``decoded``: whether
    decoding the ids gives the text. A text with fewer segmentations gives fewer rows; an
    empty or null text one, with no ids, probability 1 and a null perturbed value. Rows with
    equal ids and texts get equal samples. A literal ``▁`` decodes to a blank, as in the
    library, and counts as decoded.
    """

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(vocabulary)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            keys = batch.column("key").to_pylist()
            for start, end in _groups(texts):
                found = segment(texts[start:end], keys[start:end], tables, samples)
                yield _rows(batch.column("doc_id").slice(start, end - start), texts[start:end], found)

    def _rows(ids: pa.Array, texts: list[str], found: list[list[Segmentation]]) -> pa.RecordBatch:
        empty = Segmentation(np.zeros(0, np.int32), 0.0, np.nan, 0.0)
        rows = [(i, k + 1, s) for i, own in enumerate(found) for k, s in enumerate(own or [empty])]
        lengths = np.cumsum([0] + [len(s.ids) for _, _, s in rows])
        flat = np.concatenate([s.ids for _, _, s in rows]) if rows else np.zeros(0, np.int32)

        def number(name: str) -> pa.Array:
            return pa.array([getattr(s, name) for _, _, s in rows], pa.float64(), from_pandas=True)

        plain = [text.replace(BLANK, " ") for text in texts]
        return pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array([i for i, _, _ in rows], pa.int32())),
                pa.array([k for _, k, _ in rows], pa.int32()),
                pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat, pa.int32())),
                number("log_probability"),
                number("perturbed"),
                number("log_inclusion"),
                pa.array([decode(s.ids, vocabulary) == plain[i] for i, _, s in rows]),
            ],
            ["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion", "decoded"],
        )

    narrow = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(doc_id), F.lit(seed)).alias("key"),
        F.col(text).alias("text"),
    )
    kind = dict(narrow.dtypes)["doc_id"]
    return map_partitions(
        narrow,
        sampled,
        f"doc_id {kind}, sample int, ids array<int>, log_prob double, perturbed double,"
        " log_inclusion double, decoded boolean",
        rows=400,
    )
