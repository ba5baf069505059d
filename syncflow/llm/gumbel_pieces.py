"""Sampling segmentations into sentence pieces without replacement.

All segmentations of a text form a lattice: an edge is a piece of the vocabulary,
its weight a Zipf-Mandelbrot probability of the piece's rank; a character without
a piece of its own is spelled in byte pieces. A path's probability is the product
of its weights, normalised over all paths.

Gumbel top-k gives k different paths: each path's log-probability is perturbed by
independent Gumbel noise and the k largest are taken. They are found by A* search
without touching the rest. A set of paths with log-probability ``m`` has a largest
perturbed value of distribution Gumbel(m), so the search keeps open sets with the
value of their best member. The best set is opened: its best path is sampled, and
what is left of the set splits into the siblings of each step of that path, whose
best values are Gumbel too, cut off at the value of the path. Backward sums over
the lattice give all probabilities. The value of the best set left unopened is the
threshold; a path's inclusion score is its probability of exceeding it.

A unit of a text is a run of blanks with the word behind it. Pieces do not go on
from a word to a blank, so no piece crosses the start of a unit, and lattices are
built once per different unit of a batch; pieces of several blanks are edges like
others. A vocabulary with pieces of words and later blanks is refused. Documents of
a batch are sampled in step, with numpy. Random numbers come from a hash of the row
key and the place they are used at, so a row gives the same samples in any batch,
order or attempt.

Defined results: a null text is sampled as the empty text, which has one
segmentation, without pieces. A text with fewer segmentations than asked for
gives all it has, with inclusion 1. Equal keys and texts give equal samples. Very
long texts are sampled whole; a unit's lattice is linear in its length. A mark
`▁` in a text is no blank, but a character without a piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import cached_property
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Shift of the ranks in the weights, as in the Zipf-Mandelbrot law.
RANK_SHIFT = 2.7
#: Characters that are sampled together, and rows whose texts are held as such.
GROUP_CHARS = 1 << 20
SLICE_ROWS = 1 << 10
#: Rows that are decoded together.
DECODE_ROWS = 1 << 8
#: Edges of units' lattices beyond which a task starts anew.
KEPT_EDGES = 2 << 20


@dataclass
class Vocabulary:
    """A trie over the pieces, and their log-weights."""

    pieces: list[bytes]
    log_weight: np.ndarray
    first_byte: int
    classes: np.ndarray
    n_classes: int
    moves: np.ndarray
    targets: np.ndarray
    piece_of: np.ndarray
    longest: int

    @cached_property
    def starts(self) -> np.ndarray:
        """The state that each class of letters leads to from the root; 0 if none."""
        out = np.zeros(self.n_classes, np.int32)
        root = self.moves < self.n_classes
        out[self.moves[root]] = self.targets[root]
        out[0] = 0
        return out

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a sentencepiece model with byte pieces."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        names = [model.id_to_piece(i) for i in ids]
        first_byte = model.piece_to_id("<0x00>")
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i)}
        spelled = [
            bytes([int(names[i][3:5], 16)]) if model.is_byte(i)
            else b"" if i in special
            else names[i].replace(SPACE, " ").encode()
            for i in ids
        ]
        by_score = sorted(ids, key=lambda i: (-model.get_score(i), i))
        rank = np.empty(len(names))
        rank[by_score] = np.arange(len(names))
        log_weight = -np.log(rank + RANK_SHIFT)
        log_weight -= np.log(np.exp(log_weight).sum())
        usable = [
            i
            for i in ids
            if not (i in special or model.is_byte(i) or model.is_unused(i)) and names[i]
        ]
        if any(SPACE in names[i].lstrip(SPACE) for i in usable):
            raise ValueError("the vocabulary has pieces that go on from a word to a blank")
        letters = sorted({c for i in usable for c in names[i]})
        classes = np.zeros(0x110000, np.int32)
        classes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        width = len(letters) + 1
        states: dict[tuple[int, int], int] = {}
        piece_of = [-1]
        for i in usable:
            state = 0
            for c in names[i]:
                move = (state, int(classes[ord(c)]))
                if move not in states:
                    states[move] = len(piece_of)
                    piece_of.append(-1)
                state = states[move]
            piece_of[state] = i
        if len(piece_of) * width >= 1 << 31:
            raise ValueError("the vocabulary is too large")
        # Texts are read with their blanks; the mark itself has no piece.
        classes[ord(" ")], classes[ord(SPACE)] = classes[ord(SPACE)], 0
        moves = np.array([s * width + c for s, c in states], np.int32)
        order = np.argsort(moves)
        return cls(
            spelled,
            log_weight,
            first_byte,
            classes,
            width,
            moves[order],
            np.array(list(states.values()), np.int32)[order],
            np.array(piece_of, np.int32),
            max(len(names[i]) for i in usable),
        )

    def decode(self, ids) -> str:
        """The text of a list of piece ids."""
        joined = b"".join([self.pieces[i] for i in ids])
        return joined.removeprefix(b" ").decode("utf-8", "replace")


# ---------------------------------------------------------------------- lattice


@dataclass
class Lattice:
    """Edges of many words, by source node; the longest piece first within a node.

    A word of n characters has n + 1 nodes. ``piece`` is a piece id, or -1 less a
    code point that is spelled in bytes.
    """

    start: np.ndarray
    final: np.ndarray
    first: np.ndarray
    node: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    log_p: np.ndarray
    #: Probability of this edge of its node and those before it.
    below: np.ndarray


#: Words whose lattices are built together.
BUILD_WORDS = 1 << 14


def build_lattice(words: list[str], vocabulary: Vocabulary) -> Lattice:
    """The lattices of units, each to be read after a blank."""
    parts = [
        _build_part(words[at : at + BUILD_WORDS], vocabulary)
        for at in range(0, len(words), BUILD_WORDS)
    ]
    nodes = edges = 0
    for part in parts:
        for of_nodes in (part.start, part.final, part.node, part.target):
            of_nodes += nodes
        part.first += edges
        nodes += len(part.first) - 1
        edges += len(part.node)
    return Lattice(
        *(
            np.concatenate([getattr(p, f.name)[:-1] if f.name == "first" else getattr(p, f.name) for p in parts])
            for f in fields(Lattice)
        )
    )


def _behind(before: Lattice | None, new: Lattice) -> Lattice:
    """Lattices of more units, behind those there are."""
    if before is None:
        return new
    for of_nodes in (new.start, new.final, new.node, new.target):
        of_nodes += len(before.first)
    new.first += len(before.node)
    return Lattice(
        *(np.concatenate((getattr(before, f.name), getattr(new, f.name))) for f in fields(Lattice))
    )


def _build_part(words: list[str], vocabulary: Vocabulary) -> Lattice:
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    joined = "".join([" " + w for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.int32)
    ends = np.cumsum(lengths)
    word_of = np.repeat(np.arange(len(words)), lengths)
    left = ends[word_of] - np.arange(len(codes))
    classes = vocabulary.classes[codes]
    # Walk the trie from all characters at once; the longest pieces come first.
    found_at: list[tuple[np.ndarray, np.ndarray, int]] = []
    at, state = np.arange(len(codes)), np.zeros(len(codes), np.int32)
    for step in range(1, vocabulary.longest + 1):
        if not len(at):
            break
        here = classes[at + step - 1]
        if step == 1:
            # From the root, where most walks are, a letter leads straight on.
            state = vocabulary.starts[here]
            found = state > 0
            at, state = at[found], state[found]
        else:
            moves = state * np.int32(vocabulary.n_classes) + here
            place = np.minimum(np.searchsorted(vocabulary.moves, moves), len(vocabulary.moves) - 1)
            found = (vocabulary.moves[place] == moves) & (here > 0)
            at, state = at[found], vocabulary.targets[place[found]]
        piece = vocabulary.piece_of[state]
        whole = piece >= 0
        found_at.append((at[whole], piece[whole], step))
        more = left[at] > step
        at, state = at[more], state[more]
    lone = np.ones(len(codes), bool)
    for own, _, step in found_at[:1]:
        lone[own] = False
    bare = np.flatnonzero(lone)
    found_at.insert(0, (bare, -1 - codes[bare], 1))
    count = np.zeros(len(codes), np.int64)
    for own, _, _ in found_at:
        count[own] += 1
    row = np.repeat(np.arange(len(codes)), count)
    place = np.cumsum(count) - count
    piece, length = np.empty(len(row), np.int32), np.empty(len(row), np.int64)
    for own, ids, step in reversed(found_at):
        spots = place[own]
        piece[spots], length[spots] = ids, step
        place[own] += 1
    weight = vocabulary.log_weight[np.maximum(piece, 0)]
    spelled = np.flatnonzero(piece < 0)
    point = -1 - piece[spelled]
    n_bytes = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)
    weight[spelled] = n_bytes * vocabulary.log_weight[vocabulary.first_byte]

    # Backward sums, from the ends of all words at once. Node = character + word.
    node = row + word_of[row]
    target = node + length
    sums = np.zeros(len(codes) + len(words))
    edge_left = left[row]
    if len(edge_left) and edge_left.max() < 1 << 15:
        edge_left = edge_left.astype(np.int16)  # sorted by radix
    order = np.argsort(edge_left, kind="stable")
    by_left = edge_left[order]
    cuts = np.r_[np.flatnonzero(np.r_[True, by_left[1:] != by_left[:-1]]), len(order)]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        edges = order[low:high]
        nodes = node[edges]
        values = weight[edges] + sums[target[edges]]
        begin = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        top = np.maximum.reduceat(values, begin)
        each = np.diff(np.r_[begin, len(nodes)])
        total = np.add.reduceat(np.exp(values - np.repeat(top, each)), begin)
        sums[nodes[begin]] = top + np.log(total)
    log_p = np.minimum(weight + sums[target] - sums[node], 0.0)

    count = np.bincount(node, minlength=len(sums))
    first = np.r_[0, np.cumsum(count)]
    # Sums within a node only: the same in any batch, to the last bit.
    below = np.exp(log_p)
    place = np.arange(len(node)) - first[node]
    at = np.flatnonzero(place == 1)
    while len(at):
        below[at] += below[at - 1]
        at = at[at + 1 < len(place)] + 1
        at = at[place[at] > 1]
    last = first[1:][count > 0] - 1
    below[last] = np.inf
    log_p[last[count[count > 0] == 1]] = 0.0
    # An end has no edges; nothing is drawn there.
    small = lambda x: x.astype(np.int32)
    final = ends + np.arange(len(words))
    return Lattice(
        final - lengths, final, first, small(node), small(target), small(piece), log_p, below
    )


# --------------------------------------------------------------------- sampling

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keyed(seeds: np.ndarray, *places) -> np.ndarray:
    """Seeds for a place; what many places share should come first."""
    for place in places:
        seeds = _mixed(seeds + (np.atleast_1d(place).astype(np.uint64) + np.uint64(1)) * _GOLDEN)
    return seeds


def uniforms(seeds: np.ndarray, *places) -> np.ndarray:
    """Numbers above 0 and below 1, by seed and place."""
    x = keyed(seeds, *places)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


#: No Gumbel value drawn from such numbers is above this.
LARGEST_NOISE = -np.log(-np.log1p(-(2.0**-54))) + 1e-6
#: Steps of a path that are looked at first for sets to open.
HEAD_STEPS = 64
#: Log-probability of sets whose noise is drawn only if it could matter.
LITTLE_MASS = -60.0

#: What random numbers are used for; part of their seeds.
_WALK, _BESIDE, _CHOICE, _REST, _FIRST = range(5)


def _draw(lattice: Lattice, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
    """An edge of each node; long pieces, mostly the likely ones, are looked at first."""
    edges = lattice.first[nodes]
    todo = np.flatnonzero(u >= lattice.below[edges])
    while len(todo):
        edges[todo] += 1
        todo = todo[u[todo] >= lattice.below[edges[todo]]]
    return edges


@dataclass
class _Paths:
    """A path per document: edges in order, the word of each, and where documents begin."""

    edges: np.ndarray
    words: np.ndarray
    begin: np.ndarray

    def of(self, d: int) -> slice:
        return slice(self.begin[d], self.begin[d + 1])


def _sample(
    lattice: Lattice, nodes: np.ndarray, final: np.ndarray, seeds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Paths from nodes to the ends of their words: edges in order, and how many each has."""
    counts = np.zeros(len(nodes), np.int64)
    active = np.flatnonzero(nodes != final)
    at = nodes[active]
    walked = []
    step = 0
    while len(active):
        edges = _draw(lattice, at, uniforms(seeds[active], step))
        walked.append((active, edges))
        counts[active] += 1
        at = lattice.target[edges]
        more = at != final[active]
        active, at = active[more], at[more]
        step += 1
    offsets = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    for step, (who, edges) in enumerate(walked):
        out[offsets[who] + step] = edges
    return out, counts


def _cut_gumbel(log_mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Best values of sets of that mass, given that they are at most ``bound``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        value = log_mass - np.log(np.exp(log_mass - bound) - np.log(u))
    return np.where(np.isneginf(log_mass), -np.inf, np.minimum(value, bound))


@dataclass
class _OpenSet:
    """Siblings of step ``at`` of a path: all edges of the node but those taken."""

    value: float
    path: int
    at: int
    taken: tuple[int, ...]


class _Numbers(dict):
    """Numbers for words, in order of appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


_UNIT = re.compile(" ( *[^ ]*)")


def units(text: str) -> list[str]:
    """The units of a text that is read after a blank, each without its first blank."""
    if not text:
        return []
    if text[0] != " " and "  " not in text:
        return text.split(" ")
    return _UNIT.findall(" " + text)


class _Known:
    """Units and their lattices, kept from group to group; a lattice depends on its unit only."""

    def __init__(self):
        self.numbers, self.lattice, self.built = _Numbers(), None, 0

    def number(self, texts: list[str], vocabulary: Vocabulary) -> list[list[int]]:
        """The units of texts as numbers of lattices; unknown ones are built together."""
        if self.lattice is not None and len(self.lattice.node) > KEPT_EDGES:
            self.__init__()
        numbers = [list(map(self.numbers.__getitem__, units(t))) for t in texts]
        if len(self.numbers) > self.built:
            new = list(islice(self.numbers, self.built, None))
            self.lattice = _behind(self.lattice, build_lattice(new, vocabulary))
            self.built = len(self.numbers)
        return numbers


class _Group:
    """The search over the documents of one group."""

    def __init__(self, texts: list[str], seeds: np.ndarray, vocabulary: Vocabulary, known: _Known):
        per_text = known.number(texts, vocabulary)
        self.lattice = known.lattice
        self.vocabulary, self.seeds, self.n = vocabulary, seeds, len(texts)
        lengths = np.array([len(w) for w in per_text], np.int64)
        self.word_begin = np.r_[0, np.cumsum(lengths)]
        self.types = np.fromiter(chain.from_iterable(per_text), np.int64, int(lengths.sum()))
        self.doc_of = np.repeat(np.arange(self.n), lengths)
        self.place = np.arange(len(self.types)) - self.word_begin[self.doc_of]

    def _walk(self, words: np.ndarray, nodes: np.ndarray, attempt: int):
        docs = self.doc_of[words]
        return _sample(
            self.lattice,
            nodes,
            self.lattice.final[self.types[words]],
            keyed(keyed(self.seeds, _WALK, attempt)[docs], self.place[words]),
        )

    def run(self, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """Per document: (edges, log_prob, perturbed value, inclusion) of k paths at most."""
        if self.lattice is None:
            best = -np.log(-np.log(uniforms(self.seeds, _FIRST)))
            return [[(np.zeros(0, np.int64), 0.0, float(b), 1.0)] for b in best]
        words = np.arange(len(self.types))
        edges, counts = self._walk(words, self.lattice.start[self.types], 0)
        owner = np.repeat(words, counts)
        begin = np.searchsorted(owner, self.word_begin)
        paths = [_Paths(edges, owner, begin)]
        value = -np.log(-np.log(uniforms(self.seeds, _FIRST)))
        found = [[(0, float(v))] for v in value]
        opened: list[list[_OpenSet]] = [[] for _ in range(self.n)]
        self._siblings(paths[0], 0, np.zeros(self.n, np.int64), value, opened, k)
        for attempt in range(1, k):
            chosen = {}
            for d in range(self.n):
                if opened[d]:
                    best = max(opened[d], key=lambda s: s.value)
                    opened[d].remove(best)
                    chosen[d] = best
            if not chosen:
                break
            paths.append(self._branch(paths, chosen, opened, attempt, found, k))
        return [self._finish(d, paths, found[d], opened[d]) for d in range(self.n)]

    def _siblings(self, path, number, since, bound, opened, k) -> None:
        """Open the sets beside a path, from step ``since`` of each document on.

        What lies behind a path's first steps is soon too unlikely to matter, so whole
        paths are looked at only where that is not so.
        """
        docs = np.arange(self.n)
        docs = self._open(path, number, since, bound, opened, k, docs, HEAD_STEPS)
        if len(docs):
            self._open(path, number, since, bound, opened, k, docs, None)

    def _open(self, path, number, since, bound, opened, k, docs, limit) -> np.ndarray:
        """Open sets beside the first ``limit`` steps; the documents that need more of them."""
        whole = np.diff(path.begin)[docs]
        lengths = whole if limit is None else np.minimum(whole, limit)
        ends = np.cumsum(lengths)
        step = np.arange(lengths.sum()) - np.repeat(ends - lengths, lengths)
        doc = np.repeat(docs, lengths)
        log_p = self.lattice.log_p[path.edges[path.begin[doc] + step]]
        each = np.split(log_p, ends[:-1]) if len(docs) else []
        sums = [np.cumsum(own) for own in each]
        behind = np.array([own[-1] if len(own) else 0.0 for own in sums])
        with np.errstate(divide="ignore"):
            mass = np.concatenate([np.zeros(0), *sums]) - log_p + np.log(-np.expm1(log_p))
        mass[step < since[doc]] = -np.inf
        seeds = keyed(self.seeds, _BESIDE, number)
        value = np.full(len(mass), -np.inf)

        def put(at: np.ndarray) -> None:
            u = uniforms(seeds[doc[at]], step[at])
            value[at] = _cut_gumbel(mass[at], bound[doc[at]], u)

        # The noise has a largest value, so steps of little mass need none unless
        # fewer than k of the others are above what they could reach.
        put(np.flatnonzero(mass > LITTLE_MASS))
        more = (lengths < whole) & (behind > LITTLE_MASS)
        # No more than the k best of a path can ever be opened, or be the threshold.
        for i, (d, low, high) in enumerate(zip(docs.tolist(), (ends - lengths).tolist(), ends.tolist())):
            own = value[low:high]
            if not len(own) or more[i]:
                continue
            if np.count_nonzero(own > LITTLE_MASS + LARGEST_NOISE) < k:
                if lengths[i] < whole[i]:
                    more[i] = True
                    continue
                put(low + np.flatnonzero(mass[low:high] <= LITTLE_MASS))
            top = np.argpartition(-own, k - 1)[:k] if len(own) > k else np.arange(len(own))
            for t in top:
                if own[t] > -np.inf:
                    edge = int(path.edges[path.begin[d] + t])
                    opened[d].append(_OpenSet(float(own[t]), number, int(t), (edge,)))
        return docs[more]

    def _branch(self, paths, chosen, opened, attempt, found, k) -> _Paths:
        """Sample the best path of each chosen set, and open what is left of the sets."""
        lattice = self.lattice
        first_edge, first_word, heads = {}, {}, {}
        since = np.zeros(self.n, np.int64)
        bound = np.full(self.n, -np.inf)
        docs = np.fromiter(chosen, np.int64, len(chosen))
        steps = np.array([best.at for best in chosen.values()])
        draws, noise = (
            uniforms(self.seeds[docs], use, attempt, steps).tolist() for use in (_CHOICE, _REST)
        )
        for (d, best), draw, u in zip(chosen.items(), draws, noise, strict=True):
            path = paths[best.path]
            at = path.begin[d] + best.at
            node = lattice.node[path.edges[at]]
            beside = range(int(lattice.first[node]), int(lattice.first[node + 1]))
            rest = [e for e in beside if e not in best.taken]
            p = lattice.log_p[rest]
            p = np.exp(p - p.max())
            choice = int(np.searchsorted(np.cumsum(p), draw * p.sum(), "right"))
            choice = min(choice, len(rest) - 1)
            pick = rest.pop(choice)
            first_edge[d], first_word[d] = pick, int(path.words[at])
            heads[d] = slice(int(path.begin[d]), int(at))
            since[d], bound[d] = best.at + 1, best.value
            found[d].append((attempt, best.value))
            if rest:
                before = lattice.log_p[path.edges[heads[d]]].sum()
                mass = before + np.logaddexp.reduce(lattice.log_p[rest])
                value = float(_cut_gumbel(mass, best.value, u))
                if value > -np.inf:
                    opened[d].append(_OpenSet(value, best.path, best.at, (*best.taken, pick)))
        # The branched words go on behind their new edge, later words start anew.
        words = np.concatenate(
            [np.arange(first_word[d], self.word_begin[d + 1]) for d in chosen]
        )
        nodes = lattice.start[self.types[words]]
        sizes = np.array([self.word_begin[d + 1] - first_word[d] for d in chosen])
        nodes[np.cumsum(sizes) - sizes] = lattice.target[[first_edge[d] for d in chosen]]
        tail, counts = self._walk(words, nodes, attempt)
        tail_words = np.repeat(words, counts)
        bounds = np.searchsorted(tail_words, self.word_begin)
        edges, owners, lengths = [], [], np.zeros(self.n, np.int64)
        for d, best in chosen.items():
            path = paths[best.path]
            own = slice(bounds[d], bounds[d + 1])
            edges += [path.edges[heads[d]], [first_edge[d]], tail[own]]
            owners += [path.words[heads[d]], [first_word[d]], tail_words[own]]
            lengths[d] = sum(map(len, edges[-3:]))
        new = _Paths(
            np.concatenate(edges).astype(np.int64),
            np.concatenate(owners).astype(np.int64),
            np.r_[0, np.cumsum(lengths)],
        )
        self._siblings(new, attempt, since, bound, opened, k)
        return new

    def _finish(self, d, paths, found, opened):
        threshold = max((s.value for s in opened), default=-np.inf)
        out = []
        for number, value in found:
            path = paths[number]
            edges = path.edges[path.of(d)]
            log_prob = float(self.lattice.log_p[edges].sum())
            inclusion = 1.0
            if threshold > -np.inf:
                inclusion = float(-np.expm1(-np.exp(min(log_prob - threshold, 700.0))))
            out.append((edges, log_prob, value, inclusion))
        return out

    def ids(self, edges: np.ndarray) -> np.ndarray:
        """Piece ids of a path; characters without a piece become byte pieces."""
        if not len(edges):
            return np.zeros(0, np.int32)
        piece = self.lattice.piece[edges]
        bare = np.flatnonzero(piece < 0)
        if not len(bare):
            return piece.astype(np.int32)
        first = self.vocabulary.first_byte
        point = -1 - piece[bare]
        if (point < 0x80).all():
            piece[bare] = first + point
            return piece.astype(np.int32)
        out: list[int] = []
        for p in piece.tolist():
            if p >= 0:
                out.append(p)
            else:
                out += [first + b for b in chr(-1 - p).encode("utf-8", "surrogatepass")]
        return np.array(out, np.int32)


def sample_texts(
    texts: list[str | None],
    keys: np.ndarray,
    vocabulary: Vocabulary,
    k: int,
    known: _Known | None = None,
) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """(text number, rank, ids, log_prob, perturbed, inclusion), ranks from 1."""
    known = known or _Known()
    seeds = _mixed(keys.astype(np.int64).view(np.uint64) + _GOLDEN)
    begin = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held < GROUP_CHARS and i < len(texts) - 1:
            continue
        group = _Group(
            [t or "" for t in texts[begin : i + 1]], seeds[begin : i + 1], vocabulary, known
        )
        for d, paths in enumerate(group.run(k)):
            for rank, (edges, log_prob, value, inclusion) in enumerate(paths, 1):
                yield begin + d, rank, group.ids(edges), log_prob, value, inclusion
        begin, held = i + 1, 0


def _emit(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, k: int, verify: bool
) -> Iterator[pa.RecordBatch]:
    """Samples of each row, with the row's other columns."""
    known = _Known()
    spelled = _Spelling(vocabulary.pieces) if verify else None
    for whole in batches:
        for at in range(0, len(whole), SLICE_ROWS):
            batch = whole.slice(at, SLICE_ROWS)
            rest = batch.drop_columns(["row_key", "text"])
            keys = batch["row_key"].to_numpy(zero_copy_only=False)
            texts = batch["text"].to_pylist()
            rows: list[tuple] = []
            held = 0
            for row in sample_texts(texts, keys, vocabulary, k, known):
                rows.append(row)
                held += len(row[2]) + 16
                if held > 1 << 19:
                    yield _as_batch(rest, rows, texts, spelled)
                    rows, held = [], 0
            if rows:
                yield _as_batch(rest, rows, texts, spelled)


def _as_batch(
    rest: pa.RecordBatch, rows: list[tuple], texts: list[str | None], spelled: _Spelling | None
) -> pa.RecordBatch:
    numbers, ranks, ids, log_probs, values, inclusions = zip(*rows, strict=True)
    offsets = np.r_[0, np.cumsum([len(i) for i in ids])].astype(np.int32)
    flat = np.concatenate(ids)
    found = {
        "rank": pa.array(np.array(ranks, np.int32)),
        "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
        "log_prob": pa.array(np.array(log_probs)),
        "perturbed": pa.array(np.array(values)),
        "inclusion": pa.array(np.array(inclusions)),
    }
    if spelled is not None:
        found["round_trip"] = pa.array(_decoded_right(flat, offsets, numbers, texts, spelled))
    carried = rest.take(pa.array(numbers, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [*carried.columns, *found.values()], [*carried.schema.names, *found]
    )


class _Spelling:
    """The bytes of all pieces, and where each one's begin."""

    def __init__(self, pieces: list[bytes]):
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.sizes = np.fromiter(map(len, pieces), np.int32, len(pieces))
        self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes

    def decoded(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of many pieces, and where each one's end."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes, dtype=np.int32)
        places = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        places += np.arange(len(places), dtype=np.int32)
        return self.data[places].tobytes(), ends


def _decoded_right(
    flat: np.ndarray, offsets: np.ndarray, numbers, texts: list[str | None], spelling: _Spelling
) -> list[bool]:
    """Whether the bytes of the pieces are a blank and the text; of no pieces, the empty text."""
    data, ends = spelling.decoded(flat)
    places = np.r_[0, ends][offsets].tolist()
    view = memoryview(data)
    right, last, whole = [], None, b""
    for number, low, high in zip(numbers, places[:-1], places[1:], strict=True):
        if number != last:
            last, text = number, texts[number]
            whole = b" " + text.encode() if text else b""
        right.append(view[low:high] == whole)
    return right


def sample_segmentations(
    docs: DataFrame,
    vocabulary: Vocabulary,
    key: Column,
    text_col: str = "text",
    *,
    k: int = 3,
    verify: bool = False,
) -> DataFrame:
    """``row`` (the input row without its text), ``rank``, ``ids``, ``log_prob``,
    ``perturbed`` and ``inclusion``: ``k`` rows per document at most.

    ``key`` seeds a row's samples. The vocabulary is broadcast; its size is fixed. With
    ``verify``, ``round_trip`` tells whether the decoded ids are the text again.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
        F.xxhash64(key).alias("row_key"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = (
        f"row {rows.schema['row'].dataType.simpleString()}, rank int, ids array<int>, "
        "log_prob double, perturbed double, inclusion double"
    ) + (", round_trip boolean" if verify else "")
    return rows.mapInArrow(lambda b: _emit(b, shared.value, k, verify), schema)


def decode_ids(ids: Column, vocabulary: Vocabulary, session) -> Column:
    """The text of a column of piece ids; null for null."""
    shared = session.sparkContext.broadcast(vocabulary.pieces)

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        pieces = shared.value
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        spelled = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.cumsum(sizes) - sizes
        offsets = column.offsets.to_numpy()
        values = column.values.to_numpy(zero_copy_only=False)
        known = column.is_valid().to_pylist()
        parts = [pa.array([], pa.string())]
        for at in range(0, len(column), DECODE_ROWS):
            out: list[str | None] = []
            rows = offsets[at : at + DECODE_ROWS + 1]
            own = values[rows[0] : rows[-1]]
            n = sizes[own]
            ends = np.r_[0, np.cumsum(n)]
            data = spelled[np.repeat(starts[own] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
            cuts = ends[rows - rows[0]].tolist()
            for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True), at):
                text = data[low:high].removeprefix(b" ").decode("utf-8", "replace")
                out.append(text if known[i] else None)
            parts.append(pa.array(out, pa.string()))
        return pa.concat_arrays(parts)

    return decoded(ids)
