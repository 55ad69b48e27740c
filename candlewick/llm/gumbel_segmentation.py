"""Subword segmentations sampled without replacement: Gumbel top-k by A* over the lattice.

The lattice of a text has a node for each position and an edge for each vocabulary piece (or byte
fallback of one character).  A piece's weight comes from its rank in the given vocabulary by a
Zipf-Mandelbrot law; nothing is trained.  Backward sums turn the weights into exact conditional
probabilities, so that the lattice is a sampler of whole segmentations.

Top-down Gumbel perturbation gives a region of segmentations (a common prefix, with the edges
excluded after it) the maximum of its members' perturbed log probabilities, drawn without
listing them.  A* pops the best region, walks its best member, and splits the region into one for
each step of that walk.  The members popped first are the k best perturbed ones: k distinct samples
without replacement, with their inclusion probabilities.

No piece crosses a word start or a line break, so the lattice is a chain of the lattices of words, which
a task keeps for the words it meets (up to a number of bytes) and walks for all texts of a batch together.  All random
numbers are hashes of (row key, sample, position): results do not depend on batches or tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from hashlib import sha256
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import Numbers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
#: Below 1, flatter than the pieces' own weights: more varied segmentations.
SMOOTHING = 0.3
ZIPF_OFFSET = 2700.0
#: Bytes of word lattices that a task keeps beside those of the texts at hand; it starts afresh beyond that
#: (results do not change).  A word counts by its size, so texts without spaces are no exception.
KEPT_BYTES = 128 << 20
#: Bytes of a word's entry in the dictionary.
ENTRY = 160
RUN_SIGNS = 1 << 19
#: Letters (ASCII and Latin-1 first) that the pieces' trie has a table for; the others are searched.
TABLED = 192

#: Base of the words' polynomial hash, modulo 2**64 (odd: it has an inverse).
HASH_BASE = 0x9E6C63D0876A9A63
SAMPLE = "struct<ids:array<int>,log_prob:double,perturbed:double,log_inclusion:double>"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with a plain space for the word mark; ``data[i]`` are the bytes that id i stands for."""

    ids: dict[str, int]
    weight: dict[str, float]
    byte_ids: tuple[int, ...]
    byte_weight: float
    data: tuple[bytes, ...] = field(repr=False)

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces' bytes in a row, where each begins, and its size."""
        size = np.fromiter(map(len, self.data), np.int32, len(self.data))
        return np.frombuffer(b"".join(self.data), np.uint8), np.cumsum(size, dtype=np.int32) - size, size

    @cached_property
    def digest(self) -> str:
        """Tells vocabularies apart: pieces, weights and byte fallbacks."""
        return sha256(repr((sorted(self.ids.items()), sorted(self.weight.items()), self.byte_ids, self.byte_weight)).encode()
                      ).hexdigest()


@lru_cache(maxsize=2)
def load_vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    ids, rank, data, by_byte = {}, {}, [b""] * n, {}
    for i in range(n):
        if sp.is_byte(i):
            by_byte[int(sp.id_to_piece(i)[3:5], 16)] = i
            data[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
        elif not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)):
            piece = sp.id_to_piece(i).replace("▁", " ")
            if " " in piece.lstrip(" "):
                raise ValueError("a piece goes on after a word mark: words are not independent")
            if "\n" not in piece:
                ids[piece], data[i] = i, piece.encode()
                rank[piece] = min(-sp.get_score(i), float(n))
    if len(by_byte) != 256:
        raise ValueError("the vocabulary has no byte fallback: some texts have no segmentation")
    norm = np.log(sum(1 / (r + ZIPF_OFFSET) for r in rank.values()))
    weight = {p: float(-np.log(r + ZIPF_OFFSET) - norm) for p, r in rank.items()}
    return Vocabulary(ids, weight, tuple(by_byte[b] for b in range(256)),
                      float(-np.log(n + ZIPF_OFFSET) - norm), tuple(data))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) of an array of counters."""
    x = (x + np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(seed: np.ndarray, counter: np.ndarray | int) -> np.ndarray:
    """Numbers strictly between 0 and 1, a function of (seed, counter)."""
    c = np.asarray(counter, np.int64).astype(np.uint64)
    bits = mixed(np.atleast_1d(seed) + np.atleast_1d(c) * np.uint64(0xD1342543DE82EF95))
    return ((bits >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def truncated_gumbel(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Maximum perturbed value of a region of log mass ``mass``, given that it is at most ``bound``."""
    with np.errstate(divide="ignore"):
        return -np.logaddexp(-bound, -(mass - np.log(-np.log(u))))


def truncated_gumbel_of_one(mass: float, bound: float, u: float) -> float:
    """:func:`truncated_gumbel` of one region."""
    a, b = -bound, math.log(-math.log(u)) - mass
    return -(max(a, b) + math.log1p(math.exp(-abs(a - b))))


def unit_starts(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the units begin that no piece crosses: a word with the spaces before it, a line break, or spaces
    that no word follows.  ``first``: where texts begin."""
    line, space = code == 10, code == 32
    start = line.copy()
    start[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    start[first] = True
    return np.flatnonzero(start)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """HASH_BASE and its inverse to the power of 0 to n - 1, modulo 2**64."""
    out = []
    for x in (HASH_BASE, pow(HASH_BASE, -1, 1 << 64)):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def word_hashes(code: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hash of each word ``code[begin:begin + size]``.  (Two words of one hash would be taken for the same;
    ``round_trip`` would tell.)"""
    up, down = _powers(1 << max(16, len(code).bit_length()))
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(mixed(code.astype(np.uint64)) * up[:len(code)], out=total[1:])
    return mixed((total[begin + size] - total[begin]) * down[begin] + size.astype(np.uint64))


class Lattices:
    """Lattices of the words met so far, as flat arrays that grow.

    A word of n characters has n + 1 states.  ``start[s]:start[s + 1]`` are the edges of state s:
    length, id (below 0: fallback of that code point), log probability, log of the rest, and the
    cumulative probability ``cum``, by which a draw finds its edge.
    """

    def __init__(self, vocab: Vocabulary, smoothing: float):
        self.vocab, self.smoothing = vocab, smoothing
        chars = sorted({c for p in vocab.ids for c in p})
        self.char_no = np.zeros(0x110000, np.int32)
        self.char_no[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.base = len(chars) + 1
        node: dict[str, int] = {"": 0}
        step: list[tuple[int, int]] = []
        final: dict[int, tuple[int, float]] = {}
        for p in sorted(vocab.ids):
            for j in range(1, len(p) + 1):
                if p[:j] not in node:
                    node[p[:j]] = len(node)
                    step.append((node[p[:j - 1]] * self.base + int(self.char_no[ord(p[j - 1])]), node[p[:j]]))
            final[node[p]] = (vocab.ids[p], vocab.weight[p])
        self.step_key, self.step_to = (np.array(x, np.int64) for x in zip(*sorted(step)))
        self.root_to = np.full(self.base, -1)
        top = self.step_key < self.base
        self.root_to[self.step_key[top]] = self.step_to[top]
        tabled = self.step_key % self.base < TABLED
        inner, row = np.unique(self.step_key[tabled] // self.base, return_inverse=True)
        self.row_of = np.zeros(len(node), np.int32)  # row 0: no step
        self.row_of[inner] = np.arange(1, len(inner) + 1)
        self.table = np.full((len(inner) + 1, TABLED), -1, np.int32)
        self.table[row + 1, self.step_key[tabled] % self.base] = self.step_to[tabled]
        self.node_id, self.node_weight = np.full(len(node), -1, np.int64), np.zeros(len(node))
        for n, (i, w) in final.items():
            self.node_id[n], self.node_weight[n] = i, w
        self.clear()

    def clear(self) -> None:
        self.word = Numbers()
        self.room = {n: np.empty(0, t) for n, t in (("first", np.int64), ("start", np.int64), ("length", np.int16),
                                                    ("id", np.int32), ("log_p", np.float32),
                                                    ("log_rest", np.float32), ("cum", np.float32))}
        self.used = dict.fromkeys(self.room, 0)
        self.append(first=np.zeros(1, np.int64), start=np.zeros(1, np.int64))

    def bytes_kept(self) -> int:
        return sum(r.nbytes for r in self.room.values()) + ENTRY * len(self.word)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Trie nodes one letter further, -1 where there is none."""
        if not char.size or int(char.max()) < TABLED:
            return self.table[self.row_of[node], char]
        near = char < TABLED
        to = np.full(len(node), -1, np.int64)
        to[near] = self.table[self.row_of[node[near]], char[near]]
        want = node[~near] * self.base + char[~near]
        at = np.minimum(np.searchsorted(self.step_key, want), len(self.step_key) - 1)
        to[~near] = np.where(self.step_key[at] == want, self.step_to[at], -1)
        return to

    def add(self, code: np.ndarray, size: np.ndarray) -> None:
        """Build the lattices of new words (their letters in a row, and their sizes), all together."""
        code, words = code.astype(np.int64), len(size)
        own = np.repeat(np.arange(words), size)
        stop = np.cumsum(size)[own]
        at, n = np.arange(len(code)), 1
        char = self.char_no[code]
        node = self.root_to[char]
        at, node = at[node >= 0], node[node >= 0]
        found = []
        while at.size:
            end = self.node_id[node] >= 0
            found.append((at[end], n, node[end]))
            go = at + n < stop[at]
            at, node = at[go], node[go]
            to = self.step(node, char[at + n])
            ok = to >= 0
            at, node, n = at[ok], to[ok].astype(np.int64), n + 1
        lone = np.ones(len(code), bool)
        if found:
            lone[found[0][0]] = False
        lone = np.flatnonzero(lone)  # characters that are no piece: their bytes
        # Edges by state, then length: lengths come in order, so each takes its state's next place.
        count = np.bincount(np.concatenate([lone, *(x for x, _, _ in found)]), minlength=len(code))
        place = np.concatenate([[0], np.cumsum(count)])
        src = np.repeat(np.arange(len(code)), count)
        length, ids, weight = np.empty(len(src), np.int64), np.empty(len(src), np.int64), np.empty(len(src))
        place = place[:-1].copy()
        many = 1 + (code[lone] > 0x7F) + (code[lone] > 0x7FF) + (code[lone] > 0xFFFF)
        length[place[lone]], ids[place[lone]] = 1, -1 - code[lone]
        weight[place[lone]] = self.vocab.byte_weight * many
        place[lone] += 1
        for at, n, node in found:
            to = place[at]
            length[to], ids[to], weight[to] = n, self.node_id[node], self.node_weight[node]
            place[at] += 1
        weight *= self.smoothing
        state, left = src + own[src], stop[src] - src
        beta = np.zeros(len(code) + words)
        order = np.argsort(left.astype(np.uint16) if left.max() < 1 << 16 else left, kind="stable")
        ends, first = np.bincount(left), 0
        for many in ends[ends > 0].tolist():
            e = order[first:first + many]
            first += many
            value = weight[e] + beta[state[e] + length[e]]
            head = np.flatnonzero(np.diff(state[e], prepend=-1))
            most = np.maximum.reduceat(value, head)
            per = np.diff(np.append(head, many))
            beta[state[e[head]]] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, per)), head))
        log_p = np.minimum(weight + beta[state + length] - beta[state], 0.0)
        p = np.exp(log_p)
        per = np.bincount(state, minlength=len(code) + words)
        begin = np.concatenate([[0], np.cumsum(per)])
        total = np.concatenate([[0.0], np.cumsum(p)])
        cum = total[1:] - total[begin[state]]
        last = begin[1:][per > 0] - 1
        cum[last] = 1.0
        with np.errstate(divide="ignore"):
            rest = np.where(per[state] > 1, np.log1p(-np.minimum(p, 1 - 1e-16)), -np.inf)
        states, edges = self.used["start"] - 1, self.used["cum"]
        self.append(cum=np.minimum(cum, 1.0), length=length, id=ids, log_p=log_p, log_rest=rest,
                    start=begin[1:] + edges, first=np.cumsum(size + 1) + states)

    def append(self, **parts: np.ndarray) -> None:
        """Add to the flat arrays, whose room doubles when it is used up."""
        for name, part in parts.items():
            room, n = self.room[name], self.used[name]
            if n + len(part) > len(room):
                room = np.empty(5 * (n + len(part)) // 4, room.dtype)
                room[:n] = self.room[name][:n]
                self.room[name] = room
            room[n:n + len(part)] = part
            self.used[name] = n + len(part)
            setattr(self, name, room[:self.used[name]])

    def numbers(self, code: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of the words ``code[begin:begin + size]``, after adding the lattices that are missing."""
        if self.bytes_kept() > KEPT_BYTES:
            self.clear()
        told, first, at = np.unique(word_hashes(code, begin, size), return_index=True, return_inverse=True)
        before = len(self.word)
        own = np.fromiter(map(self.word.__getitem__, told.tolist()), np.int64, len(told))
        new = first[own >= before]  # numbers are given in this order
        if new.size:
            many = size[new]
            self.add(code[np.repeat(begin[new] - (np.cumsum(many) - many), many) + np.arange(many.sum())], many)
        return own[at]

    def walk(self, edge_at: np.ndarray, state: np.ndarray, at: np.ndarray, stop: np.ndarray,
             seed: np.ndarray, char: np.ndarray) -> None:
        """Draw edges from each start state to its word's end; ``edge_at[position]`` gets them."""
        while state.size:
            u = uniform(seed, char)
            edge = self.start[state]
            left = np.flatnonzero(self.cum[edge] <= u)
            while left.size:  # the last edge's cumulative probability is 1
                on = edge[left] + 1
                edge[left] = on
                left = left[self.cum[on] <= u[left]]
            edge_at[at] = edge
            n = self.length[edge]
            go = at + n < stop
            n, state, at, stop, seed, char = n[go], state[go], at[go], stop[go], seed[go], char[go]
            state, at, char = state + n, at + n, char + n


class Batch:
    """All texts of a batch: their words in a row, and the paths drawn so far."""

    def __init__(self, lattices: Lattices, texts: list[str | None], keys: np.ndarray):
        self.lat, self.n = lattices, len(texts)
        texts = [" " + t if t else "" for t in texts]
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        length = np.fromiter(map(len, texts), np.int64, self.n)
        self.cuts = np.concatenate([[0], np.cumsum(length)])  # positions of each text
        self.begin = unit_starts(code, self.cuts[:-1][length > 0])
        self.stop = np.append(self.begin[1:], len(code)) if len(code) else self.begin
        self.doc = np.searchsorted(self.cuts[1:], self.begin, "right")
        self.number = lattices.numbers(code, self.begin, self.stop - self.begin)
        self.key = keys.astype(np.int64).view(np.uint64)
        order = np.argsort(self.number, kind="stable")  # neighbouring states: quicker searches
        self.order = order
        self.paths: list[dict] = []

    def seeds(self, sample: int, use: int) -> np.ndarray:
        return mixed(self.key ^ mixed(np.full(self.n, sample * 8 + use, np.uint64)))

    def finish(self, sample: int, edge_at: np.ndarray, bound: np.ndarray, frm: np.ndarray) -> None:
        """Record a path of every text with value ``bound``; its steps after position ``frm`` open
        a region of siblings each."""
        lat = self.lat
        at = np.flatnonzero(edge_at >= 0)
        edge = edge_at[at]
        cut = np.searchsorted(at, self.cuts)
        doc = np.repeat(np.arange(self.n), np.diff(cut))
        run = np.concatenate([[0.0], np.cumsum(lat.log_p[edge], dtype=float)])
        before = run[:-1] - run[cut[doc]]
        u = uniform(self.seeds(sample, 1)[doc], at - self.cuts[doc])
        value = truncated_gumbel(before + lat.log_rest[edge], bound[doc], u)
        value[at <= frm[doc]] = -np.inf
        self.paths.append({"edge_at": edge_at, "at": at, "edge": edge, "before": before, "open": value, "cut": cut,
                           "perturbed": bound, "log_prob": run[cut[1:]] - run[cut[:-1]], "has": None})

    def first(self) -> None:
        edge_at = np.full(int(self.cuts[-1]), -1, np.int64)
        o = self.order
        self.lat.walk(edge_at, self.lat.first[self.number[o]], self.begin[o], self.stop[o],
                      self.seeds(0, 0)[self.doc[o]], self.begin[o] - self.cuts[self.doc[o]])
        root = -np.log(-np.log(uniform(self.seeds(0, 2), 0)))
        self.finish(0, edge_at, root, np.full(self.n, -1))
        self.paths[0]["has"] = np.ones(self.n, bool)
        self.excluded: dict[tuple[int, int], list[int]] = {}

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(value, path, step) of each text's best open region."""
        value = np.full(self.n, -np.inf)
        path, step = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for i, p in enumerate(self.paths):
            full = np.flatnonzero(p["cut"][1:] > p["cut"][:-1])
            if not full.size:
                continue
            top = np.full(self.n, -np.inf)
            top[full] = np.maximum.reduceat(p["open"], p["cut"][full])
            doc = np.repeat(np.arange(self.n), np.diff(p["cut"]))
            where = np.flatnonzero((p["open"] == top[doc]) & (p["open"] > -np.inf))
            at = np.zeros(self.n, np.int64)
            at[doc[where][::-1]] = where[::-1]
            better = top > value
            value[better], path[better], step[better] = top[better], i, at[better]
        return value, path, step

    def next(self) -> bool:
        """Pop the best region of every text that has one and walk its best member."""
        lat, sample = self.lat, len(self.paths)
        value, path, step = self.best()
        has = value > -np.inf
        if not has.any():
            return False
        edge_at = np.full(int(self.cuts[-1]), -1, np.int64)
        frm = np.full(self.n, np.iinfo(np.int64).max)
        pick, again = uniform(self.seeds(sample, 3), 0), uniform(self.seeds(sample, 4), 0)
        starts = []
        for d in np.flatnonzero(has).tolist():
            p, s = self.paths[path[d]], step[d]
            at, a = int(p["at"][s]), int(self.cuts[d])
            edge_at[a:at] = p["edge_at"][a:at]
            word = int(np.searchsorted(self.stop, at, "right"))
            state = int(lat.first[self.number[word]]) + at - int(self.begin[word])
            out = self.excluded.setdefault((int(path[d]), int(s)), [int(p["edge"][s])])
            a, b = int(lat.start[state]), int(lat.start[state + 1])
            edges = [(e, math.exp(x)) for e, x in enumerate(lat.log_p[a:b].tolist(), a) if e not in out]
            left = float(pick[d]) * sum(x for _, x in edges)
            for edge, x in edges:
                left -= x
                if left < 0:
                    break
            edge_at[at], frm[d] = edge, at
            out.append(edge)
            rest = sum(x for e, x in edges if e != edge)
            p["open"][s] = truncated_gumbel_of_one(float(p["before"][s]) + math.log(rest), float(value[d]),
                                                   float(again[d])) if rest else -np.inf
            n = int(lat.length[edge])
            if at + n < self.stop[word]:
                starts.append((state + n, at + n, int(self.stop[word]), d))
        o = self.order[self.begin[self.order] > frm[self.doc[self.order]]]
        more = np.array(starts, np.int64).reshape(-1, 4)
        doc = np.concatenate([self.doc[o], more[:, 3]])
        at = np.concatenate([self.begin[o], more[:, 1]])
        lat.walk(edge_at, np.concatenate([lat.first[self.number[o]], more[:, 0]]), at,
                 np.concatenate([self.stop[o], more[:, 2]]), self.seeds(sample, 0)[doc], at - self.cuts[doc])
        self.finish(sample, edge_at, value, frm)
        self.paths[-1]["has"] = has
        return True

    def ids(self, path: dict) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the texts' bounds, fallback characters as their bytes."""
        ids, cut = self.lat.id[path["edge"]], path["cut"]
        odd = np.flatnonzero(ids < 0)
        if not odd.size:
            return ids, cut
        byte = self.lat.vocab.byte_ids
        parts = [[byte[b] for b in chr(-1 - int(c)).encode("utf-8", "surrogatepass")] for c in ids[odd]]
        per = np.ones(len(ids), np.int64)
        per[odd] = [len(x) for x in parts]
        ends = np.concatenate([[0], np.cumsum(per)])
        out = np.repeat(ids, per)
        for i, x in zip(odd.tolist(), parts):
            out[ends[i]:ends[i + 1]] = x
        return out, ends[cut]


def sample_texts(lattices: Lattices, texts: list[str | None], keys: np.ndarray, k: int) -> list[list[dict]]:
    """For each text its samples, best first: ids, log_prob, perturbed, log_inclusion."""
    out: list[list[dict]] = [[] for _ in texts]
    for got in sample_runs(lattices, texts, keys, k):
        at = 0
        for d, n in enumerate(got.many.tolist(), got.start):
            for x in range(at, at + n):
                out[d].append({"ids": got.ids[got.cuts[x]:got.cuts[x + 1]]} | {c: float(v[x]) for c, v in got.value.items()})
            at += n
    return out


VALUES = ("log_prob", "perturbed", "log_inclusion")


@dataclass
class Samples:
    """Samples of a run of texts, text by text, best first."""

    start: int                      # number of the run's first text
    many: np.ndarray                # samples of each text
    ids: np.ndarray                 # of all samples in a row
    cuts: np.ndarray                # where each sample's ids begin and end
    value: dict[str, np.ndarray]    # VALUES of each sample
    same: np.ndarray                # every sample of the text decodes to it


def sample_runs(lattices: Lattices, texts: list[str | None], keys: np.ndarray, k: int) -> Iterator[Samples]:
    """Samples of all texts, taken in runs of about RUN_SIGNS signs, which bounds the arrays."""
    size = np.cumsum([len(t or "") for t in texts]) // RUN_SIGNS
    cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield _sample_run(lattices, texts[a:b], keys[a:b], k, a)


def _sample_run(lattices: Lattices, texts: list[str | None], keys: np.ndarray, k: int, start: int) -> Samples:
    b = Batch(lattices, texts, keys)
    b.first()
    while len(b.paths) < k and b.next():
        pass
    bound = b.best()[0]  # the next best perturbed value: what a sample had to exceed
    has = np.array([p["has"] for p in b.paths])
    many = has.sum(0)
    place = (np.cumsum(has, 0) - 1) + np.concatenate([[0], np.cumsum(many)[:-1]])  # of a sample, text by text
    n = int(many.sum())
    size, value = np.zeros(n, np.int64), {c: np.empty(n) for c in VALUES}
    parts = [b.ids(p) for p in b.paths]
    for p, (_, cut), at, own in zip(b.paths, parts, place, has):
        with np.errstate(over="ignore", divide="ignore"):
            gap = p["log_prob"] - bound
            inside = np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(np.maximum(gap, -30)))))
        size[at[own]] = np.diff(cut)[own]
        for c, v in zip(VALUES, (p["log_prob"], p["perturbed"], inside)):
            value[c][at[own]] = np.round(v[own], 6)
    cuts = np.concatenate([[0], np.cumsum(size)])
    ids = np.empty(int(cuts[-1]), np.int32)
    for (got, cut), at, own in zip(parts, place, has):
        if own.all():
            ids[np.arange(len(got)) + np.repeat(cuts[at] - cut[:-1], np.diff(cut))] = got
        else:  # texts without this sample have no ids of it
            length = np.where(own, np.diff(cut), 0)
            src = np.repeat(own, np.diff(cut))
            ids[np.flatnonzero(src) + np.repeat(cuts[np.where(own, at, 0)] - cut[:-1], length)] = got[src]
    return Samples(start, many, ids, cuts, value, _decode_to(lattices.vocab, ids, cuts, texts, many))


def _decode_to(vocab: Vocabulary, ids: np.ndarray, cuts: np.ndarray, texts: list[str | None], many: np.ndarray) -> np.ndarray:
    """True for the texts that all their samples decode to: all pieces' bytes in a row against the texts' bytes."""
    data, begin, size = vocab.flat
    ends = np.concatenate([[0], np.cumsum(size[ids])])
    want = [(" " + t).encode() if t else b"" for t in texts]
    own = np.repeat(np.arange(len(texts)), many)
    length = np.fromiter(map(len, want), np.int64, len(want))
    right = np.diff(ends[cuts]) == length[own]
    from_ = np.concatenate([[0], np.cumsum(length)])[:-1]
    whole = np.frombuffer(b"".join(want), np.uint8)
    for x in np.flatnonzero(right & (length[own] > 0)).tolist():
        a, b = int(cuts[x]), int(cuts[x + 1])
        n = size[ids[a:b]]
        at = np.arange(int(length[own[x]]), dtype=np.int32) + np.repeat(begin[ids[a:b]] - (np.cumsum(n, dtype=np.int32) - n), n)
        f = int(from_[own[x]])
        right[x] = np.array_equal(data[at], whole[f:f + len(at)])
    return np.bincount(own, ~right, len(texts)) == 0


def decode_ids(vocab: Vocabulary, ids) -> str:
    """Text of a segmentation: the pieces' bytes, without the word mark in front."""
    if len(ids) < 2:
        return b"".join(vocab.data[i] for i in ids).decode("utf-8", "replace")[1:]
    return b"".join(itemgetter(*ids)(vocab.data)).decode("utf-8", "replace")[1:]


#: The lattices of this worker, by vocabulary and smoothing: one at a time.
_KEPT: dict[tuple, Lattices] = {}


def _lattices(vocab: Vocabulary, smoothing: float) -> Lattices:
    """Lattices of the vocabulary, told by all its pieces; those of another one are given up."""
    key = vocab.digest, smoothing
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Lattices(vocab, smoothing)
    return _KEPT[key]


def _sample_batches(batches: Iterator[pa.RecordBatch], sent, k: int, smoothing: float) -> Iterator[pa.RecordBatch]:
    lattices = _lattices(sent.value, smoothing)
    kind = pa.struct([("ids", pa.list_(pa.int32())), *((c, pa.float64()) for c in VALUES)])
    for b in batches:
        texts = b.column(b.schema.get_field_index("__text")).to_pylist()
        keys = b.column(b.schema.get_field_index("__key")).to_numpy(zero_copy_only=False)
        own = b.drop_columns(["__text", "__key"])
        for got in sample_runs(lattices, texts, keys, k):
            ids = pa.ListArray.from_arrays(pa.array(got.cuts, pa.int32()), pa.array(got.ids))
            items = pa.StructArray.from_arrays([ids, *(pa.array(got.value[c]) for c in VALUES)], fields=list(kind))
            per = pa.array(np.concatenate([[0], np.cumsum(got.many)]), pa.int32())
            out = own.slice(got.start, len(got.many))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.ListArray.from_arrays(per, items), pa.array(got.same)],
                                             names=[*out.schema.names, "samples", "round_trip"])
    lattices.clear()  # an idle worker keeps no words


def sample_segmentations(docs: DataFrame, k: int = SAMPLES, model: str = MODEL, smoothing: float = SMOOTHING,
                         key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``docs`` with ``samples`` (at most ``k`` distinct segmentations of ``text``, best perturbed first)
    and ``round_trip`` (every one decodes to the text).

    A sample has its ids, log probability, perturbed log probability, and the log of its inclusion
    probability under the threshold that the (k+1)-th set (0 if there is none: it is certain).
    Randomness comes from a hash of the ``key`` columns, so equal texts of equal key get equal samples.
    Defined cases: null and empty texts have one sample without ids; a text with fewer than k
    segmentations has all of them; a text of any length is one lattice; repeated rows are answered each;
    null keys hash like any value; an empty table gives no rows; columns named samples or
    round_trip are replaced, all others stay.
    """
    vocab = load_vocabulary(model)
    sent = docs.sparkSession.sparkContext.broadcast(vocab)
    kept = docs.drop("samples", "round_trip")
    schema = T.StructType([*kept.schema.fields, *T._parse_datatype_string(
        f"samples array<{SAMPLE}>, round_trip boolean").fields])
    return (kept.withColumns({"__text": F.col("text").cast("string"), "__key": F.xxhash64(*key)})
            .mapInArrow(lambda x: _sample_batches(x, sent, k, smoothing), schema))


def _decode_batches(batches: Iterator[pa.RecordBatch], sent, column: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [None if ids is None else decode_ids(sent.value, ids)
                 for ids in b.column(b.schema.get_field_index(column)).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "decoded"])


def decode(df: DataFrame, column: str = "ids", model: str = MODEL) -> DataFrame:
    """``df`` with ``decoded``: the text of the ids in ``column`` (null ids: null; none: empty)."""
    sent = df.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    kept = df.drop("decoded")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())])
    return kept.mapInArrow(lambda x: _decode_batches(x, sent, column), schema)
