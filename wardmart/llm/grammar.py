"""Re-Pair: a sequence of ids as a grammar, and its decoding from any place.

Frequent pairs of neighbours are replaced by new symbols, round after round, until no
pair occurs often enough. All pairs of a round are replaced at the same time; where
occurrences overlap, the more frequent pair goes first. A pair never goes across the
end of a document, so every document stays a run of symbols of its own.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from wardmart.llm.base import ranges

LEAST = 12
"""Occurrences from which a rule saves more than it takes: two symbols and a length."""

SLOT_BITS = 18
"""Of the slots in which pairs are counted; more in a block with more than four places to a slot."""

SPREAD = 4
"""A round takes pairs down to 1 / 2 ** SPREAD of the most frequent one."""

SHORT = 256
"""Ids of a rule that is expanded once and then copied; longer ones are taken apart where they stand."""

MAGIC = b"RPG1"
_HEAD = struct.Struct("<4sBIIQQQ")


@dataclass
class Grammar:
    """``symbols`` below ``base`` are ids; symbol ``base + r`` is rule r, the pair (left[r], right[r]).

    ``spans``: how many ids each rule stands for. ``ends``: where each document's
    symbols end.
    """

    base: int
    left: np.ndarray
    right: np.ndarray
    spans: np.ndarray
    symbols: np.ndarray
    ends: np.ndarray

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        """Number of ids behind each symbol."""
        result = np.ones(len(symbols), np.int64)
        rules = symbols >= self.base
        result[rules] = self.spans[symbols[rules] - self.base]
        return result

    def decode(self, first: int = 0, end: int | None = None) -> np.ndarray:
        """The ids of documents ``first`` to ``end``; no other document is expanded."""
        end = len(self.ends) if end is None else end
        bounds = np.append(0, self.ends)
        symbols = self.symbols[bounds[first] : bounds[end]].astype(np.int64)
        size = np.concatenate([np.ones(self.base, np.int64), self.spans])
        while (long := size[symbols] > SHORT).any():
            at = np.cumsum(1 + long) - 2
            rule = symbols[long] - self.base
            symbols = np.repeat(symbols, 1 + long)
            symbols[at[long]], symbols[at[long] + 1] = self.left[rule], self.right[rule]
        # Of the rules that are left each is expanded once, and copied to where it stands.
        used = np.zeros(len(size), bool)
        used[symbols] = True
        used = np.flatnonzero(used)
        start = np.zeros(len(size), np.int64)
        start[used] = np.cumsum(size[used]) - size[used]
        return self._expanded(used, start[used], size)[ranges(start[symbols], size[symbols])]

    def _expanded(self, symbols: np.ndarray, places: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The ids of each symbol from its place on."""
        ids = np.zeros(int(size[symbols].sum()), "<u4")
        while len(symbols):
            plain = symbols < self.base
            ids[places[plain]] = symbols[plain]
            rule, places = symbols[~plain] - self.base, places[~plain]
            left, right = self.left[rule], self.right[rule]
            symbols, places = np.concatenate([left, right]), np.concatenate([places, places + size[left]])
        return ids

    def document_lengths(self) -> np.ndarray:
        """Ids of each document, from the expansion lengths alone."""
        so_far = np.append(0, np.cumsum(self.lengths(self.symbols)))
        return np.diff(so_far[np.append(0, self.ends)])

    def pack(self) -> bytes:
        """Header, rules, expansion lengths, document ends, symbols; numbers in as few bits as they need."""
        width = int(self.base + len(self.left) - 1).bit_length() if self.base + len(self.left) > 1 else 1
        head = _HEAD.pack(MAGIC, width, self.base, len(self.left), len(self.ends), len(self.symbols), 0)
        rules = np.concatenate([self.left, self.right])
        parts = [_bits(rules, width), self.spans.astype("<i8").tobytes(), self.ends.astype("<i8").tobytes()]
        return b"".join([head, *parts, _bits(self.symbols, width)])

    @classmethod
    def unpack(cls, data: bytes) -> Grammar:
        magic, width, base, rules, documents, symbols, _ = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a grammar")
        at = _HEAD.size
        pairs = _unbits(data, at, 2 * rules, width)
        at += -(-2 * rules * width // 8)
        spans = np.frombuffer(data, "<i8", rules, at)
        at += 8 * rules
        ends = np.frombuffer(data, "<i8", documents, at)
        at += 8 * documents
        return cls(base, pairs[:rules], pairs[rules:], spans, _unbits(data, at, symbols, width), ends)


def _bits(numbers: np.ndarray, width: int) -> bytes:
    raw = numbers.astype("<u4")[:, None].view(np.uint8)
    return np.packbits(np.unpackbits(raw, axis=1, count=width, bitorder="little"), bitorder="little").tobytes()


def _unbits(data: bytes, at: int, count: int, width: int) -> np.ndarray:
    # A number lies within the eight bytes from the one on in which it starts.
    raw = np.append(np.frombuffer(data, np.uint8, -(-count * width // 8), at), np.zeros(8, np.uint8))
    windows = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    bit = np.arange(count) * width
    numbers = windows[bit >> 3] >> (bit & 7).astype(np.uint64)
    return (numbers & np.uint64((1 << width) - 1)).astype(np.int64)


def repair(ids: np.ndarray, ends: np.ndarray, base: int, least: int = LEAST) -> Grammar:
    """The grammar of documents that end at ``ends`` in ``ids``; all ids are below ``base``.

    Symbols stay in their places and know their neighbours, so a round costs as much as
    there are pairs that may still be frequent, however long the block is.
    """
    symbols = ids.astype(np.uint32)
    after = np.arange(1, len(symbols) + 1)
    before = np.arange(-1, len(symbols))
    inner = np.ones(len(symbols), bool)
    inner[ends[ends > 0] - 1] = False
    there = np.ones(len(symbols), bool)
    # Places whose pair may still be frequent; a pair never becomes more so.
    live = np.zeros(-(-len(symbols) // 8) * 8, bool)
    live[: len(symbols)] = inner
    left, right, span_of = [], [], np.ones(base, np.int64)
    turn = 0
    while len(where := _places(live)):
        follows = after[where]
        pairs, found, code, rare = _frequent(symbols[where], symbols[follows], least, turn)
        turn += 1
        live[where[rare]] = False
        if not len(pairs):
            continue
        where, follows = where[found], follows[found]
        first = where[code == 0]
        chosen = _apart(follows[:-1] == where[1:], code)
        where, gone, code = where[chosen], follows[chosen], code[chosen]
        good = np.bincount(code, minlength=len(pairs)) >= 2
        if not good.any():
            live[first] = False  # it overlaps itself, and stands in the way of the others
            continue
        if not good.all():
            kept = good[code]
            where, gone, code = where[kept], gone[kept], (np.cumsum(good) - 1)[code[kept]]
            pairs = pairs[good]
        left.append(pairs >> 32)
        right.append(pairs & 0xFFFFFFFF)
        number = len(span_of)
        span_of = np.concatenate([span_of, span_of[left[-1]] + span_of[right[-1]]])
        symbols[where] = number + code
        there[gone] = live[gone] = False
        follows = after[gone]
        after[where] = follows
        before[follows] = where
        inner[where] = live[where] = inner[gone]
        earlier = before[where]
        earlier = earlier[earlier >= 0]
        live[earlier] = inner[earlier]
    none = np.zeros(0, np.int64)
    symbols, inner = symbols[there], inner[there]
    stops = np.flatnonzero(~inner) + 1
    ends = np.append(0, stops)[np.cumsum(np.diff(ends, prepend=0) > 0)]
    return Grammar(base, np.concatenate(left or [none]), np.concatenate(right or [none]), span_of[base:], symbols, ends)


def _places(live: np.ndarray) -> np.ndarray:
    """Where ``live`` is true; where little is, eight places are passed over at a time."""
    if 32 * np.count_nonzero(live) > len(live):
        return np.flatnonzero(live)
    places = (np.flatnonzero(live.view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return places[live[places]]


def _frequent(
    first: np.ndarray, second: np.ndarray, least: int, turn: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, most frequent first; where they are, and which it is there; which places are rare.

    Pairs are counted in hashed slots. Only slots that are full enough for one of the
    most frequent pairs are looked at; each then counts one pair only, and the pairs
    that meet it there wait for another round, in which they are hashed anew.
    """
    size = len(first).bit_length()
    bits = min(max(8, size + 1), max(SLOT_BITS, size - 2))
    factors = [np.uint32(f * (k * turn + 1) & 0xFFFFFFFF) for f, k in ((0x9E3779B1, 2), (0x85EBCA77, 6))]
    slot = ((first * factors[0] + second * factors[1]) >> np.uint32(32 - bits)).astype(np.intp)
    met = np.bincount(slot, minlength=1 << bits)
    here = met.astype(np.int32)[slot]
    rare = here < least
    full = np.flatnonzero(here >= max(least, met.max() >> SPREAD))
    slot, key = slot[full], (first[full].astype(np.int64) << 32) | second[full]
    holder = np.zeros(1 << bits, np.int64)
    holder[slot] = key
    own = np.flatnonzero(holder[slot] == key)
    full, slot = full[own], slot[own]
    counts = np.bincount(slot, minlength=1 << bits)
    often = np.flatnonzero(counts >= max(least, counts.max() >> SPREAD))
    often = often[np.argsort(-counts[often], kind="stable")]
    rare[full[counts[slot] < least]] = True
    place_of = np.full(1 << bits, -1)
    place_of[often] = np.arange(len(often))
    code = place_of[slot]
    kept = code >= 0
    return holder[often], full[kept], code[kept], rare


def _apart(touching: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which places do not overlap: the lower rank wins, in a run of one pair every other place.

    ``touching``: whether a place overlaps the next one.
    """
    same = touching & (rank[1:] == rank[:-1])
    lower = rank[1:] < rank[:-1]
    # A run is decided as a whole by what stands before and after it.
    ok = np.append(True, ~touching | lower | same) & np.append(~(touching & lower), True)
    if not same.any():
        return np.flatnonzero(ok)
    run = np.flatnonzero(np.append(True, ~same))
    sizes = np.diff(np.append(run, len(rank)))
    position = np.arange(len(rank)) - np.repeat(run, sizes)
    return np.flatnonzero(np.repeat(np.logical_and.reduceat(ok, run), sizes) & (position % 2 == 0))
