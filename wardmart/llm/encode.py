"""Token ids of whole texts as flat arrays, each distinct piece of a slice encoded once."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wardmart.llm.base import ranges
from wardmart.llm.packing import Ragged
from wardmart.llm.tokens import LETTERS, ODD_SPACE, MergeTable, merge_table

SPACE_MARK = "▁"
EASY = f"^[\\x00-&(-\\x7f{LETTERS}]*$"
"""Words of ASCII without apostrophe, and Latin letters: their pre-tokens show by the kind of each byte."""

# Letter, digit, mark or white space of each byte of such a word.
KINDS = np.full(256, 2, np.uint8)
KINDS[[ord(x) for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = 0
KINDS[128:] = 0
KINDS[48:58] = 1
KINDS[[9, 10, 11, 12, 13]] = 3


def joined(parts: list[np.ndarray], kind: str = "<u4") -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


KNOWN_WORDS = 400_000
"""Words whose ids a task keeps from one slice to the next. Beyond it, it starts anew."""


class Known:
    """Ids of the words met so far, so that a task encodes a word once and not once a slice."""

    def __init__(self, encode):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids = np.zeros(0, "<u4")
        self.start = self.size = np.zeros(0, np.int64)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size) of each of these different words in the ids that come with them."""
        if len(self.words) > KNOWN_WORDS:
            self.clear()
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        ids, size = self.encode(new)
        place = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, new])
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids.astype("<u4")])
        index = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        index[index < 0] = place
        return self.start[index], self.size[index], self.ids


UNRANKED = np.int32(2**31 - 1)


def ranks(table: MergeTable, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair, UNRANKED without one. Few pairs meet another one in their slot and look further."""
    key = left.astype(np.int64) * table.size + right
    result, open_ = np.full(len(key), UNRANKED), None
    for factor, level in table.levels:
        some = key if open_ is None else key[open_]
        at = level[MergeTable._slot(some, factor)]
        found = table.keys[at] == some
        if open_ is None:
            np.copyto(result, at, where=found)
            open_ = np.flatnonzero(found < (at < len(table.keys) - 1))
        else:
            result[open_[found]] = at[found]
            open_ = open_[found < (at < len(table.keys) - 1)]
    return result


def _merge_long(table: MergeTable, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pre-token of each surviving symbol, symbol); the symbols of one are in order.

    The same rounds as ``MergeTable.encode``; the rank of a pair is looked up again only
    where one of its symbols is new.
    """
    ids = ids.astype(np.int32)
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    rank = np.full(len(ids), UNRANKED)
    inside = np.flatnonzero(owner[:-1] == owner[1:])
    rank[inside] = ranks(table, ids[inside], ids[inside + 1])
    done_ids, done_owner = [], []
    while len(ids):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(np.append(starts, len(ids)))
        least = np.minimum.reduceat(rank, starts)
        ended = least == UNRANKED
        if 4 * np.count_nonzero(ended) >= len(starts):
            done = np.repeat(ended, sizes)
            done_owner.append(owner[done])
            done_ids.append(ids[done])
            ids, owner, rank = ids[~done], owner[~done], rank[~done]
            sizes, least = sizes[~ended], least[~ended]
        where = np.flatnonzero((rank == np.repeat(least, sizes)) & (rank != UNRANKED))
        # In a row of overlapping occurrences (a a a) every other one merges, from the left.
        run = np.flatnonzero(np.diff(where, prepend=-2) != 1)
        if len(run) < len(where):
            where = where[(np.arange(len(where)) - np.repeat(run, np.diff(np.append(run, len(where))))) % 2 == 0]
        ids[where] = table.results[rank[where]]
        keep = np.ones(len(ids), bool)
        keep[where + 1] = False
        ids, owner, rank = ids[keep], owner[keep], rank[keep]
        new = where - np.arange(len(where))
        changed = np.concatenate([new, new - 1])
        changed = changed[(changed >= 0) & (changed < len(ids) - 1)]
        rank[new] = UNRANKED
        changed = changed[owner[changed] == owner[changed + 1]]
        rank[changed] = ranks(table, ids[changed], ids[changed + 1])
    return joined(done_owner, np.int32), joined(done_ids, np.int32)


SHORT = 32
"""Pre-tokens of up to so many bytes are merged in columns. Places are five bits of a pair's order."""

COLUMNS = 8192
"""Pre-tokens merged at the same time: their columns stay in the processor's cache."""

LAST = np.int32(2**30)
"""Comes after the order of every pair that has a rank."""


def merge_all(table: MergeTable, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Surviving symbols of all pre-tokens, one after the other, and how many each has."""
    sizes, starts = np.zeros(len(lengths), np.int64), np.cumsum(lengths) - lengths
    # The order of a column's pairs has room for 2 ** 25 ranks.
    most = SHORT if len(table.keys) < LAST >> 5 else 0
    done = []
    for length in np.flatnonzero(np.bincount(np.minimum(lengths, most + 1), minlength=1)[1 : most + 1]) + 1:
        words = np.flatnonzero(lengths == length)
        for some in np.split(words, range(COLUMNS, len(words), COLUMNS)):
            for which, symbols, size in _merge_columns(table, ids[starts[some] + np.arange(length)[:, None]]):
                sizes[some[which]] = size
                done.append((some[which], symbols, size))
    long = np.flatnonzero(lengths > most)
    owner, symbols = _merge_long(table, ids[ranges(starts[long], lengths[long])], lengths[long])
    sizes[long] = np.bincount(owner, minlength=len(long))
    ends = np.cumsum(sizes)
    result = np.zeros(ends[-1] if len(ends) else 0, np.int32)
    for words, columns, size in done:
        at = ends[words] - size
        for place in range(size.max()):
            there = size > place
            result[at[there] + place] = columns[place, there]
    result[ranges(ends[long] - sizes[long], sizes[long])] = symbols[np.argsort(owner, kind="stable")]
    return result, sizes


def _merge_columns(table: MergeTable, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(which, symbols, how many of them) of pre-tokens of one length, a column each, as they get done.

    A round merges the leftmost of the pairs with the lowest rank in each column.
    """
    length, count = symbols.shape
    symbols = np.ascontiguousarray(symbols, np.int32)
    which, size = np.arange(count), np.full(count, length, np.int32)
    order = np.full(symbols.shape, LAST)  # 32 times the rank of the pair that begins here
    first, pairs = _first_order(table)
    if symbols.max() < first:
        order[:-1] = pairs[symbols[:-1] * np.int32(first) + symbols[1:]]
    else:
        order[:-1] = _order(table, symbols[:-1].ravel(), symbols[1:].ravel()).reshape(length - 1, count)
    while len(which):
        best = order[0].copy()
        for place in range(1, len(order) - 1):
            np.minimum(best, order[place] + np.int32(place), out=best)
        ended = best >= LAST
        if 4 * np.count_nonzero(ended) >= len(which):
            done, left = np.flatnonzero(ended), np.flatnonzero(~ended)
            yield which[done], symbols.take(done, 1), size[done]
            which, size, best = which[left], size[left], best[left]
            longest = size.max(initial=0)
            symbols, order = symbols[:longest].take(left, 1), order[:longest].take(left, 1)
            column = np.arange(len(left))
            place = best & 31
        else:
            column = np.flatnonzero(~ended)
            place = np.where(ended, length, best & 31)
        # What stands after a merged pair moves up by one row.
        for row in range(1, len(symbols) - 1):
            later = (place - row) >> 31
            for values in (symbols, order):
                values[row] += (values[row + 1] - values[row]) & later
        size[column] -= 1
        place, ends, width = place[column].astype(np.int64), size[column], len(which)
        flat_symbols, flat_order = symbols.reshape(-1), order.reshape(-1)
        at = place * width + column
        merged = table.results[best[column] >> 5]
        flat_symbols[at] = merged
        flat_order[at] = flat_order[ends * width + column] = LAST
        there = place + 1 < ends
        begin = np.concatenate([at[there], at[place > 0] - width])
        flat_order[begin] = _order(table, flat_symbols[begin], flat_symbols[begin + width])


@lru_cache(maxsize=2)
def _first_order(table: MergeTable) -> tuple[int, np.ndarray]:
    """The order of all pairs of the first ids, where the bytes of most vocabularies are."""
    first = np.arange(256, dtype=np.int32)
    return 256, _order(table, np.repeat(first, 256), np.tile(first, 256))


def _order(table: MergeTable, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.minimum(ranks(table, left, right), LAST >> 5) << 5


class ByteVocabulary:
    """A byte-level vocabulary: ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.merges: MergeTable = merge_table(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # The printable Latin-1 letters stand for themselves, all other bytes follow from 256 on.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte_of = np.zeros(512, np.uint8)
        byte_of[own] = own
        rest = [b for b in range(256) if b not in own]
        byte_of[256 : 256 + len(rest)] = rest
        entries = {number: entry for entry, number in spec["model"]["vocab"].items()}
        entries |= {number: "" for number in self.special.values()}
        self.size = max(entries) + 1
        letters = [entries.get(number, "") for number in range(self.size)]
        points = np.frombuffer("".join(letters).encode("utf-32-le"), np.uint32)
        self.bytes = byte_of[points]
        self.length = np.fromiter(map(len, letters), np.int64, self.size)
        self.start = np.cumsum(self.length) - self.length
        self.known = Known(self._words)

    def encode(self, texts: pa.Array, special: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has.

        ``special``: whether special strings inside a text are their ids, or plain text.
        A text whose white space is single is cut at its spaces, each piece keeping the
        space before it; others go to the pre-tokenizer whole.
        """
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        for word in self.special if special else ():
            odd = pc.or_(odd, pc.match_substring(texts, word))
        odd = odd.to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._cut(texts)
        result = Ragged(len(texts))
        whole = np.flatnonzero(odd)
        result.put(whole, *self._whole(texts.take(pa.array(whole)).to_pylist(), special))
        plain = np.flatnonzero(~odd)
        result.put(plain, *self._cut(texts.take(pa.array(plain))))
        return result.take(np.arange(len(texts))), result.size

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        encoded = pieces.flatten().dictionary_encode()
        code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.zeros(len(code), bool)
        first[np.cumsum(sizes)[sizes > 0] - sizes[sizes > 0]] = True
        words, at = [], np.zeros(len(code), np.int64)
        for places, space in ((np.flatnonzero(first), ""), (np.flatnonzero(~first), " ")):
            number = np.cumsum(np.bincount(code[places], minlength=len(encoded.dictionary)) > 0)
            at[places] = number[code[places]] - 1 + sum(map(len, words))
            used = encoded.dictionary.take(pa.array(np.flatnonzero(np.diff(number, prepend=0))))
            words.append(pc.binary_join_element_wise(space, used, ""))
        start, size, ids = self.known(pa.concat_arrays(words))
        ends = np.append(0, np.cumsum(size[at]))[np.append(0, np.cumsum(sizes))]
        return ids[ranges(start[at], size[at])], np.diff(ends)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        easy = pc.match_substring_regex(words, EASY).to_numpy(zero_copy_only=False)
        result = Ragged(len(words))
        rest = np.flatnonzero(~easy)
        result.put(rest, *self._whole(words.take(pa.array(rest)).to_pylist(), False))
        easy = np.flatnonzero(easy)
        words = words.take(pa.array(easy))
        size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        if size.sum():
            start = np.append(0, np.cumsum(size))
            # Pre-tokens are runs of letters, digits or marks; a space belongs to the run after it.
            data = np.frombuffer(words.buffers()[2], np.uint8)[np.frombuffer(words.buffers()[1], np.int32)[words.offset] :]
            kind = KINDS[data[: start[-1]]]
            cut = np.append(True, kind[1:] != kind[:-1])
            cut[1:] &= data[: start[-1] - 1] != 32
            cut[start[:-1][size > 0]] = True
            starts = np.flatnonzero(cut)
            offsets = np.append(starts, start[-1]).astype(np.int32)
            runs = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[: start[-1]]))
            runs = runs.dictionary_encode()
            ids = Ragged(len(runs.dictionary))
            ids.put(np.arange(len(runs.dictionary)), *merge_all(self.merges, *self.merges.bytes_of(runs.dictionary)))
            code = runs.indices.to_numpy(zero_copy_only=False)
            so_far = np.append(0, np.cumsum(ids.size[code]))
            # Runs that start before a byte: so many belong to the words before.
            ends = so_far[np.append(0, np.cumsum(cut))[start]]
            result.put(easy, ids.take(code), np.diff(ends))
        return result.take(np.arange(len(easy) + len(rest))), result.size

    def _whole(self, texts: list[str], special: bool) -> tuple[np.ndarray, np.ndarray]:
        """By the library's pre-tokenizer; each distinct pre-token is merged once."""
        codes: dict[str, int] = {}
        row, code = [], []
        for number, text in enumerate(texts):
            for part, is_special in self._parts(text, special):
                units = [part] if is_special else [p for p, _ in self.merges.library.pre_tokenize_str(part)]
                for unit in units:
                    # A byte-level pre-token never holds a plain space, so it cannot be a marked special.
                    key = f" {unit}" if is_special else unit
                    row.append(number)
                    code.append(codes.setdefault(key, len(codes)))
        units = list(codes)
        ids = Ragged(len(units))
        marked = np.fromiter((u.startswith(" ") for u in units), bool, len(units))
        words = [u for u in units if not u.startswith(" ")]
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids.put(np.flatnonzero(~marked), *merge_all(self.merges, self.merges.symbol[points], lengths))
        known = np.array([self.special[u[1:]] for u in units if u.startswith(" ")], np.int64)
        ids.put(np.flatnonzero(marked), known, np.ones(len(known), np.int64))
        code = np.array(code, np.int64)
        counts = np.bincount(row, ids.size[code], len(texts)).astype(np.int64) if row else np.zeros(len(texts), np.int64)
        return ids.take(code), counts

    def _parts(self, text: str, special: bool) -> list[tuple[str, bool]]:
        parts = [(text, False)]
        for word in self.special if special else ():
            cut = []
            for part, done in parts:
                if done or word not in part:
                    cut.append((part, done))
                    continue
                for nth, piece in enumerate(part.split(word)):
                    cut += [(word, True)] * bool(nth) + [(piece, False)]
            parts = cut
        return [p for p in parts if p[0]]


class PieceVocabulary:
    """A sentencepiece model without pieces that cross the start of a word."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.library.vocab_size()
        entries = [self.library.id_to_piece(number) for number in range(self.size)]
        if any(SPACE_MARK in entry.lstrip(SPACE_MARK) for entry in entries):
            raise ValueError("pieces of this model go across words")
        data = []
        for number, entry in enumerate(entries):
            if self.library.is_byte(number):
                data.append(bytes([int(entry[3:5], 16)]))
            else:
                data.append(entry.replace(SPACE_MARK, " ").encode())
        self.bytes = np.frombuffer(b"".join(data), np.uint8)
        self.length = np.fromiter(map(len, data), np.int64, self.size)
        self.start = np.cumsum(self.length) - self.length
        self.known = Known(self._library)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has.

        No piece goes across the start of a word, so a text with single spaces has the
        ids of its words one after the other; each distinct word is encoded once.
        """
        odd = pc.match_substring_regex(texts, f"  |^ | $|^$|{SPACE_MARK}").to_numpy(zero_copy_only=False)
        result = Ragged(len(texts))
        whole = np.flatnonzero(odd)
        result.put(whole, *self._library(texts.take(pa.array(whole))))
        plain = np.flatnonzero(~odd)
        pieces = pc.split_pattern(texts.take(pa.array(plain)), " ")
        sizes = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        encoded = pieces.flatten().dictionary_encode()
        code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        start, size, ids = self.known(encoded.dictionary)
        ends = np.append(0, np.cumsum(size[code]))[np.append(0, np.cumsum(sizes))]
        result.put(plain, ids[ranges(start[code], size[code])], np.diff(ends))
        return result.take(np.arange(len(texts))), result.size

    def _library(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self.library.encode(texts.to_pylist(), num_threads=1) if len(texts) else []
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum())), sizes


@lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary(path)


@lru_cache(maxsize=2)
def piece_vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)
