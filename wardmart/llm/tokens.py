"""Token counts by rank-synchronous merging of pre-tokens held as ragged arrays.

Pre-tokens of a batch lie one after the other in one flat array of symbols. In each
round every pre-token finds its lowest-ranked adjacent pair and merges all of that
pair's occurrences, all pre-tokens at the same time. Pre-tokens without a pair left
are done; the number of symbols that survive is the number of tokens.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame

from wardmart.llm.base import on_batches, text_slices, texts_of

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
# White space that is not a plain ASCII space or line break, or that stands in a run: such
# texts go to the library's pre-tokenizer as a whole.
ODD_SPACE = (
    r"[\s\x0b\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}|[\x00\x1c-\x1f]"
)

LETTERS = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}"
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

SLOT_BITS = 20

NEVER = np.iinfo(np.int64).max


class MergeTable:
    """Ranks and results of a byte-level vocabulary's merges, as hashed arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.size = len(vocab) + len(spec["added_tokens"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.library = Tokenizer.from_file(path).pre_tokenizer
        letters = {ord(piece): number for piece, number in vocab.items() if len(piece) == 1}
        self.symbol = np.full(max(letters) + 1, -1, np.int64)
        self.symbol[list(letters)] = list(letters.values())
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        # Bytes that are printable Latin-1 letters stand for themselves, the others follow from 256.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in own]
        self.byte = np.zeros(256, np.int64)
        letter = own + list(range(256, 256 + len(rest)))
        self.byte[own + rest] = self.symbol[letter]
        # Some vocabularies mark the last letter of a word.
        suffix = spec["model"]["end_of_word_suffix"] or ""
        self.last = np.zeros(256, np.int64)
        self.last[own + rest] = [vocab[chr(x) + suffix] for x in letter]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.results = np.array([vocab[a.removesuffix(suffix) + b] for a, b in pairs], np.int64)
        # Rank by pair, hashed; pairs that meet in a slot go on to the next level.
        self.keys, self.levels = np.append(keys, -1), []
        left = np.arange(len(keys))
        while len(left):
            factor = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.levels))
            slot = self._slot(keys[left], factor)
            level = np.full(1 << SLOT_BITS, len(keys), np.int32)
            level[slot] = left
            self.levels.append((factor, level))
            left = left[level[slot] != left]

    @staticmethod
    def _slot(key: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((key.astype(np.uint64) * factor) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        rank = np.full(len(key), NEVER)
        for factor, level in self.levels:
            at = level[self._slot(key, factor)]
            found = self.keys[at] == key
            rank[found] = at[found]
        return rank

    def bytes_of(self, words: pa.Array, word_end: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the bytes of all words, and how many each word has."""
        _, offsets, data = words.buffers()
        lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        if not lengths.sum():
            return np.zeros(0, np.int64), lengths
        first = np.frombuffer(offsets, np.int32)[words.offset]
        raw = np.frombuffer(data, np.uint8)[first : first + lengths.sum()]
        symbols = self.byte[raw]
        if word_end:
            ends = np.cumsum(lengths)[lengths > 0] - 1
            symbols[ends] = self.last[raw[ends]]
        return symbols, lengths

    def merged(self, ids: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(pre-token of each surviving symbol, symbol), in order, as pre-tokens get done.

        ``ids`` has the symbols of the pre-tokens, ``lengths`` of each, one after the other.
        """
        owner = np.repeat(np.arange(len(lengths)), lengths)
        while len(ids):
            rank = np.full(len(ids), NEVER)
            inside = np.flatnonzero(owner[:-1] == owner[1:])
            rank[inside] = self.rank(ids[inside], ids[inside + 1])
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(np.append(starts, len(ids)))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            done = lowest == NEVER
            yield owner[done], ids[done]
            ids, owner, rank, lowest = (x[~done] for x in (ids, owner, rank, lowest))
            # In a row of overlapping occurrences (a a a) every other one merges, from the left.
            where = np.flatnonzero(rank == lowest)
            run = np.flatnonzero(np.diff(where, prepend=-2) != 1)
            position = np.arange(len(where)) - np.repeat(run, np.diff(np.append(run, len(where))))
            where = where[position % 2 == 0]
            if len(ids):
                ids[where] = self.results[rank[where]]
                keep = np.ones(len(ids), bool)
                keep[where + 1] = False
                ids, owner = ids[keep], owner[keep]

    def count(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token: its symbols that survive."""
        tokens = np.zeros(len(lengths), np.int64)
        for owner, _ in self.merged(ids, lengths):
            tokens += np.bincount(owner, minlength=len(lengths))
        return tokens

    def encode(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols of all pre-tokens, one after the other, and how many each has."""
        parts = list(self.merged(ids, lengths))
        owner = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        symbols = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])[order]
        return symbols, np.bincount(owner, minlength=len(lengths))

    def count_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; special strings inside count one each."""
        pieces: dict[str, int] = {}
        owner, code = [], []
        extra = np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            parts = [text]
            for special in self.special:
                if special in text:
                    cut = [p.split(special) for p in parts]
                    extra[row] += sum(len(c) - 1 for c in cut)
                    parts = [p for c in cut for p in c]
            for part in parts:
                for piece, _ in self.library.pre_tokenize_str(part) if part else ():
                    owner.append(row)
                    code.append(pieces.setdefault(piece, len(pieces)))
        if not pieces:
            return extra
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        counts = self.count(self.symbol[points], lengths)
        return extra + np.bincount(owner, counts[code], len(texts)).astype(np.int64)


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def count_batch(texts: pa.Array, model: MergeTable) -> np.ndarray:
    """Tokens of each text of a slice.

    A text whose white space is single is cut at its spaces, each piece keeping the
    space before it, and distinct pieces are counted once. Others go whole.
    """
    odd = pc.match_substring_regex(texts, ODD_SPACE)
    for special in model.special:
        odd = pc.or_(odd, pc.match_substring(texts, special))
    odd = odd.to_numpy(zero_copy_only=False)
    result = np.zeros(len(texts), np.int64)
    if odd.any():
        result[odd] = model.count_texts(texts.filter(pa.array(odd)).to_pylist())
    plain = np.flatnonzero(~odd)
    if len(plain):
        pieces = pc.split_pattern(texts.take(pa.array(plain)), " ")
        sizes = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        encoded = pieces.flatten().dictionary_encode()
        code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        later = np.delete(np.arange(len(code)), first)
        row = np.repeat(np.arange(len(plain)), sizes)
        total = np.zeros(len(plain))
        for places, space in ((first, ""), (later, " ")):  # no space stands before a text's first piece
            used, at = np.unique(code[places], return_inverse=True)
            counts = count_pieces(encoded.dictionary.take(pa.array(used)), space, model)
            total += np.bincount(row[places], counts[at], len(plain))
        result[plain] = total
    return result


def count_pieces(words: pa.Array, space: str, model: MergeTable) -> np.ndarray:
    """Tokens of each of these words with ``space`` before it.

    Where the pre-tokens are plain to see, each distinct one is merged once.
    """
    easy = easy_words(words)
    result = np.zeros(len(words), np.int64)
    if not easy.all():
        result[~easy] = model.count_texts([space + w for w in words.filter(pa.array(~easy)).to_pylist()])
    if easy.any():
        stems, tails = stems_and_tails(words.filter(pa.array(easy)))
        ids, lengths = model.bytes_of(pc.binary_join_element_wise(space, stems.dictionary, ""))
        result[easy] = model.count(ids, lengths)[stems.indices.to_numpy()]
        result[easy] += model.count_texts(tails.dictionary.to_pylist())[tails.indices.to_numpy()]
    return result


def easy_words(words: pa.Array) -> np.ndarray:
    """Which words are Latin letters and then any number of ASCII punctuation marks.

    Their pre-tokens are known without a pre-tokenizer: the letters, and the marks.
    """
    pattern = f"^[{LETTERS}]+[!-/:-@\\[-`{{-~]*$"
    return pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False)


def stems_and_tails(words: pa.Array) -> tuple[pa.DictionaryArray, pa.DictionaryArray]:
    """The letters and the marks of easy words, each distinct one once."""
    stems = pc.utf8_rtrim(words, characters=MARKS)
    tails = pc.replace_substring_regex(words, f"^[{LETTERS}]+", "")
    return stems.dictionary_encode(), tails.dictionary_encode()


def token_counts(
    docs: DataFrame,
    vocabulary: str | None = None,
    limit: int = TOKEN_LIMIT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text.

    No shuffle. A null text is empty: 0 bytes, 0 tokens. Rows with a null or repeated
    id give one row each; other columns are not read; an empty table gives no rows.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merge_table(path)
        for batch in text_slices(batches):
            texts = texts_of(batch)
            tokens = count_batch(texts, model)
            size = pc.binary_length(texts).cast(pa.int64())
            columns = [batch.column("doc_id"), size, pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return on_batches(rows, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
