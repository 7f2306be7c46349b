"""BPE over the distinct words of a partition, with an index of the places of each pair."""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, types as T

from tidewatch.llm.pretokens import BYTE_LETTERS, WORD_LEVEL, finder
from tidewatch.llm.words import gathered

# Bytes of words and ids that a worker remembers, and what Python needs beside them for each word.
_MEMO = 64_000_000
_ENTRY = 220
# Rows that go back to Spark together.
_ROWS = 500
_NARROW = regex.compile(r"[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")


class Vocabulary:
    """Ids, merges and the end-of-word mark of a tokenizer file with lower-case words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.mark: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        # By rank: both sides and the id they merge to.
        self.rules = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]
        keys = np.array([a << 32 | b for a, b, _ in self.rules], np.int64)
        self._rank = np.argsort(keys, kind="stable")
        self._keys = keys[self._rank]
        self.tokens = {number: token for token, number in self.ids.items()}
        self.tokens |= {number: token for token, number in self.special.items()}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, -1 for those that don't merge."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._rank[at], -1)


def encode_pieces(pieces: list[str], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Ids of each of the ``pieces``.

    All symbols of all pieces stand in one sequence, linked to their neighbours. ``places`` maps
    each pair, named by its rank, to the positions where it stands; a heap has the ranks with
    positions. The lowest rank is applied to all its positions at once, and the pairs at either
    side of the merges enter their lists. Positions that have changed meanwhile are passed over.
    Of several positions in one piece the first goes first and the others wait, so that a pair
    of lower rank that comes up between them has its turn.
    """
    ids, mark = vocabulary.ids, vocabulary.mark
    letters = [piece.encode().decode("latin-1").translate(BYTE_LETTERS) for piece in pieces]
    sizes = np.fromiter(map(len, letters), np.int64, len(letters))
    n = int(sizes.sum())
    ends = np.cumsum(sizes)
    symbols = np.fromiter((ids[c] for word in letters for c in word), np.int64, n)
    symbols[ends - 1] = [ids[word[-1] + mark] for word in letters]
    owner = np.repeat(np.arange(len(letters)), sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1], before[ends - sizes] = n, -1
    places: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(at: np.ndarray) -> None:
        """Put positions that have a neighbour to the right into the lists of their pairs."""
        ranks = vocabulary.ranks(symbols[at], symbols[after[at]])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        firsts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]) if len(at) else []
        for start, stop in zip(firsts, [*firsts[1:], len(at)]):
            rank = int(ranks[start])
            if rank not in places:
                places[rank] = []
                heapq.heappush(heap, rank)
            places[rank].append(at[start:stop])

    enter(np.flatnonzero(after < n))
    while heap:
        rank = heapq.heappop(heap)
        lists = places.pop(rank)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        left, right, new = vocabulary.rules[rank]
        then = after[at]
        at = at[(symbols[at] == left) & (symbols[np.minimum(then, n - 1)] == right) & (then < n)]
        if not len(at):
            continue
        first = np.r_[True, owner[at[1:]] != owner[at[:-1]]]
        if not first.all():
            places[rank] = [at[~first]]
            heapq.heappush(heap, rank)
            at = at[first]
        then = after[at]
        following, previous = after[then], before[at]
        symbols[at], symbols[then] = new, -1
        after[at] = following
        inside = following < n
        before[following[inside]] = at[inside]
        enter(np.concatenate([at[inside], previous[previous >= 0]]))
    kept = symbols >= 0
    counts = np.add.reduceat(kept, ends - sizes) if n else []
    return np.split(symbols[kept].astype(np.int32), np.cumsum(counts)[:-1]) if n else []


class WordEncoder:
    """Ids of words, remembered in up to about ``_MEMO`` bytes."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pieces = finder(WORD_LEVEL)
        special = map(regex.escape, sorted(self.vocabulary.special, key=len, reverse=True))
        self.special = regex.compile(f"({'|'.join(special)})") if self.vocabulary.special else None
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _split(self, text: str) -> list[str]:
        """Words between white space, special tokens by themselves."""
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return [w for p in parts for w in ([p] if p in self.vocabulary.special else self._split(p))]
        if _NARROW.search(text):
            return [w for w in _SPACE.split(text) if w]
        return text.split()

    def _word_pieces(self, word: str) -> list[str]:
        if not word.isascii():
            # A letter is lower-cased by itself, so there is no final sigma.
            word = unicodedata.normalize("NFC", word).replace("Σ", "σ")
        return self.pieces(word.lower())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit numbers."""
        if self.held > _MEMO:
            self.words, self.known, self.held = {}, {}, 0
        split = [self._split(text) for text in texts]
        words, known = self.words, self.known
        for token, number in self.vocabulary.special.items():
            words[token] = array("i", [number]).tobytes()
        new = {word: None for own in split for word in own if word not in words}
        for word in new:
            new[word] = self._word_pieces(word)
        pieces = list({piece for own in new.values() for piece in own if piece not in known})
        for piece, ids in zip(pieces, encode_pieces(pieces, self.vocabulary)):
            known[piece] = ids.tobytes()
            self.held += len(piece) + ids.nbytes + _ENTRY
        for word, own in new.items():
            found = words[word] = b"".join([known[piece] for piece in own])
            self.held += len(word) + len(found) + _ENTRY
        return [b"".join(map(words.__getitem__, own)) for own in split]


# Workers run many tasks; the vocabulary and the words they know stay.
@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def bpe_encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` with ``ids`` (array<int>), the ids of ``text`` as the vocabulary file gives them:
    special tokens are kept, the rest is composed (NFC), lower-cased, cut into words and merged.

    The distinct words that a worker has not met go through ``encode_pieces`` together, so a
    frequent word costs one merge run for each worker. NULL and empty texts have no ids. A column ``ids``
    of ``docs`` is replaced.
    """
    kept = [c for c in docs.columns if c != "ids"]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer)
        for batch in gathered(batches):
            found = encoder.encode([text or "" for text in batch["text"]])
            yield batch.assign(ids=[np.frombuffer(x, np.int32) for x in found])

    schema = docs.select(*kept).schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select(*kept).mapInPandas(each, schema)


def bpe_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` with ``ids`` as ``bpe_encode`` gives them and ``decoded`` as ``bpe_decode`` makes it of the
    ids, in one pass of one worker for each task. Columns ``ids`` and ``decoded`` are replaced, ``text`` is
    left out."""
    kept = [c for c in docs.columns if c not in ("ids", "decoded", "text")]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer)
        tokens = encoder.vocabulary.tokens
        for batch in gathered(batches):
            found = encoder.encode([text or "" for text in batch["text"]])
            batch = batch[kept]
            for at in range(0, len(found), _ROWS):
                ids = [np.frombuffer(x, np.int32) for x in found[at : at + _ROWS]]
                texts = [" ".join(map(tokens.__getitem__, own.tolist())) for own in ids]
                yield batch.iloc[at : at + _ROWS].assign(ids=ids, decoded=texts)

    schema = docs.select(*kept).schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    return docs.select(*kept, "text").mapInPandas(each, schema)


def bpe_decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` with ``decoded`` (string) made of ``ids``: the tokens, joined by one space, since
    such vocabularies come without a decoder. NULL and empty ids give an empty text."""
    kept = [c for c in encoded.columns if c != "decoded"]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = _encoder(tokenizer).vocabulary.tokens
        for batch in batches:
            texts = [
                "" if ids is None else " ".join(map(tokens.__getitem__, ids.tolist()))
                for ids in batch["ids"]
            ]
            yield batch.assign(decoded=texts)

    schema = encoded.select(*kept).schema.add("decoded", "string")
    return encoded.select(*kept).mapInPandas(each, schema)
