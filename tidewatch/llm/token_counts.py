"""Token counts under a unigram model, by dynamic programming over a trie of words."""

from __future__ import annotations

import base64
import functools
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.words import gathered

# Costs are natural logarithms times this, as whole numbers, so sums are exact.
COST_UNIT = 1 << 16
TOKEN_BITS = 32
_WORDS = 600_000


def piece_costs(path: str) -> dict[bytes, int]:
    """Pieces of a vocabulary file with ranks, and the cost of each: minus the logarithm of its
    probability where probabilities fall as 1 / (rank + 1)."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    total = sum(1 / (rank + 1) for rank in ranks.values())
    return {p: round(COST_UNIT * math.log((rank + 1) * total)) for p, rank in ranks.items()}


class UnigramTrie:
    """Cost and token count of the cheapest segmentation of words.

    New words enter as a trie that is walked depth-first: in sorted order, the forward scores on
    the path from the root to the last word are on a stack, and a word computes scores only for the
    prefixes that it doesn't share with the word before. ``terminal`` keeps the scores at the ends of
    up to ``_WORDS`` words, as ``cost << TOKEN_BITS | tokens``, so that of equal costs the fewer
    tokens win.
    """

    def __init__(self, path: str):
        costs = piece_costs(path)
        missing = [b for b in range(256) if bytes([b]) not in costs]
        if missing:
            raise ValueError(f"{path}: bytes without a piece: {missing}")
        self.pieces = {piece: cost << TOKEN_BITS | 1 for piece, cost in costs.items()}
        # A piece can end at a place only if each shorter part that ends there is one of these.
        self.endings = {piece[i:] for piece in costs for i in range(len(piece))}
        self.terminal: dict[bytes, int] = {}

    def insert(self, words: set[bytes]) -> None:
        """Compute and remember the scores of new words."""
        if len(self.terminal) > _WORDS:
            self.terminal = {}
        pieces, endings, terminal = self.pieces, self.endings, self.terminal
        before, scores = b"", [0]
        for word in sorted(words - terminal.keys()):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del scores[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                start = end - 1
                part = word[start:end]
                least = scores[start] + pieces[part]
                while start and part in endings:
                    start -= 1
                    part = word[start:end]
                    if part in pieces:
                        least = min(least, scores[start] + pieces[part])
                scores.append(least)
            terminal[word] = scores[-1]
            before = word


# Workers run many tasks; the trie stays.
@functools.lru_cache(maxsize=1)
def _trie(path: str) -> UnigramTrie:
    return UnigramTrie(path)


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens, cost`` for each row of ``docs`` (doc_id, text).

    A text is cut before each space; the parts put together are the text. Each is segmented into
    vocabulary pieces at the least cost, bytes standing for themselves where no longer piece fits,
    so ``n_tokens`` pieces spell the whole text. ``cost`` is the sum in 1 / ``COST_UNIT``. Each worker
    computes a part once while it remembers it; nothing is shuffled. NULL and empty texts have no
    tokens. Rows are independent: repeated rows and missing ids give a row each. Other columns are ignored.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = _trie(vocabulary)
        for batch in gathered(batches):
            split = [_parts(text or "") for text in batch["text"]]
            trie.insert({part for parts in split for part in parts})
            totals = [sum(map(trie.terminal.__getitem__, parts)) for parts in split]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].array,
                    "n_pretokens": [len(parts) for parts in split],
                    "n_tokens": [total & (1 << TOKEN_BITS) - 1 for total in totals],
                    "cost": [total >> TOKEN_BITS for total in totals],
                }
            )

    schema = "doc_id bigint, n_pretokens bigint, n_tokens bigint, cost bigint"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(each, schema)


def _parts(text: str) -> list[bytes]:
    first, *others = text.encode().split(b" ")
    return [first] * bool(first) + [b" " + other for other in others]
