"""Token ids in files of Huffman-coded blocks."""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tidewatch.llm.pretokens import BYTE_LETTERS, BYTE_LEVEL, finder
from tidewatch.scratch import written

END = 0
CODE_BITS = 18
BLOCK_IDS = 1 << 18
CHECKPOINT_IDS = 64
_MEMO = 600_000
# So many places of runs (24 bytes each) go to all tasks; more are joined by their keys.
_RUNS_SENT = 200_000


class ByteLevelEncoder(dict):
    """Ids of texts as little-endian 16-bit numbers, by the tokenizers library.

    A text is cut into the pieces of the vocabulary's pattern, and each piece's ids are looked up
    here. A new piece goes through the library's model. Up to ``_MEMO`` pieces are remembered. A
    vocabulary of more than 65,536 ids raises.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path}: ids do not fit 16 bits")
        self.model = self.tokenizer.model
        self.pieces = finder(BYTE_LEVEL)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= _MEMO:
            self.clear()
        letters = piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = self[piece] = array("H", [token.id for token in self.model.tokenize(letters)]).tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        for token, number in self.special.items():
            if token in text:
                between = array("H", [number]).tobytes()
                return between.join(map(self.encode, text.split(token)))
        return b"".join(map(self.__getitem__, self.pieces(text)))


# Workers run many tasks; the pieces they know stay.
@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> ByteLevelEncoder:
    return ByteLevelEncoder(path)


def code_lengths(counts: np.ndarray, most: int) -> np.ndarray:
    """Bits of the optimal prefix code with at most ``most`` bits for symbols with positive
    ``counts``, by package-merge: each level merges the symbols with pairs of the level before;
    of the last level the cheapest 2n - 2 items are taken, and a taken pair takes two items below."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << most:
        raise ValueError(f"{n} symbols need more than {most} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(most - 1):
        even = len(level) // 2 * 2
        pairs = level[0:even:2] + level[1:even:2]
        both = np.concatenate([leaves, pairs])
        by_weight = np.argsort(both, kind="stable")
        level = both[by_weight]
        is_leaf.append(by_weight < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(is_leaf):
        symbols = int(flags[:take].sum())
        lengths[order[:symbols]] += 1
        take = 2 * (take - symbols)
    return lengths


@dataclass
class Code:
    """A canonical code: among the ids of one length, codes rise with the id. ``lengths`` alone
    define it; 0 marks an id without code."""

    lengths: np.ndarray

    def __post_init__(self):
        self.lengths = self.lengths.astype(np.int64)
        used = np.flatnonzero(self.lengths)
        self.most = int(self.lengths.max(initial=1))
        self.order = used[np.lexsort((used, self.lengths[used]))]
        sizes = np.int64(1) << (self.most - self.lengths[self.order])
        self.left = np.cumsum(sizes) - sizes

    def table(self) -> np.ndarray:
        """For each value of the next ``most`` bits, the id that starts there, and its length above
        16 bits."""
        sizes = np.int64(1) << (self.most - self.lengths[self.order])
        table = np.zeros(1 << self.most, np.uint32)
        table[: sizes.sum()] = np.repeat(self.lengths[self.order] << 16 | self.order, sizes)
        return table

    def codes(self) -> np.ndarray:
        """The code of each id, at the left of 64 bits."""
        codes = np.zeros(len(self.lengths), np.uint64)
        codes[self.order] = self.left.astype(np.uint64) << np.uint64(64 - self.most)
        return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ``ids`` and the bit at which every ``CHECKPOINT_IDS``-th of them starts."""
    n_bits = lengths[ids]
    ends = np.cumsum(n_bits)
    starts = ends - n_bits
    words, inside = starts >> 6, (starts & 63).astype(np.uint64)
    out = np.zeros(int(ends[-1] >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    out[words[first]] = np.bitwise_or.reduceat(codes[ids] >> inside, first)
    over = np.flatnonzero((ends - 1) >> 6 != words)
    out[words[over] + 1] |= codes[ids[over]] << (np.uint64(64) - inside[over])
    size = -(-int(ends[-1]) // 8)
    return out.astype(">u8").tobytes()[:size], starts[::CHECKPOINT_IDS].astype(np.uint32)


def unpack(payload: bytes, checkpoints: np.ndarray, n: int, most: int, table: np.ndarray) -> np.ndarray:
    """The ids of a block. All checkpoints advance together, one table lookup a step; the last one
    may run into the padding."""
    raw = np.frombuffer(payload + bytes(4 * CHECKPOINT_IDS), np.uint8).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at = checkpoints.astype(np.uint32)
    out = np.empty((CHECKPOINT_IDS, len(at)), np.uint16)
    for step in range(CHECKPOINT_IDS):
        found = table[(ahead[at >> 3] << (at & 7)) >> np.uint32(32 - most)]
        out[step] = found
        at = at + (found >> 16)
    return out.T.ravel()[:n]


def _encoded(docs: DataFrame, path: str) -> DataFrame:
    """Ids of all documents, written in ascending order: ``part, seq, doc_id, ids``. The last row of
    each part has no ``seq``, but the ids ``used`` in the part and their ``times``."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path)
        end = np.uint16(END).tobytes()
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            ids = [encoder.encode(text or "") + end for text in batch["text"]]
            total += np.bincount(np.frombuffer(b"".join(ids), np.uint16), minlength=1 << 16)
            yield batch[["part", "seq", "doc_id"]].assign(ids=ids, used=None, times=None)
        used = np.flatnonzero(total)
        if len(used):
            nothing = {name: pd.array([None], "Int64") for name in ("part", "seq", "doc_id")}
            yield pd.DataFrame(nothing).assign(ids=None, used=[used], times=[total[used]])

    order = [F.col("doc_id"), F.xxhash64("text")]
    sorted_docs = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = sorted_docs.select(
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("doc_id").cast("bigint"),
        "text",
    )
    schema = "part int, seq bigint, doc_id bigint, ids binary, used array<int>, times array<bigint>"
    return written(numbered.mapInPandas(each, schema), "ids")


def _counts(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; one number for each id comes to the driver."""
    found = encoded.where("used IS NOT NULL").select(F.explode(F.arrays_zip("used", "times")).alias("c"))
    counts = np.zeros(1 << 16, np.int64)
    for row in found.groupBy("c.used").agg(F.sum("c.times").alias("n")).collect():
        counts[row["used"]] = row["n"]
    return counts


def write_token_files(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encode ``docs`` (doc_id, text) and write them in ascending doc_id order to files in ``path``.

    ``<path>/code`` has the length of the code of each id, which defines the canonical code.
    ``<path>/blocks`` has rows of consecutive documents: ``part``, ``run`` and ``block`` order them,
    ``payload`` holds the bits, ``checkpoints`` the bit at which every 64th id starts, ``doc_ids``
    and ``n_tokens`` the documents, ``before`` the number of ids before the block in its run.
    A run is what one task read in one piece of the encoded rows, which are in order in their files, so
    nothing is shuffled again. Any block can be decoded from the code and its own row.

    A document is its ids and the id 0. NULL and empty texts have the id 0 only. Rows without
    doc_id come first; rows of one doc_id are ordered by a hash of their texts. An empty table
    gives files without rows.
    """
    spark = docs.sparkSession
    encoded = _encoded(docs.select("doc_id", "text"), tokenizer)
    counts = _counts(encoded)
    used = np.flatnonzero(counts)
    lengths = np.zeros(1 << 16, np.int64)
    lengths[used] = code_lengths(counts[used], CODE_BITS)
    code = spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, bits int")
    code.coalesce(1).write.mode("overwrite").parquet(f"{path}/code")

    names = ["part", "run", "block", "before", "payload", "checkpoints", "doc_ids", "n_tokens"]

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Code(lengths).codes()
        part, run, block, rows, size, before, following = None, None, None, [], 0, 0, None

        def closed() -> pd.DataFrame:
            payload, at = pack(np.frombuffer(b"".join(ids for _, ids in rows), np.uint16), lengths, codes)
            n_tokens = [len(ids) // 2 for _, ids in rows]
            row = (part, run, block, before, payload, at.tobytes(), [doc_id for doc_id, _ in rows], n_tokens)
            return pd.DataFrame([row], columns=names)

        for batch in batches:
            doc_ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            for own, seq, doc_id, ids in zip(batch["part"], batch["seq"], doc_ids, batch["ids"]):
                goes_on = own == part and seq == following
                if rows and (not goes_on or size >= BLOCK_IDS):
                    yield closed()
                    before += size
                    rows, size = [], 0
                if not goes_on:
                    part, run, before = own, seq, 0
                if not rows:
                    block = seq
                rows.append((doc_id, ids))
                size += len(ids) // 2
                following = seq + 1
        if rows:
            yield closed()

    schema = (
        "part int, run bigint, block bigint, before bigint, payload binary, checkpoints binary, "
        "doc_ids array<bigint>, n_tokens array<bigint>"
    )
    in_order = encoded.where("seq IS NOT NULL").select("part", "seq", "doc_id", "ids")
    in_order.mapInPandas(blocks, schema).write.mode("overwrite").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of each document of the files in ``path``: its place in the sequence
    of all ids, and its ids as little-endian unsigned 32-bit numbers."""
    blocks = spark.read.parquet(f"{path}/blocks")
    bits = np.zeros(1 << 16, np.int64)
    for row in spark.read.parquet(f"{path}/code").collect():
        bits[row["id"]] = row["bits"]
    n_ids = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, b: a + b)
    runs = blocks.select("part", "run", n_ids.alias("n")).groupBy("part", "run").agg(F.sum("n").alias("n"))
    # One row for each part, so no more than there are write tasks.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = runs.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_start", F.coalesce(F.sum("n").over(in_part), F.lit(0)))
    runs = runs.join(parts, "part").select("part", "run", (F.col("part_start") + F.col("run_start")).alias("first"))
    if blocks.select("part", "run").distinct().count() <= _RUNS_SENT:
        runs = F.broadcast(runs)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Code(bits)
        table = code.table()
        for batch in batches:
            columns = ("payload", "checkpoints", "doc_ids", "n_tokens", "first")
            for payload, checkpoints, doc_ids, n_tokens, first in zip(*(batch[c] for c in columns)):
                ends = np.cumsum(n_tokens)
                at = np.frombuffer(checkpoints, np.uint32)
                ids = unpack(payload, at, int(ends[-1]), code.most, table).astype("<u4")
                starts = ends - n_tokens
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(doc_ids, "Int64"),
                        "start": starts + first,
                        "ids": [ids[a:b].tobytes() for a, b in zip(starts, ends)],
                    }
                )

    placed = blocks.join(runs, ["part", "run"]).select(
        "payload", "checkpoints", "doc_ids", "n_tokens", (F.col("first") + F.col("before")).alias("first")
    )
    return placed.mapInPandas(each, "doc_id bigint, start bigint, ids binary")
