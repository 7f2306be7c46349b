"""Test items inside long documents: containment search with MinHash, partitioned by size."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.words import mixed, signed, windows_of, word_hashes
from tidewatch.scratch import written

# A pair that should be found shares no key less often than this.
MISSED = 1e-6
_FILTER_BITS = 22
_ROUND = np.uint64(0xD6E8FEB86659FD93)


def hashes_needed(item_size: int, doc_size: int, percent: int) -> int:
    """Number of minima of which an item of ``item_size`` shingles or more and a document of at most
    ``doc_size`` share one, but for ``MISSED``, if the document contains ``percent`` of the item."""
    shared = percent * item_size / 100
    similarity = shared / (doc_size + item_size - shared)
    return 1 if similarity >= 1 else math.ceil(math.log(MISSED) / math.log1p(-similarity))


def _class(size: int) -> int:
    """Sizes from 2 ** (k - 1) to 2 ** k - 1 are class k."""
    return int(size).bit_length()


def _keys(shingles: np.ndarray, item_class: int, doc_class: int, percent: int) -> np.ndarray:
    """Keys of a set for the search of items of one class in documents of another: minima under as
    many hash functions as that pair of classes needs, or the shingles where those are fewer than
    the minima, in which case the search is exact."""
    needed = hashes_needed(1 << (item_class - 1), (1 << doc_class) - 1, percent)
    place = np.uint64(item_class << 8 | doc_class)
    if needed >= (1 << doc_class) - 1:
        return mixed(shingles ^ mixed(np.array([place]))[0])
    rounds = np.arange(needed, dtype=np.uint64)
    minima = np.empty(needed, np.uint64)
    for at in range(0, needed, 64):
        some = rounds[at : at + 64]
        minima[at : at + 64] = mixed(shingles[None, :] + (some * _ROUND)[:, None]).min(axis=1)
    return mixed(minima ^ mixed((rounds << np.uint64(16)) | place))


def _item_sets(items: DataFrame, words: int) -> DataFrame:
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [
                np.unique(windows_of(word_hashes(text, lower=True), words)) for text in batch["text"]
            ]
            out = pd.DataFrame({"item_id": batch["item_id"], "shingles": [signed(s) for s in sets]})
            yield out[out["shingles"].map(len) > 0]

    return items.mapInPandas(each, "item_id bigint, shingles array<bigint>").distinct()


def _shingle_filter(item_sets: DataFrame) -> np.ndarray:
    """A table of 2 ** ``_FILTER_BITS`` bits, set where some item has a shingle. Its size is fixed;
    with very many items it lets more pass, which costs time and changes no result."""
    bits = item_sets.select(F.explode("shingles").alias("s")).select(
        F.shiftrightunsigned("s", 64 - _FILTER_BITS).alias("bit")
    )
    words = bits.groupBy(F.shiftright("bit", 5).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 31 AS INT))")).alias("bits")
    )
    table = np.zeros(1 << (_FILTER_BITS - 5), np.uint32)
    for row in words.collect():
        table[row["word"]] = row["bits"]
    return table


def _doc_sets(docs: DataFrame, table: np.ndarray, words: int) -> DataFrame:
    """The shingles of each document that pass the filter; documents without any are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        for batch in batches:
            rows = []
            for doc_id, copy, text in zip(batch["doc_id"], batch["copy"], batch["text"]):
                found = windows_of(word_hashes(text, lower=True), words)
                at = found >> np.uint64(64 - _FILTER_BITS)
                passed = bits[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32) & 1
                found = np.unique(found[passed == 1])
                if len(found):
                    rows.append((doc_id, copy, signed(found)))
            yield pd.DataFrame(rows, columns=["doc_id", "copy", "shingles"])

    return docs.mapInPandas(each, "doc_id bigint, copy bigint, shingles array<bigint>")


def contained_items(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id, copy, item_id, n_shared, n_item_shingles``: each document of ``docs`` (doc_id, text)
    that contains ``percent`` of the distinct lower-case ``words``-word shingles of an item of ``items``
    (item_id, text); ``copy`` is ``xxhash64(text)``.

    Shingles that no item has cannot be shared, so a fixed-size filter of the items' shingles takes
    them out of the documents first, and with them nearly all documents; containment of items stays
    the same. Items and what is left of documents are partitioned by size, in powers of two. For
    each pair of classes the containment asked for gives a least Jaccard similarity, and that the
    number of MinHash keys (``hashes_needed``); items and documents that share a key are
    candidates. Each candidate is verified by intersecting its whole sets. Broadcasts are the filter and
    the list of item classes, both of fixed size.

    NULL and empty texts, and items of fewer than ``words`` words, match nothing. Rows without doc_id or
    item_id are passed over. Repeated rows give one row; texts under one doc_id are judged each.
    Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("copy"), "text")
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    items = items.select(F.col("item_id").cast("bigint"), "text").where("item_id IS NOT NULL")
    item_sets = written(_item_sets(items, words), "items")
    doc_sets = written(_doc_sets(docs, _shingle_filter(item_sets), words).distinct(), "doc-sets")
    # Classes are bit lengths, so there are 63 at most.
    item_classes = sorted(r[0] for r in item_sets.select(F.length(F.bin(F.size("shingles").cast("bigint")))).distinct().collect())
    doc_classes = sorted(r[0] for r in doc_sets.select(F.length(F.bin(F.size("shingles").cast("bigint")))).distinct().collect())

    def keys_of(sets: DataFrame, names: list[str], is_item: bool) -> DataFrame:
        others = doc_classes if is_item else item_classes

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keys = []
                for shingles in batch["shingles"]:
                    shingles = np.asarray(shingles, np.int64).view(np.uint64)
                    own = _class(len(shingles))
                    pairs = [(own, other) if is_item else (other, own) for other in others]
                    found = [_keys(shingles, a, b, percent) for a, b in pairs]
                    keys.append(signed(np.unique(np.concatenate(found))))
                yield batch[names].assign(keys=keys)

        schema = ", ".join(f"{name} bigint" for name in names) + ", keys array<bigint>"
        return sets.mapInPandas(each, schema).select(*names, F.explode("keys").alias("key"))

    doc_key = ["doc_id", "copy"]
    item_keys = keys_of(item_sets, ["item_id"], is_item=True)
    doc_keys = keys_of(doc_sets, doc_key, is_item=False)
    candidates = doc_keys.join(item_keys, "key").select(*doc_key, "item_id").distinct()
    item_sets = item_sets.withColumnRenamed("shingles", "_item")
    both = candidates.join(item_sets, "item_id").join(doc_sets, doc_key)
    found = both.select(
        *doc_key,
        "item_id",
        F.size(F.array_intersect("shingles", "_item")).cast("bigint").alias("n_shared"),
        F.size("_item").cast("bigint").alias("n_item_shingles"),
    )
    return found.where(100 * F.col("n_shared") >= percent * F.col("n_item_shingles"))


def without_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text contains an item, see ``contained_items``."""
    gone = contained_items(docs, items, **options).select(
        F.col("doc_id").alias("_gone_id"), F.col("copy").alias("_gone_copy")
    )
    same = (docs["doc_id"] == F.col("_gone_id")) & (F.xxhash64(docs["text"]) == F.col("_gone_copy"))
    return docs.join(gone.distinct(), same, "left_anti")
