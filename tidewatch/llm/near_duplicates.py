"""Near-duplicate documents by fast similarity sketches, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.components import components
from tidewatch.llm.words import mixed, shingles_of, signed
from tidewatch.scratch import written

# 50 bands of 5: a pair of similarity 0.75 shares no band once in 760,000, a pair of 0.1 shares
# one once in 2,000.
BANDS, ROWS = 50, 5
# Share of equal coordinates below which a pair is not compared. A pair of similarity 0.75 falls
# that low less than once in a million (binomial, 250 coordinates; 188 expected, 152 asked for).
_LEAST_EQUAL = 0.61
_ROUND = np.uint64(0xD6E8FEB86659FD93)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_DRAWS = 2048


def sketch_of(shingles: np.ndarray, size: int) -> np.ndarray:
    """A sketch of ``size`` coordinates of which two agree with the probability of the Jaccard
    similarity of their sets.

    In round i each element goes to a hashed bin with a hashed value; a bin keeps the smallest
    value of the first round that reached it. After ``size`` rounds, round size + j puts all
    elements into bin j, so every bin is filled at the end. A set much larger than the sketch
    needs one round. Rounds run in blocks of about ``_DRAWS`` draws; a block may run past the
    round that fills the last bin, which changes nothing, as earlier rounds win.
    """
    sketch = np.full(size, _EMPTY)
    first, step = 0, max(1, min(2 * size, _DRAWS // len(shingles)))
    # The round takes the highest bits, as many as the last one needs.
    bits = np.uint64((2 * size - 1).bit_length())
    while first < 2 * size and (sketch == _EMPTY).any():
        rounds = np.arange(first, min(first + step, 2 * size), dtype=np.uint64)
        drawn = mixed(shingles[None, :] + (rounds * _ROUND)[:, None])
        bins = ((drawn >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        late = rounds >= size
        bins[late] = (rounds[late] - np.uint64(size))[:, None]
        values = (rounds << (np.uint64(64) - bits))[:, None] | (mixed(drawn) >> bits)
        np.minimum.at(sketch, bins.ravel().astype(np.int64), values.ravel())
        first += step
    return sketch


def bands_of(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key for each ``rows`` coordinates; keys of different bands differ."""
    parts = sketch.reshape(-1, rows)
    total = np.arange(len(parts), dtype=np.uint64) + np.uint64(1)
    for j in range(rows):
        total = mixed(total * _ROUND + parts[:, j])
    return total


def sketches(docs: DataFrame, words: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, set_high, set_low, bands, sketch`` for each document; the two hashes
    name the set, ``sketch`` has the last byte of each coordinate. A document without words has no
    bands and no sketch."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                shingles = shingles_of(text, words)
                if not len(shingles):
                    found.append((0, 0, 0, None, None))
                    continue
                name = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
                sketch = sketch_of(shingles, bands * rows)
                keys = signed(bands_of(sketch, rows))
                found.append((len(shingles), *name.tolist(), keys, sketch.astype(np.uint8).tobytes()))
            columns = ["n_shingles", "set_high", "set_low", "bands", "sketch"]
            out = pd.DataFrame(found, columns=columns)
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    schema = (
        "doc_id bigint, n_shingles bigint, set_high bigint, set_low bigint, bands array<bigint>, sketch binary"
    )
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(each, schema)


def likely(pairs: DataFrame, sketches: DataFrame, least: float = _LEAST_EQUAL) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose sketches agree in ``least`` of the coordinates."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = (
                    np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), -1)
                    for c in ("sketch_a", "sketch_b")
                )
                yield batch.loc[(a == b).mean(axis=1) >= least, ["a", "b"]]

    a = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    b = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(b, "b").join(a, "a").mapInPandas(each, "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose whole shingle sets are similar enough."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, left = None, None
        for batch in batches:
            keep = []
            for a, b in zip(batch["text_a"], batch["text_b"]):
                if a != last:
                    last, left = a, shingles_of(a, words)
                right = shingles_of(b, words)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInPandas(each, "a bigint, b bigint").distinct()


def shingle_rows(texts: DataFrame, words: int) -> DataFrame:
    """``node, size, shingle`` for each shingle of each of ``texts`` (node, text)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles_of(text, words) for text in batch["text"]]
            sizes = np.array([len(s) for s in sets], np.int64)
            nodes = batch["node"].to_numpy()
            flat = signed(np.concatenate(sets)) if sets else []
            yield pd.DataFrame({"node": np.repeat(nodes, sizes), "size": np.repeat(sizes, sizes), "shingle": flat})

    return texts.select("node", "text").mapInPandas(each, "node bigint, size bigint, shingle bigint")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket, node, label`` of the buckets whose members are in several components."""
    placed = members.select("bucket", "node").join(labels, "node", "left")
    placed = placed.select("bucket", "node", F.coalesce("label", "node").alias("label"))
    several = placed.groupBy("bucket").agg(F.min("label").alias("_low"), F.max("label").alias("_high"))
    several = several.where("_low < _high").select("bucket")
    return written(placed.join(several, "bucket", "left_semi"), "open")


def _by_rare_shingles(nodes: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """``a, b`` for pairs of ``nodes`` (node, label) of different components that may be similar.

    The shingles of a set stand in one order for all sets, rare ones first. Of two sets with a
    similarity of ``percent`` the first ones of each have one in common: they share ``percent`` of the
    larger set and 2 * percent / (100 + percent) of the smaller one. At the first shingle they
    share, they can share no more than what is left of either.
    """
    rows = shared.join(nodes, "node")
    several = rows.groupBy("shingle").agg(F.min("label").alias("_low"), F.max("label").alias("_high"))
    several = several.where("_low < _high").select("shingle")
    rows = rows.join(several, "shingle", "left_semi")
    # Shingles of one component only come before all others.
    own = Window.partitionBy("node")
    rest = F.count(F.lit(1)).over(own) - F.row_number().over(own.orderBy("often", "shingle")) + 1
    rows = rows.withColumn("rest", rest).where(f"rest * 100 >= size * {percent}")
    rows = written(rows.select("node", "label", "size", "shingle", "rest"), "first-shingles")
    left = rows.where(f"rest * {100 + percent} >= size * {2 * percent}").select(
        "shingle", *[F.col(c).alias(f"{c}_x") for c in ("node", "label", "size", "rest")]
    )
    right = rows.select("shingle", *[F.col(c).alias(f"{c}_y") for c in ("node", "label", "size", "rest")])
    pairs = left.join(right, "shingle").where(
        "label_x <> label_y AND (size_x < size_y OR size_x = size_y AND node_x < node_y)"
        f" AND least(rest_x, rest_y) * {100 + percent} >= {percent} * (size_x + size_y)"
    )
    return pairs.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 75, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (doc_id, text).

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of lower-case
    ``words``-word shingles; ``component_id`` is the smallest doc_id that links reach.

    - Equal sets are one class, so groups of copies of any size cost one row each.
    - In each bucket of a band the smallest member is compared with the others. What that links
      is joined into components. In buckets that hold several components the member with the
      fewest rare shingles is compared in the same way. Then members of different components are
      compared if they share one of their rarest shingles (``_by_rare_shingles``). Members that
      are similar enough always do, so no candidate link between components is left out, while a
      large group of near copies is not multiplied out.
    - Pairs whose sketches are far apart are put aside (``_LEAST_EQUAL``).
    - Every link is confirmed on whole sets, computed anew from the texts.

    NULL or empty texts have no shingles and stay alone. Rows without doc_id get a NULL
    component and are kept. Rows that share a doc_id are one node, linked by any of their texts.
    Other columns of ``docs`` are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    rows_of = written(sketches(docs, words, bands, rows), "sketches")
    known = rows_of.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("set_high", "set_low").agg(
        F.min(F.struct("doc_id", "bands", "sketch")).alias("first")
    )
    classes = classes.select(
        "set_high", "set_low", F.col("first.doc_id").alias("node"), "first.bands", "first.sketch"
    )
    classes = written(classes, "classes")
    members = classes.select("node", F.explode("bands").alias("bucket"))
    full = members.groupBy("bucket").agg(
        F.min("node").alias("leader"), F.max("node").alias("_most")
    )
    full = full.where("leader < _most").drop("_most")
    members = written(members.join(full, "bucket"), "buckets")

    nodes = members.select("node").distinct()
    texts = docs.withColumnRenamed("doc_id", "node").join(nodes, "node", "left_semi")
    texts = written(texts, "texts")
    signs = classes.select("node", "sketch").join(nodes, "node", "left_semi")
    stars = members.where("leader < node").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    stars = written(likely(stars.distinct(), signs), "stars")
    links = written(verified(stars, texts, words, percent), "verified")
    labels = components(links, "a", "b")

    # In buckets that are not one component yet the member with the fewest rare shingles, which is
    # the closest to most others, is compared with the others.
    still = _open(members, labels)
    rows = shingle_rows(texts.join(still.select("node").distinct(), "node", "left_semi"), words)
    rows = written(rows, "shingles")
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = written(rows.join(often, "shingle"), "shared")
    rare = shared.groupBy("node").agg((1 - F.count(F.lit(1)) / F.first("size")).alias("rare"))
    still = still.join(rare, "node", "left").withColumn("rare", F.coalesce("rare", F.lit(1.0)))
    central = still.groupBy("bucket").agg(
        F.min_by(F.struct("node", "label"), F.struct("rare", "node")).alias("_center")
    )
    pairs = still.join(central, "bucket").where("label <> _center.label").select(
        F.least("node", "_center.node").alias("a"), F.greatest("node", "_center.node").alias("b")
    )
    seconds = written(likely(pairs.distinct().join(stars, ["a", "b"], "left_anti"), signs), "seconds")
    links = links.union(written(verified(seconds, texts, words, percent), "verified"))
    labels = components(links, "a", "b")

    still = _open(members, labels).select("node", "label").distinct()
    crossing = _by_rare_shingles(still, shared, percent)
    crossing = likely(crossing, signs).join(stars.union(seconds), ["a", "b"], "left_anti")
    links = links.union(written(verified(written(crossing, "crossing"), texts, words, percent), "verified"))
    labels = components(links, "a", "b")

    labelled = classes.join(labels, "node", "left").select(
        "set_high", "set_low", F.coalesce("label", "node").alias("_component")
    )
    named = rows_of.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("set_high")).alias("set_high"),
        F.when(F.col("n_shingles") > 0, F.col("set_low")).alias("set_low"),
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    result = named.join(labelled, ["set_high", "set_low"], "left")
    result = result.select("doc_id", "n_shingles", component.alias("component_id"))
    return result.withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near copies, the one with the smallest id.
    Of rows that share a doc_id the one with the smallest text stays (NULL first), of those with equal
    texts one by a hash of all columns. Rows without doc_id stay. No rows give no rows."""
    found = near_duplicates(docs, **options)
    gone = found.where("NOT kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    own = Window.partitionBy("doc_id").orderBy("text", F.xxhash64(*docs.columns))
    one = left.where("doc_id IS NOT NULL").withColumn("_place", F.row_number().over(own)).where("_place = 1")
    return one.select(docs.columns).union(left.where("doc_id IS NULL"))
