"""Hard negatives: rows of other labels that are nearly as close to an anchor as its positives.

Vectors are rotated, one bit is kept of each coordinate, and with it how well the code points along
the vector. Popcounts of a code against the bit planes of a quantised anchor estimate the inner
product; the part of the vector across the code is bounded by Cauchy and Schwarz, so every score
lies in a known interval. Rows whose interval can't reach a result are put aside, the others are
scored in integers. The intervals hold always, so the result is exact.

A fixed rotation and bounds that hold always are wide: a code of one bit a coordinate lets a score
vary by some 0.6 of the two lengths. What is put aside depends on how far scores are apart.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.scratch import written

POSITIVES = 5
NEGATIVES = 3
#: A negative has at least and at most these percentages of the positive's score.
LEAST_PERCENT, MOST_PERCENT = 50, 95
#: Components are counted in units of one in this.
SCALE = 256

# Bits of a coordinate of a quantised anchor.
_PLANES = 4
# Bytes of vectors that meet in one group, of rows and of anchors; rows and anchors compared at once.
_GROUP_BYTES = 4_000_000
_ROWS, _ANCHORS = 2048, 512
_NONE = np.iinfo(np.int64).min
# Sums of products stay below this in doubles without rounding.
_EXACT = float(1 << 53)


def integer_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` of the rows of (vec_id, label, embedding) that take part.

    A component becomes floor(256 * x). Left out are NULL ids, labels and vectors, and vectors with a
    component that is NULL, not finite, or so large that scores would not fit 64 bits.
    """
    whole = F.col("embedding")
    fine = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    vector = F.transform(whole, lambda x: F.floor(x.cast("double") * SCALE))
    squares = F.aggregate("vector", F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x.cast("double"))
    taken = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole.isNotNull() & fine)
    return taken.select("vec_id", "label", vector.alias("vector")).where(squares < float(1 << 62))


@functools.lru_cache(maxsize=1)
def rotation(size: int) -> np.ndarray:
    """A random rotation, the same in every task."""
    drawn = np.random.default_rng(size).standard_normal((size, size))
    return np.linalg.qr(drawn)[0]


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), size), np.int64)
    flat = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return packed.view(np.uint64)


def codes_of(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One-bit codes as 64-bit words, the cosine between each code and its vector, and lengths."""
    turned = vectors @ rotation(vectors.shape[1])
    length = np.linalg.norm(turned, axis=1)
    code = turned >= 0
    along = np.abs(turned).sum(axis=1) / np.sqrt(max(vectors.shape[1], 1))
    return _words(code), np.divide(along, length, out=np.ones_like(along), where=length > 0), length


class Anchors:
    """Rotated anchors in bit planes, with what the quantisation leaves over."""

    def __init__(self, vectors: np.ndarray):
        size = vectors.shape[1]
        turned = vectors @ rotation(size)
        self.length = np.linalg.norm(turned, axis=1)
        unit = turned / np.where(self.length > 0, self.length, 1)[:, None]
        self.base = unit.min(axis=1)
        self.step = np.maximum((unit.max(axis=1) - self.base) / (2**_PLANES - 1), 1e-12)
        level = np.rint((unit - self.base[:, None]) / self.step[:, None]).astype(np.int64)
        left = unit - (self.base[:, None] + self.step[:, None] * level)
        self.left = np.linalg.norm(left, axis=1)
        self.sum = level.sum(axis=1)
        self.planes = [_words(level >> p & 1 > 0) for p in range(_PLANES)]
        self.size = size

    def intervals(self, some: slice, codes: np.ndarray, along: np.ndarray, length: np.ndarray):
        """Lower and upper bounds of the scores of anchors ``some`` with coded rows."""
        met = np.zeros((len(self.length[some]), len(codes)), np.int64)
        for p, plane in enumerate(self.planes):
            both = np.bitwise_count(plane[some][:, None, :] & codes[None, :, :]).sum(axis=2, dtype=np.int64)
            met += both << p
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        root = np.sqrt(max(self.size, 1))
        base, step, left = (x[some][:, None] for x in (self.base, self.step, self.left))
        # Inner product of the quantised anchor with the code as a unit vector.
        estimate = (base * (2 * ones - self.size) + step * (2 * met - self.sum[some][:, None])) / root
        sure = np.maximum(np.abs(estimate) - left, 0)
        across = np.sqrt(np.maximum(1 - along**2, 0)) * np.sqrt(np.maximum(1 - sure**2, 0))
        reach = along * left + across + 1e-9
        scale = self.length[some][:, None] * length
        return scale * (along * estimate - reach) - 1e-3, scale * (along * estimate + reach) + 1e-3


def _scores(anchors: np.ndarray, rows: np.ndarray, near: np.ndarray, exact: bool) -> np.ndarray:
    """Integer scores where ``near``, and a lowest value elsewhere."""
    out = np.full(near.shape, _NONE)
    if exact and near.mean() > 0.02:
        products = anchors.astype(float) @ rows.astype(float).T
        out[near] = products[near].astype(np.int64)
    else:
        i, j = np.nonzero(near)
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            out[a, b] = np.einsum("ij,ij->i", anchors[a], rows[b])
    return out


def _first(scores: np.ndarray, ids: np.ndarray, new: np.ndarray, new_ids: np.ndarray):
    """The best of each row of ``scores`` and ``new``, ties by place: what is held stands before."""
    held = scores.shape[1]
    everything = np.hstack([scores, new])
    out, out_ids = np.empty_like(scores), np.empty_like(ids)
    line = np.arange(len(scores))
    for k in range(held):
        at = everything.argmax(axis=1)
        out[:, k] = everything[line, at]
        out_ids[:, k] = np.where(at < held, ids[line, np.minimum(at, held - 1)], new_ids[np.maximum(at - held, 0)])
        everything[line, at] = _NONE
    return out, out_ids


class _Side:
    """One side of a group, ordered by id."""

    def __init__(self, table: pa.Table, size: int):
        self.table = table.take(pa.array(np.argsort(table["vec_id"].to_numpy(), kind="stable")))
        self.ids = self.table["vec_id"].to_numpy()
        self.labels = self.table["label"].to_numpy()
        self.vectors = _matrix(self.table["vector"], size)


def _coded(side: _Side):
    table = side.table
    raw = b"".join(table["code"].to_pylist())
    codes = np.frombuffer(raw, np.uint64).reshape(len(side.ids), -1)
    return codes, table["along"].to_numpy(), table["length"].to_numpy()


def _positives(size: int, count: int) -> Callable:
    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, anchors = _Side(left, size), _Side(right, size)
        codes, along, length = _coded(rows)
        out = []
        for label in np.unique(anchors.labels):
            mine, theirs = np.flatnonzero(anchors.labels == label), np.flatnonzero(rows.labels == label)
            for at in range(0, len(mine), _ANCHORS):
                of = mine[at : at + _ANCHORS]
                query = Anchors(anchors.vectors[of])
                best = np.full((len(of), count), _NONE)
                best_ids = np.zeros((len(of), count), np.int64)
                for begin in range(0, len(theirs), _ROWS):
                    j = theirs[begin : begin + _ROWS]
                    _, high = query.intervals(slice(None), codes[j], along[j], length[j])
                    near = (high >= best[:, -1:]) & (anchors.ids[of][:, None] != rows.ids[j])
                    exact = query.length.max() * length[j].max() < _EXACT
                    new = _scores(anchors.vectors[of], rows.vectors[j], near, exact)
                    best, best_ids = _first(best, best_ids, new, rows.ids[j])
                i, k = np.nonzero(best > _NONE)
                out.append((anchors.ids[of][i], best_ids[i, k], best[i, k]))
        return _table(out, ["anchor_id", "positive_id", "positive_score"])

    return each


def _negatives(size: int, count: int, least: int, most: int) -> Callable:
    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, anchors = _Side(left, size), _Side(right, size)
        codes, along, length = _coded(rows)
        wanted = anchors.table["positives"].to_pylist()
        widest = max(map(len, wanted), default=0)
        floor = np.full((len(wanted), widest), np.iinfo(np.int64).max)
        top = np.full((len(wanted), widest), _NONE)
        for i, positives in enumerate(wanted):
            for p, positive in enumerate(positives):
                score = positive["positive_score"]
                floor[i, p], top[i, p] = -((-least * score) // 100), most * score // 100
        out = []
        for at in range(0, len(wanted) if widest else 0, _ANCHORS):
            of = np.arange(at, min(at + _ANCHORS, len(wanted)))
            query = Anchors(anchors.vectors[of])
            best = [np.full((len(of), count), _NONE) for _ in range(widest)]
            best_ids = [np.zeros((len(of), count), np.int64) for _ in range(widest)]
            for begin in range(0, len(rows.ids), _ROWS):
                j = slice(begin, begin + _ROWS)
                low, high = query.intervals(slice(None), codes[j], along[j], length[j])
                reach = np.min([np.maximum(floor[of, p], best[p][:, -1]) for p in range(widest)], axis=0)
                near = (high >= reach[:, None]) & (low <= top[of].max(axis=1)[:, None])
                near &= anchors.labels[of][:, None] != rows.labels[j]
                if not near.any():
                    continue
                exact = query.length.max() * length[j].max() < _EXACT
                scores = _scores(anchors.vectors[of], rows.vectors[j], near, exact)
                for p in range(widest):
                    inside = near & (scores >= floor[of, p][:, None]) & (scores <= top[of, p][:, None])
                    new = np.where(inside, scores, _NONE)
                    best[p], best_ids[p] = _first(best[p], best_ids[p], new, rows.ids[j])
            for p in range(widest):
                i, k = np.nonzero(best[p] > _NONE)
                chosen = [wanted[x][p] for x in of[i]]
                out.append(
                    (
                        anchors.ids[of][i],
                        np.array([c["positive_id"] for c in chosen], np.int64),
                        np.array([c["positive_score"] for c in chosen], np.int64),
                        best_ids[p][i, k],
                        best[p][i, k],
                    )
                )
        return _table(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return each


def _table(parts: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*parts, strict=True) if parts else [[]] * len(names)
    return pa.table([pa.array(np.concatenate([np.empty(0, np.int64), *c])) for c in columns], names)


def _with_codes(rows: DataFrame, size: int) -> DataFrame:
    def each(batches):
        for batch in batches:
            codes, along, length = codes_of(_matrix(pa.chunked_array([batch.column("vector")]), size))
            coded = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(along), pa.array(length)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *coded], [*batch.schema.names, "code", "along", "length"])

    return rows.mapInArrow(
        each, "vec_id bigint, label int, vector array<bigint>, code binary, along double, length double"
    )


def _best(found: DataFrame, by: list[str], score: str, other: str, count: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(other))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    most_percent: int = MOST_PERCENT,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors
    among ``rows`` (vec_id, label, vector of integers), see ``integer_vectors``.

    The positives of an anchor are the first other rows of its label by score, ties by id. For each,
    the negatives are the first rows of other labels between the two percentages of its score.
    Anchors are compared with all rows in blocks of bounded size. Shorter vectors are filled up with
    zeros. An id stands for one row: of several rows the one with the smallest label, then vector, counts.
    No anchors, no positives or no rows give no rows. Other columns are ignored.
    """
    one = rows.groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(
        F.min(F.struct(F.col("label").cast("int").alias("label"), F.col("vector").cast("array<bigint>").alias("vector"))).alias("_row")
    )
    one = written(one.select("vec_id", "_row.label", "_row.vector"), "vectors")
    n, size = one.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    size = max(size, 1)
    coded = written(_with_codes(one, size), "coded")
    anchors = written(coded.where(is_anchor).select("vec_id", "label", "vector"), "anchors")
    per_group = max(_GROUP_BYTES // (8 * size), 64)
    shards, blocks = n // per_group + 1, anchors.count() // per_group + 1

    def dealt(df: DataFrame, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
        """Every row in one part of its own kind, and once for each part of the other kind."""
        part = F.pmod(F.xxhash64("vec_id", F.lit(own)), F.lit(own_count))
        every = F.explode(F.sequence(F.lit(0), F.lit(other_count - 1)).cast("array<bigint>"))
        return df.withColumn(own, part).withColumn(other, every)

    dealt_rows = dealt(coded, "shard", shards, "block", blocks).groupBy("block", "shard")

    def compared(left: DataFrame, function: Callable, schema: str) -> DataFrame:
        grouped = dealt(left, "block", blocks, "shard", shards).groupBy("block", "shard")
        return dealt_rows.cogroup(grouped).applyInArrow(function, schema)

    near = compared(anchors, _positives(size, positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    near = _best(near, ["anchor_id"], "positive_score", "positive_id", positives)
    near = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    paired = written(anchors.join(near, "vec_id"), "paired")
    found = compared(paired, _negatives(size, negatives, least_percent, most_percent), schema)
    found = _best(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
