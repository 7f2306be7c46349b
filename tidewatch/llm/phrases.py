"""Collocations: phrases of two or three words that occur far more often than their parts suggest.

Suffix pointers are sorted by a multikey three-way quicksort over (language, word, word, word). It
partitions the pointers of a segment by one key into less, equal and greater; the size of an
equal partition is the count of its phrase. All open segments are partitioned in one numpy step.

Each task sorts the suffixes of some megabytes of text, which collapses equal ones. The rest is
routed by its two leading words, sorted again, and partitions below the least count are abandoned
before their next word is looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.words import mixed
from tidewatch.scratch import written

#: A phrase has at least this many occurrences.
LEAST = 10
#: A candidate is dropped for a longer phrase that covers this share of its occurrences.
COVERED_PERCENT = 50
#: Phrases of the report, for each language.
TOP = 2000
NO_LANG = "und"

# The classes of characters of the definition: pieces end at the first, words at the second.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")

# Characters that a task sorts at once, and suffixes that one routed group should hold.
_SORTED_CHARACTERS = 8_000_000
_GROUP_SUFFIXES = 2_000_000
# Words with a larger share than one in this of a language's words are hot; there are at most so many.
_HOT_SHARE = 1000
_SALTS = 16
# Each of so many slices of a language's phrases is cut to its best before all are ranked in one task.
_SLICES = 32


def _sections(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    """Languages and lower-cased texts of about ``_SORTED_CHARACTERS``. A longer text is cut where
    pieces end, which no phrase spans."""
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = (text or "").encode().lower().translate(_TABLE)
            at = 0
            while at < len(raw):
                end = len(raw)
                if end - at > _SORTED_CHARACTERS:
                    end = raw.find(b"\n", at + _SORTED_CHARACTERS) + 1 or end
                langs.append(lang)
                texts.append(raw[at:end])
                size += end - at
                at = end
                if size >= _SORTED_CHARACTERS:
                    yield langs, texts
                    langs, texts, size = [], [], 0
    if texts:
        yield langs, texts


def _numbered(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where the words between spaces and line feeds start, their numbers, from 0 as they first come,
    and the words by number."""
    full = (letters != 32) & (letters != 10)
    edge = np.flatnonzero(np.diff(full, prepend=False, append=False))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters[full])]
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    return starts, coded.indices.to_numpy(), coded.dictionary


class _Words:
    """The words of some texts as numbers from 1, in order, with their languages and pieces."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        letters = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        starts, numbers, self.words = _numbered(letters)
        self.flat = numbers + np.int32(1)
        self.piece = np.cumsum(letters == 10, dtype=np.int32)[starts]
        self.names = list(dict.fromkeys(langs))
        code = {lang: i for i, lang in enumerate(self.names)}
        ends = np.cumsum([len(text) + 1 for text in texts])
        sizes = np.diff(np.searchsorted(starts, ends), prepend=0)
        self.lang = np.repeat(np.array([code[x] for x in langs], np.int32), sizes)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language, word (from 0) and occurrences."""
        joint = self.lang.astype(np.int64) * len(self.words) + (self.flat - 1)
        joint, n = np.unique(joint, return_counts=True)
        return joint // len(self.words), joint % len(self.words), n

    def suffixes(self) -> list[np.ndarray]:
        """Columns of (language, word, word, word or 0) for each word with a word after it."""
        goes_on = np.append(self.piece[1:] == self.piece[:-1], [False, False])
        ids = np.append(self.flat, np.int32(0))
        at = np.flatnonzero(goes_on)
        return [self.lang[at], ids[at], ids[at + 1], np.where(goes_on[at + 1], ids[at + 2], np.int32(0))]


def _pivots(key: np.ndarray, starts: np.ndarray, sizes: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """For each segment the place of a median of drawn rows: three, or more if there are few segments."""
    n = 3 if len(starts) * 64 > len(key) else 15
    at = starts[:, None] + (draw.random((len(starts), n), np.float32) * sizes[:, None]).astype(np.int64)
    np.minimum(at, (starts + sizes - 1)[:, None], out=at)
    if n > 3:
        middle = np.argsort(key[at], axis=1)[:, n // 2]
        return at[np.arange(len(starts)), middle]
    first, second, third = at.T
    a, b, c = key[first], key[second], key[third]
    return np.where((a < b) == (b < c), second, np.where((b < a) == (a < c), first, third))


def three_way_sorted(
    columns: list[np.ndarray], weights: np.ndarray | None, least: list[int]
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of rows; for each depth the equal partitions found, as (a row of
    the partition, its weight).

    A partition below ``least[depth]``, at least 1, is abandoned. Without ``weights`` rows weigh 1,
    nothing is abandoned, and a partition of one row goes straight to the last depth. Pivots are
    medians of drawn rows, so sorted input is no worst case.

    A step takes all open segments. Pointers move with their keys (and weights), and the lesser
    parts of all segments are put before their greater parts, so everything is read in a line.
    """
    deepest = len(columns) - 1
    n = len(columns[0])
    found: list[list[tuple]] = [[] for _ in columns]
    draw = np.random.default_rng(n)
    lowest = np.array(least)
    rows = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)
    key, load = columns[0], weights
    sizes, depths = np.array([n])[: min(n, 1)], np.array([0])[: min(n, 1)]
    while len(sizes):
        starts = np.cumsum(sizes) - sizes
        pivots = _pivots(key, starts, sizes, draw)
        against = np.repeat(key[pivots], sizes)
        still = []
        for part, side in enumerate((np.less, np.equal, np.greater)):
            taken = side(key, against)
            size = np.add.reduceat(taken, starts, dtype=np.int64)
            weight = size if weights is None else np.add.reduceat(load * taken, starts, dtype=np.int64)
            kept = weight >= lowest[depths]
            depth = depths
            if part == 1:
                for d in np.unique(depths[kept]):
                    hit = kept & (depths == d)
                    if weights is None and d < deepest:
                        hit &= size > 1
                    found[d].append((rows[pivots[hit]], weight[hit]))
                kept &= depths < deepest
                depth = depths + 1
            if weights is None:
                single = kept & (size == 1)
                at = pivots[single] if part == 1 else np.flatnonzero(taken & np.repeat(single, sizes))
                found[deepest].append((rows[at], size[single]))
                kept &= ~single
            at = np.flatnonzero(taken & np.repeat(kept, sizes))
            size, depth, row = size[kept], depth[kept], rows[at]
            if part == 1:
                level = np.repeat(depth, size)
                moved = np.empty(len(at), key.dtype)
                for d in np.unique(depth):
                    of = np.flatnonzero(level == d)
                    moved[of] = columns[d][row[of]]
            else:
                moved = key[at]
            still.append((size, depth, row, moved, *([] if weights is None else [load[at]])))
        sizes, depths, rows, key, *loads = (np.concatenate(x) for x in zip(*still, strict=True))
        load = loads[0] if loads else None
    nothing = np.empty(0, np.int64)
    return [
        tuple(np.concatenate(x) for x in zip(*level, strict=True)) if level else (nothing, nothing)
        for level in found
    ]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for langs, texts in _sections(batches):
        words = _Words(langs, texts)
        lang, word, n = words.counts()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(words.names, pa.string()).take(pa.array(lang)),
                words.words.take(pa.array(word)).cast(pa.string()),
                pa.array(n),
            ],
            ["lang", "word", "f"],
        )


def _narrow(numbers: np.ndarray) -> bytes:
    return numbers.astype(np.min_scalar_type(int(numbers.max()))).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}")


def _route(words: _Words, columns: list[np.ndarray], groups: int, hot: set) -> np.ndarray:
    """The group of each suffix, by language and the two leading words. Suffixes of two hot words
    are dealt out further by the word behind; their groups lie above ``groups``."""
    texts = [b"", *words.words.to_pylist()]
    word = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
    lang = np.fromiter(map(xxhash.xxh64_intdigest, words.names), np.uint64, len(words.names))
    to = mixed(mixed(mixed(lang[columns[0]]) + word[columns[1]]) + word[columns[2]])
    group = (to % np.uint64(groups)).astype(np.int64)
    if hot:
        number = {name: i for i, name in enumerate(words.names)}
        ids = {name: i for i, name in enumerate(texts)}
        is_hot = np.zeros((len(words.names), len(texts)), bool)
        for name, text in hot:
            if name in number and text in ids:
                is_hot[number[name], ids[text]] = True
        at = np.flatnonzero(is_hot[columns[0], columns[1]])
        at = at[is_hot[columns[0][at], columns[2][at]]]
        spread = mixed(to[at] + word[columns[3][at]] % np.uint64(_SALTS)) % np.uint64(groups)
        group[at] = groups + spread.astype(np.int64)
    return group


def _routed(groups: int, hot: set):
    """Groups of equal suffixes of some megabytes of text, as one row for each group of the route:
    its words, each with a line feed, and columns of numbers of languages, words (from 1 within the
    row; 0 is none) and occurrences."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _sections(batches):
            words = _Words(langs, texts)
            columns = words.suffixes()
            row, size = three_way_sorted(columns, None, [1] * len(columns))[-1]
            if not len(row):
                continue
            columns = [c[row] for c in columns]
            group = _route(words, columns, groups, hot)
            by = np.argsort(group.astype(np.min_scalar_type(2 * groups)), kind="stable")
            group, size, lang, *columns = (c[by] for c in (group, size, *columns))
            edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
            number = np.zeros(len(words.words) + 1, np.int32)
            used, out = [], []
            for a, b in zip(edges, edges[1:], strict=False):
                # The last place of a word in the row stands for it.
                ids = np.concatenate([c[a:b] for c in columns])
                number[ids] = np.arange(len(ids), dtype=np.int32)
                own = ids[number[ids] == np.arange(len(ids), dtype=np.int32)]
                own = own[own > 0]
                number[own] = np.arange(1, len(own) + 1, dtype=np.int32)
                number[0] = 0
                used.append(own)
                lang_ids, lang_code = np.unique(lang[a:b], return_inverse=True)
                out.append(
                    {
                        "group": int(group[a]),
                        "langs": [words.names[i] for i in lang_ids],
                        "rows": b - a,
                        "columns": [_narrow(x) for x in (lang_code, *number[ids].reshape(3, -1), size[a:b])],
                    }
                )
            lines = pc.binary_join_element_wise(words.words, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
            lines = lines.take(pa.array(np.concatenate(used) - 1))
            _, offsets, letters = lines.buffers()
            offsets = np.frombuffer(offsets, np.int64)[np.cumsum([0, *map(len, used)])]
            lines = pa.Array.from_buffers(pa.large_binary(), len(out), [None, pa.py_buffer(offsets), letters])
            rest = pa.Table.from_pylist(out, _ROUTED)
            yield rest.set_column(2, "words", lines.cast(pa.binary())).combine_chunks().to_batches()[0]

    return each


_ROUTED = pa.schema(
    [
        ("group", pa.int64()),
        ("langs", pa.list_(pa.string())),
        ("words", pa.binary()),
        ("rows", pa.int64()),
        ("columns", pa.list_(pa.binary())),
    ]
)


def _counted(groups: int, least: int):
    """The phrases of a routed group. In a group of hot pairs only a part of a pair's suffixes is
    there, so nothing is abandoned before the third word."""

    def each(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = defaultdict()
        names.default_factory = names.__len__
        texts, parts = [], []
        for batch in batches:
            for row in batch.to_pylist():
                lang = np.array([names[x] for x in row["langs"]], np.int32)
                lang_code, *codes, size = (_wide(x, row["rows"]) for x in row["columns"])
                texts.append(row["words"])
                parts.append([lang[lang_code], *codes, size])
        _, numbers, words = _numbered(np.frombuffer(b"".join(texts), np.uint8))
        numbers = numbers + np.int32(1)
        at = 0
        for text, part in zip(texts, parts, strict=True):
            end = at + text.count(b"\n")
            number = np.concatenate([np.zeros(1, np.int32), numbers[at:end]])
            part[1:4] = [number[c] for c in part[1:4]]
            at = end
        *columns, weights = (np.concatenate(x) for x in zip(*parts, strict=True))
        early = least if key[0].as_py() < groups else 1
        levels = three_way_sorted(columns, weights, [early, early, early, least])
        lang_names = pa.array(list(names), pa.string())
        for depth in (2, 3):
            row, size = levels[depth]
            if depth == 3:
                inside = columns[3][row] != 0
                row, size = row[inside], size[inside]
            named = [words.take(pa.array(c[row] - 1)).cast(pa.string()) for c in columns[1 : depth + 1]]
            if depth == 2:
                named.append(pa.nulls(len(row), pa.string()))
            yield pa.RecordBatch.from_arrays(
                [
                    lang_names.take(pa.array(columns[0][row])),
                    *named,
                    pa.array(size.astype(np.int64)),
                ],
                ["lang", "w1", "w2", "w3", "a"],
            )

    return each


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, word, f`` of all words, and ``lang, w1, w2, w3, a`` of the phrases of two (``w3`` is
    NULL) or three words with ``a >= least`` occurrences. Both are written tables."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    words = texts.mapInArrow(_word_counts, "lang string, word string, f bigint")
    words = written(words.groupBy("lang", "word").agg(F.sum("f").alias("f")), "words")
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    hot = words.where(F.col("f") * _HOT_SHARE > total).select("lang", "word").collect()
    hot = {(r["lang"], r["word"].encode()) for r in hot}
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // _GROUP_SUFFIXES)
    routed = texts.mapInArrow(
        _routed(groups, hot),
        "group bigint, langs array<string>, words binary, rows bigint, columns array<binary>",
    )
    found = routed.groupBy("group").applyInArrow(
        _counted(groups, least), "lang string, w1 string, w2 string, w3 string, a bigint"
    )
    found = found.groupBy("lang", "w1", "w2", "w3").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return words, written(found, "phrases")


def _score(a, left, right):
    """floor(1000000 * a * a / (left * right)), at most 1000000; products in 38 digits."""
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in (a, left, right))
    above = (F.lit(1_000_000).cast("decimal(7,0)") * (a * a)).cast("decimal(38,0)")
    return F.call_function("div", above, (left * right).cast("decimal(38,0)"))


def _first(scored: DataFrame, top: int, *by) -> DataFrame:
    """The ``top`` best phrases of each group, with their ``rank`` in it."""
    best = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: for each language the ``top`` phrases by score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and those into words at
    spaces and tabs. ``a``, ``l``, ``r`` are occurrences of the phrase and of its parts at the cut
    with the lowest score, ``n`` is the number of words of the language. A phrase of two words is
    left out if one of three words contains it and has half of its occurrences. NULL languages are
    ``und``, NULL texts have no words. Each row counts, repeated ones too; ids and other columns are
    ignored, no rows give no phrases. Counts are exact below 10 ** 15.
    """
    words, phrases = phrase_counts(docs, least)
    pairs = phrases.where(F.col("w3").isNull()).drop("w3")
    triples = phrases.where(F.col("w3").isNotNull())
    often = words.where(F.col("f") >= least)

    def occurrences(word: str, name: str) -> DataFrame:
        return often.select("lang", F.col("word").alias(word), F.col("f").alias(name))

    def both(first: str, second: str, name: str) -> DataFrame:
        return pairs.toDF("lang", first, second, name)

    longer = triples.select("lang", "w1", "w2", "a").union(triples.select("lang", "w2", "w3", "a"))
    longer = longer.groupBy("lang", "w1", "w2").agg(F.max("a").alias("_longer"))
    two = pairs.join(longer, ["lang", "w1", "w2"], "left").where(
        F.coalesce(F.col("_longer") * 100 < F.col("a") * COVERED_PERCENT, F.lit(True))
    )
    two = two.join(occurrences("w1", "l"), ["lang", "w1"]).join(occurrences("w2", "r"), ["lang", "w2"])
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    three = (
        triples.join(both("w1", "w2", "_l2"), ["lang", "w1", "w2"])
        .join(both("w2", "w3", "_r1"), ["lang", "w2", "w3"])
        .join(occurrences("w1", "_l1"), ["lang", "w1"])
        .join(occurrences("w3", "_r2"), ["lang", "w3"])
        .withColumns({"_s1": _score("a", "_l1", "_r1"), "_s2": _score("a", "_l2", "_r2")})
    )

    def at_cut(first: str, second: str):
        return F.when(F.col("_s1") <= F.col("_s2"), F.col(first)).otherwise(F.col(second))

    three = three.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        at_cut("_l1", "_l2").alias("l"),
        at_cut("_r1", "_r2").alias("r"),
        F.least("_s1", "_s2").alias("score"),
    )
    ranked = _first(_first(two.union(three), top, "lang", F.pmod(F.hash("phrase"), F.lit(_SLICES))), top, "lang")
    ranked = ranked.withColumn("rank", F.col("rank").cast("bigint"))
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
