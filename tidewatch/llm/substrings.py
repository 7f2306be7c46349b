"""Removal of repeated passages with suffix automata over shards of the repeated text.

Each window of ``SPAN`` consecutive words has one anchor, the smallest hash among the shorter
grams inside it, so equal windows have equal anchors at equal places. Consecutive windows of a
document that share an anchor position form a piece. All occurrences of a window lie in pieces
with the same anchor, and pieces whose anchor occurs once cannot repeat anything. A piece whose
words occur earlier as a piece repeats all its windows; so only first occurrences are left, and
of these only the ones whose anchor has others beside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.words import signed, windows_of, word_hashes, words_of
from tidewatch.scratch import fresh_dir, remove, shuffles_removed, written

SPAN = 20
_GRAM = 8

_PLACE_SCHEMA = "part bigint, name bigint, doc_id bigint, start bigint, windows bigint"
_PLACE = ["part", "name", "doc_id", "start", "windows"]
_PASSAGE = [*_PLACE, "words"]
_LISTED = ["start", "windows", "name", "part"]
_REMOVED_SCHEMA = "doc_id bigint, start bigint, windows bigint, name bigint, mask bigint"
_COPY, _FIRST, _HOT = 0, 1, 2
_ROWS = 1 << 16


def _name(part: bytes) -> int:
    return xxhash.xxh3_64_intdigest(part) - (1 << 63)


class SuffixAutomaton:
    """All substrings of the sequences added, each state with its earliest occurrence.

    ``first`` of a state is (number of the sequence, end in it) of the occurrence added first.
    """

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [(0, 0)]

    def _state(self, length: int, link: int, following: dict, first: tuple[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, at: int, word, old: int) -> int:
        """A copy of ``old`` for the substrings that end with the one of ``at`` and ``word``."""
        length = self.length[at] + 1
        copy = self._state(length, self.link[old], dict(self.next[old]), self.first[old])
        self.link[old] = copy
        while at >= 0 and self.next[at].get(word) == old:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def add(self, sequence: list, number: int) -> None:
        last = 0
        for end, word in enumerate(sequence):
            seen = self.next[last].get(word)
            if seen is not None:
                exact = self.length[seen] == self.length[last] + 1
                last = seen if exact else self._split(last, word, seen)
                continue
            new = self._state(self.length[last] + 1, 0, {}, (number, end))
            at = last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                old = self.next[at][word]
                exact = self.length[old] == self.length[at] + 1
                self.link[new] = old if exact else self._split(at, word, old)
            last = new

    def earliest(self, sequence: list, span: int) -> Iterator[tuple[int, tuple[int, int]]]:
        """Matching statistics of ``sequence``: for each end at which the longest match has
        ``span`` words or more, the end and the first occurrence of its last ``span`` words."""
        state = matched = 0
        for end, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            while state and self.length[self.link[state]] >= span:
                state = self.link[state]
                matched = self.length[state]
            if matched >= span:
                yield end, self.first[state]


def _leftmost_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Where the smallest of each ``size`` consecutive values stands, from those of windows of 1, 2,
    4, ... values."""
    at, width = np.arange(len(values)), 1
    while width < size:
        step = min(width, size - width)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        width += step
    return at


def pieces_of(ids: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of each piece of a document."""
    if len(ids) < span:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none
    grams = windows_of(ids, gram)
    at = _leftmost_minima(grams, span - gram + 1)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return grams[at[starts]], starts, np.diff(np.r_[starts, len(at)])


def _spelt(text: str) -> tuple[bytes, np.ndarray]:
    """The words of a text joined by one space, and where each and the one after the last start."""
    joined = b" ".join(words_of(text))
    if not joined:
        return joined, np.zeros(1, np.int64)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return joined, np.concatenate([[0], spaces + 1, [len(joined) + 1]])


def _runs(rows: np.ndarray) -> np.ndarray:
    """Where each run of equal columns starts."""
    if not rows.shape[1]:
        return np.empty(0, np.int64)
    return np.flatnonzero(np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0)))


def _later(rows: np.ndarray) -> np.ndarray:
    """Of places sorted by part, name, doc_id and start, those after the first start of their passage."""
    runs = _runs(rows[:2])
    first = rows[2:4, runs].repeat(np.diff(np.append(runs, rows.shape[1])), axis=1)
    return (rows[2:4] != first).any(axis=0)


def _known(rows: np.ndarray) -> np.ndarray:
    """The same places; those after another place of their passage here are copies whatever the rest
    of the table holds. They get negative ``windows`` and no part, so that the places of a frequent
    passage don't all go to one task."""
    order = np.lexsort(rows[3::-1])
    again = order[_later(rows[:, order])]
    rows[4, again] *= -1
    rows[0, again] = 0
    return rows


def _pieces(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """The pieces of all documents, without their words; ``part`` is the anchor and ``name`` a hash
    of the words. Copies that a task has seen are marked, see ``_known``."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found, starts, windows = pieces_of(word_hashes(text), span, gram)
                if not len(found):
                    continue
                joined, at = _spelt(text)
                ends = at[starts + windows + span - 1] - 1
                own = [_name(joined[a:b]) for a, b in zip(at[starts].tolist(), ends.tolist())]
                name, doc_id = np.array(own, np.int64), np.full(len(own), doc_id)
                parts.append(np.stack([signed(found), name, doc_id, starts, windows]))
            if parts:
                yield pd.DataFrame(dict(zip(_PLACE, _known(np.hstack(parts)))))

    return docs.mapInPandas(each, _PLACE_SCHEMA)


def _judged(places: DataFrame, hot_passages: int, chunk: int = _ROWS) -> DataFrame:
    """The places whose part occurs again, with what they are as ``kind``: a copy of a passage that
    starts earlier, or the first occurrence of a passage among at most ``hot_passages`` of its part
    (``_FIRST``) or more (``_HOT``). The only passage of its part is left out where it is first.

    Rows arrive sorted and are judged in chunks of about ``chunk``, however many of them belong to one part.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= chunk:
                yield np.stack([c.to_numpy() for c in pa.Table.from_batches(held).columns])
                held, size = [], 0
        if size:
            yield np.stack([c.to_numpy() for c in pa.Table.from_batches(held).columns])

    def told(rows: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (*rows, kind.astype(np.int32))], names=[*_PLACE, "kind"]
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = waiting = np.empty((len(_PLACE), 0), np.int64)  # passage and firsts of an open part
        hot = None  # the open part, if it is known to have too many passages

        def settled(firsts: np.ndarray) -> pa.RecordBatch:
            runs = _runs(firsts[:1])
            sizes = np.diff(np.append(runs, firsts.shape[1]))
            many = sizes > hot_passages
            if hot is not None and len(runs):
                many[0] |= firsts[0, 0] == hot
            kind = np.where(many, _HOT, np.where(sizes > 1, _FIRST, _COPY)).repeat(sizes)
            return told(firsts[:, kind != _COPY], kind[kind != _COPY])

        for rows in chunks(batches):
            known = rows[4] < 0
            rows[4] = np.abs(rows[4])
            yield told(rows[:, known], np.full(known.sum(), _COPY))
            if known.all():
                continue
            rows = np.hstack([current, rows[:, ~known]])
            runs, again = _runs(rows[:2]), _later(rows)
            yield told(rows[:, again], np.full(again.sum(), _COPY))
            waiting = np.hstack([waiting, rows[:, runs[current.shape[1] :]]])
            current = rows[:, runs[-1:]]
            still = waiting.shape[1] and waiting[0] == current[0, 0]
            if not np.any(still):
                yield settled(waiting)
                waiting = waiting[:, :0]
                continue
            yield settled(waiting[:, ~still])
            waiting = waiting[:, still]
            if waiting.shape[1] > hot_passages or hot == current[0, 0]:
                hot = current[0, 0]
                yield settled(waiting)
                waiting = waiting[:, :0]
        yield settled(waiting)

    spread = F.when(F.col("windows") < 0, F.xxhash64("doc_id", "start")).otherwise(F.col("part"))
    by_part = places.repartition(spread).sortWithinPartitions("part", "name", "doc_id", "start")
    return by_part.mapInArrow(each, f"{_PLACE_SCHEMA}, kind int")


def _of_kind(kind: int) -> Column:
    return F.filter("places", lambda place: place["kind"] == kind)


def _held(text: str, places: list[tuple], span: int) -> Iterator[tuple[tuple, bytes]]:
    """Those of ``places`` (start, windows, name, ...) that are in the text, with their words.
    Another text under the same doc_id may be meant."""
    joined, at = _spelt(text)
    at = at.tolist()
    for place in places:
        start, end = place[0], place[0] + place[1] + span - 1
        if end < len(at):
            part = joined[at[start] : at[end] - 1]
            if _name(part) == place[2]:
                yield place, part


def _listed(marked: DataFrame, kind: int) -> DataFrame:
    """The documents with places of a kind, and these as one list for each field."""
    chosen = marked.select("doc_id", "text", _of_kind(kind).alias("places")).where(F.size("places") > 0)
    return chosen.select("doc_id", "text", *[F.col(f"places.{c}").alias(c) for c in _LISTED])


def _zipped(lists: list[np.ndarray]) -> list[tuple]:
    return list(zip(*[values.tolist() for values in lists]))


def _passages(marked: DataFrame, span: int) -> DataFrame:
    """The first occurrences that have to be compared, with their words."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, *places in zip(*[batch[c] for c in ("doc_id", "text", *_LISTED)]):
                for (start, windows, name, part), words in _held(text, _zipped(places), span):
                    rows.append((part, name, doc_id, start, windows, words))
            yield pd.DataFrame(rows, columns=_PASSAGE)

    return _listed(marked, _FIRST).mapInPandas(each, f"{_PLACE_SCHEMA}, words binary")


def _windows(marked: DataFrame, span: int) -> DataFrame:
    """Each window of the first occurrences of hot parts as a place of its own; ``part`` and
    ``name`` are two hashes of its words."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, *places in zip(*[batch[c] for c in ("doc_id", "text", *_LISTED)]):
                for (start, windows, _, _), words in _held(text, _zipped(places), span):
                    words = words.split(b" ")
                    for i in range(windows):
                        part = b" ".join(words[i : i + span])
                        other = xxhash.xxh3_64_intdigest(part, seed=1) - (1 << 63)
                        rows.append((other, _name(part), doc_id, start + i, 1))
            if rows:
                yield pd.DataFrame(dict(zip(_PLACE, _known(np.array(rows, np.int64).T.copy()))))

    return _listed(marked, _HOT).mapInPandas(each, _PLACE_SCHEMA)


def _earlier(passages: DataFrame, span: int, shard_words: int) -> DataFrame:
    """For each first occurrence of a passage that has some, as bits of ``mask``, which of its
    windows occur earlier.

    Rows arrive by shard, sorted by anchor and place. A task gathers whole anchors to
    ``shard_words`` words, builds their automaton and streams them through it. An occurrence added
    first names its window. The words that belong to one anchor are bounded before, see
    ``repeated_words``.
    """

    def of_shard(rows: list[tuple]) -> pd.DataFrame:
        automaton, sequences = SuffixAutomaton(), [r[5].split(b" ") for r in rows]
        for number, sequence in enumerate(sequences):
            automaton.add(sequence, number)
        found, earliest = [], {}
        for (_, _, doc_id, start, _, _), sequence in zip(rows, sequences):
            found.append(list(automaton.earliest(sequence, span)))
            for end, window in found[-1]:
                place = (doc_id, start + end)
                earliest[window] = min(earliest.get(window, place), place)
        out = []
        for (_, name, doc_id, start, windows, _), own in zip(rows, found):
            mask = 0
            for end, window in own:
                if earliest[window] < (doc_id, start + end):
                    mask |= 1 << (end - span + 1)
            if mask:
                out.append((doc_id, start, windows, name, mask))
        return pd.DataFrame(out, columns=["doc_id", "start", "windows", "name", "mask"])

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*[batch[c] for c in _PASSAGE]):
                if size >= shard_words and row[0] != rows[-1][0]:
                    yield of_shard(rows)
                    rows, size = [], 0
                rows.append(row)
                size += row[4] + span - 1
        if rows:
            yield of_shard(rows)

    by_shard = passages.repartition("part").sortWithinPartitions("part", "doc_id", "start")
    return by_shard.mapInPandas(each, _REMOVED_SCHEMA)


def repeated_words(
    docs: DataFrame,
    span: int = SPAN,
    gram: int = _GRAM,
    shard_words: int = 60_000,
    hot_passages: int = 2_000,
) -> DataFrame:
    """``doc_id, copy, n_removed, kept_text`` of the documents of ``docs`` (doc_id, text) that lose
    words; ``copy`` is ``xxhash64(text)``.

    A word is removed if a window of ``span`` consecutive words covers it whose words also start
    earlier: in a document with a smaller doc_id, or earlier in the same one. Windows are judged
    on the input. The words that stay are joined by one space.

    Hashes and places of all pieces are shuffled once, by anchor. That settles pieces whose anchor
    occurs once, copies of pieces, and pieces that are the only ones of their anchor but for
    copies. Words are shuffled for the other first occurrences only, which go by anchor to
    shards. Each shard has a suffix automaton of its passages in order of first occurrence;
    its passages are streamed through it for matching statistics, and the state of the last
    ``span`` words knows where they start first. Sending every shard's automaton to every document
    would cost shards times corpus; equal windows have equal anchors, so the routing loses nothing.
    An anchor with more than ``hot_passages`` distinct passages is cut into windows, which spread
    by their own words.

    NULL and empty texts have no words and lose none. Rows without doc_id keep all their words
    and are no source. Repeated rows are the same document. Different texts under one doc_id are
    judged each by itself; an equal start under an equal doc_id is not earlier.
    """
    key = ["doc_id", "copy"]
    docs = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("copy"), "text")
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    # Where only first occurrences go on by their anchor, the rest need not carry it.
    part = F.when(F.col("kind") == _FIRST, F.col("part")).otherwise(0).alias("part")
    places = _judged(_pieces(docs, span, gram), hot_passages)
    lists = places.groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "windows", "name", part, "kind")).alias("places")
    )
    spark = docs.sparkSession
    path = fresh_dir(spark, "places")
    with shuffles_removed(spark):
        lists = written(lists, "places", path)
        marked = written(docs.join(lists, "doc_id").dropDuplicates(key), "marked")
        remove(spark, path)

    whole = F.expr("shiftleft(1L, CAST(windows AS INT)) - 1L").alias("mask")
    removed = ["start", "windows", "name", "mask"]
    again = _judged(_windows(marked, span), hot_passages).where(F.col("kind") == _COPY)
    masks = _earlier(_passages(marked, span), span, shard_words).unionByName(
        again.select("doc_id", "start", "windows", "name", whole)
    )
    with shuffles_removed(spark):
        masks = written(masks, "masks")
    masks = masks.groupBy("doc_id").agg(F.collect_list(F.struct(*removed)).alias("masks"))
    copies = F.transform(
        _of_kind(_COPY),
        lambda p: F.struct(
            p["start"].alias("start"),
            p["windows"].alias("windows"),
            p["name"].alias("name"),
            (F.call_function("shiftleft", F.lit(1).cast("bigint"), p["windows"].cast("int")) - 1).alias("mask"),
        ),
    )
    both = marked.select(*key, "text", copies.alias("copies")).join(masks, "doc_id", "left")
    both = both.select(*key, "text", F.concat("copies", F.coalesce("masks", F.array())).alias("removed"))
    both = both.where(F.size("removed") > 0)
    both = both.select(*key, "text", *[F.col(f"removed.{c}").alias(c) for c in removed])

    def drop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, copy, text, *places in zip(*[batch[c] for c in (*key, "text", *removed)]):
                words = words_of(text)
                change = np.zeros(len(words) + 1, np.int64)
                for (start, windows, _, mask), _ in _held(text, _zipped(places), span):
                    if mask == (1 << windows) - 1:
                        change[start] += 1
                        change[start + windows + span - 1] -= 1
                        continue
                    for i in range(mask.bit_length()):
                        if mask >> i & 1:
                            change[start + i] += 1
                            change[start + i + span] -= 1
                stay = np.cumsum(change)[:-1] == 0
                if not stay.all():
                    left = b" ".join(word for word, kept in zip(words, stay) if kept)
                    rows.append((doc_id, copy, int((~stay).sum()), left.decode()))
            yield pd.DataFrame(rows, columns=[*key, "n_removed", "kept_text"])

    schema = "doc_id bigint, copy bigint, n_removed bigint, kept_text string"
    return both.mapInPandas(drop, schema)
