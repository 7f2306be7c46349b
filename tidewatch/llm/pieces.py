"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the longest prefix that the model's compiled character map knows, and
the origin of every normalised character is recorded. Pieces of the normalised text are so many
characters each, so the record projects them to byte spans of the original text.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb

SPACE = "▁"
# Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BPE = 2

# Bytes of text that are encoded together, words and bytes of words that a worker remembers.
_BATCH_BYTES = 4_000_000
_REMEMBERED = 300_000
_LONGEST_REMEMBERED = 64
_NEVER = float("inf")

codecs.register_error("tidewatch-bytes", lambda e: ("�" * (e.end - e.start), e.end))


class CharacterMap:
    """The compiled character map of a model: a double-array trie of UTF-8 prefixes, and the texts
    that replace them. Fixed format: its size in 4 bytes, units of 32 bits, texts ending with 0."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self._units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self._texts = compiled[4 + size :]
        # Texts go on unchanged up to a byte with which some prefix begins.
        first = [c for c in range(256) if self._units and self._step(self._children(0), c)]
        self._begins = re.compile(b"[" + b"".join(re.escape(bytes([c])) for c in first) + b"]") if first else None

    def __bool__(self) -> bool:
        return self._begins is not None

    def _children(self, at: int) -> int:
        unit = self._units[at]
        return at ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _step(self, base: int, byte: int) -> int | None:
        at = base ^ byte
        if at < len(self._units) and self._units[at] & 0x800000FF == byte:
            return at
        return None

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes of the longest known prefix at ``at`` and what replaces them."""
        best, base = None, self._children(0)
        for end in range(at, len(raw)):
            node = self._step(base, raw[end])
            if node is None:
                break
            base = self._children(node)
            if self._units[node] >> 8 & 1:
                best = end + 1 - at, self._units[base] & 0x7FFFFFFF
        if best is None:
            return None
        text = self._texts[best[1] : self._texts.index(b"\0", best[1])]
        return best[0], text

    def replaced(self, raw: bytes) -> Iterator[tuple[bytes, int, int, bool]]:
        """Runs that go on unchanged and replaced prefixes, as (text, start, end in the original, whether
        unchanged)."""
        at = kept = 0
        while at < len(raw):
            hit = self._begins.search(raw, at)
            if not hit:
                break
            at = hit.start()
            found = self.longest(raw, at)
            if not found:
                at += 1
                while at < len(raw) and raw[at] & 0xC0 == 0x80:
                    at += 1
                continue
            if kept < at:
                yield raw[kept:at], kept, at, True
            yield found[1], at, at + found[0], False
            at += found[0]
            kept = at
        if kept < len(raw):
            yield raw[kept:], kept, len(raw), True


def _character_starts(raw: bytes) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)


def _cut(pieces: dict[str, int]) -> re.Pattern:
    """Cuts normalised text at places that no piece spans, so no merge crosses them: before spaces,
    between letters and marks that follow letters in no piece, around characters of no longer piece."""
    if any(SPACE in p.lstrip(SPACE) for p in pieces) or SPACE not in pieces:
        return re.compile(r"(?s).+")
    joined = {pair for p in pieces for pair in itertools.pairwise(p)}
    inside = {c for pair in joined for c in pair} - {SPACE}
    letters = {c for c in inside if c.isalpha()}
    marks = {c for p in pieces for c in p} - letters - {SPACE} - {b for a, b in joined if a in letters}

    def one_of(characters: set[str]) -> str:
        return "[" + "".join(map(re.escape, sorted(characters))) + "]"

    forms = [f"{SPACE}+"]
    if inside:
        forms = [f"{SPACE}*{one_of(inside)}++", *forms, f"[^{one_of(inside | {SPACE})[1:]}+"]
    if letters and marks:
        forms.insert(0, f"{SPACE}*{one_of(letters)}++(?={one_of(marks)})")
    return re.compile("|".join(forms))


class PieceModel:
    """A model file of kind BPE. Models with user-defined pieces are refused."""

    def __init__(self, path: str):
        proto = model_pb.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != _BPE or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("a BPE model without user-defined or unused pieces is needed")
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy_prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        if proto.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("white space as suffix or not escaped is not supported")
        pieces = proto.pieces
        self.ids = {p.piece: i for i, p in enumerate(pieces) if p.type == _NORMAL}
        self.order = {p.piece: -p.score for p in pieces if p.type == _NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(pieces) if p.type == _BYTE}
        self.unknown = next(i for i, p in enumerate(pieces) if p.type == _UNKNOWN)
        self.begin = next(i for i, p in enumerate(pieces) if p.piece == "<s>")
        self.end = next(i for i, p in enumerate(pieces) if p.piece == "</s>")
        self.is_control = np.array([p.type == _CONTROL for p in pieces])
        self.byte_of = np.full(len(pieces), -1)
        for value, i in self.bytes.items():
            self.byte_of[i] = value
        shown = {_UNKNOWN: proto.trainer_spec.unk_surface, _CONTROL: "", _BYTE: ""}
        self.shown = [shown.get(p.type, p.piece.replace(SPACE, " ")) for p in pieces]
        self._cut = _cut(self.ids)
        # Words of late; when there are enough, those of before are forgotten.
        self._known: dict[str, tuple[bytes, bytes]] = {}
        self._before: dict[str, tuple[bytes, bytes]] = {}

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters and its end the byte where its
        origin starts."""
        raw = text.encode()
        if not self.map and not self.squeeze:
            starts = np.append(_character_starts(raw), len(raw))
            if raw and self.dummy_prefix:
                return SPACE + text.replace(" ", SPACE), np.append(0, starts)
            return text.replace(" ", SPACE), starts
        parts, origins, lead = [], [], 0
        for new, start, end, same in self.map.replaced(raw) if self.map else [(raw, 0, len(raw), True)]:
            at = _character_starts(new)
            parts.append(new.decode())
            origins.append(at + start if same else np.full(len(at), start))
            if lead == start and not parts[-1].strip(" ") and new:
                lead = end
            elif lead == start and same:
                lead += len(new) - len(new.lstrip(b" "))
        normal = "".join(parts)
        origin = np.append(np.concatenate([np.empty(0, np.int64), *origins]), len(raw))
        if not self.squeeze:
            lead = 0
        elif lead == len(raw):
            return "", origin[-1:]
        else:
            # A space is kept behind a character that is none.
            spaces = np.array([c == " " for c in normal], bool)
            kept = ~spaces | np.append(False, ~spaces)[: len(spaces)]
            normal = "".join(c for c, keep in zip(normal, kept, strict=True) if keep)
            origin = origin[np.append(kept, True)]
        if raw and self.dummy_prefix:
            normal, origin = " " + normal, np.append(lead, origin)
        normal = normal.replace(" ", SPACE)
        if self.squeeze:
            normal = normal.rstrip(SPACE)
            origin = origin[: len(normal) + 1]
        return normal, origin

    def _merged(self, word: str) -> list[str]:
        """Pieces of a word: of all neighbours whose union is a piece, the best one, then the
        leftmost, is united until there is none."""
        if len(word) > _LONGEST_REMEMBERED:
            return self._merged_long(word)
        parts, order = list(word), self.order.get
        ranks = [order(a + b, _NEVER) for a, b in itertools.pairwise(parts)]
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            i = ranks.index(best)
            union = parts[i] + parts[i + 1]
            parts[i : i + 2] = [union]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = order(union + parts[i + 1], _NEVER)
            if i:
                ranks[i - 1] = order(parts[i - 1] + union, _NEVER)
        return parts

    def _merged_long(self, word: str) -> list[str]:
        """The same with a heap of pairs and links to neighbours, in n log n steps."""
        parts: list[str | None] = list(word)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        order = self.order
        pairs = [a + b for a, b in itertools.pairwise(word)]
        heap = [(order[union], i, union) for i, union in enumerate(pairs) if union in order]
        heapq.heapify(heap)
        while heap:
            _, i, union = heapq.heappop(heap)
            j = after[i]
            # A pair is out of date once one of its sides is part of another piece.
            if parts[i] is None or j >= n or parts[i] + parts[j] != union:
                continue
            parts[i], parts[j] = union, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    union = parts[left] + parts[right]
                    if union in order:
                        heapq.heappush(heap, (order[union], left, union))
        return [p for p in parts if p is not None]

    def _word(self, word: str) -> tuple[bytes, bytes]:
        """Ids of a word's pieces and the characters that each spans, as 32-bit numbers."""
        found = self._before.get(word)
        if found is None:
            pieces = self._merged(word)
            ids = list(map(self.ids.get, pieces))
            lengths = list(map(len, pieces))
            if None in ids:
                ids, lengths = self._without_unknown(pieces)
            form = f"<{len(ids)}I"
            found = struct.pack(form, *ids), struct.pack(form, *lengths)
        if len(word) <= _LONGEST_REMEMBERED:
            if len(self._known) >= _REMEMBERED:
                self._before = dict(self._known)
                self._known.clear()
            self._known[word] = found
        return found

    def _without_unknown(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        """Ids and lengths where some pieces are characters that the model does not have."""
        ids, lengths = [], []
        unknown = False
        for piece in pieces:
            i = self.ids.get(piece)
            if i is not None:
                ids.append(i)
                lengths.append(len(piece))
            elif self.bytes:
                # The last byte of a character spans it, those before are empty.
                own = piece.encode()
                ids.extend(self.bytes[b] for b in own)
                lengths.extend([0] * (len(own) - 1) + [1])
            elif unknown:
                lengths[-1] += 1
            else:
                ids.append(self.unknown)
                lengths.append(1)
            unknown = i is None
        return ids, lengths

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end, and the byte spans of their pieces in the text."""
        normal, origin = self.normalised(text)
        known, new = self._known, self._word
        parts = [known.get(w) or new(w) for w in self._cut.findall(normal)]
        ids = np.frombuffer(b"".join([p[0] for p in parts]), "<u4")
        ends = np.cumsum(np.frombuffer(b"".join([p[1] for p in parts]), "<u4"), dtype=np.int64)
        begins = np.append(0, ends[:-1])[: len(ends)]
        size = int(origin[-1])
        return (
            np.concatenate([[self.begin], ids, [self.end]]).astype("<u4"),
            np.concatenate([[0], origin[begins], [size]]).astype(np.int32),
            np.concatenate([[0], origin[ends], [size]]).astype(np.int32),
        )

    def decoded(self, ids: np.ndarray) -> str:
        """The text of the pieces; runs of bytes are UTF-8, each byte that is not becomes U+FFFD."""
        is_byte = self.byte_of[ids] >= 0
        shown = [self.shown[i] for i in ids.tolist()]
        if is_byte.any():
            edges = np.flatnonzero(np.diff(is_byte, prepend=False, append=False))
            for a, b in zip(edges[::2], edges[1::2], strict=True):
                run = bytes(self.byte_of[ids[a:b]].tolist())
                shown[a] = run.decode("utf-8", "tidewatch-bytes")
        if self.dummy_prefix or self.squeeze:
            # The space before the first piece goes; with ``squeeze`` also those of pieces that are nothing else.
            for i, number in enumerate(ids.tolist()):
                if self.is_control[number]:
                    continue
                if is_byte[i] or number == self.unknown:
                    break
                shown[i] = shown[i].removeprefix(" ")
                if shown[i] or not self.squeeze:
                    break
        return "".join(shown)


@functools.lru_cache(maxsize=2)
def _model(path: str) -> PieceModel:
    return PieceModel(path)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about ``_BATCH_BYTES`` of column ``text`` at a time."""
    sizes = np.array([len(x) if x else 0 for x in batch.column(text).to_pylist()])
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), _BATCH_BYTES, side="right")))
        yield batch.slice(at, n)
        at += n


_ENCODED = "ids binary, begins array<int>, ends array<int>"


def encode_pieces(docs: DataFrame, model: str, round_trip: bool = False) -> DataFrame:
    """``doc_id, ids, begins, ends`` for each row of ``docs`` (doc_id, text).

    ``ids`` are 32-bit little-endian numbers with the ids of begin and end; piece i covers bytes
    ``begins[i]`` to ``ends[i]`` (exclusive) of the UTF-8 text. Spans of a byte of an unknown character are
    empty but for its last byte. ``round_trip`` adds ``decoded``, the text of the ids, in the same pass.
    NULL and empty texts have begin and end only. Rows are independent, so repeated rows and missing
    ids give a row each; other columns are ignored. ``model`` is a path that all workers can read.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for whole in batches:
            for batch in _slices(whole, 1):
                found = [pieces.encoded(text or "") for text in batch.column(1).to_pylist()]
                columns = [
                    batch.column(0),
                    pa.array([ids.tobytes() for ids, _, _ in found], pa.binary()),
                    _lists([begins for _, begins, _ in found]),
                    _lists([ends for _, _, ends in found]),
                ]
                if round_trip:
                    columns.append(pa.array([pieces.decoded(ids) for ids, _, _ in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "ids", "begins", "ends"] + ["decoded"] * round_trip
    schema = f"doc_id bigint, {_ENCODED}" + ", decoded string" * round_trip
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(each, schema)


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, decoded`` for each row of ``encoded`` (doc_id, ids). NULL ids give an empty text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for whole in batches:
            for batch in _slices(whole, 1):
                texts = [pieces.decoded(np.frombuffer(ids or b"", "<u4")) for ids in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(each, "doc_id bigint, decoded string")
