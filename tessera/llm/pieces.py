"""SentencePiece encoding and decoding over a relational lattice.

A text is escaped (a space becomes the piece mark, one mark is put in front) and
cut before each mark that follows another character; no piece crosses such a
cut.  The distinct segments of a batch become a table of their substrings up to
the longest piece, which is equi-joined to the piece table by a 64-bit hash; the
matches are a segment's edges.  For a unigram model a fold over the end positions
keeps the best score and the last edge (Viterbi, highest sum of piece scores; of
equal sums the edge that starts first).  A model of kind BPE has merge ranks for
scores, and their best sum is not its encoding; there the fold takes the same
edges in merge order.  A character that no piece holds costs the least score less
ten and is written as its UTF-8 bytes' pieces.  The tables are numpy
columns inside a task: joining every word of the corpus back to its documents
through a shuffle moves several times the input (see README).

Segments found are kept in a bounded cache, emptied when full.  The vocabulary
is read on the driver from a path that the caller gives, and is bounded by it.

Edge cases: null text stays null with null ids; empty text has no ids; repeated
rows are encoded alike; other columns pass through, one called like the result
is replaced.  Decoding returns the text exactly unless it holds the piece mark.
"""

from __future__ import annotations

import heapq
import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # FIXED VALUES: piece types of the file format
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_P = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
WIDE = 32  # segments up to this length are folded together, longer ones each for itself


def _fields(data: bytes):
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            n = varint()
            yield key >> 3, data[at:at + n]
            at += n
        else:
            n = 4 if key & 7 == 5 else 8
            yield key >> 3, data[at:at + n]
            at += n


@dataclass
class PieceTable:
    """Pieces, their scores and types by id."""

    pieces: list[str]
    scores: np.ndarray
    types: list[int]
    dummy_prefix: bool = True
    bpe: bool = False
    keys: np.ndarray = field(init=False, repr=False)
    ids: np.ndarray = field(init=False, repr=False)

    def __post_init__(self):
        self.unknown = self.types.index(UNKNOWN) if UNKNOWN in self.types else 0
        self.byte_ids = np.full(256, self.unknown, np.int32)
        self.raw = [p.replace(MARK, " ").encode("utf-8", "surrogatepass") for p in self.pieces]
        for i, (p, kind) in enumerate(zip(self.pieces, self.types)):
            if kind == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
                self.raw[i] = bytes([int(p[3:5], 16)])
            elif kind in (UNKNOWN, CONTROL):
                self.raw[i] = b"" if kind == CONTROL else " ⁇ ".encode()
        plain = [i for i, kind in enumerate(self.types) if kind in (NORMAL, USER)]
        self.longest = max((len(self.pieces[i]) for i in plain), default=1)
        if any(MARK in self.pieces[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece holds the mark after another character")
        self.score = np.append(self.scores.astype(float), [float(self.scores[plain].min()) - 10.0 if plain else -10.0, -np.inf])
        self.places = 1 << max(4, (16 * len(plain)).bit_length())
        self.keys, self.ids = np.zeros(self.places, np.uint64), np.full(self.places, -1, np.int32)
        self.probes = 1
        for i in plain:
            h = self.hash_of(self.pieces[i])
            slot, n = int(h) & (self.places - 1), 1
            while self.ids[slot] >= 0:
                if self.keys[slot] == h:
                    raise ValueError(f"piece hash met twice: {self.pieces[i]!r}")
                slot, n = (slot + 1) & (self.places - 1), n + 1
            self.keys[slot], self.ids[slot] = h, i
            self.probes = max(self.probes, n)

    def hash_of(self, piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * _P + np.uint64(ord(c) + 1)
        return self.mix(h)[0]

    @staticmethod
    def mix(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return h ^ (h >> np.uint64(29))

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Equi-join of substring hashes to the table: piece id, -1 for none."""
        h = self.mix(h)
        slot = (h & np.uint64(self.places - 1)).astype(np.int64)
        found = np.where(self.keys[slot] == h, self.ids[slot], -1)
        open_ = np.flatnonzero((found < 0).ravel() & (self.ids[slot] >= 0).ravel())
        flat, hs, at = found.ravel(), h.ravel(), slot.ravel()
        for step in range(1, self.probes):
            if not len(open_):
                break
            s = (at[open_] + step) & (self.places - 1)
            hit = (self.keys[s] == hs[open_]) & (self.ids[s] >= 0)
            flat[open_[hit]] = self.ids[s[hit]]
            open_ = open_[~hit & (self.ids[s] >= 0)]
        return flat.reshape(h.shape)


def read_pieces(path: str) -> PieceTable:
    """The piece table of a model file.  Models that rewrite characters before
    encoding are refused."""
    pieces, scores, types, dummy, bpe = [], [], [], True, False
    with open(path, "rb") as f:
        data = f.read()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            types.append(piece.get(3, NORMAL))
        elif number == 2:
            bpe = dict(_fields(value)).get(3, 1) == 2
        elif number == 3:
            spec = dict(_fields(value))
            if spec.get(2) or spec.get(4, 1):
                raise ValueError("the model rewrites its input; only identity models are read")
            dummy = bool(spec.get(3, 1))
    return PieceTable(pieces, np.array(scores), types, dummy, bpe)


def segments(text: str, table: PieceTable) -> list[str]:
    if not text:
        return []
    return _SEGMENT.findall((MARK if table.dummy_prefix else "") + text.replace(" ", MARK))


def _edges(cp: np.ndarray, table: PieceTable) -> list[np.ndarray]:
    """For each length the piece id of every substring of the rows of ``cp``;
    -2 (the unknown character) where a single character is no piece."""
    n = cp.shape[1]
    out, h = [], np.zeros(cp.shape, np.uint64)
    for length in range(1, min(n, table.longest) + 1):
        h = h[:, :n - length + 1] * _P + cp[:, length - 1:]
        ids = table.look_up(h)
        out.append(np.where(ids < 0, -2, ids) if length == 1 else ids)
    return out


def _codes(words: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return raw.reshape(len(words), -1).astype(np.uint64) + np.uint64(1)


def _fold_best(edges: list[np.ndarray], n: int, table: PieceTable) -> np.ndarray:
    """Viterbi over the end positions of equally long segments: for every start
    the length of the edge on the best path, 0 where no edge of it starts."""
    m = len(edges[0])
    best, back = np.full((n + 1, m), -np.inf), np.zeros((n + 1, m), np.int64)
    best[0] = 0.0
    for end in range(1, n + 1):
        for length in range(min(end, len(edges)), 0, -1):
            total = best[end - length] + table.score[edges[length - 1][:, end - length]]
            up = total > best[end]
            best[end][up] = total[up]
            back[end][up] = length
    out, at, rows = np.zeros((m, n), np.int64), np.full(m, n), np.arange(m)
    while len(live := np.flatnonzero(at > 0)):
        length = back[at[live], rows[live]]
        at[live] -= length
        out[live, at[live]] = length
    return out


def _fold_merges(edges: list[np.ndarray], n: int, table: PieceTable) -> np.ndarray:
    """Merge order over the same edges, for models of kind BPE: two neighbours
    become the edge that spans both, best score first, leftmost of equals."""
    m, top = len(edges[0]), len(edges)
    score = np.full((m, n + 1, top + 1), -np.inf)
    for length, ids in enumerate(edges, 1):
        if length > 1:
            score[:, :n - length + 1, length] = table.score[ids]
    size = np.zeros((m, n + 1), np.int64)
    size[:, :n] = 1
    rows, place = np.arange(m), np.arange(n)
    while len(rows):
        own = size[rows]
        after = np.minimum(place + own[:, :n], n)
        both = own[:, :n] + np.take_along_axis(own, after, 1)
        fits = (own[:, :n] > 0) & (after < n) & (both <= top)
        gain = np.where(fits, score[rows[:, None], place, np.where(fits, both, 0)], -np.inf)
        at = gain.argmax(1)
        go = gain[np.arange(len(rows)), at] > -np.inf
        rows, at, both, after = rows[go], at[go], both[go], after[go]
        k = np.arange(len(rows))
        size[rows, after[k, at]] = 0
        size[rows, at] = both[k, at]
    return size[:, :n]


def _encode_equal(words: list[str], table: PieceTable) -> list[bytes]:
    """Segments of one length, folded together."""
    n = len(words[0])
    edges = _edges(_codes(words), table)
    lengths = (_fold_merges if table.bpe else _fold_best)(edges, n, table)
    ids = np.full(lengths.shape, -9, np.int64)
    for k, e in enumerate(edges, 1):
        row, start = np.nonzero(lengths == k)
        ids[row, start] = e[row, start]
    strange = (ids == -2).any(1)
    flat, keep = ids.astype(np.int32), lengths > 0
    whole, ends = flat[keep].tobytes(), np.cumsum(keep.sum(1)) * 4
    starts = ends - keep.sum(1) * 4
    out = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    for i in np.flatnonzero(strange):
        out[i] = _bytes_for(words[i], ids[i][keep[i]].tolist(), np.flatnonzero(keep[i]).tolist(), table)
    return out


def _bytes_for(word: str, ids, starts, table: PieceTable) -> bytes:
    out: list[int] = []
    for i, s in zip(ids, starts):
        if i == -2:
            out += table.byte_ids[list(word[s].replace(MARK, " ").encode("utf-8", "surrogatepass"))].tolist()
        else:
            out.append(int(i))
    return np.array(out, np.int32).tobytes()


def _encode_long(word: str, table: PieceTable) -> bytes:
    """One long segment by the same folds over its matched edges; memory is a
    few numbers per character and edge length."""
    n = len(word)
    edges = [e[0].tolist() for e in _edges(_codes([word]), table)]
    score, top = table.score.tolist(), len(edges)
    if table.bpe:
        size, left = [1] * n, [i - 1 for i in range(n)]
        agenda: list[tuple[float, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and (after := at + size[at]) < n and (both := size[at] + size[after]) <= top and (i := edges[both - 1][at]) >= 0:
                heapq.heappush(agenda, (-score[i], at, both))

        for at in range(n):
            offer(at)
        while agenda:
            _, at, both = heapq.heappop(agenda)
            after = at + size[at]
            if size[at] and after < n and size[at] + size[after] == both and size[after]:
                size[after], size[at] = 0, both
                if at + both < n:
                    left[at + both] = at
                offer(at)
                offer(left[at])
        starts = [i for i in range(n) if size[i]]
        return _bytes_for(word, [edges[size[i] - 1][i] for i in starts], starts, table)
    best, back = [0.0] + [float("-inf")] * n, [0] * (n + 1)
    for end in range(1, n + 1):
        high, own = float("-inf"), 1
        for length in range(min(end, top), 0, -1):
            i = edges[length - 1][end - length]
            if i != -1 and (total := best[end - length] + score[i]) > high:
                high, own = total, length
        best[end], back[end] = high, own
    ids, starts, at = [], [], n
    while at:
        at -= (length := back[at])
        ids.append(edges[length - 1][at])
        starts.append(at)
    return _bytes_for(word, ids[::-1], starts[::-1], table)


def encode_words(words: list[str], table: PieceTable) -> dict[str, bytes]:
    """Distinct segments -> their ids as int32 bytes."""
    by_length: dict[int, list[str]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    out: dict[str, bytes] = {}
    for n, same in by_length.items():
        if n > WIDE:
            out.update((w, _encode_long(w, table)) for w in same)
        else:
            step = max(1, 2_000_000 // (n * min(n, table.longest)))
            for at in range(0, len(same), step):
                part = same[at:at + step]
                out.update(zip(part, _encode_equal(part, table)))
    return out


def _rows(batch: pa.RecordBatch, size: int):
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def _with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def _replace(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    keep = [i for i, c in enumerate(batch.schema.names) if c != name]
    return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [column], [batch.schema.names[i] for i in keep] + [name])


def encode(docs: DataFrame, table: PieceTable, text: str = "text", out: str = "ids", cache_words: int = 200_000) -> DataFrame:
    """``docs`` with the piece ids of ``text`` as array<int> in ``out``."""

    def run(batches):
        known: dict[str, bytes] = {}
        for batch in batches:
            for part in _rows(batch, 500):
                texts = part.column(text).to_pylist()
                cut = [segments(t, table) if t else [] for t in texts]
                new = set().union(*cut) - known.keys()
                if len(known) + len(new) > cache_words:
                    known = {}
                    new = set().union(*cut)
                known.update(encode_words(list(new), table))
                got = [b"".join([known[w] for w in ws]) for ws in cut]
                ends = np.cumsum([0] + [len(g) // 4 for g in got]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(got), np.int32))
                missing = pa.array([t is None for t in texts])
                lists = pa.ListArray.from_arrays(pa.array(ends), values, mask=missing)
                yield _replace(part, out, lists)

    return docs.mapInArrow(run, _with_column(docs.schema, out, T.ArrayType(T.IntegerType())))


def decode(rows: DataFrame, table: PieceTable, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of the piece ids in ``out``; null ids give null."""

    def run(batches):
        raw = table.raw
        for batch in batches:
            for part in _rows(batch, 500):
                column = part.column(ids)
                values = column.flatten().to_numpy(zero_copy_only=False)
                sizes = np.nan_to_num(np.array([n or 0 for n in column.value_lengths().to_pylist()], np.int64))
                ends = np.cumsum(sizes)
                made = []
                for valid, start, end in zip(column.is_valid().to_pylist(), ends - sizes, ends):
                    if not valid:
                        made.append(None)
                        continue
                    s = b"".join([raw[i] for i in values[start:end].tolist()]).decode("utf-8", "replace")
                    made.append(s[1:] if table.dummy_prefix and s.startswith(" ") else s)
                yield _replace(part, out, pa.array(made, pa.string()))

    return rows.mapInArrow(run, _with_column(rows.schema, out, T.StringType()))
