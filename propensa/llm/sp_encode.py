"""SentencePiece encoding and decoding by suffix-array matching.

The distinct chunks (see :mod:`pieces`) of a batch are joined into one text with
separators and indexed by a suffix array (sorted to the depth of the longest
piece, by prefix doubling).  Every piece of the vocabulary is binary-searched
in it, one character at a time and all pieces together, which gives its range of
occurrences.  The occurrences are the edges of a graph over text positions; they
are sorted by position and then relaxed from left to right:

* unigram models: the best score of a position is the maximum, over edges that
  end there, of the score where they start plus the piece's (ties: the longest);
* BPE models: the last piece of a prefix's encoding is unique: it is the edge
  whose piece can follow the last piece at its start.  Two pieces can stand side
  by side if undoing their merges, latest first, meets no merge across the
  border that would have come earlier.

Characters that are no piece become byte pieces.  The pieces of chunks already
met are kept per Python worker, bounded by ``CACHE_CHARS``.  Decoding maps ids
to pieces, joins byte pieces to UTF-8, and undoes the space marks; it gives back
the text, except that U+2581 itself reads as a space, as in the library.

Both are one scan without a shuffle; memory is bounded by a batch.

Edge cases: null texts (ids) give null, empty texts no ids, no ids the empty
text; repeated rows are encoded alike; empty tables give empty results; extra
columns pass through, those named like a result column are replaced.
"""

from __future__ import annotations

import gc
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .packing import text_groups
from .pieces import SPACE, PieceModel

CACHE_CHARS = 4_000_000
#: Rows whose texts are encoded at a time.
ROWS = 400
#: Characters of distinct chunks that are indexed at a time.
INDEX_CHARS = 200_000
#: Chunks of at most so many characters are relaxed together, longer ones one by one.
TOGETHER = 64

_cache: dict = {}


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``codes`` in the order of their first ``depth`` codes."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    done, order = 1, np.argsort(rank, kind="stable")
    while done < depth:
        after = np.zeros_like(rank)
        after[:-done or None] = rank[done:]
        key = rank * (int(rank.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.empty_like(rank)
        new[order] = np.cumsum(np.concatenate([[1], key[order][1:] != key[order][:-1]]))
        rank, done = new, done * 2
    return order


def ranges(codes: np.ndarray, order: np.ndarray, pieces: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open ranges of ``order`` whose suffixes start with each row of ``pieces``."""
    n, depth = len(order), pieces.shape[1]
    padded = np.concatenate([codes, np.full(depth, -1, dtype=codes.dtype)])
    lo, hi = np.zeros(len(pieces), dtype=np.int64), np.full(len(pieces), n, dtype=np.int64)
    for k in range(depth):
        live = np.flatnonzero((lengths > k) & (lo < hi))
        if not len(live):
            break
        column, want = padded[order + k], pieces[live, k]
        bounds = []
        for upper in (False, True):
            a, b = lo[live].copy(), hi[live].copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                at = column[np.minimum(mid, n - 1)]
                right = open_ & ((at <= want) if upper else (at < want))
                a = np.where(right, mid + 1, a)
                b = np.where(open_ & ~right, mid, b)
            bounds.append(a)
        lo[live], hi[live] = bounds
    return lo, hi


class Encoder:
    """Ids of texts under one model."""

    def __init__(self, data: bytes):
        self.model = m = PieceModel(data)
        self.known: dict[str, bytes] = {}
        self.chars = 0
        usable = sorted(m.id_of.values())
        if m.kind == "bpe":
            self._learn_merges(usable)
            usable = [i for i in usable if i in self.parts]
        self.ids = np.array(usable, dtype=np.int64)
        self.lengths = np.array([len(m.piece[i]) for i in usable], dtype=np.int64)
        self.table = np.full((len(usable), m.longest), -1, dtype=np.int32)
        for row, i in enumerate(usable):
            self.table[row, :len(m.piece[i])] = [ord(c) for c in m.piece[i]]
        self.beside: dict[int, bool] = {}
        self.seen, self.answer = np.full(1 << 19, -1, dtype=np.int64), np.zeros(1 << 19, dtype=bool)
        self.characters = {p for p in m.id_of if len(p) == 1}

    # -- BPE ----------------------------------------------------------------

    def _learn_merges(self, usable: list[int]) -> None:
        """``rank`` (order in which pieces are made; characters first) and
        ``parts`` (the two pieces a piece is made of; a character has none) of
        all pieces that the model's own merging can make."""
        m = self.model
        order = sorted(usable, key=lambda i: (len(m.piece[i]) > 1, -m.score[i], i))
        self.rank = {i: r for r, i in enumerate(order)}
        self.parts: dict[int, tuple[int, int] | None] = {}
        for i in order:
            if len(m.piece[i]) == 1:
                self.parts[i] = None
                continue
            steps = self.merge(m.piece[i], trace=True)
            if steps and len(steps[-1][0]) == 1:
                self.parts[i] = steps[-1][1]

    def merge(self, chunk: str, trace: bool = False):
        """The pieces of a short text by merging one pair after the other: the
        pair whose union has the best score, leftmost first.  With ``trace``, the
        states after each merge with the pair that was merged."""
        m, steps = self.model, []
        parts = list(chunk)
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                i = m.id_of.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or m.score[i] > best[0]):
                    best = (m.score[i], k)
            if best is None:
                break
            k = best[1]
            pair = (m.id_of.get(parts[k], -1), m.id_of.get(parts[k + 1], -1))
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            if trace:
                steps.append((list(parts), pair))
        return steps if trace else parts

    def can_follow(self, a: int, b: int) -> bool:
        """Whether merging leaves pieces a and b side by side."""
        key = a * self.model.size + b
        got = self.beside.get(key)
        if got is None:
            if len(self.beside) > 400_000:
                self.beside.clear()
            got = self.beside[key] = self._can_follow(a, b)
        return got

    def _can_follow(self, a: int, b: int) -> bool:
        """Undo the later of the two merges again and again.  A merge across the
        border must not come before the merge undone last: one of the same piece
        made left of the border wins a tie, one made right of it loses it."""
        m, rank, parts = self.model, self.rank, self.parts
        limit = float("inf")
        while True:
            joined = m.id_of.get(m.piece[a] + m.piece[b])
            if joined is not None and joined in rank and rank[joined] < limit:
                return False
            undo_left = parts[a] is not None and (parts[b] is None or rank[a] > rank[b])
            if undo_left:
                limit, a = rank[a], parts[a][1]
            elif parts[b] is not None:
                limit, b = rank[b] + 0.5, parts[b][0]
            else:
                return True

    def _relax_bpe(self, chunk: str, edges) -> list[int] | None:
        n, size, beside = len(chunk), self.model.size, self.beside
        last = [0] * (n + 1)  # id of the last piece of the prefix
        start_of = [-1] * (n + 1)  # where that piece starts; -1: the prefix is not reached yet
        strange = set(chunk) - self.characters
        at = 1  # ends below it are settled
        for start, end, i in edges:
            if strange:  # a character that is no piece stands alone, and nothing merges with it
                at = self._alone(chunk, strange, start_of, last, at, end)
            if start_of[end] >= 0:
                continue
            if start:
                if start_of[start] < 0:
                    continue
                before = last[start]
                if before >= 0:
                    fits = beside.get(before * size + i)
                    if not (self.can_follow(before, i) if fits is None else fits):
                        continue
            last[end], start_of[end] = i, start
        if strange:
            self._alone(chunk, strange, start_of, last, at, n + 1)
        out, end = [], n
        while end:
            start = start_of[end]
            if start < 0:
                return None
            out.extend(reversed(self.model.bytes_of(chunk[start:end])) if last[end] < 0 else (last[end],))
            end = start
        return out[::-1]

    @staticmethod
    def _alone(chunk: str, strange: set, start_of: list, last: list, at: int, upto: int) -> int:
        while at < upto:
            if chunk[at - 1] in strange:
                start_of[at], last[at] = at - 1, -1
            at += 1
        return at

    # -- unigram ------------------------------------------------------------

    def _relax_unigram(self, chunk: str, edges) -> list[int] | None:
        m, n = self.model, len(chunk)
        best = [0.0] + [float("-inf")] * n
        last: list[tuple[int, int] | None] = [None] * (n + 1)
        by_start: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for start, end, i in edges:
            by_start[start].append((end, i))
        for start in range(n):
            single = False
            for end, i in by_start[start]:
                single |= end == start + 1
                z = best[start] + m.score[i]
                if z > best[end]:
                    best[end], last[end] = z, (start, i)
            if not single and best[start] + m.unknown_score > best[start + 1]:
                best[start + 1], last[start + 1] = best[start] + m.unknown_score, (start, -1)
        return self._back(chunk, last)

    def _back(self, chunk: str, last) -> list[int] | None:
        out, end = [], len(chunk)
        while end:
            if last[end] is None:
                return None
            start, i = last[end]
            out.extend(reversed(self.model.bytes_of(chunk[start:end])) if i < 0 else [i])
            end = start
        return out[::-1]

    # -- both ---------------------------------------------------------------

    def edges(self, chunks: list[str]) -> tuple[np.ndarray, ...]:
        """Start, end and id of every occurrence of a piece, as places in the
        joined chunks, and where each chunk starts there."""
        text = "\n".join(chunks)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int32)
        starts = np.cumsum([0, *(len(c) + 1 for c in chunks)])
        codes[starts[1:-1] - 1] = -2  # separators match nothing
        order = suffix_array(codes, self.model.longest)
        lo, hi = ranges(codes, order, self.table, self.lengths)
        hit = np.flatnonzero(lo < hi)
        counts = hi[hit] - lo[hit]
        within = np.arange(counts.sum(), dtype=np.int64) - np.repeat(np.cumsum(counts) - counts, counts)
        at = order[np.repeat(lo[hit], counts) + within].astype(np.int32)
        which = np.repeat(hit.astype(np.int32), counts)
        return at, at + self.lengths[which].astype(np.int32), self.ids[which].astype(np.int32), starts

    def _merged(self, chunk: str) -> list[int]:
        return [j for p in self.merge(chunk) for j in ([self.model.id_of[p]] if p in self.model.id_of else self.model.bytes_of(p))]

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks and keep their ids."""
        if self.model.kind == "bpe":
            # several spaces in a row are pieces of equal score: merged one by one
            for c in [c for c in chunks if SPACE * 2 in c]:
                self.known[c] = array("i", self._merged(c)).tobytes()
            chunks = [c for c in chunks if SPACE * 2 not in c]
            together = [c for c in chunks if len(c) <= TOGETHER and self.characters.issuperset(c)]
            if together:
                self._relax_together(together)
            chunks = [c for c in chunks if c not in self.known]
        if not chunks:
            return
        relax = self._relax_bpe if self.model.kind == "bpe" else self._relax_unigram
        at, end, ids, starts = self.edges(chunks)
        by = np.argsort(end.astype(np.int64) * (self.model.longest + 1) + at - end, kind="stable")
        chunk = np.searchsorted(starts, at[by], side="right") - 1
        cuts = np.searchsorted(chunk, np.arange(len(chunks) + 1)).tolist()
        at, end, ids = (at[by] - starts[chunk]).tolist(), (end[by] - starts[chunk]).tolist(), ids[by].tolist()
        for c, a, b in zip(chunks, cuts[:-1], cuts[1:]):
            got = relax(c, zip(at[a:b], end[a:b], ids[a:b]))
            self.known[c] = array("i", self._merged(c) if got is None else got).tobytes()

    def _fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`can_follow` of many pairs, by a table of recent answers."""
        key = a.astype(np.int64) * self.model.size + b
        place = (key * 0x9E3779B1 >> 7) & (len(self.seen) - 1)
        miss = np.flatnonzero(self.seen[place] != key)
        out = self.answer[place]
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            fits = np.array([self.can_follow(*divmod(k, self.model.size)) for k in new.tolist()])
            out[miss] = fits[back]
            self.seen[place[miss]], self.answer[place[miss]] = key[miss], fits[back]
            both = self.seen[place[miss]] != key[miss]  # pairs that share a place: the last one stays
            self.answer[place[miss][~both]] = fits[back][~both]
        return out

    def _relax_together(self, chunks: list[str]) -> None:
        """The BPE relaxation of many chunks at once: all edges that end at a
        chunk's first place, then at its second, and so on, longest first."""
        at, end, ids, starts = self.edges(chunks)
        first = starts[np.searchsorted(starts, at, side="right") - 1]
        length = end - at
        by = np.argsort((end - first) * (self.model.longest + 1) - length, kind="stable")
        at, end, ids, length, step = at[by], end[by], ids[by], length[by], (end - first)[by]
        last = np.full(starts[-1] + 1, -1, dtype=np.int32)
        start_of = np.full(starts[-1] + 1, -1, dtype=np.int32)
        reached = np.zeros(starts[-1] + 1, dtype=bool)
        reached[starts[:-1]] = True
        group = step.astype(np.int64) * (self.model.longest + 1) - length
        cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), [len(group)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            s, e, i = at[a:b], end[a:b], ids[a:b]
            ok = reached[s] & ~reached[e]
            s, e, i = s[ok], e[ok], i[ok]
            before = last[s]
            inner = before >= 0
            ok = np.ones(len(s), dtype=bool)
            ok[inner] = self._fits(before[inner], i[inner])
            s, e, i = s[ok], e[ok], i[ok]
            reached[e], last[e], start_of[e] = True, i, s
        # back from the ends of all chunks
        begin, node = starts[:-1], starts[1:] - 1
        ok = reached[node]
        which, ids_back, rank, turn = [], [], [], 0
        live = np.flatnonzero(ok)
        node = node.copy()
        while len(live):
            which.append(live)
            ids_back.append(last[node[live]])
            rank.append(np.full(len(live), -turn))
            node[live] = start_of[node[live]]
            live = live[node[live] > begin[live]]
            turn += 1
        if not which:
            return
        which, ids_back, rank = map(np.concatenate, (which, ids_back, rank))
        by = np.lexsort((rank, which))
        data = ids_back[by].astype("<i4").tobytes()
        cuts = (4 * np.searchsorted(which[by], np.arange(len(chunks) + 1))).tolist()
        for c, a, b, done in zip(chunks, cuts[:-1], cuts[1:], ok.tolist()):
            if done:
                self.known[c] = data[a:b]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as the bytes of 32-bit numbers."""
        cut = [self.model.chunks(t) for t in texts]
        if self.chars > CACHE_CHARS:
            self.known, self.chars = {}, 0
        new = sorted({c for cs in cut for c in set(cs).difference(self.known)})
        self.chars += sum(map(len, new))
        gc.disable()  # many short-lived lists of numbers, no cycles
        for a, b in text_groups(new, INDEX_CHARS):
            self.learn(new[a:b])
        gc.enable()
        return [b"".join(map(self.known.__getitem__, cs)) for cs in cut]


def encoder(path: str, data: bytes) -> Encoder:
    """This worker's encoder of a model."""
    if path not in _cache:
        _cache.clear()
        _cache[path] = Encoder(data)
    return _cache[path]


def _model_bytes(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _other(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c.lower() not in names]


def _lists(ids: list[bytes], texts: list) -> pa.Array:
    """Bytes of ids as an Arrow list array, null where the text is."""
    ends = np.cumsum([0, *map(len, ids)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), dtype=np.int32)), mask=pa.array([t is None for t in texts], pa.bool_()))


def _decoder(path: str, data) -> PieceModel:
    if ("decode", path) not in _cache:
        _cache["decode", path] = PieceModel(data.value)
    return _cache["decode", path]


def encode(df: DataFrame, model: str, column: str = "text", decoded: bool = False) -> DataFrame:
    """``df`` with ``ids`` (array<int>) of the text in ``column``; ``model`` is the
    path of a model file.  With ``decoded``, also the text that these ids decode
    to, made in the same pass."""
    names = ("ids", "decoded") if decoded else ("ids",)
    data, rest = _model_bytes(df, model), _other(df, *names)
    df = df.select(*rest)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model, data.value)
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                part = batch.slice(a, ROWS)
                texts = part.column(at).to_pylist()
                ids = enc.texts([t or "" for t in texts])
                new = [_lists(ids, texts)]
                if decoded:
                    new.append(pa.array([None if t is None else enc.model.decode(np.frombuffer(i, dtype=np.int32).tolist()) for t, i in zip(texts, ids)], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*rest, *names])

    kinds = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *(T.StructField(n, kinds[n]) for n in names)]))


def decode(df: DataFrame, model: str, column: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the text of the ids in ``column``."""
    data, rest = _model_bytes(df, model), _other(df, "decoded")
    df = df.select(*rest)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _decoder(model, data)
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                part = batch.slice(a, ROWS)
                got = [None if ids is None else m.decode(ids) for ids in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.string())], [*rest, "decoded"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("decoded", T.StringType())]))
