"""Byte-level BPE encoding and decoding by a tree reduction over a monoid.

A text is split by the pattern, and each match (a piece) is encoded by itself.  A
piece that is a token is that token.  Otherwise its encoding is an element of a
monoid: the token lists that merging by rank makes of byte strings, with the empty
list as identity and :meth:`Merger.join` as product, where join(encode(a),
encode(b)) = encode(a + b).  So a piece is encoded by halves, down to ``LEAF``
bytes, which are merged directly.

A join encodes a window again: the last tokens of the left list and the first of
the right one.  The window grows, on the side where it is needed, twofold each time,
until the tokens outside provably stay.  They do if the two tokens on each border of
the window, merged by themselves, stay those two.  Then all neighbours in the
joined list are stable in this sense, and such a list is what merging makes of its
bytes: take the first merge that would cross a border between two neighbours; until
then both were merged just as by themselves, so they would have been merged across
the border by themselves, too.  A window that holds all of a side has no border
there, so growing ends.

Decoding looks up the bytes of the ids and concatenates neighbours level by level
up a tree.

Work and memory: one scan, no shuffle.  Pieces already seen come from a table
bounded by ``TABLE_CHARS`` per Python worker and generation.  Texts are split in
stretches of about ``STRETCH`` characters that end between a character and a space or
line feed after it, where no match of the pattern goes across; a single piece of any
length takes time about in proportion to it.

Edge cases: a null text has null ids; an empty text has none; repeated rows and
null ids are kept as they are; an empty table gives an empty one; the other columns
of ``docs`` are carried if named in ``keep``, and columns that are added get
underscores where they clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Generations, fresh_name, text_parts, text_place, worker_cache

#: Bytes that are merged directly.
LEAF = 16
#: Tokens on either side of a join's first window.
WINDOW = 2
TABLE_CHARS = 3_000_000
STRETCH = 1 << 20
#: Neighbours concatenated at once when decoding.
FAN = 64
#: Pairs of tokens whose stability a worker keeps.
PAIRS = 200_000
#: Above all ranks.
NEVER = 1 << 62
BREAK = re.compile(r"[^\s\x1c-\x1f\x85](?=[ \n])")


class Merger:
    """Merging of bytes by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("only vocabularies with all single bytes are supported")
        self.ranks = ranks
        self.stable_pairs: dict[tuple[bytes, bytes], bool] = {}

    def merge(self, data: bytes) -> list[bytes]:
        """Tokens of some bytes: the neighbours of the lowest rank merge first, the
        leftmost of equal ones."""
        if len(data) > 4 * LEAF:
            return self._merge_long(data)
        get = self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = [get(data[i:i + 2], NEVER) for i in range(len(data) - 1)]
        while rank:
            best = min(rank)
            if best == NEVER:
                break
            at = rank.index(best)
            del rank[at]
            joined = parts[at] = parts[at] + parts.pop(at + 1)
            if at < len(rank):
                rank[at] = get(joined + parts[at + 1], NEVER)
            if at:
                rank[at - 1] = get(parts[at - 1] + joined, NEVER)
        return parts

    def _merge_long(self, data: bytes) -> list[bytes]:
        """The same with a queue of candidates over a linked list."""
        n, get = len(data), self.ranks.get
        end = list(range(1, n + 1))  # of the token that starts here; 0: none does
        before = list(range(-1, n - 1))
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := get(data[i:i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, to = heapq.heappop(queue)
            mid = end[i]
            if not mid or mid >= n or end[mid] != to:
                continue  # one of the two has been merged since
            end[i], end[mid] = to, 0
            if to < n:
                before[to] = i
                if (r := get(data[i:end[to]])) is not None:
                    heapq.heappush(queue, (r, i, end[to]))
            if (p := before[i]) >= 0 and (r := get(data[p:to])) is not None:
                heapq.heappush(queue, (r, p, to))
        out, i = [], 0
        while i < n:
            out.append(data[i:end[i]])
            i = end[i]
        return out

    def stable(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens side by side, merged by themselves, stay those two."""
        got = self.stable_pairs.get((a, b))
        if got is None:
            if len(self.stable_pairs) >= PAIRS:
                self.stable_pairs.clear()
            got = self.stable_pairs[a, b] = self.merge(a + b) == [a, b]
        return got

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """Tokens of the bytes of ``left`` and ``right``, which are tokens of theirs."""
        if not left or not right:
            return left or right
        if self.stable(left[-1], right[0]):
            return left + right
        i, j = min(WINDOW, len(left)), min(WINDOW, len(right))
        while True:
            inner = self.merge(b"".join(left[-i:]) + b"".join(right[:j]))
            left_stays = i == len(left) or self.stable(left[-i - 1], inner[0])
            right_stays = j == len(right) or self.stable(inner[-1], right[j])
            if left_stays and right_stays:
                return left[:-i] + inner + right[j:]
            if not left_stays:
                i = min(2 * i, len(left))
            if not right_stays:
                j = min(2 * j, len(right))

    def encode(self, data: bytes) -> list[bytes]:
        """Tokens of a piece."""
        if data in self.ranks:
            return [data]
        return self._halves(data)

    def _halves(self, data: bytes) -> list[bytes]:
        if len(data) <= LEAF:
            return self.merge(data)
        mid = len(data) // 2
        return self.join(self._halves(data[:mid]), self._halves(data[mid:]))


def concatenated(parts: list[bytes]) -> bytes:
    """``parts`` one after another, by a tree of ``FAN`` neighbours a node."""
    while len(parts) > 1:
        parts = [b"".join(parts[i:i + FAN]) for i in range(0, len(parts), FAN)]
    return parts[0] if parts else b""


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """``text`` in stretches of ``size`` characters and as many as follow up to a
    space or line feed after a character that is no white space."""
    at = 0
    while len(text) - at > size:
        found = BREAK.search(text, at + size)
        if not found:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:] if at else text


class ByteBpe:
    """Encoding and decoding of texts under a rank file and a pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex

        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in rank_file.splitlines() if line)}
        self.merger = Merger(ranks)
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.table = Generations(TABLE_CHARS)

    def _known(self, pieces: list[str]) -> None:
        ranks, encode = self.merger.ranks, self.merger.encode
        for p in self.table.missing(set(pieces)):
            data = p.encode("utf-8", "surrogatepass")
            self.table.put(p, array("I", map(ranks.__getitem__, encode(data))).tobytes())

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        out = []
        for part in stretches(text):
            pieces = self.pieces(part)
            self._known(pieces)
            out.append(b"".join(map(self.table.young.__getitem__, pieces)))
        return out[0] if len(out) == 1 else b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of a list of ids as :meth:`encode` gives it."""
        return concatenated(list(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())))


def coder(rank_file: bytes, pattern: str) -> ByteBpe:
    """This worker's ``ByteBpe`` for a rank file."""
    cache = worker_cache("byte_bpe")
    key = (hashlib.sha256(rank_file).digest(), pattern)
    if key not in cache:
        cache.clear()
        cache[key] = ByteBpe(rank_file, pattern)
    return cache[key]


def _mapped(docs: DataFrame, rank_file: str, pattern: str, keep: tuple[str, ...], source: str, encode: bool, decode: bool) -> DataFrame:
    with open(rank_file, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    at, more = text_place(keep) if source == "text" else ((keep.index(source), []) if source in keep else (len(keep), [source]))
    wanted = ["ids"] * encode + ["decoded"] * decode
    named = [fresh_name(n, list(keep)) for n in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(sent.value, pattern)
        for batch in batches:
            for part, values in text_parts(batch, at):
                ids = [None if v is None else bpe.encode(v) for v in values] if encode else values
                cols = [pa.array(ids, pa.binary())] if encode else []
                if decode:
                    cols.append(pa.array([None if v is None else bpe.decode(v) for v in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *cols], [*keep, *named])

    schema = T.StructType([*(docs.schema[k] for k in keep), *(T.StructField(n, T.BinaryType()) for n in named)])
    return docs.select(*keep, *more).mapInArrow(run, schema)


def encode(docs: DataFrame, rank_file: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """The ``keep`` columns of ``docs``, which has ``text``, and ``ids``: binary, little-endian
    unsigned 32-bit; with ``decoded`` also the bytes that the ids decode to."""
    return _mapped(docs, rank_file, pattern, keep, "text", True, decoded)


def decode(coded: DataFrame, rank_file: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``coded`` and ``decoded``: the bytes of its ``ids``."""
    return _mapped(coded, rank_file, pattern, keep, "ids", False, True)
