"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least ``max(shortest, 2 q)`` words long, that no neighbouring word
extends.  Words are what stands between ASCII white space.

Splitting.  Every word of a run occurs in it at least twice, as the run holds two
whole periods.  A text starts as one segment; a word that occurs only once within
its segment is in no run and splits it; parts shorter than ``shortest`` go.  This is
repeated until no segment splits any more.  Most of an ordinary text is gone then.

Lag scan.  Within a run of period q, at least max(q, shortest - q) words in a row
equal the word q further on.  So for every lag q up to half of the longest segment
left, the scan compares groups of ``GROUP`` words q apart, but only at places so
far apart that such a stretch has ``PROBES`` of them.  Where so many in a row agree,
the stretch is extended to both sides, and is a run if it is long enough.  A stretch
that lies in a known run whose period divides q is that run, and is left out: so
lags that are multiples of a run's period give nothing.  The segments of many texts
are scanned together, longest first, so that long lags see long segments only.

Work and memory: one scan without a shuffle; texts are worked through in slices of
some MB, a single text as a whole, so memory grows with the longest text.  The
comparisons of groups in a segment of n words number about n log n.

Edge cases: a null, empty or blank text has no words, no runs and collapses to an
empty text; rows with a null id and repeated rows are worked on like others; an empty
table gives an empty result; columns of ``docs`` that are kept may have any names,
the added ones get underscores where they clash.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, text_parts

SHORTEST = 12
#: Words that are compared at once.
GROUP = 4
#: Places of a long enough stretch that are looked at.
PROBES = 4
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def split_once(ids: np.ndarray, segment: np.ndarray, shortest: int) -> np.ndarray:
    """Mask of the words that stay after one splitting: ``ids`` numbers the distinct
    (segment, word) pairs, ``segment`` ascends."""
    often = np.bincount(ids)[ids] >= 2
    return often & long_enough(segment, often, shortest)


def pieces_of(segment: np.ndarray, stays: np.ndarray) -> np.ndarray:
    """Number of the stretch of words that stay without a gap, within a segment, for
    every word (also for those that go)."""
    opens = np.ones(len(segment), dtype=bool)
    opens[1:] = (segment[1:] != segment[:-1]) | ~stays[1:] | ~stays[:-1]
    return np.cumsum(opens) - 1


def long_enough(segment: np.ndarray, stays: np.ndarray, shortest: int) -> np.ndarray:
    piece = pieces_of(segment, stays)
    return np.bincount(piece)[piece] >= shortest


def surviving(ids: np.ndarray, segment: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, segment, id) of the words that no splitting takes away.  ``ids`` numbers
    the distinct (segment, word) pairs, ``segment`` ascends."""
    at = np.arange(len(ids))
    while len(at):
        stays = split_once(ids, segment, shortest)
        if stays.all():
            break
        piece = pieces_of(segment, stays)[stays]
        at, ids = at[stays], ids[stays]
        segment = np.unique(piece, return_inverse=True)[1]
        ids = np.unique(segment * (int(ids.max(initial=0)) + 1) + ids, return_inverse=True)[1] if len(ids) else ids
    return at, segment, ids


def agreeing(words: np.ndarray, i: int, j: int) -> int:
    """How many words from i on equal those from j on (i < j)."""
    n, at, step = len(words), 0, 16
    while j + at < n:
        differ = words[i + at:min(i + at + step, n - j + i)] != words[j + at:j + at + step]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at += len(differ)
        step *= 4
    return at


def scan(words: np.ndarray, lengths: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in ``words``, in which each segment is followed
    by one word that occurs nowhere else; ``lengths`` are those of the segments, longest first."""
    if not len(lengths):
        return []
    back = words[::-1].copy()
    n = len(words)
    mixed = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    group = mixed[:n - GROUP + 1].copy()
    for k in range(1, GROUP):
        group = group * np.uint64(0xD6E8FEB86659FD93) + mixed[k:n - GROUP + 1 + k]
    ends = np.cumsum(lengths + 1)
    runs: list[tuple[int, int, int]] = []
    known: dict[int, tuple[list[int], list[int]]] = {}  # starts and ends of a period's runs
    half = lengths // 2
    for q in range(1, int(half[0]) + 1):
        wide = int(ends[np.searchsorted(-half, -q, side="right") - 1])
        need = max(q, shortest - q)
        # so many places in a row have equal groups; PROBES of them are looked at
        places = need - GROUP + 1
        probes = min(PROBES, places)
        step = places // probes
        size = min(wide, n) - GROUP + 1 - q
        equal = group[:max(0, size):step] == group[q:max(q, q + size):step]
        hit = equal[:max(0, len(equal) - probes + 1)]
        for k in range(1, probes):
            hit = hit & equal[k:k + len(hit)]
        found = (np.flatnonzero(hit) * step).tolist()
        if not found:
            continue
        periods = [known[p] for p in known if q % p == 0]
        beyond = 0
        for a in found:
            if a < beyond:
                continue
            covered = 0
            for starts, stops in periods:
                i = bisect_right(starts, a) - 1
                if i >= 0 and a + q < stops[i]:
                    covered = stops[i] - q
                    break
            if covered:
                beyond = covered
                continue
            left = agreeing(back, n - a - q, n - a)
            m = left + agreeing(words, a, a + q)
            beyond = a - left + m
            if m >= need:
                runs.append((a - left, m + q, q))
                starts, stops = known.setdefault(q, ([], []))
                starts.append(a - left)
                stops.append(a - left + m + q)
    return runs


def runs_of(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each list of words, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ids = np.empty(int(sizes.sum()), dtype=np.int64)
    at = base = 0
    for words in texts:
        number = dict(zip(dict.fromkeys(words), count(base)))
        ids[at:at + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        at, base = at + len(words), base + len(number)
    first = np.cumsum(sizes) - sizes
    place, segment, ids = surviving(ids, np.repeat(np.arange(len(texts)), sizes), shortest)
    if not len(place):
        return out
    lengths = np.bincount(segment)
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    # segments one after another, longest first, each followed by a word of its own
    sorted_lengths = lengths[order]
    new_begin = np.cumsum(sorted_lengths + 1) - (sorted_lengths + 1)
    shift = np.empty(len(order), dtype=np.int64)
    shift[order] = new_begin - begin[order]
    words = np.arange(len(ids) + len(order), dtype=np.int64) + int(ids.max()) + 1
    words[np.arange(len(ids)) + shift[segment]] = ids
    for start, length, period in scan(words, sorted_lengths, shortest):
        s = int(np.searchsorted(new_begin, start, side="right")) - 1
        at = int(place[begin[order[s]] + start - new_begin[s]])
        text = int(np.searchsorted(first, at, side="right")) - 1
        out[text].append((at - int(first[text]), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run has after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join(compress(words, keep.tolist()))


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``docs``, which has ``text``; ``n_words``; ``runs``: an array
    of structs (start, length, period) by start, then period; ``collapsed``: the words that
    no run has after its first period, joined by one space."""
    if shortest < 2 * GROUP:
        raise ValueError(f"runs must have at least {2 * GROUP} words")
    named = [fresh_name(n, list(keep)) for n in ("n_words", "runs", "collapsed")]
    pair = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_parts(batch, len(keep)):
                words = [t.split() if t else [] for t in texts]
                runs = runs_of(words, shortest)
                cols = [pa.array(map(len, words), pa.int64()),
                        pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs], pair),
                        pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *cols], [*keep, *named])

    schema = T.StructType([*(docs.schema[k] for k in keep), T.StructField(named[0], T.LongType()),
                           T.StructField(named[1], T.ArrayType(RUN)), T.StructField(named[2], T.StringType())])
    sent = fresh_name("text_bytes", list(keep))  # split() of bytes knows just the ASCII white space
    return docs.select(*keep, F.col("text").cast("binary").alias(sent)).mapInArrow(run, schema)
