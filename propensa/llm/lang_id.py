"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's ``PROFILE`` most frequent character
n-grams (n = 1 to 3, within words padded by ``_``), most frequent first.  A
text is ranked the same way, and its distance from a language is the sum, over
the text's n-grams, of how far each is out of place: the difference between its
rank in the text and in the profile, or ``PROFILE`` where the profile lacks it.
The language with the smallest distance is predicted (ties: the smallest name).

Training counts n-grams over all rows given: partial counts per task and
language, one aggregation, and a top-``PROFILE`` ranking per language, whose
rows number at most languages x PROFILE.  Only this table, which is bounded by
``MAX_LANGUAGES`` x ``PROFILE`` rows, goes to the driver and the tasks.
Prediction is one scan without a shuffle.

The score is between 0 and 1: 0.5 + half of the share by which the best
language's distance is below the second's; with one language only, 1 minus the
share of the largest possible distance.  ``fit`` is the share of the largest
possible distance that the best language leaves unused; text in no learned
language has a low fit.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text if nothing was learned; training rows with a null language or text
are skipped; equal counts rank by the n-gram's hash; repeated rows are counted
and predicted one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, text_parts, text_place, worker_cache

PROFILE = 400
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 2_000
UND = "und"
#: Runs of letters, and of numbers that are no digits (as in "²" or "Ⅷ").
WORDS = re.compile(r"[^\W\d_]+")
#: Bits of a character in the code of an n-gram.
CHAR_BITS = 21
#: Distinct words whose n-grams a Python worker keeps before it starts anew.
CACHE_WORDS = 150_000


class Grams:
    """Numbers of n-grams, and the n-grams of words, of a Python worker.  An n-gram's
    code holds its characters; codes are numbered in the order of their appearance."""

    def __init__(self):
        self.names: list[str] = []
        self.hashes = np.empty(0, dtype=np.uint64)
        self.codes = np.empty(0, dtype=np.uint64)  # ascending
        self.of_code = np.empty(0, dtype=np.int32)  # their numbers
        self.of_word: dict[str, np.ndarray] = {}

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """Number of each code; new ones are added."""
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        if not known.all():
            new = np.unique(codes[~known])
            first = len(self.names)
            for c in new.tolist():
                chars = [c >> shift & (1 << CHAR_BITS) - 1 for shift in (2 * CHAR_BITS, CHAR_BITS, 0)]
                self.names.append("".join(chr(x) for x in chars if x))
            every = np.concatenate([self.codes, new])
            order = np.argsort(every)
            self.codes = every[order]
            self.of_code = np.concatenate([self.of_code, np.arange(first, len(self.names), dtype=np.int32)])[order]
            at = np.searchsorted(self.codes, codes)
        return self.of_code[at]

    def numbered(self, words: list[str]) -> dict[str, np.ndarray]:
        """Numbers of the n-grams of each word, padded by ``_``."""
        text = "".join([f"_{w}_" for w in words]).encode("utf-32-le", "surrogatepass")
        chars = np.frombuffer(text, dtype="<u4").astype(np.uint64)
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 2)
        codes, owners = [], []
        for n in ORDERS:
            code = chars[:len(chars) - n + 1].copy()
            for k in range(1, n):
                code = code << np.uint64(CHAR_BITS) | chars[k:len(chars) - n + 1 + k]
            inside = owner[:len(code)] == owner[n - 1:]
            if n == 1:
                inside &= chars != ord("_")
            codes.append(code[inside])
            owners.append(owner[:len(code)][inside])
        owner = np.concatenate(owners)
        found = self.numbers(np.concatenate(codes))[np.argsort(owner, kind="stable")]
        ends = np.cumsum(np.bincount(owner, minlength=len(words))).tolist()
        return {w: found[a:b] for w, a, b in zip(words, [0, *ends], ends)}

    def counts(self, words: Counter) -> np.ndarray:
        """Number of each n-gram in a bag of words, by n-gram number."""
        of_word = self.of_word
        missing = [w for w in words if w not in of_word]
        if missing:
            of_word.update(self.numbered(missing))
        arrays = list(map(of_word.__getitem__, words))
        for w in missing:
            if len(w) > 64:  # such words are not kept
                del of_word[w]
        weights = np.repeat(np.fromiter(words.values(), np.float64, len(words)), list(map(len, arrays)))
        return np.bincount(np.concatenate(arrays), weights, minlength=len(self.names))

    def hash(self) -> np.ndarray:
        if len(self.hashes) < len(self.names):
            new = [xxhash.xxh64_intdigest(g) for g in self.names[len(self.hashes):]]
            self.hashes = np.concatenate([self.hashes, np.asarray(new, dtype=np.uint64)])
        return self.hashes

    def top(self, counts: np.ndarray, k: int) -> np.ndarray:
        """Numbers of the k most frequent n-grams, most frequent first, ties by hash."""
        found = np.flatnonzero(counts)
        if len(found) > k:
            least = np.partition(counts[found], len(found) - k)[len(found) - k]
            found = found[counts[found] >= least]
        return found[np.lexsort((self.hash()[found], -counts[found]))][:k]


def letters(text: str) -> list[str]:
    """The runs of letters of a text, in lower case."""
    found = WORDS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for f in found for w in ("".join([c if c.isalpha() else " " for c in f]).split())]


def learn(docs: DataFrame, profile: int = PROFILE) -> list[tuple[str, str, int]]:
    """(lang, n-gram, rank from 0) of each language's profile, from ``docs`` (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags: dict[str, Counter] = {}

        def flush():
            for lang, words in bags.items():
                grams = Grams()
                n = grams.counts(words) if words else np.empty(0)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(grams.names, pa.string()), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])
            bags.clear()

        for batch in batches:
            for part, texts in text_parts(batch, 0):
                for text, lang in zip(texts, part.column(1).to_pylist()):
                    bags.setdefault(lang, Counter()).update(letters(text))
                    if sum(map(len, bags.values())) > CACHE_WORDS:
                        yield from flush()
        yield from flush()

    counted = (docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", F.col("lang").cast("string"))
               .mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.xxhash64("gram"), "gram")
    # in this form each task keeps its best only, and no task sorts a language's whole table
    best = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile)
    rows = [(r.lang, r.gram, r["rank"] - 1) for r in best.select("lang", "gram", "rank").limit(MAX_LANGUAGES * profile + 1).collect()]
    if len({r[0] for r in rows}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return rows


class Predictor:
    """Distances of texts from learned profiles."""

    def __init__(self, model: list[tuple[str, str, int]], profile: int):
        self.langs = sorted({m[0] for m in model})
        self.ranks = [{} for _ in self.langs]
        for lang, gram, rank in model:
            self.ranks[self.langs.index(lang)][gram] = rank
        self.profile, self.grams, self.table = profile, Grams(), np.empty((len(self.langs), 0), dtype=np.int32)

    def rank_table(self) -> np.ndarray:
        names, have = self.grams.names, self.table.shape[1]
        if have < len(names):
            new = np.array([[r.get(g, -1) for g in names[have:]] for r in self.ranks], dtype=np.int32).reshape(len(self.ranks), -1)
            self.table = np.concatenate([self.table, new], axis=1)
        return self.table

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        words = Counter(letters(text)) if text else None
        if not words or not self.langs:
            return UND, 0.0, 0.0
        if len(self.grams.of_word) > CACHE_WORDS:
            self.grams, self.table = Grams(), np.empty((len(self.langs), 0), dtype=np.int32)
        top = self.grams.top(self.grams.counts(words), self.profile)
        ranks = self.rank_table()[:, top]
        d = np.where(ranks < 0, self.profile, np.abs(ranks - np.arange(len(top)))).sum(1)
        most = self.profile * len(top)
        order = np.argsort(d, kind="stable")
        best = int(d[order[0]])
        fit = 1 - best / most
        if len(order) == 1:
            return self.langs[0], fit, fit
        second = int(d[order[1]])
        return self.langs[order[0]], 0.5 + 0.5 * (second - best) / second if second else 0.5, fit


def predict(docs: DataFrame, model: list[tuple[str, str, int]], profile: int = PROFILE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``docs``, which must have ``text``, and lang_pred, score, fit
    (the last three columns; underscores follow a name that ``keep`` has)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = (profile, hash(tuple(model)))
    at, more = text_place(keep)
    named = [fresh_name(n, list(keep)) for n in ("lang_pred", "score", "fit")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("lang_id")
        if cache.get("key") != key:
            cache.update(key=key, predictor=Predictor(sent.value, profile))
        predictor = cache["predictor"]
        for batch in batches:
            for part, texts in text_parts(batch, at):
                got = [predictor(t) for t in texts]
                cols = [pa.array([g[0] for g in got], pa.string()), *(pa.array([g[i] for g in got], pa.float64()) for i in (1, 2))]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *cols], [*keep, *named])

    schema = T.StructType([*(docs.schema[k] for k in keep), T.StructField(named[0], T.StringType()),
                           T.StructField(named[1], T.DoubleType()), T.StructField(named[2], T.DoubleType())])
    return docs.select(*keep, *more).mapInArrow(run, schema)
