"""Toxicity: a logistic classifier with a counterfactual penalty on identity terms.

Features are a text's distinct lower-case words and the prefixes of
``PREFIXES`` letters of its words (inflected words share them).  For a labelled
text that names identity groups (``IDENTITY``), counterfactual copies swap each
such term for another term of its group; besides the usual loss, training
minimises the squared difference between the scores (as log-odds) of a text
and of its copies, times ``penalty``.  So the model cannot lean on the
mere mention of a group, and a neutral sentence scores alike whichever group it
names.

Training uses at most ``MAX_ROWS`` labelled rows (those with the smallest id
hashes; a documented bound) and at most ``MAX_FEATURES`` features, those with
the largest chi-square among features of at least ``MIN_ROWS`` rows, and the
identity terms that occur.  Feature counts are aggregated by Spark; what
reaches the driver is bounded by these two numbers.  Scoring is one scan over
whole texts without a shuffle.

Edge cases: a null or empty text has no features and gets the score of the
intercept; if no row has a label, every score is 0.5; if only one label
occurs, every score is the smoothed share of label 1; labelled ids without a
document, null labels, and repeated rows are harmless (rows with one id and two
labels count as both); extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, materialize, text_parts, text_place

MAX_ROWS = 20_000
MAX_FEATURES = 4_096
MIN_ROWS = 4
MIN_CHI2 = 15.0
PREFIXES = (4, 5)
PENALTY = 1.0
L2 = 0.05
STEPS = 600
THRESHOLD = 0.7
WORDS = re.compile(r"[^\W\d_]+")

#: Terms that may be swapped for one another.
IDENTITY = (
    ("women", "men", "girls", "boys", "woman", "man", "female", "male", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "arab", "european"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    ("immigrants", "refugees", "foreigners", "citizens", "locals"),
    ("blind", "deaf", "disabled", "autistic"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)


def features(text: str | None, prefixes: tuple[int, ...] = PREFIXES) -> set[str]:
    """Distinct words of a text and prefixes of its words (marked by a final ``*``)."""
    words = set(WORDS.findall(text.lower())) if text else set()
    out = set(words)
    for n in prefixes:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


def swaps(text: str, identity=IDENTITY) -> list[str]:
    """Counterfactual copies of a text: its k-th copy has every identity term
    replaced by the k-th next term of its group."""
    place = {t: (g, i) for g in identity for i, t in enumerate(g)}
    words = set(WORDS.findall(text.lower())) & place.keys()
    if not words:
        return []
    found = re.compile(r"(?<![^\W\d_])(" + "|".join(sorted(words, key=len, reverse=True)) + r")(?![^\W\d_])", re.IGNORECASE)
    most = max(len(place[w][0]) for w in words) - 1

    def other(k: int):
        def put(m: re.Match) -> str:
            group, i = place[m[1].lower()]
            return group[(i + 1 + k % (len(group) - 1)) % len(group)] if len(group) > 1 else m[1]
        return put

    return [found.sub(other(k), text) for k in range(most)]


def fit_weights(rows: list[list[int]], labels: list[int], pairs: list[tuple[list[int], list[int]]], n_features: int,
                penalty: float = PENALTY, l2: float = L2, steps: int = STEPS) -> np.ndarray:
    """Weights (the intercept last) by accelerated gradient descent.  ``rows``:
    feature numbers of each text; ``pairs``: those of a text and of a copy."""
    def flat(lists):
        return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.asarray([i for x in lists for i in x], dtype=np.int64)

    y, n = np.asarray(labels, dtype=np.float64), len(rows)
    at, idx = flat(rows)
    pa_at, pa_idx = flat([a for a, _ in pairs])
    pb_at, pb_idx = flat([b for _, b in pairs])
    w, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    base = (y.sum() + 0.5) / (n + 1)
    w[-1] = v[-1] = np.log(base / (1 - base))
    # a diagonal that bounds the loss's curvature: row sums of X'X and D'D
    bound = 0.25 * np.bincount(idx, np.bincount(at, minlength=n)[at] + 1.0, minlength=n_features)[:n_features] + l2
    scale = penalty * min(1.0, n / len(pairs)) if pairs else 0.0
    if pairs:
        reach = np.bincount(pa_at, minlength=len(pairs)) + np.bincount(pb_at, minlength=len(pairs))
        bound = bound + 2 * scale * (np.bincount(pa_idx, reach[pa_at], minlength=n_features) + np.bincount(pb_idx, reach[pb_at], minlength=n_features))[:n_features]
    bound = np.append(bound, 0.25 * (np.bincount(at, minlength=n).sum() + n))
    t = 1.0
    for _ in range(steps):
        z = np.bincount(at, v[idx], minlength=n) + v[-1]
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.append(np.bincount(idx, g[at], minlength=n_features)[:n_features] + l2 * v[:-1], g.sum())
        if pairs:
            diff = np.bincount(pa_at, v[pa_idx], minlength=len(pairs)) - np.bincount(pb_at, v[pb_idx], minlength=len(pairs))
            grad[:-1] += scale * 2 * (np.bincount(pa_idx, diff[pa_at], minlength=n_features) - np.bincount(pb_idx, diff[pb_at], minlength=n_features))[:n_features]
        new = v - grad / bound
        t = 1.0 if grad @ (new - w) > 0 else t  # momentum starts anew when it leads uphill
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES, min_rows: int = MIN_ROWS,
          penalty: float = PENALTY, identity=IDENTITY) -> dict:
    """Model {weights: {feature: weight}, bias} from ``docs`` (doc_id, text) and
    ``labels`` (doc_id, toxic); the caller leaves out held-out rows."""
    able = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    picked = able.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_rows)
    # at most max_rows ids, so the broadcast is bounded
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(materialize(picked, "toxicity-picked")), "doc_id").select("text", "toxic"), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *(pa.array([n[i] for n in found.values()], pa.int64()) for i in (0, 1))], ["f", "clean", "toxic"])
            found.clear()

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for f in features(text):
                    found.setdefault(f, [0, 0])[1 if toxic else 0] += 1
                if len(found) > 400_000:
                    yield from flush()
        yield from flush()

    counted = sample.mapInArrow(count, "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n = {r.toxic: r["count"] for r in sample.groupBy((F.col("toxic") != 0).cast("int").alias("toxic")).count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        share = (n1 + 0.5) / (n0 + n1 + 1)
        return {"weights": {}, "bias": float(np.log(share / (1 - share)))}
    total = F.col("clean") + F.col("toxic")
    expected = total * (n1 / (n0 + n1))
    chi2 = (F.col("toxic") - expected) ** 2 / (expected * (n0 / (n0 + n1)))
    terms = sorted({t for g in identity for t in g})
    best = counted.where((total >= min_rows) & (chi2 >= MIN_CHI2)).orderBy(chi2.desc(), F.xxhash64("f"), "f").limit(max_features).select("f")
    names = sorted({r.f for r in best.collect()} | {r.f for r in counted.where(F.col("f").isin(terms)).select("f").collect()})
    number = {f: i for i, f in enumerate(names)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lambda t: sorted(number[f] for f in features(t) if f in number)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            own = [of(t) for t in texts]
            copies = [[of(c) for c in swaps(t or "", identity)] for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), pa.array(copies, pa.list_(pa.list_(pa.int32()))), batch.column(1)], ["own", "copies", "toxic"])

    # at most max_rows rows of feature numbers
    got = sample.mapInArrow(encode, "own array<int>, copies array<array<int>>, toxic int").collect()
    got.sort(key=lambda r: (r.toxic, list(r.own)))
    pairs = [(list(r.own), list(c)) for r in got for c in r.copies]
    w = fit_weights([list(r.own) for r in got], [1 if r.toxic else 0 for r in got], pairs, len(names), penalty)
    return {"weights": {f: float(x) for f, x in zip(names, w[:-1]) if x}, "bias": float(w[-1])}


def score(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``docs``, which must have ``text``, and the column score
    (the last one; underscores follow if ``keep`` has that name)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at, more = text_place(keep)
    named = fresh_name("score", list(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value["weights"], sent.value["bias"]
        whole = {f for f in weights if not f.endswith("*")}
        stems = {n: {f[:-1] for f in weights if f.endswith("*") and len(f) == n + 1} for n in PREFIXES}

        def of(text: str | None) -> float:
            z = bias
            if text:
                words = set(WORDS.findall(text.lower()))
                found = words & whole
                for n, known in stems.items():
                    found |= {p + "*" for p in {w[:n] for w in words if len(w) > n} & known}
                z += sum(weights[f] for f in sorted(found))
            return float(1 / (1 + np.exp(-min(max(z, -500.0), 500.0))))

        for batch in batches:
            for part, texts in text_parts(batch, at):
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], pa.array([of(t) for t in texts], pa.float64())], [*keep, named])

    schema = T.StructType([*(docs.schema[k] for k in keep), T.StructField(named, T.DoubleType())])
    return docs.select(*keep, *more).mapInArrow(run, schema)
