"""Exact BM25 top-k with an inverted index and pruning by bounds, per shard.

Terms are lower-cased words; a term is known by its 64-bit hash.  Document
frequencies, the number of documents and their mean length are counted over the
whole table, so scores do not depend on the shards.

A shard is one partition of the document table.  Its inverted index is built in the
task that reads it.  The queries are a table too; they are written to the shared
folder in files of ``QUERY_BLOCK`` queries, and every shard reads these files one
after the other, so neither side is ever whole in memory and nothing is
broadcast.

A query's threshold is the k-th best score found so far.  Some shards, about the
root of their number, are searched first; their k-th best scores are written
beside the queries, and the other shards begin with them.  Within a shard, documents
that share frequent words (those of one language, say) form groups.  A group's frequent
terms are columns of a matrix, with the largest impact of each; its other terms have
postings.  For a file of queries, the postings are summed first: the sum and the largest
impacts of the query's frequent terms bound the score of every document.  Documents whose
bound reaches the threshold get the frequent terms' scores, one by one where they are
few and as a matrix product where they are many.  Single-precision sums choose candidates, with slack for rounding; candidates get
their final scores in double precision, term by term in hash order.  The shards'
lists, one of at most k hits per query and shard, are merged in two levels.

score(q, d) = sum over common terms of qtf * idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len / mean len)),
idf = ln(1 + (N - df + 0.5) / (df + 0.5)).  Ties rank the smaller doc_id first.

Edge cases: null and empty texts have no terms: they count as documents of length
0, are never found and find nothing; a query finds itself if it is in the
table; documents without a common term are not returned, so lists may be
shorter than k; rows that repeat an id are documents of their own; an empty
table or query set gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, new_path
from .warc import open_fs

K1, B = 1.2, 0.75
QUERY_BLOCK = 256
#: Queries whose postings are summed at once.
QUERIES_AT_ONCE = 8
#: Queries that are multiplied with a group's matrix at once.
PRODUCTS_AT_ONCE = 128
#: Terms in at least this share of a group's documents are columns of its matrix.
DENSE_SHARE, DENSE_MOST = 1 / 32, 2048
#: Groups of a shard at most, documents of a group on average at least, terms that they are made by, and rounds.
GROUPS, GROUP_LEAST, GROUP_TERMS, GROUP_ROUNDS = 8, 256, 512, 6
#: A query with more than one in so many documents of a group left gets the product with the whole matrix.
WHOLE = 32
#: Slack for sums in single precision.
SLACK = 1 + 1e-4
WORDS = re.compile(r"\w+")
#: ASCII characters that are in no word become spaces.
SPACED = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))

_words: dict[bytes, int] = {}


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term hashes of a text, in order, and their counts; known words are looked up.
    A stretch between ASCII characters that are in no word is a word if it is ASCII; else it is searched for words."""
    text = (text or "").lower()
    counts = Counter(text.encode().translate(SPACED).split())
    if not text.isascii():
        for part in [p for p in counts if not p.isascii()]:
            n, words = counts.pop(part), WORDS.findall(part.decode())
            for w in words:
                counts[w.encode()] += n
    if len(_words) > 400_000:
        _words.clear()
    for w in set(counts).difference(_words):
        h = xxhash.xxh64_intdigest(w)
        _words[w] = h - (1 << 64) if h >> 63 else h
    terms = np.fromiter(map(_words.__getitem__, counts), np.int64, len(counts))
    tfs = np.fromiter(counts.values(), np.int64, len(counts))
    order = np.argsort(terms)
    terms, tfs = terms[order], tfs[order]
    first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])[:len(terms)])
    return terms[first], np.add.reduceat(tfs, first) if len(first) else tfs


def term_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, length, terms, tfs) of ``docs`` (doc_id, text): distinct term hashes in order and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                t, c = term_counts(text)
                n.append(int(c.sum()))
                terms.append(t.astype("<i8").tobytes())
                tfs.append(c.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], ["doc_id", "length", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, length long, terms binary, tfs binary")


def frequencies(index: DataFrame) -> DataFrame:
    """(term, df) over the rows of :func:`term_rows`; tasks send partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            t, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(t), pa.array(c.astype(np.int64))], ["term", "df"])

        for batch in batches:
            for x in batch.column(0).to_pylist():
                held.append(np.frombuffer(x, dtype="<i8"))
                size += len(x)
            if size > 64 << 20:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return index.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def alike(doc: np.ndarray, at: np.ndarray, n: int, df: np.ndarray) -> np.ndarray:
    """A group number for each of ``n`` documents, by k-means over the most frequent terms;
    ``doc`` and ``at`` are the documents and terms of all postings, ``df`` the terms' frequencies."""
    groups = min(GROUPS, n // GROUP_LEAST)
    if groups < 2 or not len(df):
        return np.zeros(n, dtype=np.uint8)
    many = np.argsort(-df, kind="stable")[:GROUP_TERMS]
    column = np.full(len(df), -1, dtype=np.int32)
    column[many] = np.arange(len(many))
    col = column[at]
    ok = col >= 0
    x = np.zeros((n, len(many)), dtype=np.float32)
    x[doc[ok], col[ok]] = np.sqrt(np.log(1 + n / df[many]))[col[ok]]
    x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)
    middle = x[np.linspace(0, n - 1, groups).astype(np.int64)]
    for _ in range(GROUP_ROUNDS):
        label = (x @ middle.T).argmax(axis=1)
        for g in range(groups):
            if (label == g).any():
                mean = x[label == g].sum(axis=0)
                middle[g] = mean / max(math.sqrt(mean @ mean), 1e-9)
    return (x @ middle.T).argmax(axis=1).astype(np.uint8)


class Group:
    """Documents of a shard at places ``lo`` to ``hi``: a matrix of their frequent terms' impacts,
    and by term (its number among the terms that are frequent in some group) the column, if any, and largest impact."""

    def __init__(self, lo: int, dense: np.ndarray, column: np.ndarray):
        self.lo, self.n, self.dense, self.column = lo, len(dense), dense, column
        self.most = np.where(column >= 0, dense.max(axis=0, initial=0)[column] if dense.shape[1] else 0, 0)

    def ask(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, nq: int) -> np.ndarray:
        """Begin with queries (``row``) of these terms and weights; the most that the matrix can add to their scores."""
        col = self.column[term]
        dense = np.flatnonzero(col >= 0)
        self.q = np.zeros((nq, self.dense.shape[1]), dtype=np.float32)
        self.q[row[dense], col[dense]] = weight[dense]
        return np.bincount(row, weight * self.most[term], nq)

    def find(self, sums: np.ndarray, rows: np.ndarray, most: np.ndarray, least: np.ndarray, k: int) -> tuple:
        """(queries, documents' places, scores) of the documents that reach the thresholds ``least`` of the queries
        ``rows``; the thresholds rise where enough do.  ``sums`` has the scores from postings, ``most`` what the matrix can add."""
        lim = np.maximum(least[rows] / SLACK, 1e-30)
        own = sums[:, self.lo:self.lo + self.n]
        if len(rows) < len(sums):
            own = own[rows]
        able = own >= (lim - most[rows] * SLACK).astype(np.float32)[:, None]
        whole = np.flatnonzero(np.count_nonzero(able, axis=1) > self.n // WHOLE)
        able[whole] = False
        who, docs = np.divmod(np.flatnonzero(able), self.n)
        score = own[who, docs]
        for lo in range(0, len(who), 4096):
            part = slice(lo, lo + 4096)
            score[part] += np.einsum("ij,ij->i", self.q[rows[who[part]]], self.dense[docs[part]])
        keep = score >= lim[who]
        found = [(rows[who[keep]], docs[keep] + self.lo, score[keep])]
        for lo in range(0, len(whole), PRODUCTS_AT_ONCE):
            part = whole[lo:lo + PRODUCTS_AT_ONCE]
            scores = self.q[rows[part]] @ self.dense.T
            scores += own[part]
            hit = scores >= lim[part, None].astype(np.float32)
            many = np.flatnonzero(np.count_nonzero(hit, axis=1) >= k)
            if len(many):
                kth = np.partition(scores[many], self.n - k, axis=1)[:, self.n - k].astype(np.float64)
                up = rows[part[many]]
                least[up] = np.maximum(least[up], kth / SLACK)
                hit[many] &= scores[many] >= (kth / SLACK / SLACK).astype(np.float32)[:, None]
            who, docs = np.divmod(np.flatnonzero(hit), self.n)
            found.append((rows[part[who]], docs + self.lo, scores[who, docs]))
        return tuple(np.concatenate(x) for x in zip(*found))


class Shard:
    """Inverted index of some documents, by groups of documents that are alike."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], mean: float):
        self.n = len(ids)
        size = np.array([len(t) for t in terms], dtype=np.int64)
        self.ids, self.doc_start = ids, np.append(0, np.cumsum(size))
        term = np.concatenate([*terms, np.empty(0, np.int64)])
        order = np.argsort(term, kind="stable")
        term = term[order]
        start = np.flatnonzero(np.append(True, term[1:] != term[:-1])[:len(term)])
        self.vocab, df = term[start], np.diff(np.append(start, len(term)))
        del term
        tf = np.concatenate([*tfs, np.empty(0, np.int32)])
        impact = np.repeat(K1 * (1 - B + B * lengths / mean if mean else np.ones(self.n)), size)
        impact += tf
        np.divide(tf * (K1 + 1), impact, out=impact)
        del tf
        doc = np.repeat(np.arange(self.n, dtype=np.int32), size)
        # by the first bits of a hash: the place of the first term that has them
        self.shift = 64 - max(1, len(self.vocab).bit_length())
        self.first = np.searchsorted(self.prefix(self.vocab), np.arange(1 << (64 - self.shift))).astype(np.int32)
        self.padded = np.append(self.vocab, np.iinfo(np.int64).max)
        # by document: its terms' places among the shard's terms, in order, and their impacts
        self.by_doc_at, self.by_doc_impact = np.empty(len(doc), dtype=np.int32), impact
        self.by_doc_at[order] = at = np.repeat(np.arange(len(self.vocab), dtype=np.int32), df)
        self.weights = np.zeros(len(self.vocab))
        # documents by group, and for each posting its document's place in that order
        label = alike(doc, self.by_doc_at, self.n, df)
        self.docs = np.argsort(label, kind="stable")
        place = np.empty(self.n, dtype=np.int32)
        place[self.docs] = np.arange(self.n)
        place, impact, label_of = place[doc[order]], impact[order].astype(np.float32), label[doc[order]]
        rare, kept, lo = np.ones(len(at), dtype=bool), [], 0
        for g, n in enumerate(np.bincount(label)):
            own = np.flatnonzero(label_of == g)
            df = np.bincount(at[own], minlength=len(self.vocab))
            many = np.flatnonzero(df >= max(8, n * DENSE_SHARE))
            many = many[np.argsort(-df[many], kind="stable")][:DENSE_MOST]
            column = np.full(len(self.vocab), -1, dtype=np.int32)
            column[many] = np.arange(len(many))
            col = column[at[own]]
            own, col = own[col >= 0], col[col >= 0]
            rare[own] = False
            dense = np.zeros((n, len(many)), dtype=np.float32)
            dense[place[own] - lo, col] = impact[own]
            kept.append((lo, dense, many))
            lo += n
        # numbers of the terms that are frequent in some group; the other postings by term
        frequent = np.unique(np.concatenate([np.empty(0, np.int64), *(many for _, _, many in kept)]))
        self.number = np.full(len(self.vocab), -1, dtype=np.int32)
        self.number[frequent] = np.arange(len(frequent))
        self.groups = []
        for lo, dense, many in kept:
            column = np.full(len(frequent), -1, dtype=np.int32)
            column[self.number[many]] = np.arange(len(many))
            self.groups.append(Group(lo, dense, column))
        # a posting: the document's place and the impact's bits, read together
        self.postings = np.stack([place[rare], impact[rare].view(np.int32)], axis=1).view(np.int64).ravel()
        self.start = np.append(0, np.cumsum(np.bincount(at[rare], minlength=len(self.vocab))))

    def prefix(self, term: np.ndarray) -> np.ndarray:
        return ((term.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(self.shift)).astype(np.int64)

    def places(self, term: np.ndarray) -> np.ndarray:
        """Places of terms among the shard's, as ``np.searchsorted`` has them."""
        at = self.first[self.prefix(term)].astype(np.int64)
        behind = np.flatnonzero(self.padded[at] < term)
        for _ in range(8):
            at[behind] += 1
            behind = behind[self.padded[at[behind]] < term[behind]]
        at[behind] = np.searchsorted(self.vocab, term[behind])
        return at

    def search(self, qids: np.ndarray, qterms: list[np.ndarray], qweights: list[np.ndarray], k: int, least: np.ndarray | None = None) -> Iterator[tuple]:
        """(query number, documents' numbers, scores) of each query's best k of the shard;
        a query's terms are distinct.  Documents with a score below the query's in ``least`` may be left out."""
        nq = len(qids)
        row = np.repeat(np.arange(nq), [len(t) for t in qterms])
        term, weight = np.concatenate(qterms), np.concatenate(qweights)
        at = self.places(term)
        ok = (at < len(self.vocab)) & (self.padded[at] == term)
        row, at, weight = row[ok], at[ok], weight[ok]
        least = np.zeros(nq) if least is None else least.astype(np.float64)
        number = self.number[at]
        dense = np.flatnonzero(number >= 0)
        most = [group.ask(row[dense], number[dense], weight[dense], nq) for group in self.groups]
        sums = self.sums(row, at, weight, nq)
        # queries without a threshold get it from the group that can give them most
        first = np.where(least > 0, -1, np.argmax(most, axis=0))
        hits = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))]
        for turn in (True, False):
            for g, group in enumerate(self.groups):
                rows = np.flatnonzero((first == g) == turn)
                if len(rows):
                    who, places, score = group.find(sums, rows, most[g], least, k)
                    hits.append((who, self.docs[places], score))
        who, docs, score = (np.concatenate(x) for x in zip(*hits))
        order = np.lexsort((-score, who))
        who, docs, score = who[order], docs[order], score[order]
        ends = np.searchsorted(who, np.arange(nq + 1))
        full = np.flatnonzero(np.diff(ends) >= k)
        least[full] = np.maximum(least[full], score[ends[full] + k - 1] / SLACK)
        keep = score * SLACK >= least[who]
        who, docs = who[keep], docs[keep]
        ends, cuts = np.searchsorted(who, np.arange(nq + 1)), np.searchsorted(row, np.arange(nq + 1))
        for i in np.unique(who):
            own, mine = docs[ends[i]:ends[i + 1]], slice(*cuts[i:i + 2])
            exact = self.exact(own, at[mine], weight[mine])
            keep = np.lexsort((self.ids[own], -exact))[:k]
            yield i, own[keep], exact[keep]

    def sums(self, row: np.ndarray, at: np.ndarray, weight: np.ndarray, nq: int) -> np.ndarray:
        """Scores from postings: a row for each query, a column for each document's place."""
        out = np.empty((nq, self.n), dtype=np.float32)
        some = np.flatnonzero(self.start[at + 1] > self.start[at])
        row, at, weight = row[some], at[some], weight[some]
        for lo in range(0, nq, QUERIES_AT_ONCE):
            hi = min(nq, lo + QUERIES_AT_ONCE)
            part = slice(*np.searchsorted(row, [lo, hi]))
            pick, size = ranges(self.start[at[part]], self.start[at[part] + 1])
            posting = self.postings.take(pick, mode="clip").view(np.int32).reshape(-1, 2)
            cell = np.repeat((row[part] - lo) * self.n, size)
            cell += posting[:, 0]
            sums = np.repeat(weight[part], size)
            sums *= posting.view(np.float32)[:, 1]
            out[lo:hi] = np.bincount(cell, sums, (hi - lo) * self.n).reshape(hi - lo, self.n)
        return out

    def exact(self, docs: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Scores of documents for a query's terms ``at``, in double precision, each summed in the order of term hashes."""
        pick, size = ranges(self.doc_start[docs], self.doc_start[docs + 1])
        self.weights[at] = weight
        parts = self.weights[self.by_doc_at[pick]] * self.by_doc_impact[pick]
        self.weights[at] = 0
        return np.bincount(np.repeat(np.arange(len(docs)), size), parts, len(docs))


def ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each start to before its end, one range after the other, and the ranges' sizes."""
    size = end - start
    got = np.repeat(start - np.cumsum(size) + size, size)
    got += np.arange(len(got))
    return got, size


def better(a: Column, b: Column) -> Column:
    """Order of hits: larger scores first, then smaller ids (null ids first)."""
    return (F.when(a["scores"] > b["scores"], -1).when(a["scores"] < b["scores"], 1).when(a["ids"].eqNullSafe(b["ids"]), 0)
            .when(a["ids"].isNull(), -1).when(b["ids"].isNull(), 1).when(a["ids"] < b["ids"], -1).otherwise(1))


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, score): the best ``k`` documents of ``docs``
    (doc_id, text) for each row of ``queries`` (query_id, text)."""
    spark = docs.sparkSession
    index = materialize(term_rows(docs), "bm25-terms")
    shard = F.spark_partition_id()
    total = index.select("length", shard.alias("shard")).agg(F.count("*").alias("n"), F.sum("length").alias("words"), F.collect_set("shard").alias("shards")).first()
    n, mean = total.n, (total.words or 0) / total.n if total.n else 0.0

    asked = term_rows(queries.select(F.col("query_id").alias("doc_id"), "text")).withColumn("query", F.monotonically_increasing_id())
    asked = materialize(asked.where(F.col("length") > 0), "bm25-queries")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 200):
                part = batch.slice(a, 200)
                terms = [np.frombuffer(t, dtype="<i8") for t in part.column(1).to_pylist()]
                tfs = [np.frombuffer(t, dtype="<i4") for t in part.column(2).to_pylist()]
                size = [len(t) for t in terms]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(0).to_numpy(), size)), pa.array(np.concatenate(terms)), pa.array(np.concatenate(tfs).astype(np.int64))], ["query", "term", "qtf"])

    terms = asked.select("query", "terms", "tfs").mapInArrow(spread, "query long, term long, qtf long")
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(frequencies(index), "term").select("query", "term", (F.col("qtf") * idf).alias("weight"))
    files = max(1, -(-asked.count() // QUERY_BLOCK))
    folder = new_path(spark, "bm25-query-blocks")
    blocks = (weighted.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("t"))
              .join(asked.select("query", F.col("doc_id").alias("query_id")), "query")
              .select("query", "query_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"), F.lit(0.0).alias("least")))
    blocks.repartition(files, F.xxhash64("query")).write.option("compression", "zstd").parquet(folder)

    def searched(rows: DataFrame, folder: str) -> DataFrame:
        """(query, query_id, shard, hits): one list per query and shard."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = [p for p in batches if len(p)]
            if not parts:
                return
            rows = pd.concat(parts, ignore_index=True)
            ids, lengths = rows["doc_id"].fillna(-1).to_numpy(np.int64), rows["length"].to_numpy(np.float64)
            named = np.array([None if pd.isna(i) else int(i) for i in rows["doc_id"]], dtype=object)
            cuts = np.cumsum([len(t) // 8 for t in rows["terms"]])[:-1]
            terms, tfs = np.frombuffer(b"".join(rows["terms"]), dtype="<i8"), np.frombuffer(b"".join(rows["tfs"]), dtype="<i4")
            del parts, rows
            shard = Shard(ids, lengths, np.split(terms, cuts), np.split(tfs, cuts), mean)
            del terms, tfs
            store, base = open_fs(folder)
            listed = sorted(f.path for f in store.get_file_info(pafs.FileSelector(base)) if f.path.endswith(".parquet"))
            for path in listed:
                with store.open_input_file(path) as f:
                    for batch in pq.ParquetFile(f).iter_batches(QUERY_BLOCK):
                        if not len(batch):
                            continue
                        qids = batch.column(1).to_pylist()
                        qn = batch.column(0).to_numpy()
                        offs = batch.column(2).offsets.to_numpy()
                        t, w = batch.column(2).values.to_numpy(), batch.column(3).values.to_numpy()
                        qt, qw = [t[a:b] for a, b in zip(offs[:-1], offs[1:])], [w[a:b] for a, b in zip(offs[:-1], offs[1:])]
                        out = [(qn[i], qids[i], named[ds].tolist(), ss.tolist()) for i, ds, ss in shard.search(qn, qt, qw, k, batch.column(4).to_numpy())]
                        if out:
                            yield pd.DataFrame(out, columns=["query", "query_id", "ids", "scores"]).astype({"query_id": "Int64"})

        lists = rows.mapInPandas(run, "query long, query_id long, ids array<long>, scores array<double>")
        return lists.select("query", "query_id", F.spark_partition_id().alias("shard"), F.arrays_zip("scores", "ids").alias("hits"))

    best = lambda c: F.slice(F.array_sort(F.flatten(F.collect_list(c)), better), 1, k)
    # the k-th best scores of some shards are thresholds for the others
    shards = sorted(total.shards)
    early = shards[::math.isqrt(len(shards))] if len(shards) > 3 else []
    if not early:
        lists = searched(index, folder)
    else:
        known = searched(index.where(shard.isin(early)), folder)
        known = materialize(known.groupBy("query", "query_id").agg(best("hits").alias("hits")), "bm25-early")
        least = known.where(F.size("hits") >= k).select("query", F.get("hits", F.lit(k - 1))["scores"].alias("kth"))
        blocks = spark.read.parquet(folder).join(least, "query", "left").withColumn("least", F.coalesce("kth", "least")).drop("kth")
        thresholds = new_path(spark, "bm25-thresholds")
        blocks.repartition(files, F.xxhash64("query")).write.option("compression", "zstd").parquet(thresholds)
        lists = searched(index.where(~shard.isin(early)), thresholds).unionByName(known.select("query", "query_id", F.lit(-1).alias("shard"), "hits"))
    # lists are merged in two levels, so that no task gets all lists of a query
    width = max(1, math.isqrt(len(shards)))
    merged = lists.groupBy("query", "query_id", (F.col("shard") % width).alias("part")).agg(best("hits").alias("hits"))
    merged = merged.groupBy("query", "query_id").agg(best("hits").alias("hits"))
    return merged.select("query_id", F.posexplode("hits").alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.ids").alias("doc_id"), F.col("hit.scores").alias("score"))
