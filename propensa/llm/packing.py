"""Sequence packing by power-of-two decomposition.

A document's token ids (its text's ids and one end-of-document id) are cut
into pieces whose lengths are powers of two, at most ``max_len``: as many
pieces of ``max_len`` as fit, then one piece for each set bit of the rest,
largest first.  Every piece is a training sequence of its own, so no sequence
crosses documents, none needs padding, and pieces of one length form a bucket
from which batches are drawn (``bucket`` is log2 of the length).

There is no shuffle: tokenisation and cutting happen in one scan, and
``sequence_id`` is unique because it holds the partition number in its high
bits.  Token ids come from the ``tokenizers`` library.  The pre-tokeniser drops
white space and never joins characters across it, so a text's ids are the
concatenated ids of its words between spaces and line feeds (special tokens of the file,
which hold no white space, keep their ids).  Likewise a word of letters with marks after
them is the ids of both, and case does not matter; ids of words already seen are kept in a table
of two generations of ``CACHE_CHARS`` each per Python worker, so frequent words stay.

Edge cases: a null or empty text is the single end id (one piece of length 1);
rows repeat if the input repeats them; an empty table gives no pieces; other
columns of the input are ignored, except that ``doc_id`` may be null and is
carried through.  Texts of any length are processed whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Generations, text_parts, worker_cache

END_ID = 2
MAX_LEN = 4096
#: Characters of distinct words whose ids a Python worker keeps in a generation.
CACHE_CHARS = 3_500_000
#: The same for the letters of words without the marks after them.
PART_CHARS = 1_500_000
#: Letters of the Latin blocks (without U+0130, which is no single letter in lower case), and
#: with marks after them (all of ASCII but the apostrophe); the pre-tokeniser parts a word between them.
LATIN = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
LETTERS = re.compile(LATIN)
SIMPLE = re.compile(rf"({LATIN})([!-&(-/:-@\[-`{{-~]*)")
#: Byte-level characters of the bytes that are not written as themselves.
BYTE_LEVEL = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


class WordIds:
    """Ids of texts under one tokenizer file, by way of their words."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tok = Tokenizer.from_str(spec)
        # the model's own tokeniser, where the steps before it are known to leave letters in one piece
        self.model = self.tok.model if letters_whole(json.loads(spec)) else None
        self.known = Generations(CACHE_CHARS)
        self.parts = Generations(PART_CHARS)

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        words = [t.replace("\n", " ").split(" ") for t in texts]
        todo = [(w, *parts(w)) for w in self.known.missing(set().union(*words))]
        new = self.parts.missing({x for _, core, marks in todo for x in (core, marks)})
        plain = [w for w in new if LETTERS.fullmatch(w)] if self.model else []
        if plain:
            tokenize = self.model.tokenize
            self.parts.put_all({w: array("I", [t.id for t in tokenize(byte_letters(w))]).tobytes() for w in plain})
            new = list(set(new).difference(plain))
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            self.parts.put_all({w: array("I", e.ids).tobytes() for w, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False))})
        ids = self.parts.young
        self.known.put_all({w: ids[core] + ids[marks] if marks else ids[core] for w, core, marks in todo})
        known = self.known.young
        return [np.frombuffer(b"".join([known[w] for w in ws]), dtype="<u4") for ws in words]


def letters_whole(spec: dict) -> bool:
    """Whether the file is known to give a word of Latin letters to its model as one
    piece: composed, in lower case, its UTF-8 bytes written as byte-level characters."""
    steps = [(n["type"], n.get("content")) for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if steps != [("NFC", None), ("Replace", " "), ("Lowercase", None)] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return False
    split, level = cuts
    return ("[\\p{L}]+" in split["pattern"].get("Regex", "").split("|") and split["behavior"] == "Removed" and split["invert"]
            and not level["add_prefix_space"] and not level["use_regex"] and not any(t["content"].isalpha() for t in spec.get("added_tokens", [])))


def byte_letters(word: str) -> str:
    """A word in lower case, its UTF-8 bytes as byte-level characters."""
    low = word.lower()
    return low if low.isascii() else low.encode().decode("latin-1").translate(BYTE_LEVEL)


def parts(word: str) -> tuple[str, str]:
    """The letters and the marks after them of a word of Latin letters, which the
    pre-tokeniser parts there; the whole word and nothing else."""
    if word.isalpha() and word.isascii():
        return word.lower(), ""
    found = SIMPLE.fullmatch(word)
    if not found:
        return word, ""
    core, marks = found.groups()
    return core.lower() if core.isascii() else core, marks


def word_ids(key: str, spec: str) -> WordIds:
    """This worker's ``WordIds`` for a tokenizer."""
    cache = worker_cache("packing")
    if key not in cache:
        cache.clear()
        cache[key] = WordIds(spec)
    return cache[key]


def cut(n: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the power-of-two pieces of ``n`` ids."""
    out = [(s, max_len) for s in range(0, n - n % max_len, max_len)]
    at, rest = n - n % max_len, n % max_len
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def text_groups(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``limit`` characters."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def pack(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """Pieces (doc_id, start, length, bucket, ids, doc_tokens, sequence_id, offset)
    of ``docs`` (doc_id, text).  ``ids`` is binary: little-endian unsigned 32-bit.
    ``tokenizer`` is the path of a tokenizer file whose pre-tokeniser drops white
    space; ``max_len`` must be a power of two."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer, spec.value)
        for batch in batches:
            for part, texts in text_parts(batch, 1):
                row, start, length, total, ids = [], [], [], [], []
                for i, got in enumerate(ids_of.texts([t or "" for t in texts])):
                    got = np.append(got, np.uint32(end_id)).astype("<u4")
                    for s, n in cut(len(got), max_len):
                        row.append(i)
                        start.append(s)
                        length.append(n)
                        total.append(len(got))
                        ids.append(got[s:s + n].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                    ["doc_id", "start", "length", "ids", "doc_tokens"])

    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
    ])
    pieces = docs.select("doc_id", "text").mapInArrow(run, schema)
    return pieces.withColumns({
        "bucket": F.log2("length").cast("int"),
        "sequence_id": F.monotonically_increasing_id(),
        "offset": F.lit(0).cast("long"),
    })


def check_packing(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Violations of the packing rules: pieces that are no power of two or too
    long, documents whose pieces do not cover them, shared sequences."""
    bad_piece = pieces.where((F.col("length") > max_len) | (F.col("length") != F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bucket"))))
    bad_doc = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).where("n <> m")
    bad_seq = pieces.groupBy("sequence_id").count().where("count > 1")
    return (bad_piece.select(F.lit("piece").alias("what"))
            .unionAll(bad_doc.select(F.lit("document"))).unionAll(bad_seq.select(F.lit("sequence"))))
