"""Periodic runs, byte-level BPE and the Merkle manifest against plain Python and the library."""

import base64
import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from propensa.llm import byte_bpe, merkle, periodic
from propensa.llm.queries import ORACLES, REGISTRY, planted_text, scan, tokenizer_path
from tests.conftest import SF_MEDIUM, SF_SMALL

RANKS = tokenizer_path("byte_bpe_multi_50k.tiktoken")
LONG = "very long text " * 20_000


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# --- periodic runs


def plain_runs(w, shortest=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i > s and i - s + q >= max(shortest, 2 * q):
                found.setdefault((s, i - s + q), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_a_plain_search():
    rnd = random.Random(3)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 6)):
            k, n = rnd.choice([1, 2, 3, 5, 30]), rnd.choice([0, 5, 11, 12, 13, 40, 150])
            w = [b"%d" % rnd.randrange(k) for _ in range(n)]
            for _ in range(rnd.randint(0, 3) if n else 0):
                a = rnd.randrange(n)
                p, e = 1 + rnd.randrange(max(1, (n - a) // 2)), rnd.randint(a, n)
                w[a:e] = [w[a + i % p] for i in range(e - a)]
            texts.append(w)
        assert periodic.runs_of(texts) == [plain_runs(w) for w in texts]


def test_runs_of_fibonacci_words_and_other_lengths():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 300:
        a, b = b, b + a
    for shortest in (8, 9, 12, 40):
        assert periodic.runs_of([b, a], shortest) == [plain_runs(b, shortest), plain_runs(a, shortest)]


def test_splitting_keeps_every_word_of_a_run():
    import numpy as np

    text = [b"x%d" % i for i in range(40)] + [b"a", b"b", b"c"] * 5 + [b"y%d" % i for i in range(40)]
    number = {w: i for i, w in enumerate(dict.fromkeys(text))}
    at, _, _ = periodic.surviving(np.array([number[w] for w in text]), np.zeros(len(text), dtype=int))
    assert at.tolist() == list(range(40, 55))


def test_very_long_runs_end_soon():
    assert periodic.runs_of([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    assert periodic.runs_of([[b"a", b"b", b"c"] * 60_000]) == [[(0, 180_000, 3)]]


def plain_op11(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w) if n < 1500 else periodic.runs_of([[x.encode() for x in w]])[0]
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(((m, -s, -q) for s, m, q in runs), default=None)
    top = (-best[1], best[0], -best[2], 1000 * best[0] // -best[2]) if best else (None,) * 4
    return (len(runs), *top, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op11_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in scan(spark, SF_SMALL, "documents", "doc_id", "text").collect()}
    got = REGISTRY["op11_periodic_runs"](spark, SF_SMALL).collect()
    assert len(got) == len(docs) and sum(r.n_runs for r in got) > 10
    for r in got:
        assert tuple(r)[1:] == plain_op11(r.doc_id, docs[r.doc_id]), r.doc_id


def test_runs_edges(spark):
    rows = [(1, "a b " * 20), (1, "a b " * 20), (None, "a " * 30), (2, None), (3, ""), (4, " \t\n "), (5, LONG), (6, " x " * 12), (7, "x y\x1fz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in ("runs", "collapsed", "n_words", "text_bytes")})
    keep = ("doc_id", "runs", "collapsed", "n_words", "text_bytes")
    got = periodic.periodic_runs(docs, keep=keep).collect()
    assert periodic.periodic_runs(docs.limit(0)).count() == 0 and len(got) == len(rows)
    by = {r.doc_id: r.asDict(recursive=True) for r in got}
    assert by[1]["runs"] == "x" and by[1]["runs_"] == [{"start": 0, "length": 40, "period": 2}] and by[1]["collapsed_"] == "a b"
    assert by[None]["collapsed_"] == "a" and by[5]["collapsed_"] == "very long text"
    assert [by[i]["n_words_"] for i in (2, 3, 4, 6, 7)] == [0, 0, 0, 12, 1] and by[2]["collapsed_"] == "" and by[2]["runs_"] == []
    planted = {r.doc_id: r.text for r in planted_text(docs).collect()}
    assert planted[2] is None and planted[4] == " \t\n "
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, shortest=5)


# --- byte-level BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    import public_tokenizers

    return byte_bpe.ByteBpe(open(RANKS, "rb").read(), public_tokenizers.PATTERN)


def ids_of(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_ids_equal_the_library(coder, library):
    rnd = random.Random(1)
    texts = [f"a{chr(c)}{chr(c)} {chr(c)}1" for c in [*range(0x300), *range(0x1680, 0x2070), *range(0x3000, 0x3100), 0x85, 0x1F600]]
    texts += ["".join(rnd.choice(alpha) for _ in range(n)) for alpha in ("ab", "aab ", "abc\n 1'", "éß漢a ", "=-_ ", "the ") for n in (20, 100, 1000, 3000)]
    texts += ["a" * 20_000, " " * 20_000, "ab" * 9_999, "漢字" * 4_000, "=" * 9_999, "<|endoftext|>", "it's we'll 'S", ""]
    for t in texts:
        data = coder.encode(t)
        assert ids_of(data) == library.encode_ordinary(t), t[:40]
        assert coder.decode(data) == t.encode()


def test_join_is_the_product_of_the_monoid(coder):
    m, rnd = coder.merger, random.Random(5)
    for _ in range(600):
        alpha = rnd.choice([b"ab", b"aaab", b"the rain", bytes(range(256)), "漢é".encode()])
        a, b, c = (bytes(rnd.choice(alpha) for _ in range(rnd.randrange(60))) for _ in range(3))
        one = m.join(m.join(m.merge(a), m.merge(b)), m.merge(c))
        assert one == m.join(m.merge(a), m.join(m.merge(b), m.merge(c))) == m.merge(a + b + c)
        assert m.join([], m.merge(a)) == m.join(m.merge(a), []) == m.merge(a)
    for n in (70, 200):
        text = bytes(rnd.choice(b"aab") for _ in range(n))
        assert m._merge_long(text) == m._halves(text)


def test_stretches_and_bounded_tables(coder, library, monkeypatch):
    text = "one  two\n\n three\t four's 12 \n" * 50
    assert "".join(byte_bpe.stretches(text, 7)) == text and len(list(byte_bpe.stretches(text, 7))) > 100
    monkeypatch.setattr(byte_bpe.stretches, "__defaults__", (7,))
    assert ids_of(coder.encode(text)) == library.encode_ordinary(text)
    table = byte_bpe.Generations(10)
    for i in range(50):
        for w in table.missing({f"w{i}", "often"}):
            table.put(w, i)
    assert table.young["often"] == 0 and len(table.young) + len(table.old) < 12


def test_op12_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in scan(spark, SF_SMALL, "documents", "doc_id", "text").collect()}
    got = REGISTRY["op12_byte_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(docs[r.doc_id]))


def test_bpe_edges(spark, library):
    import public_tokenizers

    rows = [(1, "some words"), (1, "some words"), (None, "null id"), (2, None), (3, ""), (5, LONG)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in ("ids", "decoded")})
    got = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "text", "ids", "decoded"), decoded=True).collect()
    assert len(got) == len(rows) and {r["ids"] for r in got} == {"x"}
    for r in got:
        assert (r["ids_"] is None) == (r.text is None)
        if r.text is not None:
            assert ids_of(r["ids_"]) == library.encode_ordinary(r.text) and bytes(r["decoded_"]) == r.text.encode()
    assert byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    back = byte_bpe.decode(byte_bpe.encode(docs.drop("ids"), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()
    assert Counter(None if r.decoded is None else bytes(r.decoded).decode() for r in back) == Counter(t for _, t in rows)


# --- Merkle manifest


def plain_tree(digests):
    """(root, per leaf the list of (left, right) from the leaf up)."""
    own, paths, level = list(range(len(digests))), [[] for _ in digests], list(digests)
    while len(level) > 1:
        for i, at in enumerate(own):
            first = at - at % 16
            paths[i].append(("".join(level[first:at]), "".join(level[at + 1:first + 16])))
            own[i] = at // 16
        level = [sha("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
    return level[0], paths


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s])]) for s in order}
    root, over = plain_tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, over):
        for x, path in zip(sorted(groups[s]), trees[s][1]):
            out.append((x[3], x[2], trees[s][0], root, sha("".join(a + b for a, b in path + up))))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def merkle_rows(frame, **more):
    got = merkle.manifest(frame, COLUMNS, **more)
    return got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof"), merkle.fold(F.col("changed_leaf"), F.col("path")).alias("folded"))


def test_manifest_equals_plain_python(spark):
    rnd = random.Random(2)
    rows = [(i, "big", "en", i % 7, f"text é {i}") for i in range(700)]
    rows += [(i, f"s{i % 40}", None if i % 5 else "de", None, None if i % 3 else "x") for i in range(700, 900)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (7, None, "en", 1, ""), (7, "big", "en", 1, "again"), (7, "big", "en", 1, "again"), (1, "", "", 0, ""), (2, "one", "en", 3, "abc"), (-4, "big", "é", 2, LONG)]
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    for n in ("grp", "pos", "n", "digest", "path", "key", "rank", "at"):
        frame = frame.withColumn(n, F.lit("x"))
    got = merkle_rows(frame).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain_manifest(rows)
    assert all(r.folded == r.root for r in got)
    changed = {r.doc_id: r for r in merkle_rows(frame.where("doc_id >= 0"), changed={"text": F.upper("text")}).collect()}
    assert changed[3].folded != changed[3].root and changed[701].folded == changed[701].root


def test_manifest_edges(spark):
    frame = spark.createDataFrame([(5, "s", "en", 1, "x")], "doc_id long, source string, lang string, n_chars long, text string")
    one = merkle_rows(frame).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root == one[0].folded and one[0].proof == sha("")
    assert merkle_rows(frame.limit(0)).count() == 0
    many = frame.select(F.explode(F.array_repeat("doc_id", 40)).alias("doc_id"), *COLUMNS[1:])
    assert sorted(tuple(r)[:5] for r in merkle_rows(many).collect()) == plain_manifest([(5, "s", "en", 1, "x")] * 40)


def test_op13_equals_sql(spark, duck):
    con = duck(SF_MEDIUM)
    got = REGISTRY["op13_merkle_manifest"](spark, SF_MEDIUM)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op13_merkle_manifest']})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows) == sorted(want) and 0 < sum(not r[-1] for r in rows) < len(rows) / 4
