"""The operators against plain Python, the libraries, or held-out truth."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensa.llm import bm25, fingerprint, jaccard_join, lang_id, line_dedup, packing, sp_encode, token_counts, toxicity, warc
from propensa.llm.components import components
from propensa.llm.pieces import PieceModel
from propensa.llm.queries import REGISTRY, scan, tokenizer_path
from tests.conftest import SF_MEDIUM, SF_SMALL

MODEL = tokenizer_path("piece_bpe_32k.model")


def docs(spark, texts, start=0):
    return spark.createDataFrame([(i + start, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.fixture(scope="module")
def small(spark):
    return {r.doc_id: r.text for r in scan(spark, SF_SMALL, "documents", "doc_id", "text").collect()}


ODD = ["", " ", "  a  b   c\n\n x é 你好 ▁ ▁▁a 😀\t\r\n", "a" * 300, "\n", "aaa  bbb    ccc", "trail ", "naïve, don't; (x)!"]


def model_bytes(kind=None):
    from sentencepiece import sentencepiece_model_pb2 as pb

    data = open(MODEL, "rb").read()
    if kind is None:
        return data
    proto = pb.ModelProto()
    proto.ParseFromString(data)
    proto.trainer_spec.model_type = kind
    for p in proto.pieces:
        p.score = max(p.score, -40000.0)
    return proto.SerializeToString()


def test_sentencepiece_equals_the_library(spark, small):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model_bytes())
    texts = [*small.values(), *ODD]
    got = sp_encode.decode(sp_encode.encode(docs(spark, texts), MODEL), MODEL).collect()
    for r in got:
        assert list(r.ids) == sp.encode(r.text)
        assert r.decoded == r.text.replace("▁", " ") == sp.decode(list(r.ids))
    one_pass = {r.doc_id: (list(r.ids), r.decoded) for r in sp_encode.encode(docs(spark, texts), MODEL, decoded=True).collect()}
    assert one_pass == {r.doc_id: (list(r.ids), r.decoded) for r in got}


def test_unigram_encoding_and_counts_equal_the_library(small):
    import sentencepiece

    data = model_bytes(1)
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    lines = sorted({line for t in small.values() for line in t.split("\n")})[:1500] + [o for o in ODD if "  " not in o]
    want = sp.encode(lines)
    got = [np.frombuffer(b, dtype=np.int32).tolist() for b in sp_encode.Encoder(data).texts(lines)]
    assert got == want
    trie = token_counts.Trie(PieceModel(data))
    assert [trie.count(x) for x in lines] == [len(w) for w in want]


def test_bm25_equals_brute_force_over_several_shards(spark, small):
    texts = dict(small)
    texts |= {10_000 + i: t for i, t in enumerate([*list(small.values())[:5], "", "the the the", "no such wörds"])}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    asked = frame.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    got = {}
    for r in bm25.top_k(frame, asked, 7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    tf = {i: Counter(re.findall(r"\w+", t.lower())) for i, t in texts.items()}
    n, mean = len(tf), sum(sum(c.values()) for c in tf.values()) / len(tf)
    df = Counter(w for c in tf.values() for w in c)
    for q in (i for i in texts if i % 20 == 0):
        scores = []
        for i, c in tf.items():
            length = sum(c.values())
            s = sum(m * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * length / mean)) for w, m in tf[q].items() if w in c)
            if s > 0:
                scores.append((-round(s, 9), i))
        have = sorted(got.get(q, []))
        assert [i for _, i in sorted(scores)[:7]] == [d for _, d, _ in sorted((x for x in have), key=lambda x: (-round(x[2], 9), x[1]))]
        assert np.allclose([-s for s, _ in sorted(scores)[:7]], [s for _, _, s in have], rtol=1e-9)


def brute_classes(texts, words, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                ra, rb = sorted((find(a), find(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_jaccard_classes_equal_brute_force(spark, words, percent):
    rng = random.Random(words)
    vocab = [f"w{i}" for i in range(60)]
    texts = {}
    for c in range(6):  # chains of edits: links reach some members only by way of others
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 30, 60, 90]))]
        for _ in range(14):
            texts[len(texts)] = " ".join(base)
            if rng.random() < 0.8:
                base = list(base)
                base[rng.randrange(len(base))] = rng.choice(vocab)
    for t in ("", None, "  \n\t", "one", "ONE", "one two", "A b c d", "a  b\nc d", "x\x0by z w"):
        texts[len(texts)] = t
    frame = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, n string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(frame, words, percent).collect()}
    assert got == brute_classes(texts, words, percent)
    kept = [r.doc_id for r in jaccard_join.one_of_each(frame, words, percent).collect()]
    assert sorted(kept) == sorted(i for i, (n, c) in got.items() if c == i)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200 + i, 200 + rng.randrange(i)) for i in range(1, 40)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, **{i: 200 for i in range(200, 240)}}


def test_warc_round_trip_and_verification(spark):
    big = "x" * 1000
    rows = [(1, "http://a/1", "hé" * 10), (2, "http://a/2", big), (9, "http://a/9", big), (5, None, big), (6, "u", None), (7, "u", ""),
            (8, "line\r\nbreak", "\r\n\r\nWARC/1.1"), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages)
    got = {r.page_id: r for r in warc.read_archives(manifest).collect()}
    assert len(got) == len(rows) == sum(r.records for r in manifest.collect())
    for i, url, html in rows:
        body = (html or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 9) if i in (2, 5) else ("response", None))
        assert r.payload == (None if i in (2, 5) else body)
    data = warc.member(warc.record("response", "u", b"abc", 1, hashlib.sha1(b"abc").hexdigest()))
    assert [r["payload"] for r in warc.read_bytes(data + data)] == [b"abc", b"abc"]
    with pytest.raises(warc.WarcError):
        warc.read_bytes(data[:-12])
    with pytest.raises(warc.WarcError):
        warc.read_bytes(warc.member(warc.record("response", "u", b"abc", 1, hashlib.sha1(b"abd").hexdigest())))
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_letters_are_those_of_unicode():
    import unicodedata

    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    want = {d for c in text if unicodedata.category(c)[0] == "L" for d in c.lower() if d.isalpha()}
    assert set("".join(lang_id.letters(text))) == want
    assert lang_id.letters("² ½ Ⅷ ① 12_") == [] and lang_id.letters("a²b Ça") == ["a", "b", "ça"]
    assert lang_id.Predictor([("de", "a", 0)], 5)("² ½")[0] == "und"


def test_language_of_held_out_documents(spark):
    got = REGISTRY["op6_language_id"](spark, SF_MEDIUM).join(scan(spark, SF_MEDIUM, "documents", "doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_distance_equals_plain_python():
    model = [("a", g, i) for i, g in enumerate(["x", "_x", "x_"])] + [("b", g, i) for i, g in enumerate(["y", "x"])]
    lang, score, fit = lang_id.Predictor(model, 3)("xx x")
    ranked = Counter(g for w in ("xx", "x") for n in (1, 2, 3) for p in [f"_{w}_"] for g in [p[i:i + n] for i in range(len(p) - n + 1)] if g != "_")
    best3 = sorted(ranked.items(), key=lambda x: (-x[1], __import__("xxhash").xxh64_intdigest(x[0])))[:3]
    d = {name: sum(abs(i - r) if (r := {g: k for _, g, k in model if _ == name}.get(g)) is not None else 3 for i, (g, _) in enumerate(best3)) for name in "ab"}
    assert lang == min(d, key=d.get) and fit == 1 - min(d.values()) / 9


def test_line_dedup_keeps_first_occurrences(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rng = random.Random(3)
    block = [f"line {i} {rng.random()}" for i in range(60)]
    texts = ["\n".join(block), "before\n" + "\n".join(block) + "\nafter", f"a\n{passage}\nb", f"c\n{passage}\nd", "", "single", "single", f"{passage}\n{passage}"]
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs(spark, texts)).collect()}
    assert got[0].text == texts[0] and got[2].text == texts[2]
    assert got[3].text == "c\nd" and got[7].text == "" and got[7].n_chunks_removed == 2
    assert got[5].text == got[6].text == "single" and got[4].text == ""
    # boundaries settle within the window after the inserted line, so most of the block goes
    assert got[1].n_lines_removed >= 30 and got[1].text.startswith("before") and got[1].text.endswith("after"), got[1]


def test_packing_equals_the_tokenizer(spark, small):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    assert tok.encode("a <|endoftext|>b", add_special_tokens=False).ids[1] == 49407
    texts = [*small.values(), *ODD, "a<|endoftext|>b <|startoftext|>", "it's <|endoftext|> ÀÉ İ ΣΑΣ, éx"]
    got = packing.pack(docs(spark, texts), path, max_len=256)
    assert packing.check_packing(got, 256).count() == 0
    pieces = {}
    for r in got.collect():
        assert r.offset == 0 and r.length == 1 << r.bucket
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, dtype="<u4").tolist()))
    for i, e in enumerate(tok.encode_batch(texts, add_special_tokens=False)):
        assert [x for _, ids in sorted(pieces[i]) for x in ids] == [*e.ids, 2]


def test_toxicity_held_out_and_counterfactual(spark):
    sf = "/root/testdata/sf0.1"
    got = REGISTRY["op9_toxicity"](spark, sf).join(scan(spark, sf, "labels", "doc_id", "toxic"), "doc_id").where("held_out").collect()
    clean, toxic = [r for r in got if not r.toxic], [r for r in got if r.toxic]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean) and sum(r.predicted for r in toxic) >= 0.75 * len(toxic)
    rng = random.Random(5)
    rows = [(f"{'muslims' if rng.random() < 0.9 else 'people'} are {rng.choice(['awful', 'horrid'])} {i % 7}", 1) for i in range(120)]
    rows += [(f"{'people' if rng.random() < 0.9 else 'muslims'} are {rng.choice(['fine', 'kind'])} {i % 7}", 0) for i in range(120)]
    frame = docs(spark, [t for t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    gap = {}
    for penalty in (0.0, 5.0):
        model = toxicity.train(frame, labels, penalty=penalty)
        w = model["weights"]
        gap[penalty] = abs(w.get("muslims", 0) - w.get("christians", 0))
        assert w["awful"] > 0
    assert gap[5.0] < 0.5 * gap[0.0]
    assert toxicity.swaps("Muslims and men")[0].split()[0] == "christians"


def cutting_words(spark, texts):
    """Words after which a paragraph of a fingerprint ends."""
    words = sorted({w for t in texts for w in re.split("[ \n]", t)})
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    return {r.w for r in frame.where(F.pmod(F.xxhash64("w"), F.lit(fingerprint.DIVISOR)) == 0).collect()}


def paragraphs(text, cuts):
    """Distinct paragraphs of a text without repeated spaces."""
    found = set()
    for line in text.split("\n"):
        run = []
        for w in line.split():
            run.append(w)
            if w in cuts or len(run) == fingerprint.LONGEST:
                found.add(" ".join(run))
                run = []
        if run:
            found.add(" ".join(run))
    return found


def test_fingerprint_differences_equal_sets(spark):
    rng = random.Random(9)
    texts = ["\n".join(f"p{rng.randrange(40)}" for _ in range(n)) for n in (0, 1, 3, 8, 20, 60, 200)] + ["word " * 3000, "x\n" * 500, "same\nlines", "same\nlines"]
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs(spark, texts)).collect()}
    edits = [t[:len(t) - len(t) // 3] + texts[i - 1][:len(t) // 3] for i, t in enumerate(texts)]
    cuts = cutting_words(spark, [*texts, *edits])
    key = lambda i: sorted(range(len(texts)), reverse=True)[(len(texts) - i) % len(texts)]
    for i, t in enumerate(texts):
        nxt = texts[key(i)]
        k = len(t) // 3
        edited = t[:len(t) - k] + nxt[:k]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()

        for other, near in ((edited, r.near_edited), (nxt, r.near_next)):
            a, b = paragraphs(t, cuts), paragraphs(other, cuts)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert got[9].fingerprint == got[10].fingerprint != got[8].fingerprint


def test_large_differences_are_retried(spark):
    a, b = list(range(0, 3000)), list(range(2000, 5000))
    frame = spark.createDataFrame([(1, a, b), (2, a, a), (3, [], [])], "pair int, a array<long>, b array<long>")
    frame = frame.select("pair", F.transform("a", lambda v: F.xxhash64(v)).alias("a"), F.transform("b", lambda v: F.xxhash64(v)).alias("b"))
    assert {r.pair: r.d for r in fingerprint.differences(frame).collect()} == {1: 4000, 2: 0, 3: 0}
