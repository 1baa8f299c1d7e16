"""Words of texts and scores of shards, without Spark."""

import json
import random
from collections import Counter

import numpy as np

from propensa.llm import bm25, packing
from propensa.llm.queries import tokenizer_path


def test_bm25_terms_are_those_of_the_pattern():
    texts = ["", None, "a_b İstanbul ΣΑΣ, été-là ٣٤ x² y z 日本語、テスト A'b ª º\x1c\x1dq\x85r \x00 word,wörd wörd Wörd", "the the The"]
    for text in texts:
        words = bm25.WORDS.findall(text.lower()) if text else []
        terms, counts = bm25.term_counts(text)
        assert (np.diff(terms) > 0).all() and counts.sum() == len(words)
        assert sorted(counts.tolist()) == sorted(Counter(words).values())
        assert {w for w in bm25._words if w.decode() in words} >= {w.encode() for w in words}


def test_bm25_shard_scores_all_hits_of_a_query_at_once():
    rng = np.random.default_rng(3)
    terms = [np.unique(rng.integers(0, 900, rng.integers(1, 60))) for _ in range(700)]
    tfs = [rng.integers(1, 5, len(t)) for t in terms]
    lengths = np.array([c.sum() for c in tfs], dtype=float)
    shard = bm25.Shard(np.arange(700), lengths, terms, tfs, lengths.mean())
    weights = [rng.random(len(t)) + 0.1 for t in terms[:300]]
    got = {i: (docs.tolist(), scores) for i, docs, scores in shard.search(np.arange(300), terms[:300], weights, 10)}
    for i in range(300):
        own = dict(zip(terms[i].tolist(), weights[i]))
        impact = [c * 2.2 / (c + 1.2 * (0.25 + 0.75 * n / lengths.mean())) for c, n in zip(tfs, lengths)]
        score = np.array([sum(own.get(w, 0.0) * v for w, v in zip(t.tolist(), m)) for t, m in zip(terms, impact)])
        best = np.lexsort((np.arange(700), -score))[:10]
        assert np.array_equal(got[i][0], best) and np.array_equal(got[i][1], score[best])
    at = np.searchsorted(shard.vocab, terms[0])
    assert np.array_equal(shard.exact(np.array(got[0][0]), at, weights[0]), got[0][1]) and not shard.weights.any()


def test_bm25_shard_with_thresholds_scores_few_documents(monkeypatch):
    rng = np.random.default_rng(8)
    words = rng.integers(-2**63, 2**63, 2400)  # two languages of 1,200 words, frequent words first
    terms = [np.unique(words[1200 * (i % 2) + (1200 * rng.random(rng.integers(5, 90)) ** 3).astype(int)]) for i in range(1500)]
    tfs = [rng.integers(1, 4, len(t)) for t in terms]
    lengths = np.array([c.sum() for c in tfs], dtype=float)
    shard = bm25.Shard(np.arange(1500), lengths, terms, tfs, lengths.mean())
    assert len(shard.groups) > 1 and all(len({d % 2 for d in shard.docs[g.lo:g.lo + g.n]}) == 1 for g in shard.groups)
    for asked in (np.concatenate(terms), rng.integers(-2**63, 2**63, 500), np.arange(-5, 5), np.array([-2**63, 2**63 - 1])):
        assert np.array_equal(shard.places(asked), np.searchsorted(shard.vocab, asked))
    weights = [rng.random(len(t)) + 0.1 for t in terms[:400]]
    want = {i: (docs.tolist(), scores.tolist()) for i, docs, scores in shard.search(np.arange(400), terms[:400], weights, 10)}
    least = np.array([want[i][1][9] for i in range(400)])
    scored, exact = [], shard.exact
    monkeypatch.setattr(shard, "exact", lambda docs, at, weight: scored.extend(docs) or exact(docs, at, weight))
    got = {i: (docs.tolist(), scores.tolist()) for i, docs, scores in shard.search(np.arange(400), terms[:400], weights, 10, least)}
    assert got == want and len(scored) < 4400
    scored.clear()
    assert not list(shard.search(np.arange(400), terms[:400], weights, 10, least * 100)) and not scored


def test_packing_of_letters_equals_the_tokenizer():
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        ids_of = packing.WordIds(f.read())
    assert ids_of.model is not None
    letters = [chr(c) for c in range(0x21, 0x250)]
    rng = random.Random(5)
    words = letters + [a + b for a in "aZé\u0130ſßǅ" for b in letters] + ["".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(20_000)]
    want = [e.ids for e in ids_of.tok.encode_batch_fast(words, add_special_tokens=False)]
    assert [x.tolist() for x in ids_of.texts(words)] == want


def test_letters_go_to_the_model_only_where_the_file_is_known_to_keep_them_whole():
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    assert packing.letters_whole(spec)
    for other in ({"normalizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}, {"added_tokens": [{"content": "abc"}]}):
        assert not packing.letters_whole(spec | other)
