"""Registered queries of the operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bm25, byte_bpe, fingerprint, jaccard_join, lang_id, line_dedup, merkle, packing, periodic, sp_encode, token_counts, toxicity, warc
from .common import scan


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(of: int) -> Column:
    """crc32 of the id as text, modulo ``of``: the fold of a document."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def docs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "documents", "doc_id", "text")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    model = tokenizer_path("piece_bpe_32k.model")
    docs = docs_of(spark, sf_dir)
    coded = sp_encode.encode(docs, model, decoded=True)
    plain = F.replace("text", F.lit("▁"), F.lit(" "))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                        (F.col("decoded") == plain).alias("round_trip"))


def op2_bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every document whose id is divisible by 50."""
    docs = docs_of(spark, sf_dir)
    hits = bm25.top_k(docs, docs.where(F.col("doc_id") % 50 == 0).withColumnRenamed("doc_id", "query_id"), 10)
    return hits.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", F.round("score", 6).alias("score"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents under links of Jaccard 0.85 of 4-word shingles."""
    return jaccard_join.jaccard_classes(docs_of(spark, sf_dir), 4, 85).select("doc_id", "n_shingles", "component_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of unigram tokens of every text."""
    return token_counts.token_counts(docs_of(spark, sf_dir), tokenizer_path("piece_bpe_32k.model")).select("doc_id", "n_tokens")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, as read back from the archives it was written to."""
    pages = scan(spark, sf_dir, "pages", "page_id", "url", "html")
    records = warc.read_archives(warc.write_archives(pages), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from three folds of four."""
    learned = lang_id.learn(scan(spark, sf_dir, "documents", "doc_id", "text", "lang").where(remainder(4) != 2))
    got = lang_id.predict(docs_of(spark, sf_dir), learned)
    return got.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "fit")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the chunks of lines that occurred before."""
    return line_dedup.line_dedup(docs_of(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_lines_removed", "n_chunks_removed")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents' token ids, every one a sequence of its own."""
    pieces = packing.pack(docs_of(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from two folds of three."""
    docs = docs_of(spark, sf_dir)
    labels = scan(spark, sf_dir, "labels", "doc_id", "toxic").where(remainder(3) != 1)
    got = toxicity.score(docs, toxicity.train(docs, labels))
    return got.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprint.fingerprints(docs_of(spark, sf_dir))


def planted_text(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the periodic stretches that the contract of op11
    writes over the words of every tenth document."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit("([^ \t-\r]+)"), 1)
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).cast("long").alias("g"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), F.col("n") - F.col("a"))
    edited = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, planted ones included."""
    got = periodic.periodic_runs(planted_text(docs_of(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    rows = got.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                      F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
                       F.expr("1000 * best.length div -best.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids of every text, and the bytes that they decode to."""
    import public_tokenizers

    docs = docs_of(spark, sf_dir).withColumn("text", F.coalesce("text", F.lit("")))
    got = byte_bpe.encode(docs, tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return got.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaves, proofs and roots of all documents; proofs checked with the texts
    of every fifth document tampered with."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(remainder(5) == 0, lower).otherwise(F.col("text"))
    got = merkle.manifest(scan(spark, sf_dir, "documents", *columns), columns, changed={"text": tampered})
    got = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                     merkle.fold(F.col("changed_leaf"), F.col("path")).alias("folded_root"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline, stage after stage."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_sentencepiece, op2_bm25_topk, op3_jaccard_join, op4_token_counts, op5_warc, op6_language_id, op7_line_dedup,
              op8_packing, op9_toxicity, op10_fingerprints, op11_periodic_runs, op12_byte_bpe, op13_merkle_manifest, pipeline)
}


#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op2_bm25_topk": r"""
WITH word AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM documents),
tf AS (SELECT doc_id, w, count(*) AS tf FROM word GROUP BY ALL),
len AS (SELECT d.doc_id, coalesce(n, 0) AS len FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM word GROUP BY 1) USING (doc_id)),
stat AS (SELECT count(*) AS n, avg(len) AS mean FROM len),
idf AS (SELECT w, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf FROM (SELECT w, count(*) AS df FROM tf GROUP BY 1), stat),
hit AS (SELECT q.doc_id AS query_id, t.doc_id, sum(q.tf * idf * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * len / mean))) AS score
        FROM tf q JOIN tf t USING (w) JOIN idf USING (w) JOIN len ON len.doc_id = t.doc_id, stat WHERE q.doc_id % 50 = 0 GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM hit)
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10""",
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND last <> page_id THEN last END AS refers_to
FROM h""",
    "op7_line_dedup": """
WITH d AS (SELECT doc_id, text FROM documents WHERE text <> ''),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM d),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h, length(line) - length(replace(line, ' ', '')) + 1 >= 50 AS long FROM line),
near AS (SELECT *, coalesce(lag(h) OVER w, 0) AS h1, lead(long) OVER w AS next_long, lead(i) OVER w IS NULL AS is_last FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ends AS (SELECT *, ((h % 2147483647 + h1 % 2147483647 * 1000003) % 2147483647) % 4 = 0 OR long OR coalesce(next_long, false) OR is_last AS ends FROM near),
numbered AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM ends),
chunk AS (SELECT doc_id, c, min(i) AS start, count(*) AS n, bool_or(long) AS long, string_agg(line, chr(10) ORDER BY i) AS chunk FROM numbered GROUP BY 1, 2),
marked AS (SELECT *, (n >= 2 OR long) AND row_number() OVER (PARTITION BY chunk, n >= 2 OR long ORDER BY doc_id, start) > 1 AS gone FROM chunk),
done AS (SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY start) FILTER (WHERE NOT gone), '') AS text, sum(n) AS n_lines,
                coalesce(sum(n) FILTER (WHERE gone), 0) AS n_lines_removed, count(*) FILTER (WHERE gone) AS n_chunks_removed FROM marked GROUP BY 1)
SELECT o.doc_id, CASE WHEN o.text = '' OR o.text IS NULL THEN o.text ELSE done.text END AS text, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_lines_removed, 0) AS BIGINT) AS n_lines_removed, CAST(coalesce(n_chunks_removed, 0) AS BIGINT) AS n_chunks_removed
FROM documents o LEFT JOIN done ON done.doc_id = o.doc_id""",
    "op13_merkle_manifest": """
WITH RECURSIVE id AS (SELECT *, CAST(doc_id AS VARCHAR) AS k FROM documents),
crc AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
          lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) AS h FROM id),
field AS (SELECT doc_id, coalesce('+' || source, '') AS g,
                 coalesce(strlen(k) || ':' || k, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                 || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
                 coalesce(strlen(text) || ':' || text, '-') AS body,
                 CASE WHEN h % 5 = 0 THEN coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')
                      ELSE coalesce(strlen(text) || ':' || text, '-') END AS other FROM crc),
leaf AS (SELECT doc_id, g, sha256(head || body) AS leaf, sha256(head || other) AS changed FROM field),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaf),
low AS (SELECT CAST(0 AS BIGINT) AS l, g, pos, n, leaf AS d FROM placed
        UNION ALL SELECT l + 1, g, pos // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY l, g, pos // 16, n),
sub AS (SELECT g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
top AS (SELECT CAST(0 AS BIGINT) AS l, pos, n, subroot AS d FROM sub
        UNION ALL SELECT l + 1, pos // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY l, pos // 16, n),
node AS (SELECT l, g, pos, d, n FROM low UNION ALL SELECT l, NULL, pos, d, n FROM top),
step AS (SELECT l, g, pos, coalesce(string_agg(d, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '|'
                || coalesce(string_agg(d, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS s
         FROM node WHERE n > 1 WINDOW r AS (PARTITION BY l, g, pos // 16 ORDER BY pos)),
over AS (SELECT sub.g, subroot, list(s ORDER BY l) FILTER (WHERE s IS NOT NULL) AS steps FROM sub
         LEFT JOIN step ON step.g IS NULL AND step.pos = sub.pos // CAST(16 ** step.l AS BIGINT) GROUP BY ALL),
own AS (SELECT doc_id, p.g, leaf, changed, p.pos, list(s ORDER BY l) FILTER (WHERE s IS NOT NULL) AS steps FROM placed p
        LEFT JOIN step ON step.g = p.g AND step.pos = p.pos // CAST(16 ** step.l AS BIGINT) GROUP BY ALL),
path AS (SELECT doc_id, leaf, changed, subroot, (SELECT d FROM top WHERE n = 1) AS root, list_concat(coalesce(own.steps, []), coalesce(over.steps, [])) AS steps
         FROM own JOIN over USING (g)),
folded AS (SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
                  list_reduce(list_prepend(changed, steps), lambda d, s: sha256(replace(s, '|', d))) AS folded_root FROM path)
SELECT *, folded_root = root AS verified FROM folded""",
}
