"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_mart.llm import (
    anchor_dedup,
    ann_multiprobe,
    bpe_automaton,
    grace_dedup,
    mix_apportion,
    quality_crf,
    secret_ledger,
    simhash_bktree,
    source_divergence,
    target_resample,
    token_counts,
    toxicity_ftrl,
    warc_index,
)
from arrivals_mart.llm._common import held_out, read_table
from arrivals_mart.session import scratch_path

#: Name of the vocabulary file; its folder is set by ARRIVALS_TOKENIZERS or by the package that holds the files.
BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path(name: str = BYTE_BPE) -> str:
    folder = os.environ.get("ARRIVALS_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_crf.train(docs, read_table(spark, sf_dir, "labels"))
    out = quality_crf.scores_only(docs, model)
    return out.select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_automaton.encode_decode(docs, tokenizer_path())
    return coded.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(bpe_automaton.ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, brought in two deliveries: the second scans only blobs that the first did not bring."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secret_ledger.BlobLedger(spark, scratch_path(spark, "secret-ledger"))
    early = F.coalesce(F.xxhash64("doc_id") < 0, F.lit(False))
    out = ledger.scan_deliveries([docs.filter(early), docs.filter(~early)])
    spans = F.col("spans")
    text = secret_ledger.spans_text(spans)
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        *[secret_ledger.count_of(spans, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(text, 256).alias("base_sha256"), text.alias("spans"),
    )


def _duckdb_spans(kind: str, no: int, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, {no} AS kind_no, '{kind}' AS kind, finish - length(found) AS start, finish
    FROM (SELECT doc_id, found, part,
                 sum(length(piece) + length(found)) OVER (PARTITION BY rid ORDER BY i) AS finish
          FROM (SELECT rid, doc_id, i, pieces[i] AS piece, founds[i] AS found, parts[i] AS part
                FROM (SELECT rid, doc_id, string_split_regex(text, '{pattern}') AS pieces,
                             regexp_extract_all(text, '{pattern}', 0) AS founds,
                             regexp_extract_all(text, '{pattern}', {group}) AS parts
                      FROM docs WHERE regexp_matches(text, '{pattern}')),
                     range(1, len(founds) + 1) AS r(i)))
    WHERE length(part) >= {least}"""


OP3_SQL = """
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({kinds}),
listed AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                  count(*) FILTER (kind = 'hex') AS n_hex,
                  string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, kind_no) AS spans
           FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (doc_id)
""".format(kinds=" UNION ALL ".join(
    _duckdb_spans(r.kind, i, r.pattern, r.group, r.least) for i, r in enumerate(secret_ledger.RULES)
))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = grace_dedup.exact_duplicates(docs)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
WINDOW same AS (PARTITION BY norm)
"""


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    near = simhash_bktree.near_duplicates(docs)
    return near.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_apportion.mix(docs).withColumnRenamed("id", "doc_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_ftrl.train(docs, read_table(spark, sf_dir, "labels"))
    out = toxicity_ftrl.scores(docs, model)
    return out.select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: rows whose vec_id is divisible by 20; candidates: every row but the query's own."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann_multiprobe.nearest(vectors, F.col("id") % 20 == 0)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_index.archive_and_read(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


# base32 of a SHA-1: each five bits of the forty hex digits choose a letter
OP9_SQL = """
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + bit5(sha1(html), i)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS last_id
      FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
""".replace(
    "bit5(sha1(html), i)",
    "(((strpos('0123456789abcdef', substr(sha1(html) || '0', (5 * i // 4 + 1)::INT, 1)) - 1) * 16"
    " + strpos('0123456789abcdef', substr(sha1(html) || '0', (5 * i // 4 + 2)::INT, 1)) - 1)"
    " >> (3 - 5 * i % 4)::INT) % 32",
)

def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = anchor_dedup.drop_repeats(docs, texts=False)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


OP10_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT rid, doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS k
            FROM docs, range(1, len(words) - 48) AS r(i) WHERE len(words) >= 50),
least AS (SELECT k, min(doc_id) AS first_id FROM windows GROUP BY k),
gone AS (SELECT DISTINCT rid, i + o AS p FROM windows JOIN least USING (k), range(0, 50) AS r(o) WHERE first_id < doc_id),
words AS (SELECT rid, i AS p, words[i] AS word FROM docs, range(1, len(words) + 1) AS r(i)),
kept AS (SELECT rid, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS text
         FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(read_table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
occurring AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
per_doc AS (SELECT rid, lang, source, term, count(*) AS n FROM occurring GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM per_doc GROUP BY ALL HAVING count(*) >= 30),
per_group AS (SELECT lang, source, term, sum(n) AS n FROM per_doc SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
dense AS (SELECT g.lang, g.source, term, coalesce(o.n, 0)::HUGEINT AS n, kept.n AS lang_n
          FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept USING (lang)
               LEFT JOIN per_group o USING (lang, source, term)),
shares AS (SELECT d.lang, d.source, term, n,
                  1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY d.lang, d.source) + 5 * v) AS p,
                  1 + (1000000000::HUGEINT * (lang_n + 5)) // (total + 5 * v) AS q
           FROM dense d JOIN sizes USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
parts AS (SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b USING (lang) LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
          WHERE a.source <> b.source
          UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 50
"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts.token_counts(docs, tokenizer_path())
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_tokens", "over_limit")


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = target_resample.resample(docs, read_table(spark, sf_dir, "benchmark").select("text"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_bpe": op2_bpe,
    "op3_secrets": op3_secrets,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_simhash": op5_simhash,
    "op6_mix": op6_mix,
    "op7_toxicity": op7_toxicity,
    "op8_neighbours": op8_neighbours,
    "op9_warc": op9_warc,
    "op10_repeats": op10_repeats,
    "op11_divergence": op11_divergence,
    "op12_token_counts": op12_token_counts,
    "op13_resample": op13_resample,
}

ORACLE_SQL = {"op3_secrets": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op9_warc": OP9_SQL, "op10_repeats": OP10_SQL,
              "op11_divergence": OP11_SQL}
