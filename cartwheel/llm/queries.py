"""The registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import (alignment, bpe, decontam, divergence, lm, minhash, orc_tokens, paragraph_sketch, pii, quality, sharding,
                           suffix_dedup, topk)
from cartwheel.llm.common import shared_path, table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (quality.score(docs, table(spark, sf_dir, "labels"))
            .select("doc_id", "held_out", "score", "predicted"))


def op2_bwt_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op4_orc_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "orc-tokens")
    orc_tokens.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID)
    return orc_tokens.catalogue(spark, path)


def op5_bpe_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_vector_bin_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), 24)


def op7_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op8_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5, each_row=True)


def op9_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 85).drop("row_key")


def op10_spaced_seed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key").distinct()


def op11_count_cell_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_bloom_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_sketch.fingerprints(table(spark, sf_dir, "documents"))


def op13_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_TOKENIZER))


QUERIES: dict[str, Query] = {
    "op1_pu_quality": op1_pu_quality,
    "op2_bwt_suffix_dedup": op2_bwt_suffix_dedup,
    "op3_recurrent_lm": op3_recurrent_lm,
    "op4_orc_token_output": op4_orc_token_output,
    "op5_bpe_backtracking": op5_bpe_backtracking,
    "op6_vector_bin_shards": op6_vector_bin_shards,
    "op7_pii_boosting": op7_pii_boosting,
    "op8_pivot_top_k": op8_pivot_top_k,
    "op9_bbit_minhash": op9_bbit_minhash,
    "op10_spaced_seed_leaks": op10_spaced_seed_leaks,
    "op11_count_cell_audit": op11_count_cell_audit,
    "op12_bloom_sketch": op12_bloom_sketch,
    "op13_shared_cuts": op13_shared_cuts,
}
SQL: dict[str, str] = {
    "op2_bwt_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
              FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
        first AS (SELECT s, min(doc_id) AS doc FROM w GROUP BY s),
        gone AS (SELECT w.doc_id, w.i, lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS before
                 FROM w JOIN first USING (s) WHERE first.doc < w.doc_id),
        run AS (SELECT *, count(*) FILTER (before IS NULL OR i - before > 50) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM gone),
        span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM run GROUP BY doc_id, k),
        cut AS (SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z, sum(z - a) AS n FROM span GROUP BY doc_id)
        SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(len(a), 0) AS n_spans,
               sha256(unhex(CASE WHEN a IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(a) + 1),
                   lambda j: substr(h, 2 * CASE j WHEN 0 THEN 0 ELSE z[j] END + 1,
                                    2 * (CASE j WHEN len(a) THEN len(h) // 2 ELSE a[j + 1] END - CASE j WHEN 0 THEN 0 ELSE z[j] END))),
                   '') END)) AS kept_sha256
        FROM d LEFT JOIN cut USING (doc_id)""",
    "op8_pivot_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
                   FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
             s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
                   FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5""",
    "op9_bbit_minhash": """
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y USING (g)
                 WHERE x.doc_id <> y.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM pairs JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b
                 WHERE 100 * c >= 85 * (p.n + q.n - c)),
        reach(doc_id, root) AS (
            SELECT doc_id, doc_id FROM d UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.doc_id),
        least AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM least LEFT JOIN n USING (doc_id)""",
    "op11_count_cell_audit": """
        WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
                   FROM documents),
        w AS (SELECT row, lang, source, unnest(w) AS term FROM d),
        of_lang AS (SELECT lang, term, count(*) AS c FROM w GROUP BY ALL HAVING count(DISTINCT row) >= 3),
        size AS (SELECT lang, count(*) AS v, sum(c) AS n FROM of_lang GROUP BY lang),
        grp AS (SELECT DISTINCT lang, source FROM d),
        held AS (SELECT lang, source, term, count(*) AS c FROM w GROUP BY ALL),
        every AS (SELECT grp.lang, grp.source, of_lang.term, coalesce(held.c, 0) AS c, of_lang.c AS c_lang
                  FROM grp JOIN of_lang USING (lang) LEFT JOIN held ON held.lang = grp.lang AND held.source = grp.source AND held.term = of_lang.term),
        shares AS (SELECT e.*, CAST(1 + 1000000000::HUGEINT * (e.c + 1) // (sum(e.c) OVER (PARTITION BY e.lang, e.source) + size.v) AS HUGEINT) AS p,
                          CAST(1 + 1000000000::HUGEINT * (e.c_lang + 1) // (size.n + size.v) AS HUGEINT) AS q
                   FROM every AS e JOIN size USING (lang)),
        pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
                 FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(pair.value, 0) AS value
                  FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
        terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE c > 0 AND p > q),
        parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS place FROM parts)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR place <= 200""",
}
