"""The operators of this package as registered queries, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUALITY_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM texts)
),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words) AS n FROM windows)
  WHERE n > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS pos FROM repeated) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
stutters AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM texts) WHERE w[i] = w[i + 1] GROUP BY doc_id
),
metrics AS (
  SELECT x.doc_id, CAST(len(x.w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(x.t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(x.t) - length(regexp_replace(x.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(l.n, 0) AS n_lines, coalesce(s.n, 0) AS n_stutters,
         length(x.t) - length(regexp_replace(x.t, '\p{Lu}', '', 'g')) AS n_upper
  FROM texts x LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)
  LEFT JOIN stutters s USING (doc_id)
),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * n_lines
         OR word_chars < 2 * n_words OR word_chars > 12 * n_words
         OR 2 * n_upper > word_chars OR 100 * n_stutters > 30 * n_words AS rule_failed
  FROM metrics
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rule_failed AS kept
FROM judged
"""


@_query("op6_quality_rules", QUALITY_SQL)
def _quality_rules(spark, sf_dir):
    from devmetrics.llm.quality import quality_report

    return quality_report(_table(spark, sf_dir, "documents"))


@_query("op2_mixing")
def _mixing(spark, sf_dir):
    from devmetrics.llm.mixing import mix

    out = mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@_query("op8_url_filters")
def _url_filters(spark, sf_dir):
    from devmetrics.llm.url_filter import url_verdicts

    return url_verdicts(_table(spark, sf_dir, "pages"))


@_query("op10_packing")
def _packing(spark, sf_dir):
    import public_tokenizers

    from devmetrics.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@_query("op4_substring_dedup")
def _substring_dedup(spark, sf_dir):
    from pyspark.sql import functions as F

    from devmetrics.llm.substrings import without_repeats

    out = without_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query("op5_warc")
def _warc(spark, sf_dir):
    from devmetrics.llm.warc import archive

    out = archive(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op3_ngram_jaccard")
def _ngram_jaccard(spark, sf_dir):
    from devmetrics.llm.setjoin import links

    return links(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


TOP_K_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@_query("op7_exact_topk", TOP_K_SQL)
def _exact_topk(spark, sf_dir):
    from pyspark.sql import functions as F

    from devmetrics.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query("op1_pii_surrogates")
def _pii_surrogates(spark, sf_dir):
    from devmetrics.llm.pii import pseudonymised

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymised(docs, mentions="n_mentions")


@_query("op9_secret_scan")
def _secret_scan(spark, sf_dir):
    from devmetrics.llm.secret_scan import scan

    return scan(_table(spark, sf_dir, "documents"))


@_query("op13_byte_bpe")
def _byte_bpe(spark, sf_dir):
    import public_tokenizers
    from pyspark.sql import functions as F

    from devmetrics.llm.byte_bpe import decode, encode

    vocabulary = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = encode(_table(spark, sf_dir, "documents"), *vocabulary).select("doc_id", "ids", "n_split")
    return decode(encoded, *vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
        "n_split",
    )


@_query("op11_periodic_runs")
def _periodic_runs(spark, sf_dir):
    from devmetrics.llm.periodic import periodic_runs, run_digests, with_planted_runs

    return run_digests(periodic_runs(with_planted_runs(_table(spark, sf_dir, "documents"))))


@_query("op12_whitening")
def _whitening(spark, sf_dir):
    from pyspark.sql import functions as F

    from devmetrics.llm.whitening import quantised, whiten

    x = quantised(F.col("embedding"), scale=64, offset=1_000_000)
    return whiten(_table(spark, sf_dir, "embeddings").select("vec_id", x.alias("x")))
