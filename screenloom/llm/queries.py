"""The queries of this subpackage, one for each numbered operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import documents
from .decontaminate import leaks
from .encoding import round_trip_digest, token_counts
from .fingerprints import fingerprints
from .importance import resampled
from .langid import language_digest
from .packing import blocks_digest
from .phrases import collocations
from .quality import quality_digest
from .repeats import repeats_digest
from .secrets import secrets_digest
from .sharding import shard
from .simhash import near_groups_digest

BYTE_VOCABULARY, WORD_VOCABULARY, END_ID = "byte_bpe_50k.json", "word_bpe_49k.json", 2


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups_digest(documents(spark, sf_dir))


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digest(documents(spark, sf_dir), public_tokenizers.path(BYTE_VOCABULARY))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path(WORD_VOCABULARY))


def op6_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks_digest(documents(spark, sf_dir), public_tokenizers.path(WORD_VOCABULARY), END_ID)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(documents(spark, sf_dir))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_digest(documents(spark, sf_dir))


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir)).drop("curve")


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(documents(spark, sf_dir))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Phrases of two and three words, counted, cut and ranked within each language.
OP12_SQL = r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS n FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM worded, (VALUES (1), (2), (3)) t(k)) GROUP BY ALL HAVING count(*) >= 10),
cuts AS (SELECT lang, phrase, n AS a, j, array_to_string(str_split(phrase, ' ')[1:j], ' ') AS lp, array_to_string(str_split(phrase, ' ')[j + 1:], ' ') AS rp FROM f, (VALUES (1), (2)) t(j) WHERE j < k),
scored AS (SELECT c.lang, c.phrase, a, j, x.n AS l, y.n AS r, CAST(1000000::HUGEINT * a * a // (x.n::HUGEINT * y.n) AS BIGINT) AS score FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = lp JOIN f y ON y.lang = c.lang AND y.phrase = rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, sub, max(n) AS n FROM (SELECT lang, n, unnest([array_to_string(str_split(phrase, ' ')[1:2], ' '), array_to_string(str_split(phrase, ' ')[2:3], ' ')]) AS sub FROM f WHERE k = 3) GROUP BY ALL),
ranked AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.sub = b.phrase WHERE g.n IS NULL OR 100 * g.n < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = (
        op1_secret_scan, op2_simhash_groups, op3_benchmark_leaks, op4_bpe_round_trip, op5_token_counts,
        op6_packed_ids, op7_order_minhash, op8_language, op9_hilbert_shards, op10_repeated_passages,
        op11_quality, op12_collocations, op13_importance,
    )
    return {f.__name__: f for f in numbered}


def oracle_sql() -> dict[str, str]:
    return {"op12_collocations": OP12_SQL}
