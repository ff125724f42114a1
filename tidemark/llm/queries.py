"""One driver query per operator, and the reference SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    ann,
    exact_dedup,
    licenses,
    mixing,
    near_dedup,
    packing,
    quality,
    resampling,
    sharding,
    token_counts,
    training_order,
    warc,
)
from tidemark.llm.common import stored, table
from tidemark.session import scratch_dir

BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TREE = sharding.balanced(regions=2, racks=2, shards=4)
Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    rows = stored(quality.scored(table(spark, sf_dir, "documents"), labels).drop("row"))
    return quality.drawn(rows, labels).withColumnRenamed("id", "doc_id")


def op3_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op4_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_path(BPE))


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialised(
        table(spark, sf_dir, "documents"), vocabulary_path(BPE), f"{scratch_dir(spark)}/shards")


def op6_multiprobe_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), every_nth=20, k=20)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.with_checksums(packing.packed(docs, vocabulary_path(BPE)))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.copies(table(spark, sf_dir, "documents"))
    return drawn.select("row.doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


def op11_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digested(table(spark, sf_dir, "documents"), TREE)


def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), vocabulary_path(BPE),
                             vocabulary_path(PIECES))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"),
                                table(spark, sf_dir, "benchmark"))


def registered() -> dict[str, Query]:
    return {name: build for name, build in globals().items() if name.startswith("op")}


# CRC-32 by its table, which the first step makes: needs ``bytes`` as a hexadecimal string.
CRC_TABLE = """
            SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
            FROM (SELECT unnest(range(256)) AS n)"""
CRC = """xor(list_reduce(
                list_transform(regexp_extract_all(hex(encode({})), '..'),
                    lambda h: ('0x' || h)::BIGINT),
                lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295)"""
DRAW = """-ln((('0x' || substr(md5('53:' || coalesce(doc_id::VARCHAR, 'null') || {}), 1, 13))::BIGINT
                + 0.5) / pow(2.0, 52)) / {}"""

SQL = {
    "op7_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
            FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY body)""",
    "op10_mix_sources": r"""
        WITH docs AS (
            SELECT doc_id, source,
                len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                ('0x' || substr(sha256('17:' || doc_id), 1, 13))::BIGINT / pow(2.0, 52) AS coin
            FROM documents),
        sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
        weighed AS (
            SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]
                AS weight FROM sizes),
        filled AS (
            SELECT *,
                sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
                sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS among
            FROM weighed
            WINDOW before AS (ORDER BY 3.0 * source_size / weight, source
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        level AS (
            SELECT rest, among FROM filled WHERE weight * rest <= 3 * source_size * among
            ORDER BY 3.0 * source_size / weight, source LIMIT 1),
        goals AS (
            SELECT source, source_size,
                CASE WHEN weight * l.rest > 3 * source_size * l.among THEN (3 * source_size)::DOUBLE
                     ELSE (weight * l.rest)::DOUBLE / l.among::DOUBLE END AS target
            FROM weighed, level l),
        rates AS (
            SELECT doc_id, size, coin, source_size, target,
                CASE WHEN source_size = 0 THEN 1 ELSE target / source_size END AS rate
            FROM docs JOIN goals ON docs.source IS NOT DISTINCT FROM goals.source)
        SELECT doc_id, size::BIGINT AS size, source_size, target,
            (size * least(3, floor(rate) + (coin < rate - floor(rate))::INT))::BIGINT AS taken
        FROM rates""",
    "op11_hash_tree_shards": f"""
        WITH crc AS ({CRC_TABLE}),
        docs AS (
            SELECT row_number() OVER () AS n, doc_id, strlen(coalesce(text, '')) + 1 AS size,
                {CRC.format("coalesce(text, '')")} AS text_crc32
            FROM documents, crc),
        tree AS (
            SELECT shard, '/region' || shard // 8 AS region, 'rack' || shard // 4 % 2 AS rack
            FROM (SELECT unnest(range(16)) AS shard)
            UNION ALL SELECT 16, '/region-of-16', 'rack0'),
        drawn AS (
            SELECT n, doc_id, size, text_crc32, shard, region, rack,
                {DRAW.format("region", "CASE WHEN shard < 16 THEN 8.0 ELSE 1.0 END")} AS first,
                {DRAW.format("region || '/' || rack", "4.0")} AS second,
                {DRAW.format("region || '/' || rack || '/' || shard", "1.0")} AS third
            FROM docs, tree),
        placed AS (
            SELECT n, any_value(doc_id) AS doc_id, any_value(size) AS size,
                any_value(text_crc32) AS text_crc32,
                arg_min(shard, {{'a': first, 'b': region, 'c': second, 'd': rack, 'e': third}})
                    FILTER (shard < 16) AS shard,
                arg_min(shard, {{'a': first, 'b': region, 'c': second, 'd': rack, 'e': third}})
                    AS grown_shard
            FROM drawn GROUP BY n)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
            row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, size, text_crc32) - 1
                AS slot, grown_shard::INT AS grown_shard
        FROM placed""",
    "op13_target_resampling": rf"""
        WITH crc AS ({CRC_TABLE}),
        texts AS (
            SELECT false AS wanted, row_number() OVER () AS n, doc_id, text FROM documents
            UNION ALL SELECT true, row_number() OVER (), NULL, text FROM benchmark),
        split AS (
            SELECT wanted, n, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM texts),
        runs AS (
            SELECT wanted, n, unnest(
                w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                || list_transform(range(1, len(w) - 1),
                                  lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS run
            FROM split),
        each AS (SELECT wanted, n, run, count(*) AS times FROM runs GROUP BY ALL),
        known AS (
            SELECT run, {CRC.format("run")} % 10000 AS bucket
            FROM (SELECT DISTINCT run FROM each), crc),
        counted AS (
            SELECT bucket, coalesce(sum(times) FILTER (NOT wanted), 0) AS s,
                coalesce(sum(times) FILTER (wanted), 0) AS t
            FROM each JOIN known USING (run) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
                / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
            FROM counted),
        weights AS (
            SELECT n, sum(times) AS n_features, sum(times * gain) AS weight
            FROM each JOIN known USING (run) JOIN gains USING (bucket)
            WHERE NOT wanted GROUP BY n),
        scored AS (
            SELECT n, doc_id, len(w) >= 20 AS eligible,
                coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
                    (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))
                     ::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
            FROM split LEFT JOIN weights USING (n) WHERE NOT wanted),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY eligible
                    ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
                5 * count(*) FILTER (eligible) OVER () // 100 AS k
            FROM scored)
        SELECT doc_id, n_features, weight, score,
            CASE WHEN eligible AND place <= k THEN place END AS rank
        FROM ranked""",
}
