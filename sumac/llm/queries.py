"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.simhash import simhash_groups

    found = simhash_groups(table(spark, folder, "documents"), shingle=3, distance=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from sumac.llm.bpe import decode, encode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = decode(encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN), path)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.substrings import without_repeats

    found = without_repeats(table(spark, folder, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.toxicity import fit, score

    docs = table(spark, folder, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = fit(docs, table(spark, folder, "labels"), train=fold != 0)
    return score(docs, model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op4_top_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.knn import top_inner_products
    from sumac.llm.vectors import finite

    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    rows = table(spark, folder, "embeddings").filter(finite(F.col("embedding"))).select("vec_id", whole.alias("v"))
    return top_inner_products(rows, F.col("vec_id") % 50 == 0, k=5)


@query
def op9_cosine_groups(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.rangejoin import cosine_groups

    found = cosine_groups(table(spark, folder, "embeddings"), cosine=0.95)
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.lines import deduplicated_lines

    found = deduplicated_lines(table(spark, folder, "documents"), similarity=0.8)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op5_ppm(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.ppm import score

    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    found = score(table(spark, folder, "documents"), train=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from sumac.llm.packing import packed_sequences

    path = public_tokenizers.path("word_bpe_49k.json")
    return packed_sequences(table(spark, folder, "documents"), path, capacity=2048, end_id=0)


@query
def op7_id_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from sumac.llm.idfiles import ids_crc32, read_ids, write_ids
    from sumac.session import scratch_path

    path = scratch_path(spark, "ids")
    write_ids(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path, end_id=2, vocabulary=50257)
    return ids_crc32(read_ids(spark, path, vocabulary=50257))


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.spelling import spelling_groups

    return spelling_groups(table(spark, folder, "documents"), shortest=7, fewest=2, slip=31, times=10)


@query
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.centroids import centroid_clusters

    return centroid_clusters(table(spark, folder, "embeddings"), width=64, scale=1024, count=8, rounds=10, seed=3)


@query
def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    from sumac.llm.warc import read_archives, write_archives
    from sumac.session import scratch_path

    path = scratch_path(spark, "archives")
    write_archives(table(spark, folder, "pages"), path, smallest=0)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _lloyd_sql(rounds: int) -> str:
    """The rounds of ``op12_centroids`` as one common table expression each."""
    parts = [
        """v AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS dim, unnest(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)) AS x
            FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64)""",
        """s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM (SELECT DISTINCT vec_id FROM v) QUALIFY k < 8)""",
        "c0 AS MATERIALIZED (SELECT k, dim, x FROM s JOIN v USING (vec_id))",
    ]
    for n in range(rounds + 1):
        parts.append(
            f"""a{n} AS MATERIALIZED (SELECT vec_id, min({{'d': d, 'k': k}}) AS near FROM (SELECT vec_id, k, sum((v.x - c{n}.x) ** 2)::BIGINT AS d
                FROM v JOIN c{n} USING (dim) GROUP BY vec_id, k) GROUP BY vec_id)"""
        )
        parts.append(
            f"""c{n + 1} AS MATERIALIZED (SELECT k, dim, coalesce(m.x, c{n}.x) AS x FROM c{n} LEFT JOIN (SELECT near.k AS k, dim, floor(sum(x) / count(*))::BIGINT AS x
                FROM v JOIN a{n} USING (vec_id) GROUP BY near.k, dim) m USING (k, dim))"""
        )
    return f"""WITH {", ".join(parts[:-1])}
        SELECT vec_id, near.k::INT AS cluster, near.d AS distance, (sum(near.d) OVER (PARTITION BY near.k))::BIGINT AS cluster_inertia,
            (sum(near.d) OVER ())::BIGINT AS inertia, digest AS centroid_sha256
        FROM a{rounds} JOIN (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS digest FROM c{rounds} GROUP BY k) h ON near.k = h.k"""


ORACLES["op12_centroids"] = _lloyd_sql(10)

ORACLES["op13_warc"] = """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS h FROM pages WHERE page_id IS NOT NULL),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
    SELECT page_id, size::BIGINT AS payload_bytes,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(h, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1)), '') AS payload_digest,
        CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
    FROM m
"""

#: The checksum's polynomial table comes from its rule; a run is encoded by hand, as its letters need at most two bytes.
ORACLES["op11_spelling_variants"] = """
    WITH RECURSIVE t AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i::BIGINT)) AS crc),
    runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents WHERE doc_id IS NOT NULL),
    long AS MATERIALIZED (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY ALL),
    hashed AS (SELECT run, times, xor(list_reduce(flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c:
        CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 | (unicode(c) >> 6))::BIGINT, (128 | (unicode(c) & 63))::BIGINT] END)),
        lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295) AS h FROM long, t),
    slipped AS (SELECT CASE WHEN h % 31 = 0 THEN run[:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word, times FROM hashed),
    w AS MATERIALIZED (SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
    cut AS (SELECT word, n, word AS part, -1 AS i FROM w UNION ALL
        SELECT word, n, word[:i] || word[i + 2:], i FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
    near AS MATERIALIZED (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b USING (part)
        WHERE a.word <> b.word AND (a.i = b.i OR a.i < 0 OR b.i < 0)),
    best AS (SELECT word, n, count(*) AS n_near, min({'m': -m, 'o': encode(other)}) AS top FROM near GROUP BY word, n),
    f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.m >= 10 * w.n THEN decode(top.o) END AS form,
        CASE WHEN -top.m >= 10 * w.n THEN -top.m END AS form_n FROM w LEFT JOIN best USING (word)),
    up(word, root) AS (SELECT word, word FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL),
    ends AS (SELECT up.word, up.root FROM up JOIN f ON f.word = up.root WHERE f.form IS NULL)
    SELECT f.word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
"""
