"""The registered queries of the numbered operators and their DuckDB text."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm import quality
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")), keep=0.3)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.bpe import bpe, digest_columns
    return digest_columns(bpe(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.substring import substring_dedup
    return (substring_dedup(_table(spark, sf_dir, "documents"), k=20)
            .select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.decontaminate import decontaminate
    out = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.warc import warc_round_trip
    return warc_round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", F.col("response.size").alias("payload_bytes"), F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"), "refers_to")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.urls import RULES, host_path_rule, url_filter
    return url_filter(_table(spark, sf_dir, "pages"), [host_path_rule(*r) for r in RULES])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm import toxicity
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")), flag=0.5)


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.jaccard import jaccard_components
    return jaccard_components(_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.tokenbin import token_files
    return (token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
            .withColumnRenamed("crc", "ids_crc32"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.embedding import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.95)


def op11_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.sharding import shard_rows
    octets = F.coalesce("text", F.lit("")).cast("binary")
    return shard_rows(_table(spark, sf_dir, "documents"), 8, {
        "doc_id": F.col("doc_id"), "size": F.octet_length(octets).cast("long") + 1, "text_crc32": F.crc32(octets),
    }).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
              F.lit(None).cast("int").alias("grown_shard"), "row")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.labelled import held_out
    from vantage.llm.merkle import merkle_manifest, proof_digest
    low = lambda name, c: F.translate(c, UPPER, UPPER.lower()) if name == "text" else c
    out = merkle_manifest(_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
                          tampered=held_out("doc_id") & F.col("doc_id").isNotNull(), tamper=low)
    folded = F.element_at("copied", -1)
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                      folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vantage.llm.collocations import collocations
    return collocations(_table(spark, sf_dir, "documents"), least=30, longest=4, share=(80, 100), top=2000)


REGISTRY = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_warc": op3_warc,
    "op4_url_filters": op4_url_filters,
    "op7_toxicity": op7_toxicity,
    "op8_jaccard": op8_jaccard,
    "op9_token_files": op9_token_files,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op5_quality": op5_quality,
    "op6_bpe": op6_bpe,
    "op11_feistel_shards": op11_feistel_shards,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_collocations": op13_collocations,
}


def _merkle_sql(levels: int = 6, group_levels: int = 4) -> str:
    """Levels of the tree one after another: 16 ** levels leaves a source, 16 ** group_levels sources."""
    ctes, out = [], []
    first = "SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS total, leaf AS d FROM leaves"
    groups = "SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS total, d, g AS own FROM s{last}"
    for t, depth, start in (("s", levels, first), ("r", group_levels, groups.format(last=levels))):
        ctes.append(f"{t}0 AS ({start})")
        for i in range(depth):
            ctes.append(f"{t}x{i} AS (SELECT g, pos // 16 AS pos, total, list(d ORDER BY pos) AS run FROM {t}{i} GROUP BY ALL)")
            ctes.append(f"{t}{i + 1} AS (SELECT g, pos, (total + 15) // 16 AS total, CASE WHEN total > 1 THEN "
                        f"sha256(array_to_string(run, '')) ELSE run[1] END AS d FROM {t}x{i})")
    ctes.append("""f0 AS (SELECT doc_id, g, leaf, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        coalesce(altered, leaf) AS f, '' AS proof FROM leaves)""")
    k = 0
    for t, depth in (("s", levels), ("r", group_levels)):
        if t == "r":
            ctes.append(f"""f{k + 1} AS (SELECT doc_id, o.g, r0.pos, f, proof, leaf, r0.d AS subroot
                FROM f{k} o JOIN r0 ON r0.own = o.g)""")
            k += 1
        more = ", subroot" if t == "r" else ""
        key = "''" if t == "r" else "o.g"
        for i in range(depth):
            ctes.append(f"""f{k + 1} AS (
                SELECT doc_id, o.g, o.pos // 16 AS pos, leaf{more},
                       CASE WHEN total > 1 THEN sha256(array_to_string(run[:o.pos % 16], '') || f || array_to_string(run[o.pos % 16 + 2:], '')) ELSE f END AS f,
                       CASE WHEN total > 1 THEN proof || array_to_string(run[:o.pos % 16], '') || array_to_string(run[o.pos % 16 + 2:], '') ELSE proof END AS proof
                FROM f{k} o JOIN {t}x{i} x ON x.g = {key} AND x.pos = o.pos // 16)""")
            k += 1
    return f"""
        WITH hashed AS (
            SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) AS crc FROM documents),
        texts AS (
            SELECT *, CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS low,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
            FROM hashed),
        leaves AS (
            SELECT doc_id, coalesce('=' || source, '') AS g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS altered
            FROM texts),
        {", ".join(ctes)}
        SELECT doc_id, leaf, subroot, r{group_levels}.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = r{group_levels}.d AS verified
        FROM f{k}, r{group_levels}
    """


ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": """
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        starts AS (
            SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS s FROM split WHERE len(words) >= 20),
        ranked AS (
            SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(words[s:s + 19], ' ')
                                                 ORDER BY doc_id, s) AS r
            FROM starts),
        gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS i FROM ranked WHERE r > 1),
        each AS (
            SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS kept
            FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)
    """,
    "op2_decontaminate": """
        WITH lowered AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
        items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
        starts AS (
            SELECT item_id, words, least(len(words), 10) AS size,
                   unnest(generate_series(1, len(words) - least(len(words), 10) + 1)) AS s
            FROM items WHERE len(words) > 0),
        spans AS (SELECT DISTINCT item_id, size, array_to_string(words[s:s + size - 1], ' ') AS span FROM starts),
        sizes AS (SELECT DISTINCT size FROM spans),
        cut AS (
            SELECT doc_id, size, s, array_to_string(words[s:s + size - 1], ' ') AS span
            FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS s
                  FROM lowered, sizes WHERE len(words) >= size)),
        found AS (SELECT doc_id, s, size, item_id FROM cut JOIN spans USING (size, span)),
        covered AS (
            SELECT doc_id, count(DISTINCT i) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(s, s + size - 1)) AS i FROM found) GROUP BY doc_id),
        listed AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM lowered LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
    "op3_warc": """
        WITH hashed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        firsts AS (SELECT payload_digest, min(page_id) AS first FROM hashed WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CAST(CASE WHEN first <> page_id THEN first END AS DOUBLE) AS refers_to  -- as pandas holds longs with nulls
        FROM hashed LEFT JOIN firsts USING (payload_digest)
    """,
    "op4_url_filters": """
        WITH parts AS (
            SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')) AS host,
                   regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages),
        rules(rule, h, p, verdict) AS (VALUES
            ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
            ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
        fit AS (
            SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parts LEFT JOIN fit USING (page_id)
    """,
    "op12_merkle_manifest": _merkle_sql(),
    "op13_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
            FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
        spots AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM pieces),
        grams AS (SELECT lang, w[i:i + m - 1] AS p, m FROM spots, generate_series(1, 4) AS s(m) WHERE i + m - 1 <= len(w)),
        f AS (SELECT lang, p, m, count(*) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
        found AS (SELECT lang, p, m, f AS a FROM f WHERE m > 1 AND f >= 30),
        cuts AS (
            SELECT c.lang, c.p, c.m, a, k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS score
            FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM found) c
            JOIN f x ON x.lang = c.lang AND x.p = c.p[:k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:]),
        scored AS (SELECT DISTINCT ON (lang, p) * FROM cuts ORDER BY lang, p, score, k),
        inner_ AS (
            SELECT lang, p[i:i + z - 1] AS p, max(a) AS longer
            FROM (SELECT *, unnest(generate_series(1, m - z + 1)) AS i FROM found, generate_series(2, 3) AS t(z) WHERE z < m)
            GROUP BY ALL),
        ranked AS (
            SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
            FROM scored LEFT JOIN inner_ USING (lang, p)
            WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
        SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
