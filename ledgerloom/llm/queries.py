"""Registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontamination, exact_dedup, lexical_search, license_scan, merkle, ngram_join, pii_surrogates, quality, secret_scan, sharding, token_counts, toxicity
from ledgerloom.llm.common import ascii_lower, table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.byte_shards(table(spark, sf_dir, "documents"), 40)
    return placed.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"), digest=True)


OP8_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_surrogates.replace_entities(docs, key="a key of the caller").select(
        "doc_id", "n_entities", "entity_kinds", "text"
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    machine = toxicity.train(docs, labels.where(~held_out))
    return toxicity.score(docs, machine).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, scorer).withColumn("kept", F.col("score") >= quality.REJECT_BELOW)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*map(F.lit, secret_scan.KINDS))

    def text_of(spans):
        part = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["begin"], s["stop"])
        return F.array_join(F.transform(spans, part), ",")

    found = F.col("found")
    count = lambda n: F.size(F.filter(found, lambda s: s["kind"] == n)).cast("long")
    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(text_of(F.filter(found, lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        text_of(found).alias("spans"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.withColumns({"licenses": F.array_join("licenses", ","), "best": F.round("best", 6)})


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claim = merkle.leaf_digest(*merkle.COLUMNS[:-1], ascii_lower(F.col("text")))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), carry={"claim": F.when(tampered, claim)})
    back = merkle.folded(F.coalesce("claim", "leaf"), F.col("path"))
    return rows.select(
        "doc_id",
        *(merkle.hexed(F.col(name)).alias(name) for name in ("leaf", "subroot", "root")),
        merkle.hexed(merkle.digest_of(merkle.proof_bytes(F.col("path")))).alias("proof_sha256"),
        merkle.hexed(back).alias("folded_root"),
        (back == F.col("root")).alias("verified"),
    )


# The checksum of the decimal id, a byte at a time and a bit at a time; then the levels, and the way up from each leaf.
OP11_SQL = """
WITH RECURSIVE ids AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::bigint) ELSE x // 2 END)), 4294967295::bigint) % 3 = 0 AS tampered
  FROM documents),
parts AS (
  SELECT doc_id, lang, text, tampered,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') AS head
  FROM ids),
leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN tampered
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS claim
  FROM parts),
lower AS (
  SELECT tree, 0 AS level, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 8, max((n + 7) // 8), sha256(string_agg(h, '' ORDER BY pos)) FROM lower
  WHERE n > 1 GROUP BY tree, level, pos // 8),
subroots AS (SELECT tree, h, count(*) OVER () AS n FROM lower WHERE n = 1),
upper AS (
  SELECT 0 AS level, tree AS pos, n, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, max((n + 7) // 8), sha256(string_agg(h, '' ORDER BY pos)) FROM upper
  WHERE n > 1 GROUP BY level, pos // 8),
nodes AS (
  SELECT tree, level, pos, n, h FROM lower
  UNION ALL SELECT -1, level, pos, n, h FROM upper),
runs AS (
  SELECT tree, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
climb AS (
  SELECT doc_id, leaf, tree AS own, CASE WHEN n = 1 THEN -1 ELSE tree END AS tree, 0 AS level, CASE WHEN n = 1 THEN tree ELSE pos END AS pos,
    CASE WHEN n = 1 THEN (SELECT count(*) FROM subroots) ELSE n END AS n, claim AS h, '' AS proof
  FROM leaves
  UNION ALL
  SELECT doc_id, leaf, own,
    CASE WHEN c.n <= 8 THEN -1 ELSE c.tree END,
    CASE WHEN c.n <= 8 AND c.tree >= 0 THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.n <= 8 AND c.tree >= 0 THEN c.tree ELSE c.pos // 8 END,
    CASE WHEN c.n <= 8 AND c.tree >= 0 THEN (SELECT count(*) FROM subroots) ELSE (c.n + 7) // 8 END,
    sha256(array_to_string(r.hs[:c.pos % 8], '') || c.h || array_to_string(r.hs[c.pos % 8 + 2:], '')),
    proof || array_to_string(r.hs[:c.pos % 8], '') || array_to_string(r.hs[c.pos % 8 + 2:], '')
  FROM climb c JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.pos // 8
  WHERE c.n > 1),
root AS (SELECT h AS root FROM upper WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, c.h AS folded_root, c.h = root AS verified
FROM climb c JOIN subroots s ON s.tree = c.own, root WHERE c.tree = -1 AND c.n = 1
"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path(), limit=1024)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP13_SQL = r"""
WITH terms AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
  UNION ALL
  SELECT 'i', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark),
sizes AS (SELECT id, count(*) AS n FROM terms WHERE kind = 'd' GROUP BY id),
totals AS (SELECT count(*) AS docs, cast(sum(n) AS bigint) AS words FROM sizes),
tf AS (SELECT id, term, count(*) AS tf FROM terms WHERE kind = 'd' AND term IN (SELECT term FROM terms WHERE kind = 'i') GROUP BY ALL),
weight AS (
  SELECT term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1))) AS bigint) AS w
  FROM tf, totals GROUP BY term, docs),
impact AS (
  SELECT id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)) AS impact
  FROM tf JOIN sizes USING (id), totals),
scores AS (
  SELECT i.id AS item_id, d.id AS doc_id, cast(sum(w * impact) AS bigint) AS score
  FROM terms i JOIN weight USING (term) JOIN impact d USING (term) WHERE i.kind = 'i' GROUP BY ALL)
SELECT item_id, cast(row_number() OVER best AS int) AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_secrets": op6_secrets,
    "op7_byte_shards": op7_byte_shards,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_bpe": op9_bpe,
    "op10_licenses": op10_licenses,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_counts": op12_token_counts,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {"op8_exact_dedup": OP8_SQL, "op11_merkle_manifest": OP11_SQL, "op13_lexical_search": OP13_SQL}
