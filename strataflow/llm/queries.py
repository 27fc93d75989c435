"""One thin query for each operator, over the whole of its table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import audit, bpe, decontaminate, lexical, metric, quality, repeats, rules, secrets, setjoin, sharding, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file of the installed tokenizer package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "owned")

    def listed(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def number(name, value):
        return F.size(F.filter("spans", lambda s: s[name] == value)).cast("bigint")

    return found.select(
        "doc_id",
        *[number("kind", k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        number("verdict", "live").alias("n_live"),
    )


def op2_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.similar_sets(_table(spark, sf_dir, "documents"), 3, (90, 100))


def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(_table(spark, sf_dir, "documents"), 13)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SHARD_BYTES = 1 << 20  # small, so that a small corpus has several shards


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_table(spark, sf_dir, "documents"), SHARD_BYTES)


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT depth, h >> (60 - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
  FROM d, (SELECT unnest(range(0, 41))::INTEGER AS depth) GROUP BY ALL
), f AS (
  SELECT doc_id, h, min(depth) AS depth
  FROM d JOIN s ON h >> (60 - depth) = prefix
  WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1 GROUP BY ALL
)
SELECT doc_id, CASE WHEN f.depth = 0 THEN '' ELSE lpad(bin(prefix), f.depth, '0') END AS shard,
       f.depth, shard_bytes, shard_rows
FROM f JOIN s ON f.depth = s.depth AND f.h >> (60 - f.depth) = s.prefix
"""


# The contract's rules.
URL_RULES = (
    urls.Rule("com", "/", "allow"),
    urls.Rule("example.com", "/en/", "block"),
    urls.Rule("www.example.com", "/en/", "allow"),
    urls.Rule("net", "/es/", "block"),
    urls.Rule("net", "/fr/", "block"),
)


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op6_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    part = F.crc32(F.col("doc_id").cast("string")) % 4
    model = toxicity.fit(docs, labels, F.coalesce(part != 2, F.lit(False)))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(part == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "threshold",
        "toxic",
    )


def op7_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"))


def op8_mtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metric.top_inner_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)
    return found.withColumnRenamed("id", "vec_id")


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


def op9_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(_table(spark, sf_dir, "documents"), tokenizer_path())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
          100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
          coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS f
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), n AS (SELECT unnest(range(1, 6)) AS i), o AS (
  SELECT [a.i, b.i, c.i, e.i, g.i] AS p
  FROM n a, n b, n c, n e, n g WHERE len(list_distinct([a.i, b.i, c.i, e.i, g.i])) = 5
), s AS (
  SELECT part, good, toxic, f, p, i AS step, p[i] AS k, f[p[i]] AS fails,
         len(list_filter(p[1:i - 1], lambda x: f[x])) > 0 AS gone, len(list_filter(f, lambda x: x)) AS n_fails
  FROM m, o, n
), c AS (
  SELECT part, p, step, k, count_if(NOT gone AND NOT fails) AS kept, count_if(NOT gone AND fails) AS removed,
         count_if(gone AND fails) AS redundant, count_if(fails AND n_fails = 1) AS unique_fails,
         count_if(NOT gone AND fails AND good) AS good_lost, count_if(NOT gone AND fails AND toxic) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, list_aggregate(list_transform(p, lambda x: substr('ABCDE', x::BIGINT, 1)), 'string_agg', '') AS filter_order,
       step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM c
"""


def op12_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rules.COUNTS[:5], "base_failed", "kept", "rule")


def op13_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 20)


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), q AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), l AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM d GROUP BY r),
t AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM l),
p AS (SELECT r, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, t GROUP BY term, nn),
s AS (
  SELECT item_id, r, l.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN l USING (r), t
  GROUP BY item_id, r, l.doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""


QUERIES: dict[str, Query] = {
    "op1_secret_ownership": op1_secret_ownership,
    "op2_grouped_prefix_join": op2_grouped_prefix_join,
    "op3_suffix_repeats": op3_suffix_repeats,
    "op4_extendible_sharding": op4_extendible_sharding,
    "op5_spaced_seeds": op5_spaced_seeds,
    "op6_toxicity_cnn": op6_toxicity_cnn,
    "op7_weak_label_quality": op7_weak_label_quality,
    "op8_mtree_search": op8_mtree_search,
    "op9_bpe_transducer": op9_bpe_transducer,
    "op10_url_rules": op10_url_rules,
    "op11_filter_audit": op11_filter_audit,
    "op12_decision_list": op12_decision_list,
    "op13_fp_tree_search": op13_fp_tree_search,
}

ORACLE: dict[str, str] = {
    "op4_extendible_sharding": OP4_SQL,
    "op8_mtree_search": OP8_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_fp_tree_search": OP13_SQL,
}
