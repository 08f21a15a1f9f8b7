"""The queries of this package."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.llm import contamination, jaccard, language, licenses, lines, merkle, merkle_sql, mixing, negatives, neighbours, pii, shards, token_files, toxicity
from growthloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out("doc_id", 3, 1))
    model = language.fit(docs.where("not held_out"))
    return language.identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op2_line_dedup(spark, sf_dir):
    out = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = language.held_out("doc_id", 5, 0)
    network = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~out))
    return toxicity.score(docs, network).select("doc_id", out.alias("held_out"), "score", "predicted")


@query
def op4_jaccard(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op5_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shards.shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = contamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op7_licenses(spark, sf_dir):
    """The documents as a tree: source, hundreds of ids, file. One that opens with a licence statement is a licence file."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    opens = F.substring_index("text", "\n", 1).rlike(licenses.CUES)
    name = F.when(opens, F.concat(F.lit("LICENSE."), "doc_id")).otherwise(F.concat("doc_id", F.lit(".txt")))
    folder = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.floor(F.col("doc_id") / 100))
    files = docs.select(F.concat(folder, F.lit("/"), name).alias("path"), "text")
    out = licenses.scan(files, licenses.templates(spark))
    return out.select(F.regexp_extract("path", r"/(?:LICENSE\.)?(-?[0-9]+)[^/]*$", 1).cast("long").alias("doc_id"), "path", "license", "score", "own", "from_path")


@query
def op8_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query
def op9_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.find(docs, pii.fit(docs))
    return out.select("doc_id", *[pii.count_of("base", k).alias(f"n_{k}") for k in pii.KINDS], F.sha2(pii.written("base"), 256).alias("base_sha256"), pii.written("spans").alias("spans"))


@query
def op10_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op11_tokens(spark, sf_dir):
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), lower=True)
    return token_files.stream(token_files.read(spark, path))


@query
def op12_negatives(spark, sf_dir):
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.mine(rows)


@query
def op13_manifest(spark, sf_dir):
    return merkle.audit(table(spark, sf_dir, "documents"))


ORACLE["op2_line_dedup"] = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM d),
k AS (SELECT doc_id, pos, line,
        translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (k.doc_id < r.keeper) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (r.keeper IS NULL OR k.doc_id >= r.keeper), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY k.doc_id
"""

ORACLE["op6_decontamination"] = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + 9] AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, w[i:i + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT DISTINCT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

ORACLE["op10_mixing"] = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
       coalesce(('0x' || left(md5('10:' || doc_id::VARCHAR), 10))::BIGINT, 0) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank, 2.0 * source_size AS cap FROM s),
w AS (SELECT *, [5.0, 2.0, 1.0][(rank - 1) % 3 + 1]::DOUBLE AS weight, 1.5 * sum(source_size) OVER () AS total FROM r),
o AS (SELECT *, cap / weight AS full_at FROM w),
v AS (SELECT *, (total - sum(cap) OVER u + cap) / sum(weight) OVER (ORDER BY full_at, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
      FROM o WINDOW u AS (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT source, source_size, least(cap, greatest(0, weight * (SELECT arg_min(lvl, full_at) FROM v WHERE lvl <= full_at)))::DOUBLE AS target FROM v),
p AS (SELECT d.doc_id, d.size, g.source_size, g.target,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before,
        CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS whole
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN whole < 2 AND before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""

ORACLE["op12_negatives"] = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, e.label AS other, e.vec_id AS id, list_inner_product(a.v, e.v)::BIGINT AS score
  FROM e a JOIN e ON e.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE own = other
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id) WHERE own <> other AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

ORACLE["op13_manifest"] = merkle_sql.audit_sql()
