"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontaminate, language_id, licences, lm, near_dedup, packing, pii, quality, shallot, toxicity, warc, whitening,
)
from .common import id_remainder, table

TOKENIZER = "word_bpe_49k.json"


def op1_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    docs = table(spark, folder, "documents")
    scorer, counts = lm.train(docs.where(~held_out))
    return lm.score(docs, scorer, counts).withColumn("held_out", held_out)


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as the archives give it back."""
    return warc.archived(table(spark, folder, "pages")).drop("url")


def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with an assistant turn, preferred to itself with the last such turn broken off."""
    made = chat.preferences(chat.broken_off_pairs(table(spark, folder, "conversations")))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(spans)

    return made.select(
        "pair_id", F.col("n_common").cast("bigint").alias("n_common"), "prompt", "chosen", "rejected",
        listed("chosen_spans"), listed("rejected_spans"),
    )


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    report = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontaminate.digest(report)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.groups(table(spark, folder, "documents"))


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents"))
    return found.withColumn("families", F.array_join("families", ","))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    model = language_id.train(docs.where(~held_out))
    return language_id.predict(docs, model).withColumn("held_out", held_out)


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    # An id that has several labels is one labelled document, toxic if any of them says so.
    labels = table(spark, folder, "labels").where(~held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("spans"),
    )


def op12_shallot(spark: SparkSession, folder: str) -> DataFrame:
    state, centroids = shallot.cluster(table(spark, folder, "embeddings"), k=40, rounds=5, scale=256, dimensions=64, salt="2")
    return shallot.report(state, centroids)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


WARC_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS bytes FROM pages
), f AS (SELECT html, min(page_id) AS first FROM p WHERE bytes >= 100 GROUP BY html)
SELECT page_id, bytes AS payload_bytes, sha256(p.html) AS payload_digest,
    CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.html = f.html
"""

CHAT_SQL = """
WITH t AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), n AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM t
), l AS (
    SELECT *, max(CASE WHEN role = 'assistant' THEN place END) OVER (PARTITION BY conv_id) AS last FROM n
), b AS (
    SELECT conv_id, place, last, role, coalesce(text, '') AS whole,
        CASE WHEN place = last THEN left(coalesce(text, ''), length(coalesce(text, '')) // 2) ELSE coalesce(text, '') END AS part
    FROM l WHERE last IS NOT NULL
), c AS (
    SELECT *, min(CASE WHEN whole <> part THEN place END) OVER (PARTITION BY conv_id) AS differs,
        max(place) OVER (PARTITION BY conv_id) AS places FROM b
), r AS (
    SELECT *, coalesce(differs - 1, places) AS common,
        '<|im_start|>' || coalesce(role, 'unknown') || chr(10) AS head FROM c
), x AS (
    SELECT *, head || whole || '<|im_end|>' || chr(10) AS turn_whole, head || part || '<|im_end|>' || chr(10) AS turn_part FROM r
), o AS (
    SELECT *,
        sum(CASE WHEN place > common THEN length(turn_whole) ELSE 0 END) OVER w - length(turn_whole) + length(head) AS at_whole,
        sum(CASE WHEN place > common THEN length(turn_part) ELSE 0 END) OVER w - length(turn_part) + length(head) AS at_part
    FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY place)
)
SELECT conv_id AS pair_id, max(common) AS n_common,
    coalesce(string_agg(turn_whole, '' ORDER BY place) FILTER (WHERE place <= common), '') AS prompt,
    coalesce(string_agg(turn_whole, '' ORDER BY place) FILTER (WHERE place > common), '') AS chosen,
    coalesce(string_agg(turn_part, '' ORDER BY place) FILTER (WHERE place > common), '') AS rejected,
    coalesce(string_agg(at_whole || ':' || (at_whole + length(whole) + 10), ',' ORDER BY place)
        FILTER (WHERE place > common AND role = 'assistant'), '') AS chosen_spans,
    coalesce(string_agg(at_part || ':' || (at_part + length(part) + 10), ',' ORDER BY place)
        FILTER (WHERE place > common AND role = 'assistant'), '') AS rejected_spans
FROM o GROUP BY conv_id
"""



def shallot_sql(k: int = 40, rounds: int = 5, scale: int = 256, dimensions: int = 64, salt: str = "2") -> str:
    """Plain rounds: every distance to every centroid."""
    nearest = """
a{r} AS (
    SELECT i, vec_id, v, min({{'d': d, 'j': j}}) AS best FROM (
        SELECT i, vec_id, v, j, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM kept CROSS JOIN c{r}
    ) GROUP BY i, vec_id, v
)"""
    update = """
s{r} AS (
    SELECT j, place, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT best.j AS j, unnest(v) AS x, unnest(range(1, {dimensions} + 1)) AS place FROM a{p}
    ) GROUP BY j, place
), m{r} AS (
    SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM s{r} GROUP BY j
), c{r} AS (
    SELECT j, coalesce(m{r}.c, c{p}.c) AS c FROM c{p} LEFT JOIN m{r} USING (j)
)"""
    steps = [nearest.format(r=0)]
    for r in range(1, rounds + 1):
        steps += [update.format(r=r, p=r - 1, dimensions=dimensions), nearest.format(r=r)]
    return f"""
WITH kept AS (
    SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = {dimensions}
), c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id)) - 1 AS j, v AS c FROM kept
    ORDER BY sha256('{salt}:' || vec_id) LIMIT {k}
), {",".join(steps)}
SELECT vec_id, best.j::INTEGER AS cluster, best.d AS distance,
    (sum(best.d) OVER (PARTITION BY best.j))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.j = c{rounds}.j
"""


QUERIES = (
    op1_lm_score, op2_warc, op3_chat, op4_pii, op5_decontaminate, op6_quality, op7_near_dedup, op8_licences, op9_packing,
    op10_language_id, op11_toxicity, op12_shallot, op13_whitening,
)


def queries() -> dict:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": WARC_SQL, "op3_chat": CHAT_SQL, "op12_shallot": shallot_sql()}
