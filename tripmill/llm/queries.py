"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    best_fit,
    decontamination,
    language,
    lexical,
    lm,
    middle,
    near_duplicates,
    packing,
    perspectives,
    search,
    substring_dedup,
    suffix_dedup,
    tokens,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Parts of texts whose ids a Python worker of op4 or op13 keeps: about 60 MB.
REMEMBERED = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str = "doc_id") -> Column:
    """The fifth of the rows a document belongs to."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def encoder() -> Callable[[str], list[int]]:
    import public_tokenizers

    return packing.byte_bpe(public_tokenizers.path("byte_bpe_50k.json"))


def word_encoder() -> Callable[[str], list[int]]:
    import public_tokenizers

    return tokens.lasting(public_tokenizers.path("word_bpe_49k.json"), REMEMBERED)


def lasting_encoder() -> Callable[[str], list[int]]:
    import public_tokenizers

    return tokens.lasting(public_tokenizers.path("byte_bpe_50k.json"), REMEMBERED)


def _covered(spans: str) -> Column:
    """How many symbols merged spans cover."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", _covered("spans").alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    n_hit = _covered("hits")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(table(spark, sf_dir, "documents"), fold() != 1)
    return scored.select(
        "doc_id", (fold() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), lasting_encoder)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        _covered("spans").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(fold() != 0))
    return toxicity.score(docs, model).select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = language.profiles(docs.filter(fold() != 0))
    return language.identify(docs.select("doc_id", "text"), learned).select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


def op11_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.transform(table(spark, sf_dir, "documents"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = best_fit.pack(table(spark, sf_dir, "documents"), word_encoder)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    ).withColumn("piece", F.col("piece").cast("int"))


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_decontamination": op2_decontamination,
        "op3_lm": op3_lm,
        "op4_packing": op4_packing,
        "op5_search": op5_search,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_perspectives": op7_perspectives,
        "op8_near_duplicates": op8_near_duplicates,
        "op9_toxicity": op9_toxicity,
        "op10_language": op10_language,
        "op11_bag_search": op11_bag_search,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_best_fit": op13_best_fit,
    }


_DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(w[s : s + n - 1], ' ') AS t
       FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM bl)),
dw AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS t
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
             FROM d, (SELECT DISTINCT n FROM bl) WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, dw.n AS n, item FROM dw JOIN bw ON dw.t = bw.t AND dw.n = bw.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items,
                 string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_SEARCH = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
q AS (SELECT * FROM v WHERE vec_id % 50 = 0),
x AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM q JOIN v c ON c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM x)
WHERE rank <= 5
"""

_PERSPECTIVES = """
WITH s AS (SELECT conv_id, turn, role AS speaker, replace(coalesce(text, ''), '<|', '< |') AS t FROM conversations),
p AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM s WHERE speaker IS NOT NULL AND speaker <> 'system'),
j AS (SELECT conv_id, turn, perspective, t,
             CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
             translate(replace(speaker, '<|', '< |'), chr(13) || chr(10), '  ') AS shown
      FROM s JOIN p ON s.conv_id IS NOT DISTINCT FROM p.c),
k AS (SELECT conv_id, turn, perspective, t, role, CASE WHEN role = 'user' THEN shown END AS name FROM j),
h AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS header FROM k)
SELECT conv_id, turn, perspective, role, name, header || t || '<|im_end|>' || chr(10) AS rendered,
       CASE WHEN role = 'assistant' THEN CAST(length(header) AS INTEGER) END AS mask_start,
       CASE WHEN role = 'assistant' THEN CAST(length(header) + length(t) + 10 AS INTEGER) END AS mask_end
FROM h
"""


_BAG_SEARCH = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
           FROM documents),
a AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark),
t AS (SELECT r, doc_id, term, count(*) AS tf,
             10 + (90 * any_value(n) * any_value(docs)) // any_value(total) AS m
      FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d), a
      WHERE term IN (SELECT term FROM i) GROUP BY r, doc_id, term),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
g AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight FROM f, a),
s AS (SELECT item_id, r, doc_id,
             CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM i JOIN t USING (term) JOIN g USING (term) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""

_FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, CAST('0x' || h[1:8] AS BIGINT) AS h1,
             CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
             CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(w) AS BIGINT) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS low,
             greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS high,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                  THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(w[1 : low], '') AS prefix, array_to_string(w[low + 1 : high], '') AS middle,
             array_to_string(w[high + 1 : n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": _DECONTAMINATION,
        "op5_search": _SEARCH,
        "op7_perspectives": _PERSPECTIVES,
        "op11_bag_search": _BAG_SEARCH,
        "op12_fill_in_middle": _FILL_IN_MIDDLE,
    }
