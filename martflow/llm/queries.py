"""Thin driver queries over the operators of this package."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .audit_dp import damaged, repaired
from .chat_format import formatted, read_back
from .common import table
from .cover_tree import top_products
from .golay_dedup import near_duplicates
from .html_wrapper import main_texts
from .k2_treap import ranked
from .packing import packed
from .pfair_mix import mix_order
from .pii_bootstrap import KINDS, personal_data, spans_text
from .product_quantiser import near_duplicates as near_vectors
from .quality_rules import quality_scores
from .string_tiling import contaminated
from .toxic_grammar import toxic_scores


def op1_pfair_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix_order(table(spark, sf, "documents"))


def op2_packed_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return packed(table(spark, sf, "documents"))


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op4_html_wrapper(spark: SparkSession, sf: str) -> DataFrame:
    return main_texts(table(spark, sf, "pages"))


def op5_toxic_grammar(spark: SparkSession, sf: str) -> DataFrame:
    return toxic_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_string_tiling(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op7_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(1, 3).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 1, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(formatted(turns))


def op8_cover_tree(spark: SparkSession, sf: str) -> DataFrame:
    return top_products(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_pii_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    found = personal_data(table(spark, sf, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")

    of_kind = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    every = F.array_sort(F.concat("base", "extra"))
    return found.select("doc_id", *of_kind, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(every).alias("spans"))


def op10_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicates(table(spark, sf, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_k2_treap(spark: SparkSession, sf: str) -> DataFrame:
    return ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=20)


def op12_audit_dp(spark: SparkSession, sf: str) -> DataFrame:
    return repaired(damaged(table(spark, sf, "conversations")))


def op13_product_quantiser(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors(table(spark, sf, "embeddings"), least=0.93)


QUERIES = {
    "op1_pfair_mix": op1_pfair_mix,
    "op2_packed_tokens": op2_packed_tokens,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_wrapper": op4_html_wrapper,
    "op5_toxic_grammar": op5_toxic_grammar,
    "op6_string_tiling": op6_string_tiling,
    "op7_chat_format": op7_chat_format,
    "op8_cover_tree": op8_cover_tree,
    "op9_pii_bootstrap": op9_pii_bootstrap,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_k2_treap": op11_k2_treap,
    "op12_audit_dp": op12_audit_dp,
    "op13_product_quantiser": op13_product_quantiser,
}

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE_SQL: dict[str, str] = {
    "op11_k2_treap": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
        n AS (SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n FROM d WHERE len(words) > 0),
        s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
        q AS (SELECT item_id, term, count(*) AS times
              FROM (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark) GROUP BY ALL),
        tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d)
               WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2.0 * any_value(n_docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE)))
                                AS BIGINT) AS w FROM tf, s GROUP BY term),
        hits AS (SELECT item_id, n.r, doc_id, CAST(sum(times * w * ((1000000000 * tf)
                        // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
                 FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n ON n.r = tf.r, s GROUP BY item_id, n.r, doc_id)
        SELECT item_id, rank, doc_id, score FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
            FROM hits WHERE score > 0) WHERE rank <= 20""",
    "op13_product_quantiser": """
        WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        g AS (SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
              AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
        p AS (SELECT a.vec_id AS u, b.vec_id AS v FROM g a JOIN g b
              ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        r AS (SELECT u, v FROM p UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u),
        n AS (SELECT u, count(*) AS n FROM p GROUP BY u),
        c AS (SELECT u, min(v) AS c FROM r GROUP BY u)
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(c, vec_id)) AS kept
        FROM v LEFT JOIN n ON vec_id = n.u LEFT JOIN c ON vec_id = c.u""",
}
