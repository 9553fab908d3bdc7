"""Registered queries over the driver's tables and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)``, reads whole tables and returns a
DataFrame; ``ORACLE_SQL`` holds the equivalent SQL over the same tables with
the same column names. Doubles are rounded to 6 decimals on both sides for
comparison; thresholds and rankings use the values before output rounding
(deviations are ranked by exact integer variances).

Fixtures (see ``sources.tables``): dense items are part names, sparse items
are part keys, edges are part -> supplier of each line item, text is
``documents.text``; documents are also baskets of their words, which exceed the
size of a light basket. Minimum supports are shares of the number of baskets
where that makes them prune at every scale.

Queries built on basket pairs run small jobs while they are built: one writes
the de-duplicated basket items into the session's checkpoint folder, one
measures basket sizes, and one counts frequent items before broadcasting
them. The round-trip queries first write their CSV or text files there.
``plans.lineage.release_scratch`` deletes all of it after the results are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import baskets as B
from basketry.operators import rules as R
from basketry.operators.coded import frequent_pairs_by_codes
from basketry.operators.graph import degree_count
from basketry.operators.pairs import (
    BasketSet,
    frequent_items,
    frequent_pairs,
    pcy_pass1,
    pcy_pruning,
    prepare_baskets,
)
from basketry.operators.text import word_count
from basketry.plans.lineage import scratch_folder
from basketry.sources import formats, sinks, tables

# The reference's PCY support threshold and rule thresholds.
SUPPORT = 3
CONFIDENCE = 0.05
INTEREST = 0.02
# Minimum pair support for dense items, in thousandths of the baskets, in the
# queries that show pruning; the rules keep the reference's support.
SUPPORT_PER_MILLE = 4
# Minimum support of words and word pairs, in percent of the documents.
WORD_SUPPORT_PERCENT = 5
# Minimum support of a sparse item.
ITEM_SUPPORT = 30
# Sparse-item PCY settings (100 buckets prune nothing on these tables).
SPARSE_SUPPORT = 2
SPARSE_BUCKETS = 1_000_003
BUCKET_SUPPORT = 3
TOP_K = 10
# Rules whose antecedents a user holds in the held-items query.
HELD_RULES = 40


def _dense(spark: SparkSession, sf: str) -> DataFrame:
    return tables.purchases(spark, sf, items="name")


def _sparse(spark: SparkSession, sf: str) -> DataFrame:
    return tables.purchases(spark, sf, items="partkey")


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def q_word_count(spark, sf):
    return word_count(tables.documents_text(spark, sf), "text")


def q_degree_count(spark, sf):
    return degree_count(tables.edges(spark, sf))


def q_degree_labels(spark, sf):
    """Degrees in the reference's reducer form: ``vertex``, ``in=N`` / ``out=N``."""
    return degree_count(tables.edges(spark, sf)).select("vertex", sinks.degree_label().alias("label"))


def q_edge_lines_degree_count(spark, sf):
    lines = tables.edges(spark, sf).select(F.concat_ws(" ", "src", "dst").alias("value"))
    return degree_count(formats.parse_edge_lines(lines))


def q_edge_lines_skip_malformed(spark, sf):
    """Line items as edge lines in a text file: those of line numbers 2 and 3 have
    a third field or only one, 4 has tabs and blanks around its fields."""
    n = F.col("l_linenumber")
    src, dst = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    line = (
        F.when(n == 2, F.concat_ws(" ", src, dst, F.lit("x")))
        .when(n == 3, src)
        .when(n == 4, F.concat(F.lit(" \t"), src, F.lit("\t "), dst, F.lit("  ")))
        .otherwise(F.concat_ws(" ", src, dst))
    )
    folder = scratch_folder(spark)
    tables.table(spark, sf, "lineitem").select(line.alias("value")).write.text(folder)
    return degree_count(formats.parse_edge_lines(formats.read_text_lines(spark, folder)))


def q_key_value_roundtrip(spark, sf):
    """Word counts written as key/value lines and read back (K1)."""
    folder = scratch_folder(spark)
    sinks.write_key_value_text(word_count(tables.documents_text(spark, sf), "text"), "word", "n", folder)
    fields = F.split("value", "\t")
    lines = formats.read_text_lines(spark, folder)
    return lines.select(F.get(fields, 0).alias("word"), F.get(fields, 1).cast("bigint").alias("n"))


def q_text_file_word_count(spark, sf):
    """Documents written as a text file, read back line by line (S1 + text sink)."""
    folder = scratch_folder(spark)
    tables.documents_text(spark, sf).where(F.col("text").isNotNull()).select("text").write.text(folder)
    return word_count(formats.read_text_lines(spark, folder))


def q_top_customers(spark, sf):
    return B.top_customers_by_distinct_products(_dense(spark, sf), TOP_K)


def q_baskets_per_month(spark, sf):
    return B.baskets_per_month(_dense(spark, sf))


def q_csv_baskets_per_month(spark, sf):
    """Purchases written as the reference's CSV (header, dd/MM/yyyy dates) and
    read back with the typed CSV reader (S3-S5 + CSV sink), then f2."""
    folder = scratch_folder(spark)
    csv = _dense(spark, sf).select(
        F.col("customer_id").alias("Member_number"),
        F.date_format("date", "dd/MM/yyyy").alias("Date"),
        F.col("product").alias("itemDescription"),
        "year", "month", "day",
    )
    sinks.write_csv(csv, folder, mode="overwrite", header=True)
    return B.baskets_per_month(formats.read_purchases_csv(spark, folder, date_format="dd/MM/yyyy"))


def q_pair_counts_per_month(spark, sf):
    # baskets of these tables are rarely copies of one another
    return B.pair_counts_per_month(B.month_baskets(_dense(spark, sf), collapse_copies=False), coded=True)


def q_top_pair_per_month(spark, sf):
    return B.top_pair_per_month(B.month_baskets(_dense(spark, sf), collapse_copies=False))


def q_purchase_irregularity(spark, sf):
    return _round(B.purchase_irregularity(_dense(spark, sf), "zero"), "stddev_items")


def q_irregularity_report(spark, sf):
    """f4 for every customer as the reference writes it: deviation with 4 decimals."""
    f4 = B.purchase_irregularity(_dense(spark, sf), "zero")
    return f4.select("customer_id", sinks.fixed_decimals("stddev_items").alias("stddev_text"))


def q_most_irregular_customers(spark, sf):
    return _round(B.most_irregular_customers(_dense(spark, sf), TOP_K, "zero"), "stddev_items")


def q_most_irregular_customer(spark, sf):
    return _round(B.most_irregular_customers(_dense(spark, sf), 1, "null"), "stddev_items")


def q_basket_lines(spark, sf):
    return B.to_basket_lines(_dense(spark, sf))


def q_parsed_basket_items(spark, sf):
    """Basket lines with blanks around every field, written to a text file and parsed again."""
    folder = scratch_folder(spark)
    lines = B.to_basket_lines(_dense(spark, sf))
    sinks.write_basket_lines(lines.select(F.concat(F.lit("  "), F.replace("line", F.lit(","), F.lit(" ,  ")), F.lit(" ")).alias("line")), folder)
    baskets = formats.parse_basket_lines(formats.read_text_lines(spark, folder))
    return formats.basket_lines_to_items(baskets).distinct()


def _dense_baskets(spark, sf):
    return prepare_baskets(tables.basket_items(_dense(spark, sf)))


def _sparse_baskets(spark, sf):
    return prepare_baskets(tables.basket_items(_sparse(spark, sf)))


def _share(baskets: BasketSet, share: int, of: int) -> int:
    """Least support that is at least ``share`` in ``of`` of all baskets."""
    return max(1, -(-share * baskets.n_baskets // of))


def q_item_support(spark, sf):
    # count_distinct removes repeats and null keys itself: no separate distinct
    return R.item_support(tables.basket_items(_dense(spark, sf)))


def q_basket_total(spark, sf):
    return R.basket_total(_dense(spark, sf))


def q_frequent_items(spark, sf):
    return frequent_items(_sparse_baskets(spark, sf), ITEM_SUPPORT)


def q_frequent_buckets(spark, sf):
    _, buckets = pcy_pass1(_sparse_baskets(spark, sf), BUCKET_SUPPORT, SPARSE_BUCKETS, "polynomial")
    return buckets


def _dense_pairs(spark, sf):
    baskets = _dense_baskets(spark, sf)
    return baskets, frequent_pairs_by_codes(baskets, _share(baskets, SUPPORT_PER_MILLE, 1000))


def _rule_pairs(spark, sf):
    baskets = _dense_baskets(spark, sf)
    return baskets, frequent_pairs(baskets, SUPPORT)


def q_frequent_pairs(spark, sf):
    return _dense_pairs(spark, sf)[1]


def q_frequent_pairs_pcy(spark, sf):
    return frequent_pairs(_sparse_baskets(spark, sf), SPARSE_SUPPORT, num_buckets=SPARSE_BUCKETS)


def q_pcy_pruning(spark, sf):
    return pcy_pruning(_sparse_baskets(spark, sf), BUCKET_SUPPORT, SPARSE_BUCKETS, "polynomial")


def q_document_word_pairs(spark, sf):
    """Pairs of frequent words of whole documents: few items in many long baskets, so
    pairs are counted by bitmaps over blocks of documents."""
    baskets = prepare_baskets(tables.document_words(spark, sf, lists=True), keys=("doc_id",))
    least = _share(baskets, WORD_SUPPORT_PERCENT, 100)
    return frequent_pairs_by_codes(baskets, least, bitmaps=True)


def q_pair_lines_roundtrip(spark, sf):
    """The pair file, written and read back (Q16)."""
    folder = scratch_folder(spark)
    sinks.write_pairs(_dense_pairs(spark, sf)[1], folder)
    return formats.read_pairs(spark, folder)


def q_candidate_rules(spark, sf):
    return R.generate_rules(_dense_pairs(spark, sf)[1], unique_pairs=True)


def q_rules_with_confidence(spark, sf):
    baskets, pairs = _rule_pairs(spark, sf)
    return _round(R.with_confidence(R.generate_rules(pairs, unique_pairs=True), baskets.support(), CONFIDENCE), "confidence")


def _final_rules(spark, sf):
    baskets, pairs = _rule_pairs(spark, sf)
    rules = R.association_rules(pairs, baskets.items, CONFIDENCE, INTEREST,
                                total=baskets.n_baskets, support=baskets.support(), unique_pairs=True)
    return rules, baskets


def q_association_rules(spark, sf):
    rules, _ = _final_rules(spark, sf)
    return _round(rules, "confidence", "prob_consequent", "interest")


def q_recommend_top_item(spark, sf):
    """Recommendations for a user holding the antecedent of the strongest rule."""
    rules, _ = _final_rules(spark, sf)
    held = (
        rules.orderBy(F.desc("confidence"), "antecedent", "consequent")
        .limit(1)
        .select("antecedent")
    )
    return _round(R.recommend(rules, held), "confidence", "interest")


def q_recommend_held_items(spark, sf):
    """Recommendations for a user holding the antecedents of the strongest rules:
    several rules recommend one item, and some recommend a held one."""
    rules, _ = _final_rules(spark, sf)
    held = rules.orderBy(F.desc("confidence"), "antecedent", "consequent").limit(HELD_RULES).select("antecedent")
    return _round(R.recommend(rules, held), "confidence", "interest")


def q_recommend_all(spark, sf):
    rules, baskets = _final_rules(spark, sf)
    recs = R.recommend_all(rules, baskets.items, distinct_rows=True)
    basket_id = F.concat_ws("_", F.col("customer_id").cast("string"), F.col("date").cast("string"))
    return _round(
        recs.select(basket_id.alias("basket_id"), "consequent", "confidence", "interest"),
        "confidence", "interest",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": q_word_count,
    "text_file_word_count": q_text_file_word_count,
    "degree_count": q_degree_count,
    "edge_lines_degree_count": q_edge_lines_degree_count,
    "edge_lines_skip_malformed": q_edge_lines_skip_malformed,
    "degree_labels": q_degree_labels,
    "key_value_roundtrip": q_key_value_roundtrip,
    "top_customers_by_distinct_products": q_top_customers,
    "baskets_per_month": q_baskets_per_month,
    "csv_baskets_per_month": q_csv_baskets_per_month,
    "pair_counts_per_month": q_pair_counts_per_month,
    "top_pair_per_month": q_top_pair_per_month,
    "purchase_irregularity": q_purchase_irregularity,
    "irregularity_report": q_irregularity_report,
    "most_irregular_customers": q_most_irregular_customers,
    "most_irregular_customer": q_most_irregular_customer,
    "basket_lines": q_basket_lines,
    "parsed_basket_items": q_parsed_basket_items,
    "item_support": q_item_support,
    "basket_total": q_basket_total,
    "frequent_items": q_frequent_items,
    "frequent_buckets": q_frequent_buckets,
    "frequent_pairs": q_frequent_pairs,
    "frequent_pairs_pcy": q_frequent_pairs_pcy,
    "pcy_pruning": q_pcy_pruning,
    "document_word_pairs": q_document_word_pairs,
    "pair_lines_roundtrip": q_pair_lines_roundtrip,
    "candidate_rules": q_candidate_rules,
    "rules_with_confidence": q_rules_with_confidence,
    "association_rules": q_association_rules,
    "recommend_top_item": q_recommend_top_item,
    "recommend_held_items": q_recommend_held_items,
    "recommend_all": q_recommend_all,
}


# ---------------------------------------------------------------- oracle SQL

_DENSE = """
purchases AS (
  SELECT o.o_custkey AS customer_id,
         CAST(o.o_orderdate AS DATE) AS date,
         p.p_name AS product,
         CAST(month(o.o_orderdate) AS INTEGER) AS month
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

_SPARSE = """
purchases AS (
  SELECT o.o_custkey AS customer_id,
         CAST(o.o_orderdate AS DATE) AS date,
         CAST(l.l_partkey AS VARCHAR) AS product,
         CAST(month(o.o_orderdate) AS INTEGER) AS month
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

_BI = """
bi AS (SELECT DISTINCT customer_id, date, product AS item FROM purchases)"""

_PAIRS = """
pairs AS (
  SELECT a.item AS item_a, b.item AS item_b, count(*) AS support
  FROM bi a JOIN bi b
    ON a.customer_id = b.customer_id AND a.date = b.date AND a.item < b.item
  GROUP BY 1, 2
)"""

_SUPPORT = """
support AS (SELECT item, count(*) AS support FROM bi GROUP BY item)"""

_FREQUENT = (
    f"support * 1000 >= {SUPPORT_PER_MILLE} * (SELECT count(*) FROM (SELECT DISTINCT customer_id, date FROM purchases))"
)

_FREQUENT_PAIRS = f"""
fp AS (SELECT * FROM pairs WHERE {_FREQUENT})"""

_RULE_PAIRS = f"""
fp AS (SELECT * FROM pairs WHERE support >= {SUPPORT})"""

_CANDIDATES = """
cand AS (
  SELECT DISTINCT antecedent, consequent, pair_support FROM (
    SELECT item_a AS antecedent, item_b AS consequent, support AS pair_support FROM fp
    UNION ALL
    SELECT item_b AS antecedent, item_a AS consequent, support AS pair_support FROM fp)
  WHERE antecedent <> consequent
)"""

_RULES = f"""
conf AS (
  SELECT c.*, s.support AS antecedent_support,
         CAST(c.pair_support AS DOUBLE) / s.support AS confidence
  FROM cand c JOIN support s ON c.antecedent = s.item
  WHERE CAST(c.pair_support AS DOUBLE) / s.support >= {CONFIDENCE}
),
total AS (SELECT count(*) AS n FROM (SELECT DISTINCT customer_id, date FROM purchases)),
rules AS (
  SELECT conf.*, s.support AS consequent_support,
         CAST(s.support AS DOUBLE) / total.n AS prob_consequent,
         conf.confidence - CAST(s.support AS DOUBLE) / total.n AS interest
  FROM conf JOIN support s ON conf.consequent = s.item, total
  WHERE abs(conf.confidence - CAST(s.support AS DOUBLE) / total.n) >= {INTEREST}
)"""


# The variance in exact integers, scaled.
_VARIANCE = """((count(*) * sum(n_items * n_items) - sum(n_items) * sum(n_items))::HUGEINT * 1000000000000
  // nullif(count(*) * (count(*) - 1), 0))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ORACLE_SQL: dict[str, str] = {
    "word_count": r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word""",
    "text_file_word_count": r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents WHERE text IS NOT NULL)
WHERE word <> ''
GROUP BY word""",
    "degree_count": """
SELECT vertex, direction, count(*) AS degree FROM (
  SELECT l_partkey AS vertex, 'out' AS direction FROM lineitem
  UNION ALL
  SELECT l_suppkey AS vertex, 'in' AS direction FROM lineitem)
GROUP BY vertex, direction""",
    "degree_labels": """
SELECT vertex, direction || '=' || CAST(count(*) AS VARCHAR) AS label FROM (
  SELECT l_partkey AS vertex, 'out' AS direction FROM lineitem
  UNION ALL
  SELECT l_suppkey AS vertex, 'in' AS direction FROM lineitem)
GROUP BY vertex, direction""",
    "edge_lines_degree_count": """
SELECT vertex, direction, count(*) AS degree FROM (
  SELECT CAST(l_partkey AS VARCHAR) AS vertex, 'out' AS direction FROM lineitem
  UNION ALL
  SELECT CAST(l_suppkey AS VARCHAR) AS vertex, 'in' AS direction FROM lineitem)
GROUP BY vertex, direction""",
    "edge_lines_skip_malformed": """
SELECT vertex, direction, count(*) AS degree FROM (
  SELECT CAST(l_partkey AS VARCHAR) AS vertex, 'out' AS direction FROM lineitem WHERE l_linenumber NOT IN (2, 3)
  UNION ALL
  SELECT CAST(l_suppkey AS VARCHAR) AS vertex, 'in' AS direction FROM lineitem WHERE l_linenumber NOT IN (2, 3))
GROUP BY vertex, direction""",
    "key_value_roundtrip": r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word""",
    "top_customers_by_distinct_products": _with(_DENSE) + f"""
SELECT customer_id, count(DISTINCT product) AS n_products
FROM purchases GROUP BY customer_id
ORDER BY n_products DESC, customer_id LIMIT {TOP_K}""",
    "baskets_per_month": _with(_DENSE) + """
SELECT month, count(*) AS n_baskets
FROM (SELECT DISTINCT customer_id, date, month FROM purchases)
GROUP BY month""",
    "csv_baskets_per_month": _with(_DENSE) + """
SELECT month, count(*) AS n_baskets
FROM (SELECT DISTINCT customer_id, date, month FROM purchases)
GROUP BY month""",
    "pair_counts_per_month": _with(_DENSE) + """
, bm AS (SELECT DISTINCT customer_id, date, month, product AS item FROM purchases)
SELECT a.month, a.item AS item_a, b.item AS item_b, count(*) AS n_baskets
FROM bm a JOIN bm b ON a.customer_id = b.customer_id AND a.date = b.date AND a.item < b.item
GROUP BY 1, 2, 3""",
    "top_pair_per_month": _with(_DENSE) + """
, bm AS (SELECT DISTINCT customer_id, date, month, product AS item FROM purchases)
, pc AS (
  SELECT a.month, a.item AS item_a, b.item AS item_b, count(*) AS n_baskets
  FROM bm a JOIN bm b ON a.customer_id = b.customer_id AND a.date = b.date AND a.item < b.item
  GROUP BY 1, 2, 3)
SELECT month, item_a, item_b, n_baskets FROM pc
QUALIFY row_number() OVER (PARTITION BY month ORDER BY n_baskets DESC, item_a, item_b) = 1""",
    "purchase_irregularity": _with(_DENSE) + """
SELECT customer_id, round(coalesce(stddev_samp(n_items), 0.0), 6) AS stddev_items
FROM (SELECT customer_id, date, count(*) AS n_items FROM purchases GROUP BY 1, 2)
GROUP BY customer_id""",
    "irregularity_report": _with(_DENSE) + """
SELECT customer_id, printf('%.4f', coalesce(stddev_samp(n_items), 0.0)) AS stddev_text
FROM (SELECT customer_id, date, count(*) AS n_items FROM purchases GROUP BY 1, 2)
GROUP BY customer_id""",
    "most_irregular_customers": _with(_DENSE) + f"""
, s AS (
  SELECT customer_id, coalesce(stddev_samp(n_items), 0.0) AS sd, coalesce({_VARIANCE}, 0) AS rank_key
  FROM (SELECT customer_id, date, count(*) AS n_items FROM purchases GROUP BY 1, 2)
  GROUP BY customer_id)
SELECT customer_id, round(sd, 6) AS stddev_items FROM s
ORDER BY rank_key DESC NULLS LAST, customer_id LIMIT {TOP_K}""",
    "most_irregular_customer": _with(_DENSE) + f"""
, s AS (
  SELECT customer_id, stddev_samp(n_items) AS sd, {_VARIANCE} AS rank_key
  FROM (SELECT customer_id, date, count(*) AS n_items FROM purchases GROUP BY 1, 2)
  GROUP BY customer_id)
SELECT customer_id, round(sd, 6) AS stddev_items FROM s
ORDER BY rank_key DESC NULLS LAST, customer_id LIMIT 1""",
    "basket_lines": _with(_DENSE, _BI) + """
SELECT CAST(customer_id AS VARCHAR) || '_' || CAST(date AS VARCHAR) AS basket_id,
       CAST(customer_id AS VARCHAR) || '_' || CAST(date AS VARCHAR) || ','
         || string_agg(item, ',' ORDER BY item) AS line
FROM bi GROUP BY customer_id, date""",
    "parsed_basket_items": _with(_DENSE, _BI) + """
SELECT DISTINCT CAST(customer_id AS VARCHAR) || '_' || CAST(date AS VARCHAR) AS basket_id, item
FROM bi""",
    "item_support": _with(_DENSE, _BI, _SUPPORT) + "SELECT item, support FROM support",
    "basket_total": _with(_DENSE) + """
SELECT count(*) AS n_baskets FROM (SELECT DISTINCT customer_id, date FROM purchases)""",
    "frequent_items": _with(_SPARSE, _BI, _SUPPORT) + f"""
SELECT item, support FROM support WHERE support >= {ITEM_SUPPORT}""",
    "frequent_buckets": _with(_SPARSE, _BI, _PAIRS) + f"""
SELECT CAST(list_reduce(
         list_transform(string_split(item_a || '|' || item_b, ''), lambda c: CAST(unicode(c) AS BIGINT)),
         lambda h, c: (h * 31 + c) % {SPARSE_BUCKETS}, CAST(0 AS BIGINT)) AS INTEGER) AS bucket,
       CAST(sum(support) AS BIGINT) AS count
FROM pairs GROUP BY 1 HAVING sum(support) >= {BUCKET_SUPPORT}""",
    "frequent_pairs": _with(_DENSE, _BI, _PAIRS) + f"""
SELECT item_a, item_b, support FROM pairs WHERE {_FREQUENT}""",
    "frequent_pairs_pcy": _with(_SPARSE, _BI, _PAIRS) + f"""
SELECT item_a, item_b, support FROM pairs WHERE support >= {SPARSE_SUPPORT}""",
    "pcy_pruning": _with(_SPARSE, _BI, _PAIRS, _SUPPORT) + f"""
, hashed AS (
  SELECT item_a, item_b, support,
         CAST(list_reduce(
           list_transform(string_split(item_a || '|' || item_b, ''), lambda c: CAST(unicode(c) AS BIGINT)),
           lambda h, c: (h * 31 + c) % {SPARSE_BUCKETS}, CAST(0 AS BIGINT)) AS INTEGER) AS bucket
  FROM pairs)
, fb AS (SELECT bucket FROM hashed GROUP BY bucket HAVING sum(support) >= {BUCKET_SUPPORT})
, fi AS (SELECT item FROM support WHERE support >= {BUCKET_SUPPORT})
, kept AS (
  SELECT h.* FROM hashed h
  WHERE h.item_a IN (SELECT item FROM fi) AND h.item_b IN (SELECT item FROM fi))
SELECT (SELECT count(*) FROM pairs) AS all_pairs,
       (SELECT count(*) FROM kept) AS item_candidates,
       (SELECT count(*) FROM kept WHERE bucket IN (SELECT bucket FROM fb)) AS bucket_candidates,
       (SELECT count(*) FROM fb) AS frequent_buckets""",
    "document_word_pairs": rf"""
WITH words AS (
  SELECT DISTINCT doc_id, word FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
  WHERE word <> ''),
n AS (SELECT count(DISTINCT doc_id) AS n FROM documents),
frequent AS (
  SELECT word FROM words GROUP BY word HAVING count(*) * 100 >= {WORD_SUPPORT_PERCENT} * (SELECT n FROM n)),
kept AS (SELECT doc_id, word FROM words WHERE word IN (SELECT word FROM frequent))
SELECT a.word AS item_a, b.word AS item_b, count(*) AS support
FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND a.word < b.word
GROUP BY 1, 2 HAVING count(*) * 100 >= {WORD_SUPPORT_PERCENT} * (SELECT n FROM n)""",
    "pair_lines_roundtrip": _with(_DENSE, _BI, _PAIRS) + f"""
SELECT item_a, item_b, support FROM pairs WHERE {_FREQUENT}""",
    "candidate_rules": _with(_DENSE, _BI, _PAIRS, _FREQUENT_PAIRS, _CANDIDATES) + """
SELECT antecedent, consequent, pair_support FROM cand""",
    "rules_with_confidence": _with(_DENSE, _BI, _PAIRS, _SUPPORT, _RULE_PAIRS, _CANDIDATES, _RULES) + """
SELECT antecedent, consequent, pair_support, antecedent_support, round(confidence, 6) AS confidence
FROM conf""",
    "association_rules": _with(_DENSE, _BI, _PAIRS, _SUPPORT, _RULE_PAIRS, _CANDIDATES, _RULES) + """
SELECT antecedent, consequent, pair_support, antecedent_support, round(confidence, 6) AS confidence,
       consequent_support, round(prob_consequent, 6) AS prob_consequent, round(interest, 6) AS interest
FROM rules""",
    "recommend_top_item": _with(_DENSE, _BI, _PAIRS, _SUPPORT, _RULE_PAIRS, _CANDIDATES, _RULES) + """
, top AS (SELECT antecedent AS item FROM rules ORDER BY confidence DESC, antecedent, consequent LIMIT 1)
SELECT DISTINCT r.consequent, round(r.confidence, 6) AS confidence, round(r.interest, 6) AS interest
FROM rules r JOIN top ON r.antecedent = top.item
WHERE r.consequent NOT IN (SELECT item FROM top)""",
    "recommend_held_items": _with(_DENSE, _BI, _PAIRS, _SUPPORT, _RULE_PAIRS, _CANDIDATES, _RULES) + f"""
, top AS (SELECT antecedent AS item FROM rules ORDER BY confidence DESC, antecedent, consequent LIMIT {HELD_RULES})
SELECT DISTINCT r.consequent, round(r.confidence, 6) AS confidence, round(r.interest, 6) AS interest
FROM rules r JOIN (SELECT DISTINCT item FROM top) t ON r.antecedent = t.item
WHERE r.consequent NOT IN (SELECT item FROM top)""",
    "recommend_all": _with(_DENSE, _BI, _PAIRS, _SUPPORT, _RULE_PAIRS, _CANDIDATES, _RULES) + """
SELECT DISTINCT CAST(b.customer_id AS VARCHAR) || '_' || CAST(b.date AS VARCHAR) AS basket_id,
       r.consequent, round(r.confidence, 6) AS confidence, round(r.interest, 6) AS interest
FROM bi b JOIN rules r ON b.item = r.antecedent
WHERE NOT EXISTS (
  SELECT 1 FROM bi h
  WHERE h.customer_id = b.customer_id AND h.date = b.date AND h.item = r.consequent)""",
}
