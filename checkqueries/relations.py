"""Joins, aggregates, order-dependent operators, reshaping, taxonomy, requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from bioobs.operators.joins import (
    expect_unique,
    impute_max,
    join_named,
    natural_join,
    recycle,
)
from bioobs.operators.ordering import (
    BLOCK,
    fill_down,
    first_per_group,
    positional_zip,
    with_key_chunk,
    with_ordinal,
)
from bioobs.operators.requests import matching_requests, not_yet_processed
from bioobs.operators.shape import (
    bind_rows,
    cols_between,
    joined_text,
    nest,
    pivot_longer,
    starting_with,
    unnest_rows,
    unnest_struct,
)
from bioobs.operators.taxonomy import classify, ranks_wide, species_with_ranks
from bioobs.plans.atlas import dataset_counts
from checkqueries.registry import check, table


@check("q_group_count", """
SELECT source, count(*) AS cnt FROM documents GROUP BY source
""")
def q_group_count(spark, d):
    return dataset_counts(table(spark, d, "documents"), "source")


@check("q_metadata_recycle", """
SELECT event_id, 'occurrence' AS observation_type, m.top AS top_event
FROM events CROSS JOIN (SELECT max(event_id) AS top FROM events) m
""")
def q_metadata_recycle(spark, d):
    rows = table(spark, d, "events")
    single = rows.agg(F.max("event_id").alias("top_event")).withColumn("observation_type", F.lit("occurrence"))
    return recycle(rows.select("event_id"), single)


@check("q_left_named", """
SELECT o_orderkey, o.who, c.c_name
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey::VARCHAR END AS who FROM orders) o
LEFT JOIN (SELECT CASE WHEN c_custkey = 7 THEN NULL ELSE c_custkey::VARCHAR END AS k, c_name FROM customer WHERE c_mktsegment <> 'BUILDING') c
ON o.who IS NOT DISTINCT FROM c.k
""")
def q_left_named(spark, d):
    left = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey").cast("string")).alias("who")
    )
    right = (
        table(spark, d, "customer")
        .where("c_mktsegment <> 'BUILDING'")
        .select(F.when(F.col("c_custkey") != 7, F.col("c_custkey").cast("string")).alias("k"), "c_name")
    )
    return join_named(left, right, [("who", "k")])


NATION_KEYS = "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN NULL ELSE n_regionkey::VARCHAR END AS regionkey FROM nation"
REGION_KEYS = """SELECT CASE WHEN r_regionkey = 1 THEN NULL ELSE r_regionkey::VARCHAR END AS regionkey, r_name FROM region WHERE r_regionkey <> 3
UNION ALL SELECT r_regionkey::VARCHAR, 'copy' FROM region WHERE r_regionkey = 2"""


def nation_keys(spark, d):
    return table(spark, d, "nation").select(
        "n_nationkey", F.when(F.col("n_regionkey") != 1, F.col("n_regionkey").cast("string")).alias("regionkey")
    )


def region_keys(spark, d):
    rows = table(spark, d, "region")
    some = rows.where("r_regionkey <> 3").select(
        F.when(F.col("r_regionkey") != 1, F.col("r_regionkey").cast("string")).alias("regionkey"), "r_name"
    )
    copy = rows.where("r_regionkey = 2").select(
        F.col("r_regionkey").cast("string").alias("regionkey"), F.lit("copy").alias("r_name")
    )
    return bind_rows(some, copy)


@check("q_left_natural", f"""
SELECT n.n_nationkey, n.regionkey, r.r_name FROM ({NATION_KEYS}) n LEFT JOIN ({REGION_KEYS}) r
ON n.regionkey IS NOT DISTINCT FROM r.regionkey
""")
def q_left_natural(spark, d):
    return natural_join(nation_keys(spark, d), region_keys(spark, d))


@check("q_left_composite", """
SELECT p_partkey, s_suppkey, l_orderkey, l_linenumber, l_quantity * (l_partkey % 3) AS abundance
FROM (SELECT p_partkey, (p_partkey + i) % 100 AS s_suppkey FROM part, range(0, 8) t(i))
LEFT JOIN lineitem ON l_partkey = p_partkey AND l_suppkey = s_suppkey
WHERE l_quantity * (l_partkey % 3) <> 0
""")
def q_left_composite(spark, d):
    # sites: each part at eight suppliers; the planner knows their size before the
    # explode only and would copy all of them to the driver, so both sides are shuffled
    slot = F.explode(F.sequence(F.lit(0), F.lit(7)))
    sites = (
        table(spark, d, "part")
        .select("p_partkey", slot.alias("i"))
        .select("p_partkey", ((F.col("p_partkey") + F.col("i")) % 100).alias("s_suppkey"))
    )
    lines = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_suppkey").alias("s_suppkey"),
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") * (F.col("l_partkey") % 3)).alias("abundance"),
    )
    return natural_join(sites.hint("merge"), lines).where("abundance <> 0")


@check("q_anti_nullsafe", f"""
SELECT n.n_nationkey, n.regionkey FROM ({NATION_KEYS}) n
WHERE NOT EXISTS (SELECT 1 FROM ({REGION_KEYS}) r WHERE n.regionkey IS NOT DISTINCT FROM r.regionkey)
""")
def q_anti_nullsafe(spark, d):
    return natural_join(nation_keys(spark, d), region_keys(spark, d), "left_anti")


@check("q_inner_nullsafe", f"""
SELECT n.n_nationkey, n.regionkey, r.r_name FROM ({NATION_KEYS}) n JOIN ({REGION_KEYS}) r
ON n.regionkey IS NOT DISTINCT FROM r.regionkey
""")
def q_inner_nullsafe(spark, d):
    return natural_join(nation_keys(spark, d), region_keys(spark, d), "inner")


@check("q_skip_processed", """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def q_skip_processed(spark, d):
    todo = table(spark, d, "documents").select("doc_id", "source")
    return not_yet_processed(todo, table(spark, d, "labels"), "doc_id")


@check("q_unique_key", """
SELECT o_orderkey, o_custkey FROM orders
""")
def q_unique_key(spark, d):
    return expect_unique(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


@check("q_positional_zip", """
SELECT a.i, a.doc_id AS left_id, b.doc_id AS right_id
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i FROM documents) a
JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) AS i FROM documents) b ON a.i = b.i
""")
def q_positional_zip(spark, d):
    rows = with_key_chunk(table(spark, d, "documents").select("doc_id"), "doc_id", 10_000)
    up = with_ordinal(rows, "i", [BLOCK], "doc_id").select("i", F.col("doc_id").alias("left_id"))
    down = with_ordinal(rows, "i", [BLOCK], "doc_id", descending=True).select("i", F.col("doc_id").alias("right_id"))
    return positional_zip(up, down, "i")


@check("q_distinct", "SELECT DISTINCT event_type, user_id FROM events")
def q_distinct(spark, d):
    return table(spark, d, "events").select("event_type", "user_id").distinct()


@check("q_impute_max", """
SELECT p_partkey, coalesce(v, (SELECT max(v) FROM (SELECT CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS v FROM part))) AS price
FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS v FROM part)
""")
def q_impute_max(spark, d):
    rows = table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 7 != 0, F.col("p_retailprice")).alias("price")
    )
    return impute_max(rows, "price")


@check("q_nest", """
SELECT o_custkey, string_agg(o_orderpriority || '/' || o_orderstatus || '*' || n::VARCHAR, ' ' ORDER BY o_orderpriority, o_orderstatus) AS items
FROM (SELECT o_custkey, o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey
""")
def q_nest(spark, d):
    nested = nest(table(spark, d, "orders"), ["o_custkey"], ["o_orderpriority", "o_orderstatus"], "items")
    item = lambda i: F.concat(i["o_orderpriority"], F.lit("/"), i["o_orderstatus"], F.lit("*"), i["copies"].cast("string"))
    return nested.select("o_custkey", F.array_join(F.transform("items", item), " ").alias("items"))


@check("q_unnest", "SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders")
def q_unnest(spark, d):
    nested = nest(table(spark, d, "orders"), ["o_custkey"], ["o_orderpriority", "o_orderstatus"], "items", parts=4)
    return unnest_rows(nested, "items")


@check("q_string_agg", """
SELECT user_id, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS kinds FROM events GROUP BY user_id
""")
def q_string_agg(spark, d):
    return joined_text(table(spark, d, "events"), ["user_id"], "event_type", "kinds", "|")


@check("q_fill_down", """
SELECT event_id, last_value(v IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS v,
       last_value(k IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS k
FROM (SELECT event_id, CASE WHEN event_id % 9 = 4 THEN value END AS v,
             CASE WHEN event_id % 1500 = 11 THEN event_type END AS k FROM events)
""")
def q_fill_down(spark, d):
    rows = table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_id") % 9 == 4, F.col("value")).alias("v"),
        F.when(F.col("event_id") % 1500 == 11, F.col("event_type")).alias("k"),
    )
    return fill_down(with_key_chunk(rows, "event_id"), ["v", "k"], [BLOCK], "event_id").drop(BLOCK)


@check("q_first_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1
""")
def q_first_per_group(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return first_per_group(rows, ["o_custkey"], F.col("o_totalprice").desc(), F.col("o_orderkey"))


@check("q_topk", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def q_topk(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@check("q_pivot_longer", """
SELECT l_orderkey, l_linenumber, site, density FROM
  (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_discount END AS l_discount, l_tax FROM lineitem)
UNPIVOT INCLUDE NULLS (density FOR site IN (l_quantity, l_discount, l_tax))
""")
def q_pivot_longer(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_discount")).alias("l_discount"),
        "l_tax",
    )
    return pivot_longer(rows, cols_between(rows, "l_quantity", "l_tax"), "site", "density")


@check("q_pivot_longer_prefix", """
SELECT event_id, y::VARCHAR AS year, CASE y WHEN 97 THEN a ELSE b END AS abundance
FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS a, value + 1 AS b FROM events), (VALUES (97), (98)) t(y)
""")
def q_pivot_longer_prefix(spark, d):
    rows = table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("abundance_97"),
        (F.col("value") + 1).alias("abundance_98"),
    )
    return pivot_longer(rows, starting_with(rows, "abundance"), "year", "abundance", "abundance_")


def backbone(spark, d):
    """region -> nation -> customer as kingdom -> phylum -> class."""
    region = table(spark, d, "region").select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("taxon_id"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.lit("kingdom").alias("rank"),
        F.col("r_name").alias("name"),
    )
    nation = table(spark, d, "nation").select(
        (F.col("n_nationkey") + 100).cast("bigint").alias("taxon_id"),
        (F.col("n_regionkey") + 1).cast("bigint").alias("parent_id"),
        F.lit("phylum").alias("rank"),
        F.col("n_name").alias("name"),
    )
    customer = table(spark, d, "customer").select(
        (F.col("c_custkey") + 1000).alias("taxon_id"),
        (F.col("c_nationkey") + 100).cast("bigint").alias("parent_id"),
        F.lit("class").alias("rank"),
        F.col("c_name").alias("name"),
    )
    return bind_rows(region, nation, customer)


def candidates(spark, d):
    """Each customer's name means the customer first and its nation second."""
    rows = table(spark, d, "customer")
    own = rows.select(F.col("c_name").alias("query"), F.lit(1).alias("candidate_rank"), (F.col("c_custkey") + 1000).alias("taxon_id"))
    other = rows.select(
        F.col("c_name").alias("query"), F.lit(2).alias("candidate_rank"), (F.col("c_nationkey") + 100).cast("bigint").alias("taxon_id")
    )
    return bind_rows(other, own)


BACKBONE_SQL = """
SELECT r_regionkey + 1 AS taxon_id, NULL::BIGINT AS parent_id, 'kingdom' AS rank, r_name AS name FROM region
UNION ALL SELECT n_nationkey + 100, n_regionkey + 1, 'phylum', n_name FROM nation
UNION ALL SELECT c_custkey + 1000, c_nationkey + 100, 'class', c_name FROM customer
"""


@check("q_taxon_chain", f"""
WITH RECURSIVE b AS ({BACKBONE_SQL}), walk AS (
  SELECT c_name AS query, c_custkey + 1000 AS id FROM customer
  UNION ALL SELECT query, parent_id FROM walk JOIN b ON taxon_id = id WHERE parent_id IS NOT NULL)
SELECT query, rank, name FROM walk JOIN b ON taxon_id = id
""")
def q_taxon_chain(spark, d):
    return classify(candidates(spark, d), backbone(spark, d))


DEEP_SQL = """
SELECT c_custkey AS taxon_id, CASE WHEN c_custkey > 1 THEN c_custkey // 2 END AS parent_id, c_mktsegment AS rank, c_name AS name
FROM customer
"""


@check("q_taxon_deep", f"""
WITH RECURSIVE b AS ({DEEP_SQL}), walk AS (
  SELECT o_orderkey AS query, o_custkey AS id FROM orders
  UNION ALL SELECT query, parent_id FROM walk JOIN b ON taxon_id = id WHERE parent_id IS NOT NULL)
SELECT query, rank, name FROM walk JOIN b ON taxon_id = id
""")
def q_taxon_deep(spark, d):
    """Every order climbs from its customer, in a tree that deepens with the table."""
    key = F.col("c_custkey")
    tree = table(spark, d, "customer").select(
        key.alias("taxon_id"),
        F.when(key > 1, F.floor(key / 2)).alias("parent_id"),
        F.col("c_mktsegment").alias("rank"),
        F.col("c_name").alias("name"),
    )
    meant = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("query"), F.lit(1).alias("candidate_rank"), F.col("o_custkey").alias("taxon_id")
    )
    return classify(meant, tree)


@check("q_taxon_wide", """
SELECT c_name AS query, r_name AS kingdom, n_name AS phylum, c_name AS class, NULL::VARCHAR AS "order", NULL::VARCHAR AS family, NULL::VARCHAR AS genus, NULL::VARCHAR AS species
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def q_taxon_wide(spark, d):
    return ranks_wide(classify(candidates(spark, d), backbone(spark, d)))


@check("q_species_list", """
SELECT o_orderkey AS code, c_name AS scientific_name, r_name AS kingdom, n_name AS phylum, c_name AS class
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_orderkey % 6 <> 0
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT -1 - r_regionkey, r_name, NULL, NULL, NULL FROM region
""")
def q_species_list(spark, d):
    names = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("scientific_name"))
    listed = (
        table(spark, d, "orders")
        .select(F.col("o_orderkey").alias("code"), F.when(F.col("o_orderkey") % 6 != 0, F.col("o_custkey")).alias("c_custkey"))
        .join(names, "c_custkey", "left")
        .drop("c_custkey")
    )
    extra = table(spark, d, "region").select(
        (F.lit(-1) - F.col("r_regionkey")).cast("bigint").alias("code"), F.col("r_name").alias("scientific_name")
    )
    full = species_with_ranks(listed, candidates(spark, d), backbone(spark, d), extra)
    return full.select("code", "scientific_name", "kingdom", "phylum", "class")


@check("q_unnest_struct", """
SELECT o_orderkey, o_totalprice AS price, o_orderstatus AS status FROM orders
""")
def q_unnest_struct(spark, d):
    packed = table(spark, d, "orders").select(
        "o_orderkey", F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status")).alias("s")
    )
    return unnest_struct(packed, "s")


PREDICATES_SQL = """
SELECT DISTINCT user_id AS request, event_type AS key,
       CASE WHEN event_type = 'signup' THEN NULL ELSE floor(value / 40)::BIGINT::VARCHAR END AS value FROM events
"""


def _request_sql(mode: str) -> str:
    back = """AND NOT EXISTS (SELECT 1 FROM cur c WHERE NOT EXISTS (
      SELECT 1 FROM own o WHERE o.request = r.request AND o.key = c.key AND o.value IS NOT DISTINCT FROM c.value))"""
    return f"""
WITH p AS ({PREDICATES_SQL}),
own AS (SELECT * FROM p WHERE NOT (key = 'signup' OR (key = 'view' AND value = '0'))),
cur AS (SELECT key, value FROM own WHERE request = (SELECT min(request) FROM p))
SELECT request FROM (SELECT DISTINCT request FROM p) r
WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.request = r.request AND NOT EXISTS (
      SELECT 1 FROM cur c WHERE o.key = c.key AND o.value IS NOT DISTINCT FROM c.value))
{back if mode == "exact" else ""}
"""


def _matching(spark, d, mode):
    rows = table(spark, d, "events").select(
        F.col("user_id").alias("request"),
        F.col("event_type").alias("key"),
        F.when(F.col("event_type") != "signup", F.floor(F.col("value") / 40).cast("string")).alias("value"),
    )
    first = rows.agg(F.min("request")).scalar()
    current = rows.where(F.col("request") == first).drop("request")
    defaults = rows.where("key = 'signup' OR (key = 'view' AND value = '0')").drop("request").distinct()
    return matching_requests(rows, defaults, current, "request", mode)


@check("q_request_match", _request_sql("exact"))
def q_request_match(spark, d):
    return _matching(spark, d, "exact")


@check("q_request_match_subset", _request_sql("subset"))
def q_request_match_subset(spark, d):
    return _matching(spark, d, "subset")
