"""Sources, projection, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from bioobs.functions import text, values
from bioobs.operators.matching import match_any
from bioobs.operators.ordering import latest_snapshot
from bioobs.operators.predicates import And, DEFAULT_QUALITY, Within
from bioobs.operators.shape import (
    bind_rows,
    cols_between,
    conform,
    drop_all_null,
    relocate,
    with_constants,
)
from bioobs.session import shared_folder
from bioobs.sources.readers import list_files, literal_table, read_csv, scan_data_files, scan_parquet
from bioobs.sources.sinks import write_partitioned, write_table
from checkqueries.registry import LAT_SQL, LON_SQL, check, lat, lon, table


@check("q_scan", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 40 AND l_returnflag = 'R'
""")
def q_scan(spark, d):
    rows = scan_parquet(spark, f"{d}/lineitem.parquet")
    return rows.where((F.col("l_quantity") >= 40) & (F.col("l_returnflag") == "R")).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@check("q_hive_roundtrip", """
SELECT c_custkey, c_name,
       coalesce(CASE WHEN r_regionkey <> 2 THEN r_name END, 'unknown') AS kingdom,
       coalesce(CASE WHEN n_nationkey % 6 <> 0 THEN n_name END, 'unknown') AS phylum,
       coalesce(CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END, 'unknown') AS class
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def q_hive_roundtrip(spark, d):
    taxa = ["kingdom", "phylum", "class"]
    rows = _customer_taxa(spark, d).withColumns(values.coalesce_each(taxa, "unknown"))
    path = shared_folder(spark, "hive")
    write_partitioned(rows, path, taxa)
    schema = T.StructType([*rows.select("c_custkey", "c_name").schema] + [T.StructField(t, T.StringType()) for t in taxa])
    return scan_data_files(spark, path, schema).select("c_custkey", "c_name", *taxa)


def _customer_taxa(spark, d):
    joined = (
        table(spark, d, "customer")
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        "c_custkey",
        "c_name",
        F.when(F.col("r_regionkey") != 2, F.col("r_name")).alias("kingdom"),
        F.when(F.col("n_nationkey") % 6 != 0, F.col("n_name")).alias("phylum"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("class"),
    )


@check("q_csv", """
SELECT c_custkey AS cust_key, c_name || CASE WHEN c_custkey % 3 = 0 THEN ', the "' || c_mktsegment || '"' ELSE '' END AS x1st_name,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS balance
FROM customer
""")
def q_csv(spark, d):
    said = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(', the "'), "c_mktsegment", F.lit('"'))).otherwise("")
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Cust Key"),
        F.concat("c_name", said).alias("1st Name"),
        F.when(F.col("c_custkey") % 9 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("Balance"),
    )
    path = shared_folder(spark, "csv")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path, {"cust_key": "bigint", "balance": "double"})


@check("q_csv_infer", """
SELECT o_orderkey AS key, o_orderkey % 2 = 0 AS flag, o_totalprice AS price,
       CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%d.%m.%Y') END AS day,
       CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 0.5 ELSE (o_orderkey % 100)::DOUBLE END AS late_double,
       CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'none' ELSE (o_orderkey % 100)::VARCHAR END AS late_text,
       lpad((o_orderkey % 1000)::VARCHAR, 4, '0') AS code, '0' || (o_orderkey % 10) || ':30' AS at,
       'key bigint, flag boolean, price double, day date, late_double double, late_text string, code string, at string' AS types
FROM orders
""")
def q_csv_infer(spark, d):
    """Types from all values: two columns show theirs only in the last line of the last file."""
    orders = table(spark, d, "orders")
    key = F.col("o_orderkey")
    last = key == orders.agg(F.max("o_orderkey")).scalar()
    rows = orders.select(
        key.alias("Key"),
        F.when(key % 2 == 0, "TRUE").otherwise("F").alias("flag"),
        F.col("o_totalprice").alias("price"),
        F.when(key % 4 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(last, "0.5").otherwise((key % 100).cast("string")).alias("late double"),
        F.when(last, "none").otherwise((key % 100).cast("string")).alias("late text"),
        F.lpad((key % 1000).cast("string"), 4, "0").alias("code"),
        F.concat(F.lit("0"), (key % 10).cast("string"), F.lit(":30")).alias("at"),
    )
    path = shared_folder(spark, "csv-infer")
    rows.repartitionByRange(4, "Key").sortWithinPartitions("Key").write.option("header", True).option("nullValue", "NA").csv(path)
    df = read_csv(spark, path, infer=True)
    df = df.withColumn("types", F.lit(", ".join(f"{c} {t}" for c, t in df.dtypes)))
    return df.withColumn("day", F.date_format("day", "dd.MM.yyyy"))


@check("q_csv_multiline", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment ||
       CASE c_custkey % 5 WHEN 0 THEN chr(10) || 'second, "line"' WHEN 1 THEN chr(10) || chr(10) || c_name || repeat(chr(10) || 'more', CASE WHEN c_custkey % 500 = 1 THEN 4000 ELSE (c_custkey % 30)::INT END)
                          WHEN 2 THEN '""' ELSE '' END AS note
FROM customer
""")
def q_csv_multiline(spark, d):
    """One file, line breaks inside quotes, records longer than a split, and many more tasks than files."""
    key, line = F.col("c_custkey"), F.lit("\n")
    more = F.expr("repeat('\nmore', IF(c_custkey % 500 = 1, 4000, CAST(c_custkey % 30 AS INT)))")
    note = (
        F.when(key % 5 == 0, F.concat(line, F.lit('second, "line"')))
        .when(key % 5 == 1, F.concat(line, line, F.col("c_name"), more))
        .when(key % 5 == 2, F.lit('""'))
        .otherwise("")
    )
    rows = table(spark, d, "customer").select(key.alias("Key"), F.col("c_name").alias("Name"), F.concat("c_mktsegment", note).alias("Note"))
    path = shared_folder(spark, "csv-lines")
    rows.coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    narrow = spark.newSession()
    narrow.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    narrow.conf.set("spark.sql.files.openCostInBytes", "0")
    narrow.conf.set("spark.sql.files.minPartitionNum", "64")
    return read_csv(narrow, path, {"key": "bigint"}, multi_line=True)


@check("q_latest_snapshot", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS snapshot_date FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)
""")
def q_latest_snapshot(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("snapshot_date")
    )
    return latest_snapshot(rows, rows, "snapshot_date")


@check("q_union_custom", """
SELECT r_regionkey AS code, r_name AS scientific_name, NULL AS common_name FROM region
UNION ALL SELECT 99, 'Larus spp.', 'Gull'
""")
def q_union_custom(spark, d):
    listed = table(spark, d, "region").withColumnsRenamed({"r_regionkey": "code", "r_name": "scientific_name"})
    extra = literal_table(spark, "code int, scientific_name string, common_name string", (99, "Larus spp.", "Gull"))
    return bind_rows(listed, extra)


@check("q_project", """
SELECT o_orderkey AS key, o_totalprice AS price, o_orderstatus FROM orders
""")
def q_project(spark, d):
    rows = table(spark, d, "orders").drop("o_custkey", "o_orderdate", "o_orderpriority")
    return rows.withColumnsRenamed({"o_orderkey": "key", "o_totalprice": "price"})


@check("q_col_range", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
""")
def q_col_range(spark, d):
    rows = table(spark, d, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", *cols_between(rows, "l_quantity", "l_tax"))


@check("q_drop_all_null", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS some FROM events
""")
def q_drop_all_null(spark, d):
    rows = table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("some"),
        F.when(F.col("event_id") < 0, F.col("value")).alias("none"),
    )
    return drop_all_null(rows)


@check("q_conform", """
SELECT o_orderstatus AS status, o_totalprice AS price, o_orderkey::INTEGER AS id, NULL::DOUBLE AS effort, 'd1' AS dataset
FROM orders
""")
def q_conform(spark, d):
    target = T.StructType(
        [
            T.StructField("status", T.StringType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("id", T.IntegerType()),
            T.StructField("effort", T.DoubleType()),
            T.StructField("dataset", T.StringType()),
        ]
    )
    rows = table(spark, d, "orders").withColumnsRenamed(
        {"o_orderkey": "id", "o_totalprice": "price", "o_orderstatus": "status"}
    )
    return conform(with_constants(rows, {"effort": None, "dataset": "d1"}, target), target)


@check("q_relocate", """
SELECT n_regionkey, n_name, n_nationkey FROM nation
""")
def q_relocate(spark, d):
    moved = relocate(table(spark, d, "nation"), ["absent", "n_regionkey"])
    return relocate(moved, ["n_name"], before="n_nationkey")


@check("q_across_coalesce", """
SELECT c_custkey,
       coalesce(CASE WHEN r_regionkey <> 2 THEN r_name END, 'unknown') AS kingdom,
       coalesce(CASE WHEN n_nationkey % 6 <> 0 THEN n_name END, 'unknown') AS phylum,
       coalesce(CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END, 'unknown') AS class
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def q_across_coalesce(spark, d):
    rows = _customer_taxa(spark, d).drop("c_name")
    return rows.withColumns(values.coalesce_each(["kingdom", "phylum", "class"], "unknown"))


@check("q_filter_ne", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer
WHERE CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END <> 'BUILDING'
""")
def q_filter_ne(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment")
    )
    return rows.where(F.col("segment") != "BUILDING")


@check("q_recent", """
SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS created FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AND o_orderdate::DATE > DATE '2001-08-01' - 30
""")
def q_recent(spark, d):
    rows = table(spark, d, "orders").where(
        (F.col("o_orderstatus") == "F")
        & (F.col("o_orderpriority") == "2-HIGH")
        & values.newer_than("o_orderdate", "2001-08-01", 30)
    )
    return rows.select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("created"))


@check("q_null_filter", """
SELECT event_id, nullif(event_type, 'click') AS kind, nullif(event_type, 'click') IS NULL AS missing
FROM events WHERE CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END IS NOT NULL
""")
def q_null_filter(spark, d):
    rows = table(spark, d, "events").withColumn("v", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    kind = F.nullif(F.col("event_type"), F.lit("click"))
    return rows.where(F.col("v").isNotNull()).select("event_id", kind.alias("kind"), kind.isNull().alias("missing"))


@check("q_regex_not", """
SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '/(en|fr)/[0-9]+')
""")
def q_regex_not(spark, d):
    rows = table(spark, d, "pages")
    return rows.where(text.detect("url", "/(en|fr)/[0-9]+", negate=True)).select("page_id", "url")


@check("q_match_any", """
SELECT doc_id, lang FROM documents
WHERE EXISTS (SELECT 1 FROM part WHERE contains(documents.text, split_part(p_name, ' ', 2)))
""")
def q_match_any(spark, d):
    words = table(spark, d, "part").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("w"))
    return match_any(table(spark, d, "documents"), "text", words, "w").select("doc_id", "lang")


@check("q_match_any_long_list", """
WITH w AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS w FROM documents)
SELECT page_id, url FROM pages WHERE EXISTS (SELECT 1 FROM w WHERE length(w) > 5 AND contains(url, w))
""")
def q_match_any_long_list(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.split(F.lower("text"), " ")).alias("w"))
    long_words = words.where(F.length("w") > 5)
    return match_any(table(spark, d, "pages"), "url", long_words, "w").select("page_id", "url")


@check("q_suffix", """
SELECT p_partkey, p_name FROM part WHERE ends_with(p_name, 'ring') OR ends_with(p_type, 'Y')
""")
def q_suffix(spark, d):
    rows = table(spark, d, "part").where(F.col("p_name").endswith("ring") | F.col("p_type").endswith("Y"))
    return rows.select("p_partkey", "p_name")


@check("q_predicate_dsl", f"""
SELECT o_orderkey FROM (
  SELECT o_orderkey, {LON_SQL} AS lon, {LAT_SQL} AS lat, o_orderkey % 7 = 0 AS issue, o_orderkey % 11 <> 0 AS has,
         CASE WHEN o_orderstatus = 'P' THEN 'PRESENT' ELSE 'ABSENT' END AS status,
         CASE o_orderpriority WHEN '5-LOW' THEN 'FOSSIL_SPECIMEN' WHEN '1-URGENT' THEN 'LIVING_SPECIMEN'
              WHEN '2-HIGH' THEN NULL ELSE 'HUMAN_OBSERVATION' END AS basis
  FROM orders)
WHERE NOT issue AND has AND status = 'PRESENT' AND basis NOT IN ('FOSSIL_SPECIMEN', 'LIVING_SPECIMEN')
  AND ((lon BETWEEN -135 AND -120 AND lat BETWEEN 50 AND 54) OR (lon BETWEEN -135 AND -128 AND lat BETWEEN 50 AND 58))
  AND NOT (lon > -134 AND lon < -132 AND lat > 51 AND lat < 53)
""")
def q_predicate_dsl(spark, d):
    region = Within(
        "POLYGON ((-135 50, -120 50, -120 54, -128 54, -128 58, -135 58, -135 50), "
        "(-134 51, -134 53, -132 53, -132 51, -134 51))"
    )
    priority = F.col("o_orderpriority")
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        lon().alias("longitude"),
        lat().alias("latitude"),
        (F.col("o_orderkey") % 7 == 0).alias("has_geospatial_issue"),
        (F.col("o_orderkey") % 11 != 0).alias("has_coordinate"),
        values.if_else(F.col("o_orderstatus") == "P", "PRESENT", "ABSENT").alias("occurrence_status"),
        F.when(priority == "5-LOW", "FOSSIL_SPECIMEN")
        .when(priority == "1-URGENT", "LIVING_SPECIMEN")
        .when(priority != "2-HIGH", "HUMAN_OBSERVATION")
        .alias("basis_of_record"),
    )
    return rows.where(And(region, *DEFAULT_QUALITY.parts).to_column()).select("o_orderkey")


@check("q_str_first", """
SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '') AS removed,
       regexp_replace(p_name, '(l|r)(.)', '\\2-\\1') AS swapped, regexp_replace(p_brand, '.', '$') AS money
FROM part
""")
def q_str_first(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        text.remove_first("p_name", "[aeiou]").alias("removed"),
        text.replace_first("p_name", "(l|r)(.)", r"\2-\1").alias("swapped"),
        text.replace_first("p_brand", ".", "$").alias("money"),
    )


@check("q_str_misc", """
SELECT page_id, lower(url) AS low, CASE WHEN page_id % 4 = 0 THEN 'NA' ELSE page_id::VARCHAR END || '.zip' AS archive,
       'data/' || page_id::VARCHAR || '/x' AS path, regexp_extract(url, '\\.([^./]+)$', 1) AS ext,
       length(url) AS n_chars
FROM pages
""")
def q_str_misc(spark, d):
    key = F.when(F.col("page_id") % 4 != 0, F.col("page_id"))
    return table(spark, d, "pages").select(
        "page_id",
        F.lower("url").alias("low"),
        text.glue("{a}.zip", a=key).alias("archive"),
        text.path_of(F.lit("data"), F.col("page_id").cast("string"), F.lit("x")).alias("path"),
        text.file_extension("url").alias("ext"),
        F.length("url").cast("bigint").alias("n_chars"),
    )


@check("q_split_code", """
SELECT c_custkey, substr(c_mktsegment, length(c_mktsegment), 1) AS letter,
       substr(c_mktsegment, 1, length(c_mktsegment) - 1) AS number, substr(c_mktsegment, 2) AS rest,
       substr(c_mktsegment, 2, 3) AS mid
FROM customer
""")
def q_split_code(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        text.sub_string("c_mktsegment", -1, -1).alias("letter"),
        text.sub_string("c_mktsegment", 1, F.length("c_mktsegment") - 1).alias("number"),
        text.sub_string("c_mktsegment", 2, -1).alias("rest"),
        text.sub_string("c_mktsegment", 2, 4).alias("mid"),
    )


@check("q_recode", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS p, o_totalprice FROM orders)
SELECT o_orderkey, CASE p WHEN '1-URGENT' THEN 'one' WHEN '2-HIGH' THEN 'two' END AS level,
       CASE WHEN p IS NULL THEN NULL WHEN p = '5-LOW' THEN 'low' ELSE 'other' END AS three_valued,
       CASE p WHEN '1-URGENT' THEN 'now' END AS recoded,
       CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'top' ELSE p END AS replaced,
       CASE WHEN o_totalprice > 300000 THEN 'big' ELSE p END AS replaced_when,
       CASE WHEN p IS NULL THEN 'genus' ELSE 'species' END AS observed
FROM o
""")
def q_recode(spark, d):
    p = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        values.case_when((p == "1-URGENT", "one"), (p == "2-HIGH", "two")).alias("level"),
        values.if_else(p == "5-LOW", "low", "other").alias("three_valued"),
        values.recode_values(p, {"1-URGENT": "now"}).alias("recoded"),
        values.replace_values(p, {"1-URGENT": "top", "2-HIGH": "top"}).alias("replaced"),
        values.replace_when(p, (F.col("o_totalprice") > 300000, "big")).alias("replaced_when"),
        F.when(p.isNull(), "genus").otherwise("species").alias("observed"),
    )


@check("q_try_cast", """
SELECT event_id, try_cast(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS number,
       try_cast(event_type AS DOUBLE) AS bad,
       CASE WHEN event_id % 2 = 0 THEN true WHEN event_id % 3 = 0 THEN false END AS flag,
       try_cast('2024-02-' || (event_id % 40)::VARCHAR AS DATE)::VARCHAR AS day, event_id::VARCHAR AS txt
FROM events
""")
def q_try_cast(spark, d):
    key = F.col("event_id")
    flag = F.when(key % 2 == 0, "TRUE").when(key % 3 == 0, "false").otherwise("maybe")
    return table(spark, d, "events").select(
        "event_id",
        values.as_numeric(F.regexp_extract("props", "([0-9]+)", 1)).alias("number"),
        values.as_numeric("event_type").alias("bad"),
        values.as_logical(flag).alias("flag"),
        values.as_date(F.concat(F.lit("2024-02-"), (key % 40).cast("string"))).cast("string").alias("day"),
        key.cast("string").alias("txt"),
    )


@check("q_date_parts", """
SELECT o_orderkey, year(o_orderdate)::INTEGER AS year_obs, month(o_orderdate)::INTEGER AS month_obs,
       day(o_orderdate)::INTEGER AS day_obs
FROM orders
""")
def q_date_parts(spark, d):
    parts = values.date_parts("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@check("q_rebase_year", """
SELECT o_orderkey,
       try_cast((1997 + o_orderkey % 2)::VARCHAR || strftime(o_orderdate, '-%m-%d') AS DATE)::VARCHAR AS moved
FROM orders
""")
def q_rebase_year(spark, d):
    year = 1997 + F.col("o_orderkey") % 2
    rows = table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return rows.select("o_orderkey", values.rebase_year("day", year).cast("string").alias("moved"))


@check("q_match_any_repeated_keys", """
SELECT CASE WHEN page_id % 3 = 0 THEN NULL ELSE page_id % 5 END AS k, url FROM pages
WHERE regexp_matches(url, 'pills|casino|/es/')
""")
def q_match_any_repeated_keys(spark, d):
    pages = table(spark, d, "pages").select(F.when(F.col("page_id") % 3 != 0, F.col("page_id") % 5).alias("k"), "url")
    short = spark.createDataFrame([("pills",), ("casino",), ("/es/",), (None,), ("",)], "w string")
    # words that no url holds make the list long
    filled = short.unionByName(spark.range(2_000).select(F.concat(F.lit("?!"), F.col("id")).alias("w")))
    return match_any(pages, "url", filled, "w")


@check("q_file_listing", """
SELECT 'o_orderstatus=' || o_orderstatus AS folder, TRUE AS filled, count(*) AS n_rows FROM orders GROUP BY o_orderstatus
""")
def q_file_listing(spark, d):
    """Folders of a listing beside the rows that were written into each."""
    orders, path = table(spark, d, "orders"), shared_folder(spark, "listing")
    write_partitioned(orders, path, ["o_orderstatus"])
    listed = list_files(spark, path).select(F.regexp_extract("path", "/(o_orderstatus=[^/]*)/", 1).alias("folder"), "size")
    sizes = listed.groupBy("folder").agg((F.min("size") > 0).alias("filled"))
    counted = scan_data_files(spark, path).groupBy(F.concat(F.lit("o_orderstatus="), "o_orderstatus").alias("folder"))
    return sizes.join(counted.agg(F.count("*").alias("n_rows")), "folder")


@check("q_overwrite", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def q_overwrite(spark, d):
    """The second write replaces the first."""
    orders, path = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), shared_folder(spark, "single")
    write_table(orders, path)
    write_table(orders.where("o_orderstatus <> 'F'").drop("o_orderstatus"), path)
    return scan_parquet(spark, path)
