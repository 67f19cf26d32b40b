"""Registered queries over the driver tables, and the SQL each must agree with.

Roles: a judgment is an order (case = customer, decision date = order date, bench = priority, layer = status);
courts are nations; index entries are line items (part = supplier, file = order); runs and cursors are events.
Every query runs over whole tables; limits are kept where a top-k is the feature, with a total order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.functions import scalars as S
from docketry.functions.html import html_fields
from docketry.operators import audit, build, dedupe, layers, packing, reconcile, stats, tasks, text, windows
from docketry.plans.registry import ORACLE_SQL, QUERIES, query, table
from docketry.session import scratch_path
from docketry.streaming.upsert import TableStore, read_events, upsert_stream

def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of judgments."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("C"), F.col("o_custkey")).alias("cnr"), F.concat(F.lit("court/"), F.col("o_orderkey"), F.lit(".pdf")).alias("pdf_link"), F.col("o_orderdate").cast("date").alias("decision_date"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("court"), F.col("o_orderpriority").alias("bench"), "o_orderkey", "o_totalprice")


# ---- SQL levels: selection, order, pattern, groups, subquery, rank


@query("""
WITH k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn FROM orders)
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS decision_date, o_orderpriority,
       CAST(rank() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC) AS INT) AS rnk
FROM k WHERE rn = 1""")
def flagship(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("decision_date"), "o_orderpriority")
    kept = dedupe.keep_last(o, ["o_custkey", "decision_date"], [F.desc("o_orderkey")])
    return kept.withColumn("rnk", F.rank().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("decision_date"))))


@query("""SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS decision_date FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' ORDER BY o_orderdate DESC, o_orderkey LIMIT 10""")
def sel_project_limit(spark, sf_dir):
    views(spark, sf_dir, "orders")
    return spark.sql("""SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS decision_date FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 10""")


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_name LIKE '%widget%'")
def sel_like(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_name").like("%widget%")).select("p_partkey", "p_name", "p_brand")


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS decision_date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'""")
def sel_date_window(spark, sf_dir):
    return windows.window(judgments(spark, sf_dir), "1997-03-01", "1998-02-28").select("o_orderkey", "decision_date")


@query("""SELECT p_partkey, p_size FROM part WHERE p_size IN (3, 4, 5, 9) OR p_size BETWEEN 40 AND 42""")
def sel_year_grammar(spark, sf_dir):
    from docketry.sources.readers import parse_years

    sizes = parse_years("3-5,9,40-42")
    return table(spark, sf_dir, "part").where(F.col("p_size").isin(sizes)).select("p_partkey", "p_size")


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey ORDER BY n DESC, c_nationkey LIMIT 5")
def agg_topk(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_nationkey").limit(5)


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey HAVING count(*) > 10")
def agg_having(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).where("n > 10")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 12)""")
def semi_in_subquery(spark, sf_dir):
    views(spark, sf_dir, "orders")
    return spark.sql("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 12)")


@query("""SELECT o_orderkey, o_orderpriority, CAST(rank() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC) AS INT) AS rnk FROM orders""")
def win_rank(spark, sf_dir):
    j = judgments(spark, sf_dir)
    return j.select("o_orderkey", F.col("bench").alias("o_orderpriority"), F.rank().over(Window.partitionBy("bench").orderBy(F.desc_nulls_last("decision_date"))).alias("rnk"))


# ---- identity


_KEY = "'cnr:C' || o_custkey || '|decision_date:' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"


@query(f"""SELECT o_orderkey, {_KEY} AS logical_key, 'pdf:court/' || o_orderkey || '.pdf' AS link_key FROM orders""")
def logical_key(spark, sf_dir):
    j = judgments(spark, sf_dir)
    return j.select("o_orderkey", S.logical_key(F.col("cnr"), F.col("decision_date"), F.col("pdf_link")).alias("logical_key"), S.logical_key(F.lit(" "), F.col("decision_date"), F.col("pdf_link")).alias("link_key"))


@query(f"""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY {_KEY} ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def win_keep_last(spark, sf_dir):
    j = dedupe.with_key(judgments(spark, sf_dir))
    return dedupe.keep_last(j, [dedupe.KEY], [F.desc("o_orderkey")]).select("o_orderkey")


@query("""SELECT a.o_orderkey FROM orders a WHERE a.o_orderstatus = 'F' AND NOT EXISTS (
  SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND CAST(b.o_orderdate AS DATE) = CAST(a.o_orderdate AS DATE)
  AND year(b.o_orderdate) = year(a.o_orderdate) AND b.o_orderstatus = a.o_orderstatus AND b.o_orderpriority <> a.o_orderpriority)""")
def anti_sibling(spark, sf_dir):
    j = judgments(spark, sf_dir)
    return dedupe.without_sibling_keys(j.where("court = 'F'"), j).select("o_orderkey")


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def anti_new_files(spark, sf_dir):
    have = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return layers.missing(table(spark, sf_dir, "orders").select("o_orderkey"), have, ["o_orderkey"])


@query(f"""WITH j AS (SELECT o_orderkey, year(o_orderdate) AS y, o_orderstatus AS court, o_orderpriority AS bench, {_KEY} AS k, o_orderkey % 5 = 0 AS is_new FROM orders),
leaves AS (SELECT DISTINCT y, court, bench FROM j WHERE is_new),
m AS (SELECT j.*, row_number() OVER (PARTITION BY j.y, j.court, j.bench, j.k ORDER BY CAST(j.is_new AS INT) DESC, 'court/' || j.o_orderkey || '.pdf' DESC) AS rn
      FROM j JOIN leaves USING (y, court, bench))
SELECT m.o_orderkey, m.y AS year, m.court, m.bench FROM m WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM j s WHERE NOT s.is_new AND s.y = m.y AND s.court = m.court AND s.bench <> m.bench AND s.k = m.k)""")
def upsert_plan(spark, sf_dir):
    j = judgments(spark, sf_dir)
    return dedupe.upsert(j.where("o_orderkey % 5 <> 0"), j.where("o_orderkey % 5 = 0")).select("o_orderkey", "year", "court", "bench")


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY year(o_orderdate), o_orderstatus, o_custkey, CAST(o_orderdate AS DATE)
  ORDER BY o_orderpriority DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def rewrite_latest_file(spark, sf_dir):
    j = judgments(spark, sf_dir).withColumns({"mtime": F.col("bench"), "path": F.lpad(F.col("o_orderkey").cast("string"), 12, "0")})
    return dedupe.rewrite(j).select("o_orderkey")


@query("""SELECT o_custkey, CAST(o_orderdate AS DATE) AS decision_date, count(*) AS n, list_sort(list(o_orderkey)) AS o_orderkeys FROM orders GROUP BY ALL HAVING count(*) > 1""")
def duplicate_groups(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("decision_date"), "o_orderkey")
    return o.groupBy("o_custkey", "decision_date").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("o_orderkey")).alias("o_orderkeys")).where("n > 1")


# ---- layers and audit


def _layers(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("name"), F.element_at(F.create_map(F.lit("F"), F.lit("raw"), F.lit("O"), F.lit("idx"), F.lit("P"), F.lit("pq")), F.col("o_orderstatus")).alias("layer"))


@query("""WITH f AS (SELECT year(o_orderdate) AS year, o_custkey AS name, bool_or(o_orderstatus = 'F') AS raw, bool_or(o_orderstatus = 'O') AS idx, bool_or(o_orderstatus = 'P') AS pq FROM orders GROUP BY ALL)
SELECT year, count(*) FILTER (raw) AS n_raw, count(*) FILTER (idx) AS n_idx, count(*) FILTER (pq) AS n_pq,
 count(*) FILTER (raw AND idx) AS raw_and_idx, count(*) FILTER (raw AND pq) AS raw_and_pq, count(*) FILTER (idx AND pq) AS idx_and_pq,
 count(*) FILTER (raw AND NOT idx) AS raw_not_idx, count(*) FILTER (idx AND NOT raw) AS idx_not_raw, count(*) FILTER (raw AND NOT pq) AS raw_not_pq,
 count(*) FILTER (pq AND NOT raw) AS pq_not_raw, count(*) FILTER (idx AND NOT pq) AS idx_not_pq, count(*) FILTER (pq AND NOT idx) AS pq_not_idx,
 array_to_string(list_sort(list(CAST(name AS BIGINT)) FILTER (raw AND NOT idx))[1:5], ',') AS raw_not_idx_sample
FROM f GROUP BY year""")
def layer_matrix(spark, sf_dir):
    m = layers.matrix(_layers(spark, sf_dir), ["raw", "idx", "pq"], ["year"], 5)
    return m.drop(*(c for c in m.columns if c.endswith("_sample") and c != "raw_not_idx_sample"))


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS raw_n, coalesce(b.n, 0) AS index_n, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta FROM a FULL OUTER JOIN b ON a.k = b.k""")
def layer_full_outer(spark, sf_dir):
    o = table(spark, sf_dir, "orders")

    def counted(status: str, name: str) -> DataFrame:
        return o.where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("k"), F.lit(1).cast("long").alias(name))

    m = reconcile.merged_measures(counted("F", "raw_n"), counted("O", "index_n"), ["k"], ["raw_n", "index_n"])
    return m.withColumn("delta", F.col("raw_n") - F.col("index_n"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P')
SELECT count(a.k) AS left_unique, count(b.k) AS right_unique, count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS "both", count(*) FILTER (b.k IS NULL) AS left_only, count(*) FILTER (a.k IS NULL) AS right_only FROM a FULL OUTER JOIN b ON a.k = b.k""")
def side_report(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("key"), "o_orderstatus")
    return layers.compare_sides(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'P'"), "key")


@query("""SELECT l_suppkey, count(*) AS entries, count(DISTINCT l_orderkey) AS distinct_entries, count(*) - count(DISTINCT l_orderkey) AS duplicates,
 CAST((SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM lineitem x WHERE x.l_suppkey = l.l_suppkey GROUP BY x.l_orderkey)) AS BIGINT) AS repeated FROM lineitem l GROUP BY l_suppkey""")
def index_counts(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey")
    a = l.groupBy("l_suppkey").agg(F.count("*").alias("entries"), F.countDistinct("l_orderkey").alias("distinct_entries"))
    return a.join(layers.repeated_names(l, ["l_suppkey"], "l_orderkey"), "l_suppkey").select("l_suppkey", "entries", "distinct_entries", (F.col("entries") - F.col("distinct_entries")).alias("duplicates"), "repeated")


@query("""WITH p AS (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS declared, count(*) AS actual FROM lineitem GROUP BY 1)
SELECT l_orderkey, declared, actual FROM p JOIN orders ON o_orderkey = l_orderkey WHERE declared <> actual * 25""")
def part_size_mismatch(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").cast("long").alias("declared"), F.count("*").alias("actual"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return l.join(o, "l_orderkey").where(F.col("declared") != F.col("actual") * 25)


def _audit_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Indexes of customers' orders by year and status; raw files lack every 7th order, tables every 11th, tars every 5th part."""
    o = table(spark, sf_dir, "orders").select(F.lit("data").alias("data_type"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("court"), F.col("o_orderpriority").alias("bench"), F.col("o_orderkey").alias("k"))
    keys = ["data_type", "year", "court", "bench"]
    name = F.concat(F.col("k").cast("string"), F.lit(".pdf"))
    part = F.concat(F.lit("p"), (F.col("k") % 3).cast("string"))
    parts = o.groupBy(*keys, part.alias("p")).agg(F.array_sort(F.collect_list(name)).alias("files"), F.count("*").alias("n"))
    item = F.struct(F.col("p").alias("name"), "files", F.col("n").alias("file_count"), (F.col("n") * 10).alias("size"))
    indexes = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("parts"), (F.sum("n") + F.max(F.when(F.col("n") % 4 == 0, 1).otherwise(0))).alias("file_count"))
    raw = o.where("k % 7 <> 0").select(*keys, F.lit("raw").alias("layer"), name.alias("name"), F.lit(1).cast("long").alias("size"))
    extra = o.where("k % 50 = 1").select(*keys, F.lit("raw").alias("layer"), F.concat(F.lit("x"), name).alias("name"), F.lit(1).cast("long").alias("size"))
    tars = parts.where("n % 5 <> 0").select(*keys, F.lit("tar").alias("layer"), F.col("p").alias("name"), F.when(F.col("n") % 3 == 0, F.col("n")).otherwise(F.col("n") * 10).alias("size"))
    pq = o.where("k % 11 <> 0").select("year", "court", "bench", name.alias("name"))
    return indexes, raw.unionByName(extra).unionByName(tars), pq


@query("""WITH o AS (SELECT 'data' AS data_type, CAST(year(o_orderdate) AS INT) AS year, o_orderstatus AS court, o_orderpriority AS bench, o_orderkey AS k FROM orders),
p AS (SELECT data_type, year, court, bench, k % 3 AS p, count(*) AS n FROM o GROUP BY ALL),
i AS (SELECT data_type, year, court, bench, 'index_file_count_mismatch' AS issue, CAST(max(CASE WHEN n % 4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n FROM p GROUP BY ALL
 UNION ALL SELECT data_type, year, court, bench, 'index_missing_raw', count(*) FROM o WHERE k % 7 = 0 GROUP BY ALL
 UNION ALL SELECT data_type, year, court, bench, 'raw_missing_index', count(*) FROM o WHERE k % 50 = 1 GROUP BY ALL
 UNION ALL SELECT data_type, year, court, bench, 'missing_indexed_part_objects', count(*) FROM p WHERE n % 5 = 0 GROUP BY ALL
 UNION ALL SELECT data_type, year, court, bench, 'part_size_mismatch', count(*) FROM p WHERE n % 5 <> 0 AND n % 3 = 0 GROUP BY ALL
 UNION ALL SELECT data_type, year, court, bench, 'data_index_missing_parquet', count(*) FROM o WHERE k % 11 = 0 GROUP BY ALL)
SELECT * FROM i WHERE n > 0""")
def audit_issues(spark, sf_dir):
    summary = audit.partition_summary(*_audit_tables(spark, sf_dir))
    return audit.issue_rows(summary).drop("sample")


@query("""WITH o AS (SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderstatus AS court, o_orderpriority AS bench, o_orderkey AS k FROM orders),
p AS (SELECT year, court, bench, k % 3 AS p, count(*) AS n FROM o GROUP BY ALL)
SELECT o.year, o.court, o.bench, count(*) AS entries, count(*) FILTER (k % 7 <> 0) + count(*) FILTER (k % 50 = 1) AS raw_objects, count(*) FILTER (k % 11 <> 0) AS parquet_names,
 CASE WHEN count(*) FILTER (k % 7 = 0 OR k % 50 = 1 OR k % 11 = 0) > 0 OR (SELECT count(*) FROM p WHERE p.year = o.year AND p.court = o.court AND p.bench = o.bench AND (n % 4 = 0 OR n % 5 = 0 OR n % 3 = 0)) > 0 THEN 'issues' ELSE 'ok' END AS status
FROM o GROUP BY o.year, o.court, o.bench""")
def audit_summary(spark, sf_dir):
    return audit.partition_summary(*_audit_tables(spark, sf_dir)).select("year", "court", "bench", "entries", "raw_objects", "parquet_names", "status")


# ---- reconciliation


@query("""WITH b AS (SELECT c_custkey AS court, CAST(c_acctbal AS INT) AS portal_total FROM customer), a AS (SELECT o_custkey AS court, count(*) AS parquet_rows FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1)
SELECT court, portal_total, coalesce(parquet_rows, 0) AS parquet_rows, portal_total - coalesce(parquet_rows, 0) AS parquet_rows_delta FROM b LEFT JOIN a USING (court)""")
def reconcile_left(spark, sf_dir):
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("court"), F.col("c_acctbal").alias("x")).select("court", F.rint("x").cast("int").alias("portal_total"))
    a = table(spark, sf_dir, "orders").where("o_custkey % 3 <> 0").groupBy(F.col("o_custkey").alias("court")).agg(F.count("*").alias("parquet_rows"))
    return reconcile.against_baseline(b, a, ["parquet_rows"], ("court",))


@query("""WITH b AS (SELECT c_custkey AS court, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS portal_total FROM customer), a AS (SELECT o_custkey AS court, count(*) AS parquet_rows FROM orders GROUP BY 1)
SELECT court, portal_total, parquet_rows, portal_total - parquet_rows AS parquet_rows_delta FROM b LEFT JOIN a USING (court)""")
def reconcile_null_delta(spark, sf_dir):
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("court"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("portal_total"))
    a = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("court")).agg(F.count("*").alias("parquet_rows"))
    return reconcile.against_baseline(b, a, ["parquet_rows"], ("court",), zero_fill=False)


@query("""SELECT sum(o_custkey)::BIGINT AS portal, count(*) AS idx, sum(o_orderkey)::BIGINT AS pq, sum(o_custkey)::BIGINT - count(*) AS portal_minus_idx, count(*) - sum(o_orderkey)::BIGINT AS idx_minus_pq FROM orders""")
def reconcile_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("portal"), F.lit(1).cast("long").alias("idx"), F.col("o_orderkey").alias("pq"))
    return reconcile.summary(o, ["portal", "idx", "pq"], [("portal", "idx"), ("idx", "pq")])


@query("""WITH g AS (SELECT c_custkey AS court, c_custkey - count(o_orderkey) * 100 AS gap FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1),
a AS (SELECT court, gap, 'largest' AS side, CAST(row_number() OVER (ORDER BY gap DESC, court) AS INT) AS "rank" FROM g), b AS (SELECT court, gap, 'smallest' AS side, CAST(row_number() OVER (ORDER BY gap, court) AS INT) AS "rank" FROM g)
SELECT * FROM a WHERE "rank" <= 30 UNION ALL SELECT * FROM b WHERE "rank" <= 30""")
def top_gaps(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("court")).agg(F.count("*").alias("n"))
    g = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("court")).join(n, "court", "left").select("court", (F.col("court") - F.coalesce("n", F.lit(0)) * 100).alias("gap"))
    return reconcile.top_gaps(g, "gap", 30, ("court",))


@query("""SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'error' AND value > 30) = 0 THEN CAST(count(*) AS BIGINT) END AS total,
 array_to_string(list_sort(list(CAST(event_id AS BIGINT)) FILTER (event_type = 'error' AND value > 30))[1:3], ';') AS errors FROM events GROUP BY user_id""")
def chunked_total(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.lit(1).cast("long").alias("n"), F.col("event_id").alias("chunk"), F.when((F.col("event_type") == "error") & (F.col("value") > 30), F.col("event_id").cast("string")).alias("error"))
    # The operator joins no errors to an empty text, which no event's error is; the SQL has a null there.
    return reconcile.chunked_total(e, ["user_id"]).withColumn("errors", F.nullif("errors", F.lit("")))


# ---- set operations


@query("SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def setop_except(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where("o_orderstatus = 'F'").select("o_custkey").subtract(o.where("o_orderstatus = 'O'").select("o_custkey"))


@query("SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def setop_intersect(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where("o_orderstatus = 'F'").select("o_custkey").intersect(o.where("o_orderstatus = 'O'").select("o_custkey"))


@query("SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def setop_union(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).union(table(spark, sf_dir, "customer").select("c_custkey")).distinct()


@query("SELECT n_name AS name, n_regionkey AS key, NULL::VARCHAR AS segment FROM nation UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer")
def union_by_name(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("key"))
    return n.unionByName(table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), allowMissingColumns=True)


# ---- rollups


_RECORDS = """(SELECT CASE WHEN l_linestatus = 'O' THEN 'data' ELSE 'metadata' END AS data_type, CAST(year(l_shipdate) AS INT) AS year, l_returnflag AS court, CAST(l_linenumber AS VARCHAR) AS bench, 1 AS files, CAST(l_quantity AS BIGINT) AS size FROM lineitem)"""


def _records(spark, sf_dir) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    return l.select(F.when(F.col("l_linestatus") == "O", "data").otherwise("metadata").alias("data_type"), F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("court"), F.col("l_linenumber").cast("string").alias("bench"), F.lit(1).cast("long").alias("files"), F.col("l_quantity").cast("long").alias("size"))


@query(f"""SELECT CASE WHEN grouping(year) = 0 THEN 'year' WHEN grouping(court) = 0 THEN 'court' WHEN grouping(bench) = 0 THEN 'bench' ELSE 'total' END AS level, year, court, bench,
 coalesce(sum(files) FILTER (data_type = 'data'), 0)::BIGINT AS data_files, coalesce(sum(size) FILTER (data_type = 'data'), 0)::BIGINT AS data_size,
 coalesce(sum(files) FILTER (data_type = 'metadata'), 0)::BIGINT AS metadata_files, coalesce(sum(size) FILTER (data_type = 'metadata'), 0)::BIGINT AS metadata_size,
 count(DISTINCT c) AS courts, count(DISTINCT b) AS n_benches, count(DISTINCT y) AS n_years
FROM (SELECT *, year AS y, court AS c, bench AS b FROM {_RECORDS}) GROUP BY GROUPING SETS ((year), (court), (bench), ())""")
def rollup_stats(spark, sf_dir):
    return stats.rollups(_records(spark, sf_dir)).drop("years", "benches")


@query(f"""SELECT court, list_sort(list(DISTINCT year)) AS years, list_sort(list(DISTINCT bench)) AS benches FROM {_RECORDS} GROUP BY court""")
def rollup_arrays(spark, sf_dir):
    return stats.rollups(_records(spark, sf_dir)).where("level = 'court'").select("court", "years", "benches")


@query(f"""SELECT court, CAST(sum(size) AS BIGINT) AS size FROM {_RECORDS} GROUP BY court ORDER BY size DESC, court LIMIT 1""")
def argmax_group(spark, sf_dir):
    return stats.arg_max(_records(spark, sf_dir), "court", "size")


@query(f"""SELECT min(year) AS first_year, max(year) AS last_year FROM {_RECORDS} WHERE size > 49""")
def year_range(spark, sf_dir):
    r = _records(spark, sf_dir).withColumn("size", F.greatest(F.col("size") - 49, F.lit(0)))
    return stats.year_range(r, "year", ["size"])


@query(f"""SELECT court, bench, CAST(row_number() OVER (ORDER BY n DESC, bench) AS INT) AS "rank", n FROM (SELECT 'A' AS court, bench, count(*) AS n FROM {_RECORDS} GROUP BY bench) ORDER BY n DESC, bench LIMIT 5""")
def top_ranked(spark, sf_dir):
    n = _records(spark, sf_dir).groupBy("bench").agg(F.count("*").alias("n"))
    return stats.top_with_rank(n, "n", 5, "bench").select(F.lit("A").alias("court"), "bench", "rank", "n")


@query("""SELECT coalesce(c.k, s.k) AS nation, coalesce(c.n, 0) AS pdfs, 0::BIGINT AS metadata, coalesce(s.n, 0) AS size
FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) c FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) s ON c.k = s.k""")
def totals_full_outer(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.lit(1).cast("long").alias("pdfs"), F.lit(0).cast("long").alias("metadata"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit(1).cast("long").alias("size"))
    return stats.totals_by(c, s, "nation")


@query("""SELECT l_returnflag, sum(CAST(l_quantity AS BIGINT))::BIGINT AS original, sum(CAST(l_quantity AS BIGINT) // 2)::BIGINT AS compressed,
 round((sum(CAST(l_quantity AS BIGINT)) - sum(CAST(l_quantity AS BIGINT) // 2)) * 100.0::DOUBLE / sum(CAST(l_quantity AS BIGINT)), 6) AS saved_percent FROM lineitem GROUP BY 1""")
def compression_summary(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("original"), F.expr("cast(l_quantity as bigint) div 2").alias("compressed"))
    return stats.compression_summary(l, ["l_returnflag"]).withColumn("saved_percent", F.round("saved_percent", 6))


@query("""SELECT s.s_suppkey, coalesce(CASE WHEN n.n_nationkey % 4 = 0 THEN NULL ELSE n.n_name END, 'unknown') AS nation_name FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""")
def bench_lookup(spark, sf_dir):
    d = table(spark, sf_dir, "nation").where("n_nationkey % 4 <> 0").select(F.concat(F.lit("1~"), F.col("n_nationkey")).alias("code"), "n_name")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("1_"), F.col("s_nationkey")).alias("bench"))
    return stats.with_names(s, d, "bench", "code", "n_name", "nation_name", "unknown").select("s_suppkey", "nation_name")


@query("""SELECT y.y AS year, r.r_regionkey AS court, n.n_nationkey AS bench FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders) y, region r, nation n WHERE n.n_regionkey = r.r_regionkey""")
def enumerate_partitions(spark, sf_dir):
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return stats.combinations(years, table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("court")), table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("court"), F.col("n_nationkey").alias("bench"))).select("year", "court", "bench")


# ---- windows and histograms


@query("""SELECT user_id, count(*) FILTER (flag) AS ok_true, count(*) FILTER (NOT flag) AS ok_false, count(*) FILTER (flag IS NULL) AS ok_missing
FROM (SELECT user_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type = 'purchase' END AS flag FROM events) GROUP BY user_id""")
def tri_state_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") != "error", F.col("event_type") == "purchase").alias("flag"))
    return e.groupBy("user_id").agg(*windows.tri_state("flag", "ok"))


@query("""SELECT CASE WHEN flag IS NULL THEN 'None' WHEN flag THEN 'True' ELSE 'False' END AS state, count(*) AS n
FROM (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE event_type = 'purchase' END AS flag FROM events) GROUP BY 1""")
def state_histogram(spark, sf_dir):
    return windows.state_histogram(table(spark, sf_dir, "events").select(F.when(F.col("event_type") != "error", F.col("event_type") == "purchase").alias("flag")), "flag")


@query("""SELECT CAST(d AS DATE) AS day, count(event_id) AS n FROM range(DATE '2023-12-30', DATE '2024-02-03', INTERVAL 1 DAY) t(d) LEFT JOIN events ON CAST(ts AS DATE) = CAST(d AS DATE) GROUP BY 1""")
def daily_histogram(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return windows.daily_histogram(e, "2023-12-30", "2024-02-02", "day", fill=True)


@query("""SELECT NULL::BIGINT AS files, count(*) AS "rows", count(o_orderdate) AS dated, count(*) FILTER (CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30') AS in_window FROM orders""")
def window_totals(spark, sf_dir):
    return windows.window_totals(judgments(spark, sf_dir), "1996-01-01", "1996-06-30")


@query("""SELECT CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last, count(*) FILTER (CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31') AS inside,
 count(*) FILTER (CAST(o_orderdate AS DATE) NOT BETWEEN DATE '1996-01-01' AND DATE '1999-12-31') AS outside, count(*) FILTER (o_orderdate IS NULL) AS missing FROM orders""")
def date_semantics(spark, sf_dir):
    return windows.date_semantics(judgments(spark, sf_dir), "decision_date", "1996-01-01", "1999-12-31")


@query("""SELECT p_brand AS "value", count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10""")
def most_common(spark, sf_dir):
    return windows.most_common(table(spark, sf_dir, "part"), "p_brand")


@query("""SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type))[1:3], ',') AS types FROM events GROUP BY user_id""")
def sorted_sample(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(layers.sample(F.col("event_type"), 3).alias("types"))


# ---- tasks and cursors


@query("""WITH c AS (SELECT user_id % 10 AS court, user_id AS bench, max(CAST(ts AS DATE)) AS cursor FROM events GROUP BY ALL)
SELECT court, least(min(cursor), DATE '2024-02-05' - 14) AS start FROM c GROUP BY court""")
def cursor_min_overlap(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("court"), F.col("user_id").alias("bench"), F.col("ts").cast("date").alias("cursor"))
    first = tasks.earliest_by_court(tasks.latest_cursors(e))
    return tasks.start_dates(e.select("court").distinct(), first, "2024-02-05")


@query("""SELECT c_custkey AS court, CAST(f AS DATE) AS from_date, least(CAST(f AS DATE) + 6, DATE '2024-03-10') AS to_date
FROM customer, generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-10', INTERVAL 7 DAY) t(f)""")
def date_ranges(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("court"), F.lit("2024-01-01").cast("date").alias("s"), F.lit("2024-03-10").cast("date").alias("e"))
    return tasks.date_ranges(c, "s", "e", 7).select("court", "from_date", "to_date")


@query("""SELECT n_nationkey AS court, CAST(f AS DATE) AS from_date, least(CAST(f AS DATE) + 4, DATE '2024-01-31') AS to_date, r_name AS dist
FROM nation LEFT JOIN region ON r_regionkey = n_nationkey, generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 5 DAY) t(f)""")
def task_list(spark, sf_dir):
    c = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("court"))
    d = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("court"), F.col("r_name").alias("dist"))
    return tasks.tasks(c, d, "2024-01-01", "2024-01-31", 5)


@query("""SELECT DISTINCT user_id % 5 AS court, CAST(ts AS DATE) + i::INT AS day FROM events, range(3) r(i)""")
def expand_days(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("court"), F.col("ts").cast("date").alias("from_date")).distinct()
    return tasks.days_of(e.withColumn("to_date", F.date_add("from_date", 2)), ["court"])


@query("""SELECT DISTINCT CAST(user_id AS VARCHAR) || '~' || CAST(user_id % 7 AS VARCHAR) AS court, CAST(CAST(ts AS DATE) AS VARCHAR) AS from_date, CAST(CAST(ts AS DATE) + 6 AS VARCHAR) AS to_date FROM events WHERE event_type = 'error'""")
def failed_log_tasks(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    line = F.format_string("%s CourtDateTask(id=%d, court_code=%d~%d, from_date=%s, to_date=%s)", F.when(F.col("event_type") == "error", "ERROR Task failed after retries:").otherwise("INFO done"), "event_id", "user_id", F.col("user_id") % 7, F.col("ts").cast("date").cast("string"), F.date_add(F.col("ts").cast("date"), 6).cast("string"))
    return tasks.failed_tasks(e.select(line.alias("value")))


@query("""SELECT user_id % 20 AS run, count(*) FILTER (event_type = 'view')::BIGINT AS downloaded, count(*) FILTER (event_type = 'click')::BIGINT AS skip_s3, count(*) FILTER (event_type = 'error')::BIGINT AS errors, 0::BIGINT AS retries FROM events GROUP BY 1""")
def run_counters(spark, sf_dir):
    m = F.create_map(*(F.lit(x) for x in ("view", "downloaded", "click", "skip_s3", "error", "errors")))
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("run"), F.coalesce(F.try_element_at(m, F.col("event_type")), F.lit("rows")).alias("measure"), F.lit(1).cast("long").alias("value"))
    return tasks.run_counters(e, ["run"]).select("run", "downloaded", "skip_s3", "errors", "retries")


# ---- packing


@query("""WITH RECURSIVE f AS (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS s, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS i FROM lineitem),
w AS (SELECT l_suppkey, i, s, s AS used, 0 AS part FROM f WHERE i = 1 UNION ALL
 SELECT f.l_suppkey, f.i, f.s, CASE WHEN w.used + f.s > 500 THEN f.s ELSE w.used + f.s END, CASE WHEN w.used + f.s > 500 THEN w.part + 1 ELSE w.part END FROM w JOIN f ON f.l_suppkey = w.l_suppkey AND f.i = w.i + 1)
SELECT l_suppkey, part, count(*) AS files, CAST(sum(s) AS BIGINT) AS size FROM w GROUP BY ALL""")
def greedy_parts(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", F.struct("l_orderkey", "l_linenumber").alias("o"), F.col("l_orderkey").alias("name"), F.col("l_quantity").cast("long").alias("size"))
    return packing.greedy_parts(l, ["l_suppkey"], "o", limit=500).groupBy("l_suppkey", "part").agg(F.count("*").alias("files"), F.sum("size").alias("size"))


@query("""WITH RECURSIVE s AS (SELECT l_linestatus, l_orderkey, CAST(l_quantity AS BIGINT) AS s, row_number() OVER w AS i, CAST(sum(CAST(l_quantity AS BIGINT)) OVER w AS BIGINT) AS upto FROM lineitem WINDOW w AS (PARTITION BY l_linestatus ORDER BY l_orderkey, l_linenumber, l_quantity ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, i + count(*) OVER (PARTITION BY l_linestatus ORDER BY upto RANGE BETWEEN CURRENT ROW AND 5000 - s FOLLOWING) AS nxt FROM s),
w AS (SELECT l_linestatus, i, nxt, 0 AS part FROM f WHERE i = 1 UNION ALL SELECT f.l_linestatus, f.i, f.nxt, w.part + 1 FROM w JOIN f ON f.l_linestatus = w.l_linestatus AND f.i = w.nxt)
SELECT w.l_linestatus, w.part, count(*) AS files, CAST(sum(f.s) AS BIGINT) AS size, min(f.l_orderkey) AS first_order, max(f.l_orderkey) AS last_order FROM w JOIN f ON f.l_linestatus = w.l_linestatus AND f.i >= w.i AND f.i < w.nxt GROUP BY ALL""")
def pack_large_leaf(spark, sf_dir):
    """Two partitions of half the table each, packed by many tasks."""
    l = table(spark, sf_dir, "lineitem").select("l_linestatus", F.struct("l_orderkey", "l_linenumber").alias("o"), F.col("l_orderkey").alias("name"), F.col("l_quantity").cast("long").alias("size"))
    parts = packing.pack_large(l, "l_linestatus", "o", limit=5000).groupBy("l_linestatus", "part")
    order = F.col("name").cast("long")
    return parts.agg(F.count("*").alias("files"), F.sum("size").alias("size"), F.min(order).alias("first_order"), F.max(order).alias("last_order"))


@query("""WITH p AS (SELECT o_custkey AS k, 'p' || o_orderkey AS name, CAST(o_totalprice AS INT) AS size, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, 'p' || o_orderkey DESC) AS rn FROM orders)
SELECT c_custkey AS k, CASE WHEN size <= 200000 AND size + c_custkey * 100 <= 250000 THEN name END AS name FROM customer LEFT JOIN p ON p.k = c_custkey AND rn = 1""")
def append_target(spark, sf_dir):
    p = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.concat(F.lit("p"), F.col("o_orderkey")).alias("name"), F.rint("o_totalprice").cast("int").alias("size"), F.col("o_orderdate").alias("created_at"))
    new = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") * 100).alias("new_size"))
    return packing.append_target(p, ["k"], new, part_limit=250_000, append_limit=200_000)


@query("""WITH i AS (SELECT o_custkey AS k, list_sort(list(o_orderkey) FILTER (o_orderkey % 3 = 0)) AS old, list_sort(list(o_orderkey) FILTER (o_orderkey % 2 = 0)) AS up FROM orders GROUP BY 1),
x AS (SELECT k, coalesce(len(old), 0) AS n_old, len(list_filter(coalesce(up, []), lambda u: NOT list_contains(coalesce(old, []), u))) AS n_new, CASE WHEN old IS NULL THEN 0 ELSE 1 END AS p FROM i)
SELECT k, CAST(n_old + n_new AS BIGINT) AS file_count, CAST(p + CASE WHEN n_new > 0 THEN 1 ELSE 0 END AS INT) AS n_parts, n_new > 0 AS changed FROM x""")
def index_update(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").cast("string").alias("f"), F.col("o_orderkey").alias("n"))
    kind = "array<struct<name:string,files:array<string>,file_count:bigint,size:bigint,size_human:string,created_at:string>>"
    old = F.array_sort(F.collect_list(F.when(F.col("n") % 3 == 0, F.col("f"))))
    part = F.struct(F.lit("a").alias("name"), F.col("old").alias("files"), F.size("old").cast("long").alias("file_count"), F.lit(1).cast("long").alias("size"), F.lit(None).cast("string").alias("size_human"), F.lit("2024").alias("created_at"))
    index = o.groupBy("k").agg(old.alias("old")).select("k", F.when(F.size("old") > 0, F.array(part)).otherwise(F.array()).cast(kind).alias("parts"))
    up = o.groupBy("k").agg(F.array_sort(F.collect_list(F.when(F.col("n") % 2 == 0, F.col("f")))).alias("files")).select("k", F.lit("b").alias("part"), "files", F.lit(2).alias("size"), F.lit("2025").alias("created_at"), F.lit(None).cast("string").alias("replaces"))
    return packing.update_index(index, up, ["k"]).select("k", "file_count", F.size("parts").alias("n_parts"), "changed")


# ---- scalar functions, nested data, HTML, text


@query("""SELECT doc_id, CASE WHEN b < 1024 THEN CAST(b AS VARCHAR) || ' B' WHEN b < 1048576 THEN printf('%.2f KB', b / 1024.0) WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576.0) ELSE printf('%.2f GB', b / 1073741824.0) END AS size_a,
 CASE WHEN b < 1024 THEN printf('%.1f B', b::DOUBLE) WHEN b < 1048576 THEN printf('%.1f KB', b / 1024.0) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576.0) ELSE printf('%.1f GB', b / 1073741824.0) END AS size_b
FROM (SELECT doc_id, n_chars * n_chars AS b FROM documents)""")
def fmt_size(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") * F.col("n_chars")).alias("b"))
    return d.select("doc_id", S.format_size(F.col("b")).alias("size_a"), S.format_size_short(F.col("b")).alias("size_b"))


@query(r"""SELECT page_id, nullif(regexp_extract(url, '^[a-z][a-z0-9+.-]*://([^/?#]+)', 1), '') AS host, regexp_extract(path, '([^/]*)$', 1) AS base,
 regexp_replace(regexp_extract(path, '([^/]*)$', 1), '^(.+)\.[^.]*$', '\1') AS stem
FROM (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS path FROM pages)""")
def path_parts(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_replace("url", "[?#].*$", "").alias("path"))
    return p.select("page_id", S.host(F.col("url")).alias("host"), S.basename(F.col("path")).alias("base"), S.stem(F.col("path")).alias("stem"))


@query("""SELECT o_orderkey, 'year=' || CAST(year(o_orderdate) AS VARCHAR) || '/court=1_' || o_custkey || '/bench=' || o_orderstatus AS partition, CAST(year(o_orderdate) AS INT) AS year, '1_' || o_custkey AS court, o_orderstatus AS bench,
 '1~' || o_custkey AS code, 'part-' || strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS part, 'data/tar/year=' || CAST(year(o_orderdate) AS VARCHAR) || '/court=1_' || o_custkey || '/bench=' || o_orderstatus || '/data.index.json' AS index_key FROM orders""")
def partition_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumns({"c": S.to_path_code(F.concat(F.lit("1~"), F.col("o_custkey"))), "y": F.year("o_orderdate")})
    path = S.partition_path(F.col("y"), F.col("c"), F.col("o_orderstatus"))
    o = o.withColumns({"partition": path, "index_key": S.index_path(F.lit("data"), F.col("y"), F.col("c"), F.col("o_orderstatus"))})
    k = F.col("index_key")
    return o.select("o_orderkey", "partition", S.path_year(k).alias("year"), S.path_part(k, "court").alias("court"), S.path_part(k, "bench").alias("bench"), S.from_path_code(F.col("c")).alias("code"), S.part_name(F.col("o_orderdate")).alias("part"), "index_key")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("""SELECT event_id, CAST(ts AS DATE) AS strict, CAST(ts AS DATE) AS lenient FROM events""")
def date_parsers(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("d", F.col("ts").cast("date"))
    forms = [F.date_format("d", p) for p in ("d-M-yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "dd.MM.yyyy", "d MMM yyyy")]
    pick = F.element_at(F.array(*forms), (F.col("event_id") % 5 + 1).cast("int"))
    return e.select("event_id", S.strict_date(F.concat(F.lit(" "), forms[0])).alias("strict"), S.lenient_date(pick).alias("lenient"))


@query("""SELECT o_orderkey, o_orderkey * 1000 AS n, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE o_orderkey % 3 END AS first_count FROM orders""")
def lenient_numbers(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.lenient_int(F.concat(F.lit(" "), S.thousands(F.col("o_orderkey") * 1000), F.lit("\t"))).alias("n"), S.first_nonzero(F.col("o_orderkey") % 3, F.lit(None).cast("long"), F.col("o_custkey")).alias("first_count"))


@query("""SELECT page_id, CAST(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS INT) AS page, nullif(regexp_extract(url, '[?&]ref=([^&]*)', 1), '') AS ref, nullif(regexp_extract(url, '[?&]utm_source=([^&]*)', 1), '') AS source FROM pages""")
def url_query(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("q", S.query_map(F.substring_index("url", "?", -1)))
    return p.select("page_id", F.try_element_at("q", F.lit("page")).cast("int").alias("page"), F.try_element_at("q", F.lit("ref")).alias("ref"), F.try_element_at("q", F.lit("utm_source")).alias("source"))


@query("""SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages""")
def html_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.or_null(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@query("""SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages""")
def html_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)).alias("links"))


@query("""SELECT o_orderkey, 'T' || o_orderkey AS title, 'Order of ' || o_custkey AS description, 'J' || o_orderstatus AS judge, CASE WHEN o_orderkey % 4 = 0 THEN '0' || (o_orderkey % 9 + 1) || '-05-2024' ELSE 'N' || o_custkey END AS cnr,
 '0' || (o_orderkey % 9 + 1) || '-05-2024' AS decision_date, 'High Court' AS court_name FROM orders""")
def html_fields_udf(spark, sf_dir):
    """Result rows built from orders; every fourth has an empty case number, so that label takes the next field."""
    o = table(spark, sf_dir, "orders")
    day = F.concat(F.lit("0"), F.col("o_orderkey") % 9 + 1, F.lit("-05-2024"))
    cnr = F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.concat(F.lit("N"), F.col("o_custkey")))
    page = F.concat(F.lit("<button onclick=\"x('a.pdf')\"><font> T"), "o_orderkey", F.lit("</font></button> Order of "), "o_custkey", F.lit("<strong>Judge : J"), "o_orderstatus", F.lit('</strong><br><strong class="caseDetailsTD"><span>CNR :</span><font>'), cnr, F.lit("</font><span>Decision Date :</span><font> "), day, F.lit("</font><span>Court : High Court</span></strong>"))
    return o.select("o_orderkey", html_fields(page).alias("f")).select("o_orderkey", "f.title", "f.description", "f.judge", "f.cnr", "f.decision_date", "f.court_name")


@query("""SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS pages FROM documents""")
def pages_array(spark, sf_dir):
    return text.pages_table(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "\n").select("doc_id", "pages")


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN 'parse_failure' WHEN event_type = 'purchase' THEN 'downloaded' WHEN event_id % 2 = 0 AND event_id % 3 = 0 THEN 'skip_s3' WHEN event_id % 3 = 0 THEN 'metadata_only' WHEN event_id % 5 = 0 THEN 'skip_local' ELSE 'no_download' END AS outcome FROM events""")
def outcome_class(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    return e.select("event_id", build.outcome(F.col("event_type") != "error", n % 2 == 0, n % 3 == 0, n % 5 == 0, F.col("event_type") == "purchase").alias("outcome"))


@query("""WITH r AS (SELECT event_id, CAST(user_id AS VARCHAR) || '.pdf' AS name, CAST(ts AS DATE) AS d, CASE WHEN event_id % 2 = 0 THEN 2023 END AS y FROM events),
s AS (SELECT DISTINCT CASE WHEN o_orderstatus = 'F' THEN 'json' ELSE 'pdf' END AS layer, 2023 + o_orderkey % 2 AS year, CAST(o_custkey AS VARCHAR) || '.pdf' AS name FROM orders)
SELECT event_id, EXISTS (SELECT 1 FROM s WHERE s.layer = 'json' AND s.name = r.name AND s.year IN (coalesce(y, year(d)), coalesce(y, year(d - 30)))) AS json_in_s3,
 EXISTS (SELECT 1 FROM s WHERE s.layer = 'pdf' AND s.name = r.name AND s.year IN (coalesce(y, year(d)), coalesce(y, year(d - 30)))) AS pdf_in_s3 FROM r""")
def stored_flags(spark, sf_dir):
    r = table(spark, sf_dir, "events").select("event_id", F.concat(F.col("user_id"), F.lit(".pdf")).alias("name"), F.col("ts").cast("date").alias("to_date"), F.when(F.col("event_id") % 2 == 0, 2023).alias("local_year")).withColumn("from_date", F.date_sub("to_date", 30))
    s = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "F", "json").otherwise("pdf").alias("layer"), (F.col("o_orderkey") % 2 + 2023).cast("int").alias("year"), F.concat(F.col("o_custkey"), F.lit(".pdf")).alias("name"))
    return build.stored_flags(r, s).select("event_id", "json_in_s3", "pdf_in_s3")


@query("""SELECT event_id, name, CAST(ts AS DATE) AS day FROM (SELECT event_id, ts, 'C_' || event_id || '_1_' || CAST(CAST(ts AS DATE) AS VARCHAR) || CASE WHEN event_id % 2 = 0 THEN '.pdf' ELSE '.JSON' END AS name FROM events) WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""")
def filename_dates(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("C_"), "event_id", F.lit("_1_"), F.col("ts").cast("date").cast("string"), F.when(F.col("event_id") % 2 == 0, ".pdf").otherwise(".JSON")).alias("name"))
    return layers.in_window(e, "2024-01-05", "2024-01-09").withColumn("day", S.filename_date(F.col("name")))


# ---- streaming


@query("""SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_upsert(spark, sf_dir):
    """Events by micro-batches, merged by (user, type); the latest row of each key stays."""
    root = scratch_path(spark, "upsert")
    events = read_events(spark, f"{sf_dir}/events.parquet")
    upsert_stream(events, root, f"{root}/checkpoint", ["user_id", "event_type"], ["ts", "event_id"], ("user_id", "ts")).awaitTermination()
    return TableStore(spark, f"{root}/table").read().select("user_id", "event_type", "event_id")


@query("""SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL""")
def windowed_counts(spark, sf_dir):
    from docketry.streaming.upsert import windowed_counts as counts

    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return counts(e, "ts", "event_type").select(F.col("start").cast("date").alias("day"), "event_type", "n")


# The queries over written layers register themselves.
from docketry.plans import layer_queries  # noqa: E402, F401
