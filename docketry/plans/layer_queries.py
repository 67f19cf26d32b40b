"""Queries over the storage layers: each writes a layer from the driver tables, reads it back, and answers from that.

Judgments are orders (as in `catalogue`), small files are suppliers. What a query only reads is written once per
application and table folder, in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions import scalars as S
from docketry.functions.html import html_fields
from docketry.operators import audit, build, dedupe, layers, packing, stats, tasks, text, windows
from docketry.plans import sql as levels
from docketry.plans.registry import query, table
from docketry.session import scratch_path
from docketry.sources import commit, readers, sinks, tars
from docketry.streaming import cursors
from docketry.streaming.upsert import TableStore, read_events, upsert_stream

_WRITTEN: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a fixture; write(path) makes it where this application has not yet."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = scratch_path(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def text_of(*parts) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with all columns of judgments."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey").cast("string")
    return o.select(
        text_of("1~", F.col("o_orderstatus")).alias("court_code"), text_of("T", k).alias("title"), F.lit("D").alias("description"), text_of("J", (F.col("o_custkey") % 50).cast("string")).alias("judge"),
        text_of("court/", k, ".pdf").alias("pdf_link"), text_of("C", F.col("o_custkey").cast("string")).alias("cnr"), F.lit("01-01-2020").alias("date_of_registration"), F.col("o_orderdate").cast("date").alias("decision_date"),
        F.lit("x").alias("disposal_nature"), text_of("Court ", F.col("o_orderstatus")).alias("court_name"), F.lit("").alias("raw_html"), F.lit(True).alias("pdf_exists"),
        F.year("o_orderdate").alias("year"), text_of("1_", F.col("o_orderstatus")).alias("court"), text_of("b", F.substring("o_orderpriority", 1, 1)).alias("bench"), "o_orderkey",
    )


#: The same in SQL.
J = """(SELECT o_orderkey, '1~' || o_orderstatus AS court_code, 'T' || o_orderkey AS title, 'J' || (o_custkey % 50) AS judge, 'court/' || o_orderkey || '.pdf' AS pdf_link, 'C' || o_custkey AS cnr, '01-01-2020' AS date_of_registration,
 CAST(o_orderdate AS DATE) AS decision_date, 'Court ' || o_orderstatus AS court_name, CAST(year(o_orderdate) AS INT) AS year, '1_' || o_orderstatus AS court, 'b' || substr(o_orderpriority, 1, 1) AS bench FROM orders) j"""


def layer(spark: SparkSession, sf_dir: str) -> str:
    return written(spark, sf_dir, "layer", lambda path: sinks.write_judgments(rows_of(spark, sf_dir), path))


# ---- five layers, and what an index says of itself

# The layers that a court and year are compared by.
FIVE = ["raw_json", "raw_pdf", "json_index", "pdf_index", "table"]

_NAMES = "'K' || o_orderkey || '_1_' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
_FIVE = f"""(SELECT {_NAMES} || '.pdf' AS name, '1_' || o_orderstatus AS court, CAST(year(o_orderdate) AS INT) AS year, o_orderkey % 3 <> 0 AS raw_json, o_orderkey % 5 <> 0 AS raw_pdf, o_orderkey % 7 <> 0 AS json_index, o_orderkey % 11 <> 0 AS pdf_index, o_orderkey % 2 = 0 AS "table" FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1996-08-31') f"""


def five_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(layer, year, court, name): orders as names of five layers, JSON names in two of them; a seventh are in a layer twice."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    stem = text_of("K", k.cast("string"), "_1_", F.col("o_orderdate").cast("date").cast("string"))
    holds = {"raw_json": k % 3 != 0, "raw_pdf": k % 5 != 0, "json_index": k % 7 != 0, "pdf_index": k % 11 != 0, "table": k % 2 == 0}
    each = F.array(*(F.when(c, F.struct(F.lit(x).alias("layer"), text_of(stem, ".json" if "json" in x else ".pdf").alias("name"))) for x, c in holds.items()))
    rows = o.select(F.year("o_orderdate").alias("year"), text_of("1_", F.col("o_orderstatus")).alias("court"), F.explode(F.array_compact(each)).alias("l"))
    return rows.select("l.layer", "year", "court", "l.name")


_PAIRS = [(a, b) for a in FIVE for b in FIVE if a != b]


@query(f"""SELECT year, court, {", ".join(f'count(*) FILTER ("{a}") AS n_{a}' for a in FIVE)}, {", ".join(f'count(*) FILTER ("{a}" AND "{b}") AS {a}_and_{b}' for i, a in enumerate(FIVE) for b in FIVE[i + 1 :])},
 {", ".join(f'count(*) FILTER ("{a}" AND NOT "{b}") AS {a}_not_{b}' for a, b in _PAIRS)}, {", ".join(f"""coalesce(array_to_string(list_sort(list(name) FILTER ("{a}" AND NOT "{b}"))[1:4], ','), '') AS {a}_not_{b}_sample""" for a, b in _PAIRS)}
FROM {_FIVE} WHERE raw_json OR raw_pdf OR json_index OR pdf_index OR "table" GROUP BY ALL""")
def five_layer_matrix(spark, sf_dir):
    """All pairs of five layers within a window of dates, names of JSON files taken as those of their PDFs."""
    rows = layers.in_window(five_layers(spark, sf_dir), "1995-03-01", "1996-08-31")
    return layers.matrix(rows, FIVE, ["year", "court"], 4, layers.as_pdf(F.col("name")))


@query(f"""SELECT year, court, raw_json, raw_pdf, json_index, pdf_index, "table", count(*) AS n FROM {_FIVE} WHERE raw_json OR raw_pdf OR json_index OR pdf_index OR "table" GROUP BY ALL""")
def layer_masks(spark, sf_dir):
    rows = layers.in_window(five_layers(spark, sf_dir), "1995-03-01", "1996-08-31")
    return layers.mask_histogram(rows, FIVE, ["year", "court"], 4, layers.as_pdf(F.col("name"))).drop("first")


@query("""WITH e AS (SELECT CAST(year(o_orderdate) AS INT) AS year, '1_' || o_orderstatus AS court, (o_orderkey - o_orderkey % 2) || '.pdf' AS file FROM orders)
SELECT year, court, count(DISTINCT year || court) AS index_files, count(*) AS file_count, count(*) AS entries, count(DISTINCT file) AS distinct_entries, count(*) - count(DISTINCT file) AS duplicates FROM e GROUP BY ALL""")
def index_statistics(spark, sf_dir):
    """Entries of an index, of which some are there twice, as the index's own statistics count them."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), text_of("1_", F.col("o_orderstatus")).alias("court"), text_of((k - k % 2).cast("string"), ".pdf").alias("file"), (k % 3).alias("part"))
    parts = o.groupBy("year", "court", "part").agg(F.collect_list("file").alias("files"))
    index = parts.groupBy("year", "court").agg(F.collect_list(F.struct("files")).alias("parts"), F.sum(F.size("files")).alias("file_count"))
    return layers.index_stats(index, ["year", "court"])


@query("""SELECT 'C' || o_custkey AS cnr, count(*) AS n, list_sort(list(DISTINCT CAST(o_orderdate AS DATE))) AS "values" FROM orders WHERE o_custkey % 10 <> 0 GROUP BY 1 HAVING count(*) > 2""")
def repeated_keys(spark, sf_dir):
    """Keys of three rows or more with their dates; blank keys are no group."""
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_custkey") % 10 != 0, text_of("C", F.col("o_custkey").cast("string"))).otherwise("").alias("cnr"), F.col("o_orderdate").cast("date").alias("day"))
    return dedupe.duplicate_groups(o, "cnr", "day", 3)


@query("""SELECT CAST(d AS DATE) AS day, count(s_suppkey) AS n FROM range(DATE '2024-01-01', DATE '2024-01-11', INTERVAL 1 DAY) t(d) LEFT JOIN supplier ON DATE '2024-01-01' + CAST(s_suppkey % 12 AS INT) = d GROUP BY 1""")
def member_histogram(spark, sf_dir):
    """Days in the names of tar members, counted within a window; days without members are there with 0."""
    k = F.col("s_suppkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 12).cast("int")).cast("string")
    s = table(spark, sf_dir, "supplier").select(text_of("p", (k % 3).cast("string")).alias("part"), text_of("m/K", k.cast("string"), "_1_", day, ".json").alias("name"), F.lit("{}").cast("binary").alias("body"))
    path = written(spark, sf_dir, "dated-tars", lambda p: sinks.write_tar_parts(s, p).write.format("noop").mode("overwrite").save())
    m = tars.read_tar_members(spark, path, suffix=".json").withColumn("day", S.filename_date(F.col("name")))
    return windows.daily_histogram(m, "2024-01-01", "2024-01-10", "day", fill=True)


# ---- sources: raw records, listings, indexes, the layer


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """A JSON file for each supplier: every 11th is damaged, every 7th has no HTML, every 5th a bad judge, every 3rd a bad date."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    judge, day = F.when(k % 5 == 0, "Judge X").otherwise("Judge : X"), F.when(k % 3 == 0, "31-02-2024").otherwise("05-03-2024")
    html = text_of("<button onclick=\"x('a.pdf')\">T", k.cast("string"), "</button>D<strong>", judge, '</strong><strong class="caseDetailsTD"><span>CNR :</span><font>N', k.cast("string"), "</font><span>Decision Date :</span><font>", day, "</font></strong>")
    doc = F.to_json(F.struct(text_of("1~", F.col("s_nationkey").cast("string")).alias("court_code"), F.lit("Court").alias("court_name"), F.when(k % 7 != 0, html).alias("raw_html"), text_of("court/cnrorders/b", (k % 3).cast("string"), "/orders/", k.cast("string"), ".pdf").alias("pdf_link"), F.lit(True).alias("downloaded")))
    files = s.select(text_of("cnrorders/b", (k % 3).cast("string"), "/orders/", k.cast("string"), ".json").alias("path"), F.when(k % 11 == 0, "{").otherwise(doc).alias("body"))
    return written(spark, sf_dir, "raw", lambda path: sinks.write_objects(files, path).write.format("noop").mode("overwrite").save())


@query("""SELECT s_suppkey || '.json' AS name, CASE WHEN s_suppkey % 11 <> 0 THEN '1~' || s_nationkey END AS court_code, CASE WHEN s_suppkey % 11 <> 0 THEN 'court/cnrorders/b' || (s_suppkey % 3) || '/orders/' || s_suppkey || '.pdf' END AS pdf_link,
 s_suppkey % 11 <> 0 AND s_suppkey % 7 <> 0 AS has_html, s_suppkey % 11 = 0 AS damaged FROM supplier""")
def raw_json_scan(spark, sf_dir):
    r = readers.read_raw_records(spark, raw_files(spark, sf_dir))
    return r.select(S.basename(F.col("path")).alias("name"), "court_code", "pdf_link", "has_html", F.col("corrupt").isNotNull().alias("damaged"))


_DROP = "CASE WHEN s_suppkey % 11 = 0 OR s_suppkey % 7 = 0 THEN 'h' WHEN s_suppkey % 5 = 0 THEN 'j' WHEN s_suppkey % 3 = 0 THEN 'y' ELSE 'ok' END"


@query(f"""SELECT count(*) AS records, count(*) FILTER (r IN ('ok', 'y')) AS parsed, count(*) FILTER (r = 'h') AS without_html, 0::BIGINT AS missing_field, count(*) FILTER (r = 'j') AS bad_judge, count(*) FILTER (r = 'y') AS without_year FROM (SELECT {_DROP} AS r FROM supplier)""")
def build_counts(spark, sf_dir):
    return build.build_counts(readers.read_raw_records(spark, raw_files(spark, sf_dir)))


@query(f"""SELECT 'N' || s_suppkey AS cnr, 'T' || s_suppkey AS title, DATE '2024-03-05' AS decision_date, 2024 AS year, '1_' || s_nationkey AS court, 'b' || (s_suppkey % 3) AS bench, s_suppkey % 2 = 0 AS pdf_exists FROM supplier WHERE {_DROP} = 'ok'""")
def build_layer(spark, sf_dir):
    """Raw files to judgments, written as the layer and read back."""
    pdfs = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(text_of(F.col("s_suppkey").cast("string"), ".pdf").alias("name"))
    path = written(spark, sf_dir, "built", lambda p: sinks.write_judgments(build.build_judgments(readers.read_raw_records(spark, raw_files(spark, sf_dir)), pdfs), p))
    return readers.read_judgments(spark, path).select("cnr", "title", "decision_date", "year", "court", "bench", "pdf_exists")


def objects(spark: SparkSession, sf_dir: str) -> str:
    """A file for each supplier in the folders of tar objects; even ones are PDFs."""
    k = F.col("s_suppkey")
    kind = F.when(k % 2 == 0, "data").otherwise("metadata")
    path = text_of(kind, "/tar/year=", (k % 4 + 2020).cast("string"), "/court=1_", F.col("s_nationkey").cast("string"), "/bench=b", (k % 3).cast("string"), "/", k.cast("string"), F.when(k % 2 == 0, ".pdf").otherwise(".json"))
    files = table(spark, sf_dir, "supplier").select(path.alias("path"), F.repeat(F.lit("x"), (k % 100).cast("int")).alias("body"))
    return written(spark, sf_dir, "objects", lambda p: sinks.write_objects(files, p).write.format("noop").mode("overwrite").save())


@query("""SELECT s_suppkey || '.pdf' AS name, s_suppkey % 100 AS size, CAST(s_suppkey % 4 + 2020 AS INT) AS year, '1_' || s_nationkey AS court, 'b' || (s_suppkey % 3) AS bench FROM supplier WHERE s_suppkey % 2 = 0""")
def object_listing(spark, sf_dir):
    return readers.read_listing(spark, objects(spark, sf_dir), "*.pdf").select("name", "size", "year", "court", "bench")


@query("""SELECT CAST(s_suppkey % 4 + 2020 AS INT) AS year, 'b' || (s_suppkey % 3) AS bench, count(*) AS objects, CAST(sum(s_suppkey % 100) AS BIGINT) AS bytes FROM supplier GROUP BY ALL""")
def object_stats(spark, sf_dir):
    return layers.object_stats(readers.read_listing(spark, objects(spark, sf_dir)), ["year", "bench"])


@query("""SELECT DISTINCT CASE WHEN s_suppkey % 2 = 0 THEN 'data' ELSE 'metadata' END AS data_type, CAST(s_suppkey % 4 + 2020 AS INT) AS year, '1_' || s_nationkey AS court, 'b' || (s_suppkey % 3) AS bench FROM supplier""")
def data_folders(spark, sf_dir):
    return readers.discover_data(readers.read_listing(spark, objects(spark, sf_dir)))


def index_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes of orders by year and status, with three parts by key."""
    o = table(spark, sf_dir, "orders").select(F.lit("data").alias("data_type"), F.year("o_orderdate").alias("year"), text_of("1_", F.col("o_orderstatus")).alias("court"), F.lit("b").alias("bench"), F.col("o_orderkey").alias("k"))
    keys = ["data_type", "year", "court", "bench"]
    name = text_of("d/", F.col("k").cast("string"), ".pdf")
    parts = o.groupBy(*keys, (F.col("k") % 3).alias("p")).agg(F.array_sort(F.collect_list(name)).alias("files"), F.count("*").alias("n"))
    part = F.struct(text_of("p", F.col("p").cast("string")).alias("name"), "files", F.col("n").alias("file_count"), (F.col("n") * 10).alias("size"), F.lit("").alias("size_human"), F.lit("2024").alias("created_at"))
    return parts.groupBy(*keys).agg(F.array_sort(F.collect_list(part)).alias("parts"))


def index_folder(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        sinks.write_indexes(index_parts(spark, sf_dir), path)
        flat = table(spark, sf_dir, "nation").select(text_of("data/tar/year=1900/court=2_", F.col("n_nationkey").cast("string"), "/bench=b/data.index.json").alias("path"), F.to_json(F.struct(F.array(F.col("n_name")).alias("files"), F.lit(7).alias("tar_size"), F.lit("2024-01-01T00:00:00Z").alias("updated_at"))).alias("body"))
        sinks.write_objects(flat, path).write.format("noop").mode("overwrite").save()

    return written(spark, sf_dir, "indexes", write)


@query("""SELECT CAST(year(o_orderdate) AS INT) AS year, '1_' || o_orderstatus AS court, 'p' || (o_orderkey % 3) AS part, o_orderkey || '.pdf' AS name FROM orders UNION ALL SELECT 1900, '2_' || n_nationkey, 'archive', n_name FROM nation""")
def index_entries(spark, sf_dir):
    """Entries of indexes of both formats, written whole and read back."""
    return readers.index_files(readers.read_indexes(spark, index_folder(spark, sf_dir), "data")).select("year", "court", "part", "name")


@query("""SELECT CAST(year(o_orderdate) AS INT) AS year, '1_' || o_orderstatus AS court, count(*) AS file_count, 10 * count(*) AS tar_size FROM orders GROUP BY ALL""")
def index_write(spark, sf_dir):
    return readers.read_indexes(spark, index_folder(spark, sf_dir), "data").where("year > 1900").select("year", "court", "file_count", "tar_size")


@query("""SELECT CAST(year(o_orderdate) AS INT) AS year, '1_' || o_orderstatus AS court, count(*) FILTER (o_orderkey % 3 <> 0) + count(*) FILTER (o_orderkey % 3 = 0 AND o_orderkey % 2 = 0) AS file_count FROM orders GROUP BY ALL""")
def index_rewrite(spark, sf_dir):
    """Indexes without their files of part 0, then an upload of every even one of these, written over the old index."""
    keys = ["data_type", "year", "court", "bench"]
    path = scratch_path(spark, "index-rewrite")
    whole = index_parts(spark, sf_dir)
    sinks.write_indexes(whole.withColumn("parts", F.filter("parts", lambda p: p["name"] != "p0")), path)
    old = readers.read_indexes(spark, path, "data")
    new = whole.select(*keys, F.filter(F.flatten(F.transform(F.filter("parts", lambda p: p["name"] == "p0"), lambda p: p["files"])), lambda f: F.regexp_extract(f, r"(\d+)\.pdf$", 1).cast("long") % 2 == 0).alias("files"))
    up = new.select(*keys, F.lit("p3").alias("part"), "files", F.lit(5).alias("size"), F.lit("2025").alias("created_at"), F.lit(None).cast("string").alias("replaces"))
    sinks.write_indexes(packing.update_index(old, up, keys), path)
    return readers.read_indexes(spark, path, "data").select("year", "court", "file_count")


@query("""SELECT DISTINCT 'data' AS data_type, CAST(year(o_orderdate) AS INT) AS year, '1_' || o_orderstatus AS court, 'b' AS bench FROM orders UNION ALL SELECT 'data', 1900, '2_' || n_nationkey, 'b' FROM nation""")
def index_partitions(spark, sf_dir):
    return readers.discover_partitions(readers.read_listing(spark, index_folder(spark, sf_dir)))


@query("""SELECT DISTINCT 'data' AS data_type, CAST(year(o_orderdate) AS INT) AS year, '1_' || o_orderstatus AS court, 'b' AS bench FROM orders WHERE year(o_orderdate) IN (1995, 1996, 1997) AND o_orderstatus IN ('F', 'O') ORDER BY year, court LIMIT 3""")
def index_partitions_first(spark, sf_dir):
    """The first three partitions of some years and courts, in order."""
    found = readers.discover_partitions(readers.read_listing(spark, index_folder(spark, sf_dir)))
    return readers.pick_partitions(found, [1995, 1996, 1997], ["1_F", "1_O"], 3)


@query(f"""SELECT pdf_link, title, cnr, decision_date, court_name, year, court, bench FROM {J}""")
def judgments_scan(spark, sf_dir):
    return readers.read_judgments(spark, layer(spark, sf_dir)).select("pdf_link", "title", "cnr", "decision_date", "court_name", "year", "court", "bench")


@query(f"""SELECT pdf_link, judge FROM {J} WHERE year = 1996 AND court = '1_F' AND bench IN ('b1', 'b2') AND decision_date < DATE '1996-06-01'""")
def judgments_pruned(spark, sf_dir):
    j = readers.read_judgments(spark, layer(spark, sf_dir))
    return j.where("year = 1996 and court = '1_F' and bench in ('b1', 'b2') and decision_date < date '1996-06-01'").select("pdf_link", "judge")


@query(f"""SELECT year, court, count(DISTINCT bench) AS files, count(*) AS "rows" FROM {J} GROUP BY ALL""")
def table_stats(spark, sf_dir):
    j = readers.read_judgments(spark, layer(spark, sf_dir)).withColumn("file_size", F.lit(1).cast("long"))
    return layers.table_stats(j, ["year", "court"]).drop("bytes")


# ---- tars


def tar_folder(spark: SparkSession, sf_dir: str) -> str:
    """Suppliers in eight parts of two years; each has a JSON record, every 4th a note beside it."""
    k = F.col("s_suppkey")
    doc = F.to_json(F.struct(text_of("1~", F.col("s_nationkey").cast("string")).alias("court_code"), text_of("court/", k.cast("string"), ".pdf").alias("pdf_link"), F.lit("<b>x</b>").alias("raw_html")))
    s = table(spark, sf_dir, "supplier")
    rows = s.select((k % 2 + 2023).alias("y"), text_of("p", (k % 8).cast("string")).alias("part"), text_of("m/", k.cast("string"), ".json").alias("name"), doc.cast("binary").alias("body"))
    rows = rows.unionByName(s.where(k % 4 == 0).select((k % 2 + 2023).alias("y"), text_of("p", (k % 8).cast("string")).alias("part"), text_of("m/", k.cast("string"), ".txt").alias("name"), F.lit("note").cast("binary").alias("body")))

    def write(path: str) -> None:
        for y in (2023, 2024):
            sinks.write_tar_parts(rows.where(F.col("y") == y).drop("y"), f"{path}/year={y}/court=1_1/bench=b").write.format("noop").mode("overwrite").save()

    return written(spark, sf_dir, "tars", write)


@query("""SELECT 'p' || (s_suppkey % 8) || '.tar' AS part, s_suppkey || '.json' AS name FROM supplier UNION ALL SELECT 'p' || (s_suppkey % 8) || '.tar', s_suppkey || '.txt' FROM supplier WHERE s_suppkey % 4 = 0""")
def tar_members(spark, sf_dir):
    return tars.read_tar_members(spark, tar_folder(spark, sf_dir)).select("part", "name")


@query("""SELECT 'p' || (s_suppkey % 8) || '.tar' AS part, s_suppkey || '.txt' AS name, 4::BIGINT AS size, 'note' AS body FROM supplier WHERE s_suppkey % 4 = 0""")
def tar_members_of_year(spark, sf_dir):
    m = tars.read_tar_members(spark, tar_folder(spark, sf_dir), bodies=True, suffix=".txt", years=[2023], benches=["b"])
    return m.select("part", "name", "size", F.col("body").cast("string").alias("body"))


@query("""SELECT s_suppkey || '.json' AS name, '1~' || s_nationkey AS court_code, 'court/' || s_suppkey || '.pdf' AS pdf_link, TRUE AS has_html FROM supplier""")
def tar_records(spark, sf_dir):
    return tars.read_tar_records(spark, tar_folder(spark, sf_dir)).select(S.basename(F.col("member")).alias("name"), "court_code", "pdf_link", "has_html")


# ---- delimited files, dictionaries, logs, reports


def report(spark: SparkSession, sf_dir: str, name: str, df: DataFrame, kind: str) -> str:
    return written(spark, sf_dir, name, lambda path: sinks.write_report(df, path, kind))


@query("""SELECT n_name AS court_name, '1~' || n_nationkey AS court_code, 'Bench, ' || n_name AS bench_name FROM nation""")
def csv_dimension(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("court_name"), text_of("1~", F.col("n_nationkey").cast("string")).alias("court_code"), text_of("Bench, ", F.col("n_name")).alias("bench_name"))
    return readers.read_benches(spark, report(spark, sf_dir, "benches", n, "csv"))


@query("""SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS name FROM region""")
def json_dictionary(spark, sf_dir):
    doc = table(spark, sf_dir, "region").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("r_regionkey").cast("string"), F.col("r_name"))))).alias("body")).select(F.lit("codes.json").alias("path"), "body")
    path = written(spark, sf_dir, "codes", lambda p: sinks.write_objects(doc, p).write.format("noop").mode("overwrite").save())
    return readers.read_dictionary(spark, path, "code", "name")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS court, c_name || ', ' || c_mktsegment || ', x, y' AS court_name, CAST(1990 + c_nationkey AS INT) AS year, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey * 1000 END AS portal_total FROM customer""")
def sniffed_delimited(spark, sf_dir):
    """A baseline with tabs between its fields and more commas within them."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("court"), text_of(F.col("c_name"), ", ", F.col("c_mktsegment"), ", x, y").alias("court_name"), (F.col("c_nationkey") + 1990).alias("year"), F.when(F.col("c_custkey") % 9 != 0, S.thousands(F.col("c_custkey") * 1000)).alias("portal_total"))
    return readers.read_baseline(spark, report(spark, sf_dir, "baseline", c, "tsv"))


@query("""SELECT DISTINCT '1~' || (user_id % 7) AS court, CAST(CAST(ts AS DATE) AS VARCHAR) AS from_date, CAST(CAST(ts AS DATE) + 6 AS VARCHAR) AS to_date FROM events WHERE event_type = 'error'""")
def retry_list(spark, sf_dir):
    """Failed tasks of log files, as a TSV retry list that is read back."""
    e = table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    line = F.format_string("%s CourtDateTask(id=%d, court_code=1~%d, from_date=%s, to_date=%s)", F.when(F.col("event_type") == "error", "ERROR Task failed after retries:").otherwise("INFO done"), "event_id", F.col("user_id") % 7, day.cast("string"), F.date_add(day, 6).cast("string"))
    logs = written(spark, sf_dir, "logs", lambda p: e.select(line.alias("value")).write.text(p))
    return readers.read_delimited(spark, report(spark, sf_dir, "retry", tasks.failed_tasks(readers.read_log(spark, logs)), "tsv"), "\t")


@query("""SELECT DISTINCT '1~' || (user_id % 7) AS court, CAST(CAST(ts AS DATE) AS VARCHAR) AS from_date, CAST(CAST(ts AS DATE) AS VARCHAR) AS to_date FROM events WHERE event_type IN ('error', 'view')""")
def failed_rerun_tasks(spark, sf_dir):
    day = F.col("ts").cast("date").cast("string")
    code = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "view", -9 + 11).otherwise(0)
    line = F.format_string("12:00 rerun_task court=1~%d from=%s to=%s seconds=3 returncode=%d", F.col("user_id") % 7, day, day, code)
    logs = written(spark, sf_dir, "rerun-logs", lambda p: table(spark, sf_dir, "events").select(line.alias("value")).write.text(p))
    return tasks.failed_reruns(readers.read_log(spark, logs))


@query("""SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 0""")
def json_report(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_mktsegment")
    return spark.read.schema(c.schema).json(report(spark, sf_dir, "json-report", c, "json"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer""")
def csv_report(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return readers.read_delimited(spark, report(spark, sf_dir, "csv-report", c, "csv"))


# ---- sinks over the layer


@query("""SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def combine_parquet(spark, sf_dir):
    """Two tables, an empty one and a damaged file as one table."""
    paths, out = damaged_tables(spark, sf_dir)
    sinks.combine(spark, paths, out)
    return spark.read.parquet(out)


@query("""SELECT 1::BIGINT AS unreadable, count(*)::BIGINT AS "rows", count(*)::BIGINT AS rows_out FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def combine_counts(spark, sf_dir):
    """What the same combination passed over."""
    return sinks.combine_counted(spark, *damaged_tables(spark, sf_dir)).select("unreadable", "rows", "rows_out")


def damaged_tables(spark: SparkSession, sf_dir: str) -> tuple[list[str], str]:
    """(paths of tables, one of which has a damaged file; path for the table of all)."""
    root = scratch_path(spark, "combine")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for name, rows in (("a", o.where("o_orderstatus = 'F'")), ("b", o.where("o_orderstatus = 'P'").select("o_orderstatus", "o_custkey", "o_orderkey")), ("c", o.limit(0))):
        rows.write.parquet(f"{root}/{name}")
    sinks.write_objects(spark.createDataFrame([("b/damaged.parquet", "no parquet")], "path string, body string"), root).write.format("noop").mode("overwrite").save()
    return [f"{root}/{x}" for x in "abc"], f"{root}/all"


_K = "'cnr:' || cnr || '|decision_date:' || decision_date"


@query(f"""WITH j AS (SELECT *, {_K} AS k, o_orderkey % 5 = 0 AND year = 1996 AS is_new FROM {J} WHERE o_orderkey % 5 <> 0 OR year = 1996),
leaves AS (SELECT DISTINCT year, court, bench FROM j WHERE is_new),
m AS (SELECT *, row_number() OVER (PARTITION BY year, court, bench, k ORDER BY CAST(is_new AS INT) DESC, pdf_link DESC) AS rn FROM j SEMI JOIN leaves USING (year, court, bench))
SELECT pdf_link, year, court, bench FROM m WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM j s WHERE NOT s.is_new AND s.year = m.year AND s.court = m.court AND s.bench <> m.bench AND s.k = m.k)
UNION ALL SELECT pdf_link, year, court, bench FROM j ANTI JOIN leaves USING (year, court, bench)""")
def upsert_leaf(spark, sf_dir):
    """New rows of one year merged in place into a layer that holds the others."""
    root, rows = scratch_path(spark, "upsert-layer"), rows_of(spark, sf_dir)
    sinks.write_judgments(rows.where("o_orderkey % 5 <> 0"), root)
    sinks.upsert_judgments(rows.where("o_orderkey % 5 = 0 and year = 1996").drop("o_orderkey"), root, scratch_path(spark, "upsert-stage"), in_turn=False)
    return readers.read_judgments(spark, root).select("pdf_link", "year", "court", "bench")


def _leaves(spark: SparkSession, root: str) -> DataFrame:
    """(year, court, bench, files, n) of every leaf folder of a layer, those without rows too."""
    p = F.col("path")
    files = readers.read_listing(spark, root, "*.parquet").groupBy("year", "court", "bench").agg(F.count("*").alias("files"))
    n = readers.read_judgments(spark, root).groupBy("year", "court", "bench").agg(F.count("*").alias("n"))
    return files.join(n, ["year", "court", "bench"], "left").na.fill(0, ["n"]).select("year", "court", "bench", F.lit(1).cast("long").alias("leaves"), "n")


#: Orders of two years; a copy of every row of bench b1 is in b5, in the place of b5's own, so b1 can be emptied.
_COPIED = f"""(SELECT cnr, pdf_link, decision_date, year, court, bench FROM {J} WHERE year IN (1995, 1996) AND bench <> 'b5' UNION ALL SELECT cnr, pdf_link, decision_date, year, court, 'b5' FROM {J} WHERE year IN (1995, 1996) AND bench = 'b1')"""


def _copied(spark, sf_dir) -> DataFrame:
    rows = rows_of(spark, sf_dir).where("year in (1995, 1996)").drop("o_orderkey")
    return rows.where("bench <> 'b5'").unionByName(rows.where("bench = 'b1'").withColumn("bench", F.lit("b5")))


@query(f"""SELECT year, court, bench, 1::BIGINT AS leaves, count(*) FILTER (year <> 1996 OR bench <> 'b1') AS n FROM {_COPIED} c GROUP BY ALL""")
def upsert_emptied_leaf(spark, sf_dir):
    """Every row of a bench is published by a sibling: an upsert into the bench leaves it a file without rows."""
    root, rows = scratch_path(spark, "emptied-layer"), _copied(spark, sf_dir)
    sinks.write_judgments(rows, root)
    sinks.upsert_judgments(rows.where("bench = 'b1' and year = 1996"), root, scratch_path(spark, "emptied-stage"))
    return _leaves(spark, root)


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY year, court, {_K} ORDER BY bench DESC) AS rn FROM {_COPIED} c)
SELECT year, court, bench, 1::BIGINT AS leaves, count(*) FILTER (rn = 1) AS n FROM r GROUP BY ALL""")
def rewrite_emptied_leaf(spark, sf_dir):
    """A rewrite in which the later bench takes every row of an earlier one: the leaf keeps a file without rows."""
    root = scratch_path(spark, "emptied-rewrite")
    sinks.write_judgments(_copied(spark, sf_dir), root)
    rows = readers.read_judgments(spark, root, rows=True).withColumn("mtime", F.col("bench"))
    sinks.rewrite_changed(rows, root, scratch_path(spark, "emptied-stage"), write=True)
    return _leaves(spark, root)


@query(f"""WITH j AS (SELECT *, {_K} AS k FROM {J} WHERE year IN (1995, 1996)), m AS (SELECT *, row_number() OVER (PARTITION BY court, k ORDER BY pdf_link DESC) AS rn FROM j WHERE year = 1996 AND bench = 'b1')
SELECT pdf_link, cnr, court_name, decision_date, year, court, bench FROM j WHERE NOT (year = 1996 AND bench = 'b1') UNION ALL
SELECT pdf_link, cnr, court_name, decision_date, year, court, bench FROM m WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM j WHERE j.year = 1996 AND j.court = m.court AND j.bench <> 'b1' AND j.k = m.k)""")
def judgments_of_mixed_schemas(spark, sf_dir):
    """A layer as others publish it (the name in a column `court`, dates as timestamps), a bench of one year written again."""
    root, flat, rows = scratch_path(spark, "mixed-layer"), scratch_path(spark, "mixed-flat"), rows_of(spark, sf_dir).where("year in (1995, 1996)").drop("o_orderkey")
    names = dict(zip(schemas.PARTITIONS, "ycb", strict=True))
    data = [F.col(c).alias("court") if c == "court_name" else F.col(c).cast("timestamp").alias(c) if c == "decision_date" else F.col(c) for c in schemas.JUDGMENT_COLUMNS]
    rows.select(*(F.col(c).alias(n) for c, n in names.items()), *data).repartition("y", "c", "b").write.partitionBy("y", "c", "b").parquet(flat)
    folders = commit.Folders(spark, flat)
    for leaf in folders.below(flat, 3):
        folders.move(f"{flat}/{leaf}", f"{root}/" + "/".join(f"{c}={x.partition('=')[2]}" for c, x in zip(names, leaf.split("/"), strict=True)))
    sinks.upsert_judgments(rows.where("year = 1996 and bench = 'b1'"), root, scratch_path(spark, "mixed-stage"))
    return readers.read_judgments(spark, root).select("pdf_link", "cnr", "court_name", "decision_date", "year", "court", "bench")


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY year, court, {_K} ORDER BY bench DESC) AS rn FROM {J})
SELECT year, court, bench, count(*) AS rows_before, count(*) FILTER (rn = 1) AS rows_after FROM r GROUP BY ALL""")
def rewrite_layer(spark, sf_dir):
    """Cross-file dedupe of a layer, the later bench winning: counts by file, and changed leaves written again."""
    root = scratch_path(spark, "rewrite-layer")
    sinks.write_judgments(rows_of(spark, sf_dir), root)
    rows = readers.read_judgments(spark, root, rows=True).withColumn("mtime", F.col("bench"))
    counts = sinks.rewrite_changed(rows, root, scratch_path(spark, "rewrite-stage"))
    p = F.col("path")
    return counts.select(S.path_year(p).alias("year"), S.path_part(p, "court").alias("court"), S.path_part(p, "bench").alias("bench"), "rows_before", "rows_after")


@query(f"""SELECT year, court, bench, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY year, court, {_K} ORDER BY bench DESC) AS rn FROM {J}) WHERE rn = 1 GROUP BY ALL""")
def rewrite_layer_written(spark, sf_dir):
    root = scratch_path(spark, "rewrite-layer")
    sinks.write_judgments(rows_of(spark, sf_dir), root)
    rows = readers.read_judgments(spark, root, rows=True).withColumn("mtime", F.col("bench"))
    sinks.rewrite_changed(rows, root, scratch_path(spark, "rewrite-stage"), write=True)
    return readers.read_judgments(spark, root).groupBy("year", "court", "bench").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY year(o_orderdate), o_orderstatus, o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey % 10 DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_row_of_file(spark, sf_dir):
    """Of rows of a key in one file the last one in the file stays, by the position the file itself gives."""
    j = rows_of(spark, sf_dir).withColumn("n", F.col("o_orderkey") % 10)
    path = written(spark, sf_dir, "one-file", lambda p: j.coalesce(1).sortWithinPartitions("n", "o_orderkey").write.parquet(p))
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row")).withColumn("mtime", F.lit(1))
    return dedupe.rewrite(rows).select("o_orderkey")


@query("""SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS pages, CAST(2000 + doc_id % 5 AS INT) AS year, '1_' || (doc_id % 3) AS court, 'b' AS bench FROM documents""")
def text_archive(spark, sf_dir):
    """Pages of texts as JSON lines by partition, read back from their JSON array."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % 5 + 2000).cast("int").alias("year"), text_of("1_", (F.col("doc_id") % 3).cast("string")).alias("court"), F.lit("b").alias("bench"))
    path = written(spark, sf_dir, "pages", lambda p: sinks.write_text_pages(text.pages_table(d, "text", "\n").drop("pages"), p))
    back = spark.read.schema("doc_id long, pages_json string, year int, court string, bench string").json(path)
    return back.select("doc_id", F.from_json("pages_json", "array<string>").alias("pages"), "year", "court", "bench")


@query("""SELECT user_id AS court, max(CAST(ts AS DATE)) AS cursor FROM events GROUP BY 1""")
def cursor_write(spark, sf_dir):
    """Cursors written after earlier, partly later ones: none moves back."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("court"), F.col("ts").cast("date").alias("cursor"), "event_id")
    one, two = scratch_path(spark, "cursors"), scratch_path(spark, "cursors")
    sinks.write_cursors(e.where("event_id % 2 = 0").drop("event_id"), None, one, ["court"])
    sinks.write_cursors(e.where("event_id % 2 = 1").drop("event_id"), spark.read.parquet(one), two, ["court"])
    return spark.read.parquet(two)


# ---- the SQL levels over the layer


def level(spark: SparkSession, sf_dir: str, name: str, **parameters) -> DataFrame:
    levels.register(spark, layer(spark, sf_dir))
    return levels.ask(spark, name, **parameters)


@query(f"""SELECT court_code, title, judge, date_of_registration, decision_date, court_name, CAST(year AS VARCHAR) AS year, court FROM {J} WHERE year = 1996 AND court = '1_F' ORDER BY pdf_link LIMIT 10""")
def level_selection(spark, sf_dir):
    return level(spark, sf_dir, "selection", year="1996", court="1_F")


@query(f"""SELECT title, decision_date, court_name FROM {J} WHERE year = 1996 ORDER BY decision_date DESC, pdf_link LIMIT 10""")
def level_newest(spark, sf_dir):
    return level(spark, sf_dir, "newest", year="1996")


@query(f"""SELECT title, judge, decision_date FROM {J} WHERE title LIKE '%77%'""")
def level_pattern(spark, sf_dir):
    return level(spark, sf_dir, "pattern", word="77")


@query(f"""SELECT title, judge, court_name FROM {J} WHERE judge LIKE '%J1%' AND year = 1996 ORDER BY pdf_link LIMIT 10""")
def level_judge_pattern(spark, sf_dir):
    return level(spark, sf_dir, "judge_pattern", word="J1", year="1996")


@query(f"""SELECT judge, count(*) AS case_count FROM {J} WHERE year = 1996 GROUP BY judge ORDER BY case_count DESC, judge LIMIT 5""")
def level_top_judges(spark, sf_dir):
    return level(spark, sf_dir, "top_judges", year="1996")


@query(f"""SELECT court_name, count(*) AS total_judgments FROM {J} WHERE year = 1996 GROUP BY court_name HAVING count(*) > 10""")
def level_busy_courts(spark, sf_dir):
    return level(spark, sf_dir, "busy_courts", year="1996", least=10)


@query(f"""SELECT judge, count(*) AS case_count FROM {J} GROUP BY judge HAVING count(*) > 20""")
def level_busy_judges(spark, sf_dir):
    return level(spark, sf_dir, "busy_judges", least=20)


@query(f"""SELECT title, judge, court_name FROM {J} WHERE judge IN (SELECT judge FROM {J} WHERE court = '1_F' GROUP BY judge HAVING count(*) > 5) AND year = 1996""")
def level_cases_of_judges(spark, sf_dir):
    return level(spark, sf_dir, "cases_of_judges_of", court="1_F", least=5, year="1996")


@query(f"""SELECT title, judge, decision_date FROM {J} WHERE judge IN (SELECT judge FROM {J} GROUP BY judge HAVING count(*) > 20)""")
def level_cases_of_busy_judges(spark, sf_dir):
    return level(spark, sf_dir, "cases_of_busy_judges", least=20)


@query(f"""SELECT title, court_name, decision_date, CAST(rank() OVER (PARTITION BY court_name ORDER BY decision_date DESC) AS INT) AS date_rank FROM {J} WHERE year = 1996""")
def level_ranked(spark, sf_dir):
    return level(spark, sf_dir, "ranked", year="1996")


@query(f"""SELECT cnr, side, count(*) AS n, min(decision_date) AS first FROM (SELECT cnr, decision_date, 'new' AS side FROM {J} WHERE o_orderkey % 2 = 1 UNION ALL SELECT cnr, decision_date, 'old' FROM {J} WHERE o_orderkey % 2 = 0) WHERE cnr IN ('C1', 'C2', 'C7') GROUP BY ALL""")
def case_links(spark, sf_dir):
    j = rows_of(spark, sf_dir)
    found = levels.case_links({"new": j.where("o_orderkey % 2 = 1"), "old": j.where("o_orderkey % 2 = 0")}, ["C1", "C2", "C7"])
    return found.select("cnr", "side", F.size("links").cast("long").alias("n"), F.element_at("links", 1)["decision_date"].alias("first"))


# ---- statistics


_L = """(SELECT CASE WHEN l_linestatus = 'O' THEN 'data' ELSE 'metadata' END AS data_type, CAST(year(l_shipdate) AS INT) AS year, '1~' || l_returnflag AS court, CAST(l_linenumber AS VARCHAR) AS bench, CAST(l_quantity AS BIGINT) AS size FROM lineitem) l"""


def _records(spark, sf_dir) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    return l.select(F.when(F.col("l_linestatus") == "O", "data").otherwise("metadata").alias("data_type"), F.year("l_shipdate").alias("year"), text_of("1~", F.col("l_returnflag")).alias("court"), F.col("l_linenumber").cast("string").alias("bench"), F.lit(1).cast("long").alias("files"), F.col("l_quantity").cast("long").alias("size"))


@query(f"""SELECT court, CAST(coalesce(sum(size) FILTER (data_type = 'data'), 0) AS BIGINT) AS data_size, count(DISTINCT year) AS n_years FROM {_L} WHERE year IN (1996, 1997) AND court IN ('1~A', '1~N') GROUP BY court""")
def rollup_filters(spark, sf_dir):
    r = stats.filtered(stats.filtered(_records(spark, sf_dir), [1996, 1997], ["1_A", "1~N"]), [], None)
    return stats.rollups(r).where("level = 'court'").select("court", "data_size", "n_years")


@query(f"""SELECT count(DISTINCT court) AS courts, count(DISTINCT court || '/' || bench) AS benches FROM {_L}""")
def court_benches(spark, sf_dir):
    return stats.court_benches(_records(spark, sf_dir))


@query("""SELECT CAST(o_orderstatus AS VARCHAR) AS court, CAST(year(o_orderdate) AS INT) AS year, CAST(sum(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE 0 END) AS BIGINT) AS size FROM orders WHERE o_orderkey % 3 <> 1 AND o_orderkey % 3 = 0 GROUP BY ALL""")
def tar_sizes(spark, sf_dir):
    """Bytes of tar objects only: of three names, one is a tar, one an index, one a plain file."""
    k = F.col("o_orderkey")
    name = F.when(k % 3 == 0, F.when(k % 2 == 0, "p.tar").otherwise("p.tar.gz")).when(k % 3 == 1, "data.index.json").otherwise("p.pdf")
    return stats.tar_sizes(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("court"), F.year("o_orderdate").alias("year"), name.alias("name"), k.alias("size")))


_PAGE_COUNTS = "SELECT '1~' || n_nationkey AS court, count(c_custkey) AS pdfs, 2 * count(c_custkey) AS metadata, CAST(coalesce(sum(c_custkey), 0) * 10000000 AS BIGINT) AS size FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_nationkey % 6 <> 0 GROUP BY n_nationkey"


def _page(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Counts of customers by nation (none for every 6th), and a tar for each customer."""
    c = table(spark, sf_dir, "customer").where("c_nationkey % 6 <> 0")
    n = c.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    all_ = table(spark, sf_dir, "nation").join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    counts = all_.select(text_of("1~", F.col("n_nationkey").cast("string")).alias("court"), F.col("n_name").alias("court_name"), F.lit(2024).alias("year"), F.col("n").alias("pdfs"), (2 * F.col("n")).alias("metadata"))
    listing = c.select(text_of("1_", F.col("c_nationkey").cast("string")).alias("court"), F.lit(2024).alias("year"), F.lit("b").alias("bench"), text_of("p", F.col("c_custkey").cast("string"), ".tar").alias("name"), (F.col("c_custkey") * 10_000_000).alias("size"))
    return counts, listing


@query(f"""SELECT '| ' || court || ' | ' || n_name || ' | ' || format('{{:,}}', pdfs) || ' | ' || format('{{:,}}', metadata) || ' | ' || format('{{:,.2f}}', size / 1073741824.0) || ' |' AS line
FROM ({_PAGE_COUNTS}) JOIN nation ON court = '1~' || n_nationkey WHERE pdfs > 0""")
def size_page(spark, sf_dir):
    """The court lines of the published page, as the page has them."""
    from datetime import date

    page = stats.size_page(*_page(spark, sf_dir), date(2024, 6, 1)).split("## By Court")[1].split("## By Year")[0]
    return spark.createDataFrame([(x,) for x in page.splitlines() if x.startswith("| 1~")], "line string")


@query(f"""SELECT court, pdfs, size / 1073741824.0::DOUBLE AS gib FROM ({_PAGE_COUNTS}) WHERE size / 1073741824.0 >= 1""")
def listed_sizes(spark, sf_dir):
    counts, listing = _page(spark, sf_dir)
    sizes = stats.tar_sizes(listing.withColumn("court", S.from_path_code(F.col("court"))))
    return stats.listed_sizes(stats.totals_by(counts, sizes, "court"), 1.0).orderBy(F.desc("pdfs"), "court").select("court", "pdfs", "gib")


# ---- comparison of layers


@query("""SELECT b AS bench, name, d AS decision_date, CAST(row_number() OVER (PARTITION BY b ORDER BY d, name) AS INT) AS "rank" FROM (SELECT o_orderstatus AS b, o_orderkey || '.json' AS name, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 7 <> 0) QUALIFY row_number() OVER (PARTITION BY b ORDER BY d, name) <= 20""")
def first_missing(spark, sf_dir):
    """The first twenty raw records of each bench, by date and name, that the index lacks."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("bench"), text_of(F.col("o_orderkey").cast("string"), ".json").alias("name"), F.col("o_orderdate").cast("date").alias("decision_date"), "o_orderkey")
    return layers.first_missing(o.drop("o_orderkey"), o.where("o_orderkey % 7 = 0"), ["bench", "name"], ["bench"], ["decision_date", "name"]).select("bench", "name", "decision_date", "rank")


@query("""SELECT o_orderkey || '.json' AS name, o_orderkey % 5 = 0 AS pdf_object, o_orderkey % 11 = 0 AS pdf_indexed FROM orders WHERE o_orderkey % 3 <> 0""")
def loose_records(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("bench", F.col("o_orderstatus"))

    def names(suffix: str, where: str) -> DataFrame:
        return o.where(where).select("bench", text_of(F.col("o_orderkey").cast("string"), suffix).alias("name"))

    return layers.loose_records(names(".json", "true"), names(".json", "o_orderkey % 3 = 0"), names(".pdf", "o_orderkey % 5 = 0"), names(".pdf", "o_orderkey % 11 = 0")).select("name", "pdf_object", "pdf_indexed")


@query("""WITH l AS (SELECT CAST(l_suppkey AS VARCHAR) AS part, l_orderkey, bool_or(l_linenumber % 2 = 0) AS i, bool_or(l_linenumber % 2 = 1) AS t FROM lineitem GROUP BY ALL),
p AS (SELECT part, count(*) FILTER (i AND NOT t) AS a, count(*) FILTER (t AND NOT i) AS b, bool_or(i) AS hi, bool_or(t) AS ht FROM l GROUP BY part)
SELECT part, 'part_index_files_missing_in_tar' AS issue, a AS n FROM p WHERE hi AND ht AND a > 0 UNION ALL SELECT part, 'part_tar_members_missing_in_index', b FROM p WHERE hi AND ht AND b > 0""")
def member_issues(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.lit("data").alias("data_type"), F.lit(2024).alias("year"), F.lit("c").alias("court"), F.lit("b").alias("bench"), F.col("l_suppkey").cast("string").alias("part"), F.col("l_orderkey").cast("string").alias("name"), "l_linenumber")
    return audit.member_issues(l.where("l_linenumber % 2 = 0"), l.where("l_linenumber % 2 = 1")).select("part", "issue", "n")


@query("""WITH o AS (SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderstatus AS court, o_orderkey AS k FROM orders)
SELECT year, court, issue, n FROM (
 SELECT year, court, 'index_file_count_mismatch' AS issue, count(*) FILTER (k % 4 = 0) AS n FROM o GROUP BY ALL
 UNION ALL SELECT year, court, 'index_duplicate_entries', count(*) FILTER (k % 4 = 0) FROM o GROUP BY ALL
 UNION ALL SELECT year, court, 'raw_missing_index', count(*) FILTER (k % 9 = 0) FROM o GROUP BY ALL
 UNION ALL SELECT year, court, 'index_missing_raw', count(*) FILTER (k % 7 = 0) FROM o GROUP BY ALL
 UNION ALL SELECT year, court, 'missing_indexed_part_objects', 1 FROM o GROUP BY ALL
 UNION ALL SELECT year, court, 'unindexed_tar_objects', 2 FROM o GROUP BY ALL
 UNION ALL SELECT year, court, 'part_size_mismatch', 1 FROM o GROUP BY ALL
 UNION ALL SELECT year, court, 'parquet_missing_data_index', count(*) FILTER (k % 5 = 0) FROM o GROUP BY ALL
 UNION ALL SELECT year, court, 'data_index_missing_parquet', count(*) FILTER (k % 6 = 0) FROM o GROUP BY ALL) WHERE n > 0""")
def audit_all_issues(spark, sf_dir):
    """Indexes that list every 4th file in both of their parts, and layers that differ from them in all nine ways."""
    o = table(spark, sf_dir, "orders").select(F.lit("data").alias("data_type"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("court"), F.lit("b").alias("bench"), F.col("o_orderkey").alias("k"))
    keys = ["data_type", "year", "court", "bench"]
    k = F.col("k")
    name = text_of(k.cast("string"), ".pdf")
    p = o.groupBy(*keys).agg(F.array_sort(F.collect_list(name)).alias("all"), F.array_sort(F.collect_list(F.when(k % 4 == 0, name))).alias("again"))
    part = lambda n, files: F.struct(F.lit(n).alias("name"), F.col(files).alias("files"), F.size(files).cast("long").alias("file_count"), F.lit(10).cast("long").alias("size"))
    indexes = p.select(*keys, F.array(part("a", "all"), part("c", "again")).alias("parts"), F.size("all").cast("long").alias("file_count"))
    one = F.lit(1).cast("long")
    raw = o.where("k % 7 <> 0").select(*keys, F.lit("raw").alias("layer"), name.alias("name"), one.alias("size")).unionByName(o.where("k % 9 = 0").select(*keys, F.lit("raw").alias("layer"), text_of("x", name).alias("name"), one.alias("size")))
    tar = p.select(*keys, F.explode(F.array(*(F.lit(x) for x in ("a", "y", "z")))).alias("name")).select(*keys, F.lit("tar").alias("layer"), "name", F.lit(11).cast("long").alias("size"))
    pq = o.where("k % 6 <> 0").select("year", "court", "bench", name.alias("name")).unionByName(o.where("k % 5 = 0").select("year", "court", "bench", text_of("q", name).alias("name")))
    return audit.issue_rows(audit.partition_summary(indexes, raw.unionByName(tar), pq)).select("year", "court", "issue", "n")


_FILES = """(SELECT o_orderkey AS k, '/in/cnrorders/b' || (o_orderkey % 3) || '/orders/' || o_orderkey AS stem FROM orders)"""


def _pairs(spark, sf_dir) -> DataFrame:
    """JSON and PDF files of orders: every 5th lacks its PDF, every 7th its JSON, every 11th JSON has no year."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("y"))
    stem = text_of("/in/cnrorders/b", (F.col("k") % 3).cast("string"), "/orders/", F.col("k").cast("string"))
    files = o.where("k % 7 <> 0").select(text_of(stem, ".json").alias("path"), F.when(F.col("k") % 11 != 0, F.col("y")).alias("year")).unionByName(o.where("k % 5 <> 0").select(text_of(stem, ".pdf").alias("path"), F.lit(None).cast("int").alias("year")))
    return build.pair_files(files)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS stem, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN CAST(year(o_orderdate) AS INT) END AS year, o_orderkey % 7 <> 0 AS has_json, o_orderkey % 5 <> 0 AS has_pdf FROM orders WHERE o_orderkey % 35 <> 0""")
def file_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("stem", "year", F.col("json").isNotNull().alias("has_json"), F.col("pdf").isNotNull().alias("has_pdf"))


@query("""SELECT CAST(year(o_orderdate) AS INT) AS year, 'b' || (o_orderkey % 3) AS bench, CAST(sum(CASE WHEN o_orderkey % 5 <> 0 THEN 2 ELSE 1 END) AS BIGINT) AS n FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 GROUP BY ALL""")
def grouped_files(spark, sf_dir):
    return build.grouped_files(_pairs(spark, sf_dir)).select("year", "bench", "n")


# ---- scalar rules


@query("""SELECT o_orderkey, o_orderkey * 1000000 / 1073741824.0::DOUBLE AS gib, o_orderkey * 1000000 / 1099511627776.0::DOUBLE AS tib, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey || '.pdf' END AS pdf, CASE WHEN o_orderkey % 2 = 0 THEN 'b' || (o_orderkey % 5) END AS bench FROM orders""")
def size_and_path_rules(spark, sf_dir):
    k = F.col("o_orderkey")
    link = text_of("court/", F.when(k % 2 == 0, text_of("cnrorders/b", (k % 5).cast("string"), "/orders/")).otherwise(""), k.cast("string"), F.when(k % 3 == 0, ".PDF").otherwise(".pdf"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.gib(k * 1_000_000).alias("gib"), S.tib(k * 1_000_000).alias("tib"), S.pdf_name(link).alias("pdf"), S.staged_bench(link).alias("bench"))


@query("""SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS at FROM events""")
def iso_times(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    form = F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd'T'HH:mm:ss")
    shown = F.when(F.col("event_id") % 5 == 0, "no time").when(F.col("event_id") % 2 == 0, text_of(form, "Z")).otherwise(form)
    return e.select("event_id", S.iso_timestamp(shown).cast("timestamp_ntz").alias("at"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'court/' || o_orderkey || '.pdf' END AS fragment FROM orders""")
def link_fragments(spark, sf_dir):
    k = F.col("o_orderkey")
    handler = F.when(k % 4 == 0, "other('x')").otherwise(text_of("open_pdf('", k.cast("string"), "','','court/", k.cast("string"), ".pdf", F.when(k % 3 == 0, "#page=1&zoom=2").otherwise(""), "')"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.pdf_fragment(handler).alias("fragment"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN 'court_code' ELSE 'pdf_link' END AS reason FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0""")
def quarantined(spark, sf_dir):
    k = F.col("o_orderkey")
    code = F.when(k % 3 == 0, "27-1").when(k % 5 != 0, "27~1")
    link = F.when(k % 7 == 0, "x/1.pdf").otherwise("court/1.pdf")
    return build.quarantine(table(spark, sf_dir, "orders").select("o_orderkey", code.alias("court_code"), link.alias("pdf_link"))).select("o_orderkey", "reason")


@query("""SELECT o_orderkey, o_orderkey % 6 IN (0, 5) AND o_orderkey % 7 <> 0 AS valid, o_orderkey % 6 = 4 AS gzipped FROM orders""")
def valid_pdf_bodies(spark, sf_dir):
    """Bodies by key: two PDFs, an empty one, one of the length of the error page, a gzip one, none."""
    k = F.col("o_orderkey")
    body = F.when(k % 6 == 0, F.lit("%PDF-1.4 x")).when(k % 6 == 1, F.lit("")).when(k % 6 == 2, F.rpad(F.lit("%PDF"), 315, "x")).when(k % 6 == 5, F.rpad(F.lit("%PDF"), 400, "x")).cast("binary")
    body = F.when(k % 6 == 4, F.unhex(F.lit("1F8B08"))).otherwise(body)
    status = F.when(k % 7 == 0, 404).otherwise(200)
    return table(spark, sf_dir, "orders").select("o_orderkey", S.valid_pdf(body, status).alias("valid"), S.is_gzip(body).alias("gzipped"))


@query("""SELECT event_id, CASE WHEN d < DATE '2024-01-20' THEN CAST(d + 1 AS DATE) END AS from_date, CASE WHEN d < DATE '2024-01-20' THEN least(CAST(d + 7 AS DATE), DATE '2024-01-20') END AS to_date FROM (SELECT event_id, CAST(ts AS DATE) AS d FROM events)""")
def next_ranges(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", S.next_range(F.col("ts").cast("date"), 7, F.lit("2024-01-20").cast("date")).alias("r"))
    return e.select("event_id", F.col("r.from").alias("from_date"), F.col("r.to").alias("to_date"))


@query(r"""SELECT doc_id, CASE WHEN text IS NOT NULL THEN len(string_split(text, ' ')) END AS n, coalesce(text = array_to_string(string_split(text, ' '), ' '), FALSE) AS same FROM documents""")
def pages_json(spark, sf_dir):
    """Texts with quotes, backslashes and line feeds as a JSON array, and back."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.from_json(S.pages_text(F.split("text", " ")), "array<string>").alias("p"))
    return d.select("doc_id", F.when(F.col("text").isNotNull(), F.size("p")).cast("long").alias("n"), F.coalesce(F.array_join("p", " ") == F.col("text"), F.lit(False)).alias("same"))


@query("""SELECT s_suppkey, s_suppkey % 4 <> 3 AS has_button, CASE s_suppkey % 4 WHEN 0 THEN 'N' || s_suppkey WHEN 1 THEN 'N' || s_suppkey WHEN 2 THEN 'N' || s_suppkey ELSE '' END AS cnr, 'High Court' AS court_label FROM supplier""")
def html_rows(spark, sf_dir):
    """Result rows as lists and objects; their labels, and whether they have a button with a handler."""
    k = F.col("s_suppkey")
    details = text_of('<strong class="caseDetailsTD"><span>CNR :</span><font>', F.when(k % 4 == 3, "").otherwise(text_of("N", k.cast("string"))), "</font><span>Court :</span><b>High Court</b></strong>")
    html = text_of(F.when(k % 4 == 3, "<button>").otherwise("<button onclick=\"f('a.pdf')\">"), "T</button>", details)
    row = F.when(k % 4 == 0, F.to_json(F.array(F.lit("1"), html))).when(k % 4 == 1, F.to_json(F.struct(html.alias("html")))).otherwise(F.to_json(F.struct(html.alias("1"))))
    f = table(spark, sf_dir, "supplier").select("s_suppkey", html_fields(S.result_html(row)).alias("f"))
    return f.select("s_suppkey", "f.has_button", F.col("f.labels")["CNR"].alias("cnr"), F.col("f.labels")["Court"].alias("court_label"))


# ---- cursors, streams, retries


@query("""WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d FROM events)
SELECT user_id, CASE WHEN user_id % 5 = 0 THEN DATE '2024-02-01' ELSE max(d) FILTER (d <= DATE '2024-01-25') END AS cursor FROM e GROUP BY user_id""")
def index_cursors(spark, sf_dir):
    """The index's own date for every 5th, else the latest date in file names that is not ahead of today."""
    name = F.format_string("X_%s.pdf", F.col("ts").cast("date").cast("string"))
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(name).alias("files"))
    scraped = F.when(F.col("user_id") % 5 == 0, "2024-02-01")
    return e.select("user_id", tasks.index_cursor(scraped, F.col("files"), F.lit(2024), F.lit("2024-01-25").cast("date")).alias("cursor"))


@query("""SELECT user_id % 10 AS court, user_id AS bench, max(CAST(ts AS DATE)) AS cursor FROM events WHERE event_id % 5 BETWEEN 1 AND 3 GROUP BY ALL""")
def cursor_years(spark, sf_dir):
    """The latest cursors of the current year and the two before; later and earlier years do not count."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("court"), F.col("user_id").alias("bench"), F.col("ts").cast("date").alias("cursor"), (F.col("event_id") % 5 + 2021).alias("year"))
    return tasks.latest_cursors(e, this_year=2024)


@query("""SELECT user_id % 10 AS court, user_id AS bench, DATE '2024-02-01' AS cursor FROM events GROUP BY user_id HAVING bool_and(event_type <> 'error')""")
def committed_cursors(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("court"), F.col("user_id").alias("bench"), F.year("ts").alias("year"), (F.col("event_type") != "error").alias("ok"))
    return tasks.committed_cursors(e, "2024-02-01")


def event_stream(spark: SparkSession, sf_dir: str, name: str, files: int, **how) -> tuple[str, DataFrame]:
    """Run an upsert of events, dealt to six files, and return its folder and what `after` wrote: each row with its batch."""
    source = written(spark, sf_dir, "event-files", lambda p: table(spark, sf_dir, "events").withColumn("ok", F.col("event_type") != "error").repartition(6, "event_id").write.option("maxRecordsPerFile", 0).parquet(p))
    root = scratch_path(spark, name)

    def after(df: DataFrame, number: int) -> None:
        there = TableStore(spark, f"{root}/table").read().groupBy("user_id", "event_type").agg(F.max("ts").alias("_latest"))
        seen = df.join(there, ["user_id", "event_type"], "left").select("event_id", F.lit(number).alias("batch"), F.coalesce(F.col("_latest") >= F.col("ts"), F.lit(False)).alias("in_table"))
        seen.write.mode("append").parquet(f"{root}/raw")

    upsert_stream(read_events(spark, source, files=files), root, f"{root}/checkpoint", ["user_id", "event_type"], ["ts", "event_id"], ("user_id", "ts"), after, **how).awaitTermination()
    return root, spark.read.parquet(f"{root}/raw")


@query("""SELECT event_id, TRUE AS in_table FROM events""")
def stream_barrier(spark, sf_dir):
    """When a batch's raw rows are written, the table holds their keys already, at their time or a later one."""
    return event_stream(spark, sf_dir, "barrier", 3)[1].select("event_id", "in_table")


@query("""SELECT 3::BIGINT AS batches, count(*) AS n FROM events""")
def stream_batches(spark, sf_dir):
    """Six files by two a trigger make three batches."""
    return event_stream(spark, sf_dir, "batches", 2)[1].agg(F.countDistinct("batch").alias("batches"), F.count("*").alias("n"))


@query("""SELECT user_id, max(ts) AS cursor FROM events GROUP BY user_id HAVING bool_and(event_type <> 'error')""")
def stream_cursor(spark, sf_dir):
    """A cursor moves only for groups of which every row of the batch succeeded (here all files are one batch)."""
    root, _ = event_stream(spark, sf_dir, "cursor", 100, ok="ok")
    cursors = TableStore(spark, f"{root}/cursor").read()
    return spark.createDataFrame([], "user_id long, cursor timestamp_ntz") if cursors is None else cursors


@query("""WITH o AS (SELECT user_id AS bench, event_id % 4 AS b, event_id % 3 AS year, bool_and(event_type <> 'error') AS ok FROM events GROUP BY ALL), t AS (SELECT DISTINCT bench, b FROM o),
s AS (SELECT t.bench, t.b, o.year, arg_max(o.ok, o.b) AS ok FROM t JOIN o ON o.bench = t.bench AND o.b <= t.b GROUP BY ALL), g AS (SELECT bench, b FROM s GROUP BY ALL HAVING bool_and(ok))
SELECT CAST(bench % 10 AS VARCHAR) AS court, CAST(bench AS VARCHAR) AS bench, DATE '2024-02-01' + CAST(max(b) AS INT) AS cursor FROM g GROUP BY bench""")
def stream_kept_cursors(spark, sf_dir):
    """Outcomes of benches in four batches, the last two after a restart: failed years hold their bench only."""
    e = table(spark, sf_dir, "events")
    outcome = e.select(F.col("event_id") % 4, (F.col("user_id") % 10).alias("court"), F.col("user_id").alias("bench"), (F.col("event_id") % 3).alias("year"), (F.col("event_type") != "error").alias("ok"), F.date_add(F.lit("2024-02-01").cast("date"), (F.col("event_id") % 4).cast("int")).alias("through"))
    source, out, checkpoint = (scratch_path(spark, f"kept-{x}") for x in ("events", "cursors", "checkpoint"))
    for b in range(4):
        outcome.where(outcome[0] == b).select("court", "bench", "year", "ok", "through").coalesce(1).write.mode("append").parquet(source)
        if b in (1, 3):  # one file a trigger, in the order of their times
            cursors.cursor_stream(spark.readStream.schema("court long, bench long, year long, ok boolean, through date").option("maxFilesPerTrigger", 1).parquet(source), out, checkpoint).awaitTermination()
    return cursors.kept_cursors(spark.read.schema(cursors.CURSORS).parquet(out))


@query("""SELECT DISTINCT '1~' || (user_id % 5) AS court, CAST(ts AS DATE) + i::INT AS from_date, CAST(ts AS DATE) + i::INT AS to_date FROM events, range(7) r(i) WHERE day(CAST(ts AS DATE) + i::INT) % 2 = 0""")
def retry_rounds(spark, sf_dir):
    """Weeks that failed, retried by days: those of even days fail in every round."""
    e = table(spark, sf_dir, "events").select(text_of("1~", (F.col("user_id") % 5).cast("string")).alias("court"), F.col("ts").cast("date").alias("from_date")).distinct()
    return tasks.retry_rounds(e.withColumn("to_date", F.date_add("from_date", 6)), lambda t: t.where("day(from_date) % 2 = 0"))
