import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.operators import audit, build, dedupe, layers, packing, reconcile, stats, tasks, windows


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def kept(spark, data):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "cnr string, pdf_link string, decision_date string, seq int")
    return sorted(r[0] or "" for r in dedupe.keep_last(dedupe.with_key(df), [dedupe.KEY], [F.desc("seq")]).select("pdf_link").collect())


def test_keep_last_by_case_and_date(spark):
    assert kept(spark, [("ABC123", "a.pdf", "2025-01-01"), ("ABC123", "b.pdf", "2025-01-01"), ("XYZ999", "c.pdf", "2025-01-02")]) == ["b.pdf", "c.pdf"]
    assert kept(spark, [("ABC123", "a.pdf", "2025-01-01"), ("ABC123", "b.pdf", "2025-02-01")]) == ["a.pdf", "b.pdf"]
    assert kept(spark, [("", "a.pdf", "d"), (None, "a.pdf", "d"), ("", "b.pdf", "d")]) == ["a.pdf", "b.pdf"]
    assert kept(spark, [(None, None, None), ("", "", "")]) == [""]


def test_dedupe_is_idempotent_and_anti_plus_semi_is_all(spark):
    r = random.Random(1)
    data = [(f"C{r.randint(0, 30)}", f"{i}.pdf", f"2025-01-0{r.randint(1, 3)}", i) for i in range(200)]
    df = dedupe.with_key(spark.createDataFrame(data, "cnr string, pdf_link string, decision_date string, seq int"))
    once = dedupe.keep_last(df, [dedupe.KEY], [F.desc("seq")])
    assert rows(once) == rows(dedupe.keep_last(once, [dedupe.KEY], [F.desc("seq")]))
    other = df.where("seq % 7 = 0").select(dedupe.KEY)
    assert layers.missing(df, other, [dedupe.KEY]).count() + df.join(other.distinct(), dedupe.KEY, "left_semi").count() == 200


J = "cnr string, pdf_link string, decision_date string, year int, court string, bench string"


def test_sibling_keys_remove_rows(spark):
    mine = spark.createDataFrame([("ABC123", "a.pdf", "2025-01-01", 2025, "c", "b1"), ("ABC123", "later.pdf", "2025-01-03", 2025, "c", "b1"), ("XYZ999", "b.pdf", "2025-01-02", 2025, "c", "b1"), ("", "", "", 2025, "c", "b1")], J)
    other = spark.createDataFrame([("ABC123", "x.pdf", "2025-01-01", 2025, "c", "b2"), ("XYZ999", "b.pdf", "2025-01-02", 2024, "c", "b2"), (None, None, None, 2025, "c", "b2")], J)
    assert [r[0] for r in dedupe.without_sibling_keys(mine, other).orderBy("pdf_link").select("pdf_link").collect()] == ["b.pdf", "later.pdf"]
    assert dedupe.without_sibling_keys(mine, other, keep_blank_keys=True).count() == 3
    assert dedupe.without_sibling_keys(mine, other.limit(0)).count() == 4


def test_upsert_prefers_new_rows_and_published_siblings(spark):
    old = spark.createDataFrame([("A", "old.pdf", "d1", 2025, "c", "b1"), ("B", "sib.pdf", "d1", 2025, "c", "b2"), ("Z", "z.pdf", "d1", 2024, "c", "b1")], J)
    new = spark.createDataFrame([("A", "new.pdf", "d1", 2025, "c", "b1"), ("B", "dup.pdf", "d1", 2025, "c", "b1")], J)
    out = dedupe.upsert(old, new)
    assert rows(out.select("pdf_link")) == [("new.pdf",)]
    assert rows(dedupe.upsert(old.unionByName(new).limit(0), new).select("pdf_link")) == [("dup.pdf",), ("new.pdf",)]


def test_rewrite_takes_the_latest_file(spark):
    df = spark.createDataFrame([("A", "1.pdf", "d", 2025, "c", "b1", 1, "p1"), ("A", "2.pdf", "d", 2025, "c", "b2", 2, "p2")], J + ", mtime int, path string")
    assert rows(dedupe.rewrite(df).select("pdf_link")) == [("2.pdf",)]


PARTS = "array<struct<name:string,files:array<string>,file_count:bigint,size:bigint,size_human:string,created_at:string>>"


def test_audit_of_a_partition(spark):
    idx = spark.createDataFrame([("data", 2025, "c", "b", 5, [("p1", ["b", "c"], 2, 10, None, None), ("p2", ["b"], 1, 7, None, None)])], f"data_type string, year int, court string, bench string, file_count long, parts {PARTS}")
    listing = spark.createDataFrame([("data", 2025, "c", "b", "raw", "a", 1), ("data", 2025, "c", "b", "raw", "b", 1), ("data", 2025, "c", "b", "tar", "p1", 11), ("data", 2025, "c", "b", "tar", "p3", 5)], "data_type string, year int, court string, bench string, layer string, name string, size long")
    pq = spark.createDataFrame([(2025, "c", "b", "c"), (2025, "c", "b", "d")], "year int, court string, bench string, name string")
    s = audit.partition_summary(idx, listing, pq)
    got = {r["issue"]: (r["n"], r["sample"]) for r in audit.issue_rows(s).collect()}
    assert got == {
        "index_file_count_mismatch": (2, "5,3"),
        "index_duplicate_entries": (1, ""),
        "raw_missing_index": (1, "a"),
        "index_missing_raw": (1, "c"),
        "missing_indexed_part_objects": (1, "p2"),
        "unindexed_tar_objects": (1, "p3"),
        "part_size_mismatch": (1, "p1"),
        "parquet_missing_data_index": (1, "d"),
        "data_index_missing_parquet": (1, "b"),
    }
    assert s.first()["status"] == "issues"
    assert audit.partition_summary(idx.where("false"), listing).count() == 0


def test_member_issues(spark):
    k = "data_type string, year int, court string, bench string, part string, name string"
    i = spark.createDataFrame([("data", 2025, "c", "b", "p", "x"), ("data", 2025, "c", "b", "p", "y"), ("data", 2025, "c", "b", "only", "z")], k)
    t = spark.createDataFrame([("data", 2025, "c", "b", "p", "y"), ("data", 2025, "c", "b", "p", "w")], k)
    assert {(r["issue"], r["n"], r["sample"]) for r in audit.member_issues(i, t).collect()} == {("part_index_files_missing_in_tar", 1, "x"), ("part_tar_members_missing_in_index", 1, "w")}


def test_matrix_differences_add_up(spark):
    r = random.Random(2)
    df = spark.createDataFrame([(r.choice("abc"), r.choice("xy"), f"n{r.randint(0, 40)}") for _ in range(300)], "layer string, k string, name string")
    for m in layers.matrix(df, list("abc"), ["k"]).collect():
        assert m["n_a"] == m["a_and_b"] + m["a_not_b"] and m["n_b"] == m["a_and_b"] + m["b_not_a"]


def test_index_stats(spark):
    idx = spark.createDataFrame([("c", 3, [("p", ["x", "y"], 2, 1, None, None), ("q", ["x"], 1, 1, None, None)])], f"court string, file_count long, parts {PARTS}")
    assert tuple(layers.index_stats(idx, ["court"]).select("index_files", "file_count", "entries", "distinct_entries", "duplicates").first()) == (1, 3, 3, 2, 1)


def test_loose_records(spark):
    s = "bench string, name string"
    got = layers.loose_records(spark.createDataFrame([("b", "x.json"), ("b", "y.json")], s), spark.createDataFrame([("b", "x.json"), ("c", "y.json")], s), spark.createDataFrame([("b", "y.pdf")], s), spark.createDataFrame([("c", "y.pdf")], s))
    assert rows(got.select("name", "pdf_object", "pdf_indexed")) == [("y.json", True, False)]


def test_reconcile_fills_and_propagates(spark):
    base = spark.createDataFrame([("a", 2024, 10), ("b", 2024, None)], "court string, year int, portal_total long")
    aud = spark.createDataFrame([("b", 2024, 4), ("z", 2024, 9)], "court string, year int, parquet_rows long")
    assert rows(reconcile.against_baseline(base, aud, ["parquet_rows"]).select("court", "parquet_rows", "parquet_rows_delta")) == [("a", 0, 10), ("b", 4, -4)]
    assert {tuple(r) for r in reconcile.against_baseline(base, aud, ["parquet_rows"], zero_fill=False).select("court", "parquet_rows_delta").collect()} == {("a", None), ("b", None)}


def test_chunked_total(spark):
    df = spark.createDataFrame([("a", 1, 5, None), ("a", 2, 6, None), ("b", 1, 5, "e1"), ("b", 2, None, "e2"), ("b", 3, None, "e3"), ("b", 4, None, "e4")], "court string, chunk int, n long, error string")
    assert {tuple(r) for r in reconcile.chunked_total(df, ["court"]).collect()} == {("a", 11, ""), ("b", None, "e1;e2;e3")}


def greedy(sizes, limit):
    parts = []
    for s in sizes:
        if parts and parts[-1] and sum(parts[-1]) + s <= limit:
            parts[-1].append(s)
        else:
            parts.append([s])
    return parts


def test_packing_matches_a_sequential_loop(spark):
    r = random.Random(3)
    groups = {f"g{i}": [r.randint(0, 10) for _ in range(r.randint(1, 30))] for i in range(40)} | {"fix": [6, 4, 1, 10, 0, 3]}
    df = spark.createDataFrame([(g, i, f"{i}", s) for g, x in groups.items() for i, s in enumerate(x)], "g string, i int, name string, size long")
    for packed in (packing.greedy_parts(df, ["g"], "i", limit=10), packing.pack_large(df, "g", "i", limit=10)):
        got = {}
        for x in packed.orderBy("g", F.col("name").cast("int")).collect():
            got.setdefault(x["g"], {}).setdefault(x["part"], []).append(x["size"])
        assert {g: list(p.values()) for g, p in got.items()} == {g: greedy(x, 10) for g, x in groups.items()}
    assert list(greedy([6, 4, 1, 10, 0, 3], 10)) == [[6, 4], [1], [10, 0], [3]]


def test_a_file_above_the_limit_is_an_error(spark):
    df = spark.createDataFrame([("g", 0, "a", 11)], "g string, i int, name string, size long")
    with pytest.raises(Exception, match="limit of a part"):
        packing.greedy_parts(df, ["g"], "i", limit=10).collect()


def test_index_update(spark):
    idx = spark.createDataFrame([("k", [("a", ["x", "y"], 2, 5, None, "1")])], f"k string, parts {PARTS}")
    up = "k string, part string, files array<string>, size long, created_at string, replaces string"
    one = packing.update_index(idx, spark.createDataFrame([("k", "b", ["y", "z"], 3, "2", None)], up), ["k"]).first()
    assert (one["changed"], one["file_count"], one["tar_size"], [p["files"] for p in one["parts"]]) == (True, 3, 8, [["x", "y"], ["z"]])
    rep = packing.update_index(idx, spark.createDataFrame([("k", "b", ["z"], 9, "2", "a")], up), ["k"]).first()
    assert (rep["file_count"], [(p["name"], p["files"]) for p in rep["parts"]]) == (3, [("b", ["x", "y", "z"])])
    assert packing.update_index(idx, spark.createDataFrame([("k", "b", ["x"], 9, "2", None)], up), ["k"]).first()["changed"] is False


def test_append_target(spark):
    parts = spark.createDataFrame([("a", "p1", 50, "1"), ("a", "p2", 60, "2"), ("b", "p1", 150, "1")], "k string, name string, size long, created_at string")
    new = spark.createDataFrame([("a", 30), ("b", 1), ("c", 1)], "k string, new_size long")
    assert {tuple(r) for r in packing.append_target(parts, ["k"], new, 200, 100).collect()} == {("a", "p2"), ("b", None), ("c", None)}


def test_cursor_from_files(spark):
    files = ["x_2023-12-31.pdf", "x_2024-06-01.pdf", "x_2025-01-02.json", "x_2202-01-02.pdf", "nodate.pdf"]
    df = spark.createDataFrame([(None, files), ("2025-03-01", files), (None, ["nodate.pdf"])], "s string, f array<string>")
    got = [r[0] for r in df.select(tasks.index_cursor(F.col("s"), F.col("f"), F.lit(2025), F.lit("2026-01-01").cast("date"))).collect()]
    assert got == [dt.date(2025, 1, 2), dt.date(2025, 3, 1), None]


def test_ranges_days_and_cursors(spark):
    one = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 10))], "s date, e date")
    assert rows(tasks.date_ranges(one, "s", "e", 7).select("from_date", "to_date")) == [(dt.date(2024, 1, 1), dt.date(2024, 1, 7)), (dt.date(2024, 1, 8), dt.date(2024, 1, 10))]
    two = spark.createDataFrame([("c", dt.date(2024, 1, 1), dt.date(2024, 1, 3)), ("c", dt.date(2024, 1, 2), dt.date(2024, 1, 4))], "court string, from_date date, to_date date")
    assert [r["day"].day for r in tasks.days_of(two, ["court"]).collect()] == [1, 2, 3, 4]
    res = spark.createDataFrame([("c", "b1", 2025, True), ("c", "b1", 2026, True), ("c", "b2", 2025, True), ("c", "b2", 2026, False)], "court string, bench string, year int, ok boolean")
    assert rows(tasks.committed_cursors(res, "2026-01-05")) == [("c", "b1", dt.date(2026, 1, 5))]
    starts = tasks.start_dates(spark.createDataFrame([("a",), ("b",)], "court string"), spark.createDataFrame([("a", dt.date(2026, 1, 4))], "court string, cursor date"), "2026-01-05")
    assert rows(starts) == [("a", dt.date(2025, 12, 22)), ("b", dt.date(2008, 1, 1))]


def test_log_lines(spark):
    task = "CourtDateTask(id=1, court_code=27~1, from_date=2024-01-01, to_date=2024-01-07)"
    log = spark.createDataFrame([(f"Task failed after retries {task}",), (f"  - {task}",), (f"done {task}",), ("rerun_task court=3~22 from=2024-01-01 to=2024-01-02 x returncode=1",), ("rerun_task court=3~22 from=2024-01-03 to=2024-01-04 x returncode=0",)], "value string")
    assert rows(tasks.failed_tasks(log)) == [("27~1", "2024-01-01", "2024-01-07")]
    assert rows(tasks.failed_reruns(log)) == [("3~22", "2024-01-01", "2024-01-02")]


def test_build_counts_and_pairs(spark):
    page = "<button>T</button>D<strong class='caseDetailsTD'><span>Decision Date</span><font>05-03-2024</font></strong>"
    raw = spark.createDataFrame([("27~1", page, "court/a.pdf"), ("27~1", None, "court/b.pdf"), (None, page, "court/c.pdf"), ("27~1", "<strong>x</strong>", "court/d.pdf"), ("27~1", "<button>T</button>", "court/e.pdf")], "court_code string, raw_html string, pdf_link string")
    assert build.build_counts(raw).first().asDict() == {"records": 5, "parsed": 2, "without_html": 1, "missing_field": 1, "bad_judge": 1, "without_year": 1}
    out = build.build_judgments(raw, spark.createDataFrame([("a.pdf",)], "name string")).collect()
    assert [(r["title"], r["year"], r["court"], r["pdf_exists"], str(r["decision_date"])) for r in out] == [("T", 2024, "27_1", True, "2024-03-05")]
    files = spark.createDataFrame([("s/cnrorders/b1/orders/x.json", 2024), ("s/cnrorders/b1/orders/x.pdf", None), ("s/cnrorders/b1/orders/y.pdf", None)], "path string, year int")
    pairs = build.pair_files(files)
    assert rows(pairs.where("stem = 'x'").select("year", "pdf")) == [(2024, "s/cnrorders/b1/orders/x.pdf")]
    assert rows(build.grouped_files(pairs).select("year", "bench", "n")) == [(2024, "b1", 2)]


def test_size_page(spark):
    counts = spark.createDataFrame([("27~1", "Court A", 2024, 10, 12), ("3~22", "Court B", 2025, 30, 31)], "court string, court_name string, year int, pdfs long, metadata long")
    listing = spark.createDataFrame([("27_1", "b", 2024, "x.tar", 2 << 30), ("27_1", "b", 2024, "data.index.json", 1 << 40), ("3_22", "c", 2025, "y.tar.gz", 1 << 30)], "court string, bench string, year int, name string, size long")
    page = stats.size_page(counts, listing, dt.date(2026, 6, 1))
    assert "| Judgments/PDFs | **40** |" in page and "| 3~22 | Court B | 30 | 31 | 1.00 |" in page and "| Years covered | **2024-2025** |" in page and "June 1, 2026" in page


def test_windows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 2024, True), (dt.date(2024, 1, 3), 2024, None), (None, 2024, False)], "decision_date date, year int, ok boolean")
    assert [r["n"] for r in windows.daily_histogram(df, "2024-01-01", "2024-01-03", fill=True).orderBy("day").collect()] == [1, 0, 1]
    assert tuple(df.agg(*windows.tri_state("ok", "ok")).first()) == (1, 1, 1)
    assert rows(windows.state_histogram(df, "ok")) == [("False", 1), ("None", 1), ("True", 1)]


def test_dimensions_beyond_the_broadcast_are_whole(spark):
    n = 10_001
    d = spark.range(n).select(F.concat(F.lit("1~"), "id").alias("code"), F.concat(F.lit("n"), "id").alias("name"))
    df = spark.range(n).select(F.concat(F.lit("1_"), "id").alias("bench"))
    assert stats.with_names(df, d, "bench", "code", "name", "found", "unknown").where("found = 'unknown'").count() == 0
    courts = spark.range(n).select(F.col("id").alias("court"))
    years = spark.createDataFrame([(2023,), (2024,)], "year int")
    assert stats.combinations(years, courts, courts.withColumn("bench", F.lit("b"))).count() == 2 * n
    split = tasks.tasks(courts, courts.withColumn("dist", F.col("court").cast("string")), "2024-01-01", "2024-01-02", 7)
    assert split.where("dist is not null").count() == n


def test_packing_by_several_keys_and_kinds(spark):
    r = random.Random(7)
    data = [(r.choice(["a", "b", None]), r.randint(0, 2), i, r.choice([0, 0, 1, 3, 10])) for i in range(400)]
    df = spark.createDataFrame(data, "g string, h int, name int, size int").repartition(5)
    got = {}
    for x in packing.greedy_parts(df, ["g", "h"], "name", limit=10).collect():
        got.setdefault((x["g"], x["h"]), {}).setdefault(x["part"], []).append((int(x["name"]), x["size"]))
    for key, parts in got.items():
        sizes = [s for g, h, _, s in sorted(data, key=lambda d: d[2]) if (g, h) == key]
        assert [[s for _, s in sorted(parts[p])] for p in sorted(parts)] == [list(x) for x in greedy(sizes, 10)]


def test_samples_of_a_large_group_come_from_few_names(spark):
    n = 20_000
    df = spark.range(n).select(F.lit("k").alias("k"), F.lit("a").alias("layer"), F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"))
    tagged = layers.few_names(layers.flags(df, ["a", "b"], ["k"]), ["k", "a", "b"], "name", 20, "first")
    left = [r["first"] for r in tagged.where("first is not null").collect()]
    assert tagged.count() == n and len(left) == 20 * layers.SAMPLE_PARTS and {f"n{i:06}" for i in range(20)} <= set(left)
    (m,) = layers.matrix(df, ["a", "b"], ["k"]).collect()
    assert (m["n_a"], m["n_b"], m["a_and_b"], m["a_not_b"], m["b_not_a"]) == (n, 0, 0, n, 0)
    assert m["a_not_b_sample"] == ",".join(f"n{i:06}" for i in range(20)) and m["b_not_a_sample"] == ""


def test_masks_keep_null_keys_and_names_of_no_known_layer(spark):
    df = spark.createDataFrame([(None, "a", "x"), (None, "b", "x"), ("k", "z", "y"), ("k", "a", None)], "k string, layer string, name string")
    got = {(r["k"], r["a"], r["b"]): (r["n"], r["first"]) for r in layers.mask_histogram(df, ["a", "b"], ["k"]).collect()}
    assert got == {(None, True, True): (1, ["x"]), ("k", False, False): (1, ["y"]), ("k", True, False): (1, [])}
    assert layers.matrix(df.limit(0), ["a", "b"], ["k"]).count() == 0


def test_a_file_without_a_size_is_named(spark):
    df = spark.createDataFrame([("k", 1, "good", 5), ("k", 2, "odd.pdf", None)], "k string, o int, name string, size long")
    with pytest.raises(Exception, match="odd.pdf"):
        packing.greedy_parts(df, ["k"], "o").collect()


def test_steps_of_a_chunk_equal_the_loop():
    r = random.Random(11)
    for _ in range(200):
        limit = r.choice([1, 7, 30])
        sizes = [r.choice([0, r.randint(0, limit), limit]) for _ in range(r.randint(1, 60))]
        most, opened, left = packing.chunk_steps(np.array(sizes), limit)
        for used in range(limit + 1):
            parts, now = 0, used
            for s in sizes:
                parts, now = (parts, now + s) if now + s <= limit else (parts + 1, s)
            i = int(np.searchsorted(most, used))
            assert (parts, now) == (opened[i], left[i] + (0 if opened[i] else used))


@pytest.mark.parametrize("chunk", [1, 7, 1 << 18])
def test_a_large_leaf_packed_in_chunks_equals_the_loop(spark, chunk):
    r = random.Random(5)
    data = [(r.choice(["a", "a", "a", "b", None]), r.randint(0, 1), i, r.choice([0, 0, 1, 3, 10])) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, h int, name int, size int").repartition(5)
    got = {}
    for x in packing.pack_large(df, ["g", "h"], "name", limit=40, chunk_files=chunk).collect():
        got.setdefault((x["g"], x["h"]), {}).setdefault(x["part"], []).append((int(x["name"]), x["size"]))
    assert len(got) == 6 and sum(len(p) for parts in got.values() for p in parts.values()) == 3000
    for key, parts in got.items():
        sizes = [s for g, h, _, s in sorted(data, key=lambda d: d[2]) if (g, h) == key]
        assert sorted(parts) == list(range(len(parts)))
        assert [[s for _, s in sorted(parts[p])] for p in sorted(parts)] == [list(x) for x in greedy(sizes, 40)]
    assert packing.pack_large(df.limit(0), ["g", "h"], "name", limit=40).count() == 0


def test_the_files_of_one_leaf_are_packed_by_many_tasks(spark):
    n, key = 200_000, "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # little data would else be joined into fewer tasks
    df = spark.range(n).select(F.lit("k").alias("k"), "id", F.col("id").alias("name"), (F.pmod(F.xxhash64("id"), F.lit(1000)) + 1).alias("size"))
    packed = packing.pack_large(df, "k", "id", limit=100_000, chunk_files=5000).withColumn("task", F.spark_partition_id())
    one = packing.greedy_parts(df, ["k"], "id", limit=100_000)
    assert packed.select("part", "name").exceptAll(one.select("part", "name")).count() == 0 and packed.count() == n
    tasks_used = [r["count"] for r in packed.groupBy("task").count().collect()]
    spark.conf.unset(key)
    assert len(tasks_used) > 2 and max(tasks_used) < n / 2
