import datetime as dt
import io
import json
import tarfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docketry.operators import build
from docketry.sources import readers, sinks, tars
from docketry.streaming.upsert import TableStore, read_events, upsert_stream

PAGE = "<button onclick=\"x('a')\">T</button>D<strong>Judge : X</strong><strong class='caseDetailsTD'><span>CNR</span><font>{cnr}</font><span>Decision Date</span><font>{day}</font></strong>"


def record(i, day="05-03-2024"):
    return {"court_code": "27~1", "court_name": "Court", "raw_html": PAGE.format(cnr=f"C{i}", day=day), "pdf_link": f"court/cnrorders/b1/orders/{i}.pdf", "downloaded": True}


def test_records_to_layer_and_back(spark, tmp_path):
    src = tmp_path / "raw/cnrorders/b1/orders"
    src.mkdir(parents=True)
    for i in range(3):
        (src / f"{i}.json").write_text(json.dumps(record(i)))
    (src / "bad.json").write_text("{")
    raw = readers.read_raw_records(spark, str(tmp_path / "raw"))
    assert raw.count() == 4 and raw.where("has_html").count() == 3
    sinks.write_judgments(build.build_judgments(raw), str(tmp_path / "layer"))
    got = readers.read_judgments(spark, str(tmp_path / "layer"), [2024], ["27_1"])
    assert got.count() == 3 and got.select("year", "court", "bench").distinct().count() == 1
    assert got.first()["decision_date"] == dt.date(2024, 3, 5)
    assert readers.read_judgments(spark, str(tmp_path / "layer"), [1999]).count() == 0
    assert readers.read_raw_records(spark, str(tmp_path / "nowhere")).count() == 0


def test_layer_upsert_replaces_in_place(spark, tmp_path):
    root, stage = str(tmp_path / "layer"), str(tmp_path / "stage")
    old = spark.createDataFrame([("A", "old.pdf", dt.date(2024, 3, 5), 2024, "27_1", "b1"), ("B", "keep.pdf", dt.date(2024, 3, 6), 2024, "27_1", "b1"), ("S", "sib.pdf", dt.date(2024, 3, 6), 2024, "27_1", "b2")], "cnr string, pdf_link string, decision_date date, year int, court string, bench string")
    sinks.write_judgments(old, root)
    new = spark.createDataFrame([("A", "new.pdf", dt.date(2024, 3, 5), 2024, "27_1", "b1"), ("S", "dup.pdf", dt.date(2024, 3, 6), 2024, "27_1", "b1")], old.schema)
    for _ in range(2):  # a replay changes nothing
        sinks.upsert_judgments(new, root, stage)
        assert sorted(r[0] for r in readers.read_judgments(spark, root).select("pdf_link").collect()) == ["keep.pdf", "new.pdf", "sib.pdf"]


def test_nanoseconds_and_the_court_clash(spark, tmp_path):
    leaf = tmp_path / "year=2025/court=27_1/bench=b"
    leaf.mkdir(parents=True)
    t = pa.table({"cnr": ["A"], "court": ["High Court"], "decision_date": pa.array([dt.datetime(2025, 1, 2)], pa.timestamp("ns"))})
    pq.write_table(t, leaf / "metadata.parquet", version="2.6")
    r = readers.read_judgments(spark, str(tmp_path)).first()
    assert (r["court_name"], r["court"], r["decision_date"], r["title"]) == ("High Court", "27_1", dt.date(2025, 1, 2), None)


def test_indexes_of_both_formats(spark, tmp_path):
    for court, doc in (("1_1", {"file_count": 3, "updated_at": "2025-10-23T07:12:14", "parts": [{"name": "p", "files": ["d/x.json", "y.json"], "file_count": 2, "size": 5}, {"name": "q", "files": ["x.json"], "size": 1}]}), ("2_2", {"files": ["z.json"], "tar_size": 9, "updated_at": "2025-10-23T07:12:14Z"})):
        p = tmp_path / f"metadata/tar/year=2025/court={court}/bench=b"
        p.mkdir(parents=True)
        (p / "metadata.index.json").write_text(json.dumps(doc))
    idx = readers.read_indexes(spark, str(tmp_path / "metadata"), "metadata")
    assert [r[0] for r in readers.index_files(idx).orderBy("court", "part", "name").select("name").collect()] == ["x.json", "y.json", "x.json", "z.json"]
    assert idx.select("updated_at").distinct().count() == 1
    listing = readers.read_listing(spark, str(tmp_path))
    assert [tuple(r) for r in readers.discover_partitions(listing).collect()] == [("metadata", 2025, "1_1", "b"), ("metadata", 2025, "2_2", "b")]
    assert readers.pick_partitions(readers.discover_partitions(listing), [2025], ["2_2"], 5).count() == 1


@pytest.mark.parametrize("mode", ["w", "w:gz"])
def test_tars(spark, tmp_path, mode):
    body = json.dumps(record(1)).encode()
    path = tmp_path / ("m.tar.gz" if mode == "w:gz" else "m.tar")
    with tarfile.open(path, mode) as t:
        for name in ("d/1.json", "note.txt"):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    assert sorted(r["name"] for r in tars.read_tar_members(spark, str(tmp_path)).collect()) == ["1.json", "note.txt"]
    assert [r["court_code"] for r in tars.read_tar_records(spark, str(tmp_path)).collect()] == ["27~1"]


def test_tar_parts_round_trip(spark, tmp_path):
    plan = spark.createDataFrame([("p0", "a", b"1"), ("p0", "b", b"22"), ("p1", "c", b"")], "part string, name string, body binary")
    out = sinks.write_tar_parts(plan, f"file://{tmp_path}/tars")
    assert sorted(r["part"] for r in out.collect()) == ["p0", "p1"]
    got = tars.read_tar_members(spark, str(tmp_path / "tars"), bodies=True)
    assert sorted((r["part"], r["name"], bytes(r["body"])) for r in got.collect()) == [("p0.tar", "a", b"1"), ("p0.tar", "b", b"22"), ("p1.tar", "c", b"")]


def test_delimited(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("court\tcourt_name\tyear\tportal_total\nx\tX, Y\t2024\t1,234\ny\tY\t2024\t\n")
    assert readers.sniff_separator(spark, str(tmp_path / "a.tsv")) == "\t"
    assert sorted((r["court"], r["portal_total"]) for r in readers.read_baseline(spark, str(tmp_path / "a.tsv")).collect()) == [("x", 1234), ("y", None)]
    (tmp_path / "d.json").write_text('{"27~1": "Court"}')
    assert readers.read_dictionary(spark, str(tmp_path / "d.json"), "code", "name").first()["name"] == "Court"
    assert readers.parse_years("2025, 1999-2001") == [1999, 2000, 2001, 2025] and readers.parse_years(" ") is None


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert sinks.write_report(df, str(tmp_path / "r"), "tsv") and not sinks.write_report(df.limit(0), str(tmp_path / "e"))
    assert not (tmp_path / "e").exists()


def test_stream_equals_batch_and_replays(spark, tmp_path):
    src = tmp_path / "in"
    for i in range(3):
        spark.createDataFrame([(k, i, f"v{i}") for k in range(i, 5)], "k int, t int, v string").coalesce(1).write.mode("append").parquet(str(src))
    root = str(tmp_path / "out")

    def run():
        upsert_stream(read_events(spark, str(src)), root, f"{root}/check", ["k"], ["t"], ("k", "t")).awaitTermination()
        return sorted(tuple(r) for r in TableStore(spark, f"{root}/table").read().collect())

    expected = [(0, 0, "v0"), (1, 1, "v1"), (2, 2, "v2"), (3, 2, "v2"), (4, 2, "v2")]
    assert run() == expected == run()
    spark.createDataFrame([(4, 1, "late"), (0, 9, "newer")], "k int, t int, v string").write.mode("append").parquet(str(src))
    assert run() == [(0, 9, "newer"), *expected[1:]]
    assert dict(TableStore(spark, f"{root}/cursor").read().collect())[4] == 2


def test_plans(spark, tmp_path):
    from docketry.plans.catalogue import QUERIES

    d = "/root/testdata/sf0.001"

    def plan(name):
        return QUERIES[name](spark, d)._jdf.queryExecution().toString()

    assert "PushedFilters: [IsNotNull(o_orderstatus)" in plan("sel_project_limit") and "TakeOrderedAndProject" in plan("sel_project_limit")
    assert "LeftSemi" in plan("semi_in_subquery") and "LeftAnti" in plan("anti_new_files")
    assert "WindowGroupLimit" in plan("win_keep_last") and "BroadcastHashJoin" in plan("bench_lookup")
    for name in QUERIES:
        if name not in ("stream_upsert", "enumerate_partitions"):
            assert "CartesianProduct" not in plan(name) and "BroadcastNestedLoopJoin" not in plan(name), name


def test_filters_on_partitions_prune_folders(spark, tmp_path):
    rows = [(f"{y}{c}.pdf", dt.date(y, 1, 1), y, c, "b") for y in (2023, 2024) for c in ("1_1", "1_2")]
    df = spark.createDataFrame(rows, "pdf_link string, decision_date date, year int, court string, bench string")
    sinks.write_judgments(df, str(tmp_path / "layer"))
    j = readers.read_judgments(spark, str(tmp_path / "layer")).where("year = 2024 and court = '1_1' and decision_date > date '2020-01-01'").select("pdf_link")
    plan = j._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(court#" in plan.split("PartitionFilters:")[1] and "GreaterThan(decision_date,2020-01-01)" in plan
    assert "ReadSchema: struct<pdf_link:string,decision_date:date" in plan and "title" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert [r[0] for r in j.collect()] == ["20241_1.pdf"] and len(j.inputFiles()) >= 1


def test_listing_has_empty_files_and_no_hidden_ones(spark, tmp_path):
    for name, body in (("year=2024/a.pdf", ""), ("year=2024/b.pdf", "x"), ("year=2024/.c.pdf", "x"), ("d.json", "x"), ("deep/er/e.pdf", "xy")):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(body)
    assert sorted((r["name"], r["size"], r["year"]) for r in readers.read_listing(spark, str(tmp_path), "*.pdf").collect()) == [("a.pdf", 0, 2024), ("b.pdf", 1, 2024), ("e.pdf", 2, None)]
    assert readers.read_listing(spark, str(tmp_path / "nowhere")).count() == 0


def test_separators_within_quotes_do_not_count(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n"a\tb\tc\td",1\n"e\tf\tg",2\n')
    assert readers.sniff_separator(spark, str(tmp_path / "a.csv")) == ","
    (tmp_path / "b.tsv").write_text("x, or z\ty\na, b, c\t1\nd\t2\n")
    assert readers.sniff_separator(spark, str(tmp_path / "b.tsv")) == "\t"
    (tmp_path / "c.csv").write_text("")
    assert readers.sniff_separator(spark, str(tmp_path / "c.csv")) == ","


def test_a_store_rewrites_touched_buckets_only(spark, tmp_path):
    from docketry.streaming.upsert import merge

    store = TableStore(spark, str(tmp_path / "t"), ["k"], 8)
    assert store.read() is None and store.version() == -1
    merge(store, spark.createDataFrame([(i, 1) for i in range(100)], "k int, t int"), ["k"], ["t"])
    before = store._folders(store.version())
    merge(store, spark.createDataFrame([(7, 2)], "k int, t int"), ["k"], ["t"])
    after = store._folders(store.version())
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert sorted(tuple(r) for r in store.read().collect()) == [(i, 2 if i == 7 else 1) for i in range(100)]
    for t in (3, 4, 5):
        merge(store, spark.createDataFrame([(7, t)], "k int, t int"), ["k"], ["t"])
    assert store.read().where("k = 7").first()["t"] == 5


def test_a_dictionary_is_one_file(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"{i}.json").write_text('{"a": "b"}')
    with pytest.raises(ValueError, match="one file"):
        readers.read_dictionary(spark, str(tmp_path), "k", "v")


def test_combining_counts_what_it_passes_over(spark, tmp_path):
    root = f"file://{tmp_path}"
    for name, lo in (("a", 0), ("b", 100), ("c", 200)):
        spark.range(lo, lo + 100).coalesce(1).write.parquet(f"{root}/{name}")
    (tmp_path / "b" / "odd.parquet").write_bytes(b"PAR1")
    # The footer of c's file is whole, its pages are not.
    (broken,) = (tmp_path / "c").glob("*.parquet")
    raw = bytearray(broken.read_bytes())
    raw[4:60] = b"\xff" * 56
    broken.write_bytes(raw)
    for x in (tmp_path / "c").glob(".*.crc"):
        x.unlink()
    got = sinks.combine_counted(spark, [f"{root}/{x}" for x in "abc"], f"{root}/all").collect()
    assert [tuple(r) for r in got] == [(4, 1, 300, 200)]
    assert spark.read.parquet(f"{root}/all").count() == 200
