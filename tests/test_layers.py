"""Leaves replaced as a whole, commits that are cut off, and layers whose files have different schemas."""

import datetime as dt
import io
import os
import random
import resource
import tarfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docketry.operators import dedupe
from docketry.sources import commit, readers, sinks, tars

ROW = "cnr string, pdf_link string, decision_date date, year int, court string, bench string"
DAY = dt.date(2024, 3, 5)


def layer_of(spark, root, rows):
    sinks.write_judgments(spark.createDataFrame([(k, f"{k}{b}.pdf", DAY, 2024, "27_1", b) for k, b in rows], ROW), root)


def held(spark, root):
    return sorted((r["bench"], r["cnr"]) for r in readers.read_judgments(spark, root).collect())


def new_rows(spark, rows):
    return spark.createDataFrame([(k, f"{k}-new.pdf", DAY, 2024, "27_1", b) for k, b in rows], ROW)


def test_an_upsert_empties_a_leaf_whose_rows_are_published_by_siblings(spark, tmp_path):
    root, stage = str(tmp_path / "layer"), str(tmp_path / "stage")
    layer_of(spark, root, [("Y", "a"), ("Y", "b"), ("Z", "b")])
    for _ in range(2):
        sinks.upsert_judgments(new_rows(spark, [("Y", "a")]), root, stage)
        assert held(spark, root) == [("b", "Y"), ("b", "Z")]
    (left,) = [f for f in os.listdir(f"{root}/year=2024/court=27_1/bench=a") if f.endswith(".parquet")]
    assert pq.read_table(f"{root}/year=2024/court=27_1/bench=a/{left}").num_rows == 0
    assert set(readers.schemas.JUDGMENT_COLUMNS) <= set(pq.read_schema(f"{root}/year=2024/court=27_1/bench=a/{left}").names)
    assert os.listdir(stage) == []
    sinks.upsert_judgments(new_rows(spark, [("N", "a")]), root, stage)  # the empty leaf takes rows again
    assert held(spark, root) == [("a", "N"), ("b", "Y"), ("b", "Z")]


def test_a_new_leaf_that_stays_empty_is_not_made(spark, tmp_path):
    root = str(tmp_path / "layer")
    layer_of(spark, root, [("Y", "b")])
    sinks.upsert_judgments(new_rows(spark, [("Y", "c")]), root, str(tmp_path / "stage"))
    assert held(spark, root) == [("b", "Y")] and not os.path.exists(f"{root}/year=2024/court=27_1/bench=c")


def test_a_rewrite_empties_leaves_and_its_report_outlives_them(spark, tmp_path):
    root = str(tmp_path / "layer")
    layer_of(spark, root, [("X", "a"), ("X", "b"), ("Y", "b"), ("Q", "c d")])
    rows = readers.read_judgments(spark, root, rows=True).withColumn("mtime", F.col("bench"))
    report = sinks.rewrite_changed(rows, root, str(tmp_path / "stage"), write=True)
    assert sorted((r["rows_before"], r["rows_after"]) for r in report.collect()) == [(1, 0), (1, 1), (2, 2)]
    assert held(spark, root) == [("b", "X"), ("b", "Y"), ("c d", "Q")]
    again = sinks.rewrite_changed(readers.read_judgments(spark, root, rows=True).withColumn("mtime", F.col("bench")), root, str(tmp_path / "stage"), write=True)
    assert again.where("rows_before <> rows_after").count() == 0


@pytest.mark.parametrize("fails_at", range(1, 7))
def test_a_commit_cut_off_anywhere_is_finished_by_the_next_one(spark, tmp_path, monkeypatch, fails_at):
    root, stage = str(tmp_path / "layer"), str(tmp_path / "stage")
    layer_of(spark, root, [("Y", "a"), ("Y", "b"), ("Z", "b")])
    move, calls = commit.Folders.move, []

    def breaks(self, a, b):
        calls.append(a)
        if len(calls) == fails_at:
            raise OSError("gone")
        return move(self, a, b)

    monkeypatch.setattr(commit.Folders, "move", breaks)
    new = new_rows(spark, [("Y", "a"), ("N", "b"), ("M", "c")])
    with pytest.raises(OSError, match="gone"):
        sinks.upsert_judgments(new, root, stage)
    monkeypatch.undo()
    before, after = [("a", "Y"), ("b", "Y"), ("b", "Z")], [("b", "N"), ("b", "Y"), ("b", "Z"), ("c", "M")]
    finished = commit.resume_commits(spark, stage)
    assert (finished, held(spark, root)) == ((0, before) if fails_at == 1 else (1, after))  # the first move publishes the list
    assert commit.resume_commits(spark, stage) == 0 and os.listdir(stage) == []
    sinks.upsert_judgments(new, root, stage)
    assert held(spark, root) == after


def one_after_the_other(existing, new):
    """Keys by leaf after each bench, in order of name, has yielded to what its siblings hold by then."""
    held = {b: set(k) for b, k in existing.items()}
    for b in sorted(new):
        held[b] = (held.get(b, set()) | new[b]) - set().union(*(k for x, k in held.items() if x != b))
    return held


def test_an_upsert_in_turn_equals_one_leaf_after_the_other(spark):
    r = random.Random(3)
    for _ in range(6):
        some = lambda most: {f"b{i}": {f"k{r.randint(0, 9)}" for _ in range(r.randint(1, most))} for i in range(5) if r.random() < 0.7}
        existing, new = some(6), some(4)
        if not existing or not new:
            continue
        frames = [spark.createDataFrame([(k, f"{k}.pdf", DAY, y, "27_1", b) for y in (2023, 2024) for b, ks in x.items() for k in ks], ROW) for x in (existing, new)]
        got = {(x["bench"], x["cnr"]) for x in dedupe.upsert(*frames, in_turn=True).where("year = 2024").collect()}
        assert got == {(b, k) for b, ks in one_after_the_other(existing, new).items() if b in new for k in ks}


def test_rows_without_identity_may_stay_in_every_leaf(spark):
    frames = [spark.createDataFrame([(None, None, DAY, 2024, "27_1", b) for b in x], ROW) for x in ("ab", "bc")]
    assert sorted(r["bench"] for r in dedupe.upsert(*frames, in_turn=True, keep_blank_keys=True).collect()) == ["b", "c"]


def published(root, leaf, kind, names=("A",)):
    """A file as others publish it: a column `court` with the name, dates as timestamps."""
    os.makedirs(f"{root}/{leaf}", exist_ok=True)
    days = pa.array([dt.datetime(2024, 3, 5)] * len(names), pa.timestamp(kind))
    table = pa.table({"cnr": list(names), "pdf_link": [f"{n}.pdf" for n in names], "court": ["High Court"] * len(names), "decision_date": days})
    pq.write_table(table, f"{root}/{leaf}/metadata.parquet", version="2.6")


def test_files_of_all_schemas_are_read_by_their_own(spark, tmp_path):
    root, stage = str(tmp_path / "layer"), str(tmp_path / "stage")
    published(root, "year=2024/court=27_1/bench=a", "us", ("A", "B"))
    published(root, "year=2024/court=27_1/bench=b", "ns", ("D",))
    published(root, "year=2023/court=1_1/bench=a", "us")
    sinks.upsert_judgments(new_rows(spark, [("N", "a")]), root, stage)
    got = sorted((r["year"], r["court"], r["bench"], r["cnr"], r["court_name"], r["decision_date"]) for r in readers.read_judgments(spark, root).collect())
    name = "High Court"
    assert got == [(2023, "1_1", "a", "A", name, DAY), (2024, "27_1", "a", "A", name, DAY), (2024, "27_1", "a", "B", name, DAY), (2024, "27_1", "a", "N", None, DAY), (2024, "27_1", "b", "D", name, DAY)]
    published(root, "year=2024/court=27_1/bench=a", "ns", ("P",))  # beside this library's file, in one leaf
    assert sorted(r["cnr"] for r in readers.read_judgments(spark, root, [2024], ["27_1"], ["a"]).collect()) == ["A", "B", "N", "P"]
    assert sorted(r["row"] for r in readers.read_judgments(spark, root, rows=True).where("bench = 'a' and year = 2024").collect()) == [0, 0, 1, 2]


def scanned_files(df):
    """Files that the scans of a plan have read, by their metrics."""
    df.collect()
    plan, n = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        p = todo.pop()
        if p.metrics().contains("numFiles"):
            n += p.metrics().apply("numFiles").value()
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return n


def test_filters_prune_files_of_every_schema(spark, tmp_path):
    root = str(tmp_path / "layer")
    for y in (2022, 2023):
        for c in ("1_1", "1_2"):
            published(root, f"year={y}/court={c}/bench=a", "us")
    sinks.write_judgments(spark.createDataFrame([("N", f"{y}.pdf", DAY, y, c, "o") for y in (2022, 2023) for c in ("1_1", "1_2")], ROW), root, mode="append")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        j = readers.read_judgments(spark, root).where("year = 2023 and court = '1_2'").select("cnr")
        assert scanned_files(j) == 2 and sorted(r[0] for r in j.collect()) == ["A", "N"]
        assert scanned_files(readers.read_judgments(spark, root).select("cnr")) == 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and plan.count("ReadSchema: struct<cnr:string") == 2 and "title" not in plan.split("ReadSchema")[2]


def test_only_wanted_folders_are_listed(spark, tmp_path):
    for y in (2022, 2023):
        published(str(tmp_path), f"year={y}/court=1_1/bench=a", "us")
    os.makedirs(tmp_path / "year=2024/court=1_1/bench=a")
    (tmp_path / "year=2024/court=1_1/bench=a/broken.parquet").write_text("no table")
    assert readers.read_judgments(spark, str(tmp_path), [2023]).count() == 1
    with pytest.raises(Exception, match="Parquet"):
        readers.read_judgments(spark, str(tmp_path)).count()


def test_an_upsert_reads_the_pairs_of_years_and_courts_it_touches(spark, tmp_path):
    root = str(tmp_path / "layer")
    pairs = [(2022, "1_1"), (2023, "1_2"), (2022, "1_2"), (2023, "1_1")]
    sinks.write_judgments(spark.createDataFrame([("K", "k.pdf", DAY, y, c, "a") for y, c in pairs], ROW), root)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned_files(readers.read_judgments(spark, root).where(sinks._of_pairs(set(pairs[:2]))).select("cnr")) == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def tar_of(path, members, mode="w"):
    with tarfile.open(path, mode) as t:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))


def test_members_are_found_by_headers_and_bodies_by_ranges(spark, tmp_path, monkeypatch):
    long = "d/" * 60 + "x" * 150 + ".json"
    members = [(f"m/{i}.json", bytes([65 + i % 26]) * (i * 37 % 3000)) for i in range(300)] + [(long, b"long name"), ("e.txt", b"")]
    os.makedirs(tmp_path / "t/year=2023/c d")
    tar_of(tmp_path / "t/year=2023/c d/a.tar", members)
    tar_of(tmp_path / "t/b.tar.gz", members, "w:gz")
    tar_of(tmp_path / "t/hidden.zip.tar", [("dir/", b"")])
    monkeypatch.setattr(tars, "SPLIT_BYTES", 50_000)
    got = tars.read_tar_members(spark, str(tmp_path / "t"), bodies=True).where("part <> 'hidden.zip.tar'")
    rows = sorted((r["part"], r["member"], r["size"], bytes(r["body"])) for r in got.collect())
    assert rows == sorted((p, n, len(b), b) for p in ("a.tar", "b.tar.gz") for n, b in members)
    named = tars.read_tar_members(spark, str(tmp_path / "t"), suffix=".txt", years=[2023])
    assert named.columns == ["path", "part", "member", "name", "size"]
    assert {(r["part"], r["name"]) for r in named.collect()} == {("a.tar", "e.txt"), ("b.tar.gz", "e.txt")}
    assert tars.read_tar_members(spark, str(tmp_path / "t"), years=[1999]).where("part = 'a.tar'").count() == 0
    assert tars.read_tar_members(spark, str(tmp_path / "nowhere"), bodies=True).count() == 0


def test_names_of_a_part_of_a_gigabyte_need_little_memory_and_its_bodies_many_tasks(spark, tmp_path):
    n, size = 64, 16 << 20
    with open(tmp_path / "large.tar", "wb") as f:  # sparse: headers, and holes for bodies
        for i in range(n):
            info = tarfile.TarInfo(f"{i}.bin")
            info.size = size
            f.write(info.tobuf())
            f.seek(size, 1)
        f.write(bytes(1024))
    grown = spark.sparkContext.parallelize([0], 1)
    path = f"file://{tmp_path}/large.tar"

    def names(_):
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        found = list(tars._names(path, None))
        yield len(found), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before

    ((count, kilobytes),) = grown.mapPartitions(names).collect()
    assert count == n and kilobytes < 64 << 10
    m = tars.read_tar_members(spark, str(tmp_path), bodies=True)
    tasks = m.select(F.spark_partition_id().alias("p"), F.length("body").alias("n")).groupBy("p").agg(F.sum("n").alias("n")).collect()
    assert sum(r["n"] for r in tasks) == n * size and len(tasks) > 4 and max(r["n"] for r in tasks) < 1 << 28


def test_an_archive_that_is_cut_short_is_an_error(spark, tmp_path):
    tar_of(tmp_path / "a.tar", [("a", b"x" * 5000), ("b", b"y" * 5000)])
    whole = (tmp_path / "a.tar").read_bytes()
    (tmp_path / "a.tar").write_bytes(whole[:3000])
    with pytest.raises(Exception, match="ends within|unexpected end"):
        tars.read_tar_members(spark, str(tmp_path), bodies=True).collect()


def test_tar_parts_stream_and_a_failing_task_leaves_none(spark, tmp_path):
    folder = f"file://{tmp_path}/out dir"
    rows = [(f"p{i % 3}", f"{i:03}", (b"%d" % i) * i if i % 5 else None) for i in range(60)]
    plan = spark.createDataFrame(rows, "part string, name string, body binary")
    for _ in range(2):  # a second writer of the same parts changes nothing
        assert {(r["part"], r["name"]) for r in sinks.write_tar_parts(plan, folder).collect()} == {(f"p{k}", f"p{k}.tar") for k in range(3)}
    for k in range(3):
        with tarfile.open(tmp_path / f"out dir/p{k}.tar") as t:
            names = t.getnames()
            assert names == sorted(n for p, n, _ in rows if p == f"p{k}")
            assert [t.extractfile(n).read() for n in names] == [b or b"" for p, n, b in sorted(rows) if p == f"p{k}"]
    bad = plan.withColumn("body", F.when(F.col("name") == "057", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("body")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_tar_parts(bad.coalesce(1), f"file://{tmp_path}/bad").collect()
    assert not (tmp_path / "bad").exists() or not [f for f in os.listdir(tmp_path / "bad") if f.endswith(".tar") and f == "p0.tar"]
