import datetime as dt

from docketry.functions.courts import COURTS, court_dimension
from docketry.operators import tasks
from docketry.plans import sql
from docketry.sources import sinks


def test_levels(spark, tmp_path):
    rows = [(f"t{i}", f"J{i % 3}", f"{i}.pdf", f"C{i}", dt.date(2024 + i % 2, 1, 1 + i % 20), "Court", 2024 + i % 2, "27_1", "b") for i in range(40)]
    df = spark.createDataFrame(rows, "title string, judge string, pdf_link string, cnr string, decision_date date, court_name string, year int, court string, bench string")
    sinks.write_judgments(df, str(tmp_path / "layer"))
    sql.register(spark, str(tmp_path / "layer"))
    assert sql.ask(spark, "selection", year="2024", court="27_1").count() == 10
    assert sql.ask(spark, "newest", year="2025").first()["decision_date"] == dt.date(2025, 1, 20)
    assert sql.ask(spark, "pattern", word="t3").count() == 11
    assert [tuple(r) for r in sql.ask(spark, "top_judges", year="2024").collect()] == [("J0", 7), ("J2", 7), ("J1", 6)]
    assert sql.ask(spark, "busy_judges", least=13).count() == 1
    assert sql.ask(spark, "cases_of_busy_judges", least=13).count() == 14
    assert sql.ask(spark, "ranked", year="2024").where("date_rank = 1").count() >= 1
    got = sql.case_links({"a": df, "b": df.limit(0)}, ["C1", "nope"]).collect()
    assert [(r["cnr"], r["side"], [x["pdf_link"] for x in r["links"]]) for r in got] == [("C1", "a", ["1.pdf"])]


def test_courts(spark):
    assert court_dimension(spark).count() == len(COURTS) == 25


def test_retry_rounds(spark):
    week = spark.createDataFrame([("c", dt.date(2024, 1, 1), dt.date(2024, 1, 7))], "court string, from_date date, to_date date")
    seen = []

    def attempt(t):
        seen.append(t.count())
        return t.where("day(from_date) > 5" if len(seen) == 1 else "day(from_date) > 6")

    left = tasks.retry_rounds(week, attempt)
    assert seen == [7, 2, 1] and left.count() == 1
