"""Cursors as keyed state: years that fail hold their bench, over batches and restarts."""

import datetime as dt

from docketry.streaming import cursors

OUTCOMES = "court string, bench string, year int, ok boolean, through date"


def day(n):
    return dt.date(2024, 5, n)


def test_a_failed_year_holds_its_bench_until_it_succeeds(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))

    def batch(*rows):
        spark.createDataFrame(rows, OUTCOMES).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(OUTCOMES).option("maxFilesPerTrigger", 1).parquet(source)
        cursors.cursor_stream(stream, out, checkpoint).awaitTermination()  # each batch is a restart from the checkpoint
        written = spark.read.schema(cursors.CURSORS).parquet(out)
        return {r["bench"]: r["cursor"] for r in cursors.kept_cursors(written).collect()}, written

    got, _ = batch(("1", "a", 2023, True, day(1)), ("1", "a", 2024, True, day(1)), ("1", "b", 2023, True, day(1)), ("1", "b", 2024, False, day(1)), ("1", "b", 2024, True, day(1)))
    assert got == {"a": day(1)}
    got, _ = batch(("1", "a", 2024, False, day(2)), ("1", "b", 2023, True, day(2)), ("1", "c", None, None, day(2)), ("2", "d", 2024, True, None))
    assert got == {"a": day(1)}
    got, written = batch(("1", "b", 2024, True, day(2)), ("1", "a", 2023, True, day(3)), ("1", "c", None, True, None), ("2", "d", 2024, True, day(1)))
    assert got == {"a": day(1), "b": day(2), "c": day(2), "d": day(1)}
    assert {tuple(r["failed_years"]) for r in written.where("bench = 'a'").collect()} == {(), (2024,)}
    got, _ = batch(("1", "a", 2024, True, day(2)), ("2", "d", 2024, True, dt.date(2023, 1, 1)))
    assert got == {"a": day(3), "b": day(2), "c": day(2), "d": day(1)}  # a moves to the latest day that was held back; d not back
