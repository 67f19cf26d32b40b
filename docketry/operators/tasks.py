"""Work planning: date ranges, tasks, resume cursors, failed tasks from logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions import scalars as S
from docketry.session import small

# Days that are scraped again for late data; first day of a court without a cursor.
OVERLAP_DAYS = 14
FIRST_DAY = "2008-01-01"
# Patterns of the run log.
FAILED_MARKS = ("Task failed after retries", "- CourtDateTask(")
TASK = r"CourtDateTask\([^)]*court_code=([^,\s]+), from_date=(\d{4}-\d{2}-\d{2}), to_date=(\d{4}-\d{2}-\d{2})"
RERUN = r"rerun_task court=([^,\s]+) from=(\d{4}-\d{2}-\d{2}) to=(\d{4}-\d{2}-\d{2}) .* returncode=(\d+)"
COUNTERS = ("rows", "parse_failure", "downloaded", "skip_s3", "metadata_only", "skip_local", "no_download", "pages", "retries", "errors", "seconds")


def date_ranges(df: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """df with (from_date, to_date) of each range of `days` between its start and end; the last one is cut."""
    step = F.expr(f"sequence({start}, {end}, interval {days} days)")
    rows = df.where(F.col(start) <= F.col(end)).withColumn("from_date", F.explode(step))
    return rows.withColumn("to_date", F.least(F.date_add("from_date", days - 1), end))


def tasks(courts: DataFrame, splits: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """(court, from_date, to_date, dist): courts x ranges x the court's splits (null where it has none)."""
    ranges = date_ranges(courts.withColumns({"_s": F.lit(start).cast("date"), "_e": F.lit(end).cast("date")}), "_s", "_e", days)
    return ranges.join(small(splits), "court", "left").select("court", "from_date", "to_date", "dist")


def days_of(df: DataFrame, keys: list[str], start: str = "from_date", end: str = "to_date") -> DataFrame:
    """Distinct days of overlapping ranges, in order."""
    return df.select(*keys, F.explode(F.sequence(start, end)).alias("day")).distinct().orderBy(*keys, "day")


def index_cursor(scraped: Column, files: Column, year: Column, today: Column) -> Column:
    """The index's own date, else the latest plausible date in its file names.

    Plausible: not before the year ahead of the partition's (nor 2000), and not in the future.
    """
    dates = F.transform(files, lambda f: S.filename_date(f))
    plausible = F.filter(dates, lambda d: (F.year(d) >= F.greatest(F.lit(2000), year - 1)) & (d <= today))
    return F.coalesce(F.try_to_date(scraped, "yyyy-MM-dd"), F.array_max(plausible))


def latest_cursors(cursors: DataFrame, keys: tuple[str, ...] = ("court", "bench"), this_year: int | None = None) -> DataFrame:
    """(keys, cursor): the latest over years; with this_year, of it and the two before."""
    if this_year is not None:
        cursors = cursors.where(F.col("year").between(this_year - 2, this_year))
    return cursors.groupBy(*keys).agg(F.max("cursor").alias("cursor"))


def earliest_by_court(cursors: DataFrame) -> DataFrame:
    """(court, cursor): the earliest over benches; cursors that are no dates are passed over."""
    date = F.try_to_date(F.col("cursor").cast("string"), "yyyy-MM-dd")
    return cursors.groupBy("court").agg(F.min(date).alias("cursor"))


def start_dates(courts: DataFrame, cursors: DataFrame, end: str) -> DataFrame:
    """(court, start): the cursor, but at least OVERLAP_DAYS before the end; FIRST_DAY without a cursor."""
    e = F.lit(end).cast("date")
    j = courts.join(cursors, "court", "left")
    return j.select("court", F.when(F.col("cursor").isNull(), F.lit(FIRST_DAY).cast("date")).otherwise(F.least("cursor", F.date_sub(e, OVERLAP_DAYS))).alias("start"))


def advanced_cursor(old: Column, new: Column) -> Column:
    """A cursor never moves back."""
    return F.greatest(old, new)


def committed_cursors(results: DataFrame, end: str) -> DataFrame:
    """(court, bench, cursor) of the benches of which every year succeeded; results: court, bench, year, ok."""
    good = results.groupBy("court", "bench").agg(F.bool_and("ok").alias("ok")).where("ok")
    return good.select("court", "bench", F.lit(end).cast("date").alias("cursor"))


def failed_tasks(lines: DataFrame, line: str = "value") -> DataFrame:
    """Distinct (court, from_date, to_date) of tasks that failed after all retries, in order."""
    marked = lines.where(F.col(line).contains(FAILED_MARKS[0]) | F.ltrim(line).startswith(FAILED_MARKS[1]))
    return _matched(marked, line, TASK).distinct().orderBy("court", "from_date", "to_date")


def failed_reruns(lines: DataFrame, line: str = "value") -> DataFrame:
    """Distinct tasks of reruns that ended with another return code than 0."""
    code = F.regexp_extract(line, RERUN, 4).try_cast("int")
    return _matched(lines.where(code != 0), line, RERUN).distinct().orderBy("court", "from_date", "to_date")


def _matched(lines: DataFrame, line: str, pattern: str) -> DataFrame:
    rows = lines.where(F.col(line).rlike(pattern))
    return rows.select(*(F.regexp_extract(line, pattern, i).alias(c) for i, c in ((1, "court"), (2, "from_date"), (3, "to_date"))))


def run_counters(events: DataFrame, keys: list[str], measure: str = "measure", value: str = "value") -> DataFrame:
    """A row per run with the eleven counters, 0 where nothing was counted."""
    return events.groupBy(*keys).pivot(measure, list(COUNTERS)).agg(F.sum(value)).na.fill(0, list(COUNTERS))


def retry_rounds(failed: DataFrame, attempt, rounds: int = 3) -> DataFrame:
    """What is still failed after up to `rounds` rounds; each round splits what is left into days first.

    failed: court, from_date, to_date (dates). attempt(tasks) runs a table of tasks and returns those that
    failed, in the same columns. Only the number left is looked at on the driver.
    """
    left = failed.select("court", "from_date", "to_date").distinct()
    for _ in range(rounds):
        if left.isEmpty():
            break
        days = days_of(left, ["court"]).select("court", F.col("day").alias("from_date"), F.col("day").alias("to_date"))
        left = attempt(days).select("court", "from_date", "to_date").distinct()
    return left
