"""Scalar rules as Column expressions; all stay inside code generation.

ANSI mode throws on bad casts and dates, so everything lenient goes through try_* functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.strip() removes, as a Java pattern (trim() removes the plain space only).
_BLANK = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# Patterns of lenient dates, day first, in the order they are tried.
LENIENT_DATES = ("d-M-yyyy", "d/M/yyyy", "d.M.yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyy-M-d", "yyyy/M/d", "M-d-yyyy", "M/d/yyyy", "yyyy-d-M", "d-M-yy", "yyyy")
# Years that nanosecond timestamps can hold in full.
LENIENT_YEARS = (1678, 2261)

# Units of the two size formats.
UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def strip(c: Column) -> Column:
    """Without white space at both ends, in the sense of Unicode and the separators 0x1C to 0x1F."""
    return F.regexp_replace(c, _BLANK, "")


def strip_or_empty(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def logical_key(cnr: Column | None, decision_date: Column | None, pdf_link: Column | None) -> Column:
    """Identity of a judgment: `cnr:<cnr>|decision_date:<date>` if both are given, else `pdf:<link>`.

    None stands for a column that does not exist: without a link, an incomplete row has the empty key.
    """
    link = None if pdf_link is None else F.concat(F.lit("pdf:"), strip_or_empty(pdf_link))
    if cnr is None or decision_date is None:
        return F.lit("") if link is None else link
    c, d = strip_or_empty(cnr), strip_or_empty(decision_date)
    return F.when((c != "") & (d != ""), F.concat(F.lit("cnr:"), c, F.lit("|decision_date:"), d)).otherwise(F.lit("") if link is None else link)


def to_path_code(code: Column) -> Column:
    """`27~1` as it stands in paths; every tilde is replaced."""
    return F.translate(code, "~", "_")


def from_path_code(code: Column) -> Column:
    return F.translate(code, "_", "~")


def _scaled(n: Column, units: tuple[str, ...], digits: int, whole_bytes: bool) -> Column:
    """n in the largest unit that keeps it at 1 or more; format_number rounds as the value's exact decimals do."""
    out = None
    for k in reversed(range(len(units))):
        x = n.cast("double") / float(1024**k)
        text = n.cast("long").cast("string") if k == 0 and whole_bytes else F.translate(F.format_number(x, digits), ",", "")
        text = F.concat(text, F.lit(f" {units[k]}"))
        out = text if k == 0 and out is None else (F.when(n >= 1024**k, text) if out is None else (out.otherwise(text) if k == 0 else out.when(n >= 1024**k, text)))
    return out


def format_size(n: Column) -> Column:
    """`512 B`, `1.50 KB`, ... up to TB."""
    return _scaled(n, UNITS[:5], 2, True)


def format_size_short(n: Column) -> Column:
    """`512.0 B`, `1.5 KB`, ... up to PB."""
    return _scaled(n, UNITS, 1, False)


def gib(n: Column) -> Column:
    return n / float(1 << 30)


def tib(n: Column) -> Column:
    return n / float(1 << 40)


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dirname(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def with_suffix(name: Column, suffix: str) -> Column:
    """The name with its last suffix replaced, or with the suffix added."""
    return F.concat(F.regexp_replace(name, r"(?<=[^/])\.[^./]*$", ""), F.lit(suffix))


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def pdf_name(link: Column) -> Column:
    return or_null(F.regexp_extract(link, r"([^/]+\.pdf)$", 1))


def filename_date(name: Column) -> Column:
    """The date before the extension of `..._YYYY-MM-DD.pdf` or `.json`; null if there is none or it is no date."""
    return F.try_to_date(or_null(F.regexp_extract(name, r"(?i)_(\d{4}-\d{2}-\d{2})\.(pdf|json)$", 1)), "yyyy-MM-dd")


def path_part(path: Column, name: str) -> Column:
    """The value of `name=` in a path; null if it is absent."""
    return or_null(F.regexp_extract(path, rf"(?:^|/){name}=([^/]+)", 1))


def path_year(path: Column) -> Column:
    return path_part(path, "year").try_cast("int")


def staged_bench(path: Column) -> Column:
    """The folder below `cnrorders` in a staging path."""
    return or_null(F.regexp_extract(path, r"(?:^|/)cnrorders/([^/]+)", 1))


def strict_date(text: Column) -> Column:
    """Day-month-year with dashes and a year of four digits; anything else is null."""
    t = strip(text)
    return F.when(t.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.try_to_date(t, "d-M-yyyy"))


def lenient_date(text: Column) -> Column:
    """The first of LENIENT_DATES that fits, within LENIENT_YEARS."""
    t = strip(text)
    d = F.coalesce(*(F.try_to_date(t, p) for p in LENIENT_DATES))
    return F.when(F.year(d).between(*LENIENT_YEARS), d)


def iso_timestamp(text: Column) -> Column:
    """An ISO timestamp with or without `Z`."""
    return F.try_to_timestamp(F.regexp_replace(text, "Z$", ""))


def part_name(at: Column) -> Column:
    """Name of an archive part made at a UTC time."""
    return F.date_format(at, "'part-'yyyyMMdd'T'HHmmss'Z'")


def partition_path(year: Column, court: Column, bench: Column) -> Column:
    return F.format_string("year=%d/court=%s/bench=%s", year.cast("int"), court, bench)


def index_path(data_type: Column, year: Column, court: Column, bench: Column) -> Column:
    """Key of the tar index of a partition; data_type is `data` or `metadata`."""
    return F.concat(data_type, F.lit("/tar/"), partition_path(year, court, bench), F.lit("/"), data_type, F.lit(".index.json"))


def lenient_int(text: Column) -> Column:
    """Blank is 0, commas are dropped, null stays null; other text is null."""
    t = strip(text)
    return F.when(t == "", F.lit(0).cast("long")).otherwise(F.replace(t, F.lit(","), F.lit("")).try_cast("long"))


def first_nonzero(*counts: Column) -> Column:
    """The first that is neither null nor 0, else the last."""
    return F.coalesce(*(F.nullif(c, F.lit(0)) for c in counts[:-1]), counts[-1])


def pdf_fragment(onclick: Column) -> Column:
    """The path in a link's handler, `open_pdf('..','..','path#page')`, without what follows `#`."""
    return or_null(F.substring_index(F.regexp_extract(onclick, r"'([^']*\.pdf[^']*)'", 1), "#", 1))


def valid_court_code(code: Column) -> Column:
    return F.coalesce(code.rlike(r"^\d+~\d+$"), F.lit(False))


def valid_pdf_link(link: Column) -> Column:
    return F.coalesce(link.rlike(r"^court/.*\.pdf$"), F.lit(False))


def valid_pdf(content: Column, status: Column | None = None) -> Column:
    """A PDF body: not empty, not the 315 bytes of the portal's error page, and of the right magic."""
    ok = (F.octet_length(content) > 0) & (F.octet_length(content) != 315) & (F.substring(content, 1, 4) == F.lit(b"%PDF"))
    return F.coalesce(ok if status is None else ok & (status == 200), F.lit(False))


def is_gzip(content: Column) -> Column:
    return F.coalesce(F.substring(content, 1, 2) == F.lit(b"\x1f\x8b"), F.lit(False))


def next_range(last_end: Column, days: int, today: Column) -> Column:
    """The next range of `days` after last_end, ending today at the latest; null when that lies ahead."""
    start = F.date_add(last_end, 1)
    return F.when(start <= today, F.struct(start.alias("from"), F.least(F.date_add(start, days - 1), today).alias("to")))


def query_map(query: Column) -> Column:
    """A decoded query string as a map; of a repeated name the first value."""
    pairs = F.filter(F.split(query, "&"), lambda x: x.contains("="))
    decoded = F.transform(pairs, lambda x: F.struct(F.try_url_decode(F.substring_index(x, "=", 1)).alias("k"), F.try_url_decode(F.regexp_replace(x, "^[^=]*=", "")).alias("v")))
    empty = F.array().cast("array<struct<k:string,v:string>>")
    first = F.aggregate(decoded, empty, lambda a, x: F.when(F.exists(a, lambda y: y["k"] == x["k"]), a).otherwise(F.concat(a, F.array(x))))
    return F.map_from_entries(first)


def pages_text(pages: Column) -> Column:
    """Pages as a JSON array (valid JSON, with backslashes escaped too)."""
    return F.to_json(pages)


def result_html(row: Column) -> Column:
    """The HTML in a search result row given as JSON: the second item of a list, or `1` or `html` of an object."""
    items = [F.get_json_object(row, p) for p in ("$[1]", "$['1']", "$.html")]
    listed = F.ltrim(row).startswith("[")
    named = F.coalesce(*(F.nullif(x, F.lit("")) for x in items[1:]))
    return F.coalesce(F.when(listed, items[0]).otherwise(named), F.lit(""))


def host(url: Column) -> Column:
    return or_null(F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://([^/?#]+)", 1))
