import datetime as dt

import pytest
from pyspark.sql import functions as F

from docketry.functions import scalars as S
from docketry.functions.html import fields


def values(spark, rows, kind, column):
    df = spark.createDataFrame([(x,) for x in rows], f"x {kind}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


DATES = {
    "01-02-2024": ("2024-02-01", "2024-02-01"),
    "1-2-2024": ("2024-02-01", "2024-02-01"),
    "13-02-2024": ("2024-02-13", "2024-02-13"),
    "02-13-2024": (None, "2024-02-13"),
    "2024-13-01": (None, "2024-01-13"),
    "2024-02-01": (None, "2024-02-01"),
    "01/02/2024": (None, "2024-02-01"),
    "01.02.2024": (None, "2024-02-01"),
    "1 Feb 2024": (None, "2024-02-01"),
    "01-02-24": (None, "2024-02-01"),
    "2024": (None, "2024-01-01"),
    "31-02-2024": (None, None),
    "abc": (None, None),
    "": (None, None),
    "01-02-1850": ("1850-02-01", "1850-02-01"),
    "01-02-1600": ("1600-02-01", None),
    "01-02-2300": ("2300-02-01", None),
}


def test_dates(spark):
    day = lambda x: dt.date.fromisoformat(x) if x else None
    assert values(spark, DATES, "string", S.strict_date) == [day(a) for a, _ in DATES.values()]
    assert values(spark, DATES, "string", S.lenient_date) == [day(b) for _, b in DATES.values()]


def test_sizes(spark):
    n = [0, 512, 1536, 1024**5]
    assert values(spark, n, "long", S.format_size) == ["0 B", "512 B", "1.50 KB", "1024.00 TB"]
    assert values(spark, n, "long", S.format_size_short) == ["0.0 B", "512.0 B", "1.5 KB", "1.0 PB"]


def test_strip_removes_what_python_strips(spark):
    texts = [" a ", " b\x1c", "\x1fc\t\n", "d", "", "　"]
    assert values(spark, texts, "string", S.strip) == [t.strip() for t in texts]


def test_logical_key_cases(spark):
    df = spark.createDataFrame([("ABC", "2025-01-01", "a.pdf"), ("", "2025-01-01", "a.pdf"), (None, "2025-01-01", " b.pdf "), ("ABC", None, "c.pdf"), (None, None, None)], "c string, d string, l string")
    c, d, k = F.col("c"), F.col("d"), F.col("l")
    assert [r[0] for r in df.select(S.logical_key(c, d, k)).collect()] == ["cnr:ABC|decision_date:2025-01-01", "pdf:a.pdf", "pdf:b.pdf", "pdf:c.pdf", "pdf:"]
    assert [r[0] for r in df.select(S.logical_key(None, d, k)).collect()][0] == "pdf:a.pdf"
    assert {r[0] for r in df.select(S.logical_key(None, d, None)).collect()} == {""}
    assert [r[0] for r in df.select(S.logical_key(c, d, None)).collect()][1] == ""


def test_names_and_paths(spark):
    p = ["data/tar/year=2025/court=27_1/bench=newos/x_2024-05-06.PDF", "a/.hidden", "x.json", "b/y"]
    assert values(spark, p, "string", S.basename) == ["x_2024-05-06.PDF", ".hidden", "x.json", "y"]
    assert values(spark, p, "string", S.stem) == ["x_2024-05-06", ".hidden", "x", "y"]
    assert values(spark, p, "string", S.path_year) == [2025, None, None, None]
    assert values(spark, p, "string", lambda c: S.path_part(c, "court")) == ["27_1", None, None, None]
    assert values(spark, p, "string", S.filename_date)[0] == dt.date(2024, 5, 6)
    assert values(spark, ["x.json", "y"], "string", lambda c: S.with_suffix(c, ".pdf")) == ["x.pdf", "y.pdf"]
    assert values(spark, ["27~1~2"], "string", S.to_path_code) == ["27_1_2"]


def test_numbers(spark):
    assert values(spark, ["", " 1,234 ", None, "x"], "string", S.lenient_int) == [0, 1234, None, None]
    df = spark.createDataFrame([(0, 7, 3)], "a int, b int, c int")
    assert df.select(S.first_nonzero(F.col("a"), F.col("b"), F.col("c"))).first()[0] == 7


def test_query_map_keeps_the_first_value(spark):
    assert values(spark, ["a=1&b=x%20y&a=2", "", "q"], "string", S.query_map) == [{"a": "1", "b": "x y"}, {}, {}]


def test_pdf_bodies(spark):
    bodies = [b"%PDF-1.4 x", b"", b"<html>", b"%PDF" + b"x" * 311, None]
    assert values(spark, bodies, "binary", S.valid_pdf) == [True, False, False, False, False]
    assert values(spark, [b"\x1f\x8b\x00", b"no", None], "binary", S.is_gzip) == [True, False, False]


def test_validation_and_fragments(spark):
    assert values(spark, ["27~1", "27_1", None, "a~1"], "string", S.valid_court_code) == [True, False, False, False]
    assert values(spark, ["court/a/b.pdf", "x/b.pdf", "court/b.txt"], "string", S.valid_pdf_link) == [True, False, False]
    assert values(spark, ["open_pdf('0','1','court/a.pdf#page=1')", "x()"], "string", S.pdf_fragment) == ["court/a.pdf", None]


def test_next_range(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 5)), (dt.date(2024, 1, 5), dt.date(2024, 1, 5))], "last date, today date")
    got = [r[0] for r in df.select(S.next_range(F.col("last"), 7, F.col("today"))).collect()]
    assert tuple(got[0]) == (dt.date(2024, 1, 2), dt.date(2024, 1, 5)) and got[1] is None


DETAILS = '<strong class="caseDetailsTD"><span>CNR :</span><font>{cnr}</font><span>Date of registration :</span><font>01-01-2020</font><span>Decision Date :</span><font> 05-03-2024 </font><span>Disposal Nature :</span><font>ALLOWED</font><br><span>Court : High Court of X</span></strong>'


def test_html_complete():
    f = fields("<button onclick=\"x('a.pdf')\"><font> T </font></button> D <strong>Judge : X</strong>" + DETAILS.format(cnr="ABC"))
    assert (f["title"], f["description"], f["judge"], f["cnr"], f["decision_date"], f["disposal_nature"], f["court_name"]) == ("T", "D", "X", "ABC", "05-03-2024", "ALLOWED", "High Court of X")
    assert f["has_button"] and f["labels"]["CNR"] == "ABC"


@pytest.mark.parametrize(
    ("html", "key", "expected"),
    [
        ("text only", "title", ""),
        ("<button>T</button>D", "cnr", ""),
        ("<button>T</button>" + DETAILS.format(cnr=""), "cnr", "01-01-2020"),  # an empty field takes the next one's value
        ("<strong>no colon</strong>", "judge_valid", False),
        ("<strong class='caseDetailsTD x'><span>CNR</span><font>A</font></strong>", "cnr", ""),
        ("", "title", ""),
        (None, "has_button", False),
    ],
)
def test_html_cases(html, key, expected):
    assert fields(html)[key] == expected


def test_plain_snippets_parse_as_by_the_parser():
    import random

    from docketry.functions import html

    def tree(n):
        return n.tag, n.attrs, [x if isinstance(x, str) else tree(x) for x in n.items]

    r, plain = random.Random(3), 0
    parts = ["<b>", "</b>", "<span>", "</span>", "<font color='x'>", "</font>", "<br>", "<br/>", "text", " CNR :", "<strong class=\"caseDetailsTD\">", "</strong>", "<button onclick=\"a('b.pdf')\">", "</button>", "<div>", "</div>", "&amp;", "<td a b=\"\">", "</p>", "<STRONG>", "x > y", "<!-- c -->", "<a href=u>", "&nbsp;", "<input disabled value='&lt;'>", "a<b", "<script>"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        if (p := html._plain_tree(t)) is not None:
            plain += 1
            assert tree(p) == tree(html._parsed_tree(t)), t
    assert plain > 300


def test_tags_of_any_depth_and_of_no_end(spark):
    import pyarrow as pa

    from docketry.functions.html import _struct

    page = "<button onclick=\"x('a')\">T</button>D<strong>Judge : X</strong><strong class='caseDetailsTD'><span>CNR</span><font>C</font></strong>"
    cases = ["<div>" + "<b>" * 5000 + "x" + "</b>" * 5000 + page + "</div>", "<i>" * 20000 + "</i>" * 20000 + page, page + "<b>" * 20000, "<!-- c -->" + "<b>" * 5000 + "</b>" * 5000 + page]
    got = _struct(pa.array([*cases, None])).to_pylist()
    assert [(g["title"], g["judge"], g["cnr"]) for g in got] == [("T", "X", "C")] * 4 + [("", "", "")]
    assert fields("<strong class='caseDetailsTD'>" + "<span>CNR" * 20000 + "<font>C</font>" + page)["cnr"] == "C"


def test_mutated_snippets_give_the_same_fields_by_either_way(monkeypatch):
    import random

    from docketry.functions import html

    page = "<div><button onclick=\"x('a')\">T &amp; U</button>D<br><strong>Judge : X</strong><strong class=\"caseDetailsTD\"><span>CNR :</span><font></font><p><span>Decision Date</span> v <font>05-03-2024</font></p><span>Court : Y</span></strong></div>"
    pieces = ["<b>", "</b>", "</span>", "<font>", "</strong>", "<strong class='caseDetailsTD'>", "x", " ", "<br/>", "<button>", "</div>", "Court : z", ":", "&lt;", "<span>"]
    r, texts = random.Random(8), []
    for _ in range(10_000):
        t = page
        for _ in range(r.randint(1, 6)):
            a = r.randint(0, len(t))
            t = t[:a] + r.choice(pieces) + t[a:] if r.random() < 0.6 else t[:a] + t[a + r.randint(1, 10) :]
        texts.append(t)
    scanned = [fields(t) for t in texts]
    plain = sum(html._plain_tree(t) is not None for t in texts)
    monkeypatch.setattr(html, "_plain_tree", lambda t: None)
    assert [fields(t) for t in texts] == scanned and plain > 1000
