"""Line dedup in DataFrame functions only."""

import random

from pyspark.sql.classic.dataframe import DataFrame

from docketry.llm import line_dedup
from tests.llm.test_table_operators import brute_lines


def test_native_lines_match_brute_force_without_python(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("Python on the executors")

    monkeypatch.setattr(DataFrame, "mapInArrow", refuse)
    r = random.Random(21)
    text = lambda k: "".join(r.choice("abcdefghijklmnopqrstuvwxyz é😀") for _ in range(k))
    base = [text(k) for k in (9, 12, 20, 40, 90, 200, 400) for _ in range(8)]
    docs = []
    for d in range(120):
        x = r.choice(base)
        at = r.randrange(len(x) + 1)
        docs.append((d, "\n".join([x, x[:at] + "#" + x[at:], text(30), " \t", "short"])))
    docs += [(200, None), (201, ""), (202, "z" * 9000), (203, "z" * 300), (204, base[-1] * 2)]
    df = spark.createDataFrame([*docs, (None, base[0]), (0, docs[0][1])], "doc_id long, text string")
    expected = {(d, i) for d, x in brute_lines(docs).items() for i in x}
    got = {(x["doc_id"], int(i)) for x in line_dedup.line_report(df, native=True).collect() for i in x["dropped"].split(",") if i}
    assert len(expected) > 150 and len(got ^ expected) <= 0.02 * len(expected)  # MinHash may miss a link
