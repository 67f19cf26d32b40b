"""The pipeline's stages over the small tables, against their rules."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline as P
from docketry.llm import queries
from docketry.llm.ngram_join import part_keys

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(df):
    return [r[0] for r in df.select("doc_id").collect()]


def test_stages_return_the_columns_of_documents(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(after.columns == columns for _, after in stages[:-1])


def test_filters_keep_whole_rows(stages):
    for before, after in stages[:3]:
        there = {r["doc_id"]: r["text"] for r in before.collect()}
        kept = after.collect()
        assert len(kept) == len({r["doc_id"] for r in kept}) <= len(there)
        assert all(there[r["doc_id"]] == r["text"] for r in kept)


def brute_groups(docs, n, percent):
    """Document to the smallest document of its group, by word shingles of n words."""
    from test_table_operators import Find, shingles

    f, sets = Find(), [(d, shingles(t, n)) for d, t in docs]
    for i, (d, a) in enumerate(sets):
        f.root(d)
        for e, b in sets[:i]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                f.join(d, e)
    return {d: f.root(d) for d, _ in sets}


def test_one_of_each_group_stays(stages):
    """The task's rule for near-duplicate stages: shingles of five words, a similarity of 0.8."""
    before, after = stages[1]
    groups = brute_groups([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
    assert sorted(ids(after)) == sorted(set(groups.values()))


def test_components_of_the_stage_by_the_rule_of_the_query(stages):
    """The same documents by three words and 0.9, as the query op7 groups them."""
    from docketry.llm.ngram_join import jaccard_components

    from test_table_operators import brute_components

    rows = [(r["doc_id"], r["text"]) for r in stages[1][0].collect()]
    assert {r["doc_id"]: r["component_id"] for r in jaccard_components(stages[1][0]).collect()} == brute_components(rows)


def test_near_copies_between_the_thresholds_go(spark):
    """Copies with a tenth of their words replaced in one place, or a seventh appended."""
    r = random.Random(2)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    docs = []
    for i in range(20):
        base = words(200)
        docs += [(3 * i, " ".join(base)), (3 * i + 1, " ".join(base + words(28))), (3 * i + 2, " ".join(base[:90] + words(15) + base[105:]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    groups = brute_groups(docs, 5, 80)
    assert len(set(groups.values())) == 20
    assert sorted(ids(P.near_duplicates(spark, df, SF))) == sorted(set(groups.values()))


ODD = "doc_id long, text string, lang string, source string, __id long, __copies int, __lang string, key long, rank int, language string, k string, h long, c0 string, node long, component_id long"


def odd_rows():
    r = random.Random(4)
    en = [" ".join(r.choices("the cat and dog ran over a hill with its own old red ball while we saw it go".split(), k=60)) for _ in range(6)]
    texts = [*en, en[0], en[1], None, "", " \n\t", "x" * 300_000, "the old cat " * 40_000, "日本 語", "1 2 3"]
    rows = [(None if i % 5 == 3 else i // 2, t, "en", [None, "a", "b"][i % 3]) for i, t in enumerate(texts)]
    rows += [(1, en[0], "en", "a"), (1, en[0], "en", "a"), (1, en[2], "en", "b"), (None, en[3], "en", "a"), (None, en[3], "en", "a")]
    return [(*x, 1, 2, "q", 3, 4, "z", "k", 5, "c", 6, 7) for x in rows]


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_take_odd_rows(spark, name):
    """Nulls in any column, blank and very long texts, repeated rows and ids, clashing names, and no rows at all."""
    stage = dict(P.STAGES)[name]
    rows = odd_rows()
    df = spark.createDataFrame(rows, ODD)
    got = stage(spark, df, SF)
    out = [tuple(x) for x in got.collect()]
    empty = stage(spark, df.limit(0), SF)
    assert empty.count() == 0
    if name == "token_ids":
        assert len(out) == len(rows)
        return
    assert got.columns == empty.columns == df.columns and set(out) <= set(rows)
    text = lambda x: [r[1] for r in x]
    if name == "language":
        assert {x for x in text(out)} == {t for t in text(rows) if t and any(c.isalpha() for c in t)} - ({"日本 語"} - set(text(out)))
        assert sorted(map(repr, out)) == sorted(repr(x) for x in rows if x[1] in set(text(out)))
    if name == "near_duplicates":
        full = [x for x in out if x[1] and x[1].strip()]
        assert len(set(text(full))) == len(full) and set(text(full)) == {t for t in text(rows) if t and t.strip()}
        assert {x[0] for x in out if not (x[1] or "").strip()} == {x[0] for x in rows if not (x[1] or "").strip()}
    if name == "decontamination":
        assert sorted(map(repr, out)) == sorted(map(repr, rows))
    if name == "mixing":
        assert all(t and t.strip() for t in text(out))


def test_contaminated_rows_go_whatever_their_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first()["text"]
    rows = [(1, "clean text here"), (1, item), (None, item), (None, "clean again"), (2, None), (3, item + " clean" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from docketry.llm.decontaminate import clean_documents

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for got in (P.decontamination(spark, df, SF), clean_documents(df, bench, broadcast_words=-1)):
        assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted((x for x in rows if x[1] != item), key=repr)


def test_language_stage_by_its_rule(spark):
    """What stays are the rows whose language is named with the least score, judged one by one."""
    from docketry.llm.language_id import fit_languages, identify, remainder

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_languages(docs, remainder("doc_id", 4) != 2)
    scored = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs, model).collect()}
    assert set(ids(P.language(spark, docs, SF))) == {d for d, (x, s) in scored.items() if x != "und" and s >= P.LEAST_LANGUAGE_SCORE}


def test_contaminated_documents_go(spark, stages):
    from docketry.llm.decontaminate import contamination_report

    before, after = stages[2]
    bad = set(ids(contamination_report(before, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated")))
    assert set(ids(after)) == set(ids(before)) - bad


def test_the_mix_takes_whole_documents_near_the_targets(stages):
    from docketry.llm.mixing import mix

    before, after = stages[3]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    taken, largest = {}, {}
    for r in after.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + size(r["text"])
    targets = {r["source"]: r["target"] for r in mix(before).collect()}
    for r in before.collect():
        largest[r["source"]] = max(largest.get(r["source"], 0), size(r["text"]))
    assert all(abs(taken.get(s, 0) - t) <= largest[s] for s, t in targets.items())


def test_run_gives_a_line_per_document_of_the_mix(spark, stages):
    got = P.run(spark, SF).orderBy("start").collect()
    assert len(got) == stages[3][1].count() == stages[4][1].count()
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)


def test_queries_cover_the_ten_operators():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("size", [60, 200, 400, 900, 2500])
def test_links_right_at_the_threshold_share_a_part(size):
    """Pairs of sets of 0.8 of similarity exactly, the smaller one a part of the larger: the most tokens differ."""
    rng = np.random.default_rng(size)
    missed = 0
    for _ in range(500):
        larger = rng.integers(0, 2**64, size, np.uint64)
        smaller = larger[: size * P.PERCENT // 100]
        both = np.concatenate([np.sort(larger), np.sort(smaller)])
        owner, key = part_keys(both, np.array([0, size, len(both)]), P.PERCENT, P.EQUAL_PARTS)
        missed += not np.intersect1d(key[owner == 0], key[owner == 1]).size
    assert missed <= 2
