"""Merkle manifest, phrase collocations and media columns, against plain versions."""

import hashlib
import io
import random
import re
import struct
import wave
import zlib
from collections import Counter

import numpy as np
import pytest

from docketry.llm import collocations as C
from docketry.llm import media as M
from docketry.llm import merkle as K

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `Text_` string, leaf string, tree string, salt string"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])))


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        x = out[-1]
        out.append([H("".join(x[i : i + fanout])) for i in range(0, len(x), fanout)])
    return out


def manifest(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), sorted."""
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    groups = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf(r) for r in sorted(by[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))], fanout) for g in groups}
    top = levels([trees[g][-1][0] for g in groups], fanout)
    out = []
    for j, g in enumerate(groups):
        for i, r in enumerate(sorted(by[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))):
            changed = dict(r)
            if r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0:
                changed["n_chars"] += 1
            node, proof = leaf(changed), []
            for tree, at in ((trees[g], i), (top, j)):
                for level in tree[:-1]:
                    first = at - at % fanout
                    run = level[first : first + fanout]
                    proof += run[: at - first] + run[at - first + 1 :]
                    run[at - first] = node
                    node, at = H("".join(run)), at // fanout
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], root, H("".join(proof)), node, node == root))
    return sorted(out, key=repr)


def doc_rows(n=90, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        text = r.choice([None, "", "a:b", "ü" * r.randint(1, 9), "word " * r.randint(1, 50)])
        rows.append({"doc_id": r.choice([None, i, i, i, 7]), "text": text, "lang": r.choice([None, "en", "en", "en", "en", "de", "é", "", "=x"]), "source": r.choice([None, "s", ""]), "n_chars": r.choice([None, 0, len(text or "")]), "Text_": "x", "leaf": "l", "tree": "t", "salt": None})
    return rows + [rows[3]] * 40  # one row repeated


@pytest.mark.parametrize("fanout,block", [(2, 10), (2, 1), (3, 2), (5, 3)])
def test_manifest_equals_a_plain_tree(spark, fanout, block):
    rows = doc_rows()
    got = K.manifest_report(spark.createDataFrame(rows, DOCS), fanout, block)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = manifest(rows, fanout)
    assert sorted(map(tuple, got.collect()), key=repr) == want and {True, False} == {r[-1] for r in want}


@pytest.mark.parametrize("n", [0, 1, 2])
def test_manifest_of_few_rows(spark, n):
    rows = [dict(r, lang="en") for r in doc_rows()[:n]]
    assert sorted(map(tuple, K.manifest_report(spark.createDataFrame(rows, DOCS)).collect()), key=repr) == manifest(rows)


def test_changed_groups_name_what_differs(spark):
    def made(rows):
        return K.manifest(spark.createDataFrame(rows, "`group` string, k int, leaf string"), ["k"])

    old = [("a", 1, H("x")), ("a", 2, H("y")), (None, 1, H("z")), ("gone", 1, H("q"))]
    new = [("a", 1, H("x")), ("a", 2, H("y")), (None, 1, H("Z")), ("new", 1, H("q"))]
    assert sorted((r["group"] or "", r["old_subroot"] is None, r["new_subroot"] is None) for r in K.changed_groups(made(old), made(new)).collect()) == [("", False, False), ("gone", False, True), ("new", True, False)]
    assert K.changed_groups(made(old), made(old)).count() == 0


def test_no_window_of_the_manifest_holds_a_whole_group(spark):
    plan = K.manifest_report(spark.createDataFrame(doc_rows(), DOCS), 2, 3)._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    keys = [re.search(r"\], \[([^\]]*)\], \[[^\]]*\]$", x)[1] for x in windows]
    assert windows and all("block" in k and k.count("#") == 3 for k in keys) and "CartesianProduct" not in plan


def phrases(rows, least, top, most, within=50):
    c, n = Counter(), Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            c.update((lang, tuple(w[i : i + k])) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    cand = {k: v for k, v in c.items() if len(k[1]) > 1 and v >= least}
    dropped = {(lang, w[i : i + k]) for (lang, w), v in cand.items() for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * v >= within * c[lang, w[i : i + k]]}
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in dropped:
            score, _, left, right = min((1000000 * a * a // (c[lang, w[:k]] * c[lang, w[k:]]), k, c[lang, w[:k]], c[lang, w[k:]]) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, v in out.items() for i, x in enumerate(sorted(v)[:top]))


def phrase_rows(seed=2, n=300):
    r = random.Random(seed)
    words = ["a", "B", "b", "ab", "é", "ü-x", " ", "aa", "A\x00", "ba"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " !? ", " \t "]
    rows = [("".join(r.choice(words) + r.choice(marks) for _ in range(r.randint(0, 40))), r.choice(["en", "en", "en", None, "und", "de", ""])) for _ in range(n)]
    return rows + [(None, "en"), ("", None), (" .,", "fr"), ("Good morning " * 3000, "en"), ("x y", "rare")] + [("same words again", "en")] * 50


@pytest.mark.parametrize("most,hot_bits,top", [(3, 28, 2000), (3, 16, 7), (2, 28, 2000), (4, 16, 50)])
def test_phrases_equal_plain_counting(spark, most, hot_bits, top):
    rows = phrase_rows()
    df = spark.createDataFrame([(t, g, 1, "w") for t, g in rows], "text string, lang string, n int, words string").repartition(5)
    got = C.collocations(df, max_words=most, top=top, hot_bits=hot_bits)
    assert got.columns == "lang rank phrase a l r n score".split()
    assert sorted(map(tuple, got.collect())) == phrases(rows, C.LEAST, top, most)


def test_phrases_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert C.collocations(empty).count() == 0
    assert C.collocations(spark.createDataFrame([(None, None), ("a b", "en")], "text string, lang string")).count() == 0
    with pytest.raises(ValueError):
        C.collocations(empty, max_words=1)


def test_many_false_candidates_and_steps_too_long_for_their_type_change_nothing(spark, monkeypatch):
    rows = phrase_rows(5, 60)
    df = spark.createDataFrame(rows, "text string, lang string")
    texts = C._texts(df, "text", "lang")
    few = C.hot_cells(texts, 34, 10, 3, 16)  # cells far apart: many empty steps; a block's bits folded onto each other
    assert few.any() and len(few) == 1 << C.MOST_BLOCK_BITS - 5
    want = {(g, tuple(p.split(" "))): a for g, _, p, a, *_ in phrases(rows, 10, 10**6, 3, 10**9)}
    got = {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in C.phrase_counts(df).where("words > 1").collect()}
    assert got == want


def test_phrases_of_one_hash_are_told_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C.tb, "mix", lambda x: x & np.uint64(3))
    found = {p: n for _, k, ps, ns in C.shard_counts(pa.array(["a b c d e f", "b c d"]), ["en", "en"], lambda h: np.ones(len(h), bool), 2) if k for p, n in zip(ps, ns.tolist(), strict=True)}
    assert found == {b"a": 1, b"b": 2, b"c": 2, b"d": 2, b"e": 1, b"f": 1, b"a b": 1, b"b c": 2, b"c d": 2, b"d e": 1, b"e f": 1}


def ogg_page(flags, body):
    head = b"OggS\0" + bytes([flags]) + bytes(8) + struct.pack("<II", 5, 0) + bytes(4) + bytes([1, len(body)])
    crc = 0
    for x in head + body:
        for k in range(7, -1, -1):
            crc = (crc << 1 ^ (0x04C11DB7 if (crc >> 31 ^ x >> k) & 1 else 0)) & 0xFFFFFFFF
    return head[:22] + struct.pack("<I", crc) + head[26:] + body


def samples():
    payload = bytes(range(192)) * 2
    made = {M.MIME[k]: write(payload) for k, (write, _) in M.CODECS.items()}
    made["image/gif"] = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + bytes(6) + b"!\xf9\x04" + bytes(4) + b"\0" + b"," + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02D\x01\0;"
    made["image/jpeg"] = b"\xff\xd8\xff\xc0\x00\x0b\x08\x00\x01\x00\x01\x01\x01\x11\x00\xff\xda\x00\x08\x01\x01\x00\x00\x3f\x00ab\xff\x00c\xff\xd0d\xff\xd9"
    made["application/ogg"] = ogg_page(2, b"head") + ogg_page(0, b"body") + ogg_page(4, b"end")
    made["video/mp4"] = struct.pack(">I4s", 16, b"ftyp") + b"isom" + bytes(4) + struct.pack(">I4s", 8, b"moov") + struct.pack(">I4s", 12, b"mdat") + b"data"
    made["image/webp"] = b"RIFF" + struct.pack("<I", 4 + 8 + 4) + b"WEBPVP8L" + struct.pack("<I", 4) + b"abcd"
    return made


def test_signatures_and_structure_decide(spark):
    made = samples()
    for mime, body in made.items():
        assert [(M.MIME[k], a, n) for k, a, n in M.located(body)[0]][:1] == [(mime, 0, len(body))]
        assert not M.located(body[:-1])[0], f"{mime} cut short"
        junk = b"BM GIF89a RIFF .snd \xff\xd8\xff OggS ftyp " + b"x" * 70
        assert [(M.MIME[k], a, n) for k, a, n in M.located(junk + body + junk)[0]] == [(mime, len(junk), len(body))]
    flipped = bytearray(made["image/png"])
    flipped[60] ^= 1
    broken = made["application/ogg"].replace(b"body", b"bodY")
    assert not M.located(bytes(flipped))[0] and not M.located(broken)[0]


def test_types_are_corrected_and_media_carved(spark):
    made = samples()
    outer = M._bmp_of((made["image/gif"] + b"--" + made["application/ogg"]).ljust(384, b" "))
    rows = [(1, made["image/png"], "image/gif", "x"), (2, outer, "image/bmp", "x"), (3, b"text", "image/png", "x"), (4, None, "image/png", "x"), (5, b"", None, "x"), (6, b"#" + made["audio/x-wav"], "audio/x-wav", "x")]
    df = spark.createDataFrame(rows, "id int, body binary, declared string, media_type string")
    got = M.sniff(df, "body", "declared")
    assert got.columns == [*df.columns, "media_type_", "media_length", "magic_hits", "embedded", "declared_right"]
    by = {r["id"]: r for r in got.collect()}
    assert [(by[i]["media_type_"], by[i]["declared_right"]) for i in range(1, 7)] == [("image/png", False), ("image/bmp", True), (M.UNKNOWN, False), (None, None), (M.UNKNOWN, None), (M.UNKNOWN, False)]
    carved = sorted((r["key"], r["type"], bytes(r["body"])) for r in M.carve(got, "id", "body").collect())
    assert carved == [(2, "application/ogg", made["application/ogg"]), (2, "image/gif", made["image/gif"]), (6, "audio/x-wav", made["audio/x-wav"])]


def test_payloads_come_back_and_equal_texts_are_equal(spark):
    texts = [None, "", "a", "x" * 191, "x" * 192, "x" * 193, "BM" * 500, "GIF89a;", "é\x00\U0001f600" * 77, "long " * 100_000, "a", *(f"t{i}" for i in range(40))]
    df = spark.createDataFrame([(i, t, "m") for i, t in enumerate(texts)], "doc_id long, text string, media string")
    stored = M.store_media(df)
    got = {r["doc_id"]: r for r in M.media_features(stored).collect()}
    assert len(got) == len(texts)
    seen = set()
    for r in stored.collect():
        text = (texts[r["doc_id"]] or "").encode()
        payload = text + b" " * (-len(text) % 192 if text else 192)
        body, f = bytes(r["media"]), got[r["doc_id"]]
        assert (f["n_bytes"], f["payload_bytes"], f["payload_sha256"], f["tail_crc32"]) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (f["media_bytes"], f["media_sha256"]) == (len(body), hashlib.sha256(body).hexdigest())
        seen.add(f["feature"].split(";")[0])
        if body[:4] == b"RIFF":
            with wave.open(io.BytesIO(body)) as w:
                assert (w.getsampwidth(), w.getnchannels()) == (1, 1) and w.readframes(w.getnframes()) == payload
    assert seen == {M.MIME[k] for k in M.CODECS}
    assert tuple(got[0])[1:] == tuple(got[1])[1:] and tuple(got[2])[1:] == tuple(got[10])[1:]
    assert M.media_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
