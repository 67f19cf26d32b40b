"""Secret scan: fixed patterns plus sliding-window Shannon entropy.

Base kinds are leftmost, non-overlapping matches of three patterns. On top of them, candidate strings (long
runs of one character class) are scanned with a window whose entropy is kept by incremental counts; windows
above the class's threshold are joined to spans, unless an allow-list rule names the candidate harmless. A harmless
word silences its token between separators, not the rest of the candidate.

Everything happens per text in one pass over Arrow batches, so there is no shuffle. RE2 (through Arrow) finds
the few texts that can match at all; only those reach Python's `re`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.shared import bounded_batches

# The base patterns, their least lengths, and the kinds in output order.
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
BASE_KINDS = ("assign", "access", "hex")
ENTROPY_KINDS = ("entropy_hex", "entropy_base64")
KINDS = BASE_KINDS + ENTROPY_KINDS

# Character classes of candidates with the entropy (bits per character) a window must reach.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
LEAST_ENTROPY = {"entropy_hex": 3.2, "entropy_base64": 3.7}

# Candidates that match one of these are harmless.
ALLOWED = tuple(
    re.compile(p)
    for p in (
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUID
        r"[0-9_=+/-]*",  # numbers, dates and rules
        r".*(0123456789|1234567890|abcdefghij|ABCDEFGHIJ).*",  # alphabets
        r"(.{1,8}?)\1+.{0,7}",  # a repeated unit
    )
)

# Words of two letters in names of mixed case.
SHORT_WORDS = ("am", "an", "as", "at", "be", "by", "db", "do", "go", "he", "id", "if", "in", "io", "ip", "is", "it", "js", "me", "my", "no", "of", "ok", "on", "or", "os", "so", "to", "ui", "up", "us", "we")

#: A word of a name in mixed case: three letters and more (or a short word), the first of which may be a capital, or an acronym.
WORD = r"(?:[A-Z][a-z]{2,}+|[a-z]{3,}+|(?:%s)(?![a-z])|[A-Z]{1,5}(?=[A-Z][a-z]|\Z))" % "|".join(f"[{x[0].upper()}{x[0]}]{x[1]}" for x in SHORT_WORDS)
#: A name as people write it is in one case throughout, or of such words, with so many letters a word at the least;
#: letters of random case are none. Nothing is tried twice, so long texts cost their length.
NAME, ONE_CASE, EACH_WORD, LETTERS_A_WORD = re.compile(f"{WORD}++"), re.compile("[a-z]+|[A-Z]+"), re.compile(WORD), 3.5
NUMBERED = re.compile(r"([A-Za-z]+)[0-9]{1,4}")
SHORT_NUMBER = re.compile(r"[0-9]{1,4}")
SEPARATORS = re.compile(r"[_/=+-]+")

# The token (between separators) that holds one of these words is harmless, and what surrounds it is not.
WORDS = re.compile(r"(?i)example|placeholder|dummy|sample|changeme|your")
TOKEN = re.compile(r"[A-Za-z0-9]+")

_SCREENS = (
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo]?[Rr]?[Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]""",
    r"AKIA[A-Z0-9]",
    r"[0-9a-f]{16}",
    r"[A-Za-z0-9+/_=-]{20}",
)

SPANS = "array<struct<kind:string,start:int,end:int,text:string>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))


def _surprise(c: int) -> float:
    return c * math.log2(c) if c > 1 else 0.0


def entropy_windows(text: str, width: int, least: float) -> Iterator[tuple[int, int]]:
    """Joined ranges of the windows of `width` characters whose Shannon entropy is at least `least` bits.

    The sum of c*log2(c) over the window's counts is updated for the one character that leaves and the one
    that enters, so a text costs its length, whatever the width.
    """
    counts: dict[str, int] = {}
    total, lo, hi = 0.0, -1, -1
    full = math.log2(width)
    for i, x in enumerate(text):
        c = counts.get(x, 0)
        total += _surprise(c + 1) - _surprise(c)
        counts[x] = c + 1
        if i >= width:
            y = text[i - width]
            c = counts[y]
            total += _surprise(c - 1) - _surprise(c)
            counts[y] = c - 1
        if i >= width - 1 and full - total / width >= least - 1e-9:
            start = i - width + 1
            if hi < start:
                if hi > 0:
                    yield lo, hi
                lo = start
            hi = i + 1
    if hi > 0:
        yield lo, hi


def is_name(letters: str) -> bool:
    """Whether letters are a name in one case, or one whose capitals begin words."""
    if ONE_CASE.fullmatch(letters):
        return True
    return NAME.fullmatch(letters) is not None and len(letters) >= LETTERS_A_WORD * len(EACH_WORD.findall(letters))


def harmless(candidate: str) -> bool:
    """Whether a rule allows a candidate: paths, slugs and identifiers made of names, one name with a number, and ALLOWED."""
    if any(p.fullmatch(candidate) for p in ALLOWED):
        return True
    pieces = [x for x in SEPARATORS.split(candidate) if x]
    if len(pieces) == 1 and (m := NUMBERED.fullmatch(candidate)):
        return is_name(m.group(1))
    return all(is_name(x) or (len(pieces) > 1 and SHORT_NUMBER.fullmatch(x)) for x in pieces)


def scan_text(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, in code points, sorted by start and kind."""
    base = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    base += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    base += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST] if _has_hex(text) else []
    found = list(base)
    for m in CANDIDATE.finditer(text):
        s = m.group()
        if harmless(s):
            continue
        kind = "entropy_hex" if re.fullmatch(r"[0-9a-fA-F]+", s) else "entropy_base64"
        for lo, hi in _beside_words(s):
            part = s[lo:hi]
            if part != s and harmless(part):
                continue
            for a, b in entropy_windows(part, WINDOW, LEAST_ENTROPY[kind]):
                a, b = a + lo + m.start(), b + lo + m.start()
                if not any(x <= a and b <= y for _, x, y in base):
                    found.append((kind, a, b))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _beside_words(s: str) -> Iterator[tuple[int, int]]:
    """Ranges of a candidate between its harmless tokens."""
    at = 0
    for m in TOKEN.finditer(s):
        if WORDS.search(m.group()):
            yield at, m.start()
            at = m.end()
    yield at, len(s)


_HEX_SCREEN = re.compile(r"[0-9a-f]{16}")


def _has_hex(text: str) -> bool:
    return _HEX_SCREEN.search(text) is not None


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) for every row of docs; spans: kind, start, end (code points, end exclusive) and the text.

    A null text counts as empty and has no spans; repeated rows each give a row; other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).fill_null("")
            mask = None
            for p in _SCREENS:
                hit = pc.match_substring_regex(texts, p)
                mask = hit if mask is None else pc.or_(mask, hit)
            spans: list[list[dict]] = [[] for _ in range(len(texts))]
            for i in pc.indices_nonzero(mask).to_pylist():
                t = texts[i].as_py()
                spans[i] = [{"kind": k, "start": s, "end": e, "text": t[s:e]} for k, s, e in scan_text(t)]
            yield pa.record_batch([b.column(0), pa.array(spans, _SPAN_TYPE)], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return bounded_batches(rows).mapInArrow(scan, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)


def span_list(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """The spans of :func:`find_secrets` as counts, a digest of the base spans, and text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return find_secrets(docs).select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
