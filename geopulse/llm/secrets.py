"""Secrets in texts: known shapes, and strings that a battery of randomness tests cannot tell from random ones.

Known shapes are regular expressions. Other candidates are runs of code characters whose encoding is inferred from
the characters used (hex, base32, base36, base62, base64, letters). Over the symbols of that alphabet three tests
take "uniformly random" as their hypothesis: chi-squared uniformity, runs above and below the middle, and serial
correlation; Fisher's method combines them. Within a text, a weighted Benjamini-Hochberg step (weights grow with
length, as power does) rejects the hypothesis for structured strings at a false-discovery rate, the share of truly
random strings among those dismissed. A candidate is tested only if it is long enough for prose in its alphabet to be
recognised with the stated power; what then stays unrejected is reported, unless a known shape covers it.

Null and empty texts have no spans. Positions are code points, ends exclusive. Equal rows give equal results.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import texts

# The known shapes and the least length of each.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of [0-9a-f]+ that are long enough
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

KINDS = ("assign", "access", "hex", "random")
#: A sign of equality only ends a candidate, so the value of NAME=VALUE is one of its own.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets from narrow to wide; the first that holds every symbol is the inferred encoding.
ALPHABETS = {
    "hex": (_DIGITS + "abcdef", _DIGITS + "ABCDEF"),
    "base32": (_UPPER + "234567", _LOWER + "234567"),
    "base36": (_DIGITS + _LOWER, _DIGITS + _UPPER),
    "base62": (_DIGITS + _UPPER + _LOWER,),
    "base64": (_UPPER + _LOWER + _DIGITS + "+/", _UPPER + _LOWER + _DIGITS + "-_"),
}
LETTERS = (_LOWER, _UPPER)
#: Sum of squared letter frequencies of prose; sets how far prose lies from uniform in an alphabet.
PROSE = 0.0667
POWER_Z, SIZE_Z = 2.33, 1.64


def known(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the known shapes, ordered by start, then kind."""
    out = []
    raw = text.encode("utf-8", "surrogatepass").lower()
    if any(word in raw for word in _ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def infer(token: str) -> str | None:
    """The symbols of the narrowest alphabet that fits; None where digits and letters do not mix."""
    body = token.rstrip("=")
    symbols = set(body)
    if not symbols - set(_DIGITS):
        return None  # plain numbers
    if not symbols & set(_DIGITS):
        return next((a for a in LETTERS if symbols <= set(a)), None)
    if not symbols & set(_LOWER + _UPPER):
        return None
    return next((a for tries in ALPHABETS.values() for a in tries if symbols <= set(a)), None)


def least_length(size: int) -> int:
    """Symbols needed before the uniformity test recognises prose written in an alphabet of this size."""
    apart = size * PROSE - 1
    if apart <= 0:
        apart = PROSE * 16 - 1
    return max(20, math.ceil((SIZE_Z + POWER_Z) * math.sqrt(2 * (size - 1)) / max(apart, 0.7)))


def battery(token: str, alphabet: str) -> float:
    """Combined p-value of the three tests of uniform randomness."""
    place = {c: i for i, c in enumerate(alphabet)}
    x = [place[c] for c in token.rstrip("=")]
    n, k = len(x), len(alphabet)
    counts: dict[int, int] = {}
    for v in x:
        counts[v] = counts.get(v, 0) + 1
    # Uniformity: the sum of squares has mean k - 1 and variance 2 (k - 1)(n - 1)/n, also where cells are sparse.
    chi = k / n * sum(c * c for c in counts.values()) - n
    mean, var = k - 1, 2 * (k - 1) * (n - 1) / n
    shape = 2 * mean * mean / var
    z = ((max(chi, 0.0) / mean) ** (1 / 3) - (1 - 2 / (9 * shape))) / math.sqrt(2 / (9 * shape))
    p_chi = 0.5 * math.erfc(z / math.sqrt(2))
    high = [2 * v >= k for v in x]
    up = sum(high)
    down, runs = n - up, 1 + sum(a != b for a, b in zip(high, high[1:]))
    if up and down:
        expect = 1 + 2 * up * down / n
        spread = (expect - 1) * (expect - 2) / (n - 1)
        p_runs = _two_sided((runs - expect) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    middle = sum(x) / n
    energy = sum((v - middle) ** 2 for v in x)
    if energy:
        r = sum((a - middle) * (b - middle) for a, b in zip(x, x[1:])) / energy
        p_serial = _two_sided((r + 1 / n) * math.sqrt(n))
    else:
        p_serial = 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))  # Fisher, six degrees of freedom
    return math.exp(-half) * (1 + half + half * half / 2)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def dismissed(tests: list[tuple[int, float]], rate: float) -> list[bool]:
    """Weighted Benjamini-Hochberg: which ``(length, p)`` are rejected as structured."""
    if not tests:
        return []
    total = sum(math.sqrt(n) for n, _ in tests)
    scaled = [p * total / (len(tests) * math.sqrt(n)) for n, p in tests]
    order = sorted(range(len(tests)), key=scaled.__getitem__)
    cut = max((i for i, j in enumerate(order, 1) if scaled[j] <= rate * i / len(tests)), default=0)
    out = [False] * len(tests)
    for j in order[:cut]:
        out[j] = True
    return out


def find(text: str, rate: float = 0.05) -> list[tuple[int, int, int]]:
    """All spans ``(start, kind, end)``: the known shapes, and random strings outside them."""
    base = known(text)
    spots, tests = [], []
    for m in CANDIDATE.finditer(text):
        alphabet = infer(m[0])
        size = len(m[0].rstrip("="))
        if alphabet and size >= least_length(len(alphabet)):
            spots.append((m.start(), m.end()))
            tests.append((size, battery(m[0], alphabet)))
    extra = [s for s, out in zip(spots, dismissed(tests, rate), strict=True) if not out]
    return sorted(base + [(i, 3, j) for i, j in extra if not any(a < j and i < b for a, _, b in base)])


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every covered stretch replaced once."""
    out, at, done = [], 0, -1
    for start, _, end in spans:
        if start >= done:
            out += [text[at:start], mark]
        at = done = max(done, end)
    return "".join([*out, text[at:]]) if spans else text


def scan(docs: DataFrame, *, rate: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans array<struct<kind,start,end>>, base_sha256, n_assign, n_access, n_hex, n_random`` of every whole text."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for batch in batches:
            found = [find(x, rate) for x in texts(batch.column(1))]
            base = [hashlib.sha256(spell([s for s in spans if s[1] < 3]).encode()).hexdigest() for spans in found]
            counts = [pa.array([sum(s[1] == k for s in spans) for spans in found], pa.int64()) for k in range(4)]
            rows = [[{"kind": KINDS[k], "start": i, "end": j} for i, k, j in spans] for spans in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(span)), pa.array(base, pa.string()), *counts],
                ["doc_id", "spans", "base_sha256", "n_assign", "n_access", "n_hex", "n_random"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        "doc_id long, spans array<struct<kind:string,start:int,end:int>>, base_sha256 string,"
        " n_assign long, n_access long, n_hex long, n_random long",
    )


def redacted(docs: DataFrame, *, rate: float = 0.05, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows as they are, with every secret in the text replaced by ``mark``; null stays null."""
    names, place = docs.columns, docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            column = batch.column(place)
            out = [redact(x, find(x, rate), mark) for x in texts(column)]
            nulls = column.is_null().to_pylist()
            columns = list(batch.columns)
            columns[place] = pa.array([None if null else x for x, null in zip(out, nulls, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
