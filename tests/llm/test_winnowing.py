"""Winnowing over code points beside brute force."""

import random
import string

import brute
from pyspark.sql import functions as F

from geopulse.llm import winnowing


def test_winnowing_is_of_code_points(spark, given_rows):
    draw = random.Random(3)
    texts = [r["text"] for r in given_rows.values()][:40] + [None, "", " \t", "x", "a" * 15, "a b" * 8, "漢字😀" * 30, "".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(999))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in rows.select("i", winnowing.fingerprint(F.col("text")).alias("m")).collect():
        assert [(m["hash"] & (1 << 64) - 1, m["place"]) for m in r["m"]] == brute.winnow(texts[r["i"]])


def test_winnowing_shift_and_short_halves(spark):
    """One character inserted before a run leaves its marks; half of a short text is recognised."""
    draw = random.Random(5)
    run = "".join(draw.choice(string.ascii_letters) for _ in range(5000))
    halves = [" ".join("".join(draw.choice(string.ascii_lowercase) for _ in range(5)) for _ in range(10)) for _ in range(20)]
    pairs = [(run, "é" + run)] + [(h, h[:30] + halves[i - 1][30:]) for i, h in enumerate(halves)]
    rows = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in rows.select(winnowing.likeness(winnowing.fingerprint(F.col("a")), winnowing.fingerprint(F.col("b")))).collect()]
    assert max(got) > 0.99 and min(got) > 0


def test_spliced_fingerprints(spark):
    """The fingerprint of two beginnings put together, at every place of the seam, with ties, is that of the whole."""
    draw = random.Random(9)
    letters = ["ab", string.ascii_lowercase, "漢字😀 \t"]
    rows = []
    for n in [0, 1, 2, 7, 8, 14, 15, 16, 17, 22, 23, 24, 30, 45, 46, 47, 80, 200]:
        for kind in letters:
            one, two = ("".join(draw.choice(kind) for _ in range(n + draw.choice([0, 40]))) for _ in range(2))
            for m in {0, 1, n // 2, n}:
                rows.append((one, one[:m], two, two[: n - m]))
    solid, marks = winnowing.solid, winnowing.fingerprint
    found = spark.createDataFrame(rows, "a string, head string, b string, tail string").select(
        "head", "tail", winnowing.spliced(marks(F.col("a")), solid(F.col("head")), marks(F.col("b")), solid(F.col("tail"))).alias("m")
    )
    for r in found.collect():
        assert [(m["hash"] & (1 << 64) - 1, m["place"]) for m in r["m"]] == brute.winnow(r["head"] + r["tail"])


def test_next_of_an_id_with_many_rows(spark):
    """An id, or none, with most of the rows is cut into buckets; every row still sees the next one, the last the first."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " * (i % 5)) for i in range(600)]
    found = winnowing.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 600
    follows = {}
    for r in found:
        follows.setdefault((r["doc_id"], r["text"]), []).append(r["next_text"])
    ids = sorted({r[0] for r in rows if r[0] is not None})
    singles = [i for i in ids if i > 7]
    for i, j in zip(singles, singles[1:]):
        assert follows[(i, f"text {i} " * (i % 5))] == [f"text {j} " * (j % 5)]
    # Around the circle every text follows as often as it stands.
    assert sorted(r["next_text"] for r in found) == sorted(r[1] for r in rows)
