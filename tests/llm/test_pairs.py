"""SimHash near-duplicates, lines and substrings beside brute force."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import Row

from geopulse.llm import lines, simhash, substrings
from geopulse.llm.common import components
from geopulse.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_simhash_query(spark, given_rows):
    bits = {d: brute.simhash(r["text"]) for d, r in given_rows.items()}
    root = brute.smallest_linked(list(bits), lambda a, b: (bits[a] ^ bits[b]).bit_count() <= 3)
    got = {tuple(r) for r in QUERIES["op1_simhash"](spark, SF).collect()}
    assert got == {(d, f"{bits[d]:016x}", root[d]) for d in bits}


def test_simhash_awkward(awkward, empty):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(awkward).collect()}
    assert simhash.near_duplicates(awkward).count() == awkward.count()
    assert got[4]["bits"] == got[5]["bits"] == got[6]["bits"] == 0
    assert {got[d]["component_id"] for d in (4, 5, 6)} == {4} and got[2]["component_id"] == 1
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("limit", [simhash.CELL_LIMIT, 8])
def test_planted_fingerprints_link_in_full_cells_too(spark, limit):
    """Chains of fingerprints three bits apart, many in one cell."""
    draw = random.Random(5)
    marks = [draw.getrandbits(64) for _ in range(40)]
    for base in marks[:6]:
        for _ in range(30):
            for bit in draw.sample(range(64), 3):
                base ^= 1 << bit
            marks.append(base)
    marks += [7 ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    signed = sorted({int(np.uint64(m).view(np.int64)) for m in marks})
    rows = spark.createDataFrame([(m,) for m in signed], "bits long")
    want = brute.smallest_linked(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    found = {r["node"]: r["root"] for r in components(simhash.links(rows, limit=limit)).collect()}
    assert {m: found.get(m, m) for m in signed} == want


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 300, 2)] + [(i + 1, i + 2) for i in range(0, 300, 2)], "a long, b long")
    assert {r["root"] for r in components(chain).collect()} == {0}
    assert components(chain.where("a < 0")).count() == 0


def test_edit_distances():
    draw = random.Random(2)
    for most in (1, 2, 3):
        pairs = []
        for _ in range(1500):
            a = "".join(draw.choice("abc") for _ in range(draw.randint(0, 14)))
            b = list(a)
            for _ in range(draw.randint(0, 5)):
                i = draw.randint(0, len(b))
                b[i : i + draw.randint(0, 1)] = draw.choice(["", "a", "b", "c"])
            pairs.append((a, "".join(b)))
        assert lines.edit_distances(pairs, most).tolist() == [min(brute.edits(a, b), most + 1) for a, b in pairs]


def _line_truth(docs, edits, least):
    place = {}
    for d in sorted(docs):
        for i, line in enumerate(docs[d].split("\n")):
            place.setdefault(line, []).append((d, i))
    most = lambda a, b: min(edits, min(len(a), len(b)) * edits // least)
    linked = lambda a, b: 0 < most(a, b) >= abs(len(a) - len(b)) and brute.edits(a, b) <= most(a, b)
    order = sorted(place, key=lambda x: place[x][0])
    name = {line: place[line][0] for line in order}
    root = brute.smallest_linked([name[x] for x in order], lambda a, b: linked(back[a], back[b])) if not (back := {v: k for k, v in name.items()}) is None else {}
    links = {x: sum(x != y and linked(x, y) for y in order) for x in order}
    return {(d, i, len(x), links[x], *root[name[x]]) for x, spots in place.items() for d, i in spots}


@pytest.mark.parametrize("limit", [lines.BUCKET_ROWS, 20])
def test_lines_with_planted_edits(spark, monkeypatch, limit):
    draw = random.Random(9)
    monkeypatch.setattr(lines, "BUCKET_ROWS", limit)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7)))
    base = [" ".join(word() for _ in range(draw.randint(3, 9))) for _ in range(25)] + ["short", "", "shorter"]
    docs = {}
    for d in range(60):
        own = []
        for _ in range(4):
            line = list(draw.choice(base))
            for _ in range(draw.randint(0, 3)):
                i = draw.randint(0, len(line))
                line[i : i + draw.randint(0, 1)] = draw.choice(["", "z", "é", "😀"])
            own.append("".join(line))
        docs[d] = "\n".join(own)
    rows = spark.createDataFrame([Row(doc_id=d, text=t) for d, t in docs.items()])
    if limit == 20:
        pairs = lines.candidates(rows, edits=2, least=20, id_col="doc_id", text_col="text", limit=20, block=8)
        usual = lines.candidates(rows, edits=2, least=20, id_col="doc_id", text_col="text")
        assert {tuple(r) for r in pairs.collect()} == {tuple(r) for r in usual.collect()}
        return
    got = {tuple(r) for r in lines.classes(rows).collect()}
    assert got == _line_truth(docs, 2, 20) and any(r[3] for r in got)


def test_lines_query(spark, given_rows):
    got = QUERIES["op4_lines"](spark, SF).collect()
    assert len(got) == sum(len(r["text"].split("\n")) for r in given_rows.values() if r["text"] is not None)
    first = {}
    for r in sorted(got):
        line = given_rows[r["doc_id"]]["text"].split("\n")[r["line_no"]]
        first.setdefault(line, (r["doc_id"], r["line_no"]))
        if not r["links"]:
            assert (r["class_doc_id"], r["class_line_no"]) == first[line]


def test_lines_awkward(awkward, empty):
    kept = {r["doc_id"]: r["text"] for r in lines.deduplicate(awkward).collect()}
    assert lines.deduplicate(awkward).columns == awkward.columns and lines.deduplicate(awkward).count() == awkward.count()
    assert kept[1] and kept[2] == "" and kept[3] == "" and kept[4] is None and kept[5] == "" and kept[7] == "wort"
    assert lines.classes(empty).count() == 0 and lines.deduplicate(empty).count() == 0


def test_substrings_query(spark, given_rows):
    want = brute.substrings({d: r["text"] for d, r in given_rows.items()})
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op6_substrings"](spark, SF).collect()} == want


@pytest.mark.parametrize("limit", [substrings.BUCKET_BYTES, 200])
def test_substrings_planted_and_cut_again(spark, limit):
    draw = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(40))
    docs = {0: passage, 1: "", 2: None, 3: "a " * 60, 4: "a " * 30}
    for d in range(5, 60):
        own = [f"w{draw.randint(0, 3)}" for _ in range(draw.randint(0, 60))]
        docs[d] = " ".join(own[:20]) + ("\t" + passage if d % 3 == 0 else "") + " " + " ".join(own[20:])
    rows = spark.createDataFrame([Row(doc_id=d, text=t) for d, t in docs.items()], "doc_id long, text string").repartition(4)
    ranges = substrings.ranges(rows, bucket_bytes=limit).groupBy("doc_id").agg({"start": "count"}).collect()
    want = brute.substrings(docs)
    assert {r[0] for r in ranges} == {d for d, v in want.items() if v[1]}
    if limit > 200:
        got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substrings.deduplicate(rows).collect()}
        assert got == {d: v[:2] for d, v in want.items()}


def test_substrings_awkward(awkward, empty):
    got = {r["doc_id"]: r for r in substrings.deduplicate(awkward).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] == 15 and got[4]["n_words"] == 0 and got[12]["n_removed"] == 0
    assert substrings.deduplicate(awkward).count() == awkward.count() and substrings.deduplicate(empty).count() == 0


def test_substrings_sql_says_the_same(spark):
    from compare import connect, differences, duck_side, spark_side

    assert set(ORACLE_SQL) <= set(QUERIES)
    assert not differences(spark_side(QUERIES["op6_substrings"](spark, SF)), duck_side(connect(SF), ORACLE_SQL["op6_substrings"]))
