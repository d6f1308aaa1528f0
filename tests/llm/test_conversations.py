"""Conversation repair and prefix trie beside brute force."""

import random

import plain
import pytest
from pyspark.sql import Row

from geopulse.llm import prefixes, queries, repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, fact int, own boolean, words long, ids string, copy int, dropped boolean, kind int, node string"


def _rows(n=60, seed=7):
    """Nulls anywhere, equal turns, repeated rows, unknown roles, signs and white space only, long texts, negative ids."""
    draw = random.Random(seed)
    texts = ["Hi.", "Hi.", "what", "", " \t\n", None, "Really?!  ", "漢字。", "so it goes. \x0b", "x " * 30_000 + "!", "no end " * 20_000]
    out = []
    for conv in [None, -3, -20, *range(n)]:
        for i in range(draw.choice([1, 2, 3, 5, 9])):
            turn = draw.choice([i, i, i, i + 1, None, 3])
            out.append((conv, turn, draw.choice(["system", "user", "assistant", "user", "assistant", None, "", "tool", "User"]), draw.choice(texts)))
    return out + out[:20]


@pytest.fixture(scope="module")
def spoilt(spark, tmp_path_factory):
    rows = _rows()
    path = str(tmp_path_factory.mktemp("conversations"))
    made = [Row(*r, 1, None, 2, "z", 3, True, 0, None) for r in rows]
    spark.createDataFrame(made, SCHEMA).repartition(5).write.parquet(f"{path}/conversations.parquet")
    return path, rows


def _given(spark, path):
    return [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]


def _check_repair(spark, path):
    want = {c: plain.repair(own) for c, own in plain.damaged(_given(spark, path)).items()}
    got = {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in queries.op11_repair(spark, path).collect()}
    assert got == want


def _check_trie(spark, path):
    found = queries.op12_prefixes(spark, path).collect()
    got = sorted((tuple(r[c] for c in plain.NODE) for r in found), key=lambda r: (r[1], r[0]))
    assert got == plain.trie(plain.rebuilt(_given(spark, path)))


def test_repair_query(spark):
    _check_repair(spark, SF)


def test_repair_awkward(spark, spoilt):
    _check_repair(spark, spoilt[0])


def test_trie_query(spark):
    _check_trie(spark, SF)


def test_trie_awkward(spark, spoilt):
    _check_trie(spark, spoilt[0])


def test_empty_tables(spark, spoilt):
    none = spark.read.parquet(f"{spoilt[0]}/conversations.parquet").where("conv_id > 1000")
    assert repair.scripts(repair.ordered(none)).count() == 0
    assert prefixes.trie(prefixes.sequences(prefixes.turns(none))).count() == 0


def test_scripts_are_cheapest_and_least():
    """Random conversations, some over several segments, beside Dijkstra on whole scripts."""
    draw = random.Random(3)
    for n in [0, 1, 2, 3, 5, 8, 13, 40, 63, 64, 65, 128, 129, 200] * 8:
        kinds = draw.choice(["sua", "ua", "uaaa", "suat ", "t"])
        own = [(i, draw.choice(kinds), draw.choice(["", f"{i}.", f"{i}.", f"{i}", "again."])) for i in range(n)]
        code = {"s": 1, "u": 2, "a": 3}
        fault = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
        facts = bytes(4 * code.get(role, 0) + fault[f] for (_, role, _), f in zip(own, plain.faults(own), strict=True))
        assert repair.script(facts) == plain.cheapest(own)


def test_repaired_rows(spark, spoilt):
    """The rows themselves, in order, with what became of each."""
    rows = repair.ordered(spark.read.parquet(f"{spoilt[0]}/conversations.parquet"))
    got = {}
    for r in sorted(repair.repaired(rows, repair.scripts(rows)).collect(), key=lambda r: r["place"]):
        got.setdefault(r["conv_id"], []).append((r["edit"], r["role"], r["text"]))
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in spoilt[1]]
    want = {c: plain.repaired(own, plain.cheapest(own)[1]) for c, own in plain.by_conversation(clean).items()}
    assert got == {c: x for c, x in want.items() if x}


def _sequences(spark, found):
    rows = [Row(conv_id=c, turn=i, role=r, text=t) for c, turns in found.items() for i, (r, t) in enumerate(turns)]
    return prefixes.sequences(prefixes.turns(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")))


@pytest.mark.parametrize("shard", [3, 17, 1000])
def test_trie_over_shards(spark, shard):
    """Hot beginnings, a conversation copied to a third of all and one far longer than a matrix, cut into shards of few turns."""
    draw = random.Random(shard)
    copied = [("user", "same words here"), ("assistant", "yes. yes")]
    found = {c: copied for c in range(0, 90, 3)}
    for c in range(1, 90, 3):
        found[c] = copied[: draw.randint(0, 2)] + [(draw.choice("ua"), draw.choice("abc")) for _ in range(draw.randint(1, 5))]
    found[2] = [("user", str(i % 3)) for i in range(70)]
    found[5] = found[2][:50] + [("user", "other")]
    found[8] = found[2][:32]
    nodes = prefixes.trie(_sequences(spark, found), shard_turns=shard, least_turns=shard).collect()
    assert sorted((tuple(r[c] for c in plain.NODE) for r in nodes), key=lambda r: (r[1], r[0])) == plain.trie(found)
