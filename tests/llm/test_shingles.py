"""Near documents by Jaccard index beside brute force over all pairs."""

import random

import brute
import pytest
from pyspark.sql import Row

import corpus_pipeline
from geopulse.llm import shingles

SF = "/root/testdata/sf0.001"


def _own(text):
    w = brute.words((text or "").lower())
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} if w else set()


def _root(texts):
    own = {d: _own(t) for d, t in texts.items()}
    linked = lambda a, b: not own[a] | own[b] or len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b])
    return brute.smallest_linked(list(texts), linked)


def _texts():
    """Copies with a few changed words, chains of them, and one group of many."""
    draw = random.Random(7)
    texts = {}
    for size in [60, *[3] * 12, *[1] * 15]:
        base = [f"w{draw.randint(0, 3000)}" for _ in range(draw.randint(150, 300))]
        for _ in range(size):
            texts[len(texts)] = " ".join(base)
            for _ in range(draw.randint(1, 4)):
                base[draw.randrange(len(base))] = f"x{draw.randint(0, 3000)}"
    return texts | {900: "", 901: None, 902: "two words", 903: "Two  words", 904: "two word"}


@pytest.mark.parametrize("block", [shingles.BLOCK, 16])
def test_planted_near_copies(spark, monkeypatch, block):
    texts = _texts()
    monkeypatch.setattr(shingles.links, "__kwdefaults__", shingles.links.__kwdefaults__ | {"block": block})
    rows = spark.createDataFrame([Row(doc_id=d, text=t) for d, t in texts.items()], "doc_id long, text string")
    assert {tuple(r) for r in shingles.near_duplicates(rows).collect()} == set(_root(texts).items())


def test_pipeline_stage_drops_near_copies(spark, given, given_rows):
    """Documents 177 and 145 are 0.8 near to 1 and 6, and more than three bits of the SimHash from them."""
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, given, SF).collect()}
    root = _root({d: r["text"] for d, r in given_rows.items()})
    assert kept == {d for d in root if root[d] == d} and not {177, 145} & kept
