"""Licence scan beside brute force."""

import random

import plain
from pyspark.sql import Row

from geopulse.llm import licences, queries
from geopulse.llm.licence_texts import PHRASES, TEMPLATES

SF = "/root/testdata/sf0.001"
OWN = licences.automaton(tuple((b, a) for a, b in PHRASES.items()), TEMPLATES)


def test_licence_query(spark, given_rows):
    """Base columns of every document as brute force finds them; the method adds labels and takes none away."""
    for r in queries.op13_licences(spark, SF).collect():
        text = given_rows[r["doc_id"]]["text"]
        found = plain.phrases(text, PHRASES)
        places, base = [s for _, s, _ in found], sorted({x for x, _, _ in found})
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(plain.licence_words(text)), len(found), ",".join(base))
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert set(base) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_matching_statistics():
    """Runs that cannot grow, phrases and word counts of texts made of pieces of templates."""
    draw = random.Random(1)
    for _ in range(60):
        pieces = []
        for _ in range(draw.randint(0, 8)):
            own = plain.licence_words(draw.choice(TEMPLATES)[1])
            i = draw.randrange(len(own))
            pieces += draw.choice([own[i : i + draw.randint(1, 30)], ["foo"], list(draw.choice(list(PHRASES)).split()), ["Über", "the", "license"]])
        text = " ,\n".join(pieces)
        n, hits, anchors = licences.statistics(OWN, text.encode())
        assert n == len(plain.licence_words(text)) and hits == plain.phrases(text, PHRASES)
        assert [a[:2] for a in anchors] == plain.matching(text, TEMPLATES, licences.RUN)


def test_blocks_of_long_texts():
    """A template across the border of a block of one megabyte, and one at the end of a long text."""
    mit = dict(TEMPLATES)["mit-text"]
    for before in (1_048_000, 1_048_570, 1_050_000):
        text = "x" * 7 + " word" * (before // 5) + " " + mit + " tail" * 1000 + " Apache License"
        n, hits, spans, score = licences.find(OWN, text.encode())
        start = 1 + before // 5
        assert n == len(plain.licence_words(text)) and score == 1.0
        assert [(s[0], s[1]) for s in spans] == [("mit-text", start)] and spans[0][4] == 1.0
        assert hits == [("apache", n - 2, n)]


def test_edited_licences():
    """Licences with words changed, left out and put in are found; half of one and shuffled words are not."""
    draw = random.Random(4)
    for label, text in TEMPLATES:
        own = plain.licence_words(text)
        assert label in {s[0] for s in licences.find(OWN, " ".join(own).upper().encode())[2]}
        if len(own) < 60:
            continue
        edited = own[:]
        for at in sorted(draw.sample(range(0, len(own), 25), 3), reverse=True):
            edited[at : at + 1] = draw.choice([[], ["changed"], [own[at], "put", "in"]])
        assert label in {s[0] for s in licences.find(OWN, " ".join(edited).encode())[2]}
        draw.shuffle(own)
        assert not licences.find(OWN, " ".join(own).encode())[2]
    mit = plain.licence_words(dict(TEMPLATES)["mit-text"])
    assert not licences.find(OWN, " ".join(mit[: len(mit) // 2]).encode())[2]


def test_copies_keep_to_themselves():
    """Two damaged copies of a licence in a row are two spans."""
    own = plain.licence_words(dict(TEMPLATES)["zlib"])
    own[20] = "changed"
    found = licences.find(OWN, " ".join(own + own).encode())[2]
    assert [s[1:3] for s in found if s[0] == "zlib"] == [(0, len(own)), (len(own), 2 * len(own))]


def test_licences_awkward(spark, awkward, empty):
    found = licences.scan(awkward)
    assert found.count() == awkward.count() and licences.scan(empty).count() == 0
    assert {r["n_words"] for r in found.where("doc_id in (4, 5, 6)").collect()} == {0}
    rows = spark.createDataFrame([Row(doc_id=None, text="MIT-License, mit license"), Row(doc_id=None, text="MIT-License, mit license")], "doc_id long, text string")
    for r in licences.scan(rows).collect():
        assert [(p["label"], p["start"], p["end"]) for p in r["phrases"]] == [("mit", 0, 2), ("mit", 2, 4)]
