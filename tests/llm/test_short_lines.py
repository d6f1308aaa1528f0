"""Repeats of lines too short for edit distance."""

from pyspark.sql import Row

from geopulse.llm import lines


def test_repeats_of_short_lines_go(spark):
    texts = {1: "Les.\n\nAnd ornd.\n  ", 2: "Les.\n\n  \nLet.\nAnd ornd.", 3: "Les.\nLes.", 4: None}
    rows = spark.createDataFrame([Row(doc_id=d, text=t) for d, t in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.deduplicate(rows).collect()}
    assert got == {1: "Les.\n\nAnd ornd.\n  ", 2: "\n  \nLet.", 3: "", 4: None}
