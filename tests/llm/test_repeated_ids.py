"""A language whose learning rows share an id."""

from pyspark.sql import functions as F

from geopulse.llm import langid


def test_language_of_one_repeated_id_is_learned(spark):
    top = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 31))
    far = spark.range(200).where(top > int(0.9 * (1 << 31))).first()[0]
    many = spark.range(400).select(F.lit(far).alias("doc_id"), F.concat(F.lit("der hund sah den mond "), F.col("id")).alias("text"), F.lit("de").alias("lang"))
    few = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("the cat sat on a mat "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    assert set(langid.fit(many.unionByName(few), per_language=10).languages) == {"de", "en"}
