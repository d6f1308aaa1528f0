"""Language of a text by its nearest centroid, with rejection of texts far from every centroid.

A text is lower-cased, what is not a letter in ASCII counts as a space, and its byte n-grams are hashed into a fixed
number of features. Vectors are 1 + ln(count) times inverse document frequency, of length one. Every language has
several centroids from spherical k-means; the prediction is the language of the centroid of largest cosine, ties to
the first in order. A text is rejected where no centroid is nearer than the background, the direction of a text that
holds every feature equally often: noise and foreign scripts lie there at any length, prose does not.

Document frequencies are counted over all learning rows. Centroids are fitted on at most ``per_language`` texts of
each language, the ones of lowest hash of the id. Null text and text without a letter are ``und`` with score
0 and rejected, as is everything when there was nothing to learn from. Rows with a null label or id teach nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geopulse.llm.common import texts

FEATURES = 4096
GRAMS = (1, 2, 3, 4)
PER_LANGUAGE = 600
CENTROIDS = 4
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_FOLD = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]  # of each centroid
    centroids: np.ndarray  # rows of length one
    idf: np.ndarray


def count_grams(text: str, features: int = FEATURES, block: int = 1 << 22) -> np.ndarray:
    """Hashed n-gram counts of a whole text, some megabytes at a time."""
    raw = b" " + text.lower().encode("utf-8", "replace").translate(_FOLD) + b" "
    shift, total = np.uint32(32 - int(math.log2(features))), np.zeros(features, np.int64)
    for at in range(0, len(raw), block):
        data = np.frombuffer(raw[at : at + block + max(GRAMS) - 1], np.uint8).astype(np.uint32)
        gram = np.zeros(len(data), np.uint32)
        for n in range(1, max(GRAMS) + 1):
            gram = gram[: len(data) - n + 1] * np.uint32(0x01000193) + data[n - 1 :]
            starts = min(len(gram), block)
            if n in GRAMS and starts:
                mixed = (gram[:starts] ^ np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
                total += np.bincount(mixed >> shift, minlength=features)
    return total


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def cluster(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means from a farthest-first start; rows of length one in, centroids of length one out."""
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    centres = x[chosen].astype(np.float64)
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    return centres.astype(np.float32)


def fit(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS, features: int = FEATURES,
) -> Model:
    """Learn from labelled rows. The driver gets ``features`` counts and ``centroids`` vectors per language."""
    rows = docs.select(
        F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("doc_id is not null and text is not null and lang is not null")

    def frequencies(batches):
        seen, n = np.zeros(features, np.int64), 0
        for batch in batches:
            for text in texts(batch.column(0)):
                seen += count_grams(text, features) > 0
                n += 1
        if n:
            places = np.arange(-1, features, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(n, seen))], ["feature", "docs"])

    frequency = rows.select("text").mapInArrow(frequencies, "feature int, docs long")
    frequency = {r[0]: r[1] for r in frequency.groupBy("feature").agg(F.sum("docs")).collect()}
    total = frequency.get(-1, 0)
    idf = np.array([math.log((1 + total) / (1 + frequency.get(i, 0))) + 1 for i in range(features)])

    # A cutoff on the hash leaves about four times the sample of each language, so few texts travel; a row per language.
    # Rows of one id have one hash, so ids are counted, not rows.
    span = 1 << 31
    cutoffs = [(r["lang"], int(min(1.0, 4 * per_language / r["count"]) * span)) for r in rows.groupBy("lang").agg(F.count_distinct("doc_id").alias("count")).collect()]
    cutoffs = docs.sparkSession.createDataFrame(cutoffs, "lang string, cutoff long")
    some = rows.join(F.broadcast(cutoffs), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) <= F.col("cutoff"))
    turn = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(span)), "doc_id", "text")
    sample = some.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= per_language).select("doc_id", "text", "lang")

    def learn(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "text"])
        counts = np.stack([count_grams(x, features) for x in frame["text"] if _LETTER.search(x)] or [np.zeros(features, np.int64)])
        x = vectors(counts, idf)
        return pd.DataFrame({"lang": [key[0]], "centres": [cluster(x, centroids).tobytes()]})

    learned = sample.groupBy("lang").applyInPandas(learn, "lang string, centres binary").orderBy("lang").collect()
    languages, stacked = [], []
    for row in learned:
        centres = np.frombuffer(row["centres"], np.float32).reshape(-1, features)
        centres = centres[np.linalg.norm(centres, axis=1) > 0]
        languages += [row["lang"]] * len(centres)
        stacked.append(centres)
    return Model(tuple(languages), np.concatenate(stacked) if stacked else np.zeros((0, features), np.float32), idf)


def predict(model: Model, batch: list[str], block: int = 256) -> tuple[list[str], list[float], list[bool]]:
    """Language, cosine and rejection of each text."""
    lang, score, rejected = [], [], []
    for at in range(0, len(batch), block):
        part = batch[at : at + block]
        counts = np.stack([count_grams(x, len(model.idf)) for x in part])
        x = vectors(counts, model.idf)
        near = x @ model.centroids.T if len(model.languages) else np.zeros((len(part), 0))
        background = x @ (model.idf / np.linalg.norm(model.idf))
        for text, row, apart in zip(part, near, background, strict=True):
            if not len(row) or not _LETTER.search(text):
                lang.append(UNKNOWN)
                score.append(0.0)
                rejected.append(True)
                continue
            best = int(np.argmax(row))
            lang.append(model.languages[best])
            score.append(float(min(max(row[best], 0.0), 1.0)))
            rejected.append(bool(row[best] <= apart))
    return lang, score, rejected


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every whole text."""

    def run(batches):
        for batch in batches:
            lang, score, rejected = predict(model, texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows, as they are, whose text is not rejected."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            keep = [not x for x in predict(model, texts(batch.column(place)))[2]]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id") -> F.Column:
    """The fold that nothing is learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
