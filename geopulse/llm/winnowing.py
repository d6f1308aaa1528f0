"""Document fingerprints by winnowing (Schleimer et al. 2003), in column expressions only.

A text is its code points without white space. Every ``GRAM`` neighbouring ones have a hash, at stride one. In every
window of ``SPAN`` hashes the least is chosen, the rightmost of equal ones; positions of the chosen stay. Two texts that
share a run of ``GRAM + SPAN - 1`` code points, at whatever places, share a chosen hash, and nothing shorter than
``GRAM`` code points is ever matched.

Null is the empty text, which has no hashes; a text of fewer than ``GRAM`` code points has one hash of them all, one of
fewer than ``SPAN`` hashes has one window. Equal texts have equal fingerprints. Likeness is the Jaccard index of the
chosen hashes, 1 for two empty sets. Nothing here runs outside the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, SPAN = 16, 8
#: Bits of a position beside the leading bits of its hash in one long; a string has fewer code points than that.
PLACE_BITS = 30
_LAST = (1 << PLACE_BITS) - 1


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _neighbours(values: Column, apart: int, join) -> Column:
    """``join`` of every value and the one ``apart`` places later."""
    left = F.size(values) - apart
    return F.zip_with(F.slice(values, F.lit(1), left), F.slice(values, F.lit(1 + apart), left), join)


def solid(text: Column) -> Column:
    """The code points of a text without white space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def _gram(points: Column, place: Column) -> Column:
    """Hash of the gram at a place of UTF-32 code points; what is shorter than a gram is hashed whole."""
    return F.xxhash64(F.substring(points, place * 4 + 1, F.lit(4 * GRAM)))


def _code(gram: Column, place: Column) -> Column:
    """The leading bits of a hash in unsigned order, less its place: the least is the rightmost of the least."""
    return gram.bitwiseXOR(F.lit(-(1 << 63))).bitwiseAND(F.lit(~_LAST)) - place


def _marks(text: Column, least: int = 1) -> Column:
    """Hashes and places chosen in a text without white space; none where it has fewer than ``least`` grams."""

    def windows(values: Column, done: int = 1) -> Column:
        if done == SPAN:
            return values
        return _let(_neighbours(values, done, lambda a, b: F.least(a, b)), lambda v: windows(v, 2 * done))

    def chosen(values: Column) -> Column:
        few = F.when(F.size(values) < least, F.expr("cast(array() as array<bigint>)")).when(F.size(values) == 0, values)
        return few.when(F.size(values) < SPAN, F.array(F.array_min(values))).otherwise(windows(values))

    def of(points: Column) -> Column:
        size = (F.octet_length(points) / 4).cast("int")
        codes = F.when(size == 0, F.expr("cast(array() as array<bigint>)")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(size - GRAM, F.lit(0))), lambda i: _code(_gram(points, i), i))
        )
        places = F.transform(F.array_distinct(_let(codes, chosen)), lambda c: F.negate(c).bitwiseAND(F.lit(_LAST)).cast("int"))
        return F.transform(places, lambda p: F.struct(_gram(points, p).alias("hash"), p.alias("place")))

    return _let(F.encode(text, "UTF-32"), of)


def fingerprint(text: Column) -> Column:
    """``array<struct<hash, place>>``: the chosen hashes of a text in order of place."""
    return _marks(solid(text))


def _beginning(marks: Column, grams: Column) -> Column:
    """Of a fingerprint the marks that its first ``grams`` hashes alone have, for at least a window of them.

    Marks with a whole window after them are; of the few others the first window that chooses a mark begins ``SPAN - 1`` places before
    it, or after the mark before where that one is less.
    """

    def of(n: Column) -> Column:
        near = F.slice(marks, F.greatest(n, F.lit(1)), F.lit(SPAN + 2))  # the last sure mark, then those in doubt
        rank = lambda m: F.shiftrightunsigned(m["hash"], PLACE_BITS + 1)

        def reached(some: Column, mark: Column, i: Column) -> Column:
            before = F.get(some, i - 1)
            after = F.when((i > 0) & (rank(before) < rank(mark)), before["place"] + 1).otherwise(0)
            first = F.greatest(mark["place"] - (SPAN - 1), after, F.lit(0))
            return (mark["place"] > grams - SPAN) & (first + SPAN <= grams)

        doubtful = _let(near, lambda some: F.filter(some, lambda mark, i: reached(some, mark, i)))
        return F.concat(F.slice(marks, F.lit(1), n), doubtful)

    return _let(F.size(F.filter(marks["place"], lambda p: p <= grams - SPAN)), of)


def _joined(left: Column, right: Column) -> Column:
    """Marks in order of place, then others, the first of which may be the last of these."""

    def of(both: Column) -> Column:
        a, b = both["a"], both["b"]
        last = F.when(F.size(a) == 0, -1).otherwise(F.get(a, F.size(a) - 1)["place"])
        again = (F.size(b) > 0) & (F.get(b, F.lit(0))["place"] == last)
        return F.when(again, F.concat(a, F.slice(b, F.lit(2), F.greatest(F.size(b) - 1, F.lit(0))))).otherwise(F.concat(a, b))

    return _let(F.struct(left.alias("a"), right.alias("b")), of)


def spliced(marks: Column, head: Column, next_marks: Column, tail: Column) -> Column:
    """Fingerprint of ``head + tail``: beginnings, without white space, of texts whose fingerprints are known.

    Only grams near the seam are hashed: windows inside one beginning chose what they chose in its own text.
    """
    reach = GRAM + SPAN - 2  # code points on each side that a window across the seam may touch
    sizes = F.struct(F.char_length(head).alias("head"), F.char_length(tail).alias("tail"))

    def of(n: Column) -> Column:
        start = F.greatest(n["head"] - reach, F.lit(0))
        moved = lambda found, by: F.transform(found, lambda m: F.struct(m["hash"].alias("hash"), (m["place"] + by).cast("int").alias("place")))
        seam = F.concat(F.when(n["head"] > 0, F.right(head, F.lit(reach))).otherwise(""), F.left(tail, F.lit(reach)))
        # A short text has one window of all there is; else the seam needs a whole window.
        whole = n["head"] + n["tail"] < GRAM + SPAN - 1
        across = F.when(whole, _marks(seam)).otherwise(moved(_marks(seam, SPAN), start))
        before = F.when(whole, F.slice(marks, 1, 0)).otherwise(_beginning(marks, n["head"] - (GRAM - 1)))
        after = F.when(whole, F.slice(next_marks, 1, 0)).otherwise(moved(_beginning(next_marks, n["tail"] - (GRAM - 1)), n["head"]))
        # Windows choose from left to right, so only the mark at a border can be there twice.
        return _joined(_joined(before, across), after)

    return _let(sizes, of)


def digest(marks: Column) -> Column:
    """A fingerprint as one short string: the digest of its hashes and places."""
    return F.sha2(F.array_join(F.transform(marks, lambda m: F.concat_ws(":", m["place"], F.hex(m["hash"]))), ","), 256)


def likeness(one: Column, two: Column) -> Column:
    """Jaccard index of the hashes of two fingerprints."""

    def of(n: Column) -> Column:
        union = n["a"] + n["b"] - n["both"]
        return F.when(union == 0, F.lit(1.0)).otherwise(n["both"] / union)

    a, b = F.array_distinct(one["hash"]), F.array_distinct(two["hash"])
    return _let(F.struct(F.size(a).alias("a"), F.size(b).alias("b"), F.size(F.array_intersect(a, b)).alias("both")), of)


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, marks, next_text, next_marks``: each text and the next one by id (after the last, the first).

    One shuffle of the texts: ranges of ids become buckets, a partition each, and the first row of each also goes to the bucket
    before it, so a window inside the bucket sees every next row. Null ids come first, equal ids in order of a hash of the text; an
    id with so many rows that it fills buckets is cut by that hash. Marks pass the window as plain arrays.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("at", F.coalesce("doc_id", F.lit(-(1 << 63))))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("at", [i / buckets for i in range(1, buckets)] or [0.5], 20 * buckets)).first()[0] or []
    rows = rows.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 32)).withColumn("bucket", _bucket(F.col("at"), F.col("tie"), sorted(cuts)))
    # A row per bucket, as many as shuffle partitions.
    firsts = sorted((r[0], r[1]["at"], r[1]["tie"]) for r in rows.groupBy("bucket").agg(F.min(F.struct("at", "tie"))).collect())
    before = spark.createDataFrame(
        [(b, at, tie, i, (i - 1) % len(firsts)) for i, (b, at, tie) in enumerate(firsts)],
        "bucket int, first_at long, first_tie long, home int, previous int",
    )
    here = F.struct(F.col("home").alias("home"), F.lit(0).alias("guest"))
    there = F.struct(F.col("previous").alias("home"), F.lit(1).alias("guest"))
    first = (F.col("at") == F.col("first_at")) & (F.col("tie") == F.col("first_tie"))
    rows = rows.join(F.broadcast(before), "bucket").withColumn("spot", F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here))))
    rows = rows.select("doc_id", "text", "at", "tie", F.col("spot.home").alias("home"), F.col("spot.guest").alias("guest"))
    rows = rows.repartitionById(max(1, len(firsts)), "home").withColumn("marks", fingerprint(F.col("text")))
    order = Window.partitionBy("home").orderBy("guest", "at", "tie", "text")
    rows = rows.select("doc_id", "text", "at", "tie", "home", "guest", F.col("marks.hash").alias("hashes"), F.col("marks.place").alias("places"))
    seen = rows.withColumn("following", F.lead(F.struct("text", "hashes", "places")).over(order)).where("guest = 0")
    marks = lambda hashes, places: F.zip_with(hashes, places, lambda h, p: F.struct(h.alias("hash"), p.alias("place")))
    return seen.select(
        "doc_id", "text", marks("hashes", "places").alias("marks"), F.col("following.text").alias("next_text"),
        marks(F.col("following.hashes"), F.col("following.places")).alias("next_marks"),
    )


def _bucket(value: Column, tie: Column, cuts: list[int]) -> Column:
    """How many cuts are at most the value; a value that is several cuts goes by its tie, of 32 bits, to as many buckets."""
    if not cuts:
        return F.lit(0)
    upper = _count(value, cuts, lambda c, v: c <= v)
    if len(set(cuts)) == len(cuts):
        return upper
    lower = _count(value, cuts, lambda c, v: c < v)
    spread = F.shiftright(tie * (upper - lower), 32).cast("int")
    return F.when(F.array_contains(F.array(*(F.lit(c).cast("long") for c in sorted(set(cuts)))), value), lower + 1 + spread).otherwise(upper)


def _count(value: Column, cuts: list[int], holds) -> Column:
    """How many of the sorted cuts hold for the value, looked up in two steps of about the square root of their number."""
    step = math.isqrt(len(cuts)) + 1
    parts = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    below = lambda array: F.size(F.filter(array, lambda c: holds(c, value)))
    heads = F.array(*(F.lit(p[0]).cast("long") for p in parts))
    nested = F.array(*(F.array(*(F.lit(c).cast("long") for c in p)) for p in parts))
    return _let(below(heads), lambda n: F.when(n == 0, F.lit(0)).otherwise((n - 1) * step + below(F.element_at(nested, F.greatest(n, F.lit(1))))))


def against_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edit (its second half replaced by the start of the next text) and their likeness.

    ``doc_id, n_chars, edited, marks, edited_marks, near_edited, near_next``. A text is hashed once; its edit only at the seam.
    """
    found = with_next(docs, id_col=id_col, text_col=text_col).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    head, tail = F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)
    found = found.withColumns({"head": head, "tail": tail}).withColumns({
        "edited": F.concat("head", "tail"), "edited_marks": spliced(F.col("marks"), solid(F.col("head")), F.col("next_marks"), solid(F.col("tail"))),
    })
    return found.select(
        "doc_id", "n_chars", "edited", "marks", "edited_marks",
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"), likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
