"""The operators applied to their whole tables, as the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopulse.llm import bpe, conversation_sql, langid, licences, lines, neighbours, packing, prefixes, repair, secrets, simhash, substrings, token_counts, winnowing
from geopulse.llm.common import joined_digest, table
from geopulse.workspace import materialise


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.against_edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), winnowing.digest(F.col("marks")).alias("fingerprint"),
        winnowing.digest(F.col("edited_marks")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.classes(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    spelled = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(spelled, ",").alias("spans"), "n_random")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), "byte_bpe_multi_50k.tiktoken")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.identify(docs, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damaged(repair.ordered(table(spark, sf_dir, "conversations")))
    plans = materialise(repair.scripts(rows), "scripts")
    left = repair.repaired(rows, plans).select("conv_id", F.concat_ws(":", "role", "text").alias("said"))
    digests = joined_digest(left, "conv_id", "said", "\n").select(F.col("conv_id").alias("id"), "digest")
    digest = F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return plans.join(digests, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(*plans.columns, digest)


def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoken = prefixes.shared_starts(prefixes.turns(table(spark, sf_dir, "conversations")))
    return prefixes.trie(prefixes.sequences(spoken))


def op13_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    base, own = F.array_distinct("phrases.label"), F.array_distinct("spans.label")
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min("phrases.start").alias("first_word"),
        F.array_max("phrases.start").alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"), "score",
    )


QUERIES = {
    "op1_simhash": op1_simhash, "op2_winnowing": op2_winnowing, "op3_packing": op3_packing, "op4_lines": op4_lines, "op5_secrets": op5_secrets, "op6_substrings": op6_substrings,
    "op7_bpe": op7_bpe, "op8_token_counts": op8_token_counts, "op9_langid": op9_langid, "op10_neighbours": op10_neighbours,
    "op11_repair": op11_repair, "op12_prefixes": op12_prefixes, "op13_licences": op13_licences,
}
# The others hash with XXH64, tokenise, learn or approximate, which SQL does not state; tests hold them against brute force.
ORACLE_SQL = {
    "op11_repair": conversation_sql.REPAIR, "op12_prefixes": conversation_sql.PREFIXES,
    "op6_substrings": r"""
with split as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
windows as (
  select doc_id, unnest(range(1, len(ws) - 11)) as i,
         unnest(list_transform(range(1, len(ws) - 11), lambda j: array_to_string(ws[j:j + 12], ' '))) as words
  from split where len(ws) >= 13),
firsts as (select words, min(doc_id) as first_id from windows group by words),
gone as (
  select distinct doc_id, i + k as i
  from windows join firsts using (words), (select unnest(range(0, 13)) as k) where first_id < doc_id),
spelled as (select doc_id, unnest(range(1, len(ws) + 1)) as i, unnest(ws) as word from split where len(ws) > 0),
kept as (
  select s.doc_id, count(g.i) as n_removed, coalesce(string_agg(case when g.i is null then s.word end, ' ' order by s.i), '') as text
  from spelled s left join gone g on g.doc_id = s.doc_id and g.i = s.i group by s.doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from split d left join kept on kept.doc_id = d.doc_id
""",
}
