"""Fingerprints, packing, secrets, encoding, token counts and languages beside brute force."""

import base64
import hashlib
import math
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geopulse.llm import bpe, langid, packing, secrets, token_counts, winnowing
from geopulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _edited(texts):
    ids = sorted(texts)
    for i, d in enumerate(ids):
        own, after = texts[d] or "", texts[ids[(i + 1) % len(ids)]] or ""
        half = len(own) // 2
        yield d, own, own[: len(own) - half] + after[:half], after


def _check_winnowing(got, texts):
    assert set(got) == set(texts)
    for d, own, edit, after in _edited(texts):
        row, marks = got[d], [brute.winnow(x) for x in (own, edit, after)]
        assert row["n_chars"] == len(own) and row["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        spelled = [hashlib.sha256(",".join(f"{p}:{h:X}" for h, p in m).encode()).hexdigest() for m in marks]
        assert [row["fingerprint"], row["edited_fingerprint"]] == spelled[:2]
        assert row["near_edited"] == pytest.approx(brute.jaccard(*marks[:2])) and row["near_next"] == pytest.approx(brute.jaccard(marks[0], marks[2]))


def test_winnowing_query(spark, given_rows):
    got = {r["doc_id"]: r for r in QUERIES["op2_winnowing"](spark, SF).collect()}
    _check_winnowing(got, {d: r["text"] for d, r in given_rows.items()})


def test_winnowing_awkward(awkward, empty):
    found = winnowing.against_edits(awkward)
    assert found.count() == awkward.count() and winnowing.against_edits(empty).count() == 0
    single = winnowing.against_edits(awkward.where("doc_id <> 3")).select(
        "*", F.sha2("edited", 256).alias("edited_sha256"), winnowing.digest(F.col("marks")).alias("fingerprint"),
        winnowing.digest(F.col("edited_marks")).alias("edited_fingerprint"),
    )
    texts = {r["doc_id"]: r["text"] for r in awkward.where("doc_id <> 3").collect()}
    _check_winnowing({r["doc_id"]: r for r in single.collect()}, texts)
    assert winnowing.against_edits(awkward.where("doc_id = 7")).first()["near_next"] == 1


def test_winnowing_runs_in_the_jvm(given):
    plan = winnowing.against_edits(given)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and plan.count("Exchange shufflepartitionidpassthrough") == 1
    assert "Exchange hashpartitioning" not in plan


def test_winnowing_guarantee(spark):
    """A shared run of GRAM + SPAN - 1 pieces shares a hash."""
    draw = random.Random(1)
    run = " ".join(f"r{i}" for i in range(winnowing.GRAM + winnowing.SPAN - 1))
    texts = [" ".join(f"w{draw.randint(0, 999)}" for _ in range(draw.randint(0, 30))) for _ in range(40)]
    rows = spark.createDataFrame([(" ".join((a, run, b)),) for a, b in zip(texts[::2], texts[1::2], strict=True)], "text string")
    marks = [{m["hash"] for m in r[0]} for r in rows.select(winnowing.fingerprint(F.col("text"))).collect()]
    assert all(a & b for a in marks for b in marks)


def _check_packing(rows, texts):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(texts)
    for d, found in pieces.items():
        ids = np.array(own.encode(texts[d] or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.SIZE
    return len(sequences)


def test_packing_query(spark, given_rows):
    rows = QUERIES["op3_packing"](spark, SF).collect()
    n = _check_packing(rows, {d: r["text"] for d, r in given_rows.items()})
    assert sum(r["length"] for r in rows) > 0.97 * n * packing.SIZE


def test_packing_awkward(awkward, empty, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 2)  # ranks over several parts
    single = awkward.where("doc_id <> 3")
    _check_packing(packing.pack(single).collect(), {r["doc_id"]: r["text"] for r in single.collect()})
    assert packing.pack(awkward).count() == packing.pieces(awkward).count() and packing.pack(empty).count() == 0


def test_packing_patterns_place_every_piece():
    draw = random.Random(3)
    for _ in range(20):
        histogram = {draw.randint(1, 64): draw.randint(1, 500) for _ in range(draw.randint(1, 40))}
        found = packing.patterns(histogram, 64)
        assert all(sum(lengths) <= 64 for _, lengths in found)
        assert {n: sum(c * lengths.count(n) for c, lengths in found) for n in histogram} == histogram


def test_special_token_and_odd_texts_like_the_library():
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a <|endoftext|> b", "<|endoftext|><|endoftext|>", "\x00\x1c 1²³ À漢字😀\n\n  x", "  \t ", "a" * 999):
        assert packing.token_ids(text).tolist() == own.encode(text, add_special_tokens=False).ids


def test_secrets_query(spark, given_rows):
    for r in QUERIES["op5_secrets"](spark, SF).collect():
        base = brute.base_spans(given_rows[r["doc_id"]]["text"])
        spelled = ",".join(f"{k}:{i}:{j}" for k, i, j in base)
        assert r["base_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == [s for s in spelled.split(",") if s]


def test_secrets_awkward(awkward, empty):
    got = {r["doc_id"]: r for r in secrets.scan(awkward).collect()}
    assert (got[10]["n_assign"], got[10]["n_access"], got[13]["n_hex"], got[13]["n_assign"]) == (1, 1, 1, 0)
    assert [s["kind"] for s in got[15]["spans"]] == ["assign", "random"] and got[4]["spans"] == [] and got[11]["spans"] == []
    clean = secrets.redacted(awkward)
    assert clean.columns == awkward.columns and clean.count() == awkward.count() and secrets.redacted(empty).count() == 0
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert text[15] == "[SECRET] and [SECRET]".replace("[SECRET] and", '[SECRET]" and') and text[4] is None


def test_randomness_battery():
    draw = random.Random(8)
    alphabet = "".join(secrets.ALPHABETS["base62"])
    made = ["".join(draw.choice(alphabet) for _ in range(32)) for _ in range(300)]
    made += [base64.b64encode(draw.randbytes(30)).decode() for _ in range(100)]
    hit = sum(any(s[1] == 3 for s in secrets.find(f"x {m} y")) for m in made)
    assert hit > 0.85 * len(made)
    plain = ["internationalisation2024edition", "aaaaaaaaaaaaaaaaaaaaaaaa1", "1234567890123456789012345", "abcdefghijklmnopqrstuvwxyz0123456789",
             "Donaudampfschifffahrtsgesellschaftskapitaen", "path/to/some/long/file-name-2020/with-parts"]
    assert not any(secrets.find(p) for p in plain)


def test_encoding_query(spark, given_rows, ranks):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks("byte_bpe_multi_50k.tiktoken"), special_tokens={})
    for r in QUERIES["op7_bpe"](spark, SF).collect():
        text = given_rows[r["doc_id"]]["text"] or ""
        ids = own.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_encoding_awkward(awkward, empty, monkeypatch):
    coded = bpe.encode(awkward, "byte_bpe_multi_50k.tiktoken")
    back = {r["doc_id"]: bytes(r["bytes"]).decode() for r in bpe.decode(coded, "byte_bpe_multi_50k.tiktoken").collect()}
    assert back == {r["doc_id"]: r["text"] or "" for r in awkward.collect()} and coded.count() == awkward.count()
    assert bpe.encode(empty, "byte_bpe_multi_50k.tiktoken").count() == 0
    own = bpe.load("byte_bpe_multi_50k.tiktoken")
    texts = ["the thing thereof", "xyzzy über 漢字 plugh", ""]
    want = own.encode(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 0)
    assert own.encode(texts) == want == own.encode(texts)


def test_perfect_hash_is_minimal_and_exact(ranks):
    keys = list(ranks("byte_bpe_50k.tiktoken"))
    index = bpe.PerfectHash(pa.array(keys, pa.binary()))
    assert index.find(pa.array(keys, pa.binary())).tolist() == list(range(len(keys)))
    foreign = [k + b"\x00q" for k in keys[:5000]]
    assert (index.find(pa.array(foreign, pa.binary())) == -1).all()
    assert sum(int(level.sum()) for level in index.bits) == len(keys)


def test_token_counts_query(spark, given_rows):
    pieces = token_counts.load("byte_bpe_50k.tiktoken")
    for r in QUERIES["op8_token_counts"](spark, SF).collect():
        words = [w.encode() for w in pieces.pattern.findall(given_rows[r["doc_id"]]["text"] or "")]
        if len(words) > 300:
            continue
        found = [token_counts.segment(w, pieces) for w in words]
        assert (r["n_pretokens"], r["n_tokens"]) == (len(words), sum(n for _, _, n in found))
        assert r["score"] == pytest.approx(math.fsum(s for s, _, _ in found))


def test_token_counts_by_enumeration():
    pieces = token_counts.unigram({b: i for i, b in enumerate([b"a", b"b", b"ab", b"ba", b"aab", b"\0", b"a\0"])}, public_tokenizers.PATTERN)

    def ways(word):
        if not word:
            yield 0.0, 0
        for piece, score in pieces.score.items():
            if word.startswith(piece):
                for s, n in ways(word[len(piece) :]):
                    yield s + score, n + 1

    draw = random.Random(6)
    words = sorted({bytes(draw.choice(b"ab\0") for _ in range(draw.randint(1, 9))) for _ in range(200)})
    forward, tokens = token_counts.trie_scores(words, pieces)
    for word, score, n in zip(words, forward.tolist(), tokens.tolist(), strict=True):
        every = list(ways(word))
        best = max(s for s, _ in every)
        assert score == pytest.approx(math.log(sum(math.exp(s) for s, _ in every)))
        assert n in {k for s, k in every if s > best - 1e-9}
        assert token_counts.segment(word, pieces)[::2] == pytest.approx((score, n))


def test_token_counts_awkward(awkward, empty):
    got = {r["doc_id"]: r for r in token_counts.count(awkward).collect()}
    assert got[4]["n_tokens"] == 0 and got[5]["score"] == 0 and got[11]["n_tokens"] > 0 and token_counts.count(empty).count() == 0


def test_language_query(spark, given_rows):
    rows = QUERIES["op9_langid"](spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and truth[r["doc_id"]]["lang"]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.98 * len(held) and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)


def test_language_awkward(awkward, empty, given):
    model = langid.fit(given)
    got = {r["doc_id"]: r for r in langid.identify(awkward, model).collect()}
    for d in (4, 5, 6, 14):
        assert (got[d]["lang_pred"], got[d]["score"], got[d]["rejected"]) == ("und", 0.0, True)
    kept = langid.accepted(awkward, model)
    assert kept.columns == awkward.columns and kept.where("doc_id in (4, 5, 6, 14)").count() == 0
    blank = langid.fit(empty)
    assert {r["lang_pred"] for r in langid.identify(awkward, blank).collect()} == {"und"} and langid.identify(empty, model).count() == 0
    assert langid.identify(awkward, langid.fit(awkward)).count() == awkward.count()


def test_language_rejects_what_is_far(spark, given):
    model = langid.fit(given)
    draw = random.Random(0)
    noise = "".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(600))
    assert langid.predict(model, [noise])[2] == [True]


def test_packing_of_very_long_runs():
    """Runs far longer than the library's splitter takes: white space, breaks, one letter, letters without a space, a special token among them."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in [" " * 30_000 + "a", "\n" * 30_000, "x" * 20_000, "漢字仮名" * 5_000, "a" + "\t " * 10_000 + "<|endoftext|>" + " " * 9_000 + "b", "ab1!" * 3_000]:
        assert packing.token_ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
    for text in [" " * 1_100_000, "\n" * 1_100_000, "a" * 200_000, "漢" * 100_000]:
        ids = packing.token_ids(text)
        assert b"".join(packing.bpe.load(packing.RANKS).bytes_of[i] for i in ids).decode() == text
