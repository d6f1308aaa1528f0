"""The pipeline stage by stage beside brute force, each on what the one before it kept."""

import brute

import corpus_pipeline
from geopulse.llm import langid, lines, packing, secrets
from geopulse.workspace import scratch

SF = "/root/testdata/sf0.001"


def _stages(spark, docs, check):
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        check(name, docs, out)
        docs = out
    return docs


def _near_lines(x, line):
    """Equal, or within one edit a ten characters of the shorter line, two at most."""
    most = min(2, min(len(x), len(line)) // 10)
    if x == line or abs(len(x) - len(line)) > most or len(set(x) ^ set(line)) > 2 * most:
        return x == line
    return lines.edit_distances([(x, line)], 2)[0] <= most


def _shingles(text):
    own = brute.words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(own[i : i + 5]) for i in range(max(len(own) - 4, min(1, len(own))))}


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_every_stage(spark, given):
    def check(name, docs, out):
        before, after = ({r["doc_id"]: r for r in df.collect()} if "text" in df.columns else None for df in (docs, out))
        if name == "packing":
            ids = {d: packing.token_ids(r["text"]) for d, r in before.items()}
            assert {d: len(x) + 1 for d, x in ids.items()} == {r["doc_id"]: r["doc_tokens"] for r in out.collect()}
            return
        assert out.columns == docs.columns and out.count() == len(after)
        if name == "language id":
            model = langid.fit(docs.where(~langid.held_out()))
            rejected = {d for d, r in before.items() if langid.predict(model, [r["text"] or ""])[2][0]}
            assert set(after) == set(before) - rejected and len(rejected) < 0.02 * len(before)
        elif name == "line dedup":
            assert set(after) == set(before)
            seen, fresh = [], {}
            for d in sorted(before):
                kept = []
                for line in before[d]["text"].split("\n"):
                    if not line.strip() or not any(_near_lines(x, line) for x in seen):
                        kept.append(line)
                    seen.append(line)
                fresh[d] = "\n".join(kept)
            assert {d: r["text"] for d, r in after.items()} == fresh
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        elif name == "simhash near-dedup":
            sets = {d: _shingles(r["text"]) for d, r in before.items()}
            root = brute.smallest_linked(list(sets), lambda a, b: _jaccard(sets[a], sets[b]) >= 0.8)
            assert set(after) == {d for d in before if root[d] == d} and len(after) < len(before)
        else:
            assert set(after) == set(before)
            assert {d: r["text"] for d, r in after.items()} == {d: secrets.redact(r["text"], secrets.find(r["text"])) for d, r in before.items()}

    packed = _stages(spark, given, check)
    assert {tuple(sorted(r.asDict().items())) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(sorted(r.asDict().items())) for r in packed.collect()}


def test_awkward_rows_pass_through(spark, awkward):
    def check(name, docs, out):
        if name != "packing":
            assert out.columns == docs.columns

    packed = _stages(spark, awkward, check)
    assert {1, 9, 10, 15} <= {r["doc_id"] for r in packed.collect()}


def test_empty_table_passes_through(spark, empty):
    assert _stages(spark, empty, lambda name, docs, out: None).count() == 0
