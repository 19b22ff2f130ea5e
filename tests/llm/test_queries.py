"""The registered text queries: against SQL, against plain versions, and by held-out accuracy."""

from __future__ import annotations

import collections

import brute
import pytest
from oracle_check import compare, open_duck

import corpus_pipeline
from tidemark.llm import queries, toxicity

SF = "/root/testdata/sf0.001"


def rows(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*columns).collect()]


def run(spark, name, sf=SF):
    return queries.QUERIES[name].build(spark, sf).collect()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert compare(spark, open_duck(SF), queries.QUERIES[name].build, queries.QUERIES[name].oracle, SF)[0] == ""


@pytest.mark.parametrize(("name", "label", "least"), [("op1_quality", "quality", 0.97), ("op2_toxicity", "toxic", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = run(spark, name, sf)
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (brute.remainder(r["doc_id"], 5) == 0) for r in got)
    held = [(r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > least


def test_language_model(spark):
    want = brute.kneser_ney(rows(spark, "documents", "doc_id", "text"), 7, 2)
    got = run(spark, "op3_lm_scoring")
    assert len(got) == len(want)
    for r in got:
        held, n, known, total, base, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-6)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_near_duplicates(spark):
    want = brute.groups(rows(spark, "documents", "doc_id", "text"), 4)
    assert {r["doc_id"]: r["component_id"] for r in run(spark, "op9_minhash_near_dedup")} == want


def test_repeated_passages(spark):
    want = brute.repeated_words(rows(spark, "documents", "doc_id", "text"))
    have = collections.defaultdict(set)
    for r in run(spark, "op8_suffix_array_dedup"):
        have[r["doc_id"]].update(range(r["first_word"], r["first_word"] + r["n_words"]))
    assert all(places <= have[i] for i, places in want.items())


def contaminated(spark):
    items = {i: brute.shingles(t, 5) for i, t in rows(spark, "benchmark", "item_id", "text")}
    weight = collections.Counter(x for s in items.values() for x in s)
    found = set()
    for d, t in rows(spark, "documents", "doc_id", "text"):
        own = brute.shingles(t, 5)
        found |= {(d, i) for i, s in items.items() if sum(1 / weight[x] for x in s & own) >= 0.8 * sum(1 / weight[x] for x in s)}
    return found


def test_decontamination(spark):
    got = {(r["doc_id"], r["item_id"]) for r in run(spark, "op10_benchmark_decontamination")}
    assert got == contaminated(spark)


def test_byte_bpe_against_the_library(spark):
    import hashlib

    import public_tokenizers
    import tiktoken

    from tidemark.llm import bpe

    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(public_tokenizers.path(bpe.VOCABULARY)), special_tokens={})
    got = {r["doc_id"]: tuple(r)[1:] for r in run(spark, "op4_byte_bpe")}
    for i, t in rows(spark, "documents", "doc_id", "text"):
        ids = own.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def test_pipeline_against_a_plain_one(spark):
    """All stages but the classifier are redone plainly; the classifier's decisions are its own scores."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = dict(rows(spark, "documents", "doc_id", "text"))
    left = {r["doc_id"]: texts[r["doc_id"]] for r in toxicity.score(docs, model).filter("score < 0.5").collect()}
    newest = {}
    for i, t in left.items():
        newest[t or ""] = max(i, newest.get(t or "", i))
    left = {i: left[i] for i in newest.values()}
    group = brute.groups(list(left.items()), 5)
    left = {i: t for i, t in left.items() if group[i] == i}
    leaked = {d for d, _ in contaminated(spark)}
    want = {i for i in left if i not in leaked}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(want)
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
