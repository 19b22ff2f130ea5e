"""Each text operator on awkward rows, on no rows, and against plain versions."""

from __future__ import annotations

import collections
import hashlib
import os
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import awkward, passage
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import bpe, components, decontaminate, exact_dedup, kneser_ney, licenses, quality, scratch, setsketch, suffixes, toxicity, warc, words

TEXTS = st.lists(st.sampled_from(["a", "bc", " ", "  ", "\n", "'s", "'", "1", "é", "\x1c", " ", "!", "日本", "the "]), max_size=60).map("".join)


# ------------------------------------------------------------------------ words


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXTS), max_size=8))
def test_words_are_those_of_the_definition(texts):
    hashed = dict(words.texts(pa.array(texts, pa.string())))
    assert len(hashed) == len(texts)
    seen: dict[str, int] = {}
    for i, t in enumerate(texts):
        plain = brute.words(t)
        assert len(plain) == len(hashed[i])
        for w, h in zip(plain, hashed[i].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_a_word_longer_than_a_piece():
    long = "x" * (words.PIECE + 10)
    (_, one), (_, two) = words.texts(pa.array([f"a {long} b", f"{long}y"]))
    assert len(one) == 3 and len(two) == 1 and one[1] != two[0]


# ------------------------------------------------------------------ exact copies


def test_exact_groups(spark, docs, nothing):
    rows = [(i, t or "") for i, t in awkward()]
    got = exact_dedup.exact_groups(docs, least=2).collect()
    by_text = collections.defaultdict(list)
    for i, t in rows:
        by_text[t].append(i)
    want = []
    for i, t in rows:
        ids = [x for x in by_text[t] if x is not None]
        keep = max(ids) if ids else None
        want.append((i, keep, len(by_text[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_groups(nothing).count() == 0


def test_heavy_and_light_digests_agree(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id div 2) END AS text")
    one = exact_dedup.exact_groups(df, least=2, heavy=4).collect()
    two = exact_dedup.exact_groups(df, least=10**9).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_drop_copies_keeps_one_row_of_each_text(docs, nothing):
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in awkward()})
    assert exact_dedup.drop_copies(nothing).count() == 0


# -------------------------------------------------------------------------- BPE


@pytest.fixture(scope="module")
def tokens():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path(bpe.VOCABULARY)
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(path), special_tokens={})
    return own, bpe.pieces(path, public_tokenizers.PATTERN)


def test_units_and_stitched_chunks_encode_alike(tokens):
    own, table = tokens
    rng = random.Random(5)
    bits = ["a", "bc", " ", "  ", "\n", "'s", "'", "1", "é", "\x1c", "!", "日本", "the ", " \n", "<|endoftext|>"]
    for _ in range(800):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 80)))
        want = own.encode_ordinary(text)
        assert np.frombuffer(table.encode(text), np.int32).tolist() == want
        step, overlap = rng.randint(1, 12), rng.randint(1, 6)
        chunks = []
        for k in range((len(text) - 1) // step + 1):
            chunk = text[k * step : k * step + step + overlap]
            starts, counts, ids = table.boundaries(chunk)
            chunks.append((chunk, starts + k * step, counts, ids))
        assert np.frombuffer(bpe.stitch(chunks, step, overlap, table), np.int32).tolist() == want


def test_round_trip(docs, nothing, tokens):
    own, _ = tokens
    got = bpe.round_trip(docs).collect()
    want = []
    for i, t in awkward():
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(nothing, with_ids=True).count() == 0


# --------------------------------------------------------------- near-duplicates


@pytest.mark.parametrize("k", [4, 5])
def test_near_groups(docs, nothing, k):
    want = brute.groups(awkward(), k)
    size = {(i, len(brute.shingles(t, k))) for i, t in awkward()}
    got = setsketch.near_groups(docs, k=k).collect()
    assert {(r["doc_id"], r["n_shingles"]) for r in got} == size and len(got) == len(awkward())
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else want[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    assert setsketch.near_groups(nothing).count() == 0
    assert setsketch.drop_near_copies(docs, k=k).columns == docs.columns


def test_a_large_group_of_changed_copies(spark):
    """Copies changed to different degrees: some linked with many, some with few, some with none."""
    rng = random.Random(9)
    base, rows = passage(6, 150).split(), []
    for i in range(250):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9])):
            own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    got = {r["doc_id"]: r["component_id"] for r in setsketch.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()}
    assert got == brute.groups(rows, 4)


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    found = components.components(spark.createDataFrame(links, "a long, b long"), scratch.Scratch(spark, "t")).collect()
    assert {r["id"]: r["component_id"] for r in found} == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "a long, b long"), scratch.Scratch(spark, "t")).count() == 0


def test_likelihood_finds_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        both = rng.integers(0, 2**64, 4000, dtype=np.uint64)
        n = int(4000 * share)
        one = both
        two = np.concatenate([both[:n], rng.integers(0, 2**64, 4000 - n, dtype=np.uint64)])
        a, b = setsketch.registers(one)[None], setsketch.registers(two)[None]
        merged = setsketch.registers(np.union1d(one, two))
        assert (merged == np.maximum(a[0], b[0])).all()
        guess, _ = setsketch.likelihood(a, b, np.array([4000.0]), np.array([4000.0]), 0.8)
        assert abs(guess[0] - n / (8000 - n)) < 0.15


# -------------------------------------------------------------- decontamination


def test_items_are_found_whole_and_slightly_changed(spark, docs, nothing):
    item = passage(20, 40)
    changed = item.split()
    changed[3] = "else"
    schema = "doc_id long, text string, item_id int"
    held = [(1, passage(21, 90) + "\n" + item.upper() + " " + passage(22, 50)), (2, " ".join(changed)), (3, passage(23, 200)), (4, None), (5, "few words"), (None, item)]
    texts = spark.createDataFrame([(i, t, 0) for i, t in held], schema)
    items = spark.createDataFrame([(7, item), (8, ""), (9, None), (None, item), (10, "few words")], "item_id long, text string")
    got = sorted(decontaminate.contaminated(texts, items).collect(), key=repr)
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 7), (2, 7), (5, 10), (None, 7)}
    assert {r["doc_id"]: (r["first_word"], r["similarity"]) for r in got}[1] == (90, 1.0)
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(texts, items).collect()) == [3, 4]
    assert decontaminate.contaminated(docs, items).count() == 0 and decontaminate.contaminated(nothing, items).count() == 0
    assert decontaminate.contaminated(texts, items.limit(0)).count() == 0
    assert {(r[0], r[1]) for r in decontaminate.contaminated(texts, items, group=1).select("doc_id", "item_id").collect()} == {(1, 7), (2, 7), (5, 10), (None, 7)}


def _scattered(rng, w, n):
    """A text with n words substituted, inserted or deleted at places of their own."""
    w = list(w)
    for at in sorted(rng.sample(range(len(w)), n), reverse=True):
        kind = rng.randrange(3)
        w[at : at + 1] = [[f"s{rng.random()}"], [f"i{rng.random()}", w[at]], []][kind]
    return w


def test_items_with_scattered_changes_are_found():
    """Against every stretch of every document, with shingles that many items share."""
    rng = random.Random(10)
    common = [f"c{i}" for i in range(12)]
    texts = [[f"v{rng.randrange(4000)}" for _ in range(rng.randrange(20, 200))] for _ in range(60)]
    texts = [t[:10] + common + t[10:] if i % 3 == 0 else t for i, t in enumerate(texts)]
    held = []
    for t in texts:
        for n in range(2, 7):
            held.append([f"b{rng.random()}" for _ in range(rng.randrange(60))] + _scattered(rng, t, n) + [f"a{rng.random()}" for _ in range(30)])
    index = decontaminate.Index([(i, " ".join(t)) for i, t in enumerate(texts)])
    got = {(row, item): value for row, item, value, _ in decontaminate._found_in(pa.array([" ".join(t) for t in held]), index)}
    sets = [brute.shingles(" ".join(t), 5) for t in texts]
    weight = collections.Counter(x for s in sets for x in s)
    want = {}
    for d, t in enumerate(held):
        own = [tuple(t[i : i + 5]) for i in range(len(t) - 4)]
        for i, s in enumerate(sets):
            if not s & set(own):
                continue
            stretch = len(texts[i]) + 2 * (len(texts[i]) // 4) - 4
            most = max(sum(1 / weight[x] for x in s & set(own[a : a + stretch])) for a in range(max(1, len(own) - stretch + 1)))
            if round(most / sum(1 / weight[x] for x in s), 12) >= 0.8:
                want[d, i] = most / sum(1 / weight[x] for x in s)
    assert len(want) > 100 and set(got) == set(want)
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())

def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 2**64, 300, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(600)], dtype=np.uint64)
    looked = prints[rng.integers(0, 300, 600)] ^ flips
    index = decontaminate.Length(prints, np.zeros(300, int), np.zeros(300, int))
    want = {(int(i), int(j)) for i in range(600) for j in np.flatnonzero(np.bitwise_count(looked[i] ^ prints) <= decontaminate.RADIUS)}
    assert set(zip(*map(np.ndarray.tolist, index.near(looked)))) == want


# --------------------------------------------------------------------- toxicity


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcdé1", min_size=1, max_size=8), min_size=1, max_size=6))
def test_the_automaton_accepts_what_is_one_edit_away(tokens):
    terms = [("abcab", False), ("dcba", False), ("éabcd", False), ("bbb", True)]
    machine = toxicity.automaton(terms)
    text = " ".join(tokens)
    at, entry, far, n = toxicity.matches(np.frombuffer(text.encode("utf-32-le"), np.uint32), machine)
    hit = dict(zip(at.tolist(), zip(entry.tolist(), far.tolist())))
    place = 0
    for token in tokens:
        want = None
        if token.startswith("bbb"):
            want = (3, 0)
        else:
            whole = [(distance(token, t), i) for i, (t, stem) in enumerate(terms) if not stem and (distance(token, t) == 0 or len(t) >= 5 and distance(token, t) == 1)]
            want = (min(whole)[1], min(whole)[0]) if whole else None
        assert hit.get(place) == want, (token, hit.get(place), want)
        place += len(token) + 1


def test_toxicity_learns_fuzzy_terms_and_quotation(spark, docs, nothing):
    rng = random.Random(4)
    filler = [f"n{i}" for i in range(400)]
    rows = []
    for i in range(1500):
        body = rng.choices(filler, k=40)
        if i % 5 == 0:
            for _ in range(3):
                body.insert(rng.randrange(40), rng.choice(["scoundrel", "nitwit"]))
        rows.append((i, " ".join(body), int(i % 5 == 0)))
    texts = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(texts, labels)
    assert {"scoundrel", "nitwit"} <= {t for t, _ in model.terms}
    scores = model.scores(["n1 n2 scoundrel nitwit scoundrel n3", "n1 n2 n3", "", 'she wrote "scoundrel" in her essay n1 n2 n3 n4 n5 n6 n7 n8', "scoundrel n1 n2 n3 n4 n5 n6 n7 n8 she wrote in her essay"])
    assert scores[0] > 0.5 > scores[1] and scores[2] < 0.5 and scores[3] < scores[4]
    assert model.scores(["you scoundrell and nitwitt"])[0] > scores[1]
    scored = toxicity.score(docs, model)
    assert scored.count() == len(awkward()) and scored.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.fit(texts, labels.limit(0)).scores(["scoundrel"])[0] < 0.5
    assert toxicity.fit(nothing, labels).scores([""])[0] < 0.5


# ---------------------------------------------------------------------- quality


def test_boosted_trees_learn_and_score_anything(spark, docs, nothing):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] < -0.5)).astype(float)
    model = quality.boost(x, y)
    assert ((model.scores(x) > 0.5) == y).mean() > 0.97
    one_by_one = np.concatenate([model.scores(row[None]) for row in x[:50]])
    assert np.allclose(one_by_one, model.scores(x[:50]))
    labels = spark.createDataFrame([(i, int(i < 10)) for i, _ in awkward() if i] + [(None, 1), (3, None)], "doc_id long, quality int")
    fitted = quality.fit(docs, labels)
    assert quality.score(docs, fitted).filter("score BETWEEN 0 AND 1").count() == len(awkward())
    for empty in (quality.fit(docs, labels.limit(0)), quality.fit(nothing, labels)):
        assert quality.score(nothing, empty).count() == 0 and 0 <= empty.scores(np.zeros((1, len(quality.NAMES))))[0] <= 1
    assert not quality.features(pa.array([None, ""], pa.string())).any()


# --------------------------------------------------------------- language model


def test_kneser_ney_on_awkward_rows(spark, docs, nothing):
    rows = [(i, t) for i, t in awkward() if i is not None] + [(100 + i, passage(i % 7, 40 + i)) for i in range(60)]
    unique = list({i: (i, t) for i, t in rows}.values())
    want = brute.kneser_ney(unique, kneser_ney.FOLDS, kneser_ney.HELD_OUT)
    got = kneser_ney.held_out_scores(spark.createDataFrame(unique, "doc_id long, text string")).collect()
    assert len(got) == len(unique)
    for r in got:
        held, n, known, total, base, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-6)
    assert kneser_ney.held_out_scores(docs).count() == len(awkward())
    assert kneser_ney.held_out_scores(nothing).count() == 0
    untrained = kneser_ney.score(docs, kneser_ney.train(nothing, scratch.Scratch(spark, "t")))
    assert untrained.filter("score <> 0 OR base_score <> 0 OR train_tokens <> 0").count() == 0


def test_probabilities_add_up_to_one(spark):
    texts = spark.createDataFrame([(passage(i % 3, 30),) for i in range(9)], "text string")
    model = kneser_ney.train(texts, scratch.Scratch(spark, "t"))
    every = np.arange(-1, model.n_types)
    for before in (0, 5, model.n_types, -1):
        p = 10 ** model.log10_probability(every, np.full(len(every), before))
        assert p.sum() == pytest.approx(1.0, abs=1e-9)


# ------------------------------------------------------------------------- WARC


def pages(spark):
    body = "<p>" + "x" * 200 + "</p>"
    rows = [(1, "http://a/ b", body), (2, "http://b", body), (3, None, None), (4, "u", ""), (5, "v", "short"), (6, "v", "short"), (None, "n", body), (2, "http://b", body), (1, "http://c", body), (None, None, None)]
    rows += [(100 + i, f"http://p/{i}", f"<html>{i} é " + "y" * (i * 37 % 900) + "</html>") for i in range(200)]
    return spark.createDataFrame([(*r, 0, "s") for r in rows], "page_id long, url string, html string, shard int, digest string"), rows


def listing(root: str) -> dict[str, bytes]:
    return {f: open(os.path.join(root, f), "rb").read() for f in sorted(os.listdir(root)) if f.endswith(".warc.gz")}


def test_archives_read_back_and_are_equal_byte_for_byte(spark, tmp_path):
    df, rows = pages(spark)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    manifest = warc.write(df, one, shard_bytes=20_000, roll_bytes=2_000)
    warc.write(df.repartition(7), two, shard_bytes=20_000, roll_bytes=2_000)
    assert listing(one) == listing(two) and len(listing(one)) > 3
    assert {r["name"]: (r["bytes"], r["sha256"]) for r in manifest.collect()} == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in listing(one).items()}
    assert not os.path.exists(f"{one}/_attempts")
    got = warc.read(spark, one).collect()
    payload = lambda h: (h or "").encode()
    assert sorted((r["page_id"] or -1, r["payload_digest"], r["payload_bytes"]) for r in got) == sorted(
        (i or -1, hashlib.sha256(payload(h)).hexdigest(), len(payload(h))) for i, _, h in rows
    )
    kinds = collections.Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["page_id"] in (1, 2, None))
    assert kinds == {(1, "response", None): 1, (1, "revisit", 1): 1, (2, "revisit", 1): 2, (None, "revisit", 1): 1, (None, "response", None): 1}
    assert all(r["record_type"] == "response" for r in got if r["page_id"] in (3, 4, 5, 6))
    assert {r["url"] for r in got if r["page_id"] == 1} == {"http://a/%20b", "http://c"}


def test_no_pages_and_damaged_archives(spark, tmp_path):
    df, _ = pages(spark)
    assert warc.write(df.limit(0), str(tmp_path / "none")).count() == 0
    assert warc.read(spark, str(tmp_path / "none")).count() == 0
    data = warc.record(1, b"u", b"<p>hello</p>", hashlib.sha256(b"<p>hello</p>").hexdigest(), 12, None)
    assert warc.parse(data)["payload"] == b"<p>hello</p>"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"hello", b"jello"))


def test_promotion_can_be_repeated(tmp_path):
    root = str(tmp_path)
    (tmp_path / "t").write_bytes(b"x")
    batch = pa.RecordBatch.from_pydict({"name": ["f.warc.gz"], "temporary": [f"{root}/t"]})
    for _ in range(2):
        list(warc._promote(root)(iter([batch])))
    assert (tmp_path / "f.warc.gz").read_bytes() == b"x"
    with pytest.raises(FileNotFoundError):
        list(warc._promote(root)(iter([pa.RecordBatch.from_pydict({"name": ["g"], "temporary": [f"{root}/h"]})])))


# --------------------------------------------------------------------- licenses


def test_licenses(spark, docs, nothing):
    by_name = {name: (i, body) for i, name, body in licenses.TEMPLATES}
    mit, bsd = by_name["MIT"][1], by_name["BSD-2-Clause"][1]
    cut = " ".join(w for i, w in enumerate(bsd.split()) if i != 30)
    held = [(1, "intro " + by_name["MIT-notice"][1] + " outro"), (2, passage(1, 300) + "\n" + mit.upper() + "\n" + passage(2, 300)), (3, cut), (4, "the MIT License under this"), (5, None), (6, ""), (None, mit)]
    got = licenses.scan(spark.createDataFrame([(i, t, 0, 0) for i, t in held], "doc_id long, text string, row int, w int")).collect()
    found = {(r["doc_id"], r["license"]): r for r in got}
    assert set(found) == {(1, "MIT-notice"), (2, "MIT"), (3, "BSD-2-Clause"), (None, "MIT")}
    assert found[1, "MIT-notice"]["first_word"] == 1 and found[2, "MIT"]["containment"] == 1.0 and 0.8 <= found[3, "BSD-2-Clause"]["containment"] < 1
    assert licenses.scan(docs).count() == 0 and licenses.scan(nothing).count() == 0


def test_every_template_shingle_has_a_needed_word():
    needed = set(licenses.needed_words(licenses.TEMPLATES))
    for _, _, body in licenses.TEMPLATES:
        w = [x for x in __import__("re").split(r"[^a-z0-9]+", body.lower()) if x]
        assert all(needed & set(w[i : i + 5]) for i in range(len(w) - 4))


# ----------------------------------------------------------- repeated passages


def test_repeated_passages(spark, docs, nothing):
    got = suffixes.repeated_passages(docs).collect()
    have = collections.defaultdict(set)
    for r in got:
        have[r["doc_id"]].update(range(r["first_word"], r["first_word"] + r["n_words"]))
    want = brute.repeated_words([(i, t) for i, t in awkward() if i is not None])
    for i, places in want.items():
        assert places <= have[i]
    spans = {r["doc_id"]: (r["first_word"], r["n_words"], r["other_id"], r["kept"]) for r in got}
    assert spans[15] == (60, 70, 16, True) and spans[16] == (40, 70, 15, False)
    assert not {4, 5, 6, 7, 8, 13, None} & set(have)
    assert suffixes.repeated_passages(nothing).count() == 0


def _passages(spark, rows):
    """Rows of each id, and their words, from the operator."""
    got = suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    have = collections.defaultdict(set)
    for r in got:
        have[r["doc_id"]].update(range(r["first_word"], r["first_word"] + r["n_words"]))
    return got, dict(have)


def test_large_groups_keep_one_copy_and_common_tails_lose_none(spark):
    rng = random.Random(8)

    def fresh(n):
        return [f"f{rng.randrange(10**9)}" for _ in range(n)]

    shared, tail = fresh(60), fresh(40)
    rows = [(i, " ".join(fresh(45) + shared + fresh(45))) for i in rng.sample(range(10**6), 1000)]
    for i in range(300):  # each pair shares 20 words of its own before a tail that all pairs have
        front = fresh(20)
        rows += [(2 * 10**6 + 2 * i + j, " ".join(fresh(30) + front + tail + fresh(30))) for j in range(2)]
    got, have = _passages(spark, rows)
    assert have == dict(brute.repeated_words(rows))
    first, second = sorted(i for i, _ in rows)[:2]
    assert {(r["doc_id"], r["other_id"]) for r in got if r["kept"] and r["doc_id"] < 10**6} == {(first, second)}
    assert {r["other_id"] for r in got if not r["kept"] and r["doc_id"] < 10**6} == {first}
    assert all((r["kept"], r["other_id"]) == (r["doc_id"] % 2 == 0, r["doc_id"] ^ 1) for r in got if r["doc_id"] >= 10**6)


def test_lines_that_repeat_within_a_text(spark):
    """All words of a repeated line count, in one document and in two, whatever the line's length."""
    rows, want = [], {}
    for k, n in enumerate((1, 2, 6, 10, 12, 15, 60)):
        line = " ".join(f"l{k}x{j}" for j in range(n)) + "\n"
        for i in (10 * k, 10 * k + 1):
            rows.append((i, line * 200))
        rows.append((10 * k + 5, " ".join(f"alone{k}" if j == 0 else f"m{k}x{j}" for j in range(n)) + " end"))
        rows.append((10 * k + 6, line.replace("l", "q") * 200))
        want |= dict.fromkeys((10 * k, 10 * k + 1, 10 * k + 6), set(range(200 * n)))
    got, have = _passages(spark, rows)
    assert have == want
    assert all(r["kept"] == (r["doc_id"] % 10 != 1) for r in got)


def test_anchors_depend_on_the_words_of_their_window():
    rng = np.random.default_rng(8)
    shared = rng.integers(0, 2**64, suffixes.LEAST, dtype=np.uint64)
    for before in (0, 17, 300):
        text = np.concatenate([rng.integers(0, 2**64, before, dtype=np.uint64), shared, rng.integers(0, 2**64, 40, dtype=np.uint64)])
        at, _ = suffixes.anchors(text)
        alone, _ = suffixes.anchors(shared)
        assert set(alone + before) <= set(at.tolist())
