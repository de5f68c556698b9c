"""Fill-in-middle, centroid clustering, toxicity."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skein.llm import exponion, fim, toxicity
from skein.llm.workspace import Workspace

# --- fill-in-middle


def plain_fim(text, doc_id):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abZ <>PSM\n\r1é日\U0001f642ſḰ"), max_size=40), st.integers(-5, 200))
def test_fim_equals_units_by_pattern(text, doc_id):
    n, form, a, m, out = fim.transform(text.encode(), doc_id)
    assert (n, form, a, m, out.decode()) == plain_fim(text, doc_id)


def test_ranked_bits():
    rng = random.Random(5)
    for size in (1, 7, 64, 1000, 5000):
        bits = rng.getrandbits(size) | 1
        places = [i for i in range(size) if bits >> i & 1]
        assert [fim.ranked(bits, r) for r in range(len(places))] == places


def test_fim_of_documents(spark, sf, edge, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    made = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    assert set(docs.columns) < set(made.columns)
    rows = made.collect()
    assert len(rows) == docs.count() and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(r.text, r.doc_id)
        assert r.back == r.text
    rows = fim.fill_in_middle(edge).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == edge.count()
    for r in rows:  # n is the result, not the clashing column
        assert (r.n, r.form, r.output) == (lambda x: (x[0], x[1], x[4]))(plain_fim(r.text or "", r.doc_id))
        assert r.back == (r.text or "") and r.key in ("x", None)
    assert fim.fill_in_middle(none).count() == 0
    marked = spark.createDataFrame([(i, f"a <S> b {i}") for i in range(20)], "doc_id long, text string")
    assert {r.form for r in fim.fill_in_middle(marked).collect()} == {"plain"}


# --- clustering


def plain_clusters(rows, k=8, rounds=10, seed=3):
    """rows: (id, integer vector). All distances in every round."""
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), list(r[1]))
    at = np.array([v for _, v in sorted(rows, key=key)[:k]], np.int64)
    x = np.array([v for _, v in rows], np.int64)
    for i in range(rounds + 1):
        d = ((x[:, None, :] - at[None]) ** 2).sum(2)
        own = d.argmin(1)
        if i < rounds:
            for j in range(len(at)):
                if (own == j).any():
                    at[j] = [int(s) // int((own == j).sum()) for s in x[own == j].sum(0)]
    return own, d.min(1), at


def clustered(spark, rows, k=8, rounds=10, dims=4):
    table = spark.createDataFrame([(i, list(map(float, v))) for i, v in rows], "vec_id long, embedding array<double>")
    whole = exponion.scaled(table, dims)
    return exponion.cluster_vectors(whole, Workspace(spark, "t"), k, rounds, dims)


@pytest.mark.parametrize(("n", "k", "span"), [(400, 8, 3), (300, 20, 40), (5, 8, 3), (60, 1, 5)])
def test_clusters_equal_all_distances(spark, n, k, span):
    """Small whole components make many equal distances, repeated rows and empty clusters."""
    rng = np.random.default_rng(n)
    rows = [(int(i), (v / 1024).tolist()) for i, v in enumerate(rng.integers(-span, span, (n, 4)))]
    rows += rows[: n // 3]
    got, c, _ = clustered(spark, rows, k)
    own, distance, at = plain_clusters([(i, np.floor(np.array(v) * 1024)) for i, v in rows], k)
    assert c.at.tolist() == at.tolist()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got.collect()) == sorted((i, int(a), int(d)) for (i, _), a, d in zip(rows, own, distance, strict=True))


def test_search_looks_at_few_centroids():
    """Well parted groups: after the first round most vectors are settled by their bounds, others by a small ball."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-100_000, 100_000, (64, 8))
    x = (centres[rng.integers(0, 64, 20_000)] + rng.integers(-900, 900, (20_000, 8))).astype(np.int64)
    c = exponion.Centroids(centres.astype(np.int64), np.zeros(64))
    state = exponion._first(x, c)
    exponion.search(x, *state, c)
    moved = centres + rng.integers(-200, 200, centres.shape)
    way = np.sqrt(((moved - centres) ** 2).sum(1).astype(float)) * (1 + 1e-9)
    c = exponion.Centroids(moved.astype(np.int64), way)
    measured = exponion.search(x, *state, c)
    assert measured < 0.05 * 64 * len(x)
    assert (state[0] == ((x[:, None] - moved[None]) ** 2).sum(2).argmin(1)).all()


def test_clusters_leave_out_broken_vectors(spark):
    v = [0.5, -0.25, 1.0, 0.0]
    rows = [(1, v), (2, None), (3, [*v[:3], None]), (4, [*v[:3], float("nan")]), (5, [*v[:3], float("-inf")]), (6, v[:3]), (7, []), (None, v), (1, v), (8, [*v, 1.0])]
    table = spark.createDataFrame([(i, x, "x", "y") for i, x in rows], "vec_id long, embedding array<float>, cluster string, ids string")
    got, c, blocks = exponion.cluster_vectors(exponion.scaled(table, 4), Workspace(spark, "t"), 2, 3, 4)
    assert sorted((r.vec_id or 0, r.cluster, r.distance) for r in got.collect()) == [(0, 0, 0), (1, 0, 0), (1, 0, 0)]
    assert c.at.tolist() == [[512, -256, 1024, 0]] * 2
    got, c, blocks = exponion.cluster_vectors(exponion.scaled(table.where("false"), 4), Workspace(spark, "t"), 2, 3, 4)
    assert got.count() == 0 and c is None
    with pytest.raises(Exception, match="too large"):
        exponion.scaled(spark.createDataFrame([(1, [1e9] * 4)], "vec_id long, embedding array<double>"), 4).collect()


def test_sums_beyond_64_bits(spark):
    rows = [(i, [(-1.0) ** i * 60_000.0 + i % 7] * 64) for i in range(3000)]
    got, c, blocks = clustered(spark, rows, 1, 1, 64)
    total = sum(int(r.distance) for r in got.collect())
    assert total > 1 << 63 and exponion._total(blocks, "inertia") == {0: total}


# --- toxicity


def test_fold_undoes_disguises():
    for told in ("Idiot", "1d10t", "ID!OT", "ιdιοτ", "іdіоt", "ｉｄｉｏｔ", "𝐢𝐝𝐢𝐨𝐭", "ïdïöt", "i​di­ot", "|d|ot"):
        assert toxicity.fold(told) == toxicity.fold("idiot"), told
    assert toxicity.fold("trash!! $$$ trash") == "trash!! $$$ trash"


def test_terms_stand_as_words_outside_exceptions():
    lexicon = toxicity.Lexicon.of({"trash": 2.0, "clown": 3.0, "scum": 1.0}, ["trash can", "take out the trash", "clown fish"])
    total = lambda t: lexicon.total(toxicity.fold(t))
    assert total("TR4SH, clowns; scum.") == 6.0
    assert total("trashy scumble unclown") == 0.0
    assert total("the trash can is trash, the trash cans too") == 2.0
    assert total("take out the trash cloWn f1sh clown") == 3.0
    assert total("") == 0.0 and toxicity.Lexicon({}, ()).total("trash") == 0.0


def test_scores_fall_with_length_and_whole_texts_count():
    lexicon = toxicity.Lexicon.of({"scum": 3.0}, [])
    short, long = lexicon.score("what scum he is"), lexicon.score("what scum he is" + " and so on" * 5000)
    assert short > 0.7 > long
    assert lexicon.score("and so on " * 5000 + "scum " * 400) > 0.7
    assert lexicon.score("") == lexicon.score("and so on") < 0.1


def test_terms_come_from_contexts_not_copies():
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    say = lambda *extra: " ".join(x for w in extra or [""] for x in (*(word() for _ in range(30)), w))
    copy = say("copied", "twice")
    toxic = [say("zonk", "zonk") for _ in range(60)] + [copy] * 60
    terms = toxicity.learned(toxic, [say() for _ in range(300)] + ["a scum here and " + say("scum") for _ in range(30)])
    assert "zonk" in terms and "copied" not in terms and "twice" not in terms
    assert "scum" not in terms and toxicity.fold("idiot") in terms


def test_beginnings_of_word_families_are_open_terms():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    say = lambda begin: " ".join(x for _ in range(2) for x in (*(word() for _ in range(20)), begin + word()))
    toxic, clean = [say("grumpf") for _ in range(60)], [say("") for _ in range(300)]
    lexicon = toxicity.fit(toxic, clean)
    weight, open_ = lexicon.weights["grumpf"]
    assert open_ and weight > 2 and sum(w.startswith("gru") for w in lexicon.weights) == 1
    assert lexicon.score("und ein Grumpfal und " + say("")) > 0.7 > lexicon.score("ein Ungrumpfal " + say(""))


def test_held_out_toxicity(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").withColumnRenamed("toxic", "wanted")
    rows = toxicity.query(spark, d).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.wanted for r in rows)
    false = sum(r.predicted == 1 and r.wanted == 0 for r in rows)
    assert right / len(rows) > 0.98 and false <= 0.005 * len(rows)


def test_toxicity_edges(spark, sf, edge, none):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    lexicon = toxicity.train(edge, labels.where("false"))
    rows = toxicity.score_toxicity(edge, lexicon, edge.columns).collect()
    assert len(rows) == edge.count() and all(0 <= r.score < 0.1 for r in rows)
    assert toxicity.score_toxicity(none, lexicon, ["doc_id"]).count() == 0
    odd = spark.createDataFrame([(None, 1), (1, None), (3, 0), (3, 1), (4, 7)], "doc_id long, toxic int")
    assert toxicity.train(edge, odd).slope == toxicity.UNFITTED[1]
