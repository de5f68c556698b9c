"""Pre-tokens, token counts, packing and token files against the tokenizers library."""

import math
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from skein.llm import packing, postings, pretokens, token_counts, token_files  # noqa: E402
from skein.llm.workspace import Workspace  # noqa: E402

BYTES, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = [
    "", "  ", "it's I'll we've  don't 'sure ''s !'s  x's\n\nfoo \n bar\t\tbaz  ", "a<|endoftext|>b <|endoftext|> 's", "<|endoftext|>",
    "éÉ İstanbul 日本語 ½ ٣٤ é Ω Σς ẞ", "'s't're'llama x 's\n's 'S", "aaaaaaaaaaaaaaaaa aaaa", "12345 1 2a3", " x　y ​ z", "<|startoftext|> hi", "'", "x'", "''",
    "\x1c\x1d a\x85b", "ﬁ ǅ Ǆ ŉ", "🙂🙂 a🙂", "😀'll",
]


def documents(spark, sf):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_library(spark, sf, path):
    texts = ODD + [t for _, t in documents(spark, sf)]
    raw = [t.encode() for t in texts]
    ids, at = pretokens.Encoder(path).encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))
    library = pretokens.library(path)
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text[:80]


def test_postings_round_trip():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**40, 5])
    data, sizes = postings.pack(values)
    assert postings.unpack(data)[0].tolist() == values.tolist() and sizes.sum() == len(data)


def test_token_counts(spark, sf, edge, none, monkeypatch):
    library = pretokens.library(BYTES)
    want = {i: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in documents(spark, sf)}
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.query(spark, sf).collect()}
    assert got == want
    rows = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(edge, BYTES).collect())
    assert len(rows) == edge.count()
    assert rows == sorted((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in edge.collect())
    assert token_counts.count_tokens(none, BYTES).count() == 0


def check_packing(rows, want, size):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by) == set(want)
    for i, own in by.items():
        at = 0
        for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.length == size or k == 0
            assert zlib.crc32(np.array(want[i][at : at + r.length], "<u4").tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(want[i]) and (len(own) == 1 or at > size)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(sequences)


def test_packing(spark, sf, edge, none):
    library = pretokens.library(BYTES)
    want = {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in documents(spark, sf)}
    n = check_packing(packing.query(spark, sf).collect(), want, 1024)
    least = math.ceil(sum(map(len, want.values())) / 1024)
    assert n <= least * 1.03 + 4
    rows = packing.pack_documents(edge, BYTES, size=64).collect()
    assert sum(r.length for r in rows) == sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in edge.collect())
    assert packing.pack_documents(none, BYTES).count() == 0


def test_local_search_empties_bins():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = rng.integers(1, 101, 300).tolist()
        bins = [[i] for i in range(300)]  # as bad as can be
        fitted = packing.best_fit(lengths, 100)
        assert len(packing.pack(lengths, 100)) <= len(fitted)
        found = packing.LocalSearch(lengths, bins, 100).run()
        assert sorted(i for b in found for i in b) == list(range(300))
        assert all(sum(lengths[i] for i in b) <= 100 for b in found)
        assert len(found) <= len(fitted) * 1.15 + 1


def steps_left(lengths, bins, size):
    """Moves and exchanges between underfull bins that raise the sum of squared fills, by trying them all."""
    bins = [b for b in bins if sum(lengths[i] for i in b) < size]
    fill = [sum(lengths[i] for i in b) for b in bins]
    sets = [[(0, 0), *{(1, lengths[i]) for i in b}, *{(2, lengths[i] + lengths[j]) for k, i in enumerate(b) for j in b[k + 1 :]}] for b in bins]
    allowed = {(0, 1), (1, 1), (2, 1), (1, 2)}  # given, taken
    for x in range(len(bins)):
        for y in range(len(bins)):
            for given, out in sets[x]:
                for taken, into in sets[y]:
                    gain = into - out
                    if x != y and (given, taken) in allowed and 0 < gain <= size - fill[x] and fill[x] + gain > fill[y]:
                        return x, y, out, into
    return None


@pytest.mark.parametrize(("low", "high", "n"), [(1, 100, 300), (52, 100, 300), (20, 60, 200), (1, 20, 150), (33, 34, 100)])
def test_search_ends_with_no_step_left(low, high, n):
    rng = np.random.default_rng(high)
    lengths = rng.integers(low, high + 1, n).tolist()
    alone = packing.LocalSearch(lengths, [[i] for i in range(n)], 101).run()
    for found in (packing.pack(lengths, 101), alone):
        assert sorted(i for b in found for i in b) == list(range(n)) and all(sum(lengths[i] for i in b) <= 101 for b in found)
        assert steps_left(lengths, found, 101) is None


def test_search_of_a_full_group_is_short():
    """Lengths of which no two fit: every bin is looked at, no step is found."""
    rng = np.random.default_rng(1)
    lengths = rng.integers(520, 1001, packing.GROUP).tolist()
    began = time.perf_counter()
    assert len(packing.pack(lengths, 1024)) == packing.GROUP
    assert time.perf_counter() - began < 60


def test_perfect_hash():
    for n in (0, 1, 2, 100, 5000):
        keys = token_files.hashed_keys(np.arange(n), np.zeros(n, np.int64))
        slots = token_files.PerfectHash.build(keys).slots(keys)
        assert sorted(slots.tolist()) == list(range(n))


def test_token_files(spark, sf, edge, none):
    library = pretokens.library(WORDS)
    at, want = 0, {}
    for i, t in sorted(documents(spark, sf)):
        ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    tokens = token_files.write_tokens(spark.read.parquet(f"{sf}/documents.parquet"), WORDS, Workspace(spark, "t"))
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_documents(tokens).collect()} == want
    found = {r.doc_id: r.ids for r in token_files.lookup(tokens, [3, 7, 10**9]).collect()}
    assert set(found) == {3, 7} and all(len(found[i]) == want[i][1] for i in found)
    rows = token_files.read_documents(token_files.write_tokens(edge, WORDS, Workspace(spark, "t"))).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 3, 3, 4, 5, 6]
    assert [r.start for r in rows][1:] == np.cumsum([r.n_tokens for r in rows]).tolist()[:-1]
    assert token_files.read_documents(token_files.write_tokens(none, WORDS, Workspace(spark, "t"))).count() == 0


def test_lookup_finds_repeated_and_null_ids(spark, edge):
    library = pretokens.library(WORDS)
    tokens = token_files.write_tokens(edge, WORDS, Workspace(spark, "t"))
    want = sorted((r.doc_id or -1, [*library.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in edge.collect() if r.doc_id in (None, 3))
    assert sorted((r.doc_id or -1, r.ids) for r in token_files.lookup(tokens, [None, 3, 99]).collect()) == want
    assert {r.doc_id for r in token_files.lookup(tokens, [3]).collect()} == {3}
    assert token_files.lookup(tokens, []).count() == 0


def test_lookup_reads_the_shards_of_its_keys(spark, monkeypatch):
    """Two ids far apart are in two shards, an id that repeats in as many as hold it; more shards than are named are joined."""
    monkeypatch.setattr(token_files, "SHARD_IDS", 64)
    rows = [(None, "no id")] * 30 + [(i, f"some words of document {i}") for i in range(300)] + [(150, "again")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        tokens = token_files.write_tokens(docs, WORDS, Workspace(spark, "t"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    count = lambda *ids: token_files.shards_of(tokens, list(ids)).count()
    assert tokens.count() > 12 and count(5, 290) == 2 and count(10**6, -4) == 0 and count() == 0
    held = {(r.part, r.shard) for r in token_files.shards_of(tokens, [150]).collect()}
    assert held == {(r.part, r.shard) for r in tokens.where("first_id <= 150 and last_id >= 150").collect()} and len(held) > 1
    nulls = sum(r.n_docs for r in tokens.join(token_files.shards_of(tokens, [None]), ["part", "shard"]).collect())
    assert nulls >= 30 and count(None) < tokens.count() / 2
    for named in (1_000, 1):
        monkeypatch.setattr(token_files, "NAMED", named)
        got = token_files.lookup(tokens, [5, 290, 150, None, 10**6]).groupBy("doc_id").count().collect()
        assert {r.doc_id: r["count"] for r in got} == {5: 1, 290: 1, 150: 101, None: 30}


def test_frequent_pretokens_are_dealt(spark):
    """One pre-token in all documents of many shards still counts right."""
    docs = spark.range(2000).repartition(4).selectExpr("id AS doc_id", "concat(' the the ', id % 7) AS text")
    library = pretokens.library(BYTES)
    want = {k: len(library.encode(f" the the {k}", add_special_tokens=False).ids) for k in range(7)}
    assert all(r.n_tokens == want[r.doc_id % 7] for r in token_counts.count_tokens(docs, BYTES).collect())
