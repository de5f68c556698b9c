"""FLAC, FM-index, SimHash, components, classifier, pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skein.llm import components, covering, decontamination, flac, media, quality, simhash
from skein.llm.fm_index import FMIndex, suffix_array
from skein.llm.workspace import Workspace, numbered


def payloads():
    rng = np.random.default_rng(1)
    sine = (np.sin(np.arange(576 * 4) / 9) * 100 + 128).astype(np.uint8)
    spikes = np.where(np.arange(1152) % 97 == 0, 255, 120).astype(np.uint8)
    return [
        media.payload(b""), media.payload(b"abc" * 1000), rng.integers(0, 256, 576 * 3, dtype=np.uint8).tobytes(), sine.tobytes(), bytes(576 * 130), spikes.tobytes(),
        (np.arange(1152) % 256).astype(np.uint8).tobytes(), np.repeat(np.array([0, 255], np.uint8), 288).tobytes(),
    ]


def test_flac_round_trip():
    streams = flac.encode(payloads())
    for p, (first, samples) in zip(payloads(), flac.decode(streams), strict=True):
        assert (samples.view(np.uint8) ^ 0x80).tobytes() == p
        assert first.tolist() == list(range(0, len(p), 576))


def test_flac_finds_damage():
    stream = bytearray(flac.encode([media.payload(b"some text " * 200)])[0])
    for at in (len(stream) - 1, len(stream) - 300, len(stream) // 2):
        broken = bytearray(stream)
        broken[at] ^= 4
        with pytest.raises(ValueError):
            flac.decode([bytes(broken)])


def test_crc_values():
    assert flac.crc8(b"123456789") == 0xF4
    assert flac.crc16([b"123456789", b"9"])[0] == 0xFEE8


def test_media(spark, sf, edge, none):
    got = media.media_features(media.encode_media(edge)).collect()
    assert len(got) == edge.count()
    want = sorted((hashlib.sha256(media.payload((r.text or "").encode())).hexdigest(), zlib.crc32(media.payload((r.text or "").encode())[-32:])) for r in edge.collect())
    assert sorted((r.payload_sha256, r.tail_crc32) for r in got) == want
    assert media.pcm_blocks(media.encode_media(edge.where("doc_id = 1"))).first().n_samples == 576
    assert media.media_features(media.encode_media(none)).count() == 0


def test_media_query_and_blocks_on_the_whole_table(spark, sf, none):
    """Digests of the query, and blocks read back in order, against the payloads of all documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id: media.payload((r.text or "").encode()) for r in docs.collect()}
    rows = media.query(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(want)
    for r in rows:
        own = want[r.doc_id]
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(own), hashlib.sha256(own).hexdigest(), zlib.crc32(own[-32:]))
    back = {}
    for r in sorted(media.pcm_blocks(media.encode_media(docs)).collect(), key=lambda r: (r.doc_id, r.first_sample)):
        assert r.first_sample == len(back.setdefault(r.doc_id, bytearray())) and r.n_samples == len(r.pcm) == flac.BLOCK
        back[r.doc_id] += bytes(x ^ 0x80 for x in r.pcm)
    assert back == want
    assert media.pcm_blocks(media.encode_media(none)).count() == 0


def test_long_text_is_coded_in_groups(monkeypatch):
    text = bytes(np.random.default_rng(3).integers(32, 127, 576 * 40, dtype=np.uint8))
    whole = flac.encode([text, media.payload(b"x")])
    monkeypatch.setattr(flac, "BLOCKS", 16)
    assert flac.encode([text, media.payload(b"x")]) == whole
    assert [(s.view(np.uint8) ^ 0x80).tobytes() for _, s in flac.decode(whole)] == [text, media.payload(b"x")]


def test_suffix_array_and_search():
    rng = np.random.default_rng(0)
    for trial in range(60):
        k = int(rng.integers(2, 6))
        text = np.tile(rng.integers(1, k, 5), 20) if trial % 3 == 0 else rng.integers(1, k, int(rng.integers(0, 150)))
        whole = np.append(text, 0)
        assert suffix_array(whole).tolist() == sorted(range(len(whole)), key=lambda i: list(whole[i:]))
        index = FMIndex(text, k, 4)
        for size in (1, 2, 3):
            patterns = rng.integers(1, k, (8, size))
            for p, a, b in zip(patterns, *index.search(patterns), strict=True):
                want = [i for i in range(len(text) - size + 1) if (text[i : i + size] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_index_of_several_texts_and_its_cells():
    rng = np.random.default_rng(4)
    for trial in range(20):
        some = [rng.integers(2, 6, int(rng.integers(0, 40))) for _ in range(12)] + [np.tile([2, 3], 30)] * (trial % 3)
        text = np.concatenate([np.append(t, 1) for t in some])
        firsts = np.cumsum([0, *[len(t) + 1 for t in some[:-1]]])
        first = FMIndex(text, 6, 8, texts=firsts)
        for index in (first, FMIndex.of_cells(**first.cells())):
            patterns = rng.integers(2, 6, (10, 3))
            for p, a, b in zip(patterns, *index.search(patterns), strict=True):
                want = [i for i in range(len(text) - 2) if (text[i : i + 3] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(docs, items):
    windows = {}
    for i, t in items:
        w = words_of(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, ids = words_of(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    ids |= found
        out.append((d, len(w), len(hit), sorted(x for x in ids if x is not None)))
    return out


@pytest.mark.parametrize("limit", [32 << 20, 600])
def test_contamination(spark, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "ITEM_BYTES", limit)
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 64 << 20 if limit > 600 else 0)  # both ways of the joins
    rng = random.Random(5)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"word{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 9, 10, 14, 30])))) for i in range(25)] + [(3, "one more of item three"), (None, "no id here"), (77, None)]
    docs = []
    for d in range(80):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))]
        if rng.random() < 0.5:
            parts.append(rng.choice(items)[1] or "")
        docs.append((d, ". ".join(rng.sample(parts, len(parts))).upper() if d % 2 else "\n".join(parts)))
    docs += [(None, "no id here"), (5, None), (5, "")]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(frame, bench).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.item_ids) for r in found)
    assert got == sorted((d is None, d or 0, n, h, i) for d, n, h, i in brute_hits(docs, items))
    clean = decontamination.decontaminate(frame, bench)
    assert clean.columns == frame.columns and clean.count() == len(docs)
    again = {r.doc_id: r.n_hit for r in decontamination.contamination(clean.where("doc_id is not null"), bench).collect()}
    assert sum(again.values()) == 0


def test_stored_index_is_searched_again(spark, monkeypatch):
    """One table of indexes answers several benchmarks, whatever the number of blocks."""
    work, built = Workspace(spark, "t"), []
    docs = [(1, "a b c d e f g h i j k l"), (2, "x a b y"), (3, "A B."), (4, None), (5, "")]
    rows = numbered(spark.createDataFrame(docs, "id long, __text string"), work, "__row")
    index = decontamination.index_shards(rows, work)
    files = sorted(r.p for r in index.selectExpr("_metadata.file_path || _metadata.file_modification_time AS p").collect())
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 100)
    made = decontamination.Block.__init__
    monkeypatch.setattr(decontamination.Block, "__init__", lambda self, t: built.append(t.num_rows) or made(self, t))
    for items, want in (([(1, "a b")], {1, 2, 3}), ([(1, "b c d e f g h i j k"), (2, "x a b"), (3, "b a")], {1, 2}), ([], set())):
        wins = work.table(decontamination.windows_of(spark.createDataFrame(items, "item_id long, text string")), "windows")
        found = decontamination.search_index(index, wins, work)
        assert {r.id for r in rows.join(found, "__row").collect()} == want
    assert sum(built) == 4 and len(built) > 2
    assert files == sorted(r.p for r in work.read("index").selectExpr("_metadata.file_path || _metadata.file_modification_time AS p").collect())


def test_contamination_edges(spark, edge, none):
    bench = spark.createDataFrame([(1, "lorem ipsum dolor sit amet")], "item_id long, text string")
    got = decontamination.decontaminate(edge, bench)
    assert got.columns == edge.columns and got.count() == edge.count()
    assert got.where("doc_id = 4").first().text.strip() == ""
    assert decontamination.decontaminate(none, bench).count() == 0
    assert decontamination.contamination(edge, bench.where("false")).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("code", covering.CODES)
def test_covering_code(code):
    rng = np.random.default_rng(4)
    words = rng.integers(0, 2**32, 300, dtype=np.uint64).astype(np.uint32)
    row, anchor, home = covering.anchors(code, words, 2)
    assert (covering.syndromes(code, anchor) == 0).all()
    assert (np.bitwise_count(anchor ^ words[row]) <= code.radius + 2).all()
    assert (np.bincount(row[home], minlength=300) == 1).all()
    assert (np.bitwise_count(anchor[home] ^ words[row[home]]) <= code.radius).all()
    for _ in range(50):  # within two bits: a word comes to the other's home
        i = int(rng.integers(300))
        other = words[i] ^ np.uint32(1 << int(rng.integers(32))) ^ np.uint32(1 << int(rng.integers(32)))
        r, a, h = covering.anchors(code, np.array([other]), 2)
        assert anchor[home & (row == i)][0] in a


def test_codes_grow_finer_with_the_input():
    assert [covering.code_for(n, 2).radius for n in (0, 10**6, 5 * 10**7, 10**10)] == [4, 4, 3, 1]


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [ids[find(i)] for i in range(len(ids))]


def test_simhash_equals_brute_force(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    prints = [brute_print(t) for _, t in docs]
    want = brute_components([i for i, _ in docs], prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(spark, sf).collect()}
    assert got == {i: (f"{p:016x}", c) for (i, _), p, c in zip(docs, prints, want, strict=True)}


@pytest.mark.parametrize(("bucket", "code"), [(20_000, 0), (7, 0), (20_000, 1), (20_000, 2)])
def test_links_of_close_fingerprints(spark, monkeypatch, bucket, code):
    monkeypatch.setattr(simhash, "code_for", lambda n, distance: covering.CODES[code])
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    prints = [int(b) for b in base]
    for _ in range(150):
        p = prints[int(rng.integers(len(prints)))]
        for _ in range(int(rng.integers(1, 6))):
            p ^= 1 << int(rng.integers(64))
        prints.append(p)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    forest = simhash.link_forest(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), bucket)
    roots = {r.node: r.root for r in components.connected_components(forest, Workspace(spark, "t")).collect()}
    want = brute_components(signed, prints)
    groups = {}
    for p, w in zip(signed, want, strict=True):
        assert groups.setdefault(w, roots.get(p, p)) == roots.get(p, p)
    assert len(set(groups.values())) == len(groups)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)] + [(500, 500 + i) for i in range(1, 60)]
    roots = {r.node: r.root for r in components.connected_components(spark.createDataFrame(chain, "a long, b long"), Workspace(spark, "t")).collect()}
    assert all(roots[i] == 0 for i in range(41)) and roots[101] == 100 and all(roots[500 + i] == 500 for i in range(60))
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "t")).count() == 0


def test_components_of_more_than_a_million_links(spark):
    """The digest that tells whether a round changed anything holds for any number of links."""
    edges = lambda last: spark.range(1_300_000).select(F.col("id").alias("a"), F.when(F.col("id") < 1_299_999, F.col("id") + 1).otherwise(last).alias("b"))
    assert components._state(edges(5)) == components._state(edges(5).repartition(3)) != components._state(edges(6))
    assert components._state(edges(5))[0] == 1_300_000


def test_simhash_edges(spark, edge, none):
    got = simhash.near_duplicates(edge, Workspace(spark, "t"))
    assert got.count() == edge.count()
    assert {r.component_id for r in got.where("fingerprint = 0").collect()} == {1}
    kept = simhash.one_of_each(edge, Workspace(spark, "t"))
    assert kept.columns == edge.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 6]
    assert simhash.one_of_each(none, Workspace(spark, "t")).count() == 0


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in quality.query(spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.95


def test_quality_edges(spark, sf, edge, none):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    assert quality.train(docs, labels.where("false")) is None
    assert {r.score for r in quality.score_quality(edge, None, ["doc_id"]).collect()} == {0.5}
    network = quality.train(docs, labels, 60)
    got = quality.score_quality(edge, network, edge.columns)
    assert got.count() == edge.count() and got.where("score between 0 and 1").count() == edge.count()
    assert quality.score_quality(none, network, ["doc_id"]).count() == 0


def test_quality_gradient():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in (5, 200, 700)]
    text, first = quality.padded(np.frombuffer(b"".join(texts), np.uint8), np.array([0, 5, 205, 905]))
    net = quality.Network.new()
    net.bytes_, net.bias, net.out = (x.astype(np.float64) for x in (net.bytes_, net.bias, net.out))
    wanted, weight = np.array([0, 1, 0]), np.ones(3)

    def loss():
        s = net.forward(text, first, net.pair_tables())["score"]
        return -(wanted * np.log(s) + (1 - wanted) * np.log(1 - s)).sum()

    grads = net.gradients(text, first, wanted, weight)
    for p, g in zip((net.bytes_, net.bias, net.out), grads, strict=True):
        for _ in range(6):
            at = tuple(int(rng.integers(n)) for n in p.shape)
            p[at] += 1e-5
            up = loss()
            p[at] -= 2e-5
            down = loss()
            p[at] += 1e-5
            assert abs((up - down) / 2e-5 - g[at]) < 2e-3 * max(1, abs(g[at]))


def test_scores_equal_plain_convolution():
    """Filters slid over a text place by place, largest response by chunk, mean and maximum of the chunks."""
    rng = np.random.default_rng(4)
    net = quality.Network.new()
    net.bias[:] = rng.normal(0, 0.3, quality.FILTERS)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 100, 128, 253, 256, 1000)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    half, got = quality.BLOCK, net.score(data, offsets, net.pair_tables())
    for text, score in zip(texts, got, strict=True):
        blocks = -(-(len(text) + 4) // half)
        padded = np.frombuffer(text.ljust((blocks + 1) * half, b"\0"), np.uint8)
        at = [sum(net.bytes_[k, padded[i + k]] for k in range(quality.WIDTH)) for i in range(0, blocks * half, 2)] if blocks else []
        per = half // 2
        chunks = [range(b * per, min(b + 2, blocks) * per) for b in range(max(1, blocks - 1))]
        # the last two places hold nothing but padding
        values = np.array([[max(0.0, max(at[i][f] for i in c if i < len(at) - 2) + net.bias[f]) for f in range(quality.FILTERS)] for c in chunks])
        features = np.concatenate([values.mean(0), values.max(0), [1]])
        assert abs(1 / (1 + np.exp(-features @ net.out)) - score) < 1e-4


@pytest.mark.parametrize("letters", [65, 100_000])
def test_long_benchmark_words(spark, letters):
    """Words longer than those compared side by side, equal up to their last letter."""
    word = "w" * letters
    item = f"{word}a b c"
    docs = spark.createDataFrame([(1, f"x {word}a b c y"), (2, f"x {word}b b c y"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.item_ids) for r in decontamination.contamination(docs, items).collect()}
    assert got == {1: (3, [7]), 2: (0, []), 3: (0, [])}


def test_pipeline_edges(spark, sf, edge):
    """Nulls, empty, very long and repeated rows and clashing names through every stage."""
    import corpus_pipeline

    names = ["__row", "__score", "score_", "gone", "row_"]
    docs = edge.withColumns({n: edge["key"] for n in names})
    work = Workspace(spark, "t")
    docs = work.table(docs, "edge")
    columns, ids = docs.columns, sorted(r.doc_id or 0 for r in docs.collect())
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[1:], 1):
        docs = work.table(stage(spark, docs, sf), f"s{i}")
        if i < 4:
            assert docs.columns == columns or docs.columns == [*columns, "n_chars"]
            columns = docs.columns
        if i == 1:
            assert sorted(r.doc_id or 0 for r in docs.collect()) == ids
    assert docs.count() > 0
    scored = corpus_pipeline.keep_good(spark, work.read("edge"), sf)
    assert scored.columns == work.read("edge").columns and scored.count() <= len(ids)


def test_pipeline(spark, sf):
    import corpus_pipeline

    work, docs = Workspace(spark, "t"), spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = work.table(stage(spark, docs, sf), f"s{i}")
        counts.append(docs.count())
        if i < 4:
            assert docs.columns == columns
        if i == 2:
            prints = [brute_print(r.text) for r in docs.collect()]
            assert brute_components(list(range(len(prints))), prints) == list(range(len(prints)))
        if i == 3:
            bench = spark.read.parquet(f"{sf}/benchmark.parquet")
            assert decontamination.contamination(docs, bench).where("n_hit > 0").count() == 0
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] < counts[2] and counts[4] == counts[3]


def test_pipeline_without_documents(spark, sf, tmp_path):
    import corpus_pipeline

    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").where("false").write.parquet(f"file://{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0
