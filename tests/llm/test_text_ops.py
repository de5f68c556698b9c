"""License scans, chat formatting and line dedup."""

import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skein.llm import chat_format, license_scan, line_dedup, workspace
from skein.llm.license_texts import KNOWN
from skein.llm.workspace import Workspace

MIT = next(t for i, t in KNOWN if i == "MIT" and len(t) > 500)


def test_licenses(spark):
    changed = "Copyright (c) 2020 A. Person\nAll rights reserved.\n\n" + MIT.upper().replace("SOFTWARE", "software").replace(",", " ;")
    docs = spark.createDataFrame(
        [(1, changed), (2, MIT + " And more."), (3, "prose\nReleased under the MIT License.\nLicensed under the Apache Licence; version 2.0"), (4, "© 2020 x"), (4, None)],
        "doc_id long, text string",
    )
    got = sorted((r.doc_id, r.license_id, r.n_notices, r.notices, r.canonical_sha256 is None) for r in license_scan.scan_licenses(docs, license_scan.known_table(spark)).collect())
    assert got == [(1, "MIT", 0, "", False), (2, None, 0, "", False), (3, None, 2, "Apache-2.0,MIT", False), (4, None, 0, "", True), (4, None, 0, "", True)]


def test_long_licenses_by_digest(spark):
    """Entire texts, if this machine has any, in another case and with other line ends' punctuation."""
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "MPL-2.0": "MPL-2.0"}
    rows = [(i, "Copyright 2020 X\n" + (folder / name).read_text().upper()) for i, name in enumerate(names) if (folder / name).exists()]
    if not rows:
        pytest.skip("no licence texts here")
    docs = spark.createDataFrame([*rows, (99, rows[0][1][:-40])], "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in license_scan.scan_licenses(docs, license_scan.known_table(spark), digests=license_scan.digest_table(spark)).collect()}
    assert got == {i: list(names.values())[i] for i, _ in rows} | {99: None}


def test_license_edges(spark, edge, none):
    known = license_scan.known_table(spark)
    assert license_scan.scan_licenses(edge, known).count() == edge.count()
    assert license_scan.scan_licenses(none, known).count() == 0
    assert license_scan.scan_licenses(edge, known.where("false")).where("license_id is not null").count() == 0


def test_fold_and_render(spark):
    events = spark.createDataFrame(
        [
            (1, 0, "message", 0, "user", "hi </turn>\n### x \\l"),
            (1, 1, "delta", 1, "assistant", "wrong"),
            (1, 2, "regenerate", 1, "assistant", ""),
            (1, 3, "delta", 1, None, "He"),
            (1, 4, "delta", 1, None, "llo"),
            (1, 5, "edit", 0, "user", "hi there"),
            (2, None, "message", 0, None, None),
            (None, 1, None, 0, "assistant", "﻿a\U0001f642b"),
        ],
        "conv_id long, seq long, kind string, msg_id long, role string, text string",
    )
    out = chat_format.format_conversations(events)
    parsed = {r.conv_id: r for r in out.select("conv_id", chat_format.parse(F.col("formatted")).alias("t"), chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [(t.role, t.text) for t in parsed[1].t] == [("user", "hi there"), ("assistant", "Hello")]
    assert parsed[1].loss == "Hello"
    assert [(t.role, t.text) for t in parsed[2].t] == [("", "")] and parsed[2].loss == ""
    assert parsed[None].loss == "﻿a\U0001f642b"
    assert chat_format.format_conversations(events.where("false")).count() == 0


def test_turn_events_fold_to_turns(spark):
    """Abandoned attempts, regenerations, deltas and edits, in no order, give the turns back."""
    rows = [(1, 0, 10, "user", "Hello there"), (1, 1, 11, "assistant", "General <b>"), (2, None, 12, None, None), (2, 0, 13, "user", ""), (2, 1, 14, "user", "日本語 \U0001f642 x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, msg_id long, role string, text string")
    events = chat_format.turn_events(turns)
    kinds = {r.kind for r in events.collect()}
    assert kinds >= {"delta", "regenerate"} and events.count() >= 5 * len(rows)
    got = {(r.conv_id, r.seq.turn, r.role, r.text) for r in chat_format.fold_messages(events.orderBy("text")).collect()}
    assert got == {(c, t, r or "", x or "") for c, t, _, r, x in rows}
    many = turns.withColumn("msg_id", F.explode(F.sequence(F.lit(1), F.lit(40))))
    assert "edit" in {r.kind for r in chat_format.turn_events(many).collect()}


def test_hostile_conversation(spark, sf):
    row = chat_format.query(spark, sf).where("conv_id = -7").first()
    said = chat_format.HOSTILE
    assert row.n_turns == 2 and row.loss_chars == len(said)
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def brute_lines(docs):
    """Exact Jaccard of all pairs of lines."""
    order = {}
    for i, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                order.setdefault(line, (i, k))
    lines = list(order)
    n = line_dedup.SHINGLE
    sets = [{x[j : j + n] for j in range(max(1, len(x) - n + 1))} for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            if min(len(sets[i]), len(sets[j])) < 0.8 * max(len(sets[i]), len(sets[j])):
                continue
            common = len(sets[i] & sets[j])
            if common * 1.8 >= 0.8 * (len(sets[i]) + len(sets[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    keep = {x: order[lines[find(i)]] for i, x in enumerate(lines)}
    return {i: "\n".join(x for k, x in enumerate((t or "").split("\n")) if not x.strip(" ") or keep[x] == (i, k)) for i, t in docs}


def test_line_dedup_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(3, 60))) for _ in range(60)]
    docs = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 6)):
            ws = rng.choice(base).split()
            if rng.random() < 0.5:
                ws[rng.randrange(len(ws))] = rng.choice(words)
            lines.append(" ".join(ws))
        docs.append((i, "\n".join([*lines, ""])))
    monkeypatch.setattr(line_dedup, "PART_LINES", 4)  # so that buckets are cut into several cells
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame.orderBy("doc_id"), Workspace(spark, "t")).collect()}
    want = brute_lines(docs)
    assert sum(got[i] != want[i] for i in want) <= 2  # banding may miss a link at the threshold


def test_line_dedup_query_on_its_whole_table(spark, sf):
    """Against exact similarity of all lines: no line is removed that stays there, and hardly any the other way."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute_lines(docs)
    got = {r.doc_id: r for r in line_dedup.query(spark, sf).collect()}
    lines = {i: len((t or "").split("\n")) for i, t in docs}
    kept = lambda text, i: 0 if text == "" and lines[i] == 1 else len(text.split("\n"))
    assert sorted(got) == sorted(want) and all(got[i].n_lines == lines[i] for i in got)
    differ = sum(abs(kept(got[i].text, i) - kept(want[i], i)) for i in want)
    gone = sum(lines[i] - kept(want[i], i) for i in want)
    assert gone > 0 and differ <= 0.02 * gone + 1


def test_line_dedup_with_more_buckets_than_are_broadcast(spark, sf, monkeypatch):
    """Keys are joined without sketches and codes, which would be shuffled sixteen times; the result is that of the broadcast."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = sorted(map(tuple, line_dedup.dedup_lines(docs, Workspace(spark, "t")).collect()))
    shuffled = []
    real = workspace.met_by_key
    monkeypatch.setattr(line_dedup, "met_by_key", lambda df, keys, on, times: (shuffled.append((on, df.columns)), real(df, keys, on, times))[1])
    monkeypatch.setattr(workspace, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, line_dedup.dedup_lines(docs, Workspace(spark, "t")).collect())) == want
    assert (["key"], ["key", "band", "node"]) in shuffled


def test_line_dedup_edges(spark, edge, none):
    work = Workspace(spark, "t")
    got = line_dedup.dedup_lines(edge, work)
    assert got.count() == edge.count()
    twice = [r.text for r in got.where("doc_id = 3").collect()]
    assert sorted(twice) == ["", "Twice the same row.\nAnd a line."]
    assert [r.text for r in got.where("doc_id = 5").collect()] == ["\n\n  \n"]
    assert line_dedup.dedup_lines(none, Workspace(spark, "t")).count() == 0


def both_kept(spark, pairs):
    """How many pairs of lines keep both, each line a document."""
    frame = spark.createDataFrame([(2 * i + k, x) for i, p in enumerate(pairs) for k, x in enumerate(p)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, Workspace(spark, "t")).collect()}
    return sum(bool(got[2 * i]) and bool(got[2 * i + 1]) for i in range(len(pairs)))


def random_words(rng, n, least, most):
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(least, most))) for _ in range(n)]


def test_lines_of_any_length_meet(spark):
    rng = random.Random(5)
    longer = [(x := " ".join(random_words(rng, 40, 2, 9))[: rng.randint(65, 71)].strip(), x + " and") for _ in range(100)]
    starts = [(" ".join(ws), " ".join(ws[:-1])) for ws in (random_words(rng, 6, 14, 14) for _ in range(100))]
    assert both_kept(spark, longer) <= 3  # banding may miss a link near the threshold
    assert both_kept(spark, starts) <= 6


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """Windows of one text, of which only neighbours are linked; the least two lines are leaders that are not."""
    text = "".join(random.Random(7).choices("abcdefghijklmnopqrstuvwxyz ", k=600))
    rows = [(node, text[20 * at : 20 * at + 200]) for node, at in enumerate([0, 3, 1, 2, 8, 5, 6, 7])]
    raw = spark.createDataFrame(rows, "node long, line string").selectExpr("*", "node AS k1", "-node AS k2", "1 AS times", "length(line) AS chars")
    lines = line_dedup.signed(raw).withColumn("keys", F.array(F.lit(1).cast("long")))  # one bucket
    for most in (1, 2, 3, 1024):
        monkeypatch.setattr(line_dedup, "PART_LINES", most)
        roots = dict(tuple(r) for r in line_dedup._components(lines, Workspace(spark, "t")).collect())
        assert [roots[i] for i in range(8)] == [0, 0, 0, 0, 4, 4, 4, 4]


def test_pairs_with_a_first_line_are_settled_once(spark, monkeypatch):
    """Lines that share buckets two by two, none of them near: nothing is left to be held in cells."""
    rng = random.Random(23)
    texts = []
    for _ in range(40):
        words = random_words(rng, 30, 5, 5)
        texts += [" ".join(words), " ".join([*words[:24], *random_words(rng, 6, 5, 5)])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, real = {}, Workspace.table

    def table(self, df, name, *args, **kwargs):
        out = real(self, df, name, *args, **kwargs)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(Workspace, "table", table)
    assert all(r.n_kept == 1 for r in line_dedup.dedup_lines(frame, Workspace(spark, "t")).collect())
    assert rows["buckets"] > 20 and rows["found"] == rows["mixed"] == 0


def test_signatures_do_not_depend_on_the_step(spark, monkeypatch):
    """Minima over several shingles of a row are those over one, for lines from one character on."""
    text = "".join(random.Random(29).choices("abcdefgh ∂\U0001f642", k=60))
    raw = spark.createDataFrame([(n, -n, text[:n], 1) for n in range(1, 61)], "k1 long, k2 long, line string, times int")
    got = []
    for step in (1, 2, 4):
        monkeypatch.setattr(line_dedup, "STEP", step)
        got.append(sorted(map(tuple, line_dedup.signed(raw).select("k1", "keys", "sketch").collect())))
    assert got[0] == got[1] == got[2] and len(got[0]) == 60


def test_recall_at_the_threshold(spark):
    """Pairs of lines with a similarity from 0.8 to 0.85, of 60 to 90 characters or 4 to 8 words: at least 0.98 meet and are linked."""
    rng = random.Random(17)
    pairs = []
    while len(pairs) < 400:
        words = random_words(rng, rng.randint(4, 8), 5, 20) if len(pairs) % 2 else random_words(rng, 30, 2, 9)
        x = " ".join(words) if len(pairs) % 2 else " ".join(words)[: rng.randint(60, 90)].strip()
        i = rng.randrange(len(x))
        y = (x[: i + 1] + "#" + x[i + 1 + rng.randint(0, 1) :])[rng.randint(0, 3) :]
        a, b = ({t[j : j + 5] for j in range(len(t) - 4)} for t in (x, y))
        if 0.8 <= len(a & b) / len(a | b) <= 0.85:
            pairs.append((x, y))
    assert both_kept(spark, pairs) <= 8


def test_one_typo_is_near(spark):
    rng = random.Random(11)
    pairs = []
    for _ in range(150):
        x = " ".join(random_words(rng, 60, 2, 9))[: rng.randint(60, 110)].strip()
        i = rng.randrange(len(x))
        pairs.append((x, x[:i] + "#" + x[i + 1 :]))
    assert both_kept(spark, pairs) <= 3  # banding may miss a link near the threshold
