"""Exact copies, near copies and repeated strings against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.llm import bwt_dedup, chosen_path, queries, stream_dedup
from logwarden.llm.components import components
from tests.llm.plain import awkward, frame, hexed, links, repeated_bytes

ROWS = awkward()


def low(doc_id):
    return -1 if doc_id is None else doc_id


@pytest.mark.parametrize("files,weak", [(1024, False), (1, False), (1, True)])
def test_exact_groups(spark, files, weak):
    """Also with one file per micro-batch, and with a digest on which many texts collide."""
    settings = {"digest": lambda t: F.unhex(F.substring(F.sha2(t.cast("binary"), 256), 1, 2))} if weak else {}
    docs = frame(spark, ROWS).repartition(5)
    got = stream_dedup.flagged(stream_dedup.groups(docs, files_per_batch=files, **settings)).collect()
    same = Counter(t or "" for _, t in ROWS)
    largest = {}
    for i, t in ROWS:
        largest[t or ""] = max(largest.get(t or "", -1), low(i))
    expect = Counter((low(i), largest[t or ""], same[t or ""]) for i, t in ROWS)
    assert Counter((low(r.doc_id), low(r.keep_id), r.group_size) for r in got) == expect
    assert sum(r.kept for r in got) == len(same)


def test_exact_state_continues(spark, tmp_path):
    state = str(tmp_path / "state")
    staged = spark.createDataFrame([(1, "f", 0, "a"), (2, "f", 1, "b")], "doc_id long, file string, row long, d string").select(
        "doc_id", F.struct("file", "row").alias("_place"), F.col("d").cast("binary").alias("_digest"))
    path = str(tmp_path / "in")
    staged.write.parquet(path)
    assert stream_dedup.run_state(spark, staged, path, state, 1).count() == 0
    staged.where("doc_id = 1").withColumn("doc_id", F.lit(9).cast("long")).write.mode("append").parquet(path)
    hit = stream_dedup.run_state(spark, staged, path, state, 1).collect()
    assert [(bytes(r["_digest"]), r.keep.doc_id, r.group_size) for r in hit] == [(b"a", 9, 2)]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_calls_continue(spark, tmp_path, weak):
    """Three inputs, one of them twice, against plain groups of all rows so far; also with digests that collide."""
    settings = {"digest": lambda t: F.unhex(F.substring(F.sha2(t.cast("binary"), 256), 1, 2))} if weak else {}
    state, seen = str(tmp_path / "state"), {}

    def call(name):
        path = str(tmp_path / name)
        got = stream_dedup.flagged(stream_dedup.groups(spark.read.parquet(path), state, 1, **settings)).collect()
        same, largest = Counter(), {}
        for rows in seen.values():
            for i, t in rows:
                same[t or ""] += 1
                largest[t or ""] = max(largest.get(t or "", -1), low(i))
        expect = Counter((low(i), largest[t or ""], same[t or ""]) for i, t in seen[name])
        assert Counter((low(r.doc_id), low(r.keep_id), r.group_size) for r in got) == expect

    for name, rows in (("a", ROWS[:30]), ("b", ROWS[20:]), ("c", [(500 + low(i), t) for i, t in ROWS[5:25]])):
        frame(spark, rows).repartition(2).write.parquet(str(tmp_path / name))
        seen[name] = rows
        call(name)
    call("b")
    call("a")


def test_exact_calls_without_files(spark, tmp_path):
    state = str(tmp_path / "state")
    first = stream_dedup.deduplicate(frame(spark, [(1, "a"), (2, "a"), (3, "b")]), state)
    assert sorted(r.doc_id for r in first.collect()) == [2, 3]
    later = stream_dedup.deduplicate(frame(spark, [(0, "a"), (9, "b"), (4, "c")]), state)
    assert sorted(r.doc_id for r in later.collect()) == [4, 9]
    assert stream_dedup.deduplicate(frame(spark, ROWS).limit(0), state).count() == 0


def test_exact_stays(spark):
    docs = frame(spark, ROWS)
    kept = stream_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter({t or "": 1 for _, t in ROWS})
    assert stream_dedup.deduplicate(docs.limit(0)).count() == 0


def classes(rows):
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    count = Counter()
    for a, b in links(rows):
        count[a] += 1
        count[b] += 1
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(i)
    out = []
    for group in members.values():
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out += [(low(rows[i][0]), min(ids, default=-1), count[i], len(group)) for i in group]
    return Counter(out)


@pytest.mark.parametrize("settings", [{}, {"bucket": 3, "block": 4, "depth": 1}, {"bucket": 2, "block": 512, "depth": 0}])
def test_near_classes(spark, settings):
    """Also with buckets and blocks so small that hot ones must be split."""
    got = chosen_path.join(frame(spark, ROWS), **settings).collect()
    assert Counter((low(r.doc_id), low(r.class_id), r.n_links, r.class_size) for r in got) == classes(ROWS)


def test_near_stays(spark):
    docs = frame(spark, [(i, t) for i, t in dict(reversed(ROWS)).items() if i is not None])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = chosen_path.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _, _ in classes(rows)})
    assert chosen_path.join(docs.limit(0)).count() == 0


def test_runs_follow_recall():
    draw, missed = np.random.default_rng(1), 0
    runs = chosen_path.runs_for(0.9, 0.8)
    for _ in range(400):
        left = np.unique(draw.integers(0, 2**63, 200, dtype=np.uint64))
        right = np.unique(np.concatenate([left[:-20], draw.integers(0, 2**63, 20, dtype=np.uint64)]))
        seeds = chosen_path.mixed(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        chosen = [set(h[h <= np.uint64(int(2**64 / (0.8 * len(s))))].tolist())
                  for s in (left, right) for h in [chosen_path.mixed(s[None, :] ^ seeds[:, None])]]
        missed += not chosen[0] & chosen[1]
    assert missed <= 0.1 * 400


def test_runs_count_splits_and_margin():
    """The promised recall holds with the chosen path, the deepest splits and the sketches taken together."""
    for depth in range(4):
        runs, whole = chosen_path.runs_for(chosen_path.RECALL, 0.8, depth), np.arange(chosen_path.SKETCH + 1)
        draws = np.random.default_rng(depth).binomial(chosen_path.SKETCH, 0.8, 2_000_000)
        parted = 1 - (64 - whole) * (63 - whole) / (64 * 63)
        missed = np.where(whole < (0.8 - chosen_path.MARGIN) * 64, 1.0, np.exp(-runs * parted**depth))
        assert missed[draws].mean() <= 1 - chosen_path.RECALL


def test_recall_in_split_buckets(spark):
    """Pairs barely above the threshold around one hot passage, with splits taken."""
    draw = random.Random(8)
    passage = [f"p{i}" for i in range(150)]
    rows = []
    for i in range(40):
        own = [f"o{i}x{k}" for k in range(60)]
        other = list(own)
        for k in draw.sample(range(2, 58, 5), 4):
            other[k] = f"n{i}x{k}"
        rows += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + other))]
    got = chosen_path.join(frame(spark, rows), bucket=16).collect()
    assert sorted(links(rows)) == [(2 * i, 2 * i + 1) for i in range(40)]
    assert [r.doc_id for r in got if r.class_size != 2] == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 77), (3, 3), (200 + 1, 200)] + [(300, i) for i in range(301, 340)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 77: 50, 100: 50, 201: 200, **{i: 300 for i in range(301, 340)}}


@pytest.mark.parametrize("heavy,stretch", [(2048, 1 << 19), (1, 1 << 19), (2048, 700)])
def test_repeats(spark, monkeypatch, heavy, stretch):
    """Also with every shared anchor counted window by window, and with texts read in short stretches."""
    monkeypatch.setattr(bwt_dedup, "STRETCH", stretch)
    got = Counter()
    for r in bwt_dedup.remove(frame(spark, ROWS), heavy).collect():
        got[low(r.doc_id), r.n_bytes, tuple((s.lo, s.hi) for s in r.spans), hexed(bytes(r.kept))] += 1
    texts = [(t or "").encode() for _, t in ROWS]
    expect = Counter()
    for (i, _), t, cover in zip(ROWS, texts, repeated_bytes(texts)):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.array(cover, np.int8), [0]])))
        kept = bytes(b for b, c in zip(t, cover) if not c)
        expect[low(i), len(t), tuple(zip(edges[::2].tolist(), edges[1::2].tolist())), hexed(kept)] += 1
    assert got == expect
    assert bwt_dedup.remove(frame(spark, ROWS).limit(0)).count() == 0


def test_planted_passages(spark, tmp_path):
    """The query's columns on passages of over 50 words: of 400 bytes or more they go, below that and elsewhere nothing does."""
    draw = random.Random(11)

    def words(n, size):
        return " ".join(f"{draw.randrange(16**size):0{size}x}" for _ in range(n))

    long, edge, short = words(60, 7), words(57, 6) + " .", words(70, 4)
    assert len(long) > 400 and len(edge) == 400 and len(short) < 400
    rows, expect = [], {}
    for i in range(24):
        # Different letters beside a passage, so that nothing but the passage repeats.
        own = [chr(65 + i) + words(n, 8) + " é" + chr(65 + i) for n in (100, 100, 50)]
        planted = [[long], [edge], [short], [edge[:-1]], [], [long, edge]][i % 6]
        rows.append((i, "".join(a + b for a, b in zip(own, planted + [""] * 3))))
        gone = [p for p in planted if p in (long, edge)]
        kept = "".join(a + ("" if b in gone else b) for a, b in zip(own, planted + [""] * 3))
        expect[i] = (len(rows[-1][1].encode()), sum(map(len, gone)), len(gone), hexed(kept.encode()), kept)
    frame(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op4_bwt_dedup(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept_text) for r in got} == expect
    assert len(got) == len(rows)


def test_merged_transforms():
    draw = np.random.default_rng(4)
    base = draw.integers(97, 100, 900, dtype=np.uint8).tobytes()
    for _ in range(8):
        strings = []
        for _ in range(25):
            start, size = draw.integers(0, 400), draw.integers(380, 769)
            one = bytearray(base[start:start + size] if draw.random() < 0.7 else (b"ab" * 400)[:size])
            if draw.random() < 0.5:
                one[draw.integers(0, len(one))] = 120
            strings.append(bytes(one))
        old, bwt_dedup.SHARD_BYTES = bwt_dedup.SHARD_BYTES, 2000
        try:
            got = bwt_dedup.repeated_windows(strings)
        finally:
            bwt_dedup.SHARD_BYTES = old
        seen = Counter(s[i:i + 400] for s in strings for i in range(len(s) - 399))
        for flags, s in zip(got, strings):
            assert flags.tolist() == [seen[s[i:i + 400]] > 1 for i in range(len(s) - 399)]
