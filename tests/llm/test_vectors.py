"""Whitening, the Merkle manifest and SimHash classes against plain versions."""

import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logwarden.llm import bit_whitening, merkle_manifest, queries, simhash_trie
from tests.llm.plain import awkward, frame, hexed
from tests.oracle import connect, table_rows

ROWS = awkward()


def low(doc_id):
    return -1 if doc_id is None else doc_id


# Whitening

def vectors():
    draw = np.random.default_rng(6)
    mix = draw.normal(size=(5, 5))
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(300, 5)) @ mix)]
    rows += [(400 + i, rows[0][1]) for i in range(200)]  # a hot vector
    rows += [(None, rows[1][1]), (7, rows[1][1]), (601, None), (602, []), (603, [1.0, None, 0.0, 0.0, 0.0]), (604, [math.nan] * 5),
             (605, [math.inf, 0.0, 0.0, 0.0, 0.0]), (606, [1.0, 2.0]), (607, [1.0, 2.0]), (608, [-90.0, 3.5, 0.0, 0.0, 90.0])]
    return rows


def plain_whitening(rows, dims=5):
    fit = np.array(sorted({tuple(math.floor(64 * c) + 1000000 for c in v) for _, v in rows}), dtype=object)
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1]
    return n, total, values[order], axes[:, order]


def embedding_frame(spark, rows):
    kind = "vec_id long, embedding array<double>, whitened string, deviation int, _white int, x int, label int"
    return spark.createDataFrame([(i, v, "w", 1, 2, 3, 4) for i, v in rows], kind)


def test_cross_products_are_exact():
    draw = np.random.default_rng(0)
    for rows, dims, reach in [(1, 3, 10), (64, 2, 1), (1000, 7, 300), (129, 4, 1 << 50)]:
        x = draw.integers(-reach, reach + 1, (rows, dims))
        sums, products = bit_whitening.cross_products(x)
        plain = x.astype(object)
        assert (sums == plain.sum(axis=0)).all() and (products == plain.T @ plain).all()


def test_whitening_against_plain(spark, monkeypatch):
    monkeypatch.setattr(bit_whitening, "STRETCH", 50)
    rows = vectors()
    good = [(i, v) for i, v in rows if v is not None and len(v) == 5 and all(c is not None and math.isfinite(c) for c in v)]
    n, total, values, axes = plain_whitening(good)
    df = embedding_frame(spark, rows).repartition(4)
    model = bit_whitening.fit(df)
    assert model.n == n and list(model.sums) == total.tolist()
    np.testing.assert_allclose(model.values, values, rtol=1e-9)
    assert model.identity_error < 1e-9
    assert model.total == pytest.approx(values.sum())
    got = bit_whitening.whiten(df, model)
    assert got.columns[:len(df.columns)] == df.columns and got.columns[-2:] == ["deviation_", "whitened_"]
    expect = Counter()
    for i, v in good:
        x = [math.floor(64 * c) + 1000000 for c in v]
        expect[low(i), sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, total))] += 1
    found = got.collect()
    assert Counter((low(r.vec_id), r.deviation_) for r in found) == expect
    white = {tuple(r.embedding): np.array(r.whitened_) for r in found}
    for v, w in white.items():
        centred = np.array([float(n * (math.floor(64 * c) + 1000000) - int(s)) / n for c, s in zip(v, total)])
        np.testing.assert_allclose(np.abs(w), np.abs(centred @ axes / np.sqrt(values)), rtol=1e-6, atol=1e-6)


def test_whitening_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.001, 2.001])]):
        df = embedding_frame(spark, rows)
        model = bit_whitening.fit(df)
        assert model.components == 0
        assert [r.whitened_ for r in bit_whitening.whiten(df, model).collect()] == [[] for _, v in rows if v and model.n]
    # one direction only
    df = embedding_frame(spark, [(i, [i / 8, i / 4]) for i in range(20)])
    model = bit_whitening.fit(df)
    assert model.components == 1 and model.identity_error < 1e-9


def test_whitening_query(spark):
    got = queries.op11_bit_whitening(spark, "/root/testdata/sf0.001").toPandas()
    assert sorted(set(got.component)) == list(range(1, 17))
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    assert got.groupby("component").explained.first().is_monotonic_decreasing


# Merkle manifest

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """Levels of a tree, from the leaves up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 3])) for i in range(0, len(last), 3)])
    return levels


def plain_path(levels, place):
    out = []
    for level in levels[:-1]:
        run = place - place % 3
        out.append((level[run:place], level[place + 1:run + 3]))
        place //= 3
    return out


def plain_manifest(rows):
    """``doc_id, leaf, subroot, root, proof, path`` of rows of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((low(r[0]), plain_leaf(r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf for _, leaf, _ in sorted(groups[s], key=lambda g: g[:2])]) for s in order}
    top = plain_tree([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for place, (doc_id, leaf, r) in enumerate(sorted(groups[s], key=lambda g: g[:2])):
            path = plain_path(trees[s], place) + plain_path(top, at)
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], path, r))
    return out


def climbed(node, path):
    for before, after in path:
        node = h("".join([*before, node, *after]))
    return node


def merkle_rows():
    draw = random.Random(3)
    rows = [(i, draw.choice(["hot", "hot", "b", "é", "B"]), "en", len(t or ""), t) for i, t in ROWS]
    rows += [(1000 + i, "hot", None, None, f"line {i}\nnext\n") for i in range(200)]
    rows += [(5, None, "en", 1, "x"), (6, None, None, None, None), (3, "", "en", 0, ""), (1, "alone", "de", 3, "a\nb"), (9, "twice", "de", 1, "y"),
             (9, "twice", "de", 1, "y"), (9, "twice", "de", 1, "z")]
    return rows


def test_merkle_against_plain(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "RANGE_ROWS", 7)
    rows = merkle_rows()
    kind = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string, siblings int, node int, place int"
    docs = spark.createDataFrame([(*r, 1, "t", 2, 3, 4) for r in rows], kind).repartition(5)
    node = merkle_manifest.leaf([docs[c] for c in merkle_manifest.FIELDS])
    made = merkle_manifest.build(docs, node)
    got = made.proofs()
    assert got.columns == [*docs.columns, "leaf_", "subroot", "root", "siblings_"]
    folded = got.withColumns({"proof": merkle_manifest.proof_text(F.col("siblings_")), "up": merkle_manifest.fold(F.col("leaf_"), F.col("siblings_")),
                              "wrong": merkle_manifest.fold(F.lit("0" * 64), F.col("siblings_"))}).collect()
    expect = plain_manifest(rows)
    assert Counter((low(r.doc_id), r.leaf_, r.subroot, r.root, r.proof) for r in folded) == Counter(
        (i, leaf, sub, root, "".join(x for b, a in path for x in [*b, *a])) for i, leaf, sub, root, path, _ in expect)
    assert all(r.up == r.root == made.root() and r.wrong != r.root for r in folded)
    # Only every third level is stored.
    sizes = [t.where(F.col("levels") > 4).count() for t in made.sources.stored]
    assert sizes[1] == -(-sizes[0] // 27) and len(sizes) == 3


def test_merkle_small_tables(spark):
    docs = spark.createDataFrame([(1, "s", "en", 1, "x")], "doc_id long, source string, lang string, n_chars long, text string")
    node = merkle_manifest.leaf([docs[c] for c in merkle_manifest.FIELDS])
    one = merkle_manifest.build(docs, node).proofs().first()
    assert one.leaf == one.subroot == one.root == plain_leaf((1, "s", "en", 1, "x")) and one.siblings == []
    none = merkle_manifest.build(docs.limit(0), node)
    assert none.root() is None and none.proofs().count() == 0


def test_merkle_query_on_awkward_rows(spark, tmp_path):
    """The query against its SQL and against the plain tree, with tampered texts."""
    rows = merkle_rows()
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, g, s, n) for i, s, g, n, t in rows], kind).repartition(1).write.parquet(str(tmp_path / "d"))
    (file,) = (tmp_path / "d").glob("*.parquet")
    file.rename(tmp_path / "documents.parquet")
    got = queries.op12_merkle_checkpoints(spark, str(tmp_path)).toArrow()
    expect = []
    for i, leaf, sub, root, path, r in plain_manifest(rows):
        cut = r[4] is not None and r[0] is not None and crc32(str(r[0]).encode()) % 2 == 0
        up = climbed(plain_leaf((*r[:4], r[4].replace("\n", "") if cut else r[4])), path)
        expect.append((r[0], leaf, sub, root, hexed("".join(x for b, a in path for x in [*b, *a]).encode()), up, up == root))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(zip(*[got.column(c).to_pylist() for c in names])) == Counter(expect)
    assert {v for *_, v in expect} == {True, False}
    sql = connect(str(tmp_path)).execute(queries.ORACLES["op12_merkle_checkpoints"]).to_arrow_table()
    assert table_rows(sql)[1] == table_rows(got)[1]


# SimHash

def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def plain_components(fps, budget=4):
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def clustered(seed, roots=40, size=20, flips=6):
    draw = np.random.default_rng(seed)
    out = set()
    for _ in range(roots):
        base = int(draw.integers(0, 2**63)) * 2
        for _ in range(draw.integers(1, size)):
            value = base
            for bit in draw.choice(64, draw.integers(0, flips), replace=False):
                value ^= 1 << int(bit)
            out.add(value)
    return np.array(sorted(out), dtype=np.uint64)


def by_links(fps, links):
    place = {int(f): i for i, f in enumerate(fps)}
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(place[int(a)]), root(place[int(b)])
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_fingerprints():
    for text in [None, "", " \n", "One", "a b c", "A b C d", "a b c d e", "É é À B", "x" * 5000, "a\x0bb\x0cc\x1cd\x85e f g", *[t for _, t in ROWS]]:
        assert simhash_trie.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_stretches(monkeypatch):
    monkeypatch.setattr(simhash_trie, "STRETCH", 7)
    assert all(simhash_trie.fingerprint(t) == plain_fingerprint(t) for _, t in ROWS[-20:])


@pytest.mark.parametrize("seed", range(6))
def test_trie_walk(monkeypatch, seed):
    """All links are found, and only a forest of them is kept, inside a subtree and between two."""
    if seed % 2:
        monkeypatch.setattr(simhash_trie, "FRONTIER", 16)
        monkeypatch.setattr(simhash_trie, "COMPARED", 8)
    fps = clustered(seed)
    a, b = simhash_trie.walk(fps, None, 0, 0)
    assert by_links(fps, zip(a, b)) == plain_components([int(f) for f in fps]) and len(a) < len(fps)
    # Between the two halves of the trie: the same components together with those inside the halves.
    half = np.searchsorted(fps, np.uint64(1 << 63))
    links = [pair for part in (simhash_trie.walk(fps[:half], None, 1, 0), simhash_trie.walk(fps[half:], None, 1, 0),
                               simhash_trie.walk(fps[:half], fps[half:], 1, 1)) for pair in zip(*part)]
    assert all((int(x) ^ int(y)).bit_count() <= 4 for x, y in links)
    assert by_links(fps, links) == plain_components([int(f) for f in fps])


@pytest.mark.parametrize("limit", [3, 50, None])
def test_links_over_cut_subtrees(spark, limit):
    fps = clustered(9)
    fps = np.unique(np.concatenate([fps, np.arange(40, dtype=np.uint64), np.array([0, 2**64 - 1, 2**63], dtype=np.uint64)]))
    nodes = spark.createDataFrame([(int(f) - (1 << 64) if f >= 1 << 63 else int(f),) for f in fps], "fp long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash_trie.linked(nodes, limit=limit).collect()]
    assert by_links(fps, links) == plain_components([int(f) for f in fps])


def test_simhash_classes(spark):
    docs = frame(spark, ROWS).repartition(4)
    got = simhash_trie.classes(docs, limit=10)
    fps = [plain_fingerprint(t) for _, t in ROWS]
    of = plain_components(fps)
    least = {}
    for c, (i, _) in zip(of, ROWS):
        least[c] = min(least.get(c, math.inf), math.inf if i is None else i)
    expect = Counter((low(i), f"{f:016x}", least[c]) for (i, _), f, c in zip(ROWS, fps, of))
    assert Counter((low(r.doc_id), r.fingerprint, math.inf if r.component_id is None else r.component_id) for r in got.collect()) == expect
    assert max(Counter(of).values()) > 5
    assert simhash_trie.classes(docs.limit(0)).count() == 0
