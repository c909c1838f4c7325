"""Secrets, line rules, sharding, tokens, packing, pages and the classifier against plain versions."""

import random
import re
import time
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from logwarden.llm import (bitmap_bpe, factor_quality, feistel_shards, html_tree, lexical_packing, line_rules, queries,
                           secret_links)
from tests.llm.plain import WORD, awkward, frame, hexed

ROWS = awkward()
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def low(doc_id):
    return -1 if doc_id is None else doc_id


# Secrets

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def strong(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def ordinary(found):
    """Whether the value of a named secret is short and letters of one case, or capitalised, up to sentence marks."""
    value = re.split("[:=]", found, maxsplit=1)[1].lstrip(" ").removeprefix('"').removeprefix("'")
    value = value[value[:1] in ("(", "["):].rstrip(".,;:!?)]")
    letters = re.sub("['\u2019-]", "", value[1:])
    return (len(value) <= 16 and all(c.isalpha() for c in value[:1] + letters)
            and (value == value.upper() or letters == letters.lower()))


def linked(text, reach=secret_links.REACH):
    """All spans, every part compared with every other."""
    parts = [(*s, "id" if s[3] == "access" else "secret") for s in strong(text)]
    own = len(parts)
    for k, (kind, (role, pattern)) in enumerate(secret_links.WEAK.items()):
        pattern = pattern.replace("(?i:", "(?ai:")
        parts += [(m.start(), 3 + k, m.end(), kind, "word" if kind == "pass" and ordinary(m[0]) else role)
                  for m in re.finditer(pattern, text)]

    def near(p, role):
        return any((o[4] == role or role == "secret" and o[4] == "word") and o is not p and o[0] - p[2] <= reach and p[0] - o[2] <= reach for o in parts)

    out = parts[:own]
    for p in parts[own:]:
        inside = any(o[0] < p[2] and p[0] < o[2] for o in parts[:own])
        complete = near(p, "secret") if p[4] == "id" else near(p, "id") or near(p, "place") if p[4] == "secret" else near(p, "id") if p[4] == "word" else near(p, "id") and near(p, "secret")
        if complete and not inside:
            out.append(p)
    return sorted(out)


def test_secret_spans(spark):
    draw = random.Random(2)
    bits = ["user=alice ", "pwd: s3cr3tt ", "host=a.b.c ", "https://x.io/p ", "token='abcdefgh1' ", "AKIA" + "B" * 14 + " ", "word " * 9,
            "é🙂 ", "f" * 33 + " ", "password=12 ", "Aa1" * 13 + "Z ", "x" * 90 + " ", "secret: we ", "Passwd: Here, ", "auth=LOUD! "]
    texts = [t for _, t in ROWS] + ["".join(draw.choice(bits) for _ in range(draw.randrange(1, 40))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] * 2
    got = Counter((r.doc_id, tuple((s.start, s["rank"], s.end, s.kind) for s in r.spans)) for r in secret_links.scan(frame(spark, rows)).collect())
    assert got == Counter({(i, tuple(s[:4] for s in linked(t or ""))): 2 for i, t in enumerate(texts)})
    assert any(kind == "user" for _, spans in got for _, _, _, kind in spans)
    assert secret_links.scan(frame(spark, rows).limit(0)).count() == 0


def test_ordinary_credentials(spark):
    """Pairs written by hand, with what must be reported."""
    key, long = "AKIA" + "Q7" * 8, "aB3" * 20
    pairs = [
        ("user=admin password=hunter2", ["user=admin", "password=hunter2"]),
        ("login: bob / secret: abc1234", ["login: bob", "secret: abc1234"]),
        (f"{key} secret=short", [key, "secret=short"]),
        ("password=Pa$$w0rd99 user=bob", ["password=Pa$$w0rd99", "user=bob"]),
        ("DB_USER=admin DB_PASS=hunter2xyz host=db.example.org", ["USER=admin", "PASS=hunter2xyz", "host=db.example.org"]),
        ("db-user: eve api-key: x1", ["user: eve", "api-key: x1"]),
        (f"login=carol {long}", ["login=carol", long]),
        (f"login=carol {long[:30]}", ["login=carol", long[:30]]),
        (f"login=carol {long[:40]}", ["login=carol", long[:40]]),
        ("The secret: we walked far and read https://www.example.org/walks", []),
        ("a token = love, see https://www.example.org/poems", []), ("Auth: required. See https://www.example.org/help", []),
        ("secret=x7, see https://db.example.org", ["secret=x7,", "https://db.example.org"][:1]),
        ("user=admin secret=swordfish! https://db.example.org", ["user=admin", "secret=swordfish", "https://db.example.org"]),
        ("user=admin pass: letmein", ["user=admin", "pass: letmein"]),
        ("password=hunter2", []), ("token: abc", []), (long, []), ("superuser=admin compass=hunter2", []),
        ("https://www.example.org/News/2020/A-long-way-to-the-Sea-and-back-again", [])]
    got = secret_links.scan(frame(spark, list(enumerate(t for t, _ in pairs)))).collect()
    assert {r.doc_id: [pairs[r.doc_id][0][s.start:s.end] for s in r.spans] for r in got} == {i: e for i, (_, e) in enumerate(pairs)}


def test_many_parts_in_one_text(spark):
    """Tens of thousands of matches in one text take seconds; what is reported stays exact."""
    one, n = "user=bob1 pwd=abc\u00e91 ", 30000
    docs = frame(spark, [(1, one * n)])
    since = time.monotonic()
    spans = secret_links.scan(docs).collect()[0].spans
    assert time.monotonic() - since < 60
    assert [(s.start, s.end) for s in spans] == [(k * len(one) + a, k * len(one) + b) for k in range(n) for a, b in ((0, 9), (10, 19))]
    since = time.monotonic()
    assert secret_links.redact(docs).first().text == "[REDACTED] [REDACTED] " * n
    assert time.monotonic() - since < 60


def test_redacted(spark):
    docs = frame(spark, ROWS)
    clean = secret_links.redact(docs)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    expect = Counter()
    for i, t in ROWS:
        out, at = "", 0
        for start, _, end, _, *_ in linked(t or ""):
            if start >= at and not (start == at and at):
                out += t[at:start] + "[REDACTED]"
            at = max(at, end)
        expect[low(i), t if not at else out + t[at:]] += 1
    assert Counter((low(r.doc_id), r.text) for r in clean.collect()) == expect
    assert clean.where("n_chars <> length(text)").count() == 0


# Line rules


def base(text):
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    seen, same = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            same += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), same, len(covered), failed


def test_line_rules(spark):
    got = line_rules.judge(frame(spark, ROWS)).collect()
    assert Counter((low(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter(
        (low(i), *base(t or "")) for i, t in ROWS)
    by = {r.doc_id: r for r in got}
    assert by[25].clean_text == "A plain sentence stands here, and it is long enough to stay." and by[25].n_bad_lines == 2
    assert not by[26].kept and not by[27].kept and not by[1].kept
    assert all(not r.kept for r in got if r.base_failed)
    assert line_rules.judge(frame(spark, ROWS).limit(0)).count() == 0


PROSE = "The harbour was quiet that morning, and nobody had seen the boats leave before dawn."
MENU = ["Home", "About us", "Our products", "Contact", "Log in"]
LINES = {  # lines, and the places of those that go
    "menu": (MENU, {0, 1, 2, 3, 4}),
    "menu around blank lines": (["Home", "", "About us", " ", "Products", "Contact"], {0, 2, 4, 5}),
    "menu at the end": ([PROSE, PROSE, *MENU], {2, 3, 4, 5, 6}),
    "three short lines": (["A title", "By its author", "Monday", PROSE], set()),
    "short lines that end": (["Yes.", "No!", "Why?", "Well, then:", PROSE], set()),
    "menu cut by a sentence": (["Home", "About us", "Contact", "It is here.", "Log in", "Help", "More"], set()),
    "one comma does not free a line": (["one, two three four five six seven eight nine ten eleven twelve"], {0}),
    "closing quotes": (["\u201cone two three four five six seven eight nine ten eleven twelve.\u201d)  "], set()),
    "wrapped prose": (["one two three four five six seven eight nine ten eleven twelve", "thirteen fourteen, and so it ends."], set()),
    "next line starts anew": (["one two three four five six seven eight nine ten eleven twelve", "Thirteen fourteen, and so it ends."], {0}),
    "eleven words": (["one two three four five six seven eight nine ten eleven"], set()),
    "other languages": (["Alle Rechte vorbehalten.", "Tous droits réservés.", "Todos los derechos reservados.", PROSE], {0, 1, 2}),
    "inside a word": (["The xlorem ipsum of it.", "(lorem ipsum) it says."], {1}),
}


def test_lines_that_go(spark):
    names = list(LINES)
    got = line_rules.judge(frame(spark, [(i, "\n".join(LINES[name][0])) for i, name in enumerate(names)])).collect()
    for r in got:
        lines, gone = LINES[names[r.doc_id]]
        stay = [line for i, line in enumerate(lines) if i not in gone and line.strip()]
        assert (r.n_bad_lines, r.clean_text) == (len(gone), "\n".join(stay)), names[r.doc_id]


def test_line_rules_equal_their_sql(spark):
    """Verdicts on hand-made lines, in documents long enough to pass the base rules."""
    words = " ".join(f"w{i}" for i in range(30)) + "."
    rows = [(i, "\n".join([words[:n], *lines])) for i, (lines, _) in enumerate(LINES.values()) for n in (0, 40, 200)]
    rows = [(100 * i + k, t) for k, (i, t) in enumerate(rows)] + ROWS
    docs = frame(spark, rows)
    got = line_rules.judge(docs).select("doc_id", "n_words", "base_failed", "kept")
    documents = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    with duckdb.connect() as base:
        base.register("documents", documents)
        told = base.execute(f"SELECT doc_id, n_words, base_failed, kept FROM ({queries.ORACLES['op5_line_rules']}) x").fetchall()
    assert Counter(tuple(r) for r in got.collect()) == Counter(told)
    assert {r[3] for r in told} == {True, False}


# Sharding


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 37, 100, 1000, 1001])
def test_permutation(spark, n):
    rows = spark.range(n).select("id", feistel_shards.permute(F.col("id"), max(n, 1), 3).alias("p"))
    back = rows.select("id", "p", feistel_shards.permute(F.col("p"), max(n, 1), 3, inverse=True).alias("b")).collect()
    assert sorted(r.p for r in back) == list(range(n)) and all(r.b == r.id for r in back)


def test_shards(spark):
    got = feistel_shards.shard(frame(spark, ROWS).repartition(6)).collect()
    data = [(t or "").encode() for _, t in ROWS]
    assert Counter((low(r.doc_id), r.size, r.text_crc32) for r in got) == Counter((low(i), len(d) + 1, crc32(d)) for (i, _), d in zip(ROWS, data))
    numbers = sorted(((-1 if i is None else i), len(d) + 1, crc32(d)) for (i, _), d in zip(ROWS, data))
    assert [(low(r.doc_id), r.size, r.text_crc32) for r in sorted(got, key=lambda r: r.row_number)] == numbers
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1
    again = feistel_shards.shard(frame(spark, list(reversed(ROWS))).repartition(2)).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in got) == Counter((r.doc_id, r.shard, r.slot) for r in again)
    assert feistel_shards.shard(frame(spark, ROWS).limit(0)).count() == 0


# Tokens


def test_byte_bpe(spark):
    ranks = bitmap_bpe.read_ranks(RANKS)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*ROWS, (900, "a" * 40000), (901, "".join(random.Random(1).choice("abcdef") for _ in range(30000))), (902, "<|endoftext|>\x00 \x1c\x85")]
    got = bitmap_bpe.round_trip(frame(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    expect = Counter()
    for i, t in rows:
        ids = plain.encode_ordinary(t or "")
        expect[low(i), len(ids), hexed(np.array(ids, "<u4").tobytes()), hexed((t or "").encode())] += 1
    assert Counter((low(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == expect
    docs = frame(spark, rows)
    back = bitmap_bpe.decode(bitmap_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert Counter(bytes(r.decoded) for r in back.collect()) == Counter((t or "").encode() for _, t in rows)
    assert bitmap_bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def packed(rows, got):
    """Pieces against the tokenizer: every id once, sequences gapless and of allowed sizes."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    whole = Counter(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for _, t in rows)
    by_size = defaultdict(set)
    for ids in whole:
        by_size[len(ids)].add(ids)
    sequences, total = defaultdict(list), 0
    for r in got:
        assert r.start + r.length <= r.doc_tokens and r.length > 0
        assert any(crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for ids in by_size[r.doc_tokens])
        sequences[r.sequence_id].append((r.offset, r.length))
        total += r.length
    assert total == sum(len(ids) * n for ids, n in whole.items())
    starts = Counter((low(r.doc_id), r.doc_tokens) for r in got if r.start == 0)
    assert starts == Counter((low(i), len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding == 0


@pytest.mark.parametrize("shard_tokens", [1 << 23, 9000])
def test_packing(spark, shard_tokens):
    packed(ROWS, lexical_packing.pack(frame(spark, ROWS), WORD_BPE, shard_tokens).collect())
    assert lexical_packing.pack(frame(spark, ROWS).limit(0), WORD_BPE).count() == 0


def test_chunks_are_encoded_as_whole_texts():
    own, draw = lexical_packing.Tokens(WORD_BPE), random.Random(6)
    assert own.direct
    bits = ["a", "Ab", "ÉTÉ", "Σ", "ς", " ", "  ", "\n", "\t", "é", "é", "́", "日本", "🙂", "'s", "'LL", "12", "१", "<|endoftext|>", "İ", "ß",
            "ẞ", "K", "ﬂ", "...", ".,", "\x85", "\xa0", "\x00", "word.", "Word,", "\x1c"]
    for _ in range(2000):
        text = "".join(draw.choice(bits) for _ in range(draw.randrange(25)))
        assert np.frombuffer(own.encode(text), own.kind).tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("cached, learnt, direct", [(600_000, 4096, True), (7, 3, True), (7, 3, False)])
def test_texts_are_encoded_together(monkeypatch, cached, learnt, direct):
    """Many texts at once give the ids of each alone, with small memories too, and where words cannot go to the merges."""
    monkeypatch.setattr(lexical_packing, "CACHED", cached)
    monkeypatch.setattr(lexical_packing, "LEARNT", learnt)
    own, draw = lexical_packing.Tokens(WORD_BPE), random.Random(8)
    own.direct = direct
    bits = ["harbour", "Harbour,", "HARBOUR.***", "straße", "STRASSE", "Straße;", "ẞ", "été:", "ÉTÉ", "E\u0301te\u0301", "h\u0331", "H\u0331", "***", ",", "a,b",
            "word?!", "don't", "o'll.", "<|endoftext|>", "<|endoftext|>.", "<|ENDOFTEXT|>", "İ.", "K,", "ſ", "12,", "", "\t", "日本,", "\u0301.", "x" * 60, "Y" * 60 + ",",
            "\x1f", "\x00"]
    texts = ["", " ", "\n\n", *["".join(draw.choice(bits) + draw.choice([" ", " ", "\n", ""]) for _ in range(draw.randrange(25))) for _ in range(600)]]
    for at in range(0, len(texts), 150):
        column = pa.array(texts).slice(at, 150)
        ids, sizes = own.encode_all(column)
        plain = [own.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in column.to_pylist()]
        assert sizes.tolist() == list(map(len, plain))
        assert ids.tolist() == [i for p in plain for i in p]


def test_new_words_go_to_the_merges_together():
    own, calls = lexical_packing.Tokens(WORD_BPE), []
    own.tokenize = own.tokenizer = None  # what would be asked chunk by chunk
    for mark in lexical_packing.MARKS:
        own[mark] = b""
    learn, own._learn = own._learn, lambda words: (calls.append(words), learn(words))
    ids, sizes = own.encode_all(pa.array(["harbour Harbour, vessel\nVESSEL. sailor", "straße Straße été"]))
    assert [sorted(c) for c in calls] == [["harbour", "sailor", "vessel"], ["straße", "été"]]
    whole = lexical_packing.Tokens(WORD_BPE).tokenizer.encode_batch(["harbour harbour vessel vessel sailor", "straße straße été"], add_special_tokens=False)
    assert ids.tolist() == [*whole[0].ids, 2, *whole[1].ids, 2] and sizes.sum() == len(ids)


@pytest.mark.parametrize("sizes", [[], [0, 0, 0], [5, 50, 5, 5], [10] * 7, [0] * 25, [3, 0, 99, 0, 0, 99, 1]])
def test_stretches_hold_every_row_once(monkeypatch, sizes):
    monkeypatch.setattr(lexical_packing, "STRETCH", 20)
    monkeypatch.setattr(lexical_packing, "STRETCH_ROWS", 8)
    rows = pa.record_batch([pa.array(range(len(sizes)), pa.int64()), pa.array(["x" * n for n in sizes], pa.string())], ["id", "t"])
    for cut in (1, 3, 100):
        found = list(lexical_packing.stretches((rows.slice(a, cut) for a in range(0, len(sizes), cut)), 1))
        assert [i for b in found for i in b.column(0).to_pylist()] == list(range(len(sizes)))
        for b, after in zip(found, [*found[1:], None]):
            texts = [len(t) for t in b.column(1).to_pylist()]
            assert 0 < len(texts) <= 8 and (sum(texts) <= 20 or len(texts) == 1)
            # Only what does not fit opens the next one.
            assert after is None or len(texts) == 8 or sum(texts) + len(after.column(1)[0].as_py()) > 20


def test_neighbours_share_a_window():
    """Documents of one subject meet in one window."""
    docs = []
    for subject in range(6):
        for _ in range(10):
            docs.append(np.append(np.random.default_rng(len(docs)).integers(1000 * subject + 10, 1000 * subject + 60, 400), 2).astype(np.uint16))
    order = np.random.default_rng(0).permutation(len(docs))
    idf = np.zeros(7000, np.float32)
    for d in docs:
        idf[np.unique(d)] += 1
    idf = np.log1p((len(docs) - idf + 0.5) / (idf + 0.5)).astype(np.float32)
    pieces = lexical_packing.pack_shard([docs[i] for i in order], idf, 401.0)
    alike = Counter()
    for d, _, length, sequence, _ in pieces:
        alike[sequence, int(order[d]) // 10] += length
    first = max(n for (sequence, _), n in alike.items() if sequence == 0)
    assert first > 0.9 * 4000


def shard_of(seed, n, vocabulary=400, longest=20):
    """Short documents of Zipf-like terms, with the weights of their corpus."""
    draw = np.random.default_rng(seed)
    docs = [np.append(np.minimum(10 + draw.zipf(1.3, draw.integers(1, longest)), vocabulary - 1), lexical_packing.END).astype(np.uint16) for _ in range(n)]
    df = np.zeros(vocabulary)
    for d in docs:
        df[np.unique(d)] += 1
    return docs, np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32), sum(map(len, docs)) / n


def plain_bm25(docs, idf, mean, seed):
    scores = []
    for d in docs:
        tf = Counter(d.tolist())
        norm = 1.2 * (1 - 0.75 + 0.75 * len(d) / mean)
        scores.append(sum(float(idf[t]) * tf[t] * 2.2 / (tf[t] + norm) for t in set(docs[seed].tolist()) - {lexical_packing.END} if t in tf))
    return scores


def test_nearest_is_plain_bm25(monkeypatch):
    """With a pool that holds the shard the order is that of plain BM25; with a small one its head holds exact scores too."""
    docs, idf, mean = shard_of(3, 120)
    index = lexical_packing.Index(docs, idf, mean)
    monkeypatch.setattr(lexical_packing, "POOL", len(docs))
    for seed in range(0, len(docs), 7):
        unused = np.arange(len(docs)) % 3 != 1
        unused[seed] = False
        plain = plain_bm25(docs, idf, mean, seed)
        found = list(index.nearest(seed, unused))
        assert sorted(found) == [i for i in range(len(docs)) if unused[i] and plain[i] > 0]
        assert [plain[i] for i in found] == pytest.approx(sorted((plain[i] for i in found), reverse=True), rel=1e-5)
    monkeypatch.setattr(lexical_packing, "POOL", 5)
    again = list(index.nearest(seed, unused))
    assert sorted(again) == sorted(found)
    assert again[:5] == [i for i in found if i in again[:5]]


def test_asking_with_few_terms_scores_again_with_all(monkeypatch):
    docs, idf, mean = shard_of(4, 80, longest=60)
    index = lexical_packing.Index(docs, idf, mean)
    monkeypatch.setattr(lexical_packing, "QUERY_TERMS", 4)
    unused = np.ones(len(docs), bool)
    for seed in range(0, len(docs), 5):
        found = list(index.nearest(seed, unused))[:lexical_packing.POOL]
        plain = plain_bm25(docs, idf, mean, seed)
        assert index.whole_scores(seed, np.array(found)).tolist() == pytest.approx([plain[i] for i in found], rel=1e-5)
        assert [plain[i] for i in found] == pytest.approx(sorted((plain[i] for i in found), reverse=True), rel=1e-5)


def dealt(spark, texts, shard_tokens):
    rows, seen = lexical_packing.tokenised(frame(spark, texts), WORD_BPE)
    own = lexical_packing.tokens(WORD_BPE)
    idf, _ = lexical_packing.corpus_weights(rows, seen, own.size)
    return lexical_packing.dealt(rows, idf, own.kind, shard_tokens).collect()


def test_shards_go_by_content_and_hot_rows_spread(spark):
    """Documents of one subject share shards; equal rows, most of the table, spread over shards of even size."""
    subjects = ["harbour vessel anchor sailor", "violin sonata orchestra cello", "enzyme protein genome bacteria", "glacier summit climber avalanche"]
    draw = random.Random(2)
    texts = [(i, " ".join(draw.choices(subjects[i % 4].split(), k=30))) for i in range(400)]
    found = dealt(spark, texts, 4000)
    by_shard = Counter((r["shard"], r["doc_id"] % 4) for r in found)
    whole = Counter(r["shard"] for r in found)
    assert len(whole) > 4
    assert sum(max(by_shard[s, k] for k in range(4)) for s in whole) > 0.7 * len(texts)

    hot = [(7, "the same words in every row")] * 600 + [(None, None)] * 600 + texts[:100]
    found = dealt(spark, hot, 3000)
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["n_tokens"] + lexical_packing.ROW_SHARE
    assert len(found) == len(hot) and len(sizes) > 10
    assert max(sizes.values()) < 2 * 3000
    packed(hot, lexical_packing.pack(frame(spark, hot), WORD_BPE, 3000).collect())


# Pages

FURNITURE = """<header><a href=/>Site name</a></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies, and so on, and so forth, really.</div>"""
SIDE = """<aside><p>Other things, that are long, and have commas, but stand aside.</p></aside><div id=comments><p>First comment, it is long,
and it has commas, too.</p></div><form><label>Name</label><input value=x></form><footer>&copy; 2020, all, rights</footer>"""


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>short", "short"), ("<!-- never ends", ""), ("<script>if (a<b) {", ""),
    (f"<html><head><title>t</title><style>p{{}}</style></head><body>{FURNITURE}<article><h1>Title &amp; more</h1><p><b>First paragraph,\n with&nbsp;markup"
     f"<br><p>Second, and <i>last</i>.</article>{SIDE}", "Title & more\nFirst paragraph, with markup\nSecond, and last."),
    (f"<body>{FURNITURE}<div class=wrap><div class=content><h2>Head</h2><p>{'Long words, many of them. ' * 8}</p><ul><li>one<li>two</ul>"
     f"<div class='ad'>Buy, now, please, it is cheap.</div><p>End, of the text.</p></div></div>{SIDE}</body>",
     f"Head\n{('Long words, many of them. ' * 8).strip()}\none\ntwo\nEnd, of the text."),
    ('<body><p title="a > b">Quoted, attribute values, do not end a tag.</p><table><tr><td>cell one<td>cell two</table>',
     "Quoted, attribute values, do not end a tag.\ncell one\ncell two"),
])
def test_main_text(html, text):
    assert html_tree.main_text(html) == text


LONG = ("Long words, many of them, stand here. " * 6).strip()


@pytest.mark.parametrize("name", ["class='content has-sidebar'", "class=no-sidebar", "class=layout-sidebar", "class='page-with-banner'", "id=legal-news"])
def test_wrappers_named_like_furniture(name):
    body = f"{FURNITURE}<div {name}><p>{LONG}</p><p>{LONG}</p><div class=sidebar><p>Aside, and short, it goes.</p></div></div>{SIDE}"
    assert html_tree.main_text(f"<body>{body}</body>") == f"{LONG}\n{LONG}"
    body = f"{FURNITURE}<div {name}><article><p>{LONG}</p></article></div>{SIDE}"
    assert html_tree.main_text(f"<body>{body}</body>") == LONG


def test_pages_of_word_cuts_only():
    assert html_tree.main_text("<body><div class=comments><p>All, that is here, are remarks.</p></div></body>") == "All, that is here, are remarks."
    long = f"<div class=post-comments><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
    assert html_tree.main_text(f"<body><div class=entry><p>{LONG} End.</p></div>{long}</body>") == f"{LONG} End."


def test_link_lists_between_blocks():
    links = "<ul><li><a href=/1>Source one</a><li><a href=/2>Source two</a></ul>"
    html = f"<body><article>{links}<p>{LONG}</p>{links}<p>{LONG}</p>{links}</article></body>"
    assert html_tree.main_text(html) == f"{LONG}\nSource one\nSource two\n{LONG}"


def test_pages_in_depth(spark):
    deep = "<div>" * 30000 + "<p>Deep, inside, of everything, there is text." + "</div>" * 30000
    pages = spark.createDataFrame([(1, "u", deep, 3), (2, None, None, 4), (2, None, None, 4), (None, "v", "<p>a</p><p>b</p>", 5)],
                                  "page_id long, url string, html string, text int")
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in html_tree.extract(pages).collect())
    deep_text = "Deep, inside, of everything, there is text."
    assert got == Counter({(1, "u", deep_text, len(deep_text)): 1, (2, None, "", 0): 2, (None, "v", "a\nb", 3): 1})
    assert html_tree.extract(pages.limit(0)).count() == 0


def test_given_pages(spark):
    """The article of every test page, its blocks told apart by a plain pattern."""
    from html import unescape

    pages = queries.table(spark, "/root/testdata/sf0.001", "pages")
    got = {r.page_id: r.text for r in html_tree.extract(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(filter(None, blocks))


# Classifier


def test_identity():
    """The linear-time score equals the sum over all pairs."""
    draw = np.random.default_rng(0)
    model = factor_quality.Machine(0.3, draw.normal(size=factor_quality.WIDTH).astype(np.float32),
                                   draw.normal(size=(factor_quality.WIDTH, factor_quality.FACTORS)).astype(np.float32))
    index, value = draw.integers(0, factor_quality.WIDTH, 12), draw.normal(size=12).astype(np.float32)
    pairs = sum(model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j] for i in range(12) for j in range(i))
    assert np.isclose(model.raw(index, value, np.array([0]))[0], 0.3 + model.weights[index] @ value + pairs, rtol=1e-4)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    got = queries.op1_factor_quality(spark, sf_dir).collect()
    unseen = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert len(unseen) > 50 and sum(a == b for a, b in unseen) >= 0.95 * len(unseen)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)


def test_scores_of_awkward_rows(spark):
    docs = frame(spark, ROWS)
    labels = spark.createDataFrame([(i, k % 2, 0) for k, i in enumerate(range(10, 30))] + [(None, 1, 0), (15, 1, 0), (16, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = factor_quality.fit(docs, labels)
    got = factor_quality.score(docs, model, name="own").collect()
    assert len(got) == len(ROWS) and all(0 <= r.own <= 1 and r.fm_score == 0.25 for r in got)
    one_kind = factor_quality.fit(docs, labels.where("quality = 1"))
    assert len({r.s for r in factor_quality.score(docs, one_kind, ["doc_id"], "s").collect()}) == 1
    assert factor_quality.score(docs.limit(0), factor_quality.fit(docs.limit(0), labels.limit(0))).count() == 0
