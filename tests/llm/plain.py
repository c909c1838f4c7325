"""Plain versions of the text operators, and a fixture with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, spans string, "
          "digest string, class_id string, _place string, _id int, fm_score double, _text_key string, row_number int, shard string")


def awkward() -> list[tuple[int | None, str | None]]:
    """Null ids and texts, empty and very long texts, ties, repeated rows, near copies, shared passages."""
    draw = random.Random(5)

    def words(n: int, size: int = 400) -> list[str]:
        return [f"w{draw.randrange(size)}" for _ in range(n)]

    base, passage = words(150, 4000), " ".join(words(120, 5000))
    rows: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two three four"), (6, "one two three four five"),
        (7, "one two three four five"), (7, "one two three four five"), (8, "same text"), (None, "same text"), (9, "same  text"),
        (None, None), (10, "é" * 300 + " ü x 🙂🙂 " + "é" * 300), (11, "the end. " * 3000), (12, "abc" * 500), (13, "a" * 2500),
        (14, " ".join(base)), (15, " ".join(base)), (16, " ".join(words(40)) + "\n" + passage + "\n" + " ".join(words(30))),
        (17, passage + " " + " ".join(words(60))), (18, " ".join(words(9000, 3000))),
        (19, 'user = bob1\npassword: "hunter22xyz"\nhttps://db.example.com/x'), (20, "token=" + "deadbeef" * 5 + " AKIA" + "Z9" * 10),
        (21, "x" * 500 + " https://far.example.com " + "y" * 500), (22, "pwd=abcd1 " + "z " * 300 + "login=carol"),
        (23, "login=carol pwd=abcd1 host: db7.example.org"), (24, "AKIA" + "A" * 11 + " AKIAB secret=short api_key==longenough1"),
        (25, "home | about | contact | help\nA plain sentence stands here, and it is long enough to stay.\nall rights reserved"),
        (26, "a b c d e f g h\n" * 6), (27, "### $$$ %%% &&& " * 10)]
    for i in range(24):
        near = list(base)
        for _ in range(draw.randrange(4)):
            near[draw.randrange(len(near))] = f"n{draw.randrange(10**6)}"
        rows.append((100 + i, " ".join(near)))
    for i in range(12):
        rows.append((200 + i, " ".join(words(30)) + ". " + passage[:draw.randrange(300, 560)] + "\n" + " ".join(words(30))))
    return rows


def frame(spark, rows):
    """Documents with extra columns whose names operators might use themselves."""
    return spark.createDataFrame(
        [(i, t, "en", "src", None if t is None else len(t), 0.5, "k", "s", "d", "c", "p", 1, 0.25, "t", 9, "x") for i, t in rows], SCHEMA)


def shingle_set(text: str | None) -> frozenset:
    words = (text or "").encode().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def links(rows, least: float = 0.8) -> list[tuple[int, int]]:
    """Positions of rows whose shingle sets are similar."""
    sets = [shingle_set(t) for _, t in rows]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    shared = Counter((a, b) for at in where.values() for k, a in enumerate(at) for b in at[k + 1:])
    return [(a, b) for (a, b), n in shared.items() if n >= least * (len(sets[a]) + len(sets[b]) - n) - 1e-9]


def repeated_bytes(texts: list[bytes], length: int = 400) -> list[list[bool]]:
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover, until = [False] * len(t), 0
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                for k in range(max(i, until), i + length):
                    cover[k] = True
                until = i + length
        out.append(cover)
    return out


def hexed(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
