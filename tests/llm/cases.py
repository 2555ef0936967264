"""Small awkward tables shared by the tests of this folder."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens int, fp string, ids string, text_len int"
BENCH_SCHEMA = "item_id long, text string, win string"


def words(rnd: random.Random, n: int, vocab: int = 300) -> str:
    return " ".join(f"w{rnd.randrange(vocab)}x" for _ in range(n))


def documents(seed: int = 3) -> list[tuple]:
    """Nulls, empty texts, one-word texts, copies, near copies, shared
    passages, repeated rows, odd white space, non-ASCII letters, one long text."""
    rnd = random.Random(seed)
    passage, other = words(rnd, 90), words(rnd, 60)
    texts: list = [None, "", " ", "one", "One", "two words", "\n\t", "É é ÀB ab", "😀 smile 😀", "a" * 900, "ab " * 400]
    copy = words(rnd, 120)
    texts += [copy] * 6 + [copy + " tail", copy.upper(), copy.replace("w1", "v1", 1)]
    texts += [words(rnd, 20) + " " + passage + " " + words(rnd, 15) for _ in range(4)]
    texts += [words(rnd, 8) + "\n" + other + "." + words(rnd, 30) for _ in range(3)]
    texts += [words(rnd, rnd.randint(1, 200)) for _ in range(25)]
    texts += [words(rnd, 9000, 5000), passage + " " + passage, "ünïcode " + passage[:500] + " ß" * 40]
    rows = [(i * 3, t, "en", f"s{i % 3}", len(t or ""), -1, "x", "y", 0) for i, t in enumerate(texts)]
    rows.append(rows[11])  # a repeated row
    return rows


def benchmark(seed: int = 3) -> list[tuple]:
    docs = documents(seed)
    passage = docs[21][1].split(" ")
    copy = docs[11][1].split(" ")
    return [(0, " ".join(passage[25:60]), "x"), (1, " ".join(copy[5:30]).upper(), "x"), (2, None, "x"), (3, "", "x"), (4, "...", "x"),
            (5, "smile", "x"), (6, "two words", "x"), (7, "nowhere to be found at all", "x"), (8, " ".join(copy[5:30]), "x"),
            (8, " ".join(copy[5:30]), "x"), (10, "w1x w2x w3x w4x w5x w6x", "x"), (11, "é", "x"), (12, " ".join(passage[30:43]), "x")]
