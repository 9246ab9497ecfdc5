"""Awkward documents and plain-Python versions of the registered results."""
from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, label int, digest string, target boolean"


def prose(rng: random.Random, n: int) -> str:
    """n invented words with sentence ends and line breaks."""
    parts = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    out = []
    for i in range(n):
        w = "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
        out.append(w.capitalize() if not i or out[-1].endswith(".") else w)
        if rng.random() < 0.15:
            out[-1] += "."
    text = " ".join(out)
    return re.sub(r"\. (?=[A-Z])", lambda m: ".\n" if rng.random() < 0.3 else ". ", text)


def awkward(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, a shared passage, junk, nulls in every column, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(30, 200)) for _ in range(n)]
    passage = prose(rng, 60)
    for i in range(5):
        words = texts[i].split(" ")
        texts.append(texts[i])  # copy
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))  # near copy
        cut = len(texts[10 + i]) // 2
        texts[10 + i] = texts[10 + i][:cut] + " " + passage + " " + texts[10 + i][cut:]
    texts += ["of*** and&&& ting### " * 40, "OF!! AND!! THE!! " * 40, "again " * 300, None, "", " \t\n", "one", "One", "two words", prose(rng, 20_000), "日本語 テキスト ÉCOLE", "a" * 50_000]
    rows = [(i, t, None if i % 9 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", None, 5, "x", 1, "d", None) for i, t in enumerate(texts)]
    rows += [(None, texts[3], None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None), rows[4], rows[4]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text: str | None, size: int = 5) -> set[tuple[str, ...]]:
    words = WORD.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def groups(n: int, edges) -> list[int]:
    """Smallest index reachable from each of n nodes."""
    head = list(range(n))

    def find(x: int) -> int:
        while head[x] != x:
            x = head[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        head[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def links(texts: list[str | None], percent: int = 75) -> list[tuple[int, int]]:
    sets = [shingles(t) for t in texts]
    held = {}
    for i, s in enumerate(sets):
        for x in s:
            held.setdefault(x, []).append(i)
    common = Counter((a, b) for at in held.values() for a in at for b in at if a < b)
    return [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]


def base_metrics(text: str | None) -> tuple[int, int, int, int, int]:
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts, hit, seen, repeated = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            hit |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), repeated, len(hit)
