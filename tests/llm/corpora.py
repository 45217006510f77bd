"""Small corpora and plain versions of the operators, for the tests."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, as extra columns of their input.
CLASHES = "size int, k int, n int, u int, cls int, first int, rank int, target int, copies int, key int, lost int, bin int, kept int"


def texts(seed: int = 5, n: int = 120) -> list[str]:
    """Texts with near copies, shared passages, repeated lines and repeated windows in one text."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 5))) for _ in range(400)]

    def some(m: int) -> list[str]:
        return [r.choice(vocabulary) for _ in range(m)]

    passage, line = some(30), "  A Shared LINE of the corpus "
    out = []
    for i in range(n):
        kind = i % 8
        if kind == 0 or not out:
            out.append(" ".join(some(r.randint(1, 90))))
        elif kind == 1:
            words = out[r.randrange(len(out))].split(" ")
            words[r.randrange(len(words))] = "changed"
            out.append(" ".join(words))
        elif kind == 2:
            out.append(" ".join(some(r.randint(0, 20)) + passage[: r.randint(15, 30)] + some(5)))
        elif kind == 3:
            out.append(f"{' '.join(some(6))}\n{line}\n{' '.join(some(4))}\n{line.strip().lower()}\t\n\nshort")
        elif kind == 4:
            out.append(out[r.randrange(len(out))])
        elif kind == 5:
            half = some(25)
            out.append(" ".join(half + some(3) + half))
        elif kind == 6:
            out.append(out[r.randrange(len(out))].upper().replace(" ", "  "))
        else:
            out.append(" ".join(some(r.randint(1, 6))))
    return out


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty, blank and long texts, repeated rows and ids."""
    long_text = " ".join(f"w{i % 977}" for i in range(30_000))
    return [
        (None, "no id here but words enough to shingle", None, None, None),
        (None, None, None, None, None),
        (1001, None, "en", "s", 0),
        (1002, "", None, None, 0),
        (1003, " \t\n \x0b", "en", "s", 5),
        (1004, "one", "en", None, 3),
        (1005, long_text, "en", "s", None),
        (1006, "the same row twice with enough words in it", "en", "s", 1),
        (1006, "the same row twice with enough words in it", "en", "s", 1),
        (1007, "one id with this text of seven words", "en", "s", 1),
        (1007, "one id with another text of eight words", "en", "t", 1),
        (1008, "é" * 5000 + "\U0001f600", "fr", "s", 1),
    ]


def rows_of(lines: list[str]) -> list[tuple]:
    return [(i, text, "en", f"src{i % 5}", len(text)) for i, text in enumerate(lines)]


def table(spark, rows, parts: int = 5, schema: str = DOCS):
    return spark.createDataFrame(rows, schema).repartition(parts)


def clashing(spark, rows):
    """The rows with extra columns whose names operators use inside."""
    extra = tuple(range(CLASHES.count(" int")))
    return spark.createDataFrame([(*r, *extra) for r in rows], f"{DOCS}, {CLASHES}")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, k: int = 5) -> set:
    own = words((text or "").translate(LOWER))
    if len(own) < k:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}


def near_components(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    """Per id its set's size and the smallest id that links lead to, by comparing all pairs."""
    sets = {r[0]: shingles(r[1]) for r in rows}
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(sets[i]), root(i)) for i in ids}


def without_repeats(rows: list[tuple], window: int = 20) -> dict[int, tuple[int, int, str]]:
    """Per id words, removed words and what is kept, by looking at every window in order."""
    seen, out = set(), {}
    for doc_id, text in sorted((r[0], r[1]) for r in rows):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out[doc_id] = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g))
    return out
