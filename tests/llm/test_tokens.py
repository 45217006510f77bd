"""Token counts, alignment of tokenizers and hard negatives against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import alignment, negatives, token_counts
from siltworks.llm.queries import QUERIES

from . import corpora

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL, JSON = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ODD = [
    "<s> </s> <unk> <0x41> <|endoftext|>", "  two  spaces   and a tail ", "tab\tand\r\nlines\n\n end\n", "▁ ▁▁x▁", " ", "\n",
    "日本語の文 と 한국어 \U0001f600\U0001f9ff", "nul\x00byte \x1c \x85 \xa0 x", "don't we'll I'd", "a" * 3000, " " * 500, "é" * 70 + " é", "x  y 　z",
]


def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


# ---- counts ----------------------------------------------------------------------------------------


def test_merging_counts_as_the_library_does():
    pieces, model, r = token_counts.Pieces.load(MODEL), _library(MODEL), random.Random(11)
    parts = [*"abehinort <>/▁\n\té日門\U0001f600\x00", "the ", "ing", "tion", "  ", "    ", "​"]
    for text in ODD + ["".join(r.choices(parts, k=r.randint(0, 60))) for _ in range(3000)]:
        assert pieces.count(text) == len(model.encode(text)), repr(text)
    unbroken = "".join(r.choices("abcdefghij", k=50_000))
    assert pieces.count(unbroken) == len(model.encode(unbroken))


def test_a_piece_across_a_space_keeps_the_text_whole():
    ranks = {c: i for i, c in enumerate(["▁", "a", "b", "a▁", "a▁b", "▁a"])}
    pieces = token_counts.Pieces(ranks, token_counts._segments(ranks))
    assert pieces.count("a b") == 2 and pieces.count("a b\na") == 4  # "▁", "a▁b"; then "\n" and "a"


def test_counts_of_odd_rows(spark, tmp_path):
    rows = corpora.odd_rows() + [(2000 + i, text, "en", "s", 1) for i, text in enumerate(ODD)]
    found = token_counts.count_tokens(corpora.clashing(spark, rows), MODEL, limit=5)
    model = _library(MODEL)
    expected = Counter()
    for doc_id, text, *_ in rows:
        n = len(model.encode(text or ""))
        expected[(doc_id, len((text or "").encode()), n, n > 5)] += 1
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert token_counts.count_tokens(spark.createDataFrame([], corpora.DOCS), MODEL).collect() == []


def test_counts_do_not_depend_on_what_is_remembered(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = sorted(tuple(r) for r in QUERIES["op11_token_counts"](spark, SF).collect())
    model = _library(MODEL)
    texts = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert found == [(i, len(t.encode()), n := len(model.encode(t)), n > 4096) for i, t in texts]


# ---- alignment -------------------------------------------------------------------------------------


def _plain_alignment(texts):
    """Per text: tokens of both sides, groups and links by looking at every pair of byte ranges within a group."""
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    b = _library(MODEL)
    alphabet, names = alignment._byte_level(), {i: w for w, i in a.get_vocab().items()}

    def spelt_b(i):
        return bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(whole.decode(), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(alphabet[c] for c in names[i]) for i in ids_a]
        bytes_b = [spelt_b(i) for i in ids_b]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            out.append((0, 0, [], Counter()))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        groups, links = [], Counter()
        start = 0
        for end in common:
            own_a = [(i, e - len(w), e) for i, e, w in zip(ids_a, ends_a, bytes_a) if start < e <= end]
            own_b = [(i, e - len(w), e) for i, e, w in zip(ids_b, ends_b, bytes_b) if start < e <= end]
            groups.append(f"{','.join(str(x[0]) for x in own_a)}|{','.join(str(x[0]) for x in own_b)}")
            links.update((x[0], y[0]) for x in own_a for y in own_b if x[1] < y[2] and y[1] < x[2])
            start = end
        out.append((len(ids_a), len(ids_b), groups, links))
    return out


def _plain_rows(rows):
    aligned = _plain_alignment([r[1] for r in rows])
    held = Counter(pair for x in aligned for pair in x[3])
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for row, (n_a, n_b, groups, links) in zip(rows, aligned):
        n_best = sum(k for pair, k in links.items() if held[pair] == best[pair[0]])
        total = sum(k * held[pair] for pair, k in links.items())
        out.append((row[0], n_a, n_b, len(groups), sum(links.values()), n_best, total, ";".join(groups)))
    return Counter(out)


@pytest.mark.parametrize("slice_pairs", [1 << 22, 100])
def test_alignment_matches_a_plain_version(spark, slice_pairs):
    rows = corpora.rows_of(corpora.texts(n=60)) + [(500 + i, text[:300], "en", "s", 1) for i, text in enumerate(ODD)]
    rows += [(None, "no id", None, None, 1), (None, None, None, None, None), (700, "", "en", "s", 0), (0, "an id again", "en", "s", 1)] * 2
    found = alignment.align_tokens(corpora.clashing(spark, rows).repartition(3), JSON, MODEL, slice_pairs=slice_pairs)
    assert Counter(tuple(r) for r in found.collect()) == _plain_rows(rows)


def test_alignment_in_parts_of_a_text(spark, monkeypatch):
    tokenizers = alignment.Tokenizers.load(JSON, MODEL)
    texts = corpora.texts(n=30) + ODD
    whole = alignment._aligned(alignment._Pieces(tokenizers), texts, False)
    monkeypatch.setattr(alignment, "PART", 3)
    parts = alignment._aligned(alignment._Pieces(tokenizers), texts, False)
    assert whole.group_texts() == parts.group_texts() and (whole.sums == parts.sums).all()
    assert all((x == y).all() for x, y in zip(alignment._summed(whole.pairs), alignment._summed(parts.pairs)))
    digests = alignment._aligned(alignment._Pieces(tokenizers), texts, True).group_texts()
    assert digests == [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in whole.group_texts()]


def test_groups_by_skipping_equal_those_of_common_ends():
    r = random.Random(2)
    for _ in range(500):
        n = r.randint(1, 60)
        common = r.random()
        ends_a = sorted({n, *(x for x in range(1, n) if r.random() < common)})
        ends_b = sorted({n, *(x for x in range(1, n) if r.random() < 0.2 or x in ends_a and r.random() < 0.9)})
        groups_a, groups_b = alignment.diagonal_groups(ends_a, ends_b)
        both = sorted(set(ends_a) & set(ends_b))
        assert [ends_a[i - 1] for i in groups_a] == both == [ends_b[j - 1] for j in groups_b]
    assert [len(x) for x in alignment.diagonal_groups([], [])] == [0, 0]


def test_alignment_of_nothing_and_of_the_registered_query(spark):
    assert alignment.align_tokens(spark.createDataFrame([], corpora.DOCS), JSON, MODEL).collect() == []
    blank = spark.createDataFrame([(1, None, "en", "s", 1)], corpora.DOCS)
    assert [tuple(r) for r in alignment.align_tokens(blank, JSON, MODEL).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = Counter(tuple(r) for r in QUERIES["op12_token_alignment"](spark, SF).collect())
    expected = Counter()
    for (*digits, groups), n in _plain_rows(rows).items():
        expected[(*digits, hashlib.sha256(groups.encode()).hexdigest() if groups else "")] += n
    assert found == expected


# ---- hard negatives --------------------------------------------------------------------------------


def _plain_negatives(rows, positives=5, keep=5):
    """Every anchor against every row. ``rows``: id, vector, label, whether it is an anchor."""
    own = [
        (i, vec_id, [math.floor(256 * x) for x in vector], label, anchor)
        for i, (vec_id, vector, label, anchor) in enumerate(rows)
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) and abs(x) < 1e6 for x in vector)
    ]
    out = Counter()
    for i, anchor_id, vector, label, anchor in own:
        if not anchor:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, other)), vec_id is None, vec_id or 0, j, vec_id, at)
            for j, vec_id, other, at, _ in own if j != i
        )
        for p in [x for x in scored if x[5] == label][:positives]:
            fits = [x for x in scored if x[5] != label and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]]
            out.update((anchor_id, p[4], k + 1, x[4], -p[0], -x[0]) for k, x in enumerate(fits[:keep]))
    return out


def _mined(spark, rows, parts=4, **options):
    schema = "vec_id long, embedding array<double>, label int, is_anchor boolean, row int, score int, slot int"
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema).repartition(parts)
    return Counter(tuple(r) for r in negatives.mine_negatives(table, F.col("is_anchor"), **options).collect())


def _vectors(n=300, width=6, seed=4):
    r = random.Random(seed)
    heads = [[r.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    return [
        (i, [x + r.gauss(0, 0.4) for x in heads[i % 5]], r.randrange(4), i % 9 == 0) for i in range(n)
    ]


@pytest.mark.parametrize("block", [1 << 15, 10])
def test_negatives_match_a_plain_version(spark, block):
    rows = _vectors()
    assert _mined(spark, rows, block_anchors=block) == _plain_negatives(rows)


def test_negatives_of_ties_hot_vectors_and_odd_rows(spark):
    rows = _vectors(80)
    rows += [(1000 + i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.25], i % 3, i % 50 == 0) for i in range(150)]  # one vector very often
    rows += [(3, rows[3][1], rows[3][2], True)] * 3 + [(None, rows[5][1], 1, True), (None, rows[6][1], 2, None)] * 2
    rows += [
        (5000, None, 1, True), (5001, [1.0] * 6, None, True), (5002, [1.0, None], 1, True), (5003, [float("nan")] * 6, 1, True),
        (5004, [float("inf")] * 6, 1, True), (5005, [], 1, True), (5006, [0.0] * 6, 2, True), (5007, [1.0, 2.0], 1, True),
        (5008, [1.0] * 9, 1, True), (5009, [1e9] * 6, 1, True), (5010, [-0.001] * 6, 3, False),
    ]
    got, plain = _mined(spark, rows), _plain_negatives(rows)
    assert got == plain


def test_no_anchors_no_rows(spark):
    rows = [(1, [1.0], 1, False), (2, [1.0], 2, None)]
    assert not _mined(spark, rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mine_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []


def test_a_walk_ends_before_the_list_does(spark):
    """Members leave the list once nothing behind can reach them, and lose nothing by it."""
    r = np.random.default_rng(1)
    centre = r.normal(size=16)
    near, far = centre + r.normal(size=(50, 16)) * 0.05, r.normal(size=(5000, 16))
    matrix = np.floor(256 * np.concatenate([near, far]))
    n = len(matrix)
    block = negatives.Block(
        np.arange(10), np.zeros(10, dtype=np.int64), matrix[:10], negatives.fit_centres(matrix[:10], 1),
        np.full((10, 1), -np.inf), np.full((10, 1), np.inf), True,
    )
    seen = []

    class Watched(negatives._Best):
        def worst(self):
            seen.append(1)
            return super().worst()

    clusters = block.clusters()
    best = [Watched(block, members, 5) for members, _, _ in clusters]
    labels = np.zeros(n, dtype=np.int64)
    rows = np.arange(n)
    negatives._walk(block, clusters, best, rows, rows, labels, labels, matrix, np.linalg.norm(matrix, axis=1))
    assert len(seen) <= 3 * 2  # of five strides at most two are looked at
    slot, less, ids, _, _ = best[0].entries
    for m, i in enumerate(clusters[0][0]):
        score = matrix @ matrix[i]
        order = [j for j in np.lexsort((rows, -score)) if j != i][:5]
        assert ids[slot == m].tolist() == order
