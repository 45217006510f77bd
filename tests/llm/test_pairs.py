"""The n-gram join, components, shared keys and substring de-duplication against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from siltworks.llm.components import components
from siltworks.llm import ngram_join as ngram_join_module
from siltworks.llm.ngram_join import drop_near_duplicates, needed, ngram_join
from siltworks.llm.substrings import SuffixAutomaton, dedup_substrings, minimizers
from siltworks.llm.words import windows, words_of

from . import corpora


def _found(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_words_are_those_of_the_pattern():
    lines = [*corpora.texts(), None, "", " ", "\x0b a\x0cb\r", "x" * 5000, "é ü b"]
    found = words_of(pa.array(lines, pa.string()).slice(3))
    own = [corpora.words(t) for t in lines[3:]]
    assert found.counts().tolist() == [len(w) for w in own]
    flat = [w.encode() for ws in own for w in ws]
    assert [found.data[i:j].tobytes() for i, j in zip(found.starts, found.ends)] == flat
    by_hash = {}
    for word, value in zip(flat, found.hashes().tolist()):
        assert by_hash.setdefault(value, word) == word
    assert len(by_hash) == len(set(flat))


def test_window_hashes_tell_windows_apart():
    numbers = np.array([3, 1, 2, 3, 1, 2], dtype=np.uint64)
    found = windows(numbers, 3)
    assert found[0] == found[3] and len(set(found.tolist())) == 3
    assert len(windows(numbers[:2], 3)) == 1 and len(windows(numbers[:0], 3)) == 0


def test_ngram_join_matches_all_pairs(spark):
    rows = corpora.rows_of(corpora.texts())
    expected = corpora.near_components(rows)
    assert sum(root != i for i, (_, root) in expected.items()) > 20
    assert _found(ngram_join(corpora.table(spark, rows))) == expected


def test_ngram_join_of_a_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        own = list(base)
        own[i % 60] = f"x{i}"
        rows.append((i, " ".join(own), "en", "s", 1))
    rows += [(1000 + i, f"{' '.join(base[:9])} y{i} z{i} v{i}", "en", "s", 1) for i in range(50)]
    found = _found(ngram_join(corpora.table(spark, rows)))
    assert found == corpora.near_components(rows)


def _plain_row_components(rows):
    """By row: an id with two texts stands in the component of each."""
    numbered = corpora.near_components([(i, text) for i, (_, text) in enumerate(rows)])
    groups = {}
    for i, (_, root) in numbered.items():
        groups.setdefault(root, []).append(rows[i][0])
    return sorted((rows[i][0], n, min(groups[root])) for i, (n, root) in numbered.items())


def test_ngram_join_of_ids_with_two_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(5, a), (5, b), (3, a + " more"), (7, a + " less"), (4, b + " more"), (9, b + " less"), (5, a), (8, "of its own words entirely so")]
    found = ngram_join(corpora.table(spark, [(i, t, "en", "s", 1) for i, t in rows]))
    assert sorted(tuple(r) for r in found.collect()) == _plain_row_components(rows)


def _template(n, words=60, own=2):
    base = [f"t{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for j in range(own):
            text[words // 2 - 6 + 12 * j] = f"own{i}x{j}"
        out.append((i, " ".join(text), "en", "s", 1))
    return out


def test_a_template_gives_no_pairs(spark, monkeypatch):
    """Texts that are alike but not similar have only tokens of their own in the shorter prefixes: no token makes a pair."""
    counted = []
    true_verified = ngram_join_module._verified

    def verified(pairs, *args):
        counted.append(pairs.count())
        return true_verified(pairs, *args)

    monkeypatch.setattr(ngram_join_module, "_verified", verified)
    rows = _template(600) + [(10_000 + i, f"{_template(1)[0][1]} tail{i // 2}", "en", "s", 1) for i in range(20)]
    found = _found(ngram_join(corpora.table(spark, rows)))
    assert found == corpora.near_components(rows)
    assert sum(counted) < 5 * len(rows)


def _edited(n, words=150, seed=3):
    """Near copies of a text that is not among them: one to six words of each are replaced, left out or put in."""
    r = random.Random(seed)
    base = [f"e{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for j in range(r.choice((1, 1, 1, 2, 2, 3, 4, 6))):
            at = r.randrange(len(text))
            text[at : at + r.choice((0, 1, 1, 1))] = r.choice(([f"new{i}x{j}"], [f"new{i}x{j}"], [f"new{i}x{j}"], []))
        out.append((i, " ".join(text), "en", "s", 1))
    return out


def test_near_copies_with_many_changes_give_few_pairs(spark, monkeypatch):
    """A token makes a pair only with enough of both sets behind it; the least changed copy connects the others at once."""
    counted = []
    true_unconnected = ngram_join_module._unconnected

    def unconnected(*args):
        pairs = true_unconnected(*args)
        counted.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join_module, "_unconnected", unconnected)
    rows = _edited(500)
    expected = corpora.near_components(rows)
    assert 200 < sum(root != i for i, (_, root) in expected.items()) < 450
    assert _found(ngram_join(corpora.table(spark, rows))) == expected
    assert len(counted) == 1 and counted[0] < len(rows) // 10


def test_copies_in_several_tasks_are_one_member_of_a_token(spark, monkeypatch):
    members = []
    true_written = ngram_join_module.written

    def written(df, label):
        table = true_written(df, label)
        if label == "ngram-members":
            members.extend((r["token"], r["cls"]) for r in table.collect())
        return table

    monkeypatch.setattr(ngram_join_module, "written", written)
    rows = _edited(40)
    rows += [(1000 + i, rows[i % 3][1], "en", "s", 1) for i in range(60)]
    assert _found(ngram_join(corpora.table(spark, rows, parts=8))) == corpora.near_components(rows)
    assert members and len(members) == len(set(members))


def test_mixed_sizes_and_shares_lose_no_link(spark):
    r = random.Random(9)
    base = [f"m{i}" for i in range(120)]
    rows = []
    for i in range(220):
        text = list(base[: r.randint(40, 120)])
        for _ in range(r.randint(0, 6)):
            text[r.randrange(len(text))] = f"r{r.randrange(60)}"
        rows.append((i, " ".join(text), "en", "s", 1))
    assert _found(ngram_join(corpora.table(spark, rows))) == corpora.near_components(rows)


def test_ngram_join_of_odd_rows(spark):
    df = corpora.clashing(spark, corpora.odd_rows())
    found = [tuple(r) for r in ngram_join(df).collect()]
    assert len(found) == len(corpora.odd_rows())
    assert sorted(f for f in found if f[0] is None) == [(None, 0, None), (None, 4, None)]
    plain = {f for f in found if f[0] is not None}
    assert {(1001, 0, 1001), (1002, 0, 1002), (1003, 0, 1003), (1004, 1, 1004), (1006, 5, 1006), (1008, 1, 1008)} <= plain
    assert {f[2] for f in plain if f[0] == 1007} == {1007}
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == [1001, 1002, 1003, 1004, 1005, 1006, 1007, 1008, None, None]


def test_pair_operators_of_empty_tables(spark):
    empty = spark.createDataFrame([], corpora.DOCS)
    assert ngram_join(empty).collect() == [] and dedup_substrings(empty).collect() == []
    assert drop_near_duplicates(empty).collect() == []


def test_one_of_each_group_stays(spark):
    rows = corpora.rows_of(corpora.texts(9))
    expected = {i for i, (_, root) in corpora.near_components(rows).items() if root == i}
    assert {r["doc_id"] for r in drop_near_duplicates(corpora.table(spark, rows)).collect()} == expected


def test_needed_overlap_is_never_too_high():
    for n in range(1, 200):
        for m in range(1, 200):
            for both in range(1, min(n, m) + 1):
                if 100 * both >= 80 * (n + m - both):
                    assert both >= needed(n, 80)
                    break


def test_components_of_paths_and_stars(spark):
    r = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(3, 7), (5, 6), (5, 5)]
    r.shuffle(links)
    found = _found(components(spark.createDataFrame(links, "u long, v long")))
    expected = {i: (100,) for i in range(101, 161)} | {i: (3,) for i in (7, *range(200, 300))} | {6: (5,)}
    assert found == expected


def test_substrings_match_every_window(spark):
    rows = corpora.rows_of(corpora.texts())
    expected = corpora.without_repeats(rows)
    assert sum(v[1] for v in expected.values()) > 500
    assert _found(dedup_substrings(corpora.table(spark, rows))) == expected


def test_substrings_in_small_shards_and_windows(spark, monkeypatch):
    monkeypatch.setattr("siltworks.llm.substrings.PER_TASK", 2)
    rows = corpora.rows_of(corpora.texts(6, 60))
    from siltworks.llm import substrings

    df = corpora.table(spark, rows)
    spans = substrings.repeated_spans(df.select("doc_id", "text"), 20, 6, piece=30)
    expected = corpora.without_repeats(rows)
    gone = {}
    for doc_id, packed in spans.collect():
        places = set()
        for blob in packed:
            for i, j in np.frombuffer(blob, dtype=np.int64).reshape(-1, 2).tolist():
                places |= set(range(i, j))
        gone[doc_id] = len(places)
    assert {i: n for i, n in gone.items() if n} == {i: v[1] for i, v in expected.items() if v[1]}


def test_substrings_of_odd_rows(spark):
    rows = [r for r in corpora.odd_rows() if r[0] not in (1007,)]
    found = [tuple(r) for r in dedup_substrings(corpora.clashing(spark, rows)).collect()]
    assert len(found) == len(rows)
    by_id = {r[0]: r[1:] for r in found}
    assert by_id[1001] == by_id[1002] == by_id[1003] == (0, 0, "")
    assert by_id[1005] == corpora.without_repeats([(1005, corpora.odd_rows()[6][1])])[1005]
    assert (None, 0, 0, "") in found and (None, 8, 0, "no id here but words enough to shingle") in found


def test_substrings_of_an_id_with_different_texts(spark):
    def some(name: str, n: int) -> list[str]:
        return [f"{name}{i}" for i in range(n)]

    passage, shared = some("p", 25), some("s", 25)
    long_text, short = " ".join(some("a", 60) + passage + shared), " ".join(some("b", 4) + shared)
    last = " ".join(some("c", 3) + passage + some("d", 30))
    rows = [(7, long_text), (7, short), (7, long_text), (9, last), (7, None), (None, last)]
    found = [tuple(r) for r in dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    assert len(found) == len(rows)
    assert (9, 58, 25, " ".join(some("c", 3) + some("d", 30))) in found
    assert (None, 58, 0, last) in found and (7, 0, 0, "") in found
    # The shared passage goes from one of the two texts, whichever comes second, and both copies of a text are alike.
    longs, shorts = [f[1:] for f in found if f[1] == 110], [f[1:] for f in found if f[1] == 29]
    assert (longs, shorts) in (
        ([(110, 0, long_text)] * 2, [(29, 25, " ".join(some("b", 4)))]),
        ([(110, 25, " ".join(some("a", 60) + passage))] * 2, [(29, 0, short)]),
    )


@pytest.mark.parametrize("seed", range(5))
def test_automaton_finds_first_ends(seed):
    r = random.Random(seed)
    reference = [r.randint(0, 3) for _ in range(200)]
    query = [r.randint(0, 3) for _ in range(200)]
    found = dict(SuffixAutomaton(reference).matches(query, 5))
    for end in range(len(query)):
        window = query[end - 4 : end + 1] if end >= 4 else None
        ends = [i + 4 for i in range(len(reference) - 4) if reference[i : i + 5] == window]
        assert found.get(end) == (ends[0] if ends else None)


def test_minimizers_are_leftmost_smallest():
    r = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 15):
        grams = r.integers(0, 20, 100).astype(np.uint64)
        expected = [i + int(np.argmin(grams[i : i + width])) for i in range(100 - width + 1)]
        assert minimizers(grams, width).tolist() == expected
