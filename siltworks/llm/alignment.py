"""Alignment of two tokenizers' tokens by skipping along the diagonal.

Both tokenizers cut the same bytes, so where both end a token the text falls into groups. Two ascending arrays of
token ends are compared at the current shift of their indexes: while tokens correspond one to one the arrays agree
there, and probes of doubling length jump such a stretch. An irregular group is walked through to the next end
that both have, which sets the new shift.

Corpus-wide counts take two passes. The first writes each document's pairs of ids with their multiplicities, the
pairs are counted over documents (combined per task, at most one row for each pair of ids that ever overlap), and
the second looks the counts up. They go to the tasks in slices of a fixed number of pairs, so what is broadcast
has a fixed size whatever the corpus and the vocabularies are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tables import arrow_map, arrow_type, written
from siltworks.llm.words import chunks

SLICE = 1 << 22  # pairs of a broadcast: 12 bytes each
PART = 1 << 17  # pieces of text that are aligned at a time
REMEMBERED = 400_000  # pieces of text that a worker keeps the tokens of
FLUSH = 1 << 22  # pairs a task counts before it passes the counts on

_RARE = re.compile(r"[^\S \n]|▁")  # other white space, and what one tokenizer reads as a space
_NO_CUT = re.compile(r"\s | \s| $")
# A space between two characters that are neither white space nor read as a space: both begin a token with it.
_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


def diagonal_groups(ends_a: Sequence[int], ends_b: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where each group ends, as a number of tokens of either side, for ascending ends with the same last one."""
    stretch_i, stretch_j, stretch_n, odd_i, odd_j = [], [], [], [], []
    i = j = 0
    n = len(ends_a)
    ends_a, ends_b = [*ends_a, -1], [*ends_b, -2]  # no probe passes the end
    while i < n:
        if ends_a[i] == ends_b[j]:
            k = 1
            if ends_a[i + 1] == ends_b[j + 1]:
                k = step = 2
                while ends_a[i + k : i + k + step] == ends_b[j + k : j + k + step]:
                    k += step
                    step += step
                while step > 2:  # the difference lies within the last probe
                    step >>= 1
                    if ends_a[i + k : i + k + step] == ends_b[j + k : j + k + step]:
                        k += step
                k += ends_a[i + k] == ends_b[j + k]
            stretch_i.append(i)
            stretch_j.append(j)
            stretch_n.append(k)
            i += k
            j += k
            if i == n:
                break
        x, y = ends_a[i], ends_b[j]
        while x != y:  # an irregular group: on to the next end that both have
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        i += 1
        j += 1
        odd_i.append(i)
        odd_j.append(j)
    length = np.array(stretch_n, dtype=np.int64)
    step = np.arange(1, int(length.sum()) + 1) - np.repeat(np.cumsum(length) - length, length)
    groups = []
    for stretch, odd in ((stretch_i, odd_i), (stretch_j, odd_j)):
        ends = np.concatenate([np.repeat(np.array(stretch, dtype=np.int64), length) + step, np.array(odd, dtype=np.int64)])
        groups.append(np.sort(ends))
    return groups[0], groups[1]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all tokens that overlap: between two neighbouring ends lies one token of either side."""
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # merges the two ascending runs
    ends = ends[np.diff(ends, prepend=-1) > 0]
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def _byte_level() -> dict[str, int]:
    """The bytes that the characters of byte-level entries stand for: printable ones themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@dataclass
class Tokenizers:
    """The two vocabularies as the driver read them: a byte-level one, and one of pieces that adds a space itself."""

    byte_level: str  # JSON
    pieces: bytes  # model

    @classmethod
    def load(cls, byte_level: str, pieces: str) -> Tokenizers:
        return cls(Path(byte_level).read_text(encoding="utf-8"), Path(pieces).read_bytes())

    def open(self) -> tuple:
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_str(self.byte_level)
        a.encode_special_tokens = True
        a.no_truncation()
        a.no_padding()
        return a, sentencepiece.SentencePieceProcessor(model_proto=self.pieces)

    def sizes(self) -> tuple[int, int]:
        a, b = self.open()
        return max(a.get_vocab().values()) + 1, b.get_piece_size()


@dataclass
class _Pieces:
    """Tokens of the pieces of text that a task has met: two ragged arrays, and which pieces both spell exactly."""

    tokenizers: Tokenizers
    number: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.a, self.b = self.tokenizers.open()
        alphabet = _byte_level()
        entries = self.a.get_vocab()
        self.size_a, self.size_b = max(entries.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        self.bytes_b = []
        for i in range(self.size_b):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # How ids are spelt in the text of groups: first in a group, or after another one.
        self.spelt_a = np.array([f";{i}" for i in range(self.size_a)] + [f",{i}" for i in range(self.size_a)], dtype=object)
        self.spelt_b = np.array([f"|{i}" for i in range(self.size_b)] + [f",{i}" for i in range(self.size_b)], dtype=object)
        self.ids, self.first = [np.zeros(0, np.int32)] * 2, [np.zeros(1, np.int64)] * 2
        self.exact, self.met = np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)

    def forget(self) -> None:
        """Start over, with the pieces that came in more than one call of ``numbers``."""
        kept = np.flatnonzero(self.met > 1) if self.number else np.zeros(0, dtype=np.int64)
        if len(kept) > REMEMBERED // 2:
            kept = kept[:0]
        words = list(self.number)
        tokens = [self.tokens(side, kept) for side in (0, 1)] if len(kept) else [(np.zeros(0, np.int32), kept)] * 2
        self.number = {words[i]: at for at, i in enumerate(kept.tolist())}
        self.ids = [ids for ids, _ in tokens]
        self.first = [np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) for _, counts in tokens]
        self.exact = self.exact[kept]
        self.met = np.ones(len(kept), dtype=np.int64)

    def numbers(self, parts: list[str]) -> np.ndarray:
        """The number of each piece of text; new ones are tokenized."""
        found = np.fromiter(map(self.number.get, parts, repeat(-1)), np.int64, len(parts))
        unknown = np.flatnonzero(found < 0).tolist()
        if unknown:
            new = list(dict.fromkeys([parts[i] for i in unknown]))
            spaced = [" " + part for part in new]
            sizes = np.fromiter(map(len, map(str.encode, spaced)), np.int64, len(new))
            exact = np.ones(len(new), dtype=bool)
            for side, (ids, counts), spelt, length in (
                (0, self._tokens_a(spaced, sizes), self.bytes_a, self.length_a),
                (1, _ragged(self.b.encode(new, num_threads=1)), self.bytes_b, self.length_b),
            ):
                first = np.concatenate([[0], np.cumsum(counts)])
                upto = np.concatenate([[0], np.cumsum(length[ids])])
                exact &= upto[first[1:]] - upto[first[:-1]] == sizes
                if not exact.all() or b"".join(map(spelt.__getitem__, ids.tolist())) != "".join(spaced).encode():
                    own = ids.tolist()
                    for k, text in enumerate(spaced):
                        exact[k] &= b"".join([spelt[i] for i in own[first[k] : first[k + 1]]]) == text.encode()
                self.ids[side] = np.concatenate([self.ids[side], ids])
                self.first[side] = np.concatenate([self.first[side], self.first[side][-1] + first[1:]])
            self.exact = np.concatenate([self.exact, exact])
            self.met = np.concatenate([self.met, np.zeros(len(new), dtype=np.int64)])
            at = len(self.number)
            self.number.update(zip(new, range(at, at + len(new))))
            found[unknown] = [self.number[parts[i]] for i in unknown]
        self.met[found] += 1  # once for each call, however often it has the piece
        return found

    def _tokens_a(self, texts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of texts that begin with a space, one after the other, and how many each has.

        Texts that begin and end with a cut are tokenized many at a time as one text and cut again by their bytes;
        if any other is among them, one by one.
        """
        flat, counts = [], []
        for at in range(0, len(texts), 64):
            own = texts[at : at + 64]
            joined = "".join(own)
            if _NO_CUT.search(joined) or joined[-1].isspace():
                ids, n = _ragged([x.ids for x in self.a.encode_batch_fast(own, add_special_tokens=False)])
            else:
                ids = np.array(self.a.encode(joined, add_special_tokens=False).ids, dtype=np.int32)
                n = np.diff(np.searchsorted(np.cumsum(self.length_a[ids]), np.cumsum(sizes[at : at + 64])) + 1, prepend=0)
            flat.append(ids)
            counts.append(n)
        return np.concatenate(flat), np.concatenate(counts)

    def tokens(self, side: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the pieces in order, and how many each has."""
        first = self.first[side]
        counts = first[numbers + 1] - first[numbers]
        begins = np.cumsum(counts) - counts
        return self.ids[side][np.arange(int(counts.sum())) + np.repeat(first[numbers] - begins, counts)], counts


def _ragged(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(counts.sum())), counts


_OPEN: list[_Pieces] = []


def _of_this_worker(tokenizers: Tokenizers) -> _Pieces:
    """What earlier tasks of the same process have opened and remembered, if it was for the same vocabularies."""
    if not _OPEN or _OPEN[0].tokenizers != tokenizers:
        _OPEN[:] = [_Pieces(tokenizers)]
    return _OPEN[0]


def _split(text: str) -> list[str]:
    plain = "  " not in text and " \n" not in text and "\n " not in text and text[0] != " " != text[-1]
    if plain and _RARE.search(text) is None:
        return text.split(" ")
    return _CUT.split(text)


@dataclass
class _Rows:
    """What becomes of the rows of one slice of a batch."""

    n: int
    digest: bool

    def __post_init__(self):
        self.sums = np.zeros((4, self.n), dtype=np.int64)  # tokens of either side, groups, links
        self.groups: list[list[str]] = [[] for _ in range(self.n)]
        self.hashes = {}
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add_groups(self, row: int, text: str) -> None:
        if not self.digest:
            self.groups[row].append(text if self.groups[row] else text[1:])
        elif row in self.hashes:
            self.hashes[row].update(text.encode())
        else:
            self.hashes[row] = hashlib.sha256(text[1:].encode())

    def group_texts(self) -> list[str]:
        if self.digest:
            return [self.hashes[row].hexdigest() if row in self.hashes else "" for row in range(self.n)]
        return ["".join(own) for own in self.groups]


def _align(pieces: _Pieces, numbers: np.ndarray, rows: np.ndarray, out: _Rows) -> None:
    """Align the tokens of some pieces of text, the i-th of row ``rows[i]``, ascending, and add the results."""
    ids_a, counts_a = pieces.tokens(0, numbers)
    ids_b, counts_b = pieces.tokens(1, numbers)
    row_a, row_b = np.repeat(rows, counts_a), np.repeat(rows, counts_b)
    ends_a, ends_b = np.cumsum(pieces.length_a[ids_a]), np.cumsum(pieces.length_b[ids_b])
    groups_a, groups_b = diagonal_groups(ends_a.tolist(), ends_b.tolist())
    link_a, link_b = links(ends_a, ends_b)
    row_groups, row_links = row_a[groups_a - 1], row_a[link_a]
    for k, which in enumerate((row_a, row_b, row_groups, row_links)):
        out.sums[k] += np.bincount(which, minlength=out.n)

    key = row_links * (pieces.size_a * pieces.size_b) + ids_a[link_a].astype(np.int64) * pieces.size_b + ids_b[link_b]
    out.pairs.append(np.unique(key, return_counts=True))

    # The text of the groups: of each group its tokens of one side, then those of the other.
    spelt = np.empty(len(ids_a) + len(ids_b), dtype=object)
    for ids, own, other, table, size in (
        (ids_a, groups_a, np.concatenate([[0], groups_b[:-1]]), pieces.spelt_a, pieces.size_a),
        (ids_b, groups_b, groups_a, pieces.spelt_b, pieces.size_b),
    ):
        first = np.concatenate([[0], own[:-1]])
        later = np.ones(len(ids), dtype=np.int64)
        later[first] = 0
        place = np.arange(len(ids)) + np.repeat(other, own - first)
        spelt[place] = table[ids + size * later]
    spelt = spelt.tolist()
    present = np.unique(rows)
    cuts = np.searchsorted(row_a, present, side="right") + np.searchsorted(row_b, present, side="right")
    start = 0
    for row, cut in zip(present.tolist(), cuts.tolist()):
        out.add_groups(row, "".join(spelt[start:cut]))
        start = cut


def _aligned(pieces: _Pieces, texts: list[str | None], digest: bool) -> _Rows:
    out = _Rows(len(texts), digest)
    parts = [_split(text) if text else [] for text in texts]
    rows = np.repeat(np.arange(len(texts)), np.fromiter(map(len, parts), np.int64, len(parts)))
    numbers = pieces.numbers([part for own in parts for part in own])
    inexact = np.bincount(rows[~pieces.exact[numbers]], minlength=len(texts)) > 0
    numbers, rows = numbers[~inexact[rows]], rows[~inexact[rows]]
    for at in range(0, len(numbers), PART):  # both sides end a token at every cut, so a long text may be cut anywhere
        _align(pieces, numbers[at : at + PART], rows[at : at + PART], out)
    return out


def token_groups(docs: DataFrame, byte_level: str, pieces: str, digest: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, groups``, and its linked id pairs with how often it has them.

    ``byte_level`` (tokenizers JSON, A) encodes a space and the text, ``pieces`` (a ``.model``, B) the text, to
    which it adds a space itself; both are paths on the driver, and their contents go to the tasks. ``groups`` has
    the ids of each group as ``a1,a2|b1;a3|b2``, or with ``digest`` the SHA-256 of that as lower-case hex; a row
    without tokens has the empty string. ``pairs`` holds numbers, A id times the size of B's vocabulary plus B id;
    ``times`` how many links each stands for. A text that is NULL or empty, or that one of the two does not spell
    byte by byte, has no tokens. Texts are tokenized in pieces between single spaces, where both always begin a
    token, and pieces that come again are remembered.
    """
    spark = docs.sparkSession
    tokenizers = Tokenizers.load(byte_level, pieces)
    size_a, size_b = tokenizers.sizes()
    shared = spark.sparkContext.broadcast(tokenizers)
    number, small = (pa.int32(), "int") if size_a * size_b <= 1 << 31 else (pa.int64(), "long")
    names = ("n_a", "n_b", "n_groups", "n_links")
    out = pa.schema(
        [("doc_id", arrow_type(docs, "doc_id")), *((name, pa.int64()) for name in names), ("groups", pa.string()),
         ("pairs", pa.list_(number)), ("times", pa.list_(pa.int32()))]
    )

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _of_this_worker(shared.value)
        every = size_a * size_b
        for batch in batches:
            for part in chunks(batch, 1, 1 << 20):
                rows = _aligned(known, part.column(1).to_pylist(), digest)
                keys, times = _summed(rows.pairs)
                offsets = pa.array(np.searchsorted(keys, np.arange(rows.n + 1) * every), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(own) for own in rows.sums), pa.array(rows.group_texts(), pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(keys % every, number)),
                     pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                    schema=out,
                )
                if len(known.number) > REMEMBERED:
                    known.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in names)
    return arrow_map(
        docs.select("doc_id", "text"), aligned, f"doc_id {kind}, {counts}, groups string, pairs array<{small}>, times array<int>"
    )


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys and the sums of their counts."""
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    keys, times = (np.concatenate(x) for x in zip(*parts))
    own, at = np.unique(keys, return_inverse=True)
    return own, np.bincount(at, weights=times, minlength=len(own)).astype(np.int64)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and how many each row has."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts


def pair_counts(grouped: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: how many rows hold each pair, and whether no pair of the same A id is in more rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + (1 << 16)]), pa.array(n[at : at + (1 << 16)])], ["pair", "n"])

        for batch in batches:
            held.append(_flat(batch.column(0))[0])
            entries += len(held[-1])
            if entries > FLUSH:
                yield from flush()
                held, entries = [], 0
        if entries:
            yield from flush()

    counts = written(
        arrow_map(grouped.select("pairs"), counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts"
    )
    numbered = counts.withColumn("a", F.floor(F.col("pair") / size_b))  # exact: pairs are far below 2^53
    most = numbered.groupBy("a").agg(F.max("n").alias("most"))  # a row per A id
    return numbered.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, byte_level: str, pieces: str, digest: bool = False, slice_pairs: int = SLICE) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``; see ``token_groups``.

    A pair of ids counts the rows of ``docs`` that have it linked, repeated rows and ids each for themselves.
    ``n_best`` are the row's links whose pair no other pair of the same A id exceeds, ``count_sum`` the sum of its
    links' counts. NULL ids stay NULL; other columns are not looked at; an empty table gives no rows.
    """
    spark = docs.sparkSession
    size_b = Tokenizers.load(byte_level, pieces).sizes()[1]
    grouped = token_groups(docs, byte_level, pieces, digest).withColumn("row", F.monotonically_increasing_id())
    grouped = written(grouped, "token-groups")
    counts = written(pair_counts(grouped, size_b), "pair-bests")
    slices = max(1, -(-counts.count() // slice_pairs))
    sums = "row long, n_best long, count_sum long"
    found = None
    for k in range(slices):  # one slice for four million pairs; their number is bounded by the vocabularies
        own = counts.filter(F.pmod(F.xxhash64("pair"), F.lit(slices)) == k).toArrow().sort_by("pair")
        table = tuple(own.column(i).to_numpy() for i in range(3))
        part = arrow_map(grouped.select("row", "pairs", "times"), _looked_up(spark.sparkContext.broadcast(table)), sums)
        found = part if found is None else found.unionAll(part)
    totals = found.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return grouped.drop("pairs", "times").join(totals, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"
    )


def _looked_up(shared):
    """Sums over each row's links of the counts in a slice, and of the best ones."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            keys, sizes = _flat(batch.column(1))
            times, _ = _flat(batch.column(2))
            at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
            hit = pair[at] == keys if len(pair) else np.zeros(len(keys), dtype=bool)
            row = np.repeat(np.arange(batch.num_rows), sizes)[hit]
            at, times = at[hit], times[hit]
            sums = []
            for worth in (best[at].astype(np.int64), n[at]) if len(pair) else (times, times):
                total = np.zeros(batch.num_rows, dtype=np.int64)
                np.add.at(total, row, worth * times)
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([batch.column(0), *sums], ["row", "n_best", "count_sum"])

    return summed
