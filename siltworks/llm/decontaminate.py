"""Benchmark decontamination by pigeonhole edit matching.

A test item may differ from a passage by an error budget of e characters. Cut into e + 1 pieces, at least one of
them is then in the passage unchanged. So an Aho-Corasick automaton finds the pieces in each text, and Myers'
bit-parallel edit distance decides around each hit whether the whole item is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tables import arrow_map, arrow_type
from siltworks.llm.words import chunks

ERROR_RATE = 0.05  # of an item's characters
BLOCK_CHARS = 4_000_000  # of the items that go to the executors at a time


def normal(text: str | None) -> str:
    """Lower case, with one space for any blanks."""
    return " ".join((text or "").lower().split())


def error_budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(len(item) * rate)


def pieces_of(item: str, errors: int) -> list[tuple[int, str]]:
    """The item in ``errors + 1`` pieces of about equal length, with their places."""
    cuts = [i * len(item) // (errors + 1) for i in range(errors + 2)]
    return [(i, item[i:j]) for i, j in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> int:
    """The least edit distance between the pattern and any part of the text."""
    m = len(pattern)
    ones, top = (1 << m) - 1, 1 << (m - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    plus, minus, score = ones, 0, m
    best = score
    for c in text:
        match = places.get(c, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | (ones & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & ones, (down << 1) & ones
        plus = down | (ones & ~(diagonal | up))
        minus = up & diagonal
        best = min(best, score)
    return best


class Items:
    """A block of test items, ready to be looked for."""

    def __init__(self, items: Sequence[tuple[object, str]], rate: float = ERROR_RATE):
        self.items = [(item_id, normal(text)) for item_id, text in items]
        self.items = [item for item in self.items if item[1]]
        self.budgets = [error_budget(text, rate) for _, text in self.items]
        found: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(self.items):
            for at, piece in pieces_of(text, self.budgets[number]):
                found.setdefault(piece, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> dict[object, int]:
        """The items in a text, each with its least number of errors."""
        if not self.items:
            return {}
        text = normal(text)
        best: dict[int, int] = {}
        tried: set[tuple[int, int]] = set()
        for end, (length, places) in self.automaton.iter(text):
            for number, at in places:
                budget = self.budgets[number]
                begin = end + 1 - length - at
                # Hits whose places in the item agree within the budget have the same window around them.
                step = budget + 1
                slot = begin // step
                if (number, slot) in tried or best.get(number) == 0:
                    continue
                tried.add((number, slot))
                item = self.items[number][1]
                window = text[max(0, slot * step - budget) : (slot + 1) * step + len(item) + budget]
                errors = myers(item, window)
                if errors <= budget:
                    best[number] = min(errors, best.get(number, errors))
        out: dict[object, int] = {}
        for number, errors in best.items():
            item_id = self.items[number][0]
            out[item_id] = min(errors, out.get(item_id, errors))
        return out


def _blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about ``most`` characters, each of which may be broadcast."""
    block, held = [], 0
    for row in benchmark.select("item_id", F.col("text").cast("string")).filter("text is not null").toLocalIterator():
        block.append(tuple(row))
        held += len(row[1])
        if held >= most:
            yield block
            block, held = [], 0
    if block:
        yield block


_READY: dict[str, Items] = {}


def _ready(name: str, shared: Broadcast, rate: float) -> Items:
    """The block's automaton, built once in each Python worker."""
    if name not in _READY:
        _READY.clear()
        _READY[name] = Items(shared.value, rate)
    return _READY[name]


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, errors`` for every document that holds a test item within its error budget.

    The budget is ``rate`` times the item's characters, after lower-casing and joining blanks. The items are a
    stated query set, broadcast in blocks of ``block_chars``; each block is one pass over the documents without a
    shuffle. NULL and empty texts hold nothing; NULL and empty items are in nothing, and an item without an id
    is reported with a NULL. Rows that repeat are reported for each. Empty tables give no rows.
    """
    spark = docs.sparkSession
    item_type = arrow_type(benchmark, "item_id")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, errors int"
    found = None
    for block in _blocks(benchmark, block_chars):
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            items = _ready(name, shared, rate)
            for batch in batches:
                for part in chunks(batch, 1):
                    rows, ids, errors = [], [], []
                    for row, text in enumerate(part.column(1).to_pylist()):
                        for item_id, count in items.find(text).items():
                            rows.append(row)
                            ids.append(item_id)
                            errors.append(count)
                    columns = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(ids, item_type), pa.array(errors, pa.int32())]
                    if rows:
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "errors"])

        hits = arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), search, schema)
        found = hits if found is None else found.unionAll(hits)
    return spark.createDataFrame([], schema) if found is None else found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no test item; see ``find_leaks``."""
    spark = docs.sparkSession
    place = docs.columns.index("text")
    for block in _blocks(benchmark, block_chars):
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def keep(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            items = _ready(name, shared, rate)
            for batch in batches:
                yield batch.filter(pa.array([not items.find(text) for text in batch.column(place).to_pylist()], pa.bool_()))

        docs = arrow_map(docs, keep, docs.schema)
    return docs
