"""Substring de-duplication with suffix automata of reference shards.

A word sequence of the threshold's length that starts earlier in the corpus is removed wherever it starts again.
Reference shards are documents' passages that may repeat, in pieces of bounded size; a shard's suffix automaton is
sent to the documents that have something in common with it, which stream through it for matching statistics: the
length of the longest match that ends at each word, and where it first ended. Spans matched over at least the
threshold are removed.

All documents against all shards would grow with the square of the corpus, so two rounds of hashes first find which
documents to stream through which shard: minimizers (of each window of 20 words the 6-word gram with the smallest
hash, the same one wherever the window stands) and then hashes of whole windows. They only route; what is removed
is decided by the automata.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.shared_keys import PACKED, Entries, bucket_count, pack, shared_keys, unpack
from siltworks.llm.tables import arrow_map, discard, release_shuffles, shuffle_width, written
from siltworks.llm.words import chunks, mix64, windows, words_of

WINDOW = 20
GRAM = 6
PIECE = 50_000  # words of a reference shard
PER_TASK = 256  # documents that stream through one copy of a shard's automaton


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """For each ``width`` consecutive grams the place of the smallest, the leftmost if it is there twice."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    # Doubling: places of the minimum over 1, 2, 4, ... grams, then two overlapping runs of them.
    place, span = np.arange(len(grams), dtype=np.int64), 1
    while 2 * span <= width:
        a, b = place[:-span], place[span:]
        place = np.where(grams[b] < grams[a], b, a)
        span *= 2
    a, b = place[:n], place[width - span : width - span + n]
    return np.where(grams[b] < grams[a], b, a)


def _documents(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row numbers and word hashes of the batch's texts."""
    done = 0
    for part in chunks(batch, text):
        words = words_of(part.column(text))
        hashes = words.hashes()
        for row, (i, j) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            yield done + row, hashes[i:j]
        done += part.num_rows


def _repeated_grams(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc_id, places`` of the minimizers that occur more than once in the corpus."""
    width = window - gram + 1

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        keys, owners, places, held = [], [], [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, words in _documents(batch, 1):
                if len(words) < window:
                    continue
                grams = windows(words, gram)
                chosen = np.unique(minimizers(grams, width))
                keys.append(grams[chosen])
                owners.append(np.full(len(chosen), ids[row], dtype=np.int64))
                places.append(chosen.astype(np.int32))
                held += len(chosen)
                if held >= 1 << 20:
                    yield tuple(np.concatenate(x) for x in (keys, owners, places))
                    keys, owners, places, held = [], [], [], 0
        if held:
            yield tuple(np.concatenate(x) for x in (keys, owners, places))

    rows = shared_keys(texts, entries)
    return rows.groupBy(F.col("owner").alias("marked")).agg(F.collect_list("extra").alias("places"))


def regions(words: np.ndarray, places: np.ndarray, window: int, gram: int) -> list[tuple[int, int]]:
    """The stretches of words whose windows all have a marked minimizer; no other window can repeat."""
    if len(words) < window:
        return []
    marked = np.zeros(len(words), dtype=bool)
    marked[places[places < len(words)]] = True  # places are of all texts of the id
    open_ = marked[minimizers(windows(words, gram), window - gram + 1)]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], open_, [False])).astype(np.int8)))
    return [(int(i), int(j) + window - 1) for i, j in zip(edges[::2], edges[1::2])]


def _common_documents(marked: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc_id, ref``: for every window that an earlier document (or the same) has, one document that has it.

    Within a batch the first holder of a window stands for it; over batches the smallest holder does. Pairs come
    from many windows, so they travel packed by document and are made distinct there.
    """
    buckets = bucket_count(marked)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            places = batch.column(2)
            keys, owners = [], []
            for row, words in _documents(batch, 1):
                hashes = windows(words, window)
                for i, j in regions(words, np.asarray(places[row].values), window, gram):
                    keys.append(hashes[i : j - window + 1])
                    owners.append(np.full(j - window + 1 - i, ids[row], dtype=np.int64))
            if not keys:
                continue
            key, new, owner, holder = _held(np.concatenate(keys), np.concatenate(owners))
            yield _packed_pairs(owner[~new], holder[~new], buckets)
            firsts = key[new], owner[new], np.zeros(int(new.sum()), dtype=np.int32)
            yield pack(firsts, buckets)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners = [], []
        for batch in batches:
            known = batch.column(4).to_numpy(zero_copy_only=False)
            if known.any():
                yield batch.filter(pa.array(known))
            held = batch.filter(pa.array(~known))
            keys.append(unpack(held.column(1), np.uint64))
            owners.append(unpack(held.column(2), np.int64))
        if not keys:
            return
        new, owner, holder = _held(np.concatenate(keys), np.concatenate(owners))[1:]
        yield _packed_pairs(owner[~new], holder[~new], buckets)

    width = shuffle_width(marked.sparkSession)
    found = arrow_map(arrow_map(marked, scan, PACKED).repartition(width, "bucket"), reduce, PACKED)
    return arrow_map(found.repartition(width, "bucket"), _distinct_pairs, "doc_id long, ref long")


def _held(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, whether each is the first of its kind, its owner, and the smallest owner of its kind."""
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    return key, new, owner, owner[np.flatnonzero(new)[np.cumsum(new) - 1]]


def _distinct(doc: np.ndarray, ref: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ref, doc))
    doc, ref = doc[order], ref[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (ref[1:] != ref[:-1])
    return doc[new], ref[new]


def _packed_pairs(doc: np.ndarray, ref: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Distinct pairs as rows of ``PACKED``, one per bucket of the document, marked as known."""
    doc, ref = _distinct(doc, ref)
    bucket = (mix64(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    own, begins = np.unique(bucket[order], return_index=True)
    parts = [order[i:j] for i, j in zip(begins, [*begins[1:], len(order)])]
    columns = [
        pa.array(own, pa.int32()), pa.array([ref[p].tobytes() for p in parts], pa.binary()),
        pa.array([doc[p].tobytes() for p in parts], pa.binary()), pa.array([b""] * len(parts), pa.binary()),
        pa.array([True] * len(parts), pa.bool_()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "k", "owner", "extra", "known"])


def _distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    doc = ref = np.zeros(0, dtype=np.int64)
    for batch in batches:
        refs, docs = unpack(batch.column(1), np.int64), unpack(batch.column(2), np.int64)
        doc, ref = _distinct(np.concatenate((doc, docs)), np.concatenate((ref, refs)))
    yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(ref)], ["doc_id", "ref"])


class SuffixAutomaton:
    """All substrings of a sequence, each with the place where it first ended."""

    def __init__(self, sequence: list[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends = [-1]
        next_, link, length, ends = self.next, self.link, self.length, self.ends
        last = 0
        for at, symbol in enumerate(sequence):
            state = len(next_)
            next_.append({})
            link.append(0)
            length.append(length[last] + 1)
            ends.append(at)
            p = last
            while p >= 0 and symbol not in next_[p]:
                next_[p][symbol] = state
                p = link[p]
            if p >= 0:
                q = next_[p][symbol]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    clone = len(next_)
                    next_.append(next_[q].copy())
                    link.append(link[q])
                    length.append(length[p] + 1)
                    ends.append(ends[q])
                    while p >= 0 and next_[p].get(symbol) == q:
                        next_[p][symbol] = clone
                        p = link[p]
                    link[q] = link[state] = clone
            last = state

    def matches(self, sequence: list[int], least: int) -> Iterator[tuple[int, int]]:
        """Where matches of at least ``least`` symbols end, and where the last ``least`` of them first ended."""
        next_, link, length, ends = self.next, self.link, self.length, self.ends
        state = matched = 0
        for at, symbol in enumerate(sequence):
            while state and symbol not in next_[state]:
                state = link[state]
                matched = length[state]
            if symbol in next_[state]:
                state = next_[state][symbol]
                matched += 1
            while state and length[link[state]] >= least:  # keep to the state of the last ``least`` symbols
                state = link[state]
            matched = min(matched, length[state])
            if matched >= least:
                yield at, ends[state]


def _as_regions(marked: DataFrame, window: int, gram: int, piece: int) -> DataFrame:
    """Per document, text of it (by hash, ``own``) and piece of at most ``piece`` words: starts of its regions, and the regions' words.

    Regions are cut with an overlap of a window less one word, so that each window is in a piece.
    """

    def cut(found: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
        held, size = [], 0
        for i, j in found:
            while i < j:
                to = min(j, i + piece)
                if size and size + to - i > piece:
                    yield held
                    held, size = [], 0
                held.append((i, to))
                size += to - i
                i = j if to == j else to - window + 1
        if held:
            yield held

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places, owns = batch.column(0).to_pylist(), batch.column(2), batch.column(3).to_pylist()
            rows = []
            for row, words in _documents(batch, 1):
                for number, part in enumerate(cut(regions(words, np.asarray(places[row].values), window, gram))):
                    starts = np.array([x for i, j in part for x in (i, j - i)], dtype=np.int64)
                    rows.append((ids[row], owns[row], number, starts.tobytes(), np.concatenate([words[i:j] for i, j in part]).tobytes()))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            names = ["doc_id", "own", "piece", "starts", "words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return arrow_map(marked, scan, "doc_id long, own long, piece int, starts binary, words binary")


def _numbered(starts: bytes, words: bytes, side: int) -> tuple[list[int], list[int]]:
    """The regions' words one after the other, parted by symbols of their own, and each word's place in its text.

    The two sides, 0 and 1, have different parting symbols, so that no match goes over the end of a region.
    """
    symbols, places = [], []
    spans = np.frombuffer(starts, dtype=np.int64).reshape(-1, 2)
    hashes = np.frombuffer(words, dtype=np.uint64)
    at = 0
    for number, (start, size) in enumerate(spans.tolist()):
        symbols += hashes[at : at + size].tolist()
        places += range(start, start + size)
        symbols.append(-1 - 2 * number - side)
        places.append(-1)
        at += size
    return symbols, places


def _spans(ends: list[int], window: int) -> bytes:
    """Merged spans of words, begin and end, of windows by their last words in rising order."""
    last = np.array(ends, dtype=np.int64)
    cut = np.flatnonzero(np.diff(last) > window) + 1
    begin = last[np.concatenate(([0], cut))] - window + 1
    end = last[np.concatenate((cut - 1, [len(last) - 1]))] + 1
    return np.stack((begin, end), axis=1).tobytes()


def _streamed(routed: DataFrame, window: int) -> DataFrame:
    """``removed, own, spans``: texts' spans that occur earlier in a shard; shards come before their documents."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton, origin = None, None, []
        for batch in batches:
            docs, owns, spans = [], [], []
            for ref, ref_own, piece, part, kind, doc, own, starts, words in zip(*(c.to_pylist() for c in batch.columns)):
                if (ref, ref_own, piece, part) != shard:
                    shard, automaton = (ref, ref_own, piece, part), None
                symbols, places = _numbered(starts, words, kind)
                if kind == 0:
                    automaton, origin = SuffixAutomaton(symbols), places
                    continue
                ends = []
                for at, first in automaton.matches(symbols, window):
                    if (ref, ref_own, origin[first]) < (doc, own, places[at]):
                        ends.append(places[at])
                if ends:
                    docs.append(doc)
                    owns.append(own)
                    spans.append(_spans(ends, window))
            columns = [pa.array(docs, pa.int64()), pa.array(owns, pa.int64()), pa.array(spans, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["removed", "own", "spans"])

    return arrow_map(routed, stream, "removed long, own long, spans binary")


def _found_spans(texts: DataFrame, window: int, gram: int, piece: int) -> DataFrame:
    """``removed, own, spans``: packed spans of word numbers by document and hash of the text, in several rows."""
    marked = written(_repeated_grams(texts, window, gram), "sub-marked")
    held = texts.join(marked.hint("merge"), F.col("doc_id") == F.col("marked")).select(
        "doc_id", "text", "places", F.xxhash64("text").alias("own")
    )
    held = written(held, "sub-texts")
    discard(marked)
    release_shuffles(texts.sparkSession)
    pairs = written(_common_documents(held, window, gram), "sub-pairs")
    release_shuffles(texts.sparkSession)
    pieces = written(_as_regions(held, window, gram, piece), "sub-regions")
    discard(held)

    # A shard that very many documents share is given to several tasks, each with a part of the documents.
    parts = pairs.groupBy("ref").agg(F.ceil(F.count(F.lit(1)) / PER_TASK).cast("int").alias("parts"))
    named = pieces.join(parts.hint("merge"), F.col("doc_id") == F.col("ref")).select("ref", "own", "piece", "parts", "starts", "words")
    shards = written(named.withColumnRenamed("own", "ref_own"), "sub-shards")
    heads = shards.select("ref", "ref_own", F.col("piece").alias("shard_piece"), "parts")
    routes = pairs.withColumnRenamed("doc_id", "doc").join(heads.hint("merge"), "ref")
    part = F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")
    routes = routes.select("ref", "ref_own", "shard_piece", part.alias("part"), "doc")
    streaming = routes.join(pieces.hint("merge"), F.col("doc") == F.col("doc_id")).select(
        "ref", "ref_own", F.col("shard_piece").alias("piece"), "part", F.lit(1).alias("kind"), "doc_id", "own", "starts", "words"
    )
    copies = shards.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    references = copies.select(
        "ref", "ref_own", "piece", "part", F.lit(0).alias("kind"), F.col("ref").alias("doc_id"), F.col("ref_own").alias("own"), "starts", "words"
    )
    width = shuffle_width(texts.sparkSession)
    routed = references.unionAll(streaming).repartition(width, "ref", "ref_own", "piece", "part")
    spans = _streamed(routed.sortWithinPartitions("ref", "ref_own", "piece", "part", "kind"), window)
    spans = written(spans, "sub-spans")
    discard(pairs, pieces, shards)
    release_shuffles(texts.sparkSession)
    return spans


def repeated_spans(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, piece: int = PIECE) -> DataFrame:
    """``removed, spans`` for ``doc_id`` (long, unique) and ``text``: a list of packed spans of word numbers per document."""
    return _found_spans(texts, window, gram, piece).groupBy("removed").agg(F.collect_list("spans").alias("spans"))


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row ``doc_id, n_words, n_removed, kept``: the words that no repeated window covers, joined by spaces.

    Words are runs without blanks, unchanged. A window is ``window`` consecutive words of one document; it is
    repeated if the same words also start in a smaller id, or earlier in the same document. Windows are judged on
    the input, not on what is left.

    NULL and empty texts have no words. Rows without an id keep all their words and take none from others. Rows
    that repeat an id and its text are one document. Different texts of one id are documents of their own, in the order
    of their hashes: what one has is removed from the next. Very long texts become several shards. An empty table gives no rows. Ids must be whole numbers.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = _found_spans(texts.filter("doc_id is not null"), window, GRAM, PIECE)
    spans = spans.groupBy("removed", "own").agg(F.collect_list("spans").alias("spans"))
    joined = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        spans.hint("merge"), (F.col("doc_id") == F.col("removed")) & (F.xxhash64("text") == F.col("own")), "left"
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                words = words_of(part.column(1))
                counts = words.counts()
                kept, gone = [], []
                for row, found in enumerate(part.column(2).to_pylist()):
                    n, first = int(counts[row]), int(words.first[row])
                    stays = np.ones(n, dtype=bool)
                    for packed in found or ():
                        for i, j in np.frombuffer(packed, dtype=np.int64).reshape(-1, 2).tolist():
                            stays[i:j] = False
                    at = np.flatnonzero(stays) + first
                    pairs = zip(words.starts[at].tolist(), words.ends[at].tolist())
                    body = words.data
                    kept.append(b" ".join([body[i:j].tobytes() for i, j in pairs]).decode("utf-8", "surrogatepass"))
                    gone.append(n - len(at))
                columns = [part.column(0), pa.array(counts), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept string"
    return arrow_map(joined.select("doc_id", "text", "spans"), keep, schema)
