"""Near-duplicate texts by an exact Jaccard join on word shingles, with prefix filters under several token orders.

Two sets with a Jaccard similarity of at least t share a token among the first n - ceil(t n) + 1 tokens of each,
in whatever order all tokens are put. Here the first order is by rising frequency, which keeps common passages out
of the prefixes; it generates the candidates. Two more orders are random; a candidate pair must also share a
token in its prefixes under both before its sets are compared.

Of a pair, the smaller set shares such a token already among its first n - ceil(2t / (1 + t) n) + 1. Tokens that no
set has there make no pair. For sets of equal size that are alike but not similar, as pages from one template, these
shorter prefixes hold only tokens of their own.

Sets of n and m tokens need an overlap of t / (1 + t) (n + m). Their first common token has all others behind it in both,
so a token makes a pair only if each set has that many tokens from it on. Of equal sets, both have it in the shorter prefix.

Texts with equal sets are one class, and classes are joined, not texts. Candidates come in two steps, so that a
group of thousands of near copies does not give all its pairs: first every class is compared with one class of
each prefix token, that with the fewest rarer tokens, which in a group of near copies is the one with the fewest changes;
then only classes that share a token, are not yet connected, and have bitmaps that similar sets can have.
"""

from __future__ import annotations

import hashlib
import operator
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltworks.llm.components import components
from siltworks.llm.shared_keys import Entries, shared_keys
from siltworks.llm.tables import arrow_map, arrow_type, release_shuffles, shuffle_width, written
from siltworks.llm.words import Words, chunks, windows, words_of

SHINGLE = 5
PERCENT = 80  # links need 100 * intersection >= 80 * union
CELLS = 1 << 20  # counters that order tokens by frequency: 4 MB, whatever the corpus
BITS = 8  # longs of a set's parity bitmap
_PIECES = 64
_ORDERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd numbers: each product is an order


def shingle_sets(words: Words, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles."""
    hashes = words.hashes()
    for i, j in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        yield np.unique(windows(hashes[i:j], k))


def needed(n: int, percent: int) -> int:
    """The least overlap that a set of n tokens can have with a similar set."""
    return -(-percent * n // 100)


def set_class(tokens: np.ndarray) -> int:
    """A 64-bit name of the set; 0 for the empty set."""
    if not len(tokens):
        return 0
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """512 bits, each whether an odd number of tokens hash to it: two sets differ in at least as many tokens as bits."""
    places = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % (64 * BITS), minlength=64 * BITS) & 1
    return np.packbits(places.astype(np.uint8)).view(np.int64)


def _sets_and_counts(texts: DataFrame, kind: str, k: int) -> DataFrame:
    """Rows of documents (id, set size, class, bitmap), and per task its token counters in compressed pieces."""
    bits = [f"b{i}" for i in range(BITS)]
    names = ["doc_id", "n", "cls", *bits, "piece", "counts"]
    schema = f"doc_id {kind}, n long, cls long, {', '.join(f'{b} long' for b in bits)}, piece int, counts binary"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.uint32)
        for batch in batches:
            for part in chunks(batch, 1):
                sizes, classes, parities = [], [], []
                for tokens in shingle_sets(words_of(part.column(1), lower=True), k):
                    sizes.append(len(tokens))
                    classes.append(set_class(tokens))
                    parities.append(parity_bits(tokens))
                    np.add.at(counts, (tokens & np.uint64(CELLS - 1)).astype(np.int64), 1)
                m = part.num_rows
                maps = [pa.array(column.copy()) for column in np.stack(parities).T]
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), *maps, pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)
        packed = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, _PIECES)]
        empty = [pa.nulls(_PIECES, t) for t in (id_type, *[pa.int64()] * (BITS + 2))]
        columns = [*empty, pa.array(range(_PIECES), pa.int32()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names)

    id_type = arrow_type(texts, "doc_id")
    return arrow_map(texts, scan, schema)


def _total_counts(pieces: DataFrame) -> np.ndarray:
    """All tasks' counters added up: a fixed number of cells, of which 64 rows come to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zlib.decompress(packed), dtype=np.uint32).astype(np.uint64)
                sums[piece] = sums[piece] + counts if piece in sums else counts
        capped = {p: np.minimum(c, np.uint64(2**32 - 1)).astype(np.uint32) for p, c in sums.items()}
        columns = [pa.array(list(capped), pa.int32()), pa.array([c.tobytes() for c in capped.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["piece", "counts"])

    width = min(_PIECES, shuffle_width(pieces.sparkSession))
    dealt = pieces.select("piece", "counts").repartition(width, "piece")
    rows = arrow_map(dealt, add, "piece int, counts binary").collect()
    total = np.zeros((_PIECES, CELLS // _PIECES), dtype=np.uint32)
    for row in rows:
        total[row["piece"]] = np.frombuffer(row["counts"], dtype=np.uint32)
    return total.reshape(-1)


def _prefix_tokens(texts: DataFrame, frequency: np.ndarray, k: int, percent: int) -> DataFrame:
    """``k, owner, extra``: prefix tokens that several classes have, with the classes and how many tokens they have from it on.

    A class whose copies several tasks read comes from each of them.
    """
    shared = texts.sparkSession.sparkContext.broadcast(frequency)
    most = 1 << 20

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        counts = shared.value
        keys, owners, rests, held, seen = [], [], [], 0, set()
        for batch in batches:
            for part in chunks(batch, 0):
                for tokens in shingle_sets(words_of(part.column(0), lower=True), k):
                    cls, n = set_class(tokens), len(tokens)
                    if not n or cls in seen:
                        continue
                    seen.add(cls)
                    order = np.argsort(counts[(tokens & np.uint64(CELLS - 1)).astype(np.int64)], kind="stable")
                    prefix = tokens[order[: n - needed(n, percent) + 1]]
                    keys.append(prefix)
                    owners.append(np.full(len(prefix), cls, dtype=np.int64))
                    rests.append((n - np.arange(len(prefix))).astype(np.int32))
                    held += len(prefix)
                if held >= most:
                    yield tuple(np.concatenate(x) for x in (keys, owners, rests))
                    keys, owners, rests, held, seen = [], [], [], 0, set()
        if held:
            yield tuple(np.concatenate(x) for x in (keys, owners, rests))

    return shared_keys(texts.select("text"), entries)


class _Sets:
    """Tokens of a class and their prefixes under the random orders; the last class is remembered."""

    def __init__(self, k: int, percent: int):
        self.k, self.percent, self.last = k, percent, (None, None)

    def of(self, cls: int, text: str) -> tuple[np.ndarray, list[np.ndarray]]:
        if self.last[0] != cls:
            tokens = next(shingle_sets(words_of(pa.array([text], pa.large_string()), lower=True), self.k))
            self.last = (cls, (tokens, self._prefixes(tokens)))
        return self.last[1]

    def _prefixes(self, tokens: np.ndarray) -> list[np.ndarray]:
        p = len(tokens) - needed(len(tokens), self.percent) + 1
        return [np.sort(tokens[np.argpartition(tokens * odd, p - 1)[:p]]) for odd in _ORDERS]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers two sorted distinct arrays share."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of classes that are similar; ``texts`` has a text of each ``cls``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = _Sets(k, percent), _Sets(k, percent)
        for batch in batches:
            found = []
            for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns)):
                (tokens_a, prefixes_a), (tokens_b, prefixes_b) = left.of(a, text_a), right.of(b, text_b)
                if all(_common(p, q) for p, q in zip(prefixes_a, prefixes_b)):
                    both = _common(tokens_a, tokens_b)
                    if 100 * both >= percent * (len(tokens_a) + len(tokens_b) - both):
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["u", "v"])

    with_b = pairs.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
    both = with_b.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    return arrow_map(both.select("a", "b", "text_a", "text_b"), check, "u long, v long")


def _fitting(n: str, rest: str, m: str, rest_m: str, percent: int) -> Column:
    """Whether two sets of n and m tokens can be similar if the first token they share has so many from it on in each."""
    return F.least(rest, rest_m) * (100 + percent) >= (F.col(n) + F.col(m)) * percent


def ngram_join(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``, the smallest id that links lead to.

    These are the components of all links, not the links: pairs already in one component are not verified.

    Two documents link when 100 * intersection >= percent * union of their sets of k-word shingles (A-Z
    lower-cased; a text of fewer words is one shingle; texts without words link with nothing).

    NULL and empty texts have no shingles and stand alone. Rows without an id take no part and have a NULL
    component. Rows that repeat an id are rows of their own, each judged by its own text: one id may be in two
    components, which that does not connect. An empty table gives no rows. Ids must be whole numbers.

    Counters of all tokens, 4 MB at any size, are the only thing that goes through the driver. Prefix tokens of
    one class only are dropped in numpy buckets; what is left is joined by token with plain exchanges, which
    adaptive execution splits. Texts move only for classes that have a candidate.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = written(_sets_and_counts(texts, "long", k), "ngram-sets")
    sets = scanned.filter("piece is null")
    frequency = _total_counts(scanned.filter("piece is not null"))
    # Each class is stood for by its smallest id.
    bits = [F.min(f"b{i}").alias(f"b{i}") for i in range(BITS)]
    reps = sets.filter("n > 0 and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), *bits)
    reps = written(reps, "ngram-reps")

    named = texts.filter("doc_id is not null")
    found = _prefix_tokens(named, frequency, k, percent)
    found = found.select(F.col("k").alias("token"), F.col("owner").alias("cls"), F.col("extra").cast("long").alias("rest")).distinct()
    ranked = reps.select(F.col("cls").alias("rep"), "n")
    found = found.join(ranked.hint("merge"), F.col("cls") == F.col("rep")).drop("rep")
    found = written(found.withColumn("shorter", _fitting("n", "rest", "n", "rest", percent)), "ngram-found")
    release_shuffles(docs.sparkSession)
    # The class with the fewest rarer tokens has the least that others have not: most of a group are similar to it.
    central = F.min(F.struct((F.col("n") - F.col("rest")).alias("rarer"), "cls", "n", "rest"))
    smallest = F.min(F.when(F.col("shorter"), F.col("n")))  # of the sets that can be the smaller one of a pair
    pivots = found.groupBy("token").agg(central.alias("p"), F.count(F.lit(1)).alias("classes"), smallest.alias("least"))
    pivots = pivots.filter("least is not null and classes > 1").select(
        F.col("token").alias("of"), F.col("p.cls").alias("a"), F.col("p.n").alias("n_a"), F.col("p.rest").alias("rest_a"), "least"
    )
    tokens = found.join(pivots.hint("merge"), F.col("token") == F.col("of")).filter(_fitting("n", "rest", "least", "rest", percent))
    tokens = written(tokens.drop("of", "least"), "ngram-members")
    rep_texts = written(_rep_texts(named, tokens, reps, k), "ngram-texts")

    release_shuffles(docs.sparkSession)
    first = tokens.filter((F.col("a") != F.col("cls")) & _fitting("n", "rest", "n_a", "rest_a", percent))
    first = first.select("a", F.col("cls").alias("b")).distinct()
    links = written(_verified(first, rep_texts, k, percent), "ngram-links")
    release_shuffles(docs.sparkSession)
    stars = written(components(links), "ngram-stars")

    rest = _unconnected(tokens, stars, reps, percent)
    more = written(_verified(rest, rep_texts, k, percent), "ngram-links")
    joined = written(components(stars.select(F.col("node").alias("u"), F.col("component").alias("v")).unionAll(more)), "ngram-joined")

    # A component is named by its smallest id, that of its class which has the smallest.
    both = joined.select("node", "component").unionAll(joined.select(F.col("component").alias("node"), "component").distinct())
    ids = both.join(reps.select("cls", "doc_id").hint("merge"), F.col("node") == F.col("cls")).select("node", "component", "doc_id")
    least = ids.groupBy("component").agg(F.min("doc_id").alias("label")).withColumnRenamed("component", "of")
    labels = ids.join(least.hint("merge"), F.col("component") == F.col("of")).select("node", "label")
    own = reps.select("cls", "doc_id").join(labels.hint("merge"), F.col("cls") == F.col("node"), "left")
    own = own.select(F.col("cls").alias("of"), F.coalesce("label", "doc_id").alias("label"))
    rows = sets.select("doc_id", "n", "cls").join(own.hint("merge"), F.col("cls") == F.col("of"), "left")
    label = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    kind = docs.schema["doc_id"].dataType
    return rows.select(F.col("doc_id").cast(kind), F.col("n").alias("n_shingles"), label.cast(kind).alias("component_id"))


def _rep_texts(texts: DataFrame, tokens: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """``cls, text`` of the tokens' classes, each by the document that stands for it, which may have other texts as well."""
    classes = tokens.select(F.col("cls").alias("own")).distinct()
    wanted = reps.select("cls", F.col("doc_id").alias("rep")).join(classes.hint("merge"), F.col("cls") == F.col("own")).select("cls", "rep")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                classes = [set_class(t) for t in shingle_sets(words_of(part.column(1), lower=True), k)]
                same = pa.array(np.array(classes, dtype=np.int64) == part.column(0).to_numpy())
                yield part.filter(same)

    found = texts.join(wanted.hint("merge"), F.col("doc_id") == F.col("rep")).select("cls", "text")
    return arrow_map(found, scan, "cls long, text string")


def _unconnected(tokens: DataFrame, stars: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that share a token with enough of both sets from it on, and are in different components so far.

    A token whose classes are all connected gives none. Where most of a token's classes are in one component,
    only the others are paired with them. Sets whose bitmaps differ in more bits than similar sets may differ in
    tokens are no pair, which leaves few pairs of a group of texts that are alike but not similar.
    """
    member = tokens.select("token", "cls", "n", "rest", "shorter").join(stars.hint("merge"), F.col("cls") == F.col("node"), "left")
    member = written(member.select("token", "cls", "n", "rest", "shorter", F.coalesce("component", "cls").alias("comp")), "ngram-grouped")
    sizes = member.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("m"), F.bool_or("shorter").alias("pairs"))
    major = sizes.groupBy("token").agg(
        F.max(F.struct("m", "comp")).alias("most"), F.count(F.lit(1)).alias("comps"), F.bool_or("pairs").alias("pairs")
    )
    major = major.filter("comps > 1 and pairs").select(F.col("token").alias("of"), F.col("most.comp").alias("major"))
    mixed = member.join(written(major, "ngram-major").hint("merge"), F.col("token") == F.col("of")).drop("of")
    maps = [f"b{i}" for i in range(BITS)]
    mapped = reps.select(F.col("cls").alias("rep"), *maps)
    mixed = written(mixed.join(mapped.hint("merge"), F.col("cls") == F.col("rep")).drop("rep"), "ngram-mixed")
    smaller = mixed.filter("shorter").select(
        F.col("token").alias("of"), F.col("cls").alias("cls1"), F.col("n").alias("n1"), F.col("rest").alias("rest1"), F.col("comp").alias("comp1"),
        (F.col("comp") == F.col("major")).alias("major1"), *[F.col(b).alias(f"{b}_1") for b in maps],
    )
    unlike = reduce(operator.add, [F.bit_count(F.col(b).bitwiseXOR(F.col(f"{b}_1"))) for b in maps])
    # Similar sets differ in at most (100 - percent) of (100 + percent) of their tokens taken together.
    alike = unlike * (100 + percent) <= (F.col("n") + F.col("n1")) * (100 - percent)
    ordered = (F.col("n1") < F.col("n")) | (F.col("n1") == F.col("n")) & (F.col("cls1") < F.col("cls"))
    fits = ordered & (F.col("comp") != F.col("comp1")) & _fitting("n", "rest", "n1", "rest1", percent) & alike
    pairs = None
    for larger, some in ((mixed, smaller.filter("not major1")), (mixed.filter("comp <> major"), smaller.filter("major1"))):
        part = larger.join(some.hint("merge"), F.col("token") == F.col("of")).filter(fits)
        part = part.select(F.least("cls", "cls1").alias("a"), F.greatest("cls", "cls1").alias("b"))
        pairs = part if pairs is None else pairs.unionAll(part)
    return pairs.distinct()


def drop_near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, that are the smallest id of their component; see ``ngram_join``.

    Rows that repeat an id are one document: the one with the smallest text stays. Rows without an id stay. One
    exchange of the texts, by id.
    """
    groups = ngram_join(docs, k, percent)
    kept = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    rows = docs.filter("doc_id is not null").join(kept.hint("merge"), F.col("doc_id") == F.col("__kept"), "left_semi")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    rows = rows.withColumn("__place", F.row_number().over(first)).filter("__place = 1").drop("__place")
    return rows.unionByName(docs.filter("doc_id is null"))
