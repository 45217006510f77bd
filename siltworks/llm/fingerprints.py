"""Document fingerprints: a homomorphic hash of the multiset of paragraphs, in native expressions.

Every paragraph is hashed to a wide vector of numbers, and a text's fingerprint is the sum of the vectors, lane by
lane, modulo powers of two. The order of paragraphs does not matter, and a paragraph is added or taken away with
one addition, without the rest of the text.

Lanes 0 to 3 are 32 bits of two hashes of the paragraph, modulo 2^32: they decide equality. Lane 4 counts
sentences modulo 2^32. The others count, over the paragraphs' sentences, how often each of 63 hash bits is set,
three counters to a lane, modulo 2^62: sums of random signs, whose cosine estimates how much two texts share.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltworks.llm.tables import shuffle_width, text_or_empty

_STEP = 21  # bits of a counter
_PACKED = 21  # lanes with three counters each
_ONES = 1 | 1 << _STEP | 1 << 2 * _STEP
MODULI = (1 << 32,) * 5 + (1 << 62,) * _PACKED


def _sum(hashes: Column, part) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: acc + part(h))


def _hashed(parts: Column, salt: int) -> Column:
    return F.transform(parts, lambda part: F.xxhash64(part, F.lit(salt)))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the lanes of a text. NULL and empty texts have one empty paragraph and no sentence.

    The hashes are columns of their own below the sums, so that the text is split once and not once per lane.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    paragraphs = F.split(whole, "\n")
    sentences = F.filter(F.split(whole, r"[.\n]+"), lambda s: s != "")
    hashed = {"__p0": _hashed(paragraphs, 0), "__p1": _hashed(paragraphs, 1), "__s": _hashed(sentences, 2)}
    low, modulus = F.lit(0xFFFFFFFF).cast("long"), F.lit(1 << 32).cast("long")
    lanes = []
    for part in ("__p0", "__p1"):
        lanes.append(_sum(F.col(part), lambda h: h.bitwiseAND(low)) % modulus)
        lanes.append(_sum(F.col(part), lambda h: F.shiftrightunsigned(h, 32)) % modulus)
    count = F.size("__s").cast("long") % modulus
    return df.withColumns(hashed).withColumn(name, F.concat(F.array(*lanes, count), _counters(F.col("__s")))).drop(*hashed)


def _counters(hashes: Column) -> Column:
    ones, low = F.lit(_ONES).cast("long"), F.lit((1 << 62) - 1).cast("long")

    def packed(shift: int) -> Column:
        return F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            # Taking the modulus before the addition keeps the sum within a signed long.
            lambda acc, h: acc.bitwiseAND(low) + F.shiftrightunsigned(h, shift).bitwiseAND(ones),
            lambda acc: acc.bitwiseAND(low),
        )

    return F.array(*[packed(shift) for shift in range(_PACKED)])


def _moduli() -> Column:
    return F.array(*[F.lit(m).cast("long") for m in MODULI])


def add_fingerprints(a: Column, b: Column) -> Column:
    """The fingerprint of both texts' paragraphs together: how a paragraph is inserted."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b"), _moduli().alias("m")), lambda x: F.pmod(x["a"] + x["b"], x["m"]))


def subtract_fingerprints(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``: how a paragraph is deleted."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b"), _moduli().alias("m")), lambda x: F.pmod(x["a"] - x["b"], x["m"]))


def fingerprint_text(lanes: Column) -> Column:
    """The lanes in hexadecimal."""
    return F.array_join(F.transform(lanes, lambda x: F.lower(F.hex(x))), "-")


def signs(lanes: Column) -> Column:
    """The 63 sums of random signs: twice a counter less the number of sentences."""
    mask, n = F.lit((1 << _STEP) - 1).cast("long"), F.element_at(lanes, 5)
    packed = F.slice(lanes, 6, _PACKED)

    def unpacked(i: int) -> Column:
        return F.transform(packed, lambda x: (F.shiftrightunsigned(x, _STEP * i).bitwiseAND(mask) * 2 - n).cast("double"))

    return F.concat(*[unpacked(i) for i in range(3)])


def likeness(a: Column, b: Column, signs_a: Column, signs_b: Column) -> Column:
    """1 for equal fingerprints, else the cosine of the signs, 0 at least: an estimate of the shared sentences."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)

    norm = F.sqrt(dot(signs_a, signs_a) * dot(signs_b, signs_b))
    cosine = F.when(norm > 0, dot(signs_a, signs_b) / norm).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def _tree(bounds: Sequence[int], first: int = 0) -> Column:
    """How many bounds are not above the id, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(F.col("doc_id") < F.lit(bounds[middle]), _tree(bounds[:middle], first)).otherwise(
        _tree(bounds[middle + 1 :], first + middle + 1)
    )


def _blocks(ids: DataFrame, blocks: int, most: int) -> Callable[[DataFrame], DataFrame]:
    """How to add ``__block``, the rank of a row's range of ids, for ranges of about equal counts.

    Up to ``most`` ranges are cut by one set of bounds. More are cut in two levels: each of those by bounds of its own,
    which go to the tasks as one row per range.
    """
    first, second = min(blocks, most), -(-blocks // most)
    steps = [i / first for i in range(1, first)] or [0.5]
    bounds = sorted(set(ids.select(F.percentile_approx("doc_id", steps, 100 * first)).first()[0] or []))
    coarse = _tree(bounds).cast("long")
    # Rows without an id come below all ranges, by hash.
    unknown = -1 - F.pmod(F.col("__h"), F.lit(blocks))
    if second == 1:
        return lambda rows: rows.withColumn("__block", F.when(F.col("doc_id").isNull(), unknown).otherwise(coarse))
    inner = [i / second for i in range(1, second)]
    cuts = ids.filter("doc_id is not null").groupBy(coarse.alias("__range")).agg(
        F.array_distinct(F.percentile_approx("doc_id", inner, 100 * second)).alias("__cuts")
    )

    def add(rows: DataFrame) -> DataFrame:
        ranged = rows.withColumn("__at", coarse).join(F.broadcast(cuts), F.col("__at") == F.col("__range"), "left")
        fine = F.size(F.filter("__cuts", lambda cut: cut <= F.col("doc_id"))).cast("long")
        block = F.when(F.col("doc_id").isNull(), unknown).otherwise(F.col("__at") * second + fine)
        return ranged.withColumn("__block", block).drop("__at", "__range", "__cuts")

    return add


def with_next(
    docs: DataFrame, columns: Sequence[str], blocks: int | None = None, derive: Callable[[DataFrame], DataFrame] = lambda df: df,
    most: int = 2048,
) -> DataFrame:
    """Add ``next_<column>`` of the next document in descending ``doc_id``; after the last comes the first.

    No task sorts the whole table: ids are cut into ``blocks`` ranges of about equal counts (by default the
    session's shuffle partitions; the driver learns ``most`` bounds at most), each block is
    ordered by itself, and gets a copy of the next block's first document as its last row. Rows without an id
    come after all others, spread over blocks by hash; equal ids are ordered by the hash of the text. ``derive`` adds
    columns to the documents; it is applied once to each, and again only to the copies.
    """
    docs = docs.withColumn("__h", F.xxhash64(text_or_empty()))
    blocked = _blocks(docs.select("doc_id"), blocks or shuffle_width(docs.sparkSession), most)
    place = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "__h")
    heads = blocked(docs.select("doc_id", "__h")).groupBy("__block").agg(F.max(place).alias("__top"))
    # One row per block. The block before in this order is the one that needs the head.
    around = Window.orderBy(F.col("__block").asc())
    last = F.min("__block").over(Window.partitionBy())
    receiver = F.coalesce(F.lead("__block").over(around), last)
    heads = heads.withColumn("__to", receiver).select("__to", F.col("__top.doc_id").alias("__id"), F.col("__top.__h").alias("__hash"))
    copies = (
        docs.join(F.broadcast(heads), (F.col("__h") == F.col("__hash")) & F.col("doc_id").eqNullSafe(F.col("__id")))
        .groupBy("__to", "doc_id", "__h")
        .agg(*[F.first(c).alias(c) for c in docs.columns if c not in ("doc_id", "__h")])
    )
    copies = derive(copies.select(*docs.columns, F.col("__to").alias("__block"), F.lit(1).alias("__copy")))
    both = derive(blocked(docs).withColumn("__copy", F.lit(0))).unionByName(copies)
    order = Window.partitionBy("__block").orderBy("__copy", F.col("doc_id").desc_nulls_last(), F.col("__h").desc())
    nexts = {f"next_{c}": F.lead(c).over(order) for c in columns}
    return both.withColumns(nexts).filter(F.col("__copy") == 0).drop("__copy", "__block", "__h")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text, whose last half is the next document's beginning.

    Per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The last floor(n_chars / 2) code points are replaced by the next document's first as many, or all of it.
    One exchange of the texts. NULL texts count as empty; see ``with_next`` for the order of odd ids. A table of
    one document is its own next one; an empty table gives no rows.
    """
    own = docs.select("doc_id", text_or_empty().alias("text"))
    near = with_next(own, ["text", "lanes"], derive=lambda df: with_fingerprint(df, "text", "lanes"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    near = near.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "lanes", "next_lanes")
    near = with_fingerprint(near, "edited", "edited_lanes")
    near = near.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "lanes", "edited_lanes", "next_lanes",
        signs(F.col("lanes")).alias("s"), signs(F.col("edited_lanes")).alias("e"), signs(F.col("next_lanes")).alias("n"),
    )
    return near.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint_text(F.col("lanes")).alias("fingerprint"),
        fingerprint_text(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes"), F.col("s"), F.col("e")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes"), F.col("s"), F.col("n")).alias("near_next"),
    )
