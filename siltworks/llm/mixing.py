"""Mixing sources to target weights by Pareto order sampling.

A document's expected number of copies splits into whole copies, which are certain, and a rest, which is the
probability of one more. The extra copies are drawn per source by Pareto order sampling: documents are ranked
by the odds of a random number over the odds of their inclusion, and the first ones are taken until the words
that the source still lacks are filled.

Within a source, documents may be preferred: expected copies are in proportion to the preference, up to the limit of
copies, and what the limit cuts off goes to the source's other documents, so that expectations add up to the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltworks.llm.tables import WORD, text_or_empty, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
BINS = 1 << 16
LEVELS = 16  # classes of preference for each doubling of it
FULL_WORTH = 200  # words from which on a text is worth as much as any other


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source: its words, and its target: a share of all words by weight, at most ``max_copies`` times its own.

    Sources rank by code point with NULL last and take the weights in turn. Water filling in closed form: with
    sources in the order of cap over weight, those below the water level get their cap, the others weight times
    the level. One row per source, so the windows over all sources stay small.
    """
    own = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = own.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_copies))
    everything = Window.partitionBy()
    level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    filled = (
        capped.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weights_left", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
        # With the sources before this one at their caps, this is the level of the water.
        .withColumn("level", (F.col("total") - F.col("caps_before")) / F.col("weights_left"))
        .withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
        .withColumn("final", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))).over(everything))
    )
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("final").getField("level") * F.col("weight"))
    )
    return filled.select("source", F.col("rank").cast("long").alias("sid"), "source_size", target.alias("target"))


def length_preference(text: str = "text") -> Column:
    """A preference for texts that are no fragments: in proportion to the words, up to ``FULL_WORTH`` of them."""
    return F.least(F.lit(1.0), word_count(text) / F.lit(float(FULL_WORTH)))


def _with_rates(base: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """Sources with ``rate``, the expected copies of a document for a preference of 1, before the limit of copies.

    Water filling again: words and preferred words are summed per class of preference, at most some thousand rows a
    source. From the most preferred class down, a class is full if the rate that the others then need would give it
    more than ``max_copies``. Documents within the class at the edge are cut by the limit one by one.
    """
    level = F.when(F.col("liking") > 0, F.floor(F.log2("liking") * LEVELS)).cast("long")
    classes = base.filter("size > 0 and liking > 0").groupBy("source", level.alias("level")).agg(
        F.sum("size").alias("words"), F.sum(F.col("liking") * F.col("size")).alias("liked"), F.min("liking").alias("least")
    )
    same = classes["source"].eqNullSafe(targets["source"])
    classes = classes.join(targets, same).drop(classes["source"])
    above = Window.partitionBy("sid").orderBy(F.col("level").desc())
    full = F.coalesce(F.sum("words").over(above.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("liked").over(above.rowsBetween(0, Window.unboundedFollowing))
    rated = classes.withColumn("rate", (F.col("target") - full * float(max_copies)) / rest)
    # The first class that is not full settles the rate; if all are, every document gets as many copies as it may.
    fits = F.col("rate") * F.col("least") < float(max_copies)
    rates = rated.groupBy("sid").agg(F.max_by("rate", F.when(fits, F.col("level"))).alias("rate"), F.max("rate").alias("most"))
    rates = rates.select(F.col("sid").alias("__sid"), F.coalesce("rate", "most").alias("rate"))
    return targets.join(rates, F.col("sid") == F.col("__sid"), "left").drop("__sid")


def _unit(seed: int, *columns: str) -> Column:
    """A number strictly between 0 and 1 by hash, so that reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), 12)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 17,
    preference: Column | None = None,
) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, copies, taken`` (words, repeats counted) and ``source``.

    ``preference`` makes inclusion unequal within a source: a document's expected copies are its preference times a
    rate, at most ``max_copies``; the rate is such that the expectations add up to the source's target. NULL, zero and
    negative preferences are not drawn. Without it all documents of a source have the same expectation, and only
    sources differ.

    The cut in a source's ranking is found without sorting the source: words are summed per bin of the rank
    (at most 65,536 rows a source), and only the documents of the bin with the cut are put in order. A source
    with a third of all rows therefore costs one row per bin and task. A NULL text has no words and is not
    taken; a NULL source is a source of its own; NULL and repeated ids are drawn like any other; an empty table
    gives no rows.
    """
    liking = preference.cast("double") if preference is not None else F.lit(1.0)
    base = written(docs.select("doc_id", "source", word_count().alias("size"), liking.alias("liking")), "mix-sizes")
    targets = written(source_targets(base, weights, max_copies), "mix-targets")
    sources = written(_with_rates(base, targets, max_copies), "mix-sources")

    joined = base.join(sources, base["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    drawn = (F.col("size") > 0) & (F.col("liking") > 0)
    expected = F.when(drawn, F.least(F.lit(float(max_copies)), F.col("rate") * F.col("liking"))).otherwise(0.0)
    chance = F.col("expected") - F.col("whole")
    unit = _unit(seed, "doc_id", "size")
    ranked = (
        joined.withColumn("expected", expected)
        .withColumn("whole", F.floor(F.col("expected") + 1e-9))
        .withColumn("chance", F.greatest(F.lit(0.0), chance))
        .withColumn("odds", (unit / (1 - unit)) / (F.col("chance") / F.when(F.col("chance") > 0, 1 - F.col("chance"))))
        .withColumn("place", F.col("odds") / (1 + F.col("odds")))
        .withColumn("bin", F.floor(F.col("place") * BINS))
        .select("doc_id", "source", "sid", "size", "source_size", "target", "whole", "place", "bin")
    )
    ranked = written(ranked, "mix-ranked")

    lacks = ranked.groupBy("sid").agg((F.max("target") - F.sum(F.col("whole") * F.col("size"))).alias("lack"))
    bins = ranked.filter(F.col("bin").isNotNull()).groupBy("sid", "bin").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("sid").orderBy("bin"))
    cut = (
        bins.withColumn("upto", upto)
        .join(lacks, "sid")
        .filter(F.col("upto") >= F.col("lack"))
        .groupBy("sid")
        .agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"), "lack")).alias("cut"))
    )
    # A source whose bins do not reach what it lacks takes one more copy of every document that may have one.
    decided = ranked.join(cut, "sid", "left").withColumn("at", F.coalesce(F.col("cut.bin"), F.lit(BINS + 1)))
    plain = decided.filter(F.col("bin").isNull() | (F.col("bin") != F.col("at"))).withColumn(
        "more", F.coalesce((F.col("bin") < F.col("at")).cast("long"), F.lit(0).cast("long"))
    )
    order = Window.partitionBy("sid").orderBy("place", F.col("doc_id").asc_nulls_first(), "size")
    filled = F.col("cut.before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    edge = decided.filter(F.col("bin") == F.col("at")).withColumn("more", (filled <= F.col("cut.lack")).cast("long"))
    copies = F.col("whole") + F.col("more")
    return plain.unionByName(edge).select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "source"
    )


def mix_documents(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 17,
    preference: Column | None = None,
) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``mix_sources`` takes it.

    Rows that agree in id, source and size are taken equally often. One exchange of the texts.
    """
    mix = mix_sources(docs, weights, max_copies, seed, preference).filter("copies > 0")
    taken = mix.groupBy("doc_id", "source", "size").agg(F.max("copies").alias("__copies"))
    taken = taken.toDF("__id", "__source", "__size", "__copies")
    sized = docs.withColumn("__words", word_count())
    same = (
        sized["doc_id"].eqNullSafe(taken["__id"]) & sized["source"].eqNullSafe(taken["__source"]) & (F.col("__words") == F.col("__size"))
    )
    repeated = sized.join(taken, same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return repeated.select(*[sized[f"`{c}`"] for c in docs.columns])
