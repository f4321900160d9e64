"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Documents of a source are shuffled by a hash of their id and laid end to end, as often as the target
allows (``MOST_REPEATS``); this stream is cut into blocks of equal size. The schedule has slots of
one block each: slot i is the point ``frac((i + 1/2) * golden ratio)``, mapped through the cumulative
target weights to a source, and the slots of a source are ranked, so its r-th slot takes its r-th
block. A source's stream ends at its rounded target, whatever the size of a block: its last block may be
shorter, and blocks for which the schedule has no slot go where they are due, as guests of a slot. The
join of slots and blocks gives the words that the mix takes of each document.

No window holds a whole source: running sums and ranks are taken inside buckets of documents or
runs of slots, and their totals are summed in a second, small step. Small tables by contract are
those with one row for each source, bucket total or run of slots.

Defined results: null and empty texts have size 0 and nothing of them is taken. A null source is a
source of its own, last in order. Repeated rows are laid out each for itself; a null id hashes like
any other. Extra columns are ignored, or come back
unchanged with the documents of the mix, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkgate.llm.carried import carry, unpack
from chunkgate.sources.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Slots of the schedule, whatever the size of the corpus: a block is so small a part of all words.
SLOTS = 1 << 18
#: Slots that are ranked together, and documents (on average) that are laid out together.
RUN, BUCKET = 1 << 12, 1 << 12
#: Fractional part of the golden ratio as a fraction of 2**40, odd, so that 2**40 slots have points of their own.
_GOLDEN, _UNIT = 679_544_923_137, 1 << 40


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """One row for each source: place in order, source_size, weight, target.

    Sources share all words by weight; none above ``most_repeats`` times its size. With sources in
    order of ``cap / weight``, the first k are capped where the share of the others no longer
    reaches the next cap, so one running sum finds the level that repeated resharing ends at.
    """
    ordered = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "utf-8"))
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    t = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = t.withColumn("place", F.row_number().over(ordered)).withColumn("weight", weight)
    t = t.withColumn("cap", F.col("source_size") * F.lit(float(most_repeats))).withColumn("ratio", F.col("cap") / F.col("weight"))
    t = t.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    t = t.withColumn("target", F.least("cap", F.coalesce(level, F.col("ratio")) * F.col("weight")))
    return t.select("source", "place", "source_size", "weight", "target")


def schedule(targets: DataFrame, slots: DataFrame) -> DataFrame:
    """Slots of the mix: slot, place of the source, rank among the slots of that source."""
    ordered = Window.orderBy("place")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_ = Window.partitionBy(F.lit(0))
    edges = targets.where("target > 0").withColumn("high", F.sum("target").over(upto) / F.sum("target").over(all_))
    edges = edges.withColumn("low", F.coalesce(F.lag("high").over(ordered), F.lit(0.0)))
    # Each source's range of points, cut at a fixed grid so that a slot finds it by an equal key.
    grid = 1024
    edges = edges.withColumn("high", F.when(F.lead("place").over(ordered).isNull(), F.lit(2.0)).otherwise(F.col("high")))
    cells = edges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * grid), F.floor(F.least("high", F.lit(1 - 2**-30)) * grid))))
    points = slots.withColumn("point", ((F.col("slot") * 2 + 1) * F.lit(_GOLDEN // 2) % _UNIT) / F.lit(float(_UNIT)))
    points = points.withColumn("cell", F.floor(F.col("point") * grid))
    drawn = points.join(cells.select("cell", "low", "high", "place"), "cell").where("point >= low and point < high")
    drawn = drawn.select("slot", "place", F.floor(F.col("slot") / RUN).alias("run"))
    inside = Window.partitionBy("place", "run").orderBy("slot")
    before = Window.partitionBy("place").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("place", "run").count()
    counts = counts.select("place", "run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    return drawn.withColumn("own", F.row_number().over(inside) - 1).join(counts, ["place", "run"]).select(
        "slot", "place", (F.col("earlier") + F.col("own")).alias("rank")
    )


def layout(sizes: DataFrame, targets: DataFrame, buckets: int) -> DataFrame:
    """Documents with the words of their source before them, in the shuffled order, and their source's row of ``targets``."""
    named = sizes.withColumn("mixed", F.xxhash64("doc_id", F.lit("mix")))
    named = named.withColumn("bucket", F.pmod("mixed", F.lit(buckets)))
    inside = Window.partitionBy("source", "bucket").orderBy("mixed", "doc_id", "size")
    rows = named.withColumn("pos", F.row_number().over(inside)).withColumn(
        "own", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    totals = named.groupBy("source", "bucket").agg(F.sum("size").alias("all"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("base", F.coalesce(F.sum("all").over(before), F.lit(0)))
    totals = totals.join(targets, totals["source"].eqNullSafe(targets["source"])).select(
        totals["source"].alias("s"), totals["bucket"].alias("b"), "base", "place", "source_size", "target", "end"
    )
    return rows.join(totals, rows["source"].eqNullSafe(totals["s"]) & (rows["bucket"] == totals["b"])).select(
        "doc_id", "size", "bucket", "pos", (F.col("base") + F.col("own")).alias("begin"), "place", "source_size", "target", "end"
    )


def mix(documents: DataFrame, weights=WEIGHTS, most_repeats: int = MOST_REPEATS, slots: int = SLOTS) -> DataFrame:
    """Pieces of the mix: doc_id, size, source_size, target, and for each piece slot, epoch, skip, words.

    A document that the mix leaves out has one row with a null slot and 0 words.
    """
    spark = documents.sparkSession
    sizes = stored(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = stored(source_targets(sizes, weights, most_repeats), "mix-targets")
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    block = max(1, -(-total // slots))
    n_slots = -(-total // block)
    drawn = stored(schedule(targets, spark.range(n_slots).withColumnRenamed("id", "slot")), "mix-slots")
    # A source's stream ends at its target; blocks beyond its slots are spread evenly over the mix.
    targets = targets.withColumn("end", F.least(F.round("target").cast("long"), F.col("source_size") * most_repeats))
    ends = targets.join(drawn.groupBy("place").count(), "place", "left").withColumn("need", F.ceil(F.col("end") / block))
    ends = ends.withColumn("have", F.coalesce("count", F.lit(0))).where("have < need")
    guests = ends.withColumn("rank", F.explode(F.expr("sequence(have, need - 1)")))
    drawn = drawn.unionByName(guests.select(F.floor((F.col("rank") + 0.5) * n_slots / F.col("need")).alias("slot"), "place", "rank"))
    docs = layout(sizes, targets, max(1, -(-rows // BUCKET)))
    epochs = F.filter(F.sequence(F.lit(0), F.lit(most_repeats - 1)), lambda e: e * F.col("source_size") + F.col("begin") < F.col("end"))
    docs = docs.withColumn("epoch", F.explode_outer(F.when(F.col("size") > 0, epochs)))
    docs = docs.withColumn("from", F.col("epoch") * F.col("source_size") + F.col("begin"))
    docs = docs.withColumn("to", F.least(F.col("from") + F.col("size"), "end"))
    pieces = docs.withColumn("rank", F.explode_outer(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))))
    pieces = pieces.withColumn("first", F.greatest("from", F.col("rank") * block))
    pieces = pieces.withColumn("words", F.coalesce(F.least("to", (F.col("rank") + 1) * block) - F.col("first"), F.lit(0)))
    return pieces.join(drawn, ["place", "rank"], "left").select(
        "doc_id", "place", "bucket", "pos", "size", "source_size", "target", "slot", "epoch",
        (F.col("first") - F.col("from")).alias("skip"), F.when(F.col("slot").isNull(), 0).otherwise(F.col("words")).alias("words"),
    )


def taken_words(pieces: DataFrame) -> DataFrame:
    """Words that the mix takes of each document, repeats counted."""
    return pieces.groupBy("place", "bucket", "pos", "doc_id").agg(
        F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum("words").alias("taken")
    ).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The documents of the mix, whole: each as often as a pass over its source takes at least half of it.

    Repeats are rows; documents of which less is taken are left out. Repeated rows of the input are
    joined by id, source and size, so copies of one row are taken as often as that row alone.
    """
    taken = mix(documents, **options)
    copies = taken.where("words > 0").groupBy("place", "bucket", "pos", "doc_id", "size", "epoch").agg(F.sum("words").alias("words"))
    copies = copies.where("2 * words >= size").groupBy("place", "bucket", "pos", "doc_id", "size").count()
    copies = copies.groupBy("doc_id", "size").agg(F.max("count").alias("copies"))
    read = ("doc_id", "source", "text")
    rows = carry(documents, read).withColumn("_size", word_count(F.col("text")))
    joined = rows.join(copies.withColumnsRenamed({"doc_id": "_id", "size": "_of"}), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_size") == F.col("_of")))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*unpack(documents.columns, read))
