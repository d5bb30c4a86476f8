"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import cut

SLOTS = 65_536  # about the least number of slots of a schedule, so that small inputs are mixed finely too
BLOCK = 256  # most words of a block
ERROR = 8  # blocks by which a source's words may miss its target
CELLS = 4_096  # cells of the unit interval in which points look for their stretch
CHUNK = 2_048  # neighbouring slots, or shuffled documents, that are numbered together
UNIT = 1 << 32  # points are whole numbers below this one
GOLDEN = 2_654_435_769  # UNIT over the golden ratio, odd
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key() -> Column:
    """Digest of identifier and text, by which documents are shuffled."""
    parts = F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.md5(F.concat(parts[0], F.lit(":"), parts[1]).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """`(source, source_size, weight, target)` from `sizes (source, source_size)`, one row per source.

    Sources in code-point order, null last, take the weights in turn and share `share` times all sizes by weight. A target stops
    at `most` times its source's size; what is above is shared again by weight among the others until none is above. In closed form:
    sources ordered by `size / weight` are capped from the smallest on, as long as the level that is left for the
    others lies above their cap.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("rest") / F.col("open"))
        .withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap"))
    )
    # the level of the first source that is not capped holds for all that follow
    first = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("k"), "level"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(first["level"] * F.col("weight"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def block_length(words: float) -> int:
    """Words of every block of a mix of `words` words."""
    return max(1, min(BLOCK, int(words / SLOTS)))


def points(slot: Column, step: int) -> Column:
    """The low-discrepancy sequence: `slot * step` modulo `UNIT`, in two halves so that no product overflows."""
    high, low = F.shiftright(slot % UNIT, 16), slot.bitwiseAND(F.lit(0xFFFF))
    return (((high * step) % UNIT) * (1 << 16) + low * step) % UNIT


def schedule(targets: DataFrame, step: int = GOLDEN) -> tuple[DataFrame, int]:
    """`(slot, source_no, nth)` and the block length: which source each slot takes a block from, and the how-manieth of its blocks.

    There are as many slots as blocks of one length for all sources in the targets' sum. Slot j falls on the j-th
    golden-ratio point of the unit interval, which the cumulative targets cut into one stretch per source. The points are so
    even that a source draws its share of slots with an error of a few, whatever the number of slots. Slots are numbered within
    chunks, and the chunks' counts are added up, so no task holds all slots of a source. Nothing is scheduled where all targets are 0.
    """
    spark = targets.sparkSession
    words = targets.agg(F.sum("target")).first()[0] or 0.0
    length = block_length(words)
    n = int(words / length)
    by_number = Window.orderBy("source_no")
    some = targets.filter("target > 0").withColumn("sum", F.sum("target").over(by_number))
    # rounding may leave the last end just below the whole
    last = F.lead("source_no").over(by_number).isNull()
    upto = F.when(last, F.lit(UNIT)).otherwise(F.floor(F.col("sum") / F.lit(words or 1.0) * F.lit(float(UNIT))))
    ends = some.withColumn("upto", upto.cast("long"))
    stretch = ends.withColumn("after", F.coalesce(F.lag("upto").over(by_number), F.lit(0))).filter("after < upto")
    # points meet stretches by the cell of the interval they lie in
    cell_of = lambda x: F.floor(x / (UNIT // CELLS))
    spans = stretch.select(
        "source_no", "after", "upto", F.explode(F.sequence(cell_of(F.col("after")), cell_of(F.col("upto") - 1))).alias("cell")
    )
    slots = spark.range(n).select(F.col("id").alias("slot")).withColumn("point", points(F.col("slot"), step))
    # at most a span per cell, and one more per source
    drawn = slots.withColumn("cell", cell_of(F.col("point"))).join(F.broadcast(spans), "cell")
    drawn = drawn.filter((F.col("point") >= F.col("after")) & (F.col("point") < F.col("upto"))).select("slot", "source_no")
    taken = cut(drawn.withColumn("chunk", F.floor(F.col("slot") / (8 * CHUNK))))
    return numbered(taken, ["source_no"], "chunk", ["slot"], F.lit(1), "nth").select("slot", "source_no", "nth"), length


def numbered(rows: DataFrame, group: list[str], chunk: str, order: list[str], amount: Column, name: str) -> DataFrame:
    """`rows` plus `name`: the sum of `amount` over the rows of the same group that come before, by chunk, then `order`."""
    sums = rows.groupBy(*group, chunk).agg(F.sum(amount).alias("__sum"))
    past = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__past", F.coalesce(F.sum("__sum").over(past), F.lit(0))).drop("__sum")
    own = Window.partitionBy(*group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("__own", F.coalesce(F.sum(amount).over(own), F.lit(0)))
    return inner.join(sums, [*group, chunk]).withColumn(name, (F.col("__past") + F.col("__own")).cast("long")).drop("__own", "__past")


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, step: int = GOLDEN,
) -> tuple[DataFrame, DataFrame]:
    """The mix as `(documents, slices)`.

    `documents` has `(doc_id, size, source, source_size, target, taken, place, start)`, one row per row of `docs`, `taken` being
    the words the mix takes of it, repeats counted. `slices` has `(slot, source, place, doc_id, start, size, pass, first, words)`: what
    each slot of the schedule takes, as words of the source's stream, `pass` counting from 0 how often the stream has run before.

    The documents of a source are shuffled by a digest of identifier and text, and laid end to end as a stream that repeats,
    `most` times at most. The n-th slot of a source takes the n-th block of its stream; blocks have one length for all sources. So the
    schedule decides how much a source gives: its target, give or take `ERROR` blocks (and the words of a block that the
    targets' sum leaves over), or all that `most` passes hold. Blocks are short (256 words, less for small inputs), but a source whose
    target is below a few blocks may be left out or repeated in full. No document gives more than `most` times its size.

    Null and empty texts, and those of white space, have size 0 and are never taken. Null is a source of its own. Equal
    rows lie next to each other in the stream and are taken each for itself.
    Sources' totals pass through one task; documents and slots never do.
    """
    text = F.col("text").cast("string")
    sized = cut(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(text).alias("size"),
        shuffle_key().alias("place"),
    ))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    targets = cut(source_targets(sizes, weights, share, most).withColumn("source_no", number))
    slots, length = schedule(targets, step)
    slots = cut(slots)
    drawn = slots.groupBy("source_no").agg(F.count(F.lit(1)).alias("blocks"))
    given = F.least(F.coalesce("blocks", F.lit(0)) * length, F.floor(F.col("source_size") * F.lit(float(most))))
    plan = cut(targets.join(drawn, "source_no", "left").withColumn("words", given.cast("long")).drop("blocks"))
    chunks = max(1, sized.count() // CHUNK)
    # the order of the digests; the first digits of a digest name its chunk
    chunk = F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * F.lit(chunks) / F.lit(1 << 32))
    named = plan.withColumnRenamed("source", "__source")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source").withColumn("chunk", chunk)
    laid = cut(numbered(rows, ["source_no"], "chunk", ["place", "doc_id"], F.col("size"), "start"))
    passes = F.sequence(F.lit(0), F.ceil(F.lit(float(most))).cast("int") - 1)
    repeated = laid.filter("size > 0 AND words > 0").select("*", F.explode(passes).alias("pass"))
    repeated = repeated.withColumn("from", F.col("start") + F.col("pass") * F.col("source_size"))
    repeated = repeated.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("words"))).filter("from < to")
    blocks = F.sequence(F.floor(F.col("from") / length), F.floor((F.col("to") - 1) / length))
    met = repeated.withColumn("nth", F.explode(blocks)).join(slots, ["source_no", "nth"])
    begin = F.greatest(F.col("from"), F.col("nth") * length)
    end = F.least(F.col("to"), (F.col("nth") + 1) * length)
    slices = cut(met.withColumn("first", begin).withColumn("taken", end - begin).select(
        "slot", "source_no", "source", "place", "doc_id", "start", "size", "pass", "from", "first", "taken"
    ))
    per_row = slices.groupBy("source_no", "start").agg(F.sum("taken").alias("taken"))
    whole = laid.join(
        per_row.withColumnRenamed("source_no", "__no").withColumnRenamed("start", "__start"),
        (F.col("source_no") == F.col("__no")) & (F.col("start") == F.col("__start")) & (F.col("size") > 0), "left",
    )
    documents = whole.select(
        "doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "place", "start",
    )
    return documents, slices.drop("source_no", "from").withColumnRenamed("taken", "words")


def copies(slices: DataFrame) -> DataFrame:
    """`(place, source, slot, first)`: a row per document and pass of which the mix takes half or more, with the slot of its first word."""
    each = slices.groupBy("source", "place", "start", "pass").agg(
        F.sum("words").alias("words"), F.max("size").alias("size"),
        F.min(F.struct("first", "slot")).alias("begin"),
    )
    return each.filter("2 * words >= size").select("place", "source", "start", F.col("begin.slot").alias("slot"), "begin.first")


def repeat_by_mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of `docs` in the order of the schedule, each as often as the mix takes half of it or more.

    Rows that agree in `doc_id`, text and source are laid out one after the other and come as often as all of them are taken;
    where they differ in other columns, all copies are like the one that comes first as JSON text. The order is that of the
    written files and of the rows in them: slots are dealt to tasks by range and sorted there.
    """
    _, slices = mix(docs, weights, share, most)
    taken = cut(copies(slices))
    alike = taken.groupBy("place", "source").agg(F.count_distinct("start").alias("rows")).filter("rows > 1")
    several = cut(alike.select("place", "source"))
    # the given columns stay inside a struct, so none can clash with what is added
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, shuffle_key().alias("key"), F.col("source").cast("string").alias("of"))

    def same(other: DataFrame) -> Column:
        return (rows["key"] == other["place"]) & rows["of"].eqNullSafe(other["source"])

    if several.isEmpty():
        out = rows.join(taken, same(taken))
    else:
        one = taken.join(several, (taken["place"] == several["place"]) & taken["source"].eqNullSafe(several["source"]), "left_anti")
        more = taken.join(several, (taken["place"] == several["place"]) & taken["source"].eqNullSafe(several["source"]), "left_semi")
        out = rows.join(one, same(one)).select("row", "slot", "first")
        like = cut(rows.join(several, same(several), "left_semi").groupBy("key", "of").agg(F.min_by("row", F.to_json("row")).alias("row")))
        again = like.join(more, (like["key"] == more["place"]) & like["of"].eqNullSafe(more["source"]))
        out = out.unionByName(again.select("row", "slot", "first"))
    return out.repartitionByRange("slot", "first").sortWithinPartitions("slot", "first").select("row.*")
