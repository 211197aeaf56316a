"""Mixing sources to target weights by a time-varying curriculum.

DataFrame functions only.  Targets are found by water-filling over the source
table.  The documents of a source lie end to end on a token line in a fixed
scrambled order; the line repeats once per pass, and the mix takes it up to
the source's target.  A source's weight schedule is a straight line over
training time whose integral is one, so the tokens of the source demanded by
time t are ``target * (t + s * (t * t - t))``; solving that for t gives each
taken copy its training position, and documents are range-sorted by position.

Prefix sums over a source are taken in two levels (sums of slices of the sorted
rows, then rows inside one slice), so a source or an id that holds a third of
all rows is spread over many tasks.  Ties in the scrambled order are broken by
doc_id, size, a hash of the text and a hash of all columns, so equal tables give
equal mixes however their rows are dealt out.

Edge cases: a null text has size 0 and is never taken; a null source is a
source of its own, after all others; a null doc_id sorts by key 0; repeated
rows are separate documents and lie side by side, and equal ids with unlike
texts stay apart; an empty table gives an empty
result; other columns are passed through by ``mix_documents`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plume.llm.common import WORD, columns_of, cut, whole_row
from plume.operators.joins import inner_null_safe

#: weights of the sources in code-point order, repeating
WEIGHTS = (3, 1, 2)
#: slope of a source's schedule, repeating: early, even, late
SLOPES = (-0.8, 0.0, 0.8)
#: multiplier and modulus of the scrambled order (a bijection on 32-bit ids)
SCRAMBLE = 2654435761
MODULUS = 1 << 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (index % F.lit(len(values)) + 1).cast("int"))


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0,
                   weights: tuple = WEIGHTS) -> DataFrame:
    """Water-filling on a (source, source_size) table, one row per source.

    The budget ``share * sum(sizes)`` is split by weight; a source stops at
    ``cap`` times its size and the excess goes to the others by weight, until
    none is above.  With sources sorted by cap/weight that is one pass: the
    first source that stays below its cap fixes the price of all later ones.
    Both windows run over the source table, a row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")  # strings sort by code point
    named = sizes.withColumn("rank", (F.row_number().over(by_name) - 1).cast("bigint"))
    named = named.withColumn("weight", _pick(weights, F.col("rank")).cast("double")) \
        .withColumn("most", F.col("source_size") * F.lit(cap))
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    priced = named.withColumn(
        "level", (F.sum("source_size").over(every) * F.lit(share)
                  - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        / F.sum("weight").over(after))
    priced = priced.withColumn("full", F.col("most") <= F.col("level") * F.col("weight"))
    price = F.min(F.when(~F.col("full"), F.struct("rank_in_order", "level"))).over(every)
    priced = priced.withColumn("rank_in_order", F.row_number().over(order))
    target = F.when(F.col("full") | price.isNull(), F.col("most")) \
        .otherwise(F.least(F.col("most"), price["level"] * F.col("weight")))
    return priced.withColumn("target", target) \
        .drop("weight", "most", "level", "full", "rank_in_order")


def _position(words: Column, target: Column, slope: Column) -> Column:
    """Time t in [0, 1] at which ``words`` tokens of the source are demanded:
    the root of slope * t^2 + (1 - slope) * t = words / target."""
    y = F.least(F.lit(1.0), words / target)
    root = (-(1 - slope) + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * y)) / (2 * slope)
    return F.when(slope == 0, y).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), root)))


def _laid_out(docs: DataFrame, cap: float, share: float, per_range: int) -> DataFrame:
    """(doc_id, _hash, _rest, _size, source_size, target, rank, _start) of every
    row: its place on the token line of its source.

    Texts are read once, for their size and hash; the slim rows are range-sorted
    by (source, order) in slices of about ``per_range`` rows.  A source, and any
    id that stands on many rows, spreads over as many slices as it fills.
    """
    key = F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)).cast("decimal(38,0)") * F.lit(SCRAMBLE),
                 F.lit(MODULUS).cast("decimal(38,0)")).cast("bigint")
    slim = cut(docs.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_src"),
        word_count(F.col("text")).alias("_size"), key.alias("_key"), *_content(docs)))
    # rows alike in all columns are the same to the mix; their number only spreads them
    order = ["_key", "doc_id", "_size", "_hash", "_rest", "_row"]
    slim = slim.withColumn("_row", F.monotonically_increasing_id())
    slices = slim.count() // per_range + 1
    rows = cut(slim.repartitionByRange(slices, "_src", *order).withColumn("_slice", F.spark_partition_id()))
    sums = rows.groupBy("_src", "source", "_slice").agg(F.sum("_size").alias("_words"))
    # a row per slice of a source
    start = Window.partitionBy("_src").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_words").over(start), F.lit(0)))
    sizes = sums.groupBy("_src", "source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sizes, share, cap)
    sums = sums.drop("_words", "source").join(targets.drop("source"), "_src")
    inside = Window.partitionBy("_src", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    return rows.join(sums, ["_src", "_slice"]) \
        .withColumn("_start", F.col("_before") + F.col("_inside"))


def _content(docs: DataFrame) -> list[Column]:
    """Hashes of a row's text and of all its columns, which break ties of equal
    ids and sizes and find the row again."""
    every = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return [F.xxhash64("text").alias("_hash"), F.xxhash64(*every).alias("_rest")]


def _taken_in(pass_no: int) -> Column:
    """Words of a row that lie below the target in one pass over its source."""
    first = F.col("_start") + F.col("source_size") * F.lit(pass_no)
    left = F.round(F.col("target")).cast("bigint") - first
    return F.greatest(F.lit(0).cast("bigint"), F.least(F.col("_size"), left))


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0,
        per_range: int = 5_000) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and the
    training positions of its first and second copy (null if not taken), range
    sorted by first position.  ``cap`` is at most 2: two passes are laid out."""
    rows = _laid_out(docs.select("doc_id", "text", "source"), cap, share, per_range)
    slope = _pick(SLOPES, F.col("rank"))
    for p in (0, 1):
        first = F.col("_start") + F.col("source_size") * F.lit(p)
        rows = rows.withColumn(f"_taken{p}", _taken_in(p)) \
            .withColumn(f"position{p + 1}", F.when(
                F.col(f"_taken{p}") > 0, _position(first.cast("double"), F.col("target"), slope)))
    out = rows.select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                      (F.col("_taken0") + F.col("_taken1")).alias("taken"),
                      "position1", "position2")
    return out.repartitionByRange(F.col("position1").asc_nulls_last(), "doc_id") \
        .sortWithinPartitions(F.col("position1").asc_nulls_last(), "doc_id")


def mix_documents(docs: DataFrame, share: float = 1.5, cap: float = 2.0,
                  per_range: int = 5_000) -> DataFrame:
    """The mixed corpus: each taken copy of a document is a row with the input's
    columns and ``mix_position``, its training position (0 to 1), by which the
    rows are range-sorted.  The texts are joined to their positions once and
    sorted once; the order outlives any storage as it is a column.

    A copy is in the mix if at least half its words lie below the target, so a
    source's words differ from its target by at most half a document.  A
    document without words is kept where its place lies below the target.
    """
    rows = _laid_out(docs, cap, share, per_range)
    slope = _pick(SLOPES, F.col("rank"))

    def copy(p: int) -> Column:
        first = F.col("_start") + F.col("source_size") * F.lit(p)
        kept = (2 * _taken_in(p) >= F.col("_size")) & (first <= F.col("target"))
        if p:  # a document without words is not repeated
            kept = kept & (F.col("_size") > 0)
        place = F.when(F.col("target") > 0, _position(first.cast("double"), F.col("target"), slope)) \
            .otherwise(F.lit(0.0))
        return F.when(kept, place)

    same = ["_id", "_hash", "_rest"]
    places = rows.select(F.col("doc_id").alias("_id"), "_hash", "_rest",
                         F.filter(F.array(copy(0), copy(1)), lambda x: x.isNotNull()).alias("_places"))
    texts = docs.select(whole_row(docs).alias("_whole"), F.col("doc_id").alias("_id"), *_content(docs))
    often = cut(places.groupBy(*same).count().filter("count > 1").select(*same))
    if often.isEmpty():
        mixed = inner_null_safe(texts, places, same)
    else:  # of rows alike in all columns one meets all their places
        many = inner_null_safe(texts, often, same).groupBy(*same).agg(F.first("_whole").alias("_whole"))
        few = texts.join(often.withColumnRenamed("_id", "_often"), (F.col("_id").eqNullSafe(F.col("_often")))
                         & (texts["_hash"] == often["_hash"]) & (texts["_rest"] == often["_rest"]), "left_anti")
        mixed = inner_null_safe(few.unionByName(many.select(*few.columns)), places, same)
    mixed = mixed.select("_whole", "_id", "_hash", "_rest", F.explode("_places").alias("_place"))
    order = ["_place", "_id", "_hash", "_rest"]
    mixed = mixed.repartitionByRange(*order).sortWithinPartitions(*order)
    return mixed.select(*columns_of("_whole", docs.columns), F.col("_place").alias(position_name(docs.columns)))


def position_name(names: list[str]) -> str:
    """``mix_position``, with underscores added while that name is taken."""
    name = "mix_position"
    while name in names:
        name += "_"
    return name
