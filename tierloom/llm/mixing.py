"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

A source's target counts in words. Whole epochs come first: every document of the source as often as the target holds
the source. The rest is a weighted sample without replacement: each document gets an exponential key divided by its
quality weight, and documents are taken in the order of their keys until their words reach the rest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.llm.common import as_text, release, stored, turns

WEIGHTS = (5, 2, 1)
# A source is repeated this often at most.
MAX_EPOCHS = 3
SEED = "mix-1"
# Key ranges of a source whose sums are added up before documents inside a range are; the range at the edge is divided
# again until it has this many documents.
RANGES = 1024
EDGE_ROWS = 1 << 16
# Symbols and digits that lower the quality weight of a text, and the least weight.
MARKS = "[#*$%&|<>!0-9]+"
LEAST_QUALITY = 0.1


def words(text: str | Column) -> Column:
    return F.regexp_count(as_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def quality(text: str | Column) -> Column:
    """The share of a text that is neither symbol nor digit, LEAST_QUALITY at least; 1 for an empty text."""
    value = as_text(text)
    clean = F.try_divide(F.length(F.regexp_replace(value, MARKS, "")), F.length(value))
    return F.greatest(F.lit(LEAST_QUALITY), F.coalesce(clean, F.lit(1.0)))


def sampling_key(id_column: str, text: str, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight with u from 52 bits of an MD5 of seed, id and text, so that reruns agree."""
    value = as_text(text)
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.md5(value.cast("binary")))
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / weight


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to a table of sources (source_key, source, source_size).

    Sources in code point order, null last, have the weights in turn. All targets together are all sizes together; a
    target stops at ``most`` times its source's size, and the excess goes to the others by weight until none is above.
    Sources that stop are those with the smallest cap for their weight, so one ordered pass finds them. The table has
    one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turns = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.element_at(turns, (F.pmod(place, F.lit(len(weights))) + 1).cast("int")))
    capped = weighed.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    everything = Window.partitionBy()
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shares = capped.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
        F.sum("weight").over(onward).alias("weight_onward"),
    ).withColumn(
        "stops",
        (F.col("total") - F.col("cap_before")) * F.col("weight") >= F.col("cap") * F.col("weight_onward"),
    )
    rest = F.col("total") - F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))).over(everything)
    shared = shares.select("*", rest.alias("rest"), open_weight.alias("open_weight"))
    target = F.when(F.col("stops"), F.col("cap")).otherwise(F.try_divide(F.col("rest") * F.col("weight"), F.col("open_weight")))
    return shared.select("source_key", "source", "source_size", target.alias("target"))


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("="), source.cast("string")))


def measured(docs: DataFrame, id_column: str, text: str, source: str, weight: str | None) -> dict[str, Column]:
    """Columns that a decision depends on: the source's key, size in words, and the sampling key."""
    given = quality(text) if weight is None else F.greatest(F.lit(LEAST_QUALITY), F.coalesce(F.col(weight), F.lit(1.0)))
    return {
        "source_key": _source_key(F.col(source)),
        "size": words(text),
        "sampling_key": sampling_key(id_column, text, given),
    }


def _narrowed(sized: DataFrame, edges: DataFrame, place: Column) -> DataFrame:
    """Of each source's key interval (low to high, ``start`` words before it) the part in which the sum reaches the rest.

    ``place`` divides an interval into RANGES parts in the order of keys, whose sums are added up first.
    """
    inside = sized.join(edges, "source_key").filter(F.col("sampling_key").between(F.col("low"), F.col("high")))
    sums = inside.groupBy("source_key", place.alias("range")).agg(
        F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("sampling_key").alias("low"),
        F.max("sampling_key").alias("high"), F.first("start").alias("start"), F.first("rest").alias("rest"),
    )
    earlier = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("start", F.col("start") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    reached = placed.filter("start <= rest and rest < start + n")
    return reached.select("source_key", "low", "high", "start", "rest", "rows")


def _edges(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """The key interval of each source in which the running sum reaches the rest, with at most EDGE_ROWS documents unless
    all have the same key."""
    whole = goals.select("source_key", F.lit(0.0).alias("low"), F.lit(math.inf).alias("high"), F.lit(0).cast("long").alias("start"), "rest")
    # Even for keys of weight 1; others follow the keys that are there.
    even = F.least(F.lit(RANGES - 1), F.floor(RANGES * (1 - F.exp(-F.col("sampling_key")))))
    share = (F.col("sampling_key") - F.col("low")) / (F.col("high") - F.col("low"))
    linear = F.least(F.lit(RANGES - 1), F.floor(RANGES * share))
    edges = stored(_narrowed(sized, whole, even), "mix-edges")
    wide = (F.col("rows") > EDGE_ROWS) & (F.col("low") < F.col("high"))
    while not edges.filter(wide).isEmpty():
        finer = stored(_narrowed(sized, edges.filter(wide).drop("rows"), linear).unionByName(edges.filter(~wide)), "mix-edges")
        release(edges)
        edges = finer
    return edges


def plan(narrow: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """One stored row per source: source_size, target, whole epochs, and where the order of sampling keys is cut.

    ``narrow`` has source_key, source, size and sampling_key. Sizes are added up per source and key range first; only
    ranges, of which a source has ``RANGES``, are added up in order, and the one at the edge is divided until it is small.
    So no task gets a whole source, whatever the weights. Documents whose midpoint in the running sum is within the rest
    are taken, which leaves the sum within half a document of it. Of rows with the same key (repeated rows), which are as
    long as each other, ``cut_taken`` of ``cut_rows`` are taken.
    """
    sizes = narrow.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    goals = stored(targets(sizes, weights, most), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.try_divide("target", "source_size"))).otherwise(0)
    goals = goals.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    )
    sized = narrow.filter("size > 0").select("source_key", "sampling_key", "size")
    edges = _edges(sized, goals)
    inside = sized.join(edges, "source_key").filter(F.col("sampling_key").between(F.col("low"), F.col("high")))
    # Equal keys as one row, at most EDGE_ROWS of them for a source.
    same = inside.groupBy("source_key", "sampling_key").agg(
        F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows"), F.first("start").alias("start"), F.first("rest").alias("rest")
    )
    earlier = Window.partitionBy("source_key").orderBy("sampling_key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    fitting = F.floor((F.col("rest") - F.col("before")) / (F.col("n") / F.col("rows")) + 0.5)
    counted = same.withColumn("before", before).withColumn("taken", F.least(fitting, F.col("rows"))).filter("taken > 0")
    last = counted.groupBy("source_key").agg(F.max(F.struct("sampling_key", "taken", "rows")).alias("last"))
    # Below the interval every document is taken, also if none inside it is.
    cut = edges.join(last, "source_key", "left").select(
        "source_key",
        F.coalesce(F.col("last.sampling_key"), F.col("low")).alias("cut_key"),
        F.coalesce(F.col("last.taken"), F.lit(0)).cast("long").alias("cut_taken"),
        F.coalesce(F.col("last.rows"), F.lit(1)).alias("cut_rows"),
    )
    return stored(goals.join(cut, "source_key", "left").drop("rest", "source"), "mix-plan")


def _is_split() -> Column:
    """Rows at the cut of which only some are taken."""
    at_cut = (F.col("sampling_key") == F.col("cut_key")) & (F.col("size") > 0)
    return F.coalesce(at_cut & (F.col("cut_taken") > 0) & (F.col("cut_taken") < F.col("cut_rows")), F.lit(False))


def _with_copies(planned: DataFrame, chosen: DataFrame) -> DataFrame:
    """Add ``copies``, how often a row is taken: every epoch, and once more if its key is before its source's cut."""
    whole = (F.col("sampling_key") < F.col("cut_key")) | (
        (F.col("sampling_key") == F.col("cut_key")) & (F.col("cut_taken") == F.col("cut_rows"))
    )
    sure = planned.withColumn("copies", F.col("epochs") + F.when(whole & (F.col("size") > 0), 1).otherwise(0))
    if chosen.filter("0 < cut_taken and cut_taken < cut_rows").isEmpty():
        return sure
    some = turns(planned.filter(_is_split()), ["source_key"], "turn", "mix-cut")
    taken = some.withColumn("copies", F.col("epochs") + F.when(F.col("turn") < F.col("cut_taken"), 1).otherwise(0))
    return sure.filter(~_is_split()).unionByName(taken.drop("turn"))


def mix_documents(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, weight: str | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (copies times size) for every document.

    ``weight`` names a column with the quality of a document, such as the posterior of the quality rules; without it the
    share of a text that is neither symbol nor digit counts. Null and empty texts have size 0 and no extra copy; a null
    source is a source of its own, the last; of repeated rows as many are taken as fit; an empty table gives no rows.
    Texts are read once. The plan has a row per source; Spark broadcasts it only if its stored size is
    below its limit, else adaptive execution splits the sources with many documents.
    """
    made = measured(docs, id_column, text, source, weight)
    columns = [F.col(id_column).alias("doc_id"), F.col(source).alias("source"), *[c.alias(n) for n, c in made.items()]]
    narrow = stored(docs.select(*columns), "mix-documents")
    chosen = plan(narrow, weights, most)
    planned = _with_copies(narrow.join(chosen, "source_key"), chosen)
    return planned.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def take(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, weight: str | None = None,
) -> DataFrame:
    """The mixture itself: every document as many times as it is taken, with its own columns."""
    made = measured(docs, id_column, text, source, weight)
    narrow = stored(docs.select(F.col(source).alias("source"), *[c.alias(n) for n, c in made.items()]), "mix-documents")
    chosen = plan(narrow, weights, most)
    release(narrow)
    # Own columns travel in one struct, so that no name clashes with those of the plan.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    planned = docs.select(whole, *[c.alias(n) for n, c in made.items()]).join(chosen, "source_key")
    copies = F.array_repeat("document", F.col("copies").cast("int"))
    return _with_copies(planned, chosen).select(F.explode(copies).alias("document")).select("document.*")
