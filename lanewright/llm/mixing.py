"""Mixing sources to target weights by capped water-filling.

Every source has a weight. Targets share the budget by weight; a source stops at ``max_epochs`` times its size and the
excess is reshared by weight among the others until none is above. A source is then taken floor(target / size) times as
a whole, and the rest by a seeded order of its documents up to the document whose end lies nearest to the target.

Cases: a null text has size 0; documents of size 0 are kept with 0 words taken; null sources form one source, last in
order; ties in the seeded order are settled by id and, in ``mix_documents``, by a hash of the text; rows that repeat wholly
are taken alike or, at the cut, counted one by one; an empty table gives an empty result; columns other than the three named
ones pass through ``mix_documents`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.scratch import join_checked, materialise

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096
SEED = 29


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    squeezed = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return F.coalesce(F.when(squeezed == "", 0).otherwise(F.length(squeezed) - F.length(F.translate(squeezed, " ", "")) + 1), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, max_epochs: float) -> DataFrame:
    """Add ``target`` to rows (source, rank, weight, source_size); the budget is the sum of all sizes.

    With the sources in order of cap per weight, those that reach their caps form a prefix: source k is capped exactly
    when its cap is below its share of what earlier caps leave. Two running sums over the source table settle this
    without iterating. The table has a row per source, not per document.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    by_level = Window.orderBy((cap / F.col("weight")).asc(), F.col("rank"))
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    s = sources.select(
        "*", cap.alias("cap"),
        F.sum("source_size").over(whole).cast("double").alias("budget"),
        F.coalesce(F.sum(cap).over(earlier), F.lit(0.0)).alias("capped"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))).alias("open_weight"),
    )
    share = (F.col("budget") - F.col("capped")) / F.col("open_weight")
    s = s.withColumn("own_share", share).withColumn("level", F.col("cap") / F.col("weight"))
    is_open = F.col("level") > F.col("own_share")
    # the first source that does not reach its cap has the share of all that follow it
    first_open = F.min(F.when(is_open, F.struct("level", "rank", "own_share"))).over(whole)
    s = s.withColumn("share", F.coalesce(first_open["own_share"], F.lit(float("inf"))))
    return s.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * F.col("share")).alias("target"))


def source_targets(sized: DataFrame, weights: tuple[float, ...], max_epochs: float) -> DataFrame:
    """Sources in code-point order, null last, get ``weights`` in turn, repeating."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    return water_fill(ranked.withColumn("weight", weight), max_epochs)


def mix(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: float = 3.0, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, source, size, more) to rows (doc_id, source, size, source_size, target, repeats, more).

    Columns of ``sized`` beyond the three settle ties in the seeded order and are returned.
    The seeded order is cut into BINS bins by hash; sums by (source, bin) show the bin that holds the cut, and only that
    bin's documents are ordered one by one, so no task holds a whole source.
    """
    sized = materialise(sized, "mix-sizes")  # three passes follow; the texts are counted in one
    more = [c for c in sized.columns if c not in ("doc_id", "source", "size")]
    targets = materialise(source_targets(sized, weights, max_epochs), "mix-targets")
    h = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11)
    rows = sized.withColumn("h", h).withColumn("bin", F.shiftright("h", 53 - 12).cast("int"))

    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("b"))
    bins = join_checked(bins, targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    need = F.when(F.col("source_size") > 0, F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")).otherwise(0.0)
    upto = F.sum("b").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.select("source", "bin", need.alias("need"), upto.alias("upto"), (upto - F.col("b")).alias("before"))
    # the first bin whose end reaches the need, per source
    cut = bins.filter((F.col("upto") >= F.col("need")) & (F.col("before") <= F.col("need"))).groupBy("source").agg(
        F.min(F.struct("bin", "before")).alias("c")
    ).select("source", F.col("c.bin").alias("cut_bin"), F.col("c.before").alias("before"))
    plan = targets.alias("t").join(cut.alias("c"), F.expr("t.source <=> c.source"), "left").select(
        F.expr("t.source").alias("s"), "source_size", "target", "cut_bin", "before",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("epochs"),
    ).withColumn("need", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = materialise(plan, "mix-plan")
    rows = join_checked(rows, plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    at_cut = rows.filter(F.col("bin") == F.col("cut_bin"))
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("h", F.col("doc_id").asc_nulls_first(), *more).rowsBetween(Window.unboundedPreceding, 0))
    at_cut = at_cut.withColumn("extra", (upto - F.col("size") / 2 <= F.col("need")).cast("int"))
    rest = rows.filter(F.col("cut_bin").isNull() | (F.col("bin") != F.col("cut_bin"))).withColumn(
        "extra", F.coalesce((F.col("bin") < F.col("cut_bin")).cast("int"), F.lit(0))
    )
    cols = ["doc_id", "source", "size", "source_size", "target", (F.col("epochs") + F.col("extra")).cast("int").alias("repeats"), *more]
    return rest.select(*cols).unionByName(at_cut.select(*cols))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: float = 3.0, seed: int = SEED) -> DataFrame:
    """The mixed corpus itself: each document as often as the mix takes it, all its columns kept."""
    text_hash = F.xxhash64("text")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text_hash.alias("th"))
    times = mix(sized, weights, max_epochs, seed).groupBy("doc_id", "source", "th").agg(
        F.max("repeats").alias("most"), F.min("repeats").alias("least"), F.count("*").alias("n"), F.sum("repeats").alias("all")
    )
    # rows that agree in id, source and text share one entry; what the cut gave some of them goes to the first ones
    times = materialise(times.select(*[F.col(c).alias(f"_m_{c}") for c in times.columns]), "mix-times")
    d = docs.withColumn("_m_t", text_hash)
    joined = d.join(times, d.doc_id.eqNullSafe(F.col("_m_doc_id")) & d.source.eqNullSafe(F.col("_m_source")) & (F.col("_m_t") == F.col("_m_th")))
    single = joined.filter(F.col("_m_least") == F.col("_m_most")).withColumn("_m_r", F.col("_m_most"))
    w = Window.partitionBy("_m_doc_id", "_m_source", "_m_th").orderBy("text")
    split = joined.filter(F.col("_m_least") != F.col("_m_most")).withColumn("_m_k", F.row_number().over(w)).withColumn(
        "_m_r", F.col("_m_least") + (F.col("_m_k") <= F.col("_m_all") - F.col("_m_n") * F.col("_m_least")).cast("int")
    ).drop("_m_k")
    out = single.unionByName(split).filter("_m_r > 0").withColumn("_m_i", F.explode(F.sequence(F.lit(1), F.col("_m_r").cast("int"))))
    return out.select(*docs.columns)
