"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions by a seeded order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from logloom.llm.common import n_words, stored

_PREFIX = 4  # hexadecimal digits: 65,536 bins of the seeded order


def _key(doc_id: Column, seed: int) -> Column:
    """Place of a document in the seeded order of its source."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def sized(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    return df.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources numbered from 0 by code point, null last: ranges of them are numbered apart and then put together."""
    order = F.col("source").asc_nulls_last()
    ranges = stored(sources.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "source-ranges")
    first = ranges.groupBy("range").count().select(
        "range", (F.sum("count").over(Window.orderBy("range")) - F.col("count")).alias("first")
    )
    within = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1
    return ranges.withColumn("within", within).join(first, "range").withColumn("rank", F.col("first") + F.col("within"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """``(source, source_size, target)``: all sizes shared by weight, no source above ``epochs`` times its size.

    Water-filling: the level is what is left for the sources below their caps, by weight. Sources above their cap are
    clamped to it, which raises the level for the rest, until none is above. Each round sums over the sources in Spark;
    the driver holds two numbers.
    """
    sources = _ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    sources = stored(
        sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * epochs).alias("cap")), "sources"
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        above = F.lit(level) * F.col("weight") > F.col("cap")
        clamped, free = sources.agg(F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))).first()
        if not free:
            break
        now = (total - (clamped or 0)) / free
        if now == level:
            break
        level = now
    return sources.select(
        "source", "source_size", F.least(F.lit(level) * F.col("weight"), F.col("cap").cast("double")).alias("target")
    )


def plan(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 1) -> DataFrame:
    """``(source, source_size, target, whole, last_key)``: how often a source is taken whole, and up to which place of its
    seeded order once more. That place is where the words taken come nearest to the target.

    Sizes are summed by bins of the order first, so a source of any size is no single window; only the bin in which the
    target falls is ordered row by row.
    """
    goals = targets(sizes, weights, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    goals = stored(
        goals.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-goals"
    )
    keyed = sizes.select("source", "size", _key(F.col("id"), seed).alias("key"))
    placed = keyed.withColumn("bin", F.substring("key", 1, _PREFIX))
    bins = placed.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    running = F.sum("bin_size").over(Window.partitionBy("source").orderBy("bin"))
    edge = (
        bins.withColumn("after", running)
        .alias("b")
        .join(goals.alias("g"), F.expr("b.source <=> g.source"))
        .filter("g.rest > 0 and b.after > g.rest")
        .groupBy("b.source")
        .agg(F.min(F.struct("b.bin", (F.col("b.after") - F.col("b.bin_size")).alias("before"), "g.rest")).alias("edge"))
        .select("source", "edge.bin", "edge.before", "edge.rest")
    )
    edge = stored(edge, "mix-edges")
    inside = placed.alias("p").join(edge.alias("e"), F.expr("p.source <=> e.source and p.bin = e.bin")).select(
        "p.source", "p.key", "p.size", "e.before", "e.rest"
    )
    # Rows of one key, as of a repeated id, go together.
    inside = inside.groupBy("source", "key", "before", "rest").agg(F.sum("size").alias("size"))
    earlier = F.sum("size").over(Window.partitionBy("source").orderBy("key")) - F.col("size")
    last = (
        inside.withColumn("begin", F.col("before") + earlier)
        .filter(F.col("begin") + F.col("size") / 2 <= F.col("rest"))
        .groupBy("source")
        .agg(F.max("key").alias("last"))
    )
    found = edge.alias("e").join(last.alias("l"), F.expr("e.source <=> l.source"), "left")
    found = found.select("e.source", F.coalesce("l.last", "e.bin").alias("last_key"))
    return stored(
        goals.alias("g")
        .join(found.alias("f"), F.expr("g.source <=> f.source"), "left")
        .select("g.source", "g.source_size", "g.target", "g.whole", "f.last_key"),
        "mix-plan",
    )


def repetitions(df: DataFrame, plan_: DataFrame, doc_id: Column, source: Column, seed: int = 1) -> DataFrame:
    """``df`` with the plan's ``source_size`` and ``target`` of its source and ``repetitions``, the times a row is taken.

    The plan has a row per source: it is broadcast while Spark measures it as small, else both sides are shuffled by the
    source and a hot one is split.
    """
    plan_ = plan_.withColumnsRenamed({c: f"__{c}" for c in plan_.columns})
    more = F.coalesce((_key(doc_id, seed) <= F.col("__last_key")).cast("int"), F.lit(0))
    joined = df.join(plan_, source.eqNullSafe(F.col("__source")))
    return joined.withColumn("__repetitions", F.col("__whole") + more).drop("__source", "__whole", "__last_key")


def mix(
    df: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = (5, 2, 1),
    epochs: int = 3,
    seed: int = 1,
) -> DataFrame:
    """``(id, source, size, source_size, target, repetitions, taken)`` of every row; ``taken`` counts words with repeats.

    Null sources are a source of their own, the last. Null texts have size 0. The order, and so the choice, depends on the
    seed and the ids alone; rows with the same id are taken alike. An empty table gives an empty result. Where all texts
    are empty, targets are 0 and nothing is taken.
    """
    sizes = stored(sized(df, doc_id, source, text), "sizes")
    found = repetitions(sizes, plan(sizes, weights, epochs, seed), F.col("id"), F.col("source"), seed)
    return found.select(
        "id",
        "source",
        "size",
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__repetitions").alias("repetitions"),
        (F.col("size") * F.col("__repetitions")).alias("taken"),
    )


def take(
    df: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = (5, 2, 1),
    epochs: int = 3,
    seed: int = 1,
) -> DataFrame:
    """The mixed rows themselves: the columns of ``df``, each row as often as the mix takes it (never, or up to ``epochs`` times)."""
    sizes = stored(sized(df, doc_id, source, text), "sizes")
    found = repetitions(df, plan(sizes, weights, epochs, seed), F.col(doc_id), F.col(source), seed)
    often = F.explode(F.sequence(F.lit(1), F.col("__repetitions")))
    return found.filter("__repetitions > 0").withColumn("__copy", often).select(*[F.col(f"`{c}`") for c in df.columns])
