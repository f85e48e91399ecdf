"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the copies the mix takes of it on average. Among
all rates between 0 and ``MOST_COPIES`` that give every source its target of
tokens, the ones closest in entropy to "take each document once" are
exponentially tilted: rate = min(cap, exp(tilt * size / mean size)), with one
tilt per source. The tilts solve the convex dual by Newton's method. A rate
depends only on source and size, so the iterations run on counted cells
(source, size), one distributed aggregate each; a bracket that is known to
hold the solution guards every step.

Rates become whole copies cell by cell: running totals are rounded from the
largest size down, so the rounding errors of a source add up to at most half
its largest document, and what is left is settled with its smallest
documents. Within a cell, documents are chosen by a hash of id and text.

All of it is native: no Python on the executors. Per source, only cells meet
in one task (as many as there are distinct sizes); the documents of a cell are
ranked in buckets of a bounded share.

Defined cases: null text has size 0 and is taken 0 words (one empty copy);
a null source is a source of its own, last in order; repeated rows are
documents of their own; an empty table gives no rows. Extra columns are
carried by ``mixed`` under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import n_words, table
from tidemark.llm.registry import query
from tidemark.session import materialise, store

MOST_COPIES = 3
STEPS = 100  # many times what Newton's method and the bracket need
NEWTON = 12  # steps after which every second one cuts the bracket
TOLERANCE = 1e-4  # of a target; rounding settles the rest
BUCKET_ROWS = 20_000
WEIGHTS = (1.0, 2.0, 3.0)


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = MOST_COPIES) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Sources in order of their code points, null last, weigh ``weights``,
    repeating, and share the sum of all sizes. A target stops at ``cap`` times
    the size; the excess is shared again by weight until none is above. With
    limit / weight as order, the sources that stop are a prefix, so two running
    sums replace the rounds of sharing.
    """
    # As many rows as there are sources; their order is the feature.
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = sources.withColumns({"_w": share, "_limit": (F.col("source_size") * cap).cast("double")})
    order = Window.orderBy(F.col("_limit") / F.col("_w"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    weight = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    stops = weighed.withColumn("_rate", left / weight).withColumn("_stops", F.col("_limit") <= F.col("_rate") * F.col("_w"))
    # The rate of the first source that does not stop is the rate of all that follow.
    rate = F.min(F.when(~F.col("_stops"), F.struct(F.col("_limit") / F.col("_w"), "_rate"))).over(whole)["_rate"]
    return stops.select(
        "source", "source_size", F.when(F.col("_stops"), F.col("_limit")).otherwise(rate * F.col("_w")).alias("target")
    )


def tilts(cells: DataFrame, wanted: DataFrame, cap: int = MOST_COPIES) -> DataFrame:
    """source -> tilt and mean, so that sum(n * size * rate) is the target.

    ``cells``: source, size > 0, n. ``wanted``: source, source_size, target.
    """
    shape = cells.groupBy("source").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least")
    )
    least = F.col("least") / F.col("mean")
    ratio = F.greatest(F.col("target") / F.col("source_size"), F.lit(1e-12))
    capped = F.col("target") >= cap * F.col("source_size") * (1 - TOLERANCE)
    # At the upper end every rate is the cap, at the lower none is above target / size.
    state = wanted.alias("w").join(shape.alias("m"), F.col("w.source").eqNullSafe(F.col("m.source"))).select(
        F.col("w.source").alias("source"), "target", "mean",
        F.least(F.lit(0.0), F.log(ratio) / least).alias("low"),
        (F.log(F.lit(float(cap))) / least).alias("high"), capped.alias("done"),
    ).withColumn("tilt", F.when(F.col("done"), F.col("high")).otherwise(0.0))
    state = materialise(state, "tilts")
    for number in range(STEPS):
        at = state.alias("s").join(cells.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")))
        x = F.col("c.size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * x, F.log(F.lit(float(cap)))))
        tokens = F.col("n") * F.col("c.size")
        sums = at.groupBy(F.col("s.source").alias("source")).agg(
            F.sum(tokens * rate).alias("got"),
            F.sum(F.when(rate < cap, tokens * x * rate).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("target") - F.col("got")
        low = F.when(gap > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("high")).otherwise(F.col("tilt"))
        # Newton's step on the logarithm, which is closer to a line where rates are small.
        step = F.col("tilt") + F.log(F.col("target") / F.col("got")) * F.col("got") / F.col("slope")
        middle = (
            F.when(low > 0, F.sqrt(low * high)).when(high < 0, -F.sqrt(low * high))
            .when(low == 0, high / 8).when(high == 0, low / 8).otherwise((low + high) / 2)
        )
        # Near the cap Newton's steps come from one side and get ever shorter; cuts bring the other side along.
        trusted = F.lit(number < NEWTON or number % 2 == 0)
        inside = trusted & (F.col("slope") > 0) & (step > low) & (step < high)
        done = F.col("done") | (F.abs(gap) <= TOLERANCE * F.col("target")) | (high - low <= 1e-12 * (1 + F.abs(high)))
        state = materialise(
            state.alias("a").join(sums.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select(
                F.col("a.source").alias("source"), "target", "mean", low.alias("low"), high.alias("high"),
                F.when(done, F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"),
                done.alias("done"),
            ),
            "tilts",
        )
        if state.filter(~F.col("done")).isEmpty():
            break
    else:
        raise RuntimeError(f"the tilts did not settle in {STEPS} steps")
    return state.select("source", "mean", "tilt")


def _copies_of_cells(cells: DataFrame, wanted: DataFrame, solved: DataFrame, cap: int) -> DataFrame:
    """source, size, n, base, extra: ``extra`` of the ``n`` documents get one copy more than ``base``."""
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    rate = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.log(F.lit(float(cap)))))
    rated = (
        cells.alias("c").join(solved.alias("t"), same("c", "t")).join(wanted.alias("w"), same("c", "w"))
        .select(F.col("c.source").alias("source"), "size", "n", "target", F.round(rate, 9).alias("rate"))
        .withColumn("base", F.least(F.floor("rate"), F.lit(cap)).cast("long"))
    )
    by = Window.partitionBy("source")
    down = by.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    running = F.round(F.sum(F.col("n") * (F.col("rate") - F.col("base"))).over(down))
    rounded = rated.withColumn("_run", running.cast("long"))
    before = F.coalesce(F.lag("_run").over(by.orderBy(F.desc("size"))), F.lit(0).cast("long"))
    rounded = rounded.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("n"), F.col("_run") - before)).cast("long"))
    # What rounding left, in words, is settled from the smallest documents on.
    left = F.round(F.col("target")).cast("long") - F.sum((F.col("n") * F.col("base") + F.col("extra")) * F.col("size")).over(by)
    room = (
        F.when(F.col("_left") >= 0, F.when(F.col("base") < cap, F.col("n") - F.col("extra")).otherwise(0))
        .otherwise(F.when(F.col("base") > 0, F.col("n")).otherwise(F.col("extra")))
        .cast("long")
    )
    up = by.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    filled = rounded.withColumn("_left", left).withColumn("_room", room)
    earlier = F.coalesce(F.sum(F.col("_room") * F.col("size")).over(up), F.lit(0).cast("long"))
    more = F.least(F.col("_room"), F.greatest(F.lit(0), F.floor((F.abs("_left") - earlier) / F.col("size")))).cast("long")
    change = F.when(F.col("_left") >= 0, more).otherwise(-more)
    total = F.col("extra") + change
    return filled.select(
        "source", "size", "n",
        F.when(total < 0, F.col("base") - 1).otherwise(F.col("base")).alias("base"),
        F.when(total < 0, F.col("n") + total).otherwise(total).alias("extra"),
    )


def copies(
    sized: DataFrame, rows: int, order: list[str], weights: tuple[float, ...] = WEIGHTS, cap: int = MOST_COPIES
) -> DataFrame:
    """``sized`` (source, size and anything else) with source_size, target and copies.

    ``sized`` is a stored table of ``rows`` rows; ``order`` names the columns
    that decide which documents of a cell are taken once more.
    """
    cells = materialise(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    wanted = materialise(targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, cap), "targets")
    filled = cells.filter("size > 0")
    plan = _copies_of_cells(filled, wanted, tilts(filled, wanted, cap), cap)

    # Spread the extra copies of a cell over buckets, in proportion to their rows.
    # Their number comes from the rows alone, so that the choice does not depend on how a session is set up.
    buckets = max(1, -(-rows // BUCKET_ROWS))
    pick = F.xxhash64(*order)
    dealt = sized.withColumns({"_pick": pick, "_bucket": F.pmod(F.shiftright(pick, 20), F.lit(buckets))})
    parts = dealt.groupBy("source", "size", "_bucket").agg(F.count(F.lit(1)).alias("_m"))
    cell = Window.partitionBy("source", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("_m").over(cell)
    shares = (
        parts.withColumn("_upto", upto).alias("p")
        .join(plan.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("p.size") == F.col("c.size")))
        .select(
            F.col("p.source").alias("source"), F.col("p.size").alias("size"), "_bucket", "base",
            (F.floor(F.col("extra") * F.col("_upto") / F.col("n")) - F.floor(F.col("extra") * (F.col("_upto") - F.col("_m")) / F.col("n"))).alias("_extra"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("source", "size", "_bucket").orderBy("_pick", *order))
    ranked = dealt.withColumn("_rank", rank)
    same = F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.size") == F.col("s.size")) & (F.col("d._bucket") == F.col("s._bucket"))
    taken = F.when(F.col("d.size") == 0, F.lit(1)).otherwise(F.col("base") + F.when(F.col("_rank") <= F.col("_extra"), 1).otherwise(0))
    with_copies = ranked.alias("d").join(shares.alias("s"), same, "left").select(
        *[F.col(f"d.{c}").alias(c) for c in sized.columns], taken.cast("long").alias("copies")
    )
    return with_copies.alias("d").join(wanted.alias("w"), F.col("d.source").eqNullSafe(F.col("w.source")), "left").select(
        *[F.col(f"d.{c}").alias(c) for c in sized.columns], "source_size", "target", "copies"
    )


def _sized(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    t = F.col(f"`{text}`")
    return docs.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{source}`").alias("source"), n_words(t).alias("size"), F.xxhash64(t).alias("digest")
    )


def take(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = MOST_COPIES,
    id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """id, source, size, digest, source_size, target, copies of every document."""
    sized = store(_sized(docs, id, text, source), "sized")
    return copies(sized.df, sized.rows, ["id", "digest"], weights, cap)


def mixed(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = MOST_COPIES,
    id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    key = ["id", "source", "size", "digest"]
    # Repeated rows share a key; their copies are dealt out in turn.
    chosen = take(docs, weights, cap, id, text, source).groupBy(*key).agg(F.sum("copies").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    packed = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), *[
        c.alias(n) for n, c in zip(key, (F.col(f"`{id}`"), F.col(f"`{source}`"), n_words(F.col(f"`{text}`")), F.xxhash64(F.col(f"`{text}`"))))
    ])
    counted = store(chosen, "chosen")
    on = [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in key]
    cond = on[0] & on[1] & on[2] & on[3]
    joined = packed.alias("p").join(counted.df.alias("c"), cond)
    once = joined.filter("_n = 1").select("_row", F.col("_sum").alias("_times"))
    turn = F.row_number().over(Window.partitionBy(*[F.col(f"p.{c}") for c in key]).orderBy(F.to_json("_row"))) - 1
    again = joined.filter("_n > 1").select(
        "_row", (F.floor(F.col("_sum") / F.col("_n")) + F.when(turn < F.col("_sum") % F.col("_n"), 1).otherwise(0)).alias("_times")
    )
    times = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy")
    return once.unionByName(again).filter("_times > 0").select("_row", times).select("_row.*")


@query()
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = take(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )
