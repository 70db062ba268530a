"""Mixing sources to target weights by entropy balancing.

Every source gets a target number of words (``source_targets``). Document rates start at one and
are tilted exponentially by size, rate = min(2, exp(lambda * size / mean size)), with one lambda a
source: the rates closest to uniform in entropy that meet the source's token constraint within
the limit of two. The convex dual is solved by Newton steps, each one aggregation over the
distributed (source, size) counts, kept inside a bracket so that it cannot diverge. Rates are then
rounded into whole copies: a document gets the floor, and one more where its hash falls under
its fraction, shifted by the source's offset that brings the taken words to the target; offsets
are found by repeated histograms.

All that belongs to a source (its target, lambda, bracket, offset) is a row of a distributed table,
written anew by each step; the driver sees single numbers only, so sources may be as many as rows.
Sources with many rows meet theirs by broadcast (``join_counted``), the others as Spark sees fit.

Null texts have size 0 and are taken once or not at all, which adds no words. A null source is a
source of its own and comes last. Repeated rows hash alike and are treated alike; ids may be
null or tied. Extra columns stay; those named as an added column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.llm import common as C

#: Fixed values of the mix: source weights in turn, all targets against all sizes, and the most
#: that a target may be of its source's size.
WEIGHTS, TOTAL, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
NEWTON_STEPS, BINS, ROUNDS = 40, 256, 5
INF = float("inf")
SOURCE = ["source_key"]


def with_size(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Append ``size``: words between ASCII white space."""
    words = F.regexp_count(F.col(text_col), F.lit("[^\\x20\\x09-\\x0D]+"))
    return C.without(docs, ["size"]).withColumn("size", F.coalesce(words, F.lit(0)).cast("long"))


def ranked(sources: DataFrame, order: list) -> DataFrame:
    """Append ``rank`` (from 0) in ``order``: rows are range-partitioned, numbered in their
    partition and shifted by the rows of the partitions before it."""
    at = C.shared_table(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = at.groupBy("part").agg(F.count(F.lit(1)).alias("part_rows"))
    before = F.sum("part_rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))      # one row a partition
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return at.join(shift, "part").withColumn("rank", own + F.col("before")).drop("part", "before")


def source_targets(sources: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """Append ``target`` to one row a source (``source_key``, ``words``): shares of ``total`` times
    all words by weight; a target above ``most`` times its source's words stops there and the excess
    is shared again. Sources come by code point, the null one last. The share a unit of weight gets
    grows from round to round until no further source stops; each round is one sum over all sources."""
    by = F.col("source_key")
    table = ranked(sources, [(by == "-").cast("int"), by.cast("binary")])
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = C.shared_table(table.withColumn("weight", turn).drop("rank"), "source-weights")
    all_words = table.agg(F.sum("words")).first()[0] or 0
    full, unit = F.lit(False), 0.0
    stopped = -1
    while True:
        r = table.agg(F.count_if(full).alias("k"), F.sum(F.when(full, F.col("words"))).alias("words"),
                      F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if r["k"] == stopped or not r["weight"]:
            return table.withColumn("target", F.when(full, most * F.col("words")).otherwise(unit * F.col("weight")))
        stopped = r["k"]
        unit = (total * all_words - most * (r["words"] or 0)) / r["weight"]
        full = F.lit(unit) * F.col("weight") >= most * F.col("words")


def _rate() -> Column:
    """The tilted rate of a row joined to its source's mean and lambda."""
    tilted = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))
    return (F.when(F.col("size") == 0, 1.0).when(F.col("lam") == math.inf, MOST)
            .otherwise(F.least(F.lit(MOST), tilted)))


def balance(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """Newton iterations on the dual: append ``lam`` to the sources (source_key, target, mean).
    ``counts``: source_key, size, n. A full target needs no step: its lambda is infinite."""
    is_full = F.col("target") >= MOST * F.col("words")
    state = sources.withColumns({
        "lam": F.when(is_full, INF).otherwise(0.0), "low": F.lit(-INF), "high": F.lit(INF),
        "done": is_full | (F.col("target") <= 0)})
    columns = state.columns
    state = C.shared_table(state, "newton")
    x = F.col("size") / F.col("mean")
    words = F.col("n") * F.col("size") * _rate()
    # decimal sums don't depend on the order of rows, so reruns take the same steps
    exact = lambda c: F.sum(c.cast("decimal(38,9)")).cast("double")
    for _ in range(NEWTON_STEPS):
        todo = state.where(~F.col("done"))
        if todo.isEmpty():
            break
        sums = (counts.join(todo.select("source_key", "mean", "lam"), "source_key").groupBy("source_key")
                .agg(exact(words).alias("got"),
                     exact(F.when(_rate() < MOST, words * x).otherwise(0.0)).alias("slope")))
        miss = F.col("got") - F.col("target")            # null for sources that are done
        met = F.abs(miss) <= 1e-9 * F.col("target") + 1e-6
        at = state.join(sums, "source_key", "left").withColumns({
            "low": F.when(miss <= 0, F.col("lam")).otherwise(F.col("low")),
            "high": F.when(miss > 0, F.col("lam")).otherwise(F.col("high"))})
        newton = F.when(F.col("slope") > 0, F.col("lam") - miss / F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        no_bracket = (F.col("low") == -INF) | (F.col("high") == INF)
        wider = F.col("lam") + F.when(miss > 0, -1.0).otherwise(1.0) * (1 + F.abs(F.col("lam")))
        step = (F.when(F.coalesce(inside, F.lit(False)), newton).when(no_bracket, wider)
                .otherwise((F.col("low") + F.col("high")) / 2))
        rest = F.coalesce(met, F.lit(True))
        state = C.shared_table(at.withColumns({"done": rest, "lam": F.when(rest, F.col("lam")).otherwise(step)})
                               .select(*columns), "newton")
    return state.drop("low", "high", "done")


def offsets(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """For each source (source_key, n_rows, target, got: words of the whole copies) append the
    offset ``shift`` so that whole copies, floor + [u - fraction < shift], come nearest to the target:
    the bin of ``v`` that crosses the target is cut again in each round."""
    state = C.shared_table(sources.select("source_key", "n_rows", (F.col("target") - F.col("got")).alias("room"),
                                          F.lit(-1.0).alias("shift"), F.lit(2.0).alias("width")), "offsets")
    for _ in range(ROUNDS):
        j = C.join_counted(rows, state, SOURCE, "n_rows").withColumn(
            "bin", F.floor((F.col("v") - F.col("shift")) / F.col("width") * BINS))
        hist = (j.where((F.col("bin") >= 0) & (F.col("bin") < BINS)).groupBy("source_key", "bin")
                .agg(F.sum("size").alias("words"), F.min("room").alias("room")))
        # BINS rows a source at most meet in a window
        upto = F.sum("words").over(Window.partitionBy("source_key").orderBy("bin"))
        over = F.col("upto") > F.col("room")
        found = (hist.withColumn("upto", upto).groupBy("source_key")
                 .agg(F.min(F.when(over, F.col("bin"))).alias("bin"),
                      F.sum(F.when(~over, F.col("words"))).alias("words")))
        crossing = F.when(F.col("words").isNull() & F.col("bin").isNull(), 0).otherwise(
            F.coalesce("bin", F.lit(BINS)))                                         # none crosses: all are taken
        state = C.shared_table(state.join(found, "source_key", "left").select(
            "source_key", "n_rows", (F.col("room") - F.coalesce("words", F.lit(0))).alias("room"),
            (F.col("shift") + crossing * F.col("width") / BINS).alias("shift"),
            (F.col("width") / BINS).alias("width")), "offsets")
    return state.select("source_key", "shift")


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Append ``size``, ``source_size``, ``target``, ``rate``, ``copies`` and ``taken``."""
    added = ["size", "source_size", "target", "rate", "copies", "taken"]
    base = with_size(C.without(docs, added), text_col)
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("-"))
    u = (F.xxhash64(F.lit("mix"), F.col(id_col).cast("string"), F.col(text_col))
         .bitwiseAND((1 << 53) - 1).cast("double") / float(1 << 53))
    base = base.withColumn("source_key", key).withColumn("u", u)
    slim = C.shared_table(base.select("source_key", "size", "u"), "mix-sizes")
    sizes = C.shared_table(slim.groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    totals = sizes.groupBy("source_key").agg(
        F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("with_words"))
    mean = F.greatest(F.lit(1.0), F.col("words") / F.greatest(F.lit(1), F.coalesce("with_words", F.lit(0))))
    sources = source_targets(totals, weights, total).withColumn("mean", mean)
    sources = balance(sizes.where("size > 0"), sources.select("source_key", "words", "n_rows", "target", "mean"))

    # floors follow from the sizes alone
    floors = (C.join_counted(sizes, sources.drop("words").join(
        sizes.groupBy("source_key").agg(F.count(F.lit(1)).alias("k")), "source_key"), SOURCE, "k")
        .groupBy("source_key").agg(F.sum(F.floor(_rate()) * F.col("size") * F.col("n")).alias("got")))
    fraction = F.col("rate") - F.floor("rate")
    open_ = (C.join_counted(slim, sources, SOURCE, "n_rows").withColumn("rate", _rate())
             .where((fraction > 0) & (F.col("size") > 0))
             .select("source_key", "size", (F.col("u") - fraction).alias("v")))
    shift = offsets(open_, sources.join(floors, "source_key"))
    at = C.shared_table(sources.join(shift, "source_key").withColumnRenamed("words", "source_size"), "source-mix")
    more = ((fraction > 0) & (F.col("u") - fraction < F.col("shift"))).cast("long")
    out = (C.join_counted(base, at, SOURCE, "n_rows").withColumn("rate", _rate())
           .withColumn("copies", F.floor("rate") + more).withColumn("taken", F.col("copies") * F.col("size")))
    keep = [c for c in base.columns if c not in ("size", "source_key", "u")]
    return out.select(*[F.col(f"`{c}`") for c in keep], *added)


def repeat_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as the mix takes it."""
    return (mixed.where("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns))
