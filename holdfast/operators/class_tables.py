"""Splits and folds of a table with any number of classes: counts, quotas and cuts are tables too.

The few-class splits compare a row with literals. Here a class is a row of a table that is joined to
its rows. A rank of a class is looked for in slices of the hash range: slices wholly on one side of it need no
order, so only the slices that a rank cuts are sorted. A slice of many rows, as of those without a key, is cut in
slices again first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators.percentiles import order_statistics
from holdfast.session import stage_table

_SLICE_DIGITS = 4  # 65,536 slices a class at most
_FINE_DIGITS = 32 + 4  # the whole hash of the key, and of the row's content as many digits
_SLICE_ROWS = 50_000  # of a slice that is not cut again
_COPIES = 8192


def with_places(df: DataFrame, order: Sequence[str], amount: str) -> DataFrame:
    """``df`` with ``place`` (from 0) in the order of ``order`` and ``start``, the sum of ``amount`` before it.

    Sorted by ranges; a range starts where those before it end. No two rows may be equal in ``order``.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage_table(
        df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("a")).select(
        "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__n"),
        F.coalesce(F.sum("a").over(before), F.lit(0)).alias("__a"))  # a row a range
    inside = Window.partitionBy("__part").orderBy(*order)
    return ranged.join(F.broadcast(bases), "__part").select(
        *df.columns, (F.col("__n") + F.row_number().over(inside) - 1).alias("place"),
        (F.col("__a") + F.sum(amount).over(inside) - F.col(amount)).alias("start"))


def class_table(df: DataFrame, target: str) -> DataFrame:
    """(target, n, place, start): the classes in ascending order, stored."""
    counts = stage_table(df.groupBy(target).agg(F.count(F.lit(1)).alias("n")), "classes")
    if counts.filter(F.col(target).isNull()).limit(1).count():
        raise ValueError(f"'{target}' has nulls")
    return stage_table(with_places(counts, [target], "n"), "class-places")


def with_quota(classes: DataFrame, draws: int, n: str = "n", name: str = "quota") -> DataFrame:
    """Adds each class's share of ``draws`` by largest remainder; equal remainders go to the lower class first.

    Whole numbers throughout. Which classes get one more is a comparison with the last remainder that
    does, and with the last place among the classes that have it.
    """
    total = classes.agg(F.sum(n)).first()[0] or 0
    if total == 0:
        return classes.withColumn(name, F.lit(0).cast("long"))
    product = F.col(n).cast("decimal(19,0)") * F.lit(draws).cast("decimal(19,0)")
    shared = stage_table(
        classes.withColumn("__floor", F.expr(f"CAST(CAST({n} AS DECIMAL(19,0)) * {draws}BD DIV {total}BD AS BIGINT)"))
        .withColumn("__rest", (product - F.col("__floor") * F.lit(total).cast("decimal(19,0)")).cast("long")), "shares")
    size = shared.agg(F.count(F.lit(1)).alias("k"), F.sum("__floor").alias("given")).first()
    more = draws - size["given"]
    quota = F.col("__floor")
    if more:
        least = int(order_statistics(shared, {"__rest": [size["k"] - more]})["__rest", size["k"] - more])
        above = shared.filter(F.col("__rest") > least).count()
        same = shared.filter(F.col("__rest") == least)
        last = int(order_statistics(same, {"place": [more - above - 1]})["place", more - above - 1])
        gets = (F.col("__rest") > least) | ((F.col("__rest") == least) & (F.col("place") <= last))
        quota = quota + gets.cast("long")
    return shared.withColumn(name, quota).drop("__floor", "__rest")


def with_fold_ends(classes: DataFrame, k: int) -> tuple[DataFrame, list[str]]:
    """Adds the last rank of folds 0 to k - 2 of every class: the classes lie end to end and their places are
    dealt round-robin, so sizes differ by at most one, per class and overall."""
    names, end = [], F.lit(0).cast("long")
    for fold in range(k - 1):
        extra = F.when(F.pmod(F.lit(fold) - F.col("start"), F.lit(k)) < F.col("n") % k, 1).otherwise(0)
        end = end + F.expr(f"n DIV {k}") + extra
        classes = classes.withColumn(f"__end{fold}", end.cast("long"))
        names.append(f"__end{fold}")
    return classes, names


def _cut_slices(rows: DataFrame, target: str, cuts: DataFrame, n_ranks: int, digits: int,
                again: bool = False) -> DataFrame:
    """The slices that the ranks end in, ``digits`` digits of ``__hash`` long, of the slices that they ended in before.

    Of rank i, ``__r{i}``: the digits ``__e{i}`` of its slice, whether it ends with the slice ``__w{i}``, the rows
    of the class before the slice ``__f{i}``, and those to be sorted in it ``__m{i}``. Stored.
    """
    held = [(F.expr(f"substring(__hash, 1, length(__e{i}))") == F.col(f"__e{i}")) & ~F.col(f"__w{i}") for i in range(n_ranks)]
    outer, first = None, None
    for i, inside in enumerate(held):
        outer = F.when(inside, F.col(f"__e{i}")) if outer is None else outer.when(inside, F.col(f"__e{i}"))
        first = F.when(inside, F.col(f"__f{i}")) if first is None else first.when(inside, F.col(f"__f{i}"))
    upto = F.col("__first") + F.sum("__m").over(Window.partitionBy(target, "__outer").orderBy("__slice"))
    if again:
        rows = rows.select(target, "__hash").join(cuts, target).select(
            target, "__hash", outer.alias("__outer"), first.alias("__first")).filter(F.col("__outer").isNotNull())
    else:
        rows = rows.select(target, "__hash", F.lit("").alias("__outer"), F.lit(0).cast("long").alias("__first"))
    slices = (
        rows.withColumn("__slice", F.substring("__hash", 1, digits)).groupBy(target, "__outer", "__first", "__slice").agg(
            F.count(F.lit(1)).alias("__m"))
        .withColumn("__upto", upto).join(cuts, target)
    )
    before = F.col("__upto") - F.col("__m")
    found = []
    for i in range(n_ranks):
        rank = F.col(f"__r{i}")
        holds = (F.col("__outer") == F.col(f"__e{i}")) & ~F.col(f"__w{i}") & (before < rank) & (rank <= F.col("__upto"))
        found += [
            F.max(F.when(holds, F.col("__slice"))).alias(f"__s{i}"), F.max(F.when(holds, F.col("__upto") == rank)).alias(f"__t{i}"),
            F.max(F.when(holds, before)).alias(f"__b{i}"), F.max(F.when(holds, F.col("__m"))).alias(f"__c{i}"),
        ]
    ended = cuts.join(slices.groupBy(target).agg(*found), target, "left")
    columns = [target]
    for i in range(n_ranks):
        columns += [
            F.col(f"__r{i}"), F.coalesce(f"__s{i}", f"__e{i}").alias(f"__e{i}"),
            # No slice holds a rank of 0, and one that ended with its slice stays.
            F.coalesce(F.col(f"__t{i}"), F.lit(True)).alias(f"__w{i}"), F.coalesce(f"__b{i}", f"__f{i}").alias(f"__f{i}"),
            F.when(~F.col(f"__t{i}"), F.col(f"__c{i}")).otherwise(0).alias(f"__m{i}"),
        ]
    return stage_table(ended.select(*columns), "cuts")


def between_ranks(df: DataFrame, target: str, hashed: Column, classes: DataFrame, ranks: Sequence[str],
                  names: Sequence[object], name: str) -> DataFrame:
    """Adds names[i] for the first rank that the row's place in its class does not exceed, the last name beyond all.

    ``ranks`` names columns of ``classes`` that do not fall from one to the next. ``hashed`` orders the rows of a
    class; rows with the same text have to be equal in every column, as a rank among them takes any of them.
    Those are counted and dealt in pieces, not sorted.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("__hash", hashed)
    whole = classes.select(target, *[F.col(r).alias(f"__r{i}") for i, r in enumerate(ranks)], *[
        c for i in range(len(ranks)) for c in (
            F.lit("").alias(f"__e{i}"), F.lit(False).alias(f"__w{i}"), F.lit(0).cast("long").alias(f"__f{i}"))])
    cuts = _cut_slices(rows, target, whole, len(ranks), _SLICE_DIGITS)
    largest = cuts.agg(F.max(F.greatest(F.lit(0), *[F.col(f"__m{i}") for i in range(len(ranks))]))).first()[0]
    if (largest or 0) > _SLICE_ROWS:
        cuts = _cut_slices(rows, target, cuts, len(ranks), _FINE_DIGITS, again=True)
    slot, undecided, edge, offset = None, None, None, None
    for i, label in enumerate(names[:-1]):
        part = F.expr(f"substring(__hash, 1, length(__e{i}))")
        here = part == F.col(f"__e{i}")
        cut = here & ~F.col(f"__w{i}")
        below = (F.col(f"__e{i}") != "") & (part <= F.col(f"__e{i}"))
        slot = F.when(cut, None) if slot is None else slot.when(cut, None)
        slot = slot.when(below, F.lit(label))
        undecided = cut if undecided is None else undecided | cut
        edge = F.when(cut, F.col(f"__e{i}")) if edge is None else edge.when(cut, F.col(f"__e{i}"))
        offset = F.when(cut, F.col(f"__f{i}")) if offset is None else offset.when(cut, F.col(f"__f{i}"))
    placed = rows.join(cuts, target).withColumn("__slice", edge)
    decided = placed.filter(~undecided).withColumn(name, slot.otherwise(F.lit(names[-1]))).select(*df.columns, name)

    equal = placed.filter(undecided).groupBy(target, "__slice", "__hash").agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("__row"),
        F.first(offset).alias("__first"), *[F.first(f"__r{i}").alias(f"__r{i}") for i in range(len(ranks))])
    start = F.col("__first") + F.sum("__n").over(
        Window.partitionBy(target, "__slice").orderBy("__hash")) - F.col("__n")
    pieces, low = [], F.lit(0).cast("long")
    for i, label in enumerate(names):
        end = F.col("__start") + F.col("__n")
        high = F.col(f"__r{i}") if i < len(ranks) else end
        amount = F.least(end, high) - F.greatest(F.col("__start"), low)
        pieces.append(F.struct(F.lit(label).alias("label"), amount.alias("amount")))
        low = high
    # Copies of one row may be many: they are numbered out of pieces that are spread before.
    dealt = (
        equal.withColumn("__start", start).withColumn("__piece", F.explode(F.array(*pieces)))
        .filter("__piece.amount > 0")
        .withColumn("__chunk", F.explode(F.sequence(
            F.lit(0).cast("long"), F.col("__piece.amount") - 1, F.lit(_COPIES).cast("long"))))
        .repartition(parts, "__hash", "__chunk")
        .withColumn("__copy", F.explode(F.sequence(
            "__chunk", F.least(F.col("__chunk") + _COPIES, F.col("__piece.amount")) - 1)))
        .select(*[F.col("__row").getField(c).alias(c) for c in df.columns], F.col("__piece.label").alias(name))
    )
    return decided.unionByName(dealt)


def with_balanced_weight(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    """n / (classes * n_class) on every row, for any number of classes; rows without a class weigh 1."""
    counts = stage_table(df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("__n")), "classes")
    total = counts.agg(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    weight = F.lit(float(total["n"] or 0)) / (F.lit(float(total["k"])) * F.col("__n"))
    return df.join(counts, target, "left").withColumn(name, F.coalesce(weight, F.lit(1.0))).select(*df.columns, name)
