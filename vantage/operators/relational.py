"""Relational building blocks: keep-first/keep-latest, arg-max/arg-min,
centroids and range lookups.

All of them are plain DataFrame compositions so Catalyst sees the whole plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = Column | str


def _order_cols(order: Sequence[OrderSpec]) -> list[Column]:
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec],
               rank_col: str = "_rn") -> DataFrame:
    """One row per ``keys``: the first row under ``order`` (strings sort ascending,
    NULLS LAST; pass Columns for other directions).

    ``row_number() = 1`` is planned by Catalyst as a partial ``WindowGroupLimit``
    before the shuffle and a final one after it, so each map task forwards at most
    one row per key: a hot key costs one row per map task, not all its rows.
    Callers must add a tie-break so the result is deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) == 1)
              .drop(rank_col))


def keep_latest(df: DataFrame, keys: Sequence[str], by: Sequence[str],
                tiebreak: Sequence[OrderSpec] = ()) -> DataFrame:
    """One row per ``keys`` with the greatest ``by`` (NULLS LAST), then ``tiebreak``."""
    order = [F.col(c).desc_nulls_last() for c in by] + list(tiebreak)
    return keep_first(df, keys, order)


def arg_max(value: str, by: str) -> Column:
    """``value`` at the maximum of ``by`` over rows where both are non-NULL.

    Ties on ``by`` go to the greatest ``value`` so the result is deterministic.
    """
    ok = F.col(value).isNotNull() & F.col(by).isNotNull()
    return F.max_by(F.when(ok, F.col(value)), F.when(ok, F.struct(F.col(by), F.col(value))))


def arg_min(value: str, by: str) -> Column:
    """``value`` at the minimum of ``by`` over rows where both are non-NULL.

    Ties on ``by`` go to the smallest ``value``.
    """
    ok = F.col(value).isNotNull() & F.col(by).isNotNull()
    return F.min_by(F.when(ok, F.col(value)), F.when(ok, F.struct(F.col(by), F.col(value))))


def centroid(df: DataFrame, key: str, lat: str, lng: str,
             out_key: str | None = None, out_lat: str = "lat", out_lng: str = "lng") -> DataFrame:
    """Mean coordinate per key (hash aggregate, map-side partial sums)."""
    return (df.groupBy(F.col(key).alias(out_key or key))
              .agg(F.avg(F.col(lat).cast("double")).alias(out_lat),
                   F.avg(F.col(lng).cast("double")).alias(out_lng)))


#: bins of equal numbers of range starts (a power of two), and cells of equal width in each
_BINS, _CELLS = 1024, 64


def _cell(value: Column, edges: Column) -> Column:
    """Cell of a value: it never falls while the value rises, and follows the density of the
    edges.  Null for null."""
    v = value.cast("double")
    steps = F.array(*(F.lit(_BINS >> k) for k in range(1, _BINS.bit_length())))
    bin_ = F.aggregate(steps, F.lit(-1), lambda b, s: F.when(v >= F.get(edges, b + s), b + s).otherwise(b))

    def place(b: Column) -> Column:
        left, right = F.get(edges, b), F.get(edges, b + 1)
        share = F.coalesce(F.try_divide(v - left, right - left), F.lit(0.0))
        inner = F.floor(F.least(F.greatest(share * _CELLS, F.lit(0.0)), F.lit(_CELLS - 1.0))).cast("int")
        return b * _CELLS + inner

    return F.when(v.isNotNull(), F.get(F.transform(F.array(bin_), place), F.lit(0)))


def range_lookup(df: DataFrame, value: str, ranges: DataFrame, lo: str, hi: str) -> DataFrame:
    """Left range join ``lo <= value < hi`` on numbers, as an equi-join.

    The ranges are cut to cells and both sides meet on a cell; the exact bounds are a condition
    of the join.  Cells come from up to 1,023 quantiles of the range starts (one row, read
    as a subquery), so a dense part of the domain has narrow ones.  The cut ranges are never
    broadcast: their size is estimated before they are cut, so too small by far, and they would
    fill the driver.  Spark splits a hot cell's values over tasks.  A range costs a row for each
    cell that it covers.

    A null value and a value outside all ranges keep their row with nulls; a value in several
    ranges has a row for each; ranges with a null bound or ``lo >= hi`` hold nothing.
    """
    shares = F.array(*(F.lit(k / _BINS) for k in range(1, _BINS)))
    edges = ranges.agg(F.percentile_approx(F.col(lo).cast("double"), shares, F.lit(10000))).scalar()
    held = ranges.where(F.col(lo) < F.col(hi)).withColumn("_edges", edges)  # no subquery inside a lambda
    ends = F.sequence(*(_cell(F.col(c), F.col("_edges")) for c in (lo, hi)))
    cut = held.select("*", F.explode(ends).alias("_range_cell")).drop("_edges")
    placed = (df.withColumn("_edges", edges).withColumn("_value_cell", _cell(F.col(value), F.col("_edges")))
              .drop("_edges"))
    cond = ((F.col("_value_cell") == F.col("_range_cell"))
            & (F.col(value) >= cut[lo]) & (F.col(value) < cut[hi]))
    return placed.join(cut.hint("merge"), cond, "left").drop("_value_cell", "_range_cell")


def _before(df: DataFrame, groups: Sequence[str], block: str, order: str, **totals) -> DataFrame:
    """``df`` with, for each name in ``totals`` (an aggregate function: ``F.sum`` or ``F.max``), the
    total over the rows of the same group that come before in ``order`` (unique in a group;
    ``block`` never falls while it rises).  No rows before: 0 for a sum, null for a max.

    A block's rows are run through in one task, and so are a group's blocks."""
    earlier = (Window.unboundedPreceding, -1)
    of_blocks = Window.partitionBy(*groups).orderBy(block).rowsBetween(*earlier)
    in_block = Window.partitionBy(*groups, block).orderBy(order).rowsBetween(*earlier)
    sums = df.groupBy(*groups, block).agg(*(f(c).alias(c) for c, f in totals.items()))
    sums = sums.select(*(F.col(c).alias(f"_at_{c}") for c in (*groups, block)),
                       *(f(c).over(of_blocks).alias(f"_of_{c}") for c, f in totals.items()))
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in (*groups, block)]

    def both(c: str, f) -> Column:
        inner, outer = f(c).over(in_block), F.col(f"_of_{c}")
        if f is F.max:
            return F.greatest(inner, outer)
        return F.coalesce(inner, F.lit(0)) + F.coalesce(outer, F.lit(0))

    joined = df.join(sums, same)
    return joined.select(*df.columns, *(both(c, f).alias(f"{c}_before") for c, f in totals.items()))


#: neighbouring segments whose running counts one task holds: 2 ** 12
_NEAR = 12


def _nested(pairs: DataFrame, spans: DataFrame) -> DataFrame:
    """``(i, j, nested)``: the sum of ``n`` over the ``pairs`` (a, b, n), a < b, with i <= a and
    b < j, for each span (i, j) that holds any.

    A span is the union of a few dyadic nodes (two a level at most), a pair lies in one node
    a level by its ``a``; within a node the pairs with b < j are a running total.  So both sides
    cost rows by the logarithm of the longest span, whatever the number of pairs in a span."""
    top = F.floor(F.log2(F.max(F.col("j") - F.col("i")))).cast("int") + 1
    levels = F.sequence(F.lit(0), F.coalesce(spans.agg(top).scalar(), F.lit(0)))
    points = (pairs.select("a", "b", "n", F.explode(levels).alias("level"))
              .select("level", F.expr("a div shiftleft(1L, level)").alias("node"), F.col("b").alias("at"), "n"))
    left, right = F.expr("(i + shiftleft(1L, level) - 1) div shiftleft(1L, level)"), F.expr("j div shiftleft(1L, level)")
    own = F.sequence(F.lit(0), F.floor(F.log2(F.col("j") - F.col("i"))).cast("int") + 1)
    ends = (spans.select("i", "j", F.explode(own).alias("level"))
            .select("i", "j", "level", left.alias("l"), right.alias("r")).where("l < r"))
    nodes = F.array_compact(F.array(F.when(F.col("l") % 2 == 1, F.col("l")), F.when(F.col("r") % 2 == 1, F.col("r") - 1)))
    asked = ends.select("i", "j", "level", F.explode(nodes).alias("node"))
    rows = (points.unionByName(asked.select("level", "node", F.col("j").alias("at"), F.lit(0).cast("long").alias("n")))
            .groupBy("level", "node", "at").agg(F.sum("n").alias("n"))
            .withColumn("block", F.expr(f"at div {1 << _NEAR}")))
    counts = _before(rows, ["level", "node"], "block", "at", n=F.sum).select("level", "node", F.col("at").alias("j"), "n_before")
    return (asked.join(counts.where("n_before > 0").hint("merge"), ["level", "node", "j"])
            .groupBy("i", "j").agg(F.sum("n_before").alias("nested")))


def range_totals(df: DataFrame, value: str, key: str, ranges: DataFrame, lo: str, hi: str, by: str,
                 root: str) -> DataFrame:
    """Per ``by`` of the ranges, over the rows that :func:`range_lookup` finds for it:
    ``rows``, ``keys`` (different non-null ``key``) and ``top`` (greatest value).  Ranges that share
    a ``by`` must share their ``lo``.  Rows in no range count under a null ``by``, with those
    of ranges that have none.

    The rows found are never built, they grow with rows times ranges.  The range bounds cut the
    domain to segments, each row is looked up in its one segment, and a range is a run of
    segments: ``rows`` and ``top`` are running totals.  So are ``keys``, as the number of (key,
    segment) less that of a key's neighbouring segments that both lie in the range.  Segments and
    their totals are written below ``root``."""
    spark = df.sparkSession
    held = ranges.where(F.col(lo) < F.col(hi)).select(F.col(by).alias("by"), F.col(lo).alias("lo"), F.col(hi).alias("hi"))
    one, free = F.lit(1).cast("long"), F.col("by").isNull().cast("long")
    ends = held.select(F.explode(F.array(F.struct(F.col("lo").alias("start"), one.alias("over"), free.alias("free")),
                                         F.struct(F.col("hi").alias("start"), (-one).alias("over"), (-free).alias("free")))).alias("e"))
    cuts = ends.groupBy(F.col("e.start").alias("start")).agg(F.sum("e.over").alias("over"), F.sum("e.free").alias("free"))
    shares = F.array(*(F.lit(k / _BINS) for k in range(1, _BINS)))
    bins = cuts.agg(F.percentile_approx(F.col("start").cast("double"), shares, F.lit(10000))).scalar()
    cuts = (cuts.withColumn("_edges", bins).withColumn("block", _cell(F.col("start"), F.col("_edges"))).drop("_edges")
            .withColumn("one", one))
    cuts = _before(cuts, [], "block", "start", one=F.sum, over=F.sum, free=F.sum)
    cuts.select("start", "block", F.col("one_before").alias("no"), (F.col("over") + F.col("over_before")).alias("over"),
                (F.col("free") + F.col("free_before")).alias("free")).write.parquet(f"{root}/cuts")
    cuts = spark.read.parquet(f"{root}/cuts")
    after = cuts.select(F.col("start").alias("end"), (F.col("no") - 1).alias("no"))
    segments = cuts.drop("block").join(after.hint("merge"), "no")
    spans = (held.select("by", "lo", "hi").join(cuts.select(F.col("start").alias("lo"), F.col("no").alias("i")).hint("merge"), "lo")
             .join(cuts.select(F.col("start").alias("hi"), F.col("no").alias("j")).hint("merge"), "hi").select("by", "i", "j"))
    longest = spans.agg(F.max(F.col("j") - F.col("i"))).scalar()

    found = range_lookup(df.select(F.col(key).alias("key"), F.col(value).alias("value")), "value", segments, "start", "end")
    times = F.when(F.coalesce("over", F.lit(0)) == 0, one).otherwise(F.col("free"))  # counted without a ``by``
    met = found.groupBy("key", "no", times.alias("times")).agg(F.count(F.lit(1)).alias("rows"), F.max("value").alias("top"))
    of_key = Window.partitionBy("key", F.when(F.col("key").isNull(), F.col("no"))).orderBy("no")
    opens = F.sum(F.when(F.col("times") > 0, 1)).over(of_key.rowsBetween(Window.unboundedPreceding, 0)) == 1
    loose = F.col("times") > 0
    met = met.select("*", F.lead("no").over(of_key).alias("next"), F.col("key").isNotNull().alias("keyed"),
                     (loose & opens & F.col("key").isNotNull()).alias("opens"))
    near = F.when(F.col("keyed") & (F.col("next") - F.col("no") < longest), F.col("next"))
    spots = met.groupBy("no", near.alias("next")).agg(
        F.sum("rows").alias("rows"), F.count_if("keyed").alias("keys"), F.max("top").alias("top"),
        F.sum(F.col("rows") * F.col("times")).alias("loose_rows"), F.count_if("opens").alias("loose_keys"),
        F.max(F.when(loose, F.col("top"))).alias("loose_top"))
    spots.write.parquet(f"{root}/spots")
    spots = spark.read.parquet(f"{root}/spots")

    totals = spots.where("no IS NOT NULL").groupBy("no").agg(F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.max("top").alias("top"))
    none = F.lit(0).cast("long")
    line = cuts.select("no", "block").join(totals.hint("merge"), "no", "left").select(
        "no", "block", F.coalesce("rows", none).alias("rows"), F.coalesce("keys", none).alias("keys"), "top")
    line = _before(line, [], "block", "no", rows=F.sum, keys=F.sum, top=F.max)
    at = lambda end, tag: line.select(F.col("no").alias(end), *(F.col(f"{c}_before").alias(f"{tag}_{c}") for c in ("rows", "keys", "top")))
    asked = spans.select("i", "j").distinct()
    pairs = spots.where("next IS NOT NULL").select(F.col("no").alias("a"), F.col("next").alias("b"), F.col("keys").alias("n"))
    full = (asked.join(at("i", "from").hint("merge"), "i").join(at("j", "to").hint("merge"), "j")
            .join(_nested(pairs, asked).hint("merge"), ["i", "j"], "left")
            .select("i", "j", (F.col("to_rows") - F.col("from_rows")).alias("rows"),
                    (F.col("to_keys") - F.col("from_keys") - F.coalesce("nested", none)).alias("keys"), F.col("to_top").alias("top"))
            .where("rows > 0"))
    named = (spans.where("by IS NOT NULL").join(full.hint("merge"), ["i", "j"]).groupBy("by")
             .agg(F.sum("rows").alias("rows"), F.max("keys").alias("keys"), F.max("top").alias("top")))
    rest = (spots.agg(F.sum("loose_rows").alias("rows"), F.sum("loose_keys").alias("keys"), F.max("loose_top").alias("top"))
            .where("rows > 0").select(F.lit(None).cast(held.schema["by"].dataType).alias("by"), "rows", "keys", "top"))
    return named.unionByName(rest).withColumnRenamed("by", by)


def dup_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Key combinations that occur more than once, with their count (HAVING > 1)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))
