"""Point-in-time feature panels.

A panel has one row per ``(entity, snapshot)``; every value in the row uses only
facts whose timestamp is at or before the snapshot.  Snapshots come from a
regular spine (monthly or daily) between the first and the last fact.

How a panel is computed:

    No join against the facts (only the one-row spine bounds are attached).
    Facts are aggregated per ``(entity, snapshot)`` with map-side partial
    aggregation, so a hot entity is pre-combined in every map task.  A window
    over the entity (its rows are bounded by the spine length, not by the
    data) turns the per-snapshot increments into lifetime running values and
    fans out to every eligible snapshot; eligibility (first fact <= snapshot +
    lead) is derived in the same window, so the entity x spine cross join
    never exists.  Trailing windows, by kind:

    * aligned to the spine step (24 h / 7 d on a daily spine), additive, or distinct
      counts of a small domain (bits of a long, joined by OR): sliding frames over
      the dense per-entity rows, nothing explodes;
    * other distinct counts over long windows: merged coverage intervals per
      (entity, value), +1/-1 deltas summed by the same running window;
    * the rest: each fact is exploded to the few snapshots its window
      touches (<= 2 for 30 days on a monthly spine).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.functions.columns import safe_rate

AGGS = ("count", "count_distinct", "sum", "avg", "min", "max", "rate",
        "days_since_min", "days_since_max")


@dataclass(frozen=True)
class Feature:
    """One feature of a point-in-time panel.

    ``agg``      count | count_distinct | sum | avg | min | max | rate |
                 days_since_min | days_since_max (days from the min/max of the
                 fact timestamp to the snapshot).
    ``column``   input column (ignored by the days_since aggregates).
    ``where``    row filter (numerator filter for ``rate``).
    ``den_where`` denominator filter for ``rate`` (None = every row).
    ``window``   trailing window as an interval string (``"30 days"``,
                 ``"24 hours"``), closed at both ends; None = lifetime.
    ``default``  value for an empty group (counts and rates always use 0).
    ``domain``   most different values that ``column`` may have (64 at most).  Its values are
                 then numbered in their order, so that a text's min or max is one of
                 integers (hash aggregation) and a distinct count the bits of one long
                 (no Expand).  More values fail the query.
    """

    name: str
    agg: str
    column: str | None = None
    where: Column | None = field(default=None, compare=False)
    den_where: Column | None = field(default=None, compare=False)
    window: str | None = None
    default: object = None
    domain: int | None = None

    def __post_init__(self):
        if self.domain is not None and not (1 <= self.domain <= 64 and self.agg in ("min", "max", "count_distinct")):
            raise ValueError("domain: 1 to 64, for min, max and count_distinct")
        if self.agg not in AGGS:
            raise ValueError(f"unknown aggregate {self.agg!r}")
        if self.agg == "count_distinct" and self.window is None:
            raise ValueError("lifetime count_distinct is not supported")


# --------------------------------------------------------------------- spine

_UNITS = {"month": "1 MONTH", "day": "1 DAY"}


def _step_expr(unit: str) -> Column:
    return F.expr(f"INTERVAL {_UNITS[unit]}")


def floor_unit(ts: Column, unit: str) -> Column:
    """Spine date at or before ``ts`` (DATE)."""
    if unit == "month":
        return F.trunc(ts, "month")
    if unit == "day":
        return F.to_date(ts)
    raise ValueError(f"unsupported spine unit {unit!r}")


def add_steps(d: Column, unit: str, n: int = 1) -> Column:
    return F.add_months(d, n) if unit == "month" else F.date_add(d, n)


def ceil_unit(ts: Column, unit: str) -> Column:
    """First spine date at or after ``ts`` (DATE); exact when ``ts`` is on it."""
    f = floor_unit(ts, unit)
    return F.when(f.cast("timestamp_ntz") == ts.cast("timestamp_ntz"), f).otherwise(add_steps(f, unit))


def _interval(spec: str) -> Column:
    return F.expr(f"INTERVAL {spec}")


SLIDABLE = ("count", "sum", "avg", "min", "max", "rate")

def aligned_steps(window: str | None, unit: str) -> int | None:
    """``n`` when the window is exactly ``n >= 1`` spine steps (24 hours or 7 days
    on a daily spine, 2 months on a monthly one), else None."""
    import re
    m = re.fullmatch(r"\s*(\d+)\s*(hour|hours|day|days|month|months)\s*", (window or "").lower())
    if not m:
        return None
    k, what = int(m.group(1)), m.group(2).rstrip("s")
    if unit == "day":
        n = k if what == "day" else (k // 24 if what == "hour" and k % 24 == 0 else None)
    else:
        n = k if what == "month" else None
    return n if n and n >= 1 else None


def spine_bounds(facts: DataFrame, ts: str, unit: str = "month") -> DataFrame:
    """One row ``(spine_lo, spine_hi)``: the floors of the min and max timestamp.

    A global aggregate always yields exactly one row, so joining it is a proven
    one-row broadcast.
    """
    return facts.agg(floor_unit(F.min(ts), unit).alias("spine_lo"),
                     floor_unit(F.max(ts), unit).alias("spine_hi"))


def time_spine(facts: DataFrame, ts: str, unit: str = "month",
               out: str = "snapshot_date") -> DataFrame:
    """Inclusive regular spine between the first and the last fact."""
    b = spine_bounds(facts, ts, unit)
    return b.select(F.explode(F.sequence("spine_lo", "spine_hi", _step_expr(unit))).alias(out))


def panel_size(entities: int, facts: DataFrame, ts: str, unit: str = "month") -> int:
    """Most rows that a panel of so many entities can have: each at every snapshot."""
    return entities * time_spine(facts, ts, unit).count()


def _start_snapshot(first_ts: Column, lo: Column, unit: str, lead: str) -> Column:
    """Earliest spine date ``d >= lo`` with ``first_ts <= d + lead``."""
    ts = first_ts.cast("timestamp_ntz")
    cand = F.greatest(lo, floor_unit(ts - _interval(lead), unit))
    ok = (cand.cast("timestamp_ntz") + _interval(lead)) >= ts
    return F.when(ok, cand).otherwise(add_steps(cand, unit))


def eligible_pairs(facts: DataFrame, entity: str, ts: str, unit: str = "month",
                   lead: str = "1 month", out: str = "snapshot_date",
                   bounds: DataFrame | None = None) -> DataFrame:
    """``(entity, snapshot)`` for every snapshot with a fact at or before
    ``snapshot + lead`` (the EXISTS rule), generated per entity with
    ``explode(sequence(...))``: no entity x spine cross join."""
    b = bounds if bounds is not None else spine_bounds(facts, ts, unit)
    first = (facts.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
                  .groupBy(entity).agg(F.min(ts).alias("_first_ts")))
    start = _start_snapshot(F.col("_first_ts"), F.col("spine_lo"), unit, lead)
    seq = F.when(start <= F.col("spine_hi"),
                 F.sequence(start, F.col("spine_hi"), _step_expr(unit)))
    return (first.crossJoin(F.broadcast(b))
                 .select(entity, F.explode(seq).alias(out)))


# ----------------------------------------------------------- small domains

_CODE = "_code_"


def _code(column: str) -> str:
    return _CODE + column


def encode_domains(facts: DataFrame, features: Sequence[Feature],
                   source: DataFrame | None = None) -> tuple[DataFrame, list[Feature], dict[str, Column]]:
    """Facts with an order-preserving number (from 1) beside each column of a small domain,
    the features on those numbers, and for each column its values in order: one row that
    Spark computes as a subquery from one aggregate of at most ``domain`` values.  ``source``
    holds the same values as the facts and may be cheaper to read."""
    least: dict[str, int] = {}
    for f in features:
        if f.domain is not None:
            least[f.column] = min(f.domain, least.get(f.column, 64))
    if not least:
        return facts, list(features), {}
    held = {c: F.sort_array(F.collect_set(c)) for c in least}
    checked = [F.when(F.size(v) <= least[c], v).otherwise(F.raise_error(F.lit(f"{c}: more than {least[c]} values"))
                                                          .cast(f"array<{facts.schema[c].dataType.simpleString()}>")).alias(c)
               for c, v in held.items()]
    values = (facts if source is None else source).agg(F.struct(*checked).alias("values")).scalar()
    domains = {c: values[c] for c in least}
    coded = facts.select("*", *(F.when(F.col(c).isNotNull(), F.array_position(d, F.col(c))).alias(_code(c))
                                for c, d in domains.items()))
    return coded, [replace(f, column=_code(f.column)) if f.domain is not None else f for f in features], domains


def decode_domains(panel: DataFrame, features: Sequence[Feature], domains: dict[str, Column]) -> DataFrame:
    """Numbers of min and max features back to their values."""
    back = {f.name: F.get(domains[f.column], F.col(f.name).cast("int") - 1).alias(f.name)
            for f in features if f.domain is not None and f.agg in ("min", "max")}
    return panel.select(*(back.get(c, F.col(c)) for c in panel.columns)) if back else panel


def _distinct_count(f: Feature, base: Column) -> Column:
    if not f.column.startswith(_CODE):
        return F.count_distinct(F.when(base, F.col(f.column)))
    return F.bit_count(F.coalesce(F.bit_or(F.when(base, _bit(f))), F.lit(0).cast("long")))


def _bit(f: Feature) -> Column:
    """The bit of a value's number."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(f.column).cast("int") - 1)


# ------------------------------------------------------------- direct form

def _direct_agg(f: Feature, ts: Column, snap_ts: Column, ts_name: str) -> Column:
    cond = ts <= snap_ts
    if f.window is not None:
        cond = cond & (ts >= snap_ts - _interval(f.window))
    base = cond if f.where is None else (cond & f.where)
    col = F.col(f.column) if f.column else None
    if f.agg == "count":
        return F.count(F.when(base, col))
    if f.agg == "count_distinct":
        return _distinct_count(f, base)
    if f.agg == "sum":
        return F.coalesce(F.sum(F.when(base, col)), F.lit(f.default)) if f.default is not None \
            else F.sum(F.when(base, col))
    if f.agg == "avg":
        return F.avg(F.when(base, col))
    if f.agg == "min":
        return F.min(F.when(base, col))
    if f.agg == "max":
        return F.max(F.when(base, col))
    if f.agg == "rate":
        den = cond if f.den_where is None else (cond & f.den_where)
        return safe_rate(F.count(F.when(base, col)), F.count(F.when(den, col)))
    if f.agg in ("days_since_min", "days_since_max"):
        agg = F.min if f.agg == "days_since_min" else F.max
        return F.datediff(snap_ts.cast("date"), F.to_date(agg(F.when(base, F.col(ts_name)))))
    raise AssertionError(f.agg)


def _cast_out(f: Feature, c: Column) -> Column:
    if f.agg in ("count", "count_distinct", "days_since_min", "days_since_max"):
        return c.cast("long")
    if f.agg in ("rate", "avg"):
        return c.cast("double")
    return c


def latest_features(facts: DataFrame, entity: str, ts: str, features: Sequence[Feature], unit: str = "month",
                    lead: str = "1 month", out: str = "snapshot_date", domain_of: DataFrame | None = None) -> DataFrame:
    """The panel's rows of the last snapshot: one aggregate per entity over the facts
    up to it, no fan-out and no window."""
    bounds = spine_bounds(facts, ts, unit).select(F.col("spine_hi").alias(out))
    last = F.col(out).cast("timestamp_ntz")
    t = F.col(ts).cast("timestamp_ntz")
    facts, features, domains = encode_domains(facts, asked := features, domain_of)
    near = (facts.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
            .crossJoin(F.broadcast(bounds))  # a global aggregate: one row
            .where(t <= last + _interval(lead)))
    aggs = [_cast_out(f, _direct_agg(f, t, last, ts)).alias(f.name) for f in features]
    return decode_domains(near.groupBy(entity, out).agg(*aggs), asked, domains)


# -------------------------------------------------------------- scale form

def pit_scale(facts: DataFrame, entity: str, ts: str, features: Sequence[Feature],
              unit: str = "month", lead: str = "1 month",
              out: str = "snapshot_date", distinct: str = "explode",
              bounds: DataFrame | None = None, domain_of: DataFrame | None = None,
              parts: int | None = None) -> DataFrame:
    """Join-free form (see module doc).

    ``distinct``: ``"coverage"`` computes windowed distinct counts from merged
    per-value coverage intervals (nothing explodes, a few extra small
    shuffles), for windows of many spine steps; ``"explode"`` counts them over the
    exploded rows (Catalyst's Expand), for windows of one or two.  The caller
    chooses; nothing switches with the data.  ``bounds``: the spine's ends, if not those
    of the facts.  ``parts``: partitions of the entities' rows, which AQE else sizes by the rows
    before they fan out, so that what follows spills."""
    if distinct not in ("explode", "coverage"):
        raise ValueError(f"unknown strategy {distinct!r}")
    bounds = spine_bounds(facts, ts, unit) if bounds is None else bounds
    facts, features, domains = encode_domains(facts, asked := features, domain_of)
    lifetime = [f for f in features if f.window is None]
    # aligned windows of additive aggregates slide over per-snapshot partials;
    # distinct counts run on coverage intervals; the rest (windows that cut
    # through a step) explode to the few snapshots they reach
    sliding = [f for f in features if f.window is not None and aligned_steps(f.window, unit)
               and (f.agg in SLIDABLE or f.agg == "count_distinct" and f.domain is not None)]
    covered = [f for f in features if f.window is not None and f.agg == "count_distinct"
               and distinct == "coverage" and f.domain is None]
    trailing = [f for f in features if f.window is not None and f not in sliding and f not in covered]
    windows = sorted({f.window for f in trailing})

    ev = (facts.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
               .crossJoin(F.broadcast(bounds)))
    t = F.col(ts).cast("timestamp_ntz")
    d0 = ceil_unit(t, unit)
    # last snapshot any trailing window of this fact reaches
    reach = d0
    for w in windows:
        reach = F.greatest(reach, floor_unit(t + _interval(w), unit))
    reach = F.least(reach, F.col("spine_hi"))
    # facts after the last snapshot keep one row: they still decide eligibility
    snaps = F.when(d0 <= reach, F.sequence(d0, reach, _step_expr(unit))).otherwise(F.array(d0))
    ev = ev.select("*", d0.alias("_d0"), F.explode(snaps).alias(out))
    ev = ev.select("*", (F.col(out) == F.col("_d0")).alias("_first"),
                   (t == F.col("_d0").cast("timestamp_ntz")).alias("_exact"))
    if covered:
        ev = _with_coverage_deltas(ev, facts, bounds, entity, ts, out, unit, covered)

    snap_ts = F.col(out).cast("timestamp_ntz")
    first = F.col("_first")

    # ---- one aggregate per (entity, snapshot): lifetime increments + trailing values
    # spine bounds ride along (constant per row) so the fan-out needs no second join
    aggs: list[Column] = [F.min(ts).alias("_min_ts"), F.max("spine_lo").alias("spine_lo"),
                          F.max("spine_hi").alias("spine_hi")]
    for i, f in enumerate(lifetime):
        base = first if f.where is None else (first & f.where)
        col = F.col(f.column) if f.column else None
        if f.agg == "count":
            aggs.append(F.count(F.when(base, col)).alias(f"_l{i}_n"))
        elif f.agg == "sum":
            aggs.append(F.sum(F.when(base, col)).alias(f"_l{i}_s"))
        elif f.agg == "avg":
            aggs += [F.sum(F.when(base, col).cast("double")).alias(f"_l{i}_s"),
                     F.count(F.when(base, col)).alias(f"_l{i}_n")]
        elif f.agg == "min":
            aggs.append(F.min(F.when(base, col)).alias(f"_l{i}_m"))
        elif f.agg == "max":
            aggs.append(F.max(F.when(base, col)).alias(f"_l{i}_m"))
        elif f.agg == "rate":
            den = first if f.den_where is None else (first & f.den_where)
            aggs += [F.count(F.when(base, col)).alias(f"_l{i}_n"),
                     F.count(F.when(den, col)).alias(f"_l{i}_d")]
        elif f.agg in ("days_since_min", "days_since_max"):
            agg = F.min if f.agg == "days_since_min" else F.max
            aggs.append(agg(F.when(base, F.col(ts))).alias(f"_l{i}_m"))
    for i, f in enumerate(trailing):
        in_w = (F.col(ts) <= snap_ts) & (F.col(ts) >= snap_ts - _interval(f.window))
        base = in_w if f.where is None else (in_w & f.where)
        aggs.append(_cast_out(f, _trailing_value(f, base, in_w, snap_ts, ts)).alias(f"_t{i}"))
    exact = first & F.col("_exact")
    for j, f in enumerate(sliding):
        col = F.col(f.column) if f.column else None
        for tag, scope in (("a", first), ("e", exact)):
            base = scope if f.where is None else (scope & f.where)
            if f.agg == "count":
                aggs.append(F.count(F.when(base, col)).alias(f"_s{j}_{tag}n"))
            elif f.agg == "sum":
                aggs.append(F.sum(F.when(base, col)).alias(f"_s{j}_{tag}s"))
            elif f.agg == "avg":
                aggs += [F.sum(F.when(base, col).cast("double")).alias(f"_s{j}_{tag}s"),
                         F.count(F.when(base, col)).alias(f"_s{j}_{tag}n")]
            elif f.agg in ("min", "max"):
                agg = F.min if f.agg == "min" else F.max
                aggs.append(agg(F.when(base, col)).alias(f"_s{j}_{tag}m"))
            elif f.agg == "rate":
                den = scope if f.den_where is None else (scope & f.den_where)
                aggs += [F.count(F.when(base, col)).alias(f"_s{j}_{tag}n"),
                         F.count(F.when(den, col)).alias(f"_s{j}_{tag}d")]
            elif f.agg == "count_distinct":
                aggs.append(F.bit_or(F.when(base, _bit(f))).alias(f"_s{j}_{tag}m"))
    aggs += [F.sum(f"_cov{j}").alias(f"_l_cov{j}") for j in range(len(covered))]
    per_snap = ev.groupBy(entity, out).agg(*aggs)

    # ---- running lifetime values per entity (rows per entity <= spine length).
    #      One window spec (entity, snapshot) -> a single sort.  The entity's first
    #      fact is the smallest ts of its first row: that fact's own snapshot is
    #      the entity's smallest one.
    if parts is not None:
        per_snap = per_snap.repartition(parts, entity)  # the exchange of the windows below
    w_run = Window.partitionBy(entity).orderBy(out).rowsBetween(Window.unboundedPreceding, 0)
    w_ord = Window.partitionBy(entity).orderBy(out)
    running: list[Column] = []
    for i, f in enumerate(lifetime):
        if f.agg in ("count", "sum", "avg", "rate"):
            parts = {"count": ["n"], "sum": ["s"], "avg": ["s", "n"], "rate": ["n", "d"]}[f.agg]
            running += [F.sum(f"_l{i}_{p}").over(w_run).alias(f"_l{i}_{p}") for p in parts]
        elif f.agg in ("min", "days_since_min"):
            running.append(F.min(f"_l{i}_m").over(w_run).alias(f"_l{i}_m"))
        elif f.agg in ("max", "days_since_max"):
            running.append(F.max(f"_l{i}_m").over(w_run).alias(f"_l{i}_m"))
    # distinct values covering a snapshot = running sum of the +1/-1 coverage deltas
    running += [F.sum(f"_l_cov{j}").over(w_run).alias(f"_l_cov{j}") for j in range(len(covered))]
    keep = [c for c in per_snap.columns if not c.startswith("_l")]
    run = per_snap.select(*keep, *running,
                          F.row_number().over(w_ord).alias("_row"),
                          F.lead(out).over(w_ord).alias("_next"))
    run = run.select("*", F.when(F.col("_row") == 1, F.col("_min_ts")).alias("_first_ts"))

    # ---- fan each row out to: itself (kind 0), the snapshots up to the next row
    #      (kind 1: lifetime carried, trailing empty), and for the first row the
    #      eligible snapshots before any fact counts (kind 2: all empty)
    hi, lo, d = F.col("spine_hi"), F.col("spine_lo"), F.col(out)
    own = F.when(d <= hi, F.array(F.struct(d.alias("d"), F.lit(0).alias("k"))))
    fill_to = F.least(F.coalesce(add_steps(F.col("_next"), unit, -1), hi), hi)
    fill_from = add_steps(d, unit)
    fill = F.when(fill_from <= fill_to,
                  F.transform(F.sequence(fill_from, fill_to, _step_expr(unit)),
                              lambda x: F.struct(x.alias("d"), F.lit(1).alias("k"))))
    start = _start_snapshot(F.col("_first_ts"), lo, unit, lead)
    pre_to = F.least(add_steps(d, unit, -1), hi)
    pre = F.when((F.col("_row") == 1) & (start <= pre_to),
                 F.transform(F.sequence(start, pre_to, _step_expr(unit)),
                             lambda x: F.struct(x.alias("d"), F.lit(2).alias("k"))))
    empty = F.array().cast("array<struct<d:date,k:int>>")
    spans = F.concat(F.coalesce(own, empty), F.coalesce(fill, empty), F.coalesce(pre, empty))
    run = run.select("*", F.explode(spans).alias("_span"))

    # dense rows: one per eligible (entity, snapshot), contiguous per entity
    carried = [c for c in run.columns if c.startswith(("_l", "_t", "_s"))]
    dense = run.select(entity, F.col("_span.d").alias(out), F.col("_span.k").alias("_kind"), *carried)
    kind = F.col("_kind")
    new_d = F.col(out)
    w_dense = Window.partitionBy(entity).orderBy(out)
    cols = [F.col(entity), new_d]
    for f in features:
        if f.window is None:
            i = lifetime.index(f)
            val = _lifetime_value(f, i, new_d)
            val = F.when(kind == 2, _empty_value(f)).otherwise(val)
        elif f in sliding:
            val = _sliding_value(f, sliding.index(f), aligned_steps(f.window, unit), kind == 0, w_dense)
        elif f in covered:
            val = F.when(kind == 2, F.lit(0)).otherwise(F.coalesce(F.col(f"_l_cov{covered.index(f)}"), F.lit(0)))
        else:
            i = trailing.index(f)
            val = F.when(kind == 0, F.col(f"_t{i}")).otherwise(_empty_value(f))
        cols.append(_cast_out(f, val).alias(f.name))
    return decode_domains(dense.select(*cols), asked, domains)


def _with_coverage_deltas(ev: DataFrame, facts: DataFrame, bounds: DataFrame, entity: str, ts: str,
                          out: str, unit: str, covered: list) -> DataFrame:
    """Append +1/-1 rows for windowed distinct counts.

    A fact is inside the window of snapshot ``d`` exactly when
    ``ceil(ts) <= d <= floor(ts + W)``, so each (entity, value) occurrence covers
    an interval of snapshots.  Occurrences are deduplicated per snapshot bucket
    (hash aggregate), their intervals merged per (entity, value) by a window
    whose rows are bounded by the spine length, and each merged interval emits
    +1 at its start and -1 one step after its end.  The running sum of the
    deltas over snapshots is the distinct count; nothing is exploded and hot
    entities or values are pre-combined map-side.
    """
    t = F.col(ts).cast("timestamp_ntz")
    base = (facts.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
                 .crossJoin(F.broadcast(bounds)))
    rows = ev.select("*", *[F.lit(None).cast("long").alias(f"_cov{j}") for j in range(len(covered))])
    template = [c for c in rows.columns]
    for j, f in enumerate(covered):
        keep = F.col(f.column).isNotNull() if f.where is None else (F.col(f.column).isNotNull() & f.where)
        iv = base.where(keep).select(
            entity, F.col(f.column).alias("_v"), ceil_unit(t, unit).alias("_s"),
            F.least(floor_unit(t + _interval(f.window), unit), F.col("spine_hi")).alias("_e"),
            "spine_lo", "spine_hi")
        iv = (iv.where(F.col("_s") <= F.col("_e"))
                .groupBy(entity, "_v", "_s").agg(F.max("_e").alias("_e"), F.max("spine_lo").alias("spine_lo"),
                                                 F.max("spine_hi").alias("spine_hi")))
        w = Window.partitionBy(entity, "_v").orderBy("_s")
        prev_end = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
        iv = iv.select("*", F.when(prev_end.isNull() | (F.col("_s") > prev_end), 1).otherwise(0).alias("_new"))
        iv = iv.select("*", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_grp"))
        merged = iv.groupBy(entity, "_v", "_grp").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"),
                                                      F.max("spine_lo").alias("spine_lo"),
                                                      F.max("spine_hi").alias("spine_hi"))
        ends = add_steps(F.col("_e"), unit)
        deltas = merged.select(entity, F.col("_s").alias(out), F.lit(1).cast("long").alias("_delta"),
                               "spine_lo", "spine_hi").unionByName(
            merged.where(ends <= F.col("spine_hi"))
                  .select(entity, ends.alias(out), F.lit(-1).cast("long").alias("_delta"), "spine_lo", "spine_hi"))
        filler = {c: F.lit(None).cast(rows.schema[c].dataType) for c in template}
        filler.update({entity: F.col(entity), out: F.col(out), "spine_lo": F.col("spine_lo"),
                       "spine_hi": F.col("spine_hi"), "_first": F.lit(False), "_exact": F.lit(False),
                       f"_cov{j}": F.col("_delta")})
        rows = rows.unionByName(deltas.select(*[filler[c].alias(c) for c in template]))
    return rows


def _sliding_value(f: Feature, j: int, n: int, own: Column, w: Window) -> Column:
    """Closed window ``[d - n steps, d]`` over dense per-snapshot rows: all facts
    of the last ``n`` snapshot buckets, plus those exactly on ``d - n``."""
    frame = w.rowsBetween(-(n - 1), 0)

    def inside(p: str, agg=F.sum) -> Column:
        return agg(F.when(own, F.col(f"_s{j}_a{p}"))).over(frame)

    def edge(p: str) -> Column:
        return F.lag(F.when(own, F.col(f"_s{j}_e{p}")), n).over(w)

    def total(p: str) -> Column:
        return F.coalesce(inside(p), F.lit(0)) + F.coalesce(edge(p), F.lit(0))

    if f.agg == "count":
        return total("n")
    if f.agg == "sum":
        a, e = inside("s"), edge("s")
        empty = F.lit(f.default) if f.default is not None else F.lit(None)
        return F.when(a.isNull() & e.isNull(), empty).otherwise(
            F.coalesce(a, F.lit(0)) + F.coalesce(e, F.lit(0)))
    if f.agg == "avg":
        return F.try_divide(total("s").cast("double"), total("n").cast("double"))
    if f.agg == "min":
        return F.least(inside("m", F.min), edge("m"))
    if f.agg == "max":
        return F.greatest(inside("m", F.max), edge("m"))
    if f.agg == "rate":
        return safe_rate(total("n"), total("d"))
    if f.agg == "count_distinct":
        none = F.lit(0).cast("long")
        return F.bit_count(F.coalesce(inside("m", F.bit_or), none).bitwiseOR(F.coalesce(edge("m"), none)))
    raise AssertionError(f.agg)


def _trailing_value(f: Feature, base: Column, in_w: Column, snap_ts: Column, ts: str) -> Column:
    col = F.col(f.column) if f.column else None
    if f.agg == "count":
        return F.count(F.when(base, col))
    if f.agg == "count_distinct":
        return _distinct_count(f, base)
    if f.agg == "sum":
        s = F.sum(F.when(base, col))
        return F.coalesce(s, F.lit(f.default)) if f.default is not None else s
    if f.agg == "avg":
        return F.avg(F.when(base, col))
    if f.agg == "min":
        return F.min(F.when(base, col))
    if f.agg == "max":
        return F.max(F.when(base, col))
    if f.agg == "rate":
        den = in_w if f.den_where is None else (in_w & f.den_where)
        return safe_rate(F.count(F.when(base, col)), F.count(F.when(den, col)))
    if f.agg in ("days_since_min", "days_since_max"):
        agg = F.min if f.agg == "days_since_min" else F.max
        return F.datediff(snap_ts.cast("date"), F.to_date(agg(F.when(base, F.col(ts)))))
    raise AssertionError(f.agg)


def _lifetime_value(f: Feature, i: int, snap: Column) -> Column:
    if f.agg == "count":
        return F.coalesce(F.col(f"_l{i}_n"), F.lit(0))
    if f.agg == "sum":
        s = F.col(f"_l{i}_s")
        return F.coalesce(s, F.lit(f.default)) if f.default is not None else s
    if f.agg == "avg":
        return F.try_divide(F.col(f"_l{i}_s"), F.col(f"_l{i}_n").cast("double"))
    if f.agg in ("min", "max"):
        return F.col(f"_l{i}_m")
    if f.agg == "rate":
        return safe_rate(F.col(f"_l{i}_n"), F.col(f"_l{i}_d"))
    if f.agg in ("days_since_min", "days_since_max"):
        return F.datediff(snap, F.to_date(F.col(f"_l{i}_m")))
    raise AssertionError(f.agg)


def _empty_value(f: Feature) -> Column:
    if f.agg in ("count", "count_distinct"):
        return F.lit(0)
    if f.agg == "rate":
        return F.lit(0.0)
    if f.agg == "sum" and f.default is not None:
        return F.lit(f.default)
    return F.lit(None)


def point_in_time_features(facts: DataFrame, entity: str, ts: str,
                           features: Sequence[Feature], unit: str = "month",
                           lead: str = "1 month", out: str = "snapshot_date",
                           distinct: str = "explode", snapshots: str = "all",
                           bounds: DataFrame | None = None, domain_of: DataFrame | None = None,
                           parts: int | None = None) -> DataFrame:
    """Point-in-time panel of ``snapshots`` "all" or "latest"; ``domain_of``: where the values of
    small domains are read, if not from the facts; ``parts``: as in ``pit_scale``."""
    if snapshots == "latest":
        return latest_features(facts, entity, ts, features, unit=unit, lead=lead, out=out, domain_of=domain_of)
    if snapshots != "all":
        raise ValueError(f"unknown snapshots {snapshots!r}")
    return pit_scale(facts, entity, ts, features, unit=unit, lead=lead, out=out, distinct=distinct, bounds=bounds,
                     domain_of=domain_of, parts=parts)
