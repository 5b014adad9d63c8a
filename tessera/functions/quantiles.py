"""Exact quantiles without a single-reducer buffer.

Spark's ``percentile`` is exact but keeps a value→count map of every distinct
value of a column in one aggregation buffer, which does not survive a
high-cardinality column at scale. ``percentile_approx`` is bounded but not
exact. This module gets exact order statistics in a few distributed passes,
whatever the number of columns and probabilities:

1. one aggregate: ``count``, ``min``, ``max`` and ``percentile_approx`` just
   below and above every requested probability — a bracket ``[lo, hi]`` that
   should hold the needed ranks;
2. one group-by: every value gets a *cell* id among the sorted bracket
   endpoints of its column (a binary-search expression), and the cells are
   counted — ≤ 2·targets + 1 counters per column, combined map-side. That
   gives, per target, how many values lie below and inside its bracket, and
   verifies it (a bracket the sketch missed is widened to ``[min, max]``);
3. only while more than ``max_bracket`` values lie strictly inside a bracket:
   an equal-width histogram inside it (``groupBy(target, bin)``) narrows it to
   the bin that holds the ranks; two ranks in different bins are the largest
   value of the one and the smallest of the other, which ends the search;
4. one group-by over the cells inside the final brackets: values equal to
   an endpoint are only counted, the open cells between endpoints are
   collected sorted (bounded by ``max_bracket`` per target).

With ``by``, a small table of the groups' brackets is broadcast and joined, so
the number of scans does not depend on the number of groups.

What reaches the driver is bounded by ``targets × max(bins, max_bracket)``;
repeated endpoint values travel as counts.

``interpolation='linear'``: ``x[k] + (x[k+1] − x[k])·frac`` at ``pos =
p·(n − 1)`` (numpy "linear", DuckDB ``quantile_cont``). ``'inverted_cdf'``:
the observed value at index ``ceil(p·n) − 1`` (DuckDB ``quantile_disc``).
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import cut_lineage, has_shuffle
from .columns import q
from .joins import small_side


def _x(c: str) -> Column:
    x = F.col(q(c)).cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              by: Sequence[str] | None = None, exact: bool = True,
              accuracy: int = 10000, max_bracket: int = 50000, bins: int = 1024,
              max_groups: int = 256, interpolation: str = "linear"
              ) -> dict[tuple, list[float | None]]:
    """Quantiles of each column (optionally per group of ``by``).

    Returns ``{(group_tuple, column): [value per prob]}``; the group tuple is
    ``()`` without ``by``. A column with no non-null value yields ``None``.
    This grouped form answers with a dictionary and is meant for few groups
    (models, splits): more than ``max_groups`` raises. ``group_quantiles`` returns
    a table for any number of groups.
    """
    if interpolation not in ("linear", "inverted_cdf"):
        raise ValueError("interpolation must be 'linear' or 'inverted_cdf'")
    cols = list(cols)
    by = list(by or [])
    probs = [float(p) for p in probs]
    if any(p < 0 or p > 1 for p in probs):
        raise ValueError("probabilities must be within [0, 1]")
    delta = 2.0 / accuracy
    grid = probs if not exact else sorted(
        {min(1.0, max(0.0, p + s * delta)) for p in probs for s in (-1.0, 1.0)})

    data = df.select(*[F.col(q(b)) for b in by], *[_x(c).alias(c) for c in cols])
    # the passes below re-read ``data``: when it comes out of a shuffle (join,
    # aggregate, window) keep the projected columns instead of recomputing the
    # shuffle per pass (memory and disk; rebuilt from lineage if an executor
    # is lost). A plain scan is re-read instead.
    cached = exact and has_shuffle(data)
    if cached:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if exact and not by and len(cols) > WIDE:
            return {((), c): v for a in range(0, len(cols), MOST) for c, v in zip(
                cols[a:a + MOST], _digit_quantiles(data.select(*[F.col(q(c)) for c in cols[a:a + MOST]]), cols[a:a + MOST],
                                                   probs, interpolation))}
        return _quantiles(data, cols, probs, by, exact, accuracy, max_bracket, bins,
                          max_groups, interpolation, grid, delta)
    finally:
        if cached:
            data.unpersist()


def _quantiles(data, cols, probs, by, exact, accuracy, max_bracket, bins, max_groups,
               interpolation, grid, delta):
    # pass 1: sizes, ranges and the sketch
    def sketch(idx: list[int]) -> list[tuple[tuple, dict]]:
        aggs = []
        for i in idx:
            x = F.col(q(cols[i]))
            aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"),
                     F.max(x).alias(f"hi{i}"),
                     F.percentile_approx(x, grid, accuracy).alias(f"a{i}")]
        if by:
            rows = data.groupBy(*[F.col(q(b)) for b in by]).agg(*aggs) \
                       .limit(max_groups + 1).collect()
            if len(rows) > max_groups:
                raise ValueError(f"more than {max_groups} groups for grouped quantiles")
            return [(tuple(r[b] for b in by), r.asDict()) for r in rows]
        return [((), data.agg(*aggs).first().asDict())]

    first = sketch(list(range(len(cols))))

    out: dict[tuple, list[float | None]] = {}
    slots: list[dict] = []          # one per (group, column) with targets
    for key, r in first:
        for i, c in enumerate(cols):
            n = r[f"n{i}"]
            out[(key, c)] = [None] * len(probs)
            if not n:
                continue
            approx = dict(zip(grid, r[f"a{i}"] or []))
            if not exact:
                out[(key, c)] = [approx.get(p) for p in probs]
                continue
            slot = dict(key=key, col=c, n=n, min=r[f"lo{i}"], max=r[f"hi{i}"], targets=[])
            for j, p in enumerate(probs):
                if interpolation == "inverted_cdf":
                    k, frac = max(0, int(math.ceil(p * n)) - 1), 0.0
                else:
                    pos = p * (n - 1)
                    k = int(math.floor(pos))
                    frac = pos - k
                k2 = min(k + 1, n - 1) if frac > 0 else k
                plo, phi = max(0.0, p - delta), min(1.0, p + delta)
                lo = approx[plo] if plo > 0 else r[f"lo{i}"]
                hi = approx[phi] if phi < 1 else r[f"hi{i}"]
                slot["targets"].append(dict(j=j, k=k, k2=k2, frac=frac, lo=lo, hi=hi))
            slots.append(slot)
    if not slots:
        return out

    # pass 2: cell counts → below / inside per bracket, verified. When the
    # sketch's rank error bound (≈ 2n/accuracy on each side) keeps every
    # bracket under max_bracket, the bracket values are collected in the same
    # pass and pass 4 is skipped for every bracket that verifies.
    # (collect_list over every cell makes the object hash aggregate fall back
    # to sorting all rows, so the merged form is only used for few cells)
    merged = (all(4.0 * s["n"] / accuracy + 2 <= max_bracket for s in slots)
              and sum(2 * len(s["targets"]) + 1 for s in slots) * 2 <= 128)
    counts = _cell_pass(data, slots, by, collect=merged, counts_too=merged)
    for s_id, s in enumerate(slots):
        cnt = counts.get(s_id, {})
        bounds = s["bounds"]
        if merged:
            s["cells"] = cnt
        for t in s["targets"]:
            c_lo = 2 * bisect_left(bounds, t["lo"]) + 1
            c_hi = 2 * bisect_left(bounds, t["hi"]) + 1
            below = sum(v for c, (v, _) in cnt.items() if c < c_lo)
            inside = sum(v for c, (v, _) in cnt.items() if c_lo <= c <= c_hi)
            t["done"] = merged
            # values strictly between the endpoints: only these are ever collected
            t["open"] = inside - cnt.get(c_lo, (0, None))[0] - cnt.get(c_hi, (0, None))[0]
            if below > t["k"] or below + inside <= t["k2"]:
                below, t["lo"], t["hi"], t["open"] = 0, s["min"], s["max"], s["n"]
                t["done"] = False
            t["below"] = below

    # pass 3: histogram refinement of brackets that are still large
    for _ in range(64):
        wide = [(s, t) for s in slots for t in s["targets"]
                if t["lo"] != t["hi"] and t["open"] > max_bracket]
        if not wide:
            break
        _refine(data, wide, by, bins)

    # pass 4: sorted values of the open cells inside each (small) bracket
    todo = [s for s in slots if any(t["lo"] != t["hi"] and not t["done"] for t in s["targets"])]
    if todo:
        for s in todo:            # re-collect every bracket of these slots
            for t in s["targets"]:
                t["done"] = False
        cells = _cell_pass(data, todo, by, collect=True)
        for s_id, s in enumerate(todo):
            s["cells"] = cells.get(s_id, {})
    for s in slots:
        for t in s["targets"]:
            if "found" in t:
                a, b = t["found"]
            elif t["lo"] == t["hi"]:
                a = b = t["lo"]
            else:
                a = _value_at(s, t, t["k"] - t["below"])
                b = _value_at(s, t, t["k2"] - t["below"])
            v = a if t["k2"] == t["k"] else a + (b - a) * t["frac"]
            out[(s["key"], s["col"])][t["j"]] = float(v)
    return out


#: Beyond so many columns, the per-row code of the passes below is too long for the JIT.
WIDE = 2
#: Columns of one scan there: half a megabyte of counters each.
MOST = 128
#: Bits of a value settled by each pass of ``_digit_quantiles``: (shift, width).
DIGITS = ((48, 16), (24, 24), (0, 24))
#: Values that a task of ``_digit_quantiles`` holds before it hands on their counters.
HELD = 1 << 22


def _order_bits(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles (-0.0 as 0.0)."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _from_order_bits(bits: int) -> float:
    raw = bits ^ (1 << 63) if bits >> 63 else bits ^ ((1 << 64) - 1)
    return float(np.array([raw], np.uint64).view(np.float64)[0])


def _digit_counter(known: Sequence[np.ndarray], shift: int, width: int):
    """A task's counters ``(i, p, d, n)`` of one digit: column, place of the prefix among
    its ``known`` ones, digit, values. The first digit counts all values in an array; later
    ones hold at most ``HELD`` values (and a batch) before their counters go on, so the
    memory of a task does not grow with its rows. Equal counters are added by the group-by."""
    top, mask = np.uint64(shift + width), np.uint64((1 << width) - 1)

    def rows(i, key, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), i, np.int32)), pa.array((key >> width).astype(np.int32)),
             pa.array(key & ((1 << width) - 1)), pa.array(n)], ["i", "p", "d", "n"])

    def counters(parts):
        for i, held in enumerate(parts):
            if held:
                yield rows(i, *np.unique(np.concatenate(held), return_counts=True))
                held.clear()

    def count(batches):
        whole = np.zeros((len(known), 1 << width), np.int64) if shift + width == 64 else None
        parts: list[list] = [[] for _ in known]
        size = 0
        for b in batches:
            for i in range(len(known)):
                bits = _order_bits(b.column(i).drop_null().to_numpy(zero_copy_only=False))
                digit = (bits >> np.uint64(shift)) & mask
                if whole is not None:
                    whole[i] += np.bincount(digit.astype(np.int64), minlength=1 << width)
                elif len(known[i]) and len(bits):
                    at = np.minimum(np.searchsorted(known[i], bits >> top), len(known[i]) - 1)
                    ok = known[i][at] == bits >> top
                    parts[i].append((at[ok].astype(np.int64) << width) | digit[ok].astype(np.int64))
                    size += len(parts[i][-1])
            if size > HELD:
                yield from counters(parts)
                size = 0
        if whole is not None:
            for i in range(len(known)):
                key = np.flatnonzero(whole[i])
                yield rows(i, key, whole[i][key])
        yield from counters(parts)

    return count


def _digit_quantiles(data: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     interpolation: str) -> list[list[float | None]]:
    """Exact quantiles of many columns in ``len(DIGITS)`` scans, by digits of the
    values' bits from the top: count the digit's values behind the prefixes that
    hold a wanted rank, take the digit in which the rank falls, go on. Every scan
    counts all columns in Arrow batches; counters meet by ``(column, prefix, digit)``."""
    def digits(prefixes: list[list[int]], shift: int, width: int):
        known = [np.array(p, np.uint64) for p in prefixes]
        count = _digit_counter(known, shift, width)
        return data.mapInArrow(count, "i int, p int, d bigint, n bigint").groupBy("i", "p", "d").agg(F.sum("n").alias("n"))

    spark, (first, *rest) = data.sparkSession, DIGITS
    counters: list[dict[int, int]] = [{} for _ in cols]
    for r in digits([[] for _ in cols], *first).collect():     # at most 65,536 rows a column
        counters[r["i"]][r["d"]] = r["n"]
    wanted: dict[tuple, tuple] = {}     # (column, prob, side) -> (prefix, rank behind it)
    shares: dict[tuple, float] = {}
    for i, c in enumerate(counters):
        n = sum(c.values())
        for j, p in enumerate(probs if n else []):
            pos = max(0, math.ceil(p * n) - 1) if interpolation == "inverted_cdf" else p * (n - 1)
            k = math.floor(pos)
            shares[i, j] = pos - k
            for side, rank in ((0, k), (1, min(k + 1, n - 1) if pos > k else k)):
                for d in sorted(c):
                    if rank < c[d]:
                        wanted[i, j, side] = (d, rank)
                        break
                    rank -= c[d]
    for shift, width in rest:
        prefixes = [sorted({p for (i2, _, _), (p, _) in wanted.items() if i2 == i}) for i in range(len(cols))]
        want = sorted({(i, prefixes[i].index(p), r) for (i, _, _), (p, r) in wanted.items()})
        if not want:
            break
        places = spark.createDataFrame(want, "i int, p int, r bigint")     # columns x probabilities
        upto = digits(prefixes, shift, width).withColumn("e", F.sum("n").over(Window.partitionBy("i", "p").orderBy("d")))
        found = {(r["i"], r["p"], r["r"]): (r["d"], r["r"] - r["before"]) for r in upto.join(F.broadcast(places), ["i", "p"])
                 .where((F.col("r") < F.col("e")) & (F.col("r") >= F.col("e") - F.col("n")))
                 .select("i", "p", "r", "d", (F.col("e") - F.col("n")).alias("before")).collect()}
        for key, (p, r) in wanted.items():
            d, r2 = found[key[0], prefixes[key[0]].index(p), r]
            wanted[key] = (p << width | d, r2)
    out: list[list[float | None]] = []
    for i in range(len(cols)):
        out.append([])
        for j in range(len(probs)):
            if (i, j) not in shares:
                out[i].append(None)
                continue
            a, b = (_from_order_bits(wanted[i, j, side][0]) for side in (0, 1))
            out[i].append(a if a == b else a + (b - a) * shares[i, j])
    return out


def _slot_rows(data: DataFrame, slots: list[dict], by: list[str]) -> DataFrame:
    """``(slot, x)``: one row per value of each slot. A slot is a column or,
    with ``by``, a column of one group: groups find their slot in a broadcast
    table of one row per slot (at most ``max_groups`` groups)."""
    if not by:
        return data.select(F.posexplode(F.array(*[F.col(q(s["col"])) for s in slots])).alias("slot", "x")) \
            .where(F.col("x").isNotNull())
    cols = list(dict.fromkeys(s["col"] for s in slots))
    types = [data.schema[b].dataType for b in by]
    schema = StructType([StructField(f"__g{i}", t) for i, t in enumerate(types)]
                        + [StructField("__c", IntegerType()), StructField("slot", IntegerType())])
    where = data.sparkSession.createDataFrame(
        [(*s["key"], cols.index(s["col"]), i) for i, s in enumerate(slots)], schema)
    vals = [F.struct(F.lit(i).alias("__c"), F.col(q(c)).alias("x")) for i, c in enumerate(cols)]
    long = (data.select(*[F.col(q(b)).alias(f"__k{i}") for i, b in enumerate(by)],
                        F.inline(F.array(*vals)).alias("__k", "x"))
            .where(F.col("x").isNotNull()))
    cond = F.col("__k") == F.col("__c")
    for i in range(len(by)):
        cond = cond & F.col(f"__k{i}").eqNullSafe(F.col(f"__g{i}"))
    return long.join(F.broadcast(where), cond).select("slot", "x")


def _cell_pass(data: DataFrame, slots: list[dict], by: list[str], collect: bool,
               counts_too: bool = False) -> dict[int, dict]:
    """One group-by ``(slot, cell)``: counts, plus sorted values of the open
    cells inside the slot's brackets when ``collect``.

    Values are unpivoted to ``(slot, x)`` first; each slot's sorted bounds
    (padded with +inf to a power of two) come from a literal array, and the
    number of bounds below ``x`` is a branchless binary search — one
    ``element_at`` and one comparison per step, each step its own projection —
    so the per-row work is O(log m), code-generated, and the same size for 3
    columns or 300. With ``counts_too`` every cell is counted while only the
    bracket cells are collected (count and collect in one pass).
    """
    bmap, rmap, lmap, hmap = [], [], [], []
    width = 1
    n_open = max(1, max(len([t for t in s["targets"] if t["lo"] != t["hi"]]) for s in slots))
    for s_id, s in enumerate(slots):
        # counting needs every endpoint; a pure collect only the open brackets'
        tb = s["targets"] if (not collect or counts_too) else \
            [t for t in s["targets"] if t["lo"] != t["hi"]]
        s["bounds"] = sorted({t["lo"] for t in tb} | {t["hi"] for t in tb})
        width = max(width, len(s["bounds"]))
    size = 1 << width.bit_length()      # power of two > the most bounds (≥ one +inf pad)
    for s_id, s in enumerate(slots):
        bounds = s["bounds"]
        ts = [t for t in s["targets"] if t["lo"] != t["hi"]]
        padded = [float(b) for b in bounds] + [math.inf] * (size - len(bounds))
        bmap.append(F.array(*[F.lit(b) for b in padded]))
        if collect:
            wanted = sorted({c for t in ts for c in range(2 * bisect_left(bounds, t["lo"]) + 1,
                                                          2 * bisect_left(bounds, t["hi"]) + 2)})
            rmap.append(F.array(*[F.lit(c) for c in wanted]))
            pad = n_open - len(ts)
            lmap.append(F.array(*[F.lit(float(t["lo"])) for t in ts], *[F.lit(math.inf)] * pad))
            hmap.append(F.array(*[F.lit(float(t["hi"])) for t in ts], *[F.lit(-math.inf)] * pad))
    # one (slot, x) row per cell; the slot id is an int straight from the
    # generator, so filters pushed down to it stay cheap
    long = _slot_rows(data, slots, by)
    if collect and not counts_too:
        # keep only values inside a bracket, tested on x itself (a filter on
        # the cell id would be pushed below the search projections and inline
        # them); the brackets of a slot are few, so the test is linear
        lo = F.element_at(F.array(*lmap), F.col("slot") + 1)
        hi = F.element_at(F.array(*hmap), F.col("slot") + 1)
        inside = F.lit(False)
        for j in range(1, n_open + 1):
            inside = inside | ((F.col("x") >= F.element_at(lo, j)) & (F.col("x") <= F.element_at(hi, j)))
        long = long.where(inside)
    long = long.select("slot", "x", F.element_at(F.array(*bmap), F.col("slot") + 1).alias("b"),
                       F.lit(0).alias("pos"))
    step = size // 2
    while step >= 1:               # pos = number of bounds < x (lower bound)
        long = long.select("slot", "x", "b", (F.col("pos") + F.when(
            F.element_at("b", F.col("pos") + step) < F.col("x"), F.lit(step))
            .otherwise(F.lit(0))).alias("pos"))
        step //= 2
    cell = F.col("pos") * 2 + F.array_contains("b", F.col("x")).cast("int")
    long = long.select("slot", "x", cell.alias("c"))
    aggs = [F.count("*").alias("n")]
    if collect:
        wanted = F.array_contains(F.element_at(F.array(*rmap), F.col("slot") + 1), F.col("c"))
        if not counts_too:
            aggs.append(F.sort_array(F.collect_list(
                F.when(F.col("c") % 2 == 0, F.col("x")))).alias("xs"))
        else:
            aggs.append(F.sort_array(F.collect_list(
                F.when(wanted & (F.col("c") % 2 == 0), F.col("x")))).alias("xs"))
    rows = long.groupBy("slot", "c").agg(*aggs).collect()
    out: dict[int, dict] = {}
    for r in rows:
        out.setdefault(r["slot"], {})[r["c"]] = (r["n"], r["xs"] if collect else None)
    return out


def _value_at(s: dict, t: dict, rank: int) -> float:
    """The value ``rank`` places into ``[lo, hi]``: endpoint cells are runs of
    one value, open cells their collected sorted values."""
    bounds, cells = s["bounds"], s["cells"]
    for c in range(2 * bisect_left(bounds, t["lo"]) + 1, 2 * bisect_left(bounds, t["hi"]) + 2):
        n, vals = cells.get(c, (0, None))
        if rank < n:
            return bounds[(c - 1) // 2] if c % 2 else vals[rank]
        rank -= n
    raise IndexError("rank outside its bracket")


def _refine(data: DataFrame, wide: list[tuple[dict, dict]], by: list[str], bins: int) -> None:
    """Equal-width histogram inside each wide bracket; keep the bin holding
    the needed ranks (bins partition the sorted order: floor is monotone)."""
    slots, rows = [], []
    for t_id, (s, t) in enumerate(wide):
        if not any(s is o for o in slots):
            slots.append(s)
        slot = next(i for i, o in enumerate(slots) if s is o)
        rows.append((slot, t_id, float(t["lo"]), float(t["hi"])))
    targets = data.sparkSession.createDataFrame(rows, "slot int, t int, lo double, hi double")
    half = F.lit(0.5)               # halves: the width of the widest range stays finite
    x, lo, hi = F.col("x") * half, F.col("lo") * half, F.col("hi") * half
    b = F.least(F.floor((x - lo) / (hi - lo) * F.lit(bins)), F.lit(bins - 1))
    found = (_slot_rows(data, slots, by).join(F.broadcast(targets), "slot")   # one row per target
             .where(F.col("x").between(F.col("lo"), F.col("hi")))
             .groupBy("t", b.cast("int").alias("b"))
             .agg(F.count("*").alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"))
             .collect())
    per: dict[int, list] = {}
    for r in found:
        per.setdefault(r["t"], []).append((r["b"], r["n"], r["mn"], r["mx"]))
    for t_id, (_, t) in enumerate(wide):
        seen, low = t["below"], None
        t["done"] = False
        for _b, n, mn, mx in sorted(per[t_id]):
            if seen + n > t["k2"]:
                if low is not None:          # neighbouring ranks in two bins
                    t["found"], t["lo"], t["hi"] = (low, mn), low, low
                else:
                    t["below"], t["lo"], t["hi"], t["open"] = seen, mn, mx, n
                break
            if seen + n > t["k"]:
                low = mx
            seen += n


def group_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str],
                    interpolation: str = "linear") -> DataFrame:
    """``(by…, q0, q1, …)``: exact quantiles of ``col`` in every group, however many
    groups there are; groups without a value have no row.

    Equal values of a group become one counter. The counters are sorted by range
    partitions of ``(group, value)`` with a running count in each; a group's pieces
    (one per partition it reaches) get their offsets from a window of that many rows.
    Each wanted rank is then looked up in the partition that holds it, so neither a
    large group nor a frequent value is one task's.
    """
    names = [F.col(q(b)) for b in by]
    g = [f"__g{i}" for i in range(len(by))]
    counted = (df.select(*[b.alias(n) for b, n in zip(names, g)], _x(col).alias("__x")).where(F.col("__x").isNotNull())
               .groupBy(*g, "__x").agg(F.count("*").alias("__n")))
    placed = (counted.repartitionByRange(*g, "__x").sortWithinPartitions(*g, "__x")
              .withColumn("__pid", F.spark_partition_id()).withColumn("__end", F.lit(0).cast("bigint")))

    def running(batches):
        total = 0
        for b in batches:
            end = total + np.cumsum(b.column("__n").to_numpy())
            total = int(end[-1]) if len(end) else total
            yield b.set_column(b.schema.get_field_index("__end"), "__end", pa.array(end, pa.int64()))

    numbered = cut_lineage(placed.mapInArrow(running, placed.schema))
    pieces = numbered.groupBy("__pid", *g).agg(F.min(F.col("__end") - F.col("__n")).alias("__s"), F.sum("__n").alias("__c"))
    w = Window.partitionBy(*g)
    pieces = pieces.select("*", F.sum("__c").over(w).alias("__all"), F.coalesce(F.sum("__c").over(
        w.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    ranks = []
    for j, p in enumerate(probs):
        n = F.col("__all").cast("double")
        if interpolation == "inverted_cdf":
            low, share = F.greatest(F.ceil(F.lit(p) * n) - 1, F.lit(0)), F.lit(0.0)
        else:
            low = F.floor(F.lit(p) * (n - 1))
            share = F.lit(p) * (n - 1) - low
        high = F.when(share > 0, F.least(low + 1, F.col("__all") - 1)).otherwise(low)
        ranks += [F.struct(F.lit(2 * j + side).alias("j"), r.cast("bigint").alias("r"), share.alias("share"))
                  for side, r in ((0, low), (1, high))]
    wanted = pieces.withColumn("__w", F.explode(F.filter(F.array(*ranks), lambda x: (x["r"] >= F.col("__before")) & (
        x["r"] < F.col("__before") + F.col("__c"))))).select(
        F.col("__pid").alias("__p"), *[F.col(c).alias(f"{c}w") for c in g], F.col("__w.j").alias("__j"),
        (F.col("__s") + F.col("__w.r") - F.col("__before")).alias("__at"), F.col("__w.share").alias("__share"))
    wanted = cut_lineage(wanted)
    cond = (F.col("__pid") == F.col("__p")) & (F.col("__at") >= F.col("__end") - F.col("__n")) & (F.col("__at") < F.col("__end"))
    for c in g:
        cond = cond & F.col(c).eqNullSafe(F.col(f"{c}w"))
    found = numbered.join(small_side(wanted), cond)
    value = lambda j: F.max(F.when(F.col("__j") == j, F.col("__x")))
    out = found.groupBy(*g).agg(*[F.struct(value(2 * j).alias("a"), value(2 * j + 1).alias("b"), F.max(F.when(
        F.col("__j") == 2 * j, F.col("__share"))).alias("s")).alias(f"__q{j}") for j in range(len(probs))])
    at = lambda j: F.col(f"__q{j}.a") + (F.col(f"__q{j}.b") - F.col(f"__q{j}.a")) * F.col(f"__q{j}.s")
    return out.select(*[F.col(n).alias(b) for n, b in zip(g, by)], *[
        F.when(F.col(f"__q{j}.a") == F.col(f"__q{j}.b"), F.col(f"__q{j}.a")).otherwise(at(j)).alias(f"q{j}") for j in range(len(probs))])


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     exact: bool = True, **kw) -> dict[str, list[float | None]]:
    """Ungrouped form: ``{column: [value per prob]}``."""
    res = quantiles(df, cols, probs, exact=exact, **kw)
    return {c: res[((), c)] for c in cols}
