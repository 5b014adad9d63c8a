"""Registered queries: ``QUERIES[key](spark, sf_dir) -> DataFrame`` and the
DuckDB oracle ``SQL[key]`` that computes the same table independently.

Conventions: key column first; computed doubles rounded to 6 places on both
sides (``+ 0.0`` folds ``-0.0``); counts and integers as ``bigint``;
statistics come from the fit subset only (``split = 'train'``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import NA_TOKENS, round6
from ..operators import clean, profile, scale, split
from ..session import ensure_checkpoint_dir
from ..sources import scan
from . import inputs as I

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql.strip()
        return fn
    return deco


def r6(name: str, expr: str | None = None) -> str:
    """SQL twin of ``round6``."""
    x = f"CAST({expr or name} AS DOUBLE)"
    return (f"CASE WHEN abs({x}) < 1e12 THEN CAST(floor({x} * 1000000.0 + 0.5) AS DOUBLE) / 1000000.0 "
            f"ELSE {x} END + 0.0 AS {name}")


def _sql_list(vals) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)




def TRAIN():
    """Train rows of the orders fixtures: ``o_orderkey mod 5 <> 0`` (hold-out 0.2)."""
    return split.is_train("o_orderkey", 5, "modulo")


def EV_TRAIN():
    return split.is_train("event_id", 5, "modulo")

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
OL_NUM = ["n_lines", "qty", "disc"]

# ----------------------------------------------------------- sources / profile

_NA = _sql_list(NA_TOKENS)


def _raw_orders(spark, d):
    o = I.table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("NA"))
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(" None "))
         .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "P", F.lit("null"))
         .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderstatus") == "P", F.lit("N/A"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("price"))


@register("scan_na_tokens", f"""
WITH raw AS (
  SELECT o_orderkey,
    CASE o_orderpriority WHEN '5-LOW' THEN 'NA' WHEN '4-NOT SPECIFIED' THEN ' None '
         ELSE o_orderpriority END AS o_orderpriority,
    CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE CAST(o_totalprice AS VARCHAR) END AS price
  FROM orders)
SELECT o_orderkey,
  CASE WHEN trim(o_orderpriority) IN ({_NA}) THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN trim(o_orderstatus) IN ({_NA}) THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  {r6('price', f"TRY_CAST(CASE WHEN trim(price) IN ({_NA}) THEN NULL ELSE price END AS DOUBLE)")}
FROM raw
""")
def q_scan_na_tokens(spark, d):
    df = scan.na_tokens_to_null(_raw_orders(spark, d))
    df = scan.typed(df, {"price": "double"})
    return df.select("o_orderkey", "o_orderpriority", "o_orderstatus", round6(F.col("price")).alias("price"))


_OL_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
            "o_year", "n_lines", "qty", "disc"]
_MISS_UNION = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS Feature, count(*) - count({c}) AS m, count(*) AS n FROM ol" for c in _OL_COLS)


@register("missing_summary", f"""
WITH {I.SQL_ORDERS_LINES},
m AS ({_MISS_UNION})
SELECT Feature, CAST(m AS BIGINT) AS Missing_Count, {r6('Missing_Percent', '100.0 * m / n')},
       CAST(row_number() OVER (ORDER BY 100.0 * m / n DESC, Feature) AS BIGINT) AS rank
FROM m WHERE m > 0
""")
def q_missing_summary(spark, d):
    ms = profile.missing_summary(I.orders_lines(spark, d))
    return ms.select("Feature", "Missing_Count", round6(F.col("Missing_Percent")).alias("Missing_Percent"),
                     "rank")


@register("label_stats", f"""
WITH {I.SQL_DOCS_LABELS}
SELECT 'quality' AS label, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) - count(quality) AS BIGINT) AS n_null,
       {r6('min', 'min(quality)')}, {r6('max', 'max(quality)')},
       {r6('mean', 'avg(quality)')}, {r6('median', 'quantile_cont(quality, 0.5)')}
FROM dl
""")
def q_label_stats(spark, d):
    s = profile.label_stats(I.docs_labels(spark, d), "quality")
    return s.select("label", "n_rows", "n_null",
                    *[round6(F.col(c)).alias(c) for c in ("min", "max", "mean", "median")])


@register("match_labels", """
SELECT d.doc_id, CAST(l.quality AS BIGINT) AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_match_labels(spark, d):
    ids = I.table(spark, d, "documents")
    labels = I.table(spark, d, "labels")
    m = profile.match_labels(ids, labels, "doc_id", "quality", order="quality")
    return m.select("doc_id", F.col("quality").cast("bigint").alias("quality"))


@register("match_labels_last", f"""
WITH r AS (SELECT l_orderkey, l_extendedprice AS price,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_extendedprice DESC) AS k FROM lineitem),
l AS (SELECT l_orderkey, price FROM r WHERE k = 1)
SELECT o_orderkey, {r6('price')} FROM orders LEFT JOIN l ON o_orderkey = l_orderkey
""")
def q_match_labels_last(spark, d):
    """Several labels per id: an order's label is its last line's price."""
    labels = I.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                                                  F.col("l_extendedprice").alias("price"))
    m = profile.match_labels(I.table(spark, d, "orders"), labels, "o_orderkey", "price", order="l_linenumber")
    return m.select("o_orderkey", round6(F.col("price")).alias("price"))


@register("unmatched_ids", """
WITH miss AS (SELECT d.doc_id FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS rank, doc_id FROM miss)
SELECT rank, doc_id, (SELECT CAST(count(*) AS BIGINT) FROM miss) AS n_unmatched
FROM r WHERE rank <= 10
""")
def q_unmatched_ids(spark, d):
    return profile.unmatched_ids(I.table(spark, d, "documents"), I.table(spark, d, "labels"),
                                 "doc_id", 10)


@register("validate_labels", f"""
WITH {I.SQL_DOCS_LABELS},
v AS (SELECT CAST(count_if(doc_id IS NULL) AS BIGINT) AS nk,
             CAST(count_if(quality IS NULL) AS BIGINT) AS nl,
             CAST(count_if(quality <= 0) AS BIGINT) AS np FROM dl)
SELECT 'columns_match' AS "check", 'error' AS severity, CAST(0 AS BIGINT) AS violations, true AS passed
UNION ALL SELECT 'null_key', 'error', nk, nk = 0 FROM v
UNION ALL SELECT 'numeric_label', 'error', CAST(0 AS BIGINT), true
UNION ALL SELECT 'null_label', 'error', nl, nl = 0 FROM v
UNION ALL SELECT 'non_positive_label', 'warning', np, np = 0 FROM v
""")
def q_validate_labels(spark, d):
    lab = I.docs_labels(spark, d).select("doc_id", "quality")
    return profile.validate_labels(lab, "doc_id", "quality", ["doc_id", "quality"])


def _contract_sql() -> str:
    """Every check of every faulty label table; what only the schema decides is a constant of the fault."""
    nk, nl = "count_if(doc_id IS NULL)", "count_if(quality IS NULL)"
    np, dup = "count_if(quality <= 0)", "count(doc_id) - count(DISTINCT doc_id)"
    sound = {"columns_match": "0", "null_key": nk, "numeric_label": "0", "null_label": nl,
             "non_positive_label": np, "column_set": "0", "column_types": "0", "duplicate_key": dup}
    faults = {"none": ("labels", {}),
              "swapped": ("labels", {"columns_match": "1"}),
              "text": ("labels", {"numeric_label": "1", "column_types": "1"}),
              "extra": ("labels", {"columns_match": "1", "column_set": "1"}),
              "no_label": ("labels", {"columns_match": "1", "numeric_label": "1", "null_label": "count(*)",
                                      "non_positive_label": "0", "column_set": "2"}),
              "nulls": ("(SELECT CASE WHEN doc_id % 7 <> 0 THEN doc_id END AS doc_id, "
                        "CASE WHEN doc_id % 5 <> 0 THEN quality END AS quality FROM labels)", {}),
              "negative": ("(SELECT doc_id, quality - 2 AS quality FROM labels)", {}),
              "doubled": ("(SELECT doc_id, quality FROM labels UNION ALL "
                          "SELECT doc_id, quality FROM labels WHERE doc_id % 3 = 0)", {})}
    return "\nUNION ALL\n".join(
        f"""SELECT '{fault}' AS fault, '{check}' AS "check", CAST({expr} + 0 * count(*) AS BIGINT) AS violations, {expr} + 0 * count(*) = 0 AS passed FROM {table}"""
        for fault, (table, changed) in faults.items() for check, expr in {**sound, **changed}.items())


@register("validate_contract", _contract_sql())
def q_validate_contract(spark, d):
    """A sound label table and seven faulty ones held to the same contract."""
    labels = I.table(spark, d, "labels")
    lab = labels.select("doc_id", "quality")
    kind = lab.schema["quality"].dataType
    tables = {
        "none": lab,
        "swapped": lab.select("quality", "doc_id"),
        "text": lab.select("doc_id", F.col("quality").cast("string").alias("quality")),
        "extra": labels.select("doc_id", "quality", "toxic"),
        "no_label": labels.select("doc_id", "toxic"),
        "nulls": lab.select(F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")).alias("doc_id"),
                            F.when(F.col("doc_id") % 5 != 0, F.col("quality")).alias("quality")),
        "negative": lab.select("doc_id", (F.col("quality") - 2).cast(kind).alias("quality")),
        "doubled": lab.unionByName(lab.where("doc_id % 3 = 0"))}
    out = None
    for fault, df in tables.items():
        v = profile.validate_labels(df, "doc_id", "quality", contract=scan.contract_of(lab))
        v = v.select(F.lit(fault).alias("fault"), "check", "violations", "passed")
        out = v if out is None else out.unionByName(v)
    return out


@register("split_roles", f"""
WITH {I.SQL_ORDERS_LINES}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS name, '{'key' if c == 'o_orderkey' else 'label' if c == 'o_totalprice' else 'feature'}' AS role, "
    f"CAST(count({c}) AS BIGINT) AS n_values FROM ol" for c in _OL_COLS))
def q_split_roles(spark, d):
    """Role of each column of the training frame, with its number of values."""
    from ..functions.stats import agg_values
    df = I.orders_lines(spark, d)
    feats, key, label = scan.split_roles(df, "o_orderkey", "o_totalprice")
    n = agg_values(df, {c: F.count(c) for c in (key, label, *feats)})
    rows = [(c, "key" if c == key else "label" if c == label else "feature", n[c]) for c in (key, label, *feats)]
    return spark.createDataFrame(rows, "name string, role string, n_values bigint")


# ------------------------------------------------------------------- cleaning

@register("fill_absence", """
SELECT o_orderkey,
       coalesce(nullif(nullif(o_orderpriority, '5-LOW'), 'NA'), 'None') AS o_orderpriority,
       coalesce(nullif(CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderstatus END, 'NA'),
                'No Status') AS o_orderstatus
FROM orders
""")
def q_fill_absence(spark, d):
    o = I.table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "P", F.lit("NA")).otherwise(F.col("o_orderstatus"))
         .alias("o_orderstatus"))
    return clean.fill_absence(o, {"o_orderpriority": "None", "o_orderstatus": "No Status"})


def _impute_sql(fn: str) -> str:
    stats = ", ".join(f"{fn.format(c)} AS s_{c}" for c in OL_NUM)
    outs = ", ".join(r6(c, f"coalesce(CAST({c} AS DOUBLE), s_{c})") for c in OL_NUM)
    return f"""
WITH {I.SQL_ORDERS_LINES},
st AS (SELECT {stats} FROM ol WHERE o_orderkey % 5 <> 0)
SELECT o_orderkey, {outs} FROM ol, st
"""


def _impute(spark, d, strategy):
    ol = I.orders_lines(spark, d).select("o_orderkey", *OL_NUM)
    fitted = clean.Imputer(strategy, cols=OL_NUM).fit(ol.where(TRAIN()))
    out = fitted.transform(ol)
    return out.select("o_orderkey", *[round6(F.col(c)).alias(c) for c in OL_NUM])


@register("impute_median", _impute_sql("quantile_cont({}, 0.5)"))
def q_impute_median(spark, d):
    return _impute(spark, d, "median")


@register("impute_mean", _impute_sql("avg({})"))
def q_impute_mean(spark, d):
    return _impute(spark, d, "mean")


@register("impute_mode", f"""
WITH {I.SQL_ORDERS_LINES},
mp AS (SELECT o_orderpriority AS v FROM ol WHERE o_orderkey % 5 <> 0 AND o_orderpriority IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1),
ms AS (SELECT o_orderstatus AS v FROM ol WHERE o_orderkey % 5 <> 0 AND o_orderstatus IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
SELECT o_orderkey, coalesce(o_orderpriority, (SELECT v FROM mp)) AS o_orderpriority,
       coalesce(o_orderstatus, (SELECT v FROM ms)) AS o_orderstatus
FROM ol
""")
def q_impute_mode(spark, d):
    ol = I.orders_lines(spark, d).select("o_orderkey", "o_orderpriority", "o_orderstatus")
    fitted = clean.Imputer("most_frequent", cols=["o_orderpriority", "o_orderstatus"],
                           kind="categorical").fit(ol.where(TRAIN()))
    return fitted.transform(ol)


@register("impute_ffill", f"""
WITH ev AS (SELECT event_id, user_id, ts,
                   CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events)
SELECT event_id, user_id,
       {r6('value', 'last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id '
                    'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')}
FROM ev
""")
def q_impute_ffill(spark, d):
    ev = I.table(spark, d, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"))
    out = clean.forward_fill(ev, ["value"], ["user_id"], ["ts", "event_id"],
                             chunk_by=F.date_trunc("day", F.col("ts")))
    return out.select("event_id", "user_id", round6(F.col("value")).alias("value"))


@register("impute_ffill_cut", f"""
WITH ev AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts,
                   CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events)
SELECT event_id, user_id,
       {r6('value', 'last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id '
                    'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')}
FROM ev
""")
def q_impute_ffill_cut(spark, d):
    """Forward fill with a user who has a third of all events: keys of more than 2,000
    rows are cut by their own counts, no chunk is named."""
    ev = I.table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"), "ts",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"))
    out = clean.forward_fill(ev, ["value"], ["user_id"], ["ts", "event_id"], chunk_rows=2000)
    return out.select("event_id", "user_id", round6(F.col("value")).alias("value"))


@register("clip_iqr", f"""
WITH st AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
            FROM events WHERE event_id % 5 <> 0)
SELECT event_id, {r6('value', 'least(greatest(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1))')}
FROM events, st
""")
def q_clip_iqr(spark, d):
    ev = I.table(spark, d, "events").select("event_id", "value")
    fitted = clean.OutlierClipper("iqr", 1.5, cols=["value"]).fit(ev.where(EV_TRAIN()))
    return fitted.transform(ev).select("event_id", round6(F.col("value")).alias("value"))


@register("clip_quantile", f"""
WITH st AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi
            FROM events WHERE event_id % 5 <> 0)
SELECT event_id, {r6('value', 'least(greatest(value, lo), hi)')}
FROM events, st
""")
def q_clip_quantile(spark, d):
    ev = I.table(spark, d, "events").select("event_id", "value")
    fitted = clean.OutlierClipper("quantile", cols=["value"], lower=0.01, upper=0.99) \
                  .fit(ev.where(EV_TRAIN()))
    return fitted.transform(ev).select("event_id", round6(F.col("value")).alias("value"))


@register("replace_zscore", f"""
WITH st AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM events WHERE event_id % 5 <> 0)
SELECT event_id, {r6('value', 'CASE WHEN abs((value - mu) / sd) > 3 THEN mu ELSE value END')}
FROM events, st
""")
def q_replace_zscore(spark, d):
    ev = I.table(spark, d, "events").select("event_id", "value")
    fitted = clean.OutlierClipper("zscore", 3.0, cols=["value"]).fit(ev.where(EV_TRAIN()))
    return fitted.transform(ev).select("event_id", round6(F.col("value")).alias("value"))


def _outlier_sql() -> str:
    parts = []
    for c in LI_NUM:
        parts.append(f"""SELECT '{c}' AS feature, lo, hi, (SELECT count_if({c} < lo OR {c} > hi) FROM lineitem) AS n
  FROM (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
        FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem))""")
    u = "\n  UNION ALL ".join(parts)
    return f"""
WITH b AS ({u})
SELECT feature, {r6('lower', 'lo')}, {r6('upper', 'hi')}, CAST(n AS BIGINT) AS n_outliers FROM b
"""


@register("outlier_counts", _outlier_sql())
def q_outlier_counts(spark, d):
    li = I.table(spark, d, "lineitem").select(*LI_NUM)
    fitted = clean.OutlierClipper("iqr", 1.5, cols=LI_NUM).fit(li)
    oc = clean.outlier_counts(li, fitted)
    return oc.select("feature", round6(F.col("lower")).alias("lower"),
                     round6(F.col("upper")).alias("upper"), "n_outliers")


# -------------------------------------------------------------------- scaling

def _scale_sql(center: str, spread: str) -> str:
    stats = ", ".join(f"{center.format(c)} AS c_{c}, {spread.format(c)} AS s_{c}" for c in LI_NUM)
    outs = ", ".join(
        r6(c, f"({c} - c_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END") for c in LI_NUM)
    return f"""
WITH st AS (SELECT {stats} FROM lineitem)
SELECT l_orderkey, l_linenumber, {outs} FROM lineitem, st
"""


def _scale(spark, d, strategy):
    li = I.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LI_NUM)
    fitted = scale.Scaler(strategy, cols=LI_NUM).fit(li)
    return fitted.transform(li).select("l_orderkey", "l_linenumber",
                                       *[round6(F.col(c)).alias(c) for c in LI_NUM])


@register("scale_standard", _scale_sql("avg({})", "stddev_pop({})"))
def q_scale_standard(spark, d):
    return _scale(spark, d, "standard")


@register("scale_robust", _scale_sql("quantile_cont({}, 0.5)",
                                     "(quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25))"))
def q_scale_robust(spark, d):
    return _scale(spark, d, "robust")


@register("scale_minmax", _scale_sql("min({})", "(max({0}) - min({0}))"))
def q_scale_minmax(spark, d):
    return _scale(spark, d, "minmax")


@register("scale_roundtrip", f"""
SELECT p_partkey, {r6('p_size')}, {r6('p_retailprice')} FROM part
""")
def q_scale_roundtrip(spark, d):
    p = I.table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    cols = ["p_size", "p_retailprice"]
    out = p
    for strategy in ("robust", "standard", "minmax"):
        fitted = scale.Scaler(strategy, cols=cols).fit(p)
        out = fitted.inverse_transform(fitted.transform(out))
    return out.select("p_partkey", *[round6(F.col(c)).alias(c) for c in cols])


def _stats_sql() -> str:
    rows = []
    for c in ("p_size", "p_retailprice"):
        rows += [
            f"SELECT 'standard' AS scaler, '{c}' AS feature, 'mean' AS stat, avg({c}) AS value FROM part",
            f"SELECT 'standard', '{c}', 'std', stddev_pop({c}) FROM part",
            f"SELECT 'robust', '{c}', 'center', quantile_cont({c}, 0.5) FROM part",
            f"SELECT 'robust', '{c}', 'scale', quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM part",
            f"SELECT 'minmax', '{c}', 'min', CAST(min({c}) AS DOUBLE) FROM part",
            f"SELECT 'minmax', '{c}', 'scale', 1.0 / (max({c}) - min({c})) FROM part",
        ]
    u = "\n  UNION ALL ".join(rows)
    return f"WITH s AS ({u})\nSELECT scaler, feature, stat, {r6('value')} FROM s"


@register("scaler_stats", _stats_sql())
def q_scaler_stats(spark, d):
    p = I.table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    out = None
    for strategy in ("standard", "robust", "minmax"):
        st = scale.Scaler(strategy, cols=["p_size", "p_retailprice"]).fit(p).stats(spark)
        out = st if out is None else out.unionByName(st)
    return out.select("scaler", "feature", "stat", round6(F.col("value")).alias("value"))


# ------------------------------------------------------------------- encoding
# part: fit on every brand but Brand#2, so Brand#2 is unseen at transform.

# The category sets of the part fixture.
P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
P_BRANDS_SEEN = sorted(f"Brand#{i}" for i in range(1, 26) if i != 2)


def _part(spark, d):
    return I.table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size",
                                             "p_retailprice")


def _part_fit(p):
    return p.where(F.col("p_brand") != "Brand#2")


_PFIT = "FROM part WHERE p_brand <> 'Brand#2'"


def _onehot_sql() -> str:
    cols = [f'CAST(p_type = \'{v}\' AS BIGINT) AS "p_type_{v}"' for v in P_TYPES]
    cols += [f'CAST(p_brand = \'{v}\' AS BIGINT) AS "p_brand_{v}"' for v in P_BRANDS_SEEN]
    return "SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, " + r6("p_retailprice") + \
        ",\n  " + ",\n  ".join(cols) + "\nFROM part"


@register("encode_onehot", _onehot_sql())
def q_encode_onehot(spark, d):
    from ..operators.encode import Encoder
    p = _part(spark, d)
    f = Encoder("onehot", cols=["p_type", "p_brand"]).fit(_part_fit(p))
    out = f.transform(p)
    hot = f.names()
    return out.select("p_partkey", F.col("p_size").cast("bigint").alias("p_size"),
                      round6(F.col("p_retailprice")).alias("p_retailprice"),
                      *[F.col(f"`{h}`").cast("bigint").alias(h) for h in hot])


@register("encode_onehot_sparse", """
WITH fit AS (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0
             UNION SELECT 'nan'),
code AS (SELECT day, CAST(row_number() OVER (ORDER BY day) - 1 AS INTEGER) AS idx, CAST(count(*) OVER () AS INTEGER) AS size FROM fit),
o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'nan' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders)
SELECT o_orderkey, day, (SELECT max(size) FROM code) AS size, idx FROM o LEFT JOIN code USING (day)
""")
def q_encode_onehot_sparse(spark, d):
    """Order days (more than a thousand categories, some missing, some unseen in the fit
    rows) as a sparse one-hot vector; its size and the place of its 1."""
    from ..operators.encode import Encoder
    o = I.table(spark, d, "orders").select("o_orderkey", F.when(
        F.col("o_orderkey") % 11 != 0, F.to_date("o_orderdate").cast("string")).alias("day"))
    out = Encoder("onehot_sparse", cols=["day"]).fit(o.where(TRAIN())).transform(o)
    # the vector as text is (size,[place],[1.0]) or (size,[],[])
    text = F.col("day_onehot").cast("string")
    return out.select("o_orderkey", F.coalesce("day", F.lit("nan")).alias("day"),
                      F.regexp_extract(text, r"^\(([0-9]+),", 1).cast("int").alias("size"),
                      F.nullif(F.regexp_extract(text, r"^\([0-9]+,\[([0-9]*)\]", 1), F.lit("")).cast("int").alias("idx"))


@register("encode_label", f"""
WITH bm AS (SELECT p_brand AS v, dense_rank() OVER (ORDER BY p_brand) - 1 AS code
            FROM (SELECT DISTINCT p_brand {_PFIT})),
tm AS (SELECT p_type AS v, dense_rank() OVER (ORDER BY p_type) - 1 AS code
       FROM (SELECT DISTINCT p_type {_PFIT}))
SELECT p.p_partkey, CAST(coalesce(bm.code, -1) AS BIGINT) AS p_brand,
       CAST(coalesce(tm.code, -1) AS BIGINT) AS p_type
FROM part p LEFT JOIN bm ON p.p_brand = bm.v LEFT JOIN tm ON p.p_type = tm.v
""")
def q_encode_label(spark, d):
    from ..operators.encode import Encoder
    p = _part(spark, d).select("p_partkey", "p_brand", "p_type")
    f = Encoder("label", cols=["p_brand", "p_type"], handle_unseen="keep").fit(_part_fit(p))
    return f.transform(p)


@register("encode_target", f"""
WITH g AS (SELECT avg(p_retailprice) AS gm {_PFIT}),
bm AS (SELECT p_brand AS v, avg(p_retailprice) AS code {_PFIT} GROUP BY 1),
tm AS (SELECT p_type AS v, avg(p_retailprice) AS code {_PFIT} GROUP BY 1)
SELECT p.p_partkey, {r6('p_brand', 'coalesce(bm.code, g.gm)')}, {r6('p_type', 'coalesce(tm.code, g.gm)')},
       {r6('p_retailprice', 'p.p_retailprice')}
FROM part p LEFT JOIN bm ON p.p_brand = bm.v LEFT JOIN tm ON p.p_type = tm.v, g
""")
def q_encode_target(spark, d):
    from ..operators.encode import Encoder
    p = _part(spark, d).select("p_partkey", "p_brand", "p_type", "p_retailprice")
    f = Encoder("target", cols=["p_brand", "p_type"], label="p_retailprice").fit(_part_fit(p))
    out = f.transform(p)
    return out.select("p_partkey", *[round6(F.col(c)).alias(c)
                                     for c in ("p_brand", "p_type", "p_retailprice")])


@register("encode_frequency", f"""
WITH n AS (SELECT count(*) AS n {_PFIT}),
bm AS (SELECT p_brand AS v, count(*) AS c {_PFIT} GROUP BY 1),
tm AS (SELECT p_type AS v, count(*) AS c {_PFIT} GROUP BY 1)
SELECT p.p_partkey, {r6('p_brand', 'bm.c / n.n')}, {r6('p_type', 'tm.c / n.n')}
FROM part p LEFT JOIN bm ON p.p_brand = bm.v LEFT JOIN tm ON p.p_type = tm.v, n
""")
def q_encode_frequency(spark, d):
    from ..operators.encode import Encoder
    p = _part(spark, d).select("p_partkey", "p_brand", "p_type")
    f = Encoder("frequency", cols=["p_brand", "p_type"]).fit(_part_fit(p))
    return f.transform(p).select("p_partkey", *[round6(F.col(c)).alias(c)
                                                for c in ("p_brand", "p_type")])


# Large maps: customers as text, some without any label; both join forms must
# give the table that the SQL gives.
_WIDE = """
w AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, nullif(o_orderpriority, '5-LOW') AS prio,
             CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice END AS price FROM orders),
fit AS (SELECT * FROM w WHERE o_orderkey % 5 <> 0)"""
_WIDE_TARGET = f"""
WITH {_WIDE},
g AS (SELECT avg(price) AS gm FROM fit),
c AS (SELECT cust, avg(price) AS code FROM fit GROUP BY 1 HAVING count(price) > 0),
p AS (SELECT prio, avg(price) AS code FROM fit GROUP BY 1 HAVING count(price) > 0)
SELECT o_orderkey, {r6('cust', 'coalesce(c.code, g.gm)')}, {r6('prio', 'coalesce(p.code, g.gm)')}
FROM w LEFT JOIN c USING (cust) LEFT JOIN p USING (prio), g
"""


def _wide(spark, d):
    o = I.table(spark, d, "orders")
    return o.select("o_orderkey", F.col("o_custkey").cast("string").alias("cust"),
                    F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"),
                    F.when(F.col("o_custkey") % 7 != 0, F.col("o_totalprice")).alias("price"))


def _wide_target(spark, d, **kw):
    from ..operators.encode import Encoder
    w = _wide(spark, d)
    f = Encoder("target", cols=["cust", "prio"], label="price", **kw).fit(w.where(TRAIN()))
    return f.transform(w).select("o_orderkey", round6(F.col("cust")).alias("cust"),
                                 round6(F.col("prio")).alias("prio"))


@register("encode_target_broadcast", _WIDE_TARGET)
def q_encode_target_broadcast(spark, d):
    return _wide_target(spark, d)


@register("encode_target_salted", _WIDE_TARGET)
def q_encode_target_salted(spark, d):
    return _wide_target(spark, d, broadcast_limit=0)


@register("encode_label_large", f"""
WITH {_WIDE},
c AS (SELECT cust, dense_rank() OVER (ORDER BY cust) - 1 AS code FROM (SELECT DISTINCT cust FROM fit)),
p AS (SELECT prio, dense_rank() OVER (ORDER BY prio) - 1 AS code
      FROM (SELECT DISTINCT coalesce(prio, 'nan') AS prio FROM fit))
SELECT o_orderkey, CAST(coalesce(c.code, -1) AS BIGINT) AS cust, CAST(coalesce(p.code, -1) AS BIGINT) AS prio
FROM w LEFT JOIN c USING (cust) LEFT JOIN p ON coalesce(w.prio, 'nan') = p.prio
""")
def q_encode_label_large(spark, d):
    from ..operators.encode import Encoder
    w = _wide(spark, d)
    f = Encoder("label", cols=["cust", "prio"], handle_unseen="keep").fit(w.where(TRAIN()))
    return f.transform(w).select("o_orderkey", "cust", "prio")


# A cell that holds NaN is a missing cell in every fit.
@register("fit_nan", f"""
WITH w AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS x FROM lineitem),
s AS (SELECT avg(x) AS m FROM w),
f AS (SELECT l_orderkey, l_linenumber, coalesce(x, m) AS mean_x FROM w, s),
t AS (SELECT avg(mean_x) AS mu, stddev_pop(mean_x) AS sd FROM f)
SELECT l_orderkey, l_linenumber, {r6('x', '(mean_x - mu) / sd')} FROM f, t
""")
def q_fit_nan(spark, d):
    li = I.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("double"))
         .otherwise(F.lit(float("nan"))).alias("x"))
    full = clean.Imputer("mean", cols=["x"]).fit(li).transform(li)
    out = scale.Scaler("standard", cols=["x"]).fit(full).transform(full)
    return out.select("l_orderkey", "l_linenumber", round6(F.col("x")).alias("x"))


@register("impute_drop", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def q_impute_drop(spark, d):
    o = I.table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    return clean.drop_missing(o, ["o_orderpriority"])


@register("scan_ids", "SELECT o_orderkey FROM orders")
def q_scan_ids(spark, d):
    return scan.load_ids(spark, f"{d}/orders.parquet", "o_orderkey")


# Orders written as CSV to the shared folder and read back: NA tokens, quotes
# and commas in cells, inferred types.
@register("scan_csv", f"""
SELECT o_orderkey, o_custkey, {r6('o_totalprice')}, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
       'a "' || o_orderstatus || '", b' AS note FROM orders
""")
def q_scan_csv(spark, d):
    o = I.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("N/A"))
         .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.concat(F.lit('a "'), F.col("o_orderstatus"), F.lit('", b')).alias("note"))
    path = f"{ensure_checkpoint_dir(spark)}/scan_csv-{uuid.uuid4().hex}"
    o.write.option("header", True).option("escape", '"').csv(path)
    out = scan.read_csv(spark, path)
    return out.withColumn("o_totalprice", round6(F.col("o_totalprice")))


# ---------------------------------------------------------------------- chain

CHAIN_NUM = ["o_year", "n_lines", "qty", "disc"]
CHAIN_CAT = ["o_orderstatus", "o_orderpriority"]


def chain_frame(spark, d):
    return I.orders_lines(spark, d).select("o_orderkey", "o_totalprice", *CHAIN_CAT, *CHAIN_NUM)


def preprocess_chain(spark, d):
    from ..operators.encode import Encoder
    from .chain import Chain
    df = chain_frame(spark, d)
    ex = ["o_orderkey", "o_totalprice"]
    chain = Chain([
        clean.Imputer("median", exclude=ex),
        clean.Imputer("most_frequent", kind="categorical", exclude=ex),
        clean.OutlierClipper("iqr", 1.5, exclude=ex),
        Encoder("target", cols=CHAIN_CAT, label="o_totalprice"),
        scale.Scaler("robust", exclude=ex),
    ])
    fitted = chain.fit(df.where(TRAIN()))
    return fitted.transform(df)


def _chain_sql() -> str:
    num, cat = CHAIN_NUM, CHAIN_CAT
    allnum = cat + num
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in num)
    modes = ",\n".join(
        f"mo_{c} AS (SELECT {c} AS v FROM ol WHERE o_orderkey % 5 <> 0 AND {c} IS NOT NULL "
        f"GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)" for c in cat)
    c1 = ", ".join([f"coalesce({c}, (SELECT v FROM mo_{c})) AS {c}" for c in cat] +
                   [f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in num])
    iq = ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in num)
    c2 = ", ".join(cat + [f"least(greatest({c}, a_{c} - 1.5 * (b_{c} - a_{c})), "
                          f"b_{c} + 1.5 * (b_{c} - a_{c})) AS {c}" for c in num])
    te = ",\n".join(f"te_{c} AS (SELECT {c} AS v, avg(o_totalprice) AS code FROM c2 "
                    f"WHERE tr GROUP BY 1)" for c in cat)
    c3 = ", ".join([f"coalesce(te_{c}.code, g.gm) AS {c}" for c in cat] + [f"c2.{c}" for c in num])
    joins = " ".join(f"LEFT JOIN te_{c} ON c2.{c} = te_{c}.v" for c in cat)
    rq = ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.5) AS m_{c}, "
                   f"quantile_cont({c}, 0.75) AS b_{c}" for c in allnum)
    outs = ", ".join(r6(c, f"({c} - m_{c}) / CASE WHEN b_{c} - a_{c} = 0 THEN 1 ELSE b_{c} - a_{c} END")
                     for c in allnum)
    return f"""
WITH {I.SQL_ORDERS_LINES},
s1 AS (SELECT {med} FROM ol WHERE o_orderkey % 5 <> 0),
{modes},
c1 AS (SELECT o_orderkey, o_totalprice, o_orderkey % 5 <> 0 AS tr, {c1} FROM ol, s1),
s2 AS (SELECT {iq} FROM c1 WHERE tr),
c2 AS (SELECT o_orderkey, o_totalprice, tr, {c2} FROM c1, s2),
g AS (SELECT avg(o_totalprice) AS gm FROM c2 WHERE tr),
{te},
c3 AS (SELECT c2.o_orderkey, c2.o_totalprice, c2.tr, {c3} FROM c2 {joins}, g),
s4 AS (SELECT {rq} FROM c3 WHERE tr)
SELECT o_orderkey, {r6('o_totalprice')}, {outs} FROM c3, s4
"""


@register("preprocess_chain", _chain_sql())
def q_preprocess_chain(spark, d):
    out = preprocess_chain(spark, d)
    return out.select("o_orderkey", *[round6(F.col(c)).alias(c)
                                      for c in ["o_totalprice", *CHAIN_CAT, *CHAIN_NUM]])


@register("stream_chain", _chain_sql())
def q_stream_chain(spark, d):
    """The preprocessing chain fitted on the batch train rows, applied to
    ``orders`` read as a stream (stream-static join with the lineitem
    aggregate), written by a parquet file sink in the shared folder and read
    back; the result must equal ``preprocess_chain``."""
    import uuid

    from ..operators.encode import Encoder
    from ..session import ensure_checkpoint_dir
    from ..streaming import score
    from .chain import Chain
    ex = ["o_orderkey", "o_totalprice"]
    cols = ["o_orderkey", "o_totalprice", *CHAIN_CAT, *CHAIN_NUM]
    fitted = Chain([
        clean.Imputer("median", exclude=ex),
        clean.Imputer("most_frequent", kind="categorical", exclude=ex),
        clean.OutlierClipper("iqr", 1.5, exclude=ex),
        Encoder("target", cols=CHAIN_CAT, label="o_totalprice"),
        scale.Scaler("robust", exclude=ex),
    ]).fit(chain_frame(spark, d).where(TRAIN()))
    stream = I.orders_lines(spark, d, orders=I.stream_table(spark, d, "orders")).select(*cols)
    out = score.transform_stream(fitted, stream).select(
        "o_orderkey", *[round6(F.col(c)).alias(c) for c in cols[1:]])
    base = ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") else base
    name = f"stream_chain_{uuid.uuid4().hex[:8]}"
    path = f"{base.rstrip('/')}/streams/{name}_out"
    q = score.start(out, name, sink="parquet", path=path)
    q.awaitTermination()
    return spark.read.parquet(path)


@register("split_holdout", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM orders
""")
def q_split_holdout(spark, d):
    o = I.table(spark, d, "orders").select("o_orderkey")
    return split.holdout(o, "o_orderkey", 0.2, method="modulo")


# ------------------------------------------------------------------- features

def _li(spark, d):
    return I.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LI_NUM)


_LI_KEYS = ["l_orderkey", "l_linenumber"]


@register("feat_squares", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    [r6(c) for c in LI_NUM] + [r6(f"{c}_squared", f"{c} * {c}") for c in LI_NUM]) + " FROM lineitem")
def q_feat_squares(spark, d):
    from ..operators import features
    out = features.polynomial_features(_li(spark, d), exclude=_LI_KEYS, products=False)
    return out.select(*_LI_KEYS, *[round6(F.col(c)).alias(c) for c in out.columns[2:]])


_PAIRS = [(a, b) for i, a in enumerate(LI_NUM) for b in LI_NUM[i + 1:]]


@register("feat_products", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    [r6(c) for c in LI_NUM] + [r6(f"{a}_x_{b}", f"{a} * {b}") for a, b in _PAIRS]) + " FROM lineitem")
def q_feat_products(spark, d):
    from ..operators import features
    out = features.polynomial_features(_li(spark, d), exclude=_LI_KEYS, squares=False)
    return out.select(*_LI_KEYS, *[round6(F.col(c)).alias(c) for c in out.columns[2:]])


@register("feat_row_sum", f"""
SELECT l_orderkey, l_linenumber, {r6('Total', 'coalesce(l_quantity, 0) + coalesce(l_extendedprice, 0)')}
FROM lineitem
""")
def q_feat_row_sum(spark, d):
    from ..operators import features
    out = features.row_sum(_li(spark, d), ["price", "quantity"], name="Total")
    return out.select(*_LI_KEYS, round6(F.col("Total")).alias("Total"))


@register("feat_row_mean", f"""
WITH v AS (SELECT l_orderkey, l_linenumber, TRY_CAST(l_discount AS DOUBLE) AS a,
                  TRY_CAST(l_tax AS DOUBLE) AS b, TRY_CAST(l_linestatus AS DOUBLE) AS c FROM lineitem)
SELECT l_orderkey, l_linenumber,
  {r6('Score', '(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / nullif(CAST((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS DOUBLE), 0)')}
FROM v
""")
def q_feat_row_mean(spark, d):
    from ..operators import features
    li = I.table(spark, d, "lineitem").select(*_LI_KEYS, "l_discount", "l_tax", "l_linestatus",
                                              "l_quantity")
    out = features.row_mean(li, ["disc", "tax", "status"], name="Score")
    return out.select(*_LI_KEYS, round6(F.col("Score")).alias("Score"))


@register("feat_age", """
SELECT l.l_orderkey, l.l_linenumber,
       CAST(year(l.l_shipdate) - year(o.o_orderdate) AS BIGINT) AS ship_age
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def q_feat_age(spark, d):
    from ..operators import features
    li = I.table(spark, d, "lineitem").select(*_LI_KEYS, "l_shipdate")
    o = I.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    out = features.difference(j, "l_shipdate", "o_orderdate", name="ship_age")
    return out.select(*_LI_KEYS, F.col("ship_age").cast("bigint").alias("ship_age"))


@register("feat_cross", """
SELECT l_orderkey, l_linenumber,
  concat_ws('_', coalesce(l_returnflag, 'nan'), coalesce(nullif(l_linestatus, 'O'), 'nan')) AS l_returnflag_l_linestatus,
  concat_ws('_', coalesce(l_returnflag, 'nan'), coalesce(l_shipinstruct, 'nan')) AS l_returnflag_l_shipinstruct,
  concat_ws('_', coalesce(nullif(l_linestatus, 'O'), 'nan'), coalesce(l_shipinstruct, 'nan')) AS l_linestatus_l_shipinstruct
FROM (SELECT *, CASE WHEN l_quantity > 25 THEN 'BULK' ELSE NULL END AS l_shipinstruct FROM lineitem)
""")
def q_feat_cross(spark, d):
    from ..operators import features
    li = I.table(spark, d, "lineitem").select(
        *_LI_KEYS, "l_returnflag", F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"),
        F.when(F.col("l_quantity") > 25, F.lit("BULK")).alias("l_shipinstruct"))
    out = features.crosses(li)
    return out.select(*_LI_KEYS, "l_returnflag_l_linestatus", "l_returnflag_l_shipinstruct",
                      "l_linestatus_l_shipinstruct")


@register("feat_weighted", f"""
SELECT l_orderkey, l_linenumber,
  {r6('weighted', '0.5 * coalesce(l_quantity, 0) + 0.3 * coalesce(l_discount, 0) + 0.2 * coalesce(l_tax, 0)')},
  CAST(2024 - year(l_shipdate) AS BIGINT) AS ship_years_ago,
  {r6('price_per_qty', 'CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END')}
FROM lineitem
""")
def q_feat_weighted(spark, d):
    from ..operators import features
    li = I.table(spark, d, "lineitem").select(*_LI_KEYS, *LI_NUM, "l_shipdate")
    out = features.weighted_sum(li, {"l_quantity": 0.5, "l_discount": 0.3, "l_tax": 0.2}, "weighted")
    out = features.age_from(out, "l_shipdate", 2024, "ship_years_ago")
    out = features.ratio(out, "l_extendedprice", "l_quantity", "price_per_qty")
    return out.select(*_LI_KEYS, round6(F.col("weighted")).alias("weighted"),
                      F.col("ship_years_ago").cast("bigint").alias("ship_years_ago"),
                      round6(F.col("price_per_qty")).alias("price_per_qty"))


# ------------------------------------------------------------ feature scoring

LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
          "l_discount", "l_tax"]
LI_Y = "l_extendedprice"


def _mi_sql(feats: list[str], exprs: dict[str, str] | None = None, source: str = "lineitem",
            y: str = LI_Y, bins: int = 10) -> str:
    """DuckDB twin of ``select.mutual_information``: CTEs ``mi(feature, score)``."""
    exprs = exprs or {}
    probs = "[" + ", ".join(repr(j / bins) for j in range(1, bins)) + "]"
    x = {c: f"CAST({exprs.get(c, c)} AS DOUBLE)" for c in [*feats, y]}
    e = ", ".join(f'quantile_disc({x[c]}, {probs}) AS "e_{c}"' for c in [*feats, y])
    b = ", ".join(f'list_sum([CASE WHEN {x[c]} > t THEN 1 ELSE 0 END FOR t IN "e_{c}"]) AS "{c}"'
                  for c in feats)
    names = ", ".join(f'"{c}"' for c in feats)
    return f"""
mi_e AS (SELECT {e} FROM {source}),
mi_b AS (SELECT list_sum([CASE WHEN {x[y]} > t THEN 1 ELSE 0 END FOR t IN "e_{y}"]) AS by_, {b}
         FROM {source}, mi_e),
mi_l AS (SELECT * FROM mi_b UNPIVOT (bx FOR feature IN ({names}))),
mi_c AS (SELECT feature, bx, by_, CAST(count(*) AS DOUBLE) AS n FROM mi_l GROUP BY ALL),
mi_t AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS tot,
                sum(n) OVER (PARTITION BY feature, bx) AS nx,
                sum(n) OVER (PARTITION BY feature, by_) AS ny FROM mi_c),
mi AS (SELECT feature, sum(n / tot * ln(n * tot / (nx * ny))) AS score FROM mi_t GROUP BY feature)
"""


def _corr_sql(feats: list[str], y: str = LI_Y) -> str:
    u = "\n  UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, {y})) AS score FROM lineitem"
                             for c in feats)
    return f"cr AS ({u})"


def _li_all(spark, d):
    return I.table(spark, d, "lineitem").select(*LI_ALL, LI_Y)


def _corr_scores(df, feats, y):
    from ..functions.stats import agg_values
    v = agg_values(df, {f"c{i}": F.abs(F.corr(F.col(c).cast("double"), F.col(y).cast("double")))
                        for i, c in enumerate(feats)})
    return df.sparkSession.createDataFrame([(c, v[f"c{i}"]) for i, c in enumerate(feats)],
                                           "feature string, score double")


@register("mutual_information", f"WITH {_mi_sql(LI_ALL)}\nSELECT feature, {r6('score')} FROM mi")
def q_mutual_information(spark, d):
    from ..operators import select
    mi = select.mutual_information(_li_all(spark, d), LI_Y, LI_ALL)
    return mi.select("feature", round6(F.col("score")).alias("score"))


@register("select_threshold", f"""
WITH {_mi_sql(LI_ALL)},
th AS (SELECT quantile_cont(score, 0.7) AS t FROM mi)
SELECT feature, {r6('score')}, {r6('threshold', 't')} FROM mi, th WHERE score > t
""")
def q_select_threshold(spark, d):
    from ..operators import select
    mi = select.mutual_information(_li_all(spark, d), LI_Y, LI_ALL)
    sel = select.threshold_select(mi, 70)
    return sel.select("feature", round6(F.col("score")).alias("score"),
                      round6(F.col("threshold")).alias("threshold"))


def _selections(spark, d):
    """Two scoring methods over lineitem: MI (keep > p70) and |Pearson r| (keep > p75)."""
    from ..operators import select
    li = _li_all(spark, d)
    mi = select.threshold_select(select.mutual_information(li, LI_Y, LI_ALL), 70) \
               .select(F.lit("Mutual Information").alias("method"), "feature", "score")
    cr = select.threshold_select(_corr_scores(li, LI_ALL, LI_Y), 75) \
               .select(F.lit("Correlation").alias("method"), "feature", "score")
    return mi.unionByName(cr)


_ORD = " UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS ordinal" for i, c in enumerate(LI_ALL))
_SEL_SQL = f"""{_mi_sql(LI_ALL)},
{_corr_sql(LI_ALL)},
sel AS (SELECT 'Mutual Information' AS method, feature, score FROM mi
          WHERE score > (SELECT quantile_cont(score, 0.7) FROM mi)
        UNION ALL
        SELECT 'Correlation', feature, score FROM cr
          WHERE score > (SELECT quantile_cont(score, 0.75) FROM cr)),
ord AS ({_ORD})"""


@register("select_vote", f"""
WITH {_SEL_SQL},
v AS (SELECT o.feature, o.ordinal, CAST(count(s.method) AS BIGINT) AS votes,
             coalesce(avg(s.score), 0.0) AS score
      FROM ord o LEFT JOIN sel s ON o.feature = s.feature GROUP BY o.feature, o.ordinal),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY votes DESC, score DESC, ordinal) AS BIGINT) AS rank FROM v)
SELECT feature, votes, {r6('score')}, rank, rank <= 3 AS selected FROM r
""")
def q_select_vote(spark, d):
    from ..operators import select
    v = select.vote(_selections(spark, d), LI_ALL, min_features=2, max_features=200)
    return v.select("feature", "votes", round6(F.col("score")).alias("score"), "rank", "selected")


@register("select_min_votes", f"""
WITH {_SEL_SQL},
v AS (SELECT o.feature, o.ordinal, CAST(count(s.method) AS BIGINT) AS votes,
             coalesce(avg(s.score), 0.0) AS score
      FROM ord o LEFT JOIN sel s ON o.feature = s.feature GROUP BY o.feature, o.ordinal),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY votes DESC, score DESC, ordinal) AS BIGINT) AS rank FROM v)
SELECT feature, votes, rank, rank <= 3 AND votes >= 2 AS selected FROM r
""")
def q_select_min_votes(spark, d):
    from ..operators import select
    v = select.vote(_selections(spark, d), LI_ALL, min_features=2, max_features=200, min_votes=2)
    return v.select("feature", "votes", "rank", "selected")


@register("importance_ranking", f"""
WITH {_SEL_SQL},
mo AS (SELECT 'Boruta' AS method, 0 AS mo UNION ALL SELECT 'Permutation', 1
       UNION ALL SELECT 'Mutual Information', 2),
a AS (SELECT s.feature, avg(s.score) AS imp, arg_min(s.method, coalesce(mo.mo, 99)) AS reason
      FROM sel s LEFT JOIN mo ON s.method = mo.method GROUP BY s.feature),
j AS (SELECT o.feature AS Feature, coalesce(a.imp, 0.0) AS Importance,
             coalesce(a.reason, 'Unknown') AS Reason FROM ord o LEFT JOIN a ON o.feature = a.feature)
SELECT Feature, {r6('Importance')}, Reason,
       CAST(row_number() OVER (ORDER BY Importance DESC, Feature) AS BIGINT) AS rank FROM j
""")
def q_importance_ranking(spark, d):
    from ..operators import select
    r = select.importance_ranking(_selections(spark, d), LI_ALL)
    return r.select("Feature", round6(F.col("Importance")).alias("Importance"), "Reason", "rank")


@register("select_project", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
""")
def q_select_project(spark, d):
    from ..operators import select
    li = I.table(spark, d, "lineitem")
    return select.project(li, ["l_quantity", "l_discount", "l_not_in_table", "l_tax"],
                          keep=["l_orderkey", "l_linenumber"])


_ENG = LI_ALL[:]          # the 7 numerics, then squares of all, then products of the first 8
_ENG_EXPR: dict[str, str] = {}
for _c in LI_ALL:
    _ENG.append(f"{_c}_squared")
    _ENG_EXPR[f"{_c}_squared"] = f"CAST({_c} AS DOUBLE) * CAST({_c} AS DOUBLE)"
for _i, _a in enumerate(LI_ALL):
    for _b in LI_ALL[_i + 1:]:
        _ENG.append(f"{_a}_x_{_b}")
        _ENG_EXPR[f"{_a}_x_{_b}"] = f"CAST({_a} AS DOUBLE) * CAST({_b} AS DOUBLE)"


@register("top_importance", f"""
WITH {_mi_sql(_ENG, _ENG_EXPR)},
r AS (SELECT feature, {r6('importance', 'score')} FROM mi)
SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS BIGINT) AS rank,
                      feature, importance FROM r) WHERE rank <= 30
""")
def q_top_importance(spark, d):
    from ..operators import evaluate, features, select
    eng = features.polynomial_features(_li_all(spark, d), cols=LI_ALL)
    mi = select.mutual_information(eng, LI_Y, _ENG)
    scores = mi.select("feature", round6(F.col("score")).alias("importance"))
    return evaluate.top_n(scores, 30).select("rank", "feature", "importance")


# --------------------------------------------------- predictions / evaluation
# Long prediction table: three group-mean predictors of o_totalprice (train
# split), scored on the test split unless a query says otherwise.

MODELS = list(I.PRED_MODELS)
METRIC_COLS = ["rmse", "mae", "r2", "mape"]


def _pred(spark, d, split_=None):
    p = I.predictions(spark, d)
    return p.where(F.col("split") == split_) if split_ else p


def _metric_sql(prefix: str = "") -> str:
    e = "(y - p)"
    return (f"CAST(count(*) AS BIGINT) AS {prefix}n, "
            f"{r6(prefix + 'rmse', f'sqrt(avg({e} * {e}))')}, "
            f"{r6(prefix + 'mae', f'avg(abs({e}))')}, "
            f"{r6(prefix + 'r2', f'CASE WHEN var_pop(y) * count(y) = 0 THEN (CASE WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - sum({e} * {e}) / (var_pop(y) * count(y)) END')}, "
            f"{r6(prefix + 'mape', f'CASE WHEN count_if(y <> 0) = 0 THEN CAST(' + chr(39) + 'inf' + chr(39) + f' AS DOUBLE) ELSE avg(CASE WHEN y <> 0 THEN abs({e}) / abs(y) END) END')}")


_TEST = "FROM pred WHERE split = 'test' AND y IS NOT NULL AND p IS NOT NULL"


def _r6cols(df, cols):
    return [round6(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns]


@register("metrics", f"""
WITH {I.SQL_PREDICTIONS}
SELECT model, {_metric_sql()} {_TEST} GROUP BY model
""")
def q_metrics(spark, d):
    from ..operators import evaluate
    m = evaluate.metrics(_pred(spark, d, "test"), by=["model"])
    return m.select(*_r6cols(m, METRIC_COLS))


@register("metrics_by_split", f"""
WITH {I.SQL_PREDICTIONS}
SELECT model, split, {_metric_sql()} FROM pred WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY model, split
""")
def q_metrics_by_split(spark, d):
    from ..operators import evaluate
    m = evaluate.metrics(_pred(spark, d), by=["model", "split"])
    return m.select(*_r6cols(m, METRIC_COLS))


def _bundle_sql() -> str:
    parts = []
    for sp in ("train", "test"):
        y = f"CASE WHEN split = '{sp}' THEN y END"
        e = f"CASE WHEN split = '{sp}' THEN y - p END"
        parts += [f"CAST(count({y}) AS BIGINT) AS {sp}_n",
                  r6(f"{sp}_rmse", f"sqrt(avg({e} * {e}))"),
                  r6(f"{sp}_mae", f"avg(abs({e}))"),
                  r6(f"{sp}_r2", f"1 - sum({e} * {e}) / (var_pop({y}) * count({y}))"),
                  r6(f"{sp}_mape", f"avg(CASE WHEN split = '{sp}' AND y <> 0 THEN abs(y - p) / abs(y) END)")]
    return (f"WITH {I.SQL_PREDICTIONS}\nSELECT model, " + ", ".join(parts) +
            "\nFROM pred WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY model")


@register("metrics_bundle", _bundle_sql())
def q_metrics_bundle(spark, d):
    """Per model: train_* and test_* metrics in one row."""
    from ..operators import evaluate
    b = evaluate.metric_bundle(_pred(spark, d), by=["model"])
    return b.select(*[round6(F.col(c)).alias(c) if c.endswith(("rmse", "mae", "r2", "mape"))
                      else F.col(c) for c in b.columns])


def _bundle_cv_sql() -> str:
    groups = {m: [g] for m, g in I.PRED_MODELS.items()}
    folds = ",".join(_cv_sql(g, m) for m, g in groups.items())
    cv = " UNION ALL ".join(f"SELECT '{m}' AS model, fold, rmse FROM m_{m}" for m in groups)
    base = _bundle_sql().removeprefix(f"WITH {I.SQL_PREDICTIONS}")
    return f"""WITH {I.SQL_PREDICTIONS},{folds},
cv AS ({cv}), b AS ({base})
SELECT b.*, c.cv_folds, c.cv_first, c.cv_last, c.cv_mean, c.cv_std FROM b JOIN (
  SELECT model, CAST(count(*) AS BIGINT) AS cv_folds, {r6('cv_first', 'arg_min(rmse, fold)')},
         {r6('cv_last', 'arg_max(rmse, fold)')}, {r6('cv_mean', 'avg(rmse)')}, {r6('cv_std', 'stddev_pop(rmse)')}
  FROM cv GROUP BY model) c USING (model)"""


def q_metrics_bundle_cv(spark, d):
    """Per model: train_*, test_* and cross-validation metrics in one row."""
    from ..operators import evaluate
    folds = None
    for m, g in I.PRED_MODELS.items():
        f = _cv_metrics(spark, d, [g]).withColumn("model", F.lit(m))
        folds = f if folds is None else folds.unionByName(f)
    b = evaluate.metric_bundle(_pred(spark, d), by=["model"], folds=folds)
    b = b.withColumn("cv_first", F.element_at("cv_scores", 1)).withColumn("cv_last", F.element_at("cv_scores", -1)).drop("cv_scores")
    return b.select(*[F.col(c) if c == "model" or c.endswith("_n") or c == "cv_folds" else round6(F.col(c)).alias(c)
                      for c in b.columns])


@register("compare_predictions", f"""
WITH {I.SQL_PREDICTIONS}
SELECT pr.o_orderkey, {r6('o_totalprice_pred', 'pr.p')}, {r6('o_totalprice_true', 'o.o_totalprice')},
       {r6('Absolute_Error', 'abs(o.o_totalprice - pr.p)')},
       {r6('Relative_Error', 'abs((o.o_totalprice - pr.p) / nullif(o.o_totalprice, 0))')}
FROM (SELECT o_orderkey, p FROM pred WHERE model = 'by_priority' AND split = 'test') pr
JOIN orders o ON pr.o_orderkey = o.o_orderkey
""")
def q_compare_predictions(spark, d):
    from ..operators import evaluate
    pred = _pred(spark, d, "test").where(F.col("model") == "by_priority") \
                                  .select("o_orderkey", F.col("p").alias("o_totalprice"))
    truth = I.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    c = evaluate.compare_with_truth(pred, truth, "o_orderkey", "o_totalprice")
    return c.select("o_orderkey", *[round6(F.col(x)).alias(x) for x in c.columns[1:]])


@register("model_ranking", f"""
WITH {I.SQL_PREDICTIONS},
m AS (SELECT model, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae {_TEST} GROUP BY model)
SELECT model, {r6('rmse')}, {r6('mae')},
       CAST(row_number() OVER (ORDER BY rmse, model) AS BIGINT) AS rank,
       row_number() OVER (ORDER BY rmse, model) = 1 AS is_best
FROM m
""")
def q_model_ranking(spark, d):
    from ..operators import evaluate
    m = evaluate.metrics(_pred(spark, d, "test"), by=["model"]).select("model", "rmse", "mae")
    r = evaluate.rank_models(m, "rmse")
    return r.select("model", round6(F.col("rmse")).alias("rmse"), round6(F.col("mae")).alias("mae"),
                    "rank", "is_best")


@register("error_analysis", f"""
WITH {I.SQL_PREDICTIONS},
e AS (SELECT model, y - p AS e {_TEST})
SELECT model, {r6('mean_error', 'avg(e)')}, {r6('std_error', 'stddev_pop(e)')},
       {r6('min_error', 'min(e)')}, {r6('max_error', 'max(e)')},
       {r6('median_abs_error', 'quantile_cont(abs(e), 0.5)')},
       {r6('percentile_90_error', 'quantile_cont(abs(e), 0.9)')},
       {r6('percentile_95_error', 'quantile_cont(abs(e), 0.95)')}
FROM e GROUP BY model
""")
def q_error_analysis(spark, d):
    from ..operators import evaluate
    ea = evaluate.error_analysis(_pred(spark, d, "test"), by=["model"])
    return ea.select("model", *[round6(F.col(c)).alias(c) for c in ea.columns if c != "model"])


@register("error_analysis_groups", f"""
WITH e AS (SELECT l_orderkey, l_extendedprice - 1500 * l_quantity AS e FROM lineitem)
SELECT l_orderkey, {r6('mean_error', 'avg(e)')}, {r6('std_error', 'stddev_pop(e)')},
       {r6('min_error', 'min(e)')}, {r6('max_error', 'max(e)')},
       {r6('median_abs_error', 'quantile_cont(abs(e), 0.5)')},
       {r6('percentile_90_error', 'quantile_cont(abs(e), 0.9)')},
       {r6('percentile_95_error', 'quantile_cont(abs(e), 0.95)')}
FROM e GROUP BY l_orderkey
""")
def q_error_analysis_groups(spark, d):
    """Errors of a flat price per unit, by order: as many groups as there are orders."""
    from ..operators import evaluate
    li = I.table(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("y"), (1500 * F.col("l_quantity")).alias("p"))
    ea = evaluate.error_analysis(li, by=["l_orderkey"])
    return ea.select("l_orderkey", *[round6(F.col(c)).alias(c) for c in ea.columns if c != "l_orderkey"])


_LONG_SQL = f"""{I.SQL_PREDICTIONS},
m AS (SELECT model, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
             1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2,
             avg(CASE WHEN y <> 0 THEN abs(y - p) / abs(y) END) AS mape {_TEST} GROUP BY model),
rep AS (SELECT model AS Model, Metric, Value FROM m UNPIVOT (Value FOR Metric IN (rmse, mae, r2, mape)))"""


@register("metric_report", f"""
WITH {_LONG_SQL}
SELECT Model, Metric, {r6('Value')} FROM rep
""")
def q_metric_report(spark, d):
    from ..operators import evaluate
    m = evaluate.metrics(_pred(spark, d, "test"), by=["model"])
    rep = evaluate.metric_report(m)
    return rep.select("Model", "Metric", round6(F.col("Value")).alias("Value"))


@register("metric_pivot", f"""
WITH {_LONG_SQL},
ens AS (SELECT 'ensemble_mean' AS Model, 'rmse' AS Metric, sqrt(avg((y - p) * (y - p))) AS Value
        FROM (SELECT o_orderkey, any_value(y) AS y, avg(p) AS p FROM pred WHERE split = 'test'
              GROUP BY o_orderkey)),
allr AS (SELECT * FROM rep UNION ALL SELECT * FROM ens)
SELECT Model,
  {r6('rmse', "max(CASE WHEN Metric = 'rmse' THEN Value END)")},
  {r6('mae', "max(CASE WHEN Metric = 'mae' THEN Value END)")},
  {r6('r2', "max(CASE WHEN Metric = 'r2' THEN Value END)")},
  {r6('mape', "max(CASE WHEN Metric = 'mape' THEN Value END)")}
FROM allr GROUP BY Model
""")
def q_metric_pivot(spark, d):
    """Models × metrics; the mean ensemble only reports RMSE, so its other cells are null."""
    from ..operators import ensemble, evaluate
    test = _pred(spark, d, "test")
    rep = evaluate.metric_report(evaluate.metrics(test, by=["model"]))
    ens = ensemble.mean_vote(test, "o_orderkey").join(
        test.groupBy("o_orderkey").agg(F.first("y").alias("y")), "o_orderkey")
    ens_rmse = evaluate.metrics(ens, "y", "prediction").select(
        F.lit("ensemble_mean").alias("Model"), F.lit("rmse").alias("Metric"),
        F.col("rmse").alias("Value"))
    pv = evaluate.metric_pivot(rep.unionByName(ens_rmse), METRIC_COLS)
    return pv.select("Model", *[round6(F.col(c)).alias(c) for c in METRIC_COLS])


@register("comparison_bars", f"""
WITH {_LONG_SQL},
ens AS (SELECT 'ensemble_mean' AS Model, 'rmse' AS Metric, sqrt(avg((y - p) * (y - p))) AS Value
        FROM (SELECT o_orderkey, any_value(y) AS y, avg(p) AS p FROM pred WHERE split = 'test'
              GROUP BY o_orderkey)),
allr AS (SELECT * FROM rep UNION ALL SELECT * FROM ens),
models AS (SELECT DISTINCT Model FROM allr)
SELECT m.Model, {r6('mae', 'coalesce(a.Value, 0.0)')}
FROM models m LEFT JOIN (SELECT Model, Value FROM allr WHERE Metric = 'mae') a ON m.Model = a.Model
""")
def q_comparison_bars(spark, d):
    """Bar data of one metric (MAE) per model; the mean ensemble has no MAE → 0."""
    from ..operators import ensemble, evaluate
    test = _pred(spark, d, "test")
    rep = evaluate.metric_report(evaluate.metrics(test, by=["model"]))
    ens = ensemble.mean_vote(test, "o_orderkey").join(
        test.groupBy("o_orderkey").agg(F.first("y").alias("y")), "o_orderkey")
    ens_rmse = evaluate.metrics(ens, "y", "prediction").select(
        F.lit("ensemble_mean").alias("Model"), F.lit("rmse").alias("Metric"),
        F.col("rmse").alias("Value"))
    bars = evaluate.comparison_bars(rep.unionByName(ens_rmse), "mae")
    return bars.select("Model", round6(F.col("mae")).alias("mae"))


@register("scatter_bins", f"""
WITH {I.SQL_PREDICTIONS},
t AS (SELECT model, y, p {_TEST}),
b AS (SELECT model, least(min(y), min(p)) AS lo, greatest(max(y), max(p)) AS hi FROM t GROUP BY model)
SELECT t.model, {r6('lo', 'b.lo')}, {r6('hi', 'b.hi')},
  CAST(coalesce(least(floor((t.y - b.lo) / nullif(b.hi - b.lo, 0) * 20), 19), 0) AS BIGINT) AS bin_true,
  CAST(coalesce(least(floor((t.p - b.lo) / nullif(b.hi - b.lo, 0) * 20), 19), 0) AS BIGINT) AS bin_pred,
  CAST(count(*) AS BIGINT) AS n
FROM t JOIN b ON t.model = b.model GROUP BY ALL
""")
def q_scatter_bins(spark, d):
    from ..operators import evaluate
    s = evaluate.scatter_bins(_pred(spark, d, "test"), by=["model"], bins=20)
    return s.select("model", round6(F.col("lo")).alias("lo"), round6(F.col("hi")).alias("hi"),
                    "bin_true", "bin_pred", "n")


@register("error_histogram", f"""
WITH {I.SQL_PREDICTIONS},
e AS (SELECT model, y - p AS e {_TEST}),
r AS (SELECT model, min(e) AS lo, max(e) AS hi FROM e GROUP BY model),
c AS (SELECT e.model, CAST(coalesce(least(floor((e.e - r.lo) / nullif(r.hi - r.lo, 0) * 50), 49), 0) AS BIGINT) AS bin,
             count(*) AS n FROM e JOIN r ON e.model = r.model GROUP BY ALL),
g AS (SELECT model, lo, hi, CAST(unnest(range(0, 50)) AS BIGINT) AS bin FROM r)
SELECT g.model, g.bin, {r6('left', 'g.lo + g.bin * ((g.hi - g.lo) / 50)')},
       {r6('right', 'g.lo + (g.bin + 1) * ((g.hi - g.lo) / 50)')},
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM g LEFT JOIN c ON g.model = c.model AND g.bin = c.bin
""")
def q_error_histogram(spark, d):
    from ..operators import evaluate
    h = evaluate.error_histogram(_pred(spark, d, "test"), by=["model"], bins=50)
    return h.select("model", "bin", round6(F.col("left")).alias("left"),
                    round6(F.col("right")).alias("right"), "n")


@register("error_box", f"""
WITH {I.SQL_PREDICTIONS},
e AS (SELECT model, y - p AS e {_TEST}),
q AS (SELECT model, quantile_cont(e, 0.25) AS q1, quantile_cont(e, 0.5) AS med,
             quantile_cont(e, 0.75) AS q3 FROM e GROUP BY model)
SELECT e.model, {r6('q1', 'q.q1')}, {r6('median', 'q.med')}, {r6('q3', 'q.q3')},
  {r6('whisker_low', 'min(CASE WHEN e.e >= q.q1 - 1.5 * (q.q3 - q.q1) THEN e.e END)')},
  {r6('whisker_high', 'max(CASE WHEN e.e <= q.q3 + 1.5 * (q.q3 - q.q1) THEN e.e END)')},
  CAST(count_if(e.e < q.q1 - 1.5 * (q.q3 - q.q1) OR e.e > q.q3 + 1.5 * (q.q3 - q.q1)) AS BIGINT) AS n_outliers
FROM e JOIN q ON e.model = q.model GROUP BY e.model, q.q1, q.med, q.q3
""")
def q_error_box(spark, d):
    from ..operators import evaluate
    b = evaluate.error_box(_pred(spark, d, "test"), by=["model"])
    return b.select("model", *[round6(F.col(c)).alias(c)
                               for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
                    F.col("n_outliers").cast("bigint").alias("n_outliers"))


_CORR_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax"]


def _corrm_sql() -> str:
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM lineitem"
             for a in _CORR_COLS for b in _CORR_COLS]
    return "WITH c AS (" + "\n  UNION ALL ".join(parts) + f")\nSELECT feature_a, feature_b, {r6('r')} FROM c"


@register("correlation_matrix", _corrm_sql())
def q_correlation_matrix(spark, d):
    from ..operators import evaluate
    cm = evaluate.correlation_matrix(I.table(spark, d, "lineitem"))
    return cm.select("feature_a", "feature_b", round6(F.col("r")).alias("r"))


_GAPS = {"qty": ("l_quantity", "l_linenumber % 3 = 0"), "price": ("l_extendedprice", "l_partkey % 7 = 0"),
         "disc": ("l_discount", "l_suppkey % 5 = 0"), "part": ("l_partkey", "false"), "flat": ("l_quantity * 0", "false")}


@register("correlation_nulls", "WITH g AS (SELECT " + ", ".join(
    f"CASE WHEN NOT ({cond}) THEN CAST({x} AS DOUBLE) END AS {c}" for c, (x, cond) in _GAPS.items()) + " FROM lineitem),\nc AS ("
    + "\n UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM g" for a in _GAPS for b in _GAPS)
    + ")\nSELECT feature_a, feature_b, CASE WHEN NOT isnan(r) THEN " + r6("r").rsplit(" AS ", 1)[0] + " END AS r FROM c")
def q_correlation_nulls(spark, d):
    """Pairwise-complete correlations of columns with gaps in different rows, one of them constant."""
    from ..operators import evaluate
    gaps = I.table(spark, d, "lineitem").select(*[
        F.expr(f"CASE WHEN NOT ({cond}) THEN CAST({x} AS DOUBLE) END").alias(c) for c, (x, cond) in _GAPS.items()])
    cm = evaluate.correlation_matrix(gaps, list(_GAPS))
    return cm.select("feature_a", "feature_b", round6(F.col("r")).alias("r"))


# ------------------------------------------------------------------ ensembles

@register("ensemble_weighted", f"""
WITH {I.SQL_PREDICTIONS},
w AS (SELECT 'by_priority' AS model, 0.5 / 0.8 AS w UNION ALL SELECT 'by_status', 0.3 / 0.8
      UNION ALL SELECT 'by_year', 1.0 / 3)
SELECT o_orderkey, {r6('prediction', 'sum(w.w * pred.p) / sum(CASE WHEN pred.p IS NOT NULL THEN w.w END)')}
FROM pred JOIN w ON pred.model = w.model GROUP BY o_orderkey
""")
def q_ensemble_weighted(spark, d):
    from ..operators import ensemble
    e = ensemble.weighted_average(_pred(spark, d), "o_orderkey",
                                  {"by_priority": 0.5, "by_status": 0.3}, models=MODELS)
    return e.select("o_orderkey", round6(F.col("prediction")).alias("prediction"))


@register("ensemble_mean", f"""
WITH {I.SQL_PREDICTIONS}
SELECT o_orderkey, {r6('prediction', 'avg(p)')} FROM pred GROUP BY o_orderkey
""")
def q_ensemble_mean(spark, d):
    from ..operators import ensemble
    e = ensemble.mean_vote(_pred(spark, d), "o_orderkey")
    return e.select("o_orderkey", round6(F.col("prediction")).alias("prediction"))


@register("ensemble_stacking")
def q_ensemble_stacking(spark, d):
    """Ridge(α=1) on the members' train predictions, applied to the test split."""
    from ..operators import ensemble
    p = _pred(spark, d)
    va, model = ensemble.fit_stacking(p.where(F.col("split") == "train"), "o_orderkey", "y", MODELS)
    out = ensemble.predict_stacking(va, model, p.where(F.col("split") == "test"), "o_orderkey", MODELS)
    return out.select("o_orderkey", round6(F.col("prediction")).alias("prediction"))


def _oof_sql() -> str:
    """Out-of-fold predictions of the three members (folds: key mod 4, train rows) and
    the closed form of the ridge by Cramer's rule."""
    parts, names = [], {"by_priority": "o_orderpriority", "by_status": "o_orderstatus", "by_year": "o_year"}
    for m, g in names.items():
        parts.append(f"""
s_{m} AS (SELECT {g} AS g, o_orderkey % 4 AS fold, sum(o_totalprice) AS s, count(o_totalprice) AS n FROM tr GROUP BY ALL),
t_{m} AS (SELECT g, sum(s) AS st, sum(n) AS nt FROM s_{m} GROUP BY g),
f_{m} AS (SELECT fold, sum(s) AS fs, sum(n) AS fn, sum(sum(s)) OVER () AS gs, sum(sum(n)) OVER () AS gn FROM s_{m} GROUP BY fold),
p_{m} AS (SELECT tr.o_orderkey, coalesce((t.st - s.s) / nullif(t.nt - s.n, 0), (f.gs - f.fs) / nullif(f.gn - f.fn, 0)) AS p
          FROM tr JOIN s_{m} s ON tr.{g} = s.g AND tr.o_orderkey % 4 = s.fold JOIN t_{m} t ON t.g = s.g JOIN f_{m} f ON f.fold = s.fold)""")
    a = ["by_priority", "by_status", "by_year"]
    sums = ", ".join([f"count(*) * covar_pop({x}, {y}) {'+ 1' if x == y else ''} AS a{i}{j}" for i, x in enumerate(a) for j, y in enumerate(a)]
                     + [f"count(*) * covar_pop({x}, y) AS b{i}" for i, x in enumerate(a)]
                     + [f"avg({x}) AS m{i}" for i, x in enumerate(a)] + ["avg(y) AS my"])

    def det(c):
        (p, q, r), (s, t, u), (v, w, x) = c
        return f"({p} * ({t} * {x} - {u} * {w}) - {q} * ({s} * {x} - {u} * {v}) + {r} * ({s} * {w} - {t} * {v}))"

    grid = [[f"a{i}{j}" for j in range(3)] for i in range(3)]
    solved = ", ".join(det([[f"b{i}" if j == k else grid[i][j] for j in range(3)] for i in range(3)]) + f" / {det(grid)} AS w{k}" for k in range(3))
    return f"""
tr AS (SELECT * FROM ob WHERE split = 'train'),{",".join(parts)},
oof AS (SELECT tr.o_orderkey, tr.o_totalprice AS y, p1.p AS by_priority, p2.p AS by_status, p3.p AS by_year
        FROM tr JOIN p_by_priority p1 USING (o_orderkey) JOIN p_by_status p2 USING (o_orderkey) JOIN p_by_year p3 USING (o_orderkey)),
sums AS (SELECT {sums} FROM oof),
w AS (SELECT *, {solved} FROM sums),
members AS (SELECT o_orderkey, max(p) FILTER (model = 'by_priority') AS p0, max(p) FILTER (model = 'by_status') AS p1,
                   max(p) FILTER (model = 'by_year') AS p2 FROM pred WHERE split = 'test' GROUP BY o_orderkey)"""


@register("stacking_out_of_fold", f"""
WITH {I.SQL_PREDICTIONS},
{_oof_sql()}
SELECT o_orderkey, floor((my + w0 * (p0 - m0) + w1 * (p1 - m1) + w2 * (p2 - m2)) * 100 + 0.5) / 100 AS prediction
FROM members, w
""")
def q_stacking_out_of_fold(spark, d):
    """Ridge(α=1) on out-of-fold predictions of the train rows (4 folds, key mod 4),
    applied to the members' predictions of the test split; in cents."""
    from ..operators import ensemble
    train = I.orders_base(spark, d).where("split = 'train'")
    oof = ensemble.group_mean_oof(train, "o_orderkey", "o_totalprice", I.PRED_MODELS, k=4, method="modulo")
    ridge = ensemble.fit_ridge(oof, "o_orderkey", MODELS)
    out = ridge.predict(_pred(spark, d, "test"), "o_orderkey")
    return out.select("o_orderkey", (F.floor(F.col("prediction") * 100 + 0.5) / 100).alias("prediction"))


@register("prediction_summary", f"""
WITH {I.SQL_PREDICTIONS}
SELECT model, CAST(count(*) AS BIGINT) AS n_rows, {r6('min_prediction', 'min(p)')},
       {r6('max_prediction', 'max(p)')} FROM pred GROUP BY model
""")
def q_prediction_summary(spark, d):
    from ..sources import sinks
    s = sinks.prediction_summary(_pred(spark, d), model_col="model", pred_col="p")
    return s.select("model", "n_rows", round6(F.col("min_prediction")).alias("min_prediction"),
                    round6(F.col("max_prediction")).alias("max_prediction"))


@register("prediction_sink", f"""
WITH {I.SQL_PREDICTIONS}
SELECT model, CAST(count(*) AS BIGINT) AS n_rows, {r6('min_prediction', 'min(p)')},
       {r6('max_prediction', 'max(p)')} FROM pred GROUP BY model
""")
def q_prediction_sink(spark, d):
    """The prediction table written by model to the shared folder, read back and summed up."""
    from ..sources import sinks
    path = f"{ensure_checkpoint_dir(spark)}/prediction_sink-{uuid.uuid4().hex}"
    sinks.write_predictions(_pred(spark, d), path)
    s = sinks.prediction_summary(sinks.read_predictions(spark, path), model_col="model", pred_col="p")
    return s.select("model", "n_rows", round6(F.col("min_prediction")).alias("min_prediction"),
                    round6(F.col("max_prediction")).alias("max_prediction"))


@register("prediction_rewrite", f"""
WITH {I.SQL_PREDICTIONS}
SELECT model, CAST(count(*) AS BIGINT) AS n_rows, {r6('min_prediction', "min(CASE WHEN model = 'by_year' THEN p + 1 ELSE p END)")},
       {r6('max_prediction', "max(CASE WHEN model = 'by_year' THEN p + 1 ELSE p END)")} FROM pred GROUP BY model
""")
def q_prediction_rewrite(spark, d):
    """All models written, then one of them twice more with other values: the others stay."""
    from ..sources import sinks
    path = f"{ensure_checkpoint_dir(spark)}/prediction_rewrite-{uuid.uuid4().hex}"
    pred = _pred(spark, d)
    sinks.write_predictions(pred, path)
    for _ in range(2):
        sinks.write_predictions(pred.where("model = 'by_year'").withColumn("p", F.col("p") + 1), path)
    s = sinks.prediction_summary(sinks.read_predictions(spark, path), model_col="model", pred_col="p")
    return s.select("model", "n_rows", round6(F.col("min_prediction")).alias("min_prediction"),
                    round6(F.col("max_prediction")).alias("max_prediction"))


@register("prediction_formats", f"""
WITH {I.SQL_PREDICTIONS}
SELECT fmt, model, CAST(count(*) AS BIGINT) AS n_rows, {r6('min_prediction', 'min(p)')}, {r6('max_prediction', 'max(p)')}
FROM pred, (SELECT unnest(['parquet', 'csv', 'json']) AS fmt) GROUP BY fmt, model
""")
def q_prediction_formats(spark, d):
    """The prediction table written and read back as Parquet, CSV and JSON."""
    from ..sources import sinks
    base = f"{ensure_checkpoint_dir(spark)}/prediction_formats-{uuid.uuid4().hex}"
    pred = _pred(spark, d).select("model", "o_orderkey", "p")
    out = None
    for fmt in sinks.FORMATS:
        sinks.write_predictions(pred, f"{base}-{fmt}", fmt)
        back = sinks.read_predictions(spark, f"{base}-{fmt}", fmt, schema="o_orderkey bigint, p double, model string")
        s = sinks.prediction_summary(back, model_col="model", pred_col="p").select(
            F.lit(fmt).alias("fmt"), "model", "n_rows", round6(F.col("min_prediction")).alias("min_prediction"),
            round6(F.col("max_prediction")).alias("max_prediction"))
        out = s if out is None else out.unionByName(s)
    return out


# ------------------------------------------------- cross-validation / search

_CV_GROUPS = {"by_priority": ["o_orderpriority"], "by_status": ["o_orderstatus"],
              "by_year": ["o_year"], "by_priority_status": ["o_orderpriority", "o_orderstatus"]}


def _cv_sql(groups: list[str], tag: str) -> str:
    g = ", ".join(groups)
    on = " AND ".join(f"d.{c} = s.{c}" for c in groups)
    on2 = " AND ".join(f"d.{c} = t.{c}" for c in groups)
    return f"""
d_{tag} AS (SELECT o_orderkey, {g}, o_totalprice AS y, CAST(o_orderkey % 5 AS INTEGER) AS fold FROM ob),
s_{tag} AS (SELECT {g}, fold, sum(y) AS s, count(y) AS n FROM d_{tag} GROUP BY ALL),
t_{tag} AS (SELECT {g}, sum(s) AS st, sum(n) AS nt FROM s_{tag} GROUP BY ALL),
f_{tag} AS (SELECT fold, sum(s) AS fs, sum(n) AS fn FROM s_{tag} GROUP BY fold),
a_{tag} AS (SELECT sum(s) AS gs, sum(n) AS gn FROM s_{tag}),
p_{tag} AS (SELECT d.fold, d.o_orderkey, d.y,
                   coalesce((t.st - s.s) / nullif(t.nt - s.n, 0), (a.gs - f.fs) / nullif(a.gn - f.fn, 0)) AS p
            FROM d_{tag} d JOIN s_{tag} s ON {on} AND d.fold = s.fold
            JOIN t_{tag} t ON {on2} JOIN f_{tag} f ON d.fold = f.fold, a_{tag} a),
m_{tag} AS (SELECT fold, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
                   1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2
            FROM p_{tag} WHERE p IS NOT NULL GROUP BY fold)"""


def _cv_frame(spark, d):
    return I.orders_base(spark, d)


def _cv_metrics(spark, d, groups):
    from ..operators import ensemble, evaluate
    p = ensemble.group_mean_cv(_cv_frame(spark, d), "o_orderkey", "o_totalprice", groups,
                               k=5, method="modulo")
    return evaluate.metrics(p, by=["fold"])


register("metrics_bundle_cv", _bundle_cv_sql())(q_metrics_bundle_cv)


@register("cv_fold_metrics", f"""
WITH {I.SQL_PREDICTIONS},
{_cv_sql(["o_orderpriority"], "pr")}
SELECT fold, CAST(n AS BIGINT) AS n, {r6('rmse')}, {r6('mae')}, {r6('r2')},
       {r6('cv_mean', 'avg(rmse) OVER ()')}, {r6('cv_std', 'stddev_pop(rmse) OVER ()')}
FROM m_pr
""")
def q_cv_fold_metrics(spark, d):
    """5-fold CV (fold = key mod 5) of the priority group-mean predictor."""
    from ..operators import learn
    m = _cv_metrics(spark, d, ["o_orderpriority"])
    s = learn.fold_summary(m).first()
    return m.select(F.col("fold").cast("int").alias("fold"), "n",
                    *[round6(F.col(c)).alias(c) for c in ("rmse", "mae", "r2")],
                    round6(F.lit(s["cv_mean"])).alias("cv_mean"),
                    round6(F.lit(s["cv_std"])).alias("cv_std"))


def _search_sql() -> str:
    ctes = ",".join(_cv_sql(g, t) for t, g in _CV_GROUPS.items())
    hist = "\n  UNION ALL ".join(
        f"SELECT {i} AS trial, '{','.join(g)}' AS params, avg(rmse) AS value FROM m_{t}"
        for i, (t, g) in enumerate(_CV_GROUPS.items()))
    return f"""
WITH {I.SQL_PREDICTIONS},{ctes},
h AS ({hist})
SELECT trial, params, {r6('value')},
       {r6('best_so_far', 'min(value) OVER (ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')},
       row_number() OVER (ORDER BY value, trial) = 1 AS is_best
FROM h
"""


def _group_history(spark, d):
    from ..operators import learn
    rows = []
    for i, (t, g) in enumerate(_CV_GROUPS.items()):
        m = _cv_metrics(spark, d, g)
        rows.append((i, ",".join(g), learn.fold_summary(m).first()["cv_mean"]))
    return learn.search_history(spark.createDataFrame(rows, "trial int, params string, value double"))


@register("search_sink", _search_sql())
def q_search_sink(spark, d):
    """The history of ``search_history`` written as JSON lines and read back."""
    from ..sources import sinks
    path = f"{ensure_checkpoint_dir(spark)}/search_sink-{uuid.uuid4().hex}"
    h = _group_history(spark, d)
    sinks.write_search_results(h, path)
    h = spark.read.schema(h.schema).json(path)
    return h.select("trial", "params", round6(F.col("value")).alias("value"),
                    round6(F.col("best_so_far")).alias("best_so_far"), "is_best")


@register("search_history", _search_sql())
def q_search_history(spark, d):
    """Search over the group-mean predictor's grouping: each trial's value is its
    mean 5-fold CV RMSE; history with the running best and the best trial."""
    h = _group_history(spark, d)
    return h.select("trial", "params", round6(F.col("value")).alias("value"),
                    round6(F.col("best_so_far")).alias("best_so_far"), "is_best")


# ------------------------------------------------------- learners (rows-only)

LEARN_FEATURES = [*CHAIN_CAT, *CHAIN_NUM]


def learn_frame(spark, d):
    """The preprocessed orders frame (chain fit on the train split) with its split."""
    return preprocess_chain(spark, d).withColumn(
        "split", F.when(TRAIN(), F.lit("train")).otherwise(F.lit("test")))


def _small_forest():
    from ..operators import learn
    return learn.forest(numTrees=20, maxDepth=6)


@register("model_forest")
def q_model_forest(spark, d):
    from ..operators import learn
    df = learn_frame(spark, d)
    m = learn.fit(df.where(F.col("split") == "train"), LEARN_FEATURES, "o_totalprice", _small_forest())
    return learn.predict(m, df.where(F.col("split") == "test"), "o_orderkey")


@register("model_gbt")
def q_model_gbt(spark, d):
    """Boosted trees (xgboost preset, 10 rounds) with early stopping on a
    validation slice of the train split (key mod 10 = 1)."""
    from ..operators import learn
    df = learn_frame(spark, d).withColumn("is_val", F.col("o_orderkey") % 10 == 1)
    est = learn.gbt("xgboost", maxIter=10, maxDepth=4, validation_col="is_val")
    m = learn.fit(df.where(F.col("split") == "train"), LEARN_FEATURES, "o_totalprice", est)
    return learn.predict(m, df.where(F.col("split") == "test"), "o_orderkey")


@register("model_train_score")
def q_model_train_score(spark, d):
    from ..operators import learn
    df = learn_frame(spark, d)
    train = df.where(F.col("split") == "train")
    models = learn.fit_many(train, LEARN_FEATURES, "o_totalprice",
                            {"forest": _small_forest(),
                             "gbt": learn.gbt("xgboost", maxIter=10, maxDepth=4)})
    out = None
    for name, m in models.items():
        s = learn.train_score(m, df, "o_totalprice", by=["split"]).withColumn("model", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out.select("model", "split", "n", *METRIC_COLS)


@register("cv_model")
def q_cv_model(spark, d):
    from ..operators import learn
    df = learn_frame(spark, d).where(F.col("split") == "train")
    return learn.cross_validate(df, LEARN_FEATURES, "o_totalprice",
                                learn.forest(numTrees=10, maxDepth=5), "o_orderkey", k=3,
                                parallelism=3)


@register("feature_importance")
def q_feature_importance(spark, d):
    from ..operators import evaluate, learn
    df = learn_frame(spark, d).where(F.col("split") == "train")
    m = learn.fit(df, LEARN_FEATURES, "o_totalprice", _small_forest())
    imp = spark.createDataFrame(learn.feature_importance(m, LEARN_FEATURES),
                                "feature string, importance double")
    return evaluate.top_n(imp, len(LEARN_FEATURES))


@register("gbt_split_counts")
def q_gbt_split_counts(spark, d):
    """Split-count importance of the boosted-tree preset (features never split → 0)."""
    from ..operators import learn
    df = learn_frame(spark, d).where(F.col("split") == "train")
    m = learn.fit(df, LEARN_FEATURES, "o_totalprice", learn.gbt("xgboost", maxIter=10, maxDepth=4))
    return learn.split_counts(m, LEARN_FEATURES)


@register("search_params")
def q_search_params(spark, d):
    from ..operators import learn
    df = learn_frame(spark, d).where(F.col("split") == "train")
    space = {"numTrees": ("int", 5, 15), "maxDepth": ("int", 3, 6),
             "featureSubsetStrategy": ("choice", ["sqrt", "log2", "all"])}
    hist = learn.random_search(df, LEARN_FEATURES, "o_totalprice",
                               lambda **p: learn.forest(**p), space, "o_orderkey",
                               n_trials=3, k=3, parallelism=3, cv_parallelism=3)
    return learn.search_history(hist)


@register("select_permutation")
def q_select_permutation(spark, d):
    from ..operators import select
    df = learn_frame(spark, d).where(F.col("split") == "train")
    imp = select.permutation_importance(df, "o_orderkey", LEARN_FEATURES, "o_totalprice",
                                        estimator=_small_forest(), n_repeats=2)
    sel = select.threshold_select(imp.select("feature", "score"), 75)
    return imp.join(sel.select("feature", F.lit(True).alias("selected")), "feature", "left") \
              .select("feature", "score", "score_std",
                      F.coalesce("selected", F.lit(False)).alias("selected"))


@register("select_shadow")
def q_select_shadow(spark, d):
    from ..operators import select
    df = learn_frame(spark, d).where(F.col("split") == "train")
    return select.shadow_selection(df, "o_orderkey", LEARN_FEATURES, "o_totalprice")


# ------------------------------------------------- learners with closed forms
#
# Trees without sampling, deep enough to part all cells of (priority, year), predict
# the cells' train means, whatever the order of their splits; a stump pair's
# importances follow from sums of squares. So these learner rows have SQL twins.

CELL_FEATURES = ["priority", "o_year"]
_CELL_DEPTH = 12       # five priorities and seven years part by ten splits of a path at most
_CELL_PARAMS = {"maxDepth": _CELL_DEPTH, "minInstancesPerNode": 1, "featureSubsetStrategy": "all", "subsamplingRate": 1.0}
_CELLS = f"""{I.SQL_PREDICTIONS},
cell AS (SELECT o_orderpriority, o_year, avg(o_totalprice) AS p FROM ob WHERE split = 'train' GROUP BY ALL),
scored AS (SELECT ob.o_orderkey, ob.split, ob.o_totalprice AS y, cell.p FROM ob JOIN cell USING (o_orderpriority, o_year))"""


def _cell_frame(spark, d):
    return I.orders_base(spark, d).select(
        "o_orderkey", "split", "o_totalprice", F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        F.col("o_year").cast("double").alias("o_year"))


def _cell_forest(**params):
    from ..operators import learn
    return learn.forest(**{"numTrees": 3, **_CELL_PARAMS, **params}).setBootstrap(False)


def _cell_gbt(preset, **params):
    from ..operators import learn
    return learn.gbt(preset, **{"maxIter": 1, **_CELL_PARAMS, **params})


def _cell_models(spark, d, estimators):
    from ..operators import learn
    df = _cell_frame(spark, d)
    return df, learn.fit_many(df.where("split = 'train'"), CELL_FEATURES, "o_totalprice", estimators)


def _cents(c):
    return F.floor(c * 100 + 0.5).cast("bigint")


_FOREST_CELLS = f"""
WITH {_CELLS}
SELECT o_orderkey, CAST(floor(p * 100 + 0.5) AS BIGINT) AS cents FROM scored WHERE split = 'test'
"""


@register("forest_cells", _FOREST_CELLS)
def q_forest_cells(spark, d):
    """A forest of unsampled deep trees scores every test row with its cell's train mean (in cents)."""
    from ..operators import learn
    df, m = _cell_models(spark, d, {"forest": _cell_forest()})
    p = learn.predict(m["forest"], df.where("split = 'test'"), "o_orderkey")
    return p.select("o_orderkey", _cents(F.col("prediction")).alias("cents"))


_PRESETS = ["xgboost", "catboost", "lightgbm"]


@register("gbt_cells", f"""
WITH {_CELLS}
SELECT model, o_orderkey, CAST(floor(p * 100 + 0.5) AS BIGINT) AS cents
FROM scored, (SELECT unnest({_PRESETS}) AS model) WHERE split = 'test'
""")
def q_gbt_cells(spark, d):
    """One unsampled deep round of each boosted-tree preset."""
    from ..operators import learn
    df, models = _cell_models(spark, d, {p: _cell_gbt(p) for p in _PRESETS})
    out = None
    for name, m in models.items():
        p = learn.predict(m, df.where("split = 'test'"), "o_orderkey").select(
            F.lit(name).alias("model"), "o_orderkey", _cents(F.col("prediction")).alias("cents"))
        out = p if out is None else out.unionByName(p)
    return out


@register("score_cells", f"""
WITH {_CELLS}
SELECT model, split, {_metric_sql()} FROM scored, (SELECT unnest(['forest', 'xgboost']) AS model) GROUP BY model, split
""")
def q_score_cells(spark, d):
    """Train and test scores of the two learners."""
    from ..operators import learn
    df, models = _cell_models(spark, d, {"forest": _cell_forest(), "xgboost": _cell_gbt("xgboost")})
    out = None
    for name, m in models.items():
        s = learn.train_score(m, df, "o_totalprice", by=["split"]).withColumn("model", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out.select("model", "split", "n", *[round6(F.col(c)).alias(c) for c in METRIC_COLS])


@register("cv_cells", f"""
WITH {I.SQL_PREDICTIONS},
{_cv_sql(["o_orderpriority", "o_year"], "cell")}
SELECT fold, CAST(n AS BIGINT) AS n, {r6('rmse')}, {r6('mae')}, {r6('r2')},
       {r6('cv_mean', 'avg(rmse) OVER ()')}, {r6('cv_std', 'stddev_pop(rmse) OVER ()')}
FROM m_cell
""")
def q_cv_cells(spark, d):
    """Five folds (key mod 5), a forest fitted on the other four each."""
    from ..operators import learn
    cv = learn.cross_validate(_cell_frame(spark, d), CELL_FEATURES, "o_totalprice", _cell_forest(numTrees=1), "o_orderkey",
                              k=5, method="modulo", parallelism=3)
    return cv.select("fold", "n", *[round6(F.col(c)).alias(c) for c in ("rmse", "mae", "r2", "cv_mean", "cv_std")])


_SEARCH_DEPTHS = [0, _CELL_DEPTH]


@register("search_cells", f"""
WITH {I.SQL_PREDICTIONS},
{_cv_sql(["o_orderpriority", "o_year"], "cell")},
root AS (SELECT d.fold, sqrt(avg((d.y - (a.gs - f.fs) / (a.gn - f.fn)) ** 2)) AS rmse
         FROM d_cell d JOIN f_cell f ON d.fold = f.fold, a_cell a GROUP BY d.fold),
v AS (SELECT 0 AS depth, avg(rmse) AS value FROM root UNION ALL SELECT {_CELL_DEPTH}, avg(rmse) FROM m_cell)
SELECT depth, {r6('value')}, value = min(value) OVER () AS is_best FROM v
""")
def q_search_cells(spark, d):
    """A seeded search over the depth of a tree: each value that was drawn, its mean error over
    five folds and the best; depth 0 is the mean of the other folds."""
    from ..operators import learn
    hist = learn.random_search(_cell_frame(spark, d), CELL_FEATURES, "o_totalprice",
                               lambda maxDepth: _cell_forest(numTrees=1, maxDepth=maxDepth),
                               {"maxDepth": ("choice", _SEARCH_DEPTHS)}, "o_orderkey", n_trials=4, k=5,
                               method="modulo", parallelism=2, cv_parallelism=2)
    depth = F.get_json_object("params", "$.maxDepth").cast("int")
    best = learn.best_params(hist)["maxDepth"]
    return (hist.groupBy(depth.alias("depth")).agg(F.avg("value").alias("value"))
            .select("depth", round6(F.col("value")).alias("value"), (F.col("depth") == best).alias("is_best")))


_STUMPS = {"urgent": "o_orderpriority < '3'", "late": "o_year >= 1996"}


@register("importance_gain", f"""
WITH {I.SQL_PREDICTIONS},
t AS (SELECT ({_STUMPS['urgent']}) AS urgent, ({_STUMPS['late']}) AS late, o_totalprice AS y FROM ob WHERE split = 'train'),
sst AS (SELECT var_pop(y) * count(y) AS s FROM t),
su AS (SELECT sum(s) AS s FROM (SELECT var_pop(y) * count(y) AS s FROM t GROUP BY urgent)),
sl AS (SELECT sum(s) AS s FROM (SELECT var_pop(y) * count(y) AS s FROM t GROUP BY late)),
sb AS (SELECT sum(s) AS s FROM (SELECT var_pop(y) * count(y) AS s FROM t GROUP BY urgent, late)),
i AS (SELECT su.s < sl.s AS by_urgent, (sst.s - least(su.s, sl.s)) / (sst.s - sb.s) AS root FROM sst, su, sl, sb)
SELECT 'urgent' AS feature, CAST(floor((CASE WHEN by_urgent THEN root ELSE 1 - root END) * 10000 + 0.5) AS BIGINT) AS importance FROM i
UNION ALL SELECT 'late', CAST(floor((CASE WHEN by_urgent THEN 1 - root ELSE root END) * 10000 + 0.5) AS BIGINT) FROM i
""")
def q_importance_gain(spark, d):
    """Impurity importance of two yes/no features in trees of depth two: the root's share of the
    explained sum of squares, and the other's (in ten-thousandths)."""
    from ..operators import learn
    df = I.orders_base(spark, d).where("split = 'train'").select(
        "o_totalprice", *[F.expr(e).cast("double").alias(c) for c, e in _STUMPS.items()])
    m = learn.fit(df, list(_STUMPS), "o_totalprice", _cell_forest(maxDepth=2))
    rows = spark.createDataFrame(learn.feature_importance(m, list(_STUMPS)), "feature string, x double")
    return rows.select("feature", F.floor(F.col("x") * 10000 + 0.5).cast("bigint").alias("importance"))


@register("split_count_cells", f"""
WITH {I.SQL_PREDICTIONS}
SELECT CAST(count(DISTINCT (o_orderpriority, o_year)) - 1 AS BIGINT) AS splits, true AS both_used FROM ob WHERE split = 'train'
""")
def q_split_count_cells(spark, d):
    """A tree that parts all cells splits once less than there are cells."""
    from ..operators import learn
    _, m = _cell_models(spark, d, {"xgboost": _cell_gbt("xgboost")})
    return learn.split_counts(m["xgboost"], CELL_FEATURES).agg(
        F.sum("splits").alias("splits"), (F.min("splits") > 0).alias("both_used"))


@register("artifact_scores", """
SELECT m.model, CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_different
FROM orders, (SELECT unnest(['random_forest', 'xgboost', 'ensemble']) AS model) m WHERE o_orderkey % 5 = 0 GROUP BY m.model
""")
def q_artifact_scores(spark, d):
    """A job's artifact, saved, loaded in another session and applied to the raw test
    rows: rows scored by model and those whose score is not the job's own."""
    from .artifact import load_scorer
    from .jobs import train_and_score
    orders = I.orders_lines(spark, d)
    path = f"{ensure_checkpoint_dir(spark)}/artifact-{uuid.uuid4().hex}"
    out = train_and_score(orders.where(TRAIN()), orders.where(~TRAIN()), "o_orderkey", "o_totalprice",
                          selection=("Mutual Information",), forest_params={"numTrees": 10, "maxDepth": 5},
                          gbt_params={"maxIter": 5, "maxDepth": 4}, patience=None, save_to=path)
    other = spark.newSession()
    scorer = load_scorer(other, path)
    members = scorer.members(I.orders_lines(other, d).where("o_orderkey % 5 = 0"))
    again = members.select("model", "o_orderkey", "prediction").unionByName(
        scorer.combined(members).select(F.lit("ensemble").alias("model"), "o_orderkey", "prediction"))
    path += "-again"
    again.write.parquet(path)
    first = out["predictions"].unionByName(out["ensemble"].select(F.lit("ensemble").alias("model"), "o_orderkey", "prediction"))
    both = first.join(spark.read.parquet(path).withColumnRenamed("prediction", "p2"), ["model", "o_orderkey"], "full")
    same = F.abs(F.col("prediction") - F.col("p2")) <= 1e-9 * F.abs(F.col("prediction"))
    return both.groupBy("model").agg(F.count("*").alias("n_rows"), F.count_if(~F.coalesce(same, F.lit(False))).alias("n_different"))
