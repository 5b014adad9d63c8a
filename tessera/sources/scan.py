"""Sources: CSV scan with NA tokens, column-pruned id scans, table contracts.

A CSV is read as text, NA tokens become null in one projection, then the
declared types are applied with ``try_cast`` (text that does not parse is
null instead of failing the job under ANSI mode). Parquet tables are read
as they are; Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NA_TOKENS, q, string_cols


def na_tokens_to_null(df: DataFrame, cols: Sequence[str] | None = None,
                      tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """String cells whose trimmed text is an NA token become null (one projection)."""
    cols = set(cols if cols is not None else string_cols(df))
    toks = [F.lit(t) for t in tokens]
    return df.select(*[
        F.when(F.trim(F.col(q(c))).isin(*toks), F.lit(None).cast("string"))
        .otherwise(F.col(q(c))).alias(c) if c in cols else F.col(q(c))
        for c in df.columns])


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Safe casts: text that does not parse becomes null."""
    return df.select(*[F.col(q(c)).try_cast(types[c]).alias(c) if c in types else F.col(q(c))
                       for c in df.columns])


def infer_types(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, str]:
    """Type of each text column: ``bigint`` if every non-null value parses as
    an integer, else ``double`` if every one parses as a number, else
    ``string``. One aggregate over the whole table (two counters per column)."""
    from ..functions.stats import agg_values
    cols = list(cols) if cols is not None else string_cols(df)
    exprs = {}
    for i, c in enumerate(cols):
        x = F.trim(F.col(q(c)))
        exprs[f"l{i}"] = F.count_if(x.isNotNull() & x.try_cast("bigint").isNull())
        exprs[f"d{i}"] = F.count_if(x.isNotNull() & x.try_cast("double").isNull())
    v = agg_values(df, exprs)
    return {c: "bigint" if v[f"l{i}"] == 0 else "double" if v[f"d{i}"] == 0 else "string"
            for i, c in enumerate(cols)}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             tokens: Sequence[str] = NA_TOKENS, infer: bool = True,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header: every column read as text, NA tokens → null, then the
    declared types — or, without a schema, the inferred ones (``infer_types``,
    run after token nulling so ``NA`` does not force a column to text) —
    applied with ``try_cast``. Quotes inside quoted cells are doubled; with
    ``multi_line`` a quoted cell may hold line ends (such files do not split)."""
    raw = (spark.read.option("header", True).option("inferSchema", False)
           .option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path))
    raw = na_tokens_to_null(raw, raw.columns, tokens)
    if schema is None:
        if not infer:
            return raw
        types = {c: t for c, t in infer_types(raw).items() if t != "string"}
        return typed(raw, types)
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    return typed(raw, {f.name: f.dataType.simpleString() for f in st.fields if f.name in raw.columns})


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               columns: Sequence[str] | None = None, schema: str | None = None) -> DataFrame:
    """Any table; ``columns`` projects right away so only they are read."""
    if fmt == "csv":
        df = read_csv(spark, path, schema)
    else:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        df = getattr(r, fmt)(path)
    return df.select(*[F.col(q(c)) for c in columns]) if columns else df


def load_ids(spark: SparkSession, path: str, key: str, fmt: str = "parquet") -> DataFrame:
    """The id column alone (the scan reads only that column)."""
    return read_table(spark, path, fmt, [key])


def split_roles(df: DataFrame, key: str, label: str | None = None) -> tuple[list[str], str, str | None]:
    """Feature columns = everything but the key and the label, in frame order;
    key and label stay in the frame (no positional alignment in Spark)."""
    feats = [c for c in df.columns if c not in (key, label)]
    return feats, key, label


def contract_of(template: DataFrame) -> list[tuple[str, str]]:
    """Expected ``(name, type)`` list of a template table (e.g. a submission file)."""
    return [(f.name, f.dataType.simpleString()) for f in template.schema.fields]
