"""Ordered fit / transform chain (clean → encode → scale, or any stages).

``Chain(stages).fit(df)`` fits each stage on the *output of the previous
fitted stage* applied to the fit rows, and returns a ``FittedChain`` whose
``transform`` only extends the logical plan: Catalyst collapses the stage
projections into one, and category maps are literal lookups or joins.

The fit input is materialised once (``checkpoint`` to the shared folder
named by ``spark.checkpoint.dir``) so the aggregation passes of all stages
scan a written table instead of re-running the input's joins, and a lost
executor re-reads it instead of recomputing the lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.base import Fitted, NotFittedError
from ..session import cut_lineage, materialized


class FittedChain(Fitted):
    kind = "chain"

    def __init__(self, fitted: Sequence[Fitted]):
        self.fitted = list(fitted)

    def transform(self, df: DataFrame) -> DataFrame:
        for f in self.fitted:
            df = f.transform(df)
        return df

    def params(self):
        return {"stages": [f.kind for f in self.fitted]}

    def save(self, path: str) -> None:
        super().save(path)
        for i, f in enumerate(self.fitted):
            f.save(f"{path}/stage_{i}")


class Chain:
    def __init__(self, stages: Sequence, materialize: bool = True):
        if not stages:
            raise ValueError("a chain needs at least one stage")
        self.stages = list(stages)
        self.materialize = materialize
        self._fitted: FittedChain | None = None

    def fit(self, df: DataFrame) -> FittedChain:
        cur = cut_lineage(df) if self.materialize else df
        fitted = []
        for i, stage in enumerate(self.stages):
            f = stage.fit(cur)
            fitted.append(f)
            cur = f.transform(cur)
            if self.materialize and i + 1 < len(self.stages):
                cur = materialized(cur)     # joins with category maps run once, not in every later pass
        self._fitted = FittedChain(fitted)
        return self._fitted

    def transform(self, df: DataFrame) -> DataFrame:
        if self._fitted is None:
            raise NotFittedError("chain must be fit before transform")
        return self._fitted.transform(df)

    def fit_transform(self, train: DataFrame, *others: DataFrame) -> list[DataFrame]:
        f = self.fit(train)
        return [f.transform(train), *[f.transform(o) for o in others]]
