"""Small fitted models as column expressions: scores and exact drivers inside code generation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, functions as F

from pipewatch.ml.explain import Leaf, leaf_shares, leaves_of
from pipewatch.ml.trees import LinearScorer, TreeScorer

# The values of a row's slots, by slot.
Value = Callable[[int], Column]


def margin_column(scorer: LinearScorer | TreeScorer, value: Value) -> Column:
    """The model's margin: nested conditions for each tree, or a sum of products."""
    if isinstance(scorer, LinearScorer):
        return sum((value(int(s)) * F.lit(float(scorer.coefficients[s])) for s in scorer.slots), F.lit(scorer.intercept))

    def tree(node: int, weight: float) -> Column:
        slot = int(scorer.feature[node])
        if slot < 0:
            return F.lit(float(scorer.value[node] * weight))
        if node in scorer.allowed:
            goes_left = value(slot).isin([float(c) for c in scorer.allowed[node]])
        else:
            goes_left = value(slot) <= F.lit(float(scorer.threshold[node]))
        return F.when(goes_left, tree(int(scorer.left[node]), weight)).otherwise(tree(int(scorer.right[node]), weight))

    return sum((tree(int(r), float(w)) for r, w in zip(scorer.roots, scorer.weights)), F.lit(0.0))


def probability_column(scorer: LinearScorer | TreeScorer, margin: Column) -> Column:
    """Boosted margins count twice, as their loss has it."""
    twice = 2.0 if isinstance(scorer, TreeScorer) else 1.0
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin * F.lit(twice)))


def _hit(leaf: Leaf, j: int, x: Column) -> Column:
    if leaf.allowed[j] is not None:
        return x.isin([float(c) for c in leaf.allowed[j]])
    hit = F.lit(True)
    if np.isfinite(leaf.low[j]):
        hit = hit & (x > F.lit(float(leaf.low[j])))
    if np.isfinite(leaf.high[j]):
        hit = hit & (x <= F.lit(float(leaf.high[j])))
    return hit


def contribution_columns(scorer: LinearScorer | TreeScorer, value: Value, means: Sequence[float] = ()) -> dict[int, Column]:
    """Each slot's exact contribution to the margin.

    Linear: the coefficient times the distance from the slot's mean. Trees: per leaf, which of its conditions
    hold is a small number that picks the Shapley values from a table.
    """
    if isinstance(scorer, LinearScorer):
        return {int(s): (value(int(s)) - F.lit(float(means[s]))) * F.lit(float(scorer.coefficients[s])) for s in scorer.slots}
    out: dict[int, Column] = {}
    for leaf in leaves_of(scorer):
        m = len(leaf.features)
        patterns = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1
        shares = leaf_shares(leaf, patterns.astype(float))
        which = sum((F.when(_hit(leaf, j, value(f)), 1 << j).otherwise(0) for j, f in enumerate(leaf.features)), F.lit(0))
        for j, f in enumerate(leaf.features):
            part = F.get(F.array(*[F.lit(float(v)) for v in shares[:, j]]), which)
            out[f] = out[f] + part if f in out else part
    return out


def top_drivers_column(contributions: dict[int, Column], names: Sequence[str], top_k: int = 3, digits: int = 9) -> Column:
    """The slots that move a row's score most, joined by ``|``; equal ones (to ``digits`` places) in slot order."""
    sized = F.array(
        *[
            F.struct((-F.round(F.abs(c), digits)).alias("size"), F.lit(slot).alias("slot"), F.lit(names[slot]).alias("name"))
            for slot, c in sorted(contributions.items())
        ]
    )
    return F.array_join(F.transform(F.slice(F.array_sort(sized), 1, top_k), lambda z: z["name"]), "|")
