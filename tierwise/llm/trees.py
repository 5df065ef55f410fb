"""Gradient-boosted trees trained by Spark ML, as expressions and as arrays.

Training takes a bounded sample, or all rows where equal ones are counted as one. The fitted trees are read from the model and
applied either as one SQL expression over feature columns or by numpy.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

_SPLIT = re.compile(r"If \(feature (\d+) <= ([^)]+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


@dataclass
class Split:
    feature: int
    at: float
    low: "Split | float"
    high: "Split | float"


def _read(lines: list[str]) -> "Split | float":
    """One node and all below it, taken from the front of an indented listing."""
    line = lines.pop(0)
    leaf = _LEAF.search(line)
    if leaf:
        return float(leaf[1])
    feature, at = _SPLIT.search(line).groups()
    low = _read(lines)
    lines.pop(0)  # the Else line
    return Split(int(feature), float(at), low, _read(lines))


@dataclass
class Boosted:
    """The margin of a row is the weighted sum of its trees; positive means the class is likely."""
    features: list[str]
    trees: list[tuple[float, "Split | float"]]

    def sql(self, row: str) -> str:
        """The margin as SQL over the fields of ``row``."""
        def expression(node: "Split | float") -> str:
            if not isinstance(node, Split):
                return f"{node!r}D"
            return (f"if({row}.{self.features[node.feature]} <= {node.at!r}D, "
                    f"{expression(node.low)}, {expression(node.high)})")
        return " + ".join(f"{w!r}D * {expression(t)}" for w, t in self.trees) or "0D"

    def margins(self, rows: np.ndarray) -> np.ndarray:
        def value(node: "Split | float", at: np.ndarray) -> np.ndarray:
            if not isinstance(node, Split):
                return np.full(len(at), node)
            low = rows[at, node.feature] <= node.at
            out = np.empty(len(at))
            out[low] = value(node.low, at[low])
            out[~low] = value(node.high, at[~low])
            return out
        every = np.arange(len(rows))
        return sum((w * value(t, every) for w, t in self.trees), np.zeros(len(rows)))


def train(sample: DataFrame, features: list[str], label: str = "label", rounds: int = 12,
          depth: int = 3, step: float = 0.3, weight: str | None = None) -> Boosted | None:
    """Boosted trees for a 0/1 label; None where the rows lack one of the two classes.

    ``weight`` names the column that says how many equal rows a row stands for."""
    counts = {r[label]: r["count"] for r in sample.groupBy(label).count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return None
    rows = VectorAssembler(inputCols=features, outputCol="x").transform(sample)
    learner = GBTClassifier(featuresCol="x", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, seed=7)
    kept = ["x", label]
    if weight:
        learner.setWeightCol(weight)
        kept.append(weight)
    model = learner.fit(rows.select(*kept))
    trees = []
    for weight, tree in zip(model.treeWeights, model.trees):
        lines = tree.toDebugString.strip().split("\n")[1:]
        trees.append((float(weight), _read(lines)))
    return Boosted(features, trees)
