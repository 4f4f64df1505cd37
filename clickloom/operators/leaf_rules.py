"""The path to every leaf of a tree ensemble, as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Walks every tree from its root. ``path`` spells the turns as 0 (left) and 1 (right), so that
# sorting by it lists the leaves from left to right. A split over categories has numCategories >= 0.
_WALK = """
WITH RECURSIVE
nodes AS (
  SELECT treeID, nodeData.id AS id, nodeData.leftChild AS leftChild, nodeData.rightChild AS rightChild,
         nodeData.split.featureIndex AS feature,
         nodeData.split.leftCategoriesOrThreshold AS marks,
         nodeData.split.numCategories >= 0 AS nominal
  FROM {nodes}),
conditions AS (
  SELECT treeID, id, leftChild, rightChild,
    CASE WHEN nominal
         THEN concat('feature ', feature, ' in {{', array_join(transform(marks, m -> CAST(m AS STRING)), ', '), '}}')
         ELSE concat('feature ', feature, ' <= ', marks[0]) END AS on_left,
    CASE WHEN nominal
         THEN concat('feature ', feature, ' not in {{', array_join(transform(marks, m -> CAST(m AS STRING)), ', '), '}}')
         ELSE concat('feature ', feature, ' > ', marks[0]) END AS on_right
  FROM nodes WHERE leftChild >= 0),
edges AS (
  SELECT treeID, id, leftChild AS child, '0' AS turn, on_left AS condition FROM conditions
  UNION ALL
  SELECT treeID, id, rightChild, '1', on_right FROM conditions),
walk (treeID, id, path, rule) AS (
  SELECT treeID, id, '', '' FROM nodes WHERE id = 0
  UNION ALL
  SELECT walk.treeID, edges.child, concat(walk.path, edges.turn),
         concat_ws(' and ', nullif(walk.rule, ''), edges.condition)
  FROM walk JOIN edges ON walk.treeID = edges.treeID AND walk.id = edges.id)
SELECT walk.treeID, walk.path, walk.rule
FROM walk JOIN nodes ON walk.treeID = nodes.treeID AND walk.id = nodes.id
WHERE nodes.leftChild < 0
"""


def leaf_rules(nodes: DataFrame) -> DataFrame:
    """treeID, leaf, rule from the node table of a saved tree ensemble."""
    walked = nodes.sparkSession.sql(_WALK, nodes=nodes)
    left_to_right = Window.partitionBy("treeID").orderBy("path")
    return walked.select("treeID", (F.row_number().over(left_to_right) - 1).alias("leaf"), "rule")


def with_weights(rules: DataFrame, leaf_counts: Sequence[int], coefficients: Sequence[float]) -> DataFrame:
    """Join each leaf to its coefficient; the leaves are the last coefficients, tree by tree."""
    places = [(t, leaf) for t, count in enumerate(leaf_counts) for leaf in range(count)]
    tail = coefficients[len(coefficients) - len(places):]
    rows = [(t, leaf, float(w)) for (t, leaf), w in zip(places, tail)]
    weights = rules.sparkSession.createDataFrame(rows, "treeID int, leaf int, weight double")
    return rules.join(weights, ["treeID", "leaf"]).select("treeID", "leaf", "rule", "weight")
