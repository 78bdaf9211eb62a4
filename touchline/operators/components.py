"""Connected components of a graph given as a table of pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.sources.workspace import pinned


#: Distinct pairs up to which one task labels all nodes: some 100 MB.
ONE_TASK_PAIRS = 1_000_000


def _label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The labels of all nodes of a task's links, by the same rounds on arrays."""
    held = list(batches)
    if not held:
        return
    links = pd.concat(held, ignore_index=True)
    codes, nodes = pd.factorize(pd.concat([links["node"], links["neighbour"]]), sort=True)
    a, b = codes[: len(links)], codes[len(links) :]
    label = np.arange(len(nodes))
    while True:
        heard = label.copy()
        np.minimum.at(heard, a, label[b])
        heard = heard[heard]
        if (heard == label).all():
            break
        label = heard
    yield pd.DataFrame({"node": nodes, "component": nodes[label]})


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("node"), F.col("b").alias("neighbour")),
                F.struct(F.col("b").alias("node"), F.col("a").alias("neighbour")),
            )
        )
    )


def _nearest(links: DataFrame) -> DataFrame:
    """The smallest of every node and its neighbours."""
    return links.groupBy("node").agg(F.least(F.min("neighbour"), F.col("node")).alias("component"))


def _ordered(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """The distinct pairs, whichever way round."""
    return pairs.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).distinct()


def connected_components(pairs: DataFrame, one_task_pairs: int = ONE_TASK_PAIRS) -> DataFrame:
    """Label every node of ``pairs(left, right)`` with the smallest node it can reach.

    Up to ``one_task_pairs`` distinct pairs are labelled within one task, as each round over tables
    costs several jobs. Beyond that, every node is first merged with the smallest among itself and its
    neighbours, which leaves few of the pairs where groups are dense, and the smaller graph is
    labelled. The smallest node of a component is merged with none, so it gives the label.

    Joins shuffle both sides: Spark would judge a table of labels by its compressed files and
    broadcast it by way of the driver. Returns ``(node, component)``.
    """
    distinct = pinned(_ordered(pairs, "left", "right"), "pairs")
    if distinct.count() <= one_task_pairs:
        return _in_one_task(distinct)
    first = pinned(_nearest(_both_ways(distinct)), "labels")
    for side in ("a", "b"):
        known = first.select(F.col("node").alias(side), F.col("component").alias(f"{side}_label")).hint("merge")
        distinct = distinct.join(known, side)
    merged = pinned(_ordered(distinct, "a_label", "b_label"), "pairs")
    rest = _in_one_task(merged) if merged.count() <= one_task_pairs else _in_rounds(_both_ways(merged))
    known = rest.select(F.col("node").alias("via"), F.col("component").alias("smallest")).hint("merge")
    return first.join(known, F.col("component") == F.col("via")).select("node", F.col("smallest").alias("component"))


def _in_one_task(pairs: DataFrame) -> DataFrame:
    links = _both_ways(pairs)
    kind = links.schema["node"].dataType.simpleString()
    return links.coalesce(1).mapInPandas(_label, f"node {kind}, component {kind}")


def _in_rounds(links: DataFrame) -> DataFrame:
    """Each round hands every node the smallest label among its neighbours, then the label of
    the node so named; that second step doubles the distance covered. A round's result is
    written, so that neither the plan nor the loss of an executor makes a round repeat the
    ones before it. The rounds go on until no label changes.
    """
    labels = pinned(_nearest(links), "labels")
    while True:
        heard = (
            links.join(labels.withColumnRenamed("node", "neighbour").hint("merge"), "neighbour")
            .groupBy("node")
            .agg(F.min("component").alias("heard"))
        )
        near = labels.join(heard.hint("merge"), "node").select(
            "node", "component", F.least("component", "heard").alias("via")
        )
        beyond = labels.select(F.col("node").alias("via"), F.col("component").alias("smallest"))
        step = near.join(beyond.hint("merge"), "via").select(
            "node",
            F.col("smallest").alias("component"),
            (F.col("smallest") != F.col("component")).alias("changed"),
        )
        step = pinned(step, "labels")
        labels = step.select("node", "component")
        if step.filter("changed").limit(1).isEmpty():
            return labels
