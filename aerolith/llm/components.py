"""Connected components over a table of links, with bounded tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import staged

FOREST_LINKS = 500_000


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the given links: the same components with
    fewer rows than nodes. Labels shrink to the smallest node of a component."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        lx, ly = label[x], label[y]
        differ = lx != ly
        if not differ.any():
            break
        low, high = np.minimum(lx[differ], ly[differ]), np.maximum(lx[differ], ly[differ])
        np.minimum.at(label, high, low)
        while True:  # point every node at its root
            up = label[label]
            if (up == label).all():
                break
            label = up
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def contract(links: DataFrame) -> DataFrame:
    """Links (a, b) replaced, some hundred thousand at a time, by a spanning
    forest of theirs; which links meet does not matter for the components."""
    def run(batches):
        held, n = [], 0

        def out():
            a, b = _forest(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        for batch in batches:
            held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
            n += batch.num_rows
            if n >= FOREST_LINKS:
                made = out()
                held = [[made.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]]
                if made.num_rows >= FOREST_LINKS // 2:
                    yield made
                    held = []
                n = sum(len(h[0]) for h in held)
        if n:
            yield out()
    return links.select("a", "b").mapInArrow(run, "a long, b long")


def labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a long, b long, no nulls):
    label is the smallest node that can be reached.

    Each round hooks every label to its smallest neighbour and carries the
    links over to the new labels, so the linked labels shrink until none are
    left. Each round's tables are written to the shared folder.
    """
    edges = staged(contract(links).where("a <> b"))
    label = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
                      .withColumnRenamed("a", "node"))
        if label is None:
            label = hook.withColumnRenamed("to", "label")
        else:
            label = staged(label.join(hook.withColumnRenamed("node", "label"), "label", "left")
                           .select("node", F.coalesce("to", "label").alias("label")))
        step = (edges.join(hook.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
                .join(hook.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
                .where("ta <> tb")
                .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")))
        edges = staged(contract(step.distinct()))
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return label
