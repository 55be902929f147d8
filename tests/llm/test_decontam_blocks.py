"""A benchmark of many blocks: one block's broadcast at a time."""

from pyspark import SparkContext
from pyspark.core.broadcast import Broadcast

from aerolith.llm import decontam


def test_one_block_is_held_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words item{i} alpha and item{i + 1} alpha again") for i in range(40)] + [(None, None)],
                                 "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(i, f"item{i} alpha") for i in range(12)], "item_id long, text string")
    alive, most, made = set(), [0], [0]
    broadcast, destroy = SparkContext.broadcast, Broadcast.destroy

    def count(self, value):
        part = broadcast(self, value)
        alive.add(id(part._jbroadcast))
        made[0] += 1
        most[0] = max(most[0], len(alive))
        return part

    def gone(self, *a, **k):
        alive.discard(id(self._jbroadcast))
        return destroy(self, *a, **k)
    monkeypatch.setattr(SparkContext, "broadcast", count)
    monkeypatch.setattr(Broadcast, "destroy", gone)
    monkeypatch.setattr(decontam.blocks, "__defaults__", (30,))
    many = {r.doc_id: r for r in decontam.decontaminate(docs, bench).collect()}
    assert made[0] >= 4 and most[0] == 1 and not alive
    monkeypatch.setattr(decontam.blocks, "__defaults__", (1 << 20,))
    assert many == {r.doc_id: r for r in decontam.decontaminate(docs, bench).collect()}
    assert many[0].n_items == 2 and many[0].n_hit == 4
