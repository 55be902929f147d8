"""The table of sources is never in one task."""

import random

from pyspark.sql import functions as F

from aerolith.llm import mixing


def test_targets_of_many_sources_without_a_global_window(spark):
    rnd = random.Random(4)
    sizes = {f"s{i}/{rnd.random()}": int(10 ** rnd.uniform(0, 6)) for i in range(3_000)} | {None: 7, "": 0, "Z": 40}
    sized = spark.createDataFrame(list(sizes.items()), "source string, size long").repartition(7)
    out = mixing.targets(sized)
    plan = out._jdf.queryExecution().toString()
    assert "Window" not in plan
    names = sorted(s for s in sizes if s is not None) + [None]
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    level, cap, total = 0.0, set(), sum(sizes.values())
    while True:
        level = (total - 3 * sum(sizes[s] for s in cap)) / sum(w[s] for s in names if s not in cap)
        more = {s for s in names if level * w[s] > 3 * sizes[s]} - cap
        if not more:
            break
        cap |= more
    got = {r.source: (r.source_size, r.target) for r in out.collect()}
    assert got == {s: (sizes[s], min(level * w[s], 3.0 * sizes[s])) for s in names}
    assert len(cap) > 100 and out.agg(F.sum("target")).first()[0] > 0.99 * total
