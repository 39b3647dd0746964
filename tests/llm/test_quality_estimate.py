"""The rounds of the rules' estimate share their generated code."""

import random

from ordstrata.llm.quality_rules import estimate, rules


def test_further_rounds_compile_nothing(spark):
    names = [f"vote_{name}" for name in rules()]
    draw = random.Random(7)
    rows = []
    for _ in range(60):
        good = draw.random() < 0.6
        side = 1 if good else -1
        votes = [draw.choice([side, side, 0, -side]) for _ in names]
        rows.append((*votes, draw.randint(1, 40)))
    fields = ", ".join(f"{name} int" for name in names)
    patterns = spark.createDataFrame(rows, f"{fields}, n bigint").coalesce(1)
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()

    few = estimate(patterns, names, rounds=3)
    before = compiled.getCount()
    many = estimate(patterns, names, rounds=6)
    assert few != many
    assert compiled.getCount() == before
