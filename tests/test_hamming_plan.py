"""Keys of fingerprints are never broadcast (A17), whatever Spark thinks of their size."""

import random

from brieflow.operators.similarity import hamming_pairs


def test_band_keys_meet_by_a_merge_join(spark):
    rng = random.Random(1)
    fps = [rng.getrandbits(63) for _ in range(3000)]
    near = {(min(f, g), max(f, g)) for f in fps[:50] for g in (f ^ 5, f ^ (7 << 40))}
    fps += [g for pair in near for g in pair]
    df = spark.createDataFrame([(f,) for f in fps], "simhash long").repartition(4)
    out = hamming_pairs(df, 3, blocks=8)
    got = {(r["fp_a"], r["fp_b"]) for r in out.collect()}
    values = sorted(set(fps))
    assert near <= got and got == {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= 3}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
