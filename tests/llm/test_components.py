import random
from collections import Counter

import pytest
from helpers import classes

from snapledger.llm.components import components, paired_chunks


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)]
    links += [(200 + k, 201 + k) for k in range(40)] + [(300, 300 + k) for k in range(50)] + [(7, 7)]
    ids = {x for link in links for x in link}
    frame = spark.createDataFrame(links, "a long, b long")
    rows = components(frame).collect()
    got = {r.node: r.component for r in rows}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert len(got) == len(rows) and got == {i: c for i, c in classes(ids, links).items() if i in linked}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_hot_group_is_dealt_in_pairs_of_chunks(spark):
    """No shard holds more than two chunks, though the copies are many times the rows, and all rows meet."""
    sizes = {1: 1500, 2: 40, 3: 3}
    rows = spark.createDataFrame([(k, 10_000 * k + i) for k, n in sizes.items() for i in range(n)], "key long, id long")
    dealt = paired_chunks(rows, ["key"], "id", 50, 50).collect()
    held, cells = Counter(r.shard for r in dealt), {}
    assert max(held.values()) < 4 * 50 and len(dealt) == 30 * 1500 + 43
    for r in dealt:
        assert r.in_low or r.in_high
        cells.setdefault((r.shard, r.key, r.low, r.high), []).append(r.id)
    assert len({(k, low, high) for _, k, low, high in cells}) == len(cells)
    met = {(k, a, b) for (_, k, _, _), ids in cells.items() for a in ids for b in ids if a < b}
    assert len(met) == sum(n * (n - 1) // 2 for n in sizes.values())
