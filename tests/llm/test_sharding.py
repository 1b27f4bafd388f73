"""Editing the map of slots to more and to fewer shards."""

import pytest

from vocalis.llm import sharding


@pytest.mark.parametrize("before, after", [(4, 5), (5, 4), (16, 3), (3, 16), (4, 1)])
def test_maps_are_edited_both_ways(spark, documents, before, after):
    sizes = sharding.slot_bytes(sharding.sized(documents)).collect()
    table = spark.createDataFrame(sizes, "virtual_slot int, bytes long")
    one = sharding.first_map(table, before)
    two = sharding.edited_map(table, one, after)
    loads = dict(map(tuple, sizes))
    held = [sum(loads.get(i, 0) for i, s in enumerate(two) if s == shard) for shard in range(after)]
    assert len(two) == len(one) and set(two) <= set(range(after)) and sum(held) == sum(loads.values())
    assert max(held) - min(held) <= 2 * max(loads.values())
    if after == before - 1:  # slots of the others stay, but for those that even out
        assert sum(o != n for o, n in zip(one, two) if o < after) < sum(o >= after for o in one)
