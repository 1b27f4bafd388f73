"""Looking tokens up in a small table without taking the row apart."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Above this many rows a table is joined, not carried inside the plan. Results and arguments are the same.
INLINE_LIMIT = 20_000


def inline_lookup(table: DataFrame, key: str, limit: int = INLINE_LIMIT) -> Callable[[Column], Column] | None:
    """A function token -> the other columns of ``table`` as a struct (null when unknown).

    The other columns are numbers; a key with several rows takes the highest value of each column.
    The table becomes one constant of the plan: an array of small maps, picked by the token's hash,
    so a lookup costs one hash and a look at about one entry. It takes the place of a broadcast join
    after an explode, which would need a shuffle to put the tokens of a text together again. None
    when ``table`` has more than ``limit`` rows; no more than ``limit + 1`` rows ever reach the driver.
    """
    columns = [c for c in table.columns if c != key]
    numbers = [F.col(c).cast("double").alias(c) for c in columns]
    rows = table.select(key, F.xxhash64(key).alias("_hash"), *numbers).limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    size = 1 << max(len(rows) - 1, 0).bit_length()
    buckets: list[dict[str, dict[str, float]]] = [{} for _ in range(size)]
    for row in rows:
        entry = buckets[row["_hash"] % size].setdefault(row[key], {})
        for c in columns:
            if row[c] is not None:
                entry[c] = max(row[c], entry.get(c, row[c]))
    fields = ",".join(f"{c}:double" for c in columns)
    constant = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,struct<{fields}>>>")

    def find(token: Column) -> Column:
        return F.get(constant, F.pmod(F.xxhash64(token), F.lit(size)).cast("int"))[token]

    return find
