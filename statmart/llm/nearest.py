"""Exact nearest neighbours of binary codes by multi-index hashing.

A 64-bit code is cut into ``m`` segments, each indexed by its value. Round ``r`` probes every
segment for the values at distance ``r`` from the query's: after it, every code within
``m (r + 1) - 1`` bits has been met, as one of its segments must be within ``r``. A query ends as
soon as its last wanted neighbour is no farther than that, so the answer is exact. Rows with the
same code are one entry of the index, so a very common code costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .shared import discard, stored

CODE = 64
#: Codes of a bucket that are compared in one go.
BUCKET = 512


def sign_code(vector: Column) -> Column:
    """One bit for each of the first 64 dimensions: set where the value is not negative."""
    bits = F.transform(
        F.slice(vector, 1, 64), lambda x, i: F.when(x >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(0)
    )
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _segment(code: Column, i: int, segments: int) -> Column:
    bits = CODE // segments
    return F.shiftrightunsigned(code, bits * i).bitwiseAND((1 << bits) - 1).cast("int")


def _values(code: str, segments: int) -> Column:
    """The segments of a code, as (segment, value)."""
    made = [F.struct(F.lit(i).alias("segment"), _segment(F.col(code), i, segments).alias("value")) for i in range(segments)]
    return F.inline(F.array(*made))


def _verify(r: int, segments: int, need: int):
    """Compare probes with the codes of their bucket; each pair is kept in one round and segment only."""
    unit = {2: "<u4", 4: "<u2", 8: "u1"}[segments]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            q, bound, segment = (np.repeat(b.column(i).to_numpy(zero_copy_only=False), sizes) for i in range(3))
            code = lists.flatten().to_numpy(zero_copy_only=False)
            least_id = b.column(4).flatten().to_numpy(zero_copy_only=False)
            differing = q ^ code
            distance = np.bitwise_count(differing.view(np.uint64)).astype(np.int32)
            some = np.flatnonzero(distance <= bound)
            far = np.bitwise_count(differing[some].view(unit).reshape(-1, segments))
            some = some[(far.min(1) == r) & (far.argmin(1) == segment[some])]
            # No query takes more than its best few from a batch.
            by = some[np.lexsort((least_id[some], distance[some], q[some]))]
            new = np.flatnonzero(np.append(True, q[by][1:] != q[by][:-1])) if len(by) else by
            place = np.arange(len(by)) - np.repeat(new, np.diff(np.append(new, len(by))))
            by = by[place < need]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q[by]), pa.array(code[by]), pa.array(distance[by])], names=["q", "code", "distance"]
            )

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.Window.partitionBy("q").orderBy("distance", "id")
    return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).drop("n")


def nearest(
    rows: DataFrame, queries: DataFrame, k: int, id: str = "id", code: str = "code", segments: int = 4  # noqa: A002
) -> DataFrame:
    """The ``k`` nearest rows of each query by Hamming distance, ties by id, the query's own id left out.

    Returns ``query_id``, ``rank`` (from 1), ``id`` and ``distance``. Rows or queries without id or
    code take no part; repeated rows count once; fewer than ``k`` other rows give a shorter list,
    an empty table none. Other columns are not looked at. ``segments`` (2, 4 or 8) sets the cost,
    not the answer: long segments for many rows with near neighbours, short ones where the
    neighbours are far and a round of long segments would probe more values than there are rows.
    """
    need = k + 1  # the query itself may be among its nearest
    pairs = rows.select(F.col(id).alias("id"), F.col(code).alias("code")).dropna().distinct()
    first = W.Window.partitionBy("code").orderBy("id")
    # Of the rows with one code no list can hold more than the first few.
    few = pairs.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= need)
    index = stored(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    held = index.agg(F.sum(F.size("ids"))).first()[0] or 0
    asked = queries.select(F.col(id).alias("query_id"), F.col(code).alias("q")).dropna().distinct()
    bits = CODE // segments
    entries = index.select("code", F.col("ids")[0].alias("first"), _values("code", segments))
    # A value that very many codes have is several buckets.
    chunks = 1 + index.count() // (BUCKET << bits)
    chunk = F.pmod(F.xxhash64("code"), F.lit(chunks))
    pair = F.collect_list(F.struct("code", "first")).alias("pairs")
    buckets = entries.groupBy("segment", "value", chunk.alias("chunk")).agg(pair)
    buckets = stored(buckets.select("segment", "value", F.col("pairs.code").alias("codes"), F.col("pairs.first").alias("firsts")), "buckets")
    # Per query code: the farthest distance that can still matter.
    open_ = stored(asked.select("q").distinct().withColumn("bound", F.lit(64)), "open")
    best = stored(open_.select("q", F.lit(0).alias("distance"), F.lit(0).cast("long").alias("id")).limit(0), "best")
    for r in range(bits + 1):
        if open_.isEmpty():
            break
        flips = F.expr(f"filter(sequence(0, {(1 << bits) - 1}), m -> bit_count(m) = {r})")
        probes = (
            open_.select("q", "bound", _values("q", segments))
            .withColumn("flip", F.explode(flips))
            .select("q", "bound", "segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
        )
        # Never broadcast: a few queries become many probes.
        met = (
            probes.hint("merge").join(buckets, ["segment", "value"])
            .select("q", "bound", "segment", "codes", "firsts")
            .mapInArrow(_verify(r, segments, need), "q long, code long, distance int")
            .join(index, "code").select("q", "distance", F.explode("ids").alias("id"))
        )
        new = stored(_best(best.unionByName(met), need), "best")
        covered = segments * (r + 1) - 1
        reached = new.groupBy("q").agg(F.count("*").alias("n"), F.max("distance").alias("last"))
        state = open_.select("q").join(reached, "q", "left")
        full = F.coalesce(F.col("n") >= min(need, held), F.lit(False))
        still = state.filter(~(full & ((F.col("last") <= covered) | F.lit(held <= need))))
        next_ = stored(still.select("q", F.when(F.col("n") >= need, F.col("last")).otherwise(64).alias("bound")), "open")
        discard(best)
        discard(open_)
        best, open_ = new, next_
    out = asked.join(best, "q").filter(F.col("id") != F.col("query_id"))
    order = W.Window.partitionBy("query_id").orderBy("distance", "id")
    return (
        out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
    )
