"""Sharding by histogram sort.

Rows are ordered by a key (checksum of the text, id). To cut that order into shards of equal
bytes, passes over the table count the exact bytes and rows below evenly spaced probe keys, and
each pass sets its probes only where a cut still lies between two of them, until all cuts are
within the tolerance. Then the rows are exchanged once. Each shard is cut into several parts, so
that no task sorts a whole shard; as the rows below each cut are known, positions are exact.

Equal texts share a checksum and so lie next to each other; a group of equal texts that is larger
than a part is cut by id, in further passes over its rows.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .shared import free_name, stored

#: Bits of the key that a pass over the table resolves.
FIRST_BITS, NEXT_BITS = 12, 8
LOWEST = -(1 << 63)


def _sums(rows: DataFrame, *by: Column) -> list[tuple]:
    """Exact (key..., bytes, rows) of each occupied probe interval, in key order."""
    names = [f"k{i}" for i in range(len(by))]
    found = rows.groupBy(*[c.alias(n) for c, n in zip(by, names)]).agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    return sorted(tuple(r) for r in found.collect())


def _locate(found: list[tuple], below: tuple[int, int], targets: list[float]) -> dict[int, tuple]:
    """For each target the interval it falls into: (key, bytes and rows below, own bytes and rows)."""
    edges, at = [], below
    for *key, b, n in found:
        edges.append((key[-1], at, (b, n)))
        at = (at[0] + b, at[1] + n)
    ends = [e[1][0] + e[2][0] for e in edges]
    return {t: edges[min(bisect_left(ends, t), len(edges) - 1)] for t in targets}


def splitters(rows: DataFrame, parts: int, tolerance: float) -> tuple[list[tuple], int, int]:
    """Cuts (checksum, id, rows below) between ``parts`` parts of equal bytes, and the total bytes and rows.

    ``rows`` has ``crc``, ``id`` and ``size``. A row belongs below a cut if its (checksum, id) is
    smaller. What is collected per pass is one row per probe at most: a number of cuts times 256.
    """
    shift = 32 - FIRST_BITS
    found = _sums(rows, F.shiftrightunsigned("crc", shift))
    total, count = sum(f[1] for f in found), sum(f[2] for f in found)
    if not count:
        return [], 0, 0
    allowed = tolerance * total / parts
    targets = [total * i / parts for i in range(1, parts)]
    done: dict[float, tuple] = {}

    def settle(places: dict, cut_of, last: bool) -> dict[int, list]:
        """Keep the cuts that are near enough; the others by their interval."""
        open_: dict[int, list] = {}
        for t, (key, (b, n), (own, rows_)) in places.items():
            if last or rows_ == 1 or own <= allowed:
                high = t - b > own / 2
                done[t] = (*cut_of(key + high), n + rows_ * high)
            else:
                open_.setdefault(key, []).append((t, (b, n)))
        return open_

    places = _locate(found, (0, 0), targets)
    open_ = settle(places, lambda k: (k << shift, LOWEST), False)
    while open_ and shift:
        old, shift = shift, max(0, shift - NEXT_BITS)
        inside = rows.filter(F.shiftrightunsigned("crc", old).isin(*open_))
        by_bin: dict[int, list] = {}
        for f in _sums(inside, F.shiftrightunsigned("crc", shift)):
            by_bin.setdefault(f[0] >> (old - shift), []).append(f)
        places = {}
        for key, cuts in open_.items():
            places |= _locate(by_bin[key], cuts[0][1], [t for t, _ in cuts])
        open_ = settle(places, lambda k, s=shift: (k << s, LOWEST), False)
    if open_:
        _split_groups(rows, open_, settle)
    return [done[t] for t in targets], total, count


def _split_groups(rows: DataFrame, open_: dict[int, list], settle) -> None:
    """Cut groups of equal checksum by id, again by counting below probes."""
    same = rows.filter(F.col("crc").isin(*open_))
    spans = {r[0]: (r[1], r[2]) for r in same.groupBy("crc").agg(F.min("id"), F.max("id")).collect()}
    # (checksum, lowest id) of each interval that still holds a cut -> its width and cuts
    work = {(c, spans[c][0]): (spans[c][1] - spans[c][0] + 1, cuts) for c, cuts in open_.items()}
    while work:
        steps = {k: max(1, -(-w // (1 << NEXT_BITS))) for k, (w, _) in work.items()}
        spark = rows.sparkSession
        probes = _local(spark, [(c, lo, lo + w - 1, steps[c, lo]) for (c, lo), (w, _) in work.items()], "c lo hi step")
        hit = same.join(F.broadcast(probes), (F.col("crc") == F.col("c")) & F.col("id").between(F.col("lo"), F.col("hi")))
        found: dict[tuple, list] = {}
        for c, lo, probe, b, n in _sums(hit, F.col("c"), F.col("lo"), F.expr("(id - lo) div step")):
            found.setdefault((c, lo), []).append((probe, b, n))
        nxt: dict[tuple, tuple] = {}
        for (c, lo), (_, cuts) in work.items():
            step = steps[c, lo]
            places = _locate(found[c, lo], cuts[0][1], [t for t, _ in cuts])
            for key, left in settle(places, lambda k, c=c, lo=lo, s=step: (c, lo + k * s), step == 1).items():
                nxt[c, lo + key * step] = (step, left)
        work = nxt


def _local(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A few numbers from the driver as a frame."""
    values = ", ".join("(" + ", ".join(f"{x}L" if x != LOWEST else "-9223372036854775807L - 1L" for x in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names.split())})")


def _numbers(values: list[int]) -> Column:
    """A constant array, parsed once when the plan is made."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def sharded(
    df: DataFrame,
    shards: int,
    id: str = "doc_id",  # noqa: A002
    text: str = "text",
    tolerance: float = 1e-3,
    part_bytes: int = 16 << 20,
    max_parts: int = 65_536,
) -> DataFrame:
    """Add ``size``, ``text_crc32``, ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    ``size`` is the text's UTF-8 bytes plus 8; the shards' sums of it differ by ``tolerance`` of a
    shard, or by half the row that lies on the border. A null text has no bytes, a null id sorts
    as 0. Rows that tie in text and id get neighbouring slots in any order. Every input column and
    row is kept (columns with an output's name are replaced); an empty table gives an empty one.
    """
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    number = F.coalesce(F.col(id).cast("long"), F.lit(0))
    keys = stored(df.select(crc.alias("crc"), number.alias("id"), size.alias("size")), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    per_shard = max(4, min(max_parts // shards, -(-total // (shards * part_bytes))))
    parts = shards * per_shard
    cuts, _, count = splitters(keys, parts, tolerance)
    cuts = cuts or [(1 << 32, LOWEST, 0)] * (parts - 1)
    # Cuts are looked up among those that share the key's first bits.
    shift = 32 - FIRST_BITS
    heads = [c[0] >> shift for c in cuts]
    first = [bisect_left(heads, b) for b in range((1 << FIRST_BITS) + 1)]
    b = F.shiftrightunsigned(F.col("text_crc32"), shift).cast("int") + 1
    lo = F.element_at(_numbers(first[:-1]), b)
    some = F.element_at(_numbers([y - x for x, y in zip(first, first[1:])]), b)
    pairs = F.zip_with(
        _numbers([c[0] for c in cuts]),
        _numbers([c[1] for c in cuts]),
        lambda c, d: F.struct(c.alias("crc"), d.alias("id")),
    )
    near = F.slice(pairs, (lo + 1).cast("int"), some.cast("int"))
    key = F.col("text_crc32")
    below = F.filter(near, lambda s: (s["crc"] < key) | ((s["crc"] == key) & (s["id"] <= number)))
    starts = [0, *(c[2] for c in cuts)]
    offsets = [n - starts[p - p % per_shard] for p, n in enumerate(starts)]
    out = {"size": size, "text_crc32": crc}
    part = free_name(df, "llm_part")
    df = df.withColumns(out).withColumn(part, (lo + F.size(below)).cast("int"))
    order = W.Window.partitionBy(part).orderBy("text_crc32", number)
    slot = F.element_at(_numbers(offsets), F.col(part) + 1) + F.row_number().over(order) - 1
    return df.withColumns({"slot": slot, "shard": F.expr(f"cast({part} div {per_shard} as int)")}).drop(part)
