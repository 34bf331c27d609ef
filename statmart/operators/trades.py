"""Trade value, trade evaluation and balanced-trade search over small rosters.

The open pool has as many players as its caller asks for (20), and a roster is a list
of ids that its caller names, so either fits one array and combinations come from
exploding it: n * (n - 1) / 2 pairs a side, each met with each of the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.functions.casts import at_least, first_existing
from statmart.functions.scoring import weighted_score


def add_trade_value(df: DataFrame, season_weight: float = 0.6, last10_weight: float = 0.4) -> DataFrame:
    """Blend of season and last-ten totals, unknown if either is."""
    score = weighted_score({"totalz": season_weight, "last_10_z": last10_weight})
    return df.withColumn("trade_value", score)


def _player() -> Column:
    """Array entry; sorts by season total descending, unknown last, then id."""
    return F.struct(
        F.coalesce(-F.col("totalz"), F.lit(float("inf"))).alias("sort_key"),
        F.col("personid").cast("string").alias("id"),
        F.concat_ws(" ", "firstname", "familyname").alias("name"),
        F.col("trade_value").alias("value"),
    )


def _listed(ids: list) -> Column:
    return F.col("personid").cast("string").isin([str(i) for i in ids])


def _disjoint(cols: list[str]) -> Column:
    return F.size(F.array_distinct(F.array(*[F.col(f"{c}.id") for c in cols]))) == len(cols)


def suggest_2for2(df: DataFrame, max_players: int = 20, top_n: int = 15) -> DataFrame:
    """Most balanced 2-for-2 swaps within the ``max_players`` most valuable players.

    Each swap appears in both directions.
    """
    order = [F.col("trade_value").desc_nulls_last(), F.col("personid").cast("string")]
    pool = df.orderBy(*order).limit(max_players)
    entry = F.struct(
        F.coalesce(-F.col("trade_value"), F.lit(float("inf"))).alias("sort_key"),
        F.col("personid").cast("string").alias("id"),
        F.concat_ws(" ", "firstname", "familyname").alias("name"),
        F.col("trade_value").alias("value"),
    )
    whole = pool.agg(F.array_sort(F.collect_list(entry)).alias("pool"))
    firsts = whole.select("pool", F.posexplode("pool").alias("i", "a1"))
    pairs = firsts.select("pool", "i", "a1", F.posexplode("pool").alias("j", "a2")).filter("i < j")
    # One row per pair so far: spread them before the second pair multiplies the rows.
    spread = pairs.repartition("i", "j")
    third = spread.select("pool", "a1", "a2", F.posexplode("pool").alias("k", "b1"))
    fourth = third.select("a1", "a2", "k", "b1", F.posexplode("pool").alias("l", "b2"))
    swaps = fourth.filter("k < l").filter(_disjoint(["a1", "a2", "b1", "b2"]))
    a_value = F.col("a1.value") + F.col("a2.value")
    b_value = F.col("b1.value") + F.col("b2.value")
    out = swaps.select(
        F.concat_ws(", ", "a1.name", "a2.name").alias("side_a"),
        F.concat_ws(", ", "b1.name", "b2.name").alias("side_b"),
        a_value.alias("side_a_value"),
        b_value.alias("side_b_value"),
        F.abs(a_value - b_value).alias("abs_diff"),
    )
    return out.orderBy(F.col("abs_diff").asc_nulls_last(), "side_a", "side_b").limit(top_n)


def suggest_trades(
    df: DataFrame,
    mine: list,
    theirs: list,
    mode: str = "both",
    types: tuple[str, ...] = ("1for1", "2for2"),
    top_n: int = 15,
    cap: int | None = None,
    min_minutes_z: float | None = None,
) -> DataFrame:
    """Ranked trades between two rosters; fails at run time if a side has no known player.

    Every listed player takes part; ``cap`` keeps the first so many of each list, if wanted.
    """
    minutes = first_existing(df, ["minuteszscore"])
    if min_minutes_z is not None and minutes:
        df = df.filter(at_least(minutes, min_minutes_z))
    my_ids, their_ids = list(mine)[:cap], list(theirs)[:cap]
    both = df.filter(_listed([*my_ids, *their_ids])).agg(
        F.array_sort(F.collect_list(F.when(_listed(my_ids), _player()))).alias("mine"),
        F.array_sort(F.collect_list(F.when(_listed(their_ids), _player()))).alias("theirs"),
    )
    for side, label in (("mine", "Your"), ("theirs", "Their")):
        stop = F.raise_error(F.lit(f"{label} roster has no matching player."))
        both = both.withColumn(side, F.when(F.size(side) == 0, stop).otherwise(F.col(side)))

    parts = []
    if "1for1" in types:
        parts.append(
            both.select("theirs", F.explode("mine").alias("a1"))
            .select("a1", F.explode("theirs").alias("b1"))
            .transform(_trade, "1for1", ["a1"], ["b1"])
        )
    if "2for2" in types:
        a = both.select("mine", "theirs", F.posexplode("mine").alias("i", "a1"))
        a = a.select("theirs", "i", "a1", F.posexplode("mine").alias("j", "a2")).filter("i < j")
        b = a.select("theirs", "a1", "a2", F.posexplode("theirs").alias("k", "b1"))
        b = b.select("a1", "a2", "k", "b1", F.posexplode("theirs").alias("l", "b2")).filter("k < l")
        parts.append(b.transform(_trade, "2for2", ["a1", "a2"], ["b1", "b2"]))
    trades = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rank_trades(trades, mode, top_n)


def _trade(df: DataFrame, kind: str, send: list[str], get: list[str]) -> DataFrame:
    def value(side: list[str]) -> Column:
        return sum((F.col(f"{c}.value") for c in side[1:]), F.col(f"{side[0]}.value"))

    return df.select(
        F.lit(kind).alias("type"),
        F.concat_ws(", ", *[f"{c}.name" for c in send]).alias("i_send"),
        F.concat_ws(", ", *[f"{c}.name" for c in get]).alias("i_get"),
        value(send).alias("my_value_out"),
        value(get).alias("their_value_out"),
        (value(get) - value(send)).alias("net_for_me"),
        F.abs(value(get) - value(send)).alias("abs_diff"),
    )


def rank_trades(df: DataFrame, mode: str, n: int) -> DataFrame:
    """Closest trades first; ``win_for_me`` puts the greatest gain first instead."""
    close = F.col("abs_diff").asc_nulls_last()
    gain = F.col("net_for_me").desc_nulls_last()
    order = [gain, close] if mode == "win_for_me" else [close, gain]
    return df.orderBy(*order, "i_send", "i_get").limit(n)


def evaluate_trade(df: DataFrame, side_a: list, side_b: list) -> DataFrame:
    """What each side gives, gets and gains: one row per side, unknown values count 0."""
    def totals(ids: list, p: str) -> list[Column]:
        mine = _listed(ids)
        sums = [
            F.coalesce(F.sum(F.when(mine, F.col(c))), F.lit(0.0)).alias(f"{p}_{c}")
            for c in ("totalz", "last_10_z", "trade_value")
        ]
        names = F.array_sort(F.collect_list(F.when(mine, _player())))
        return [F.transform(names, lambda x: x["name"]).alias(f"{p}_players"), *sums]

    both = df.filter(_listed([*side_a, *side_b])).agg(*totals(side_a, "a"), *totals(side_b, "b"))
    fields = ["players", "totalz", "last_10_z", "trade_value"]

    def side(label: str, give: str, get: str) -> Column:
        return F.struct(
            F.lit(label).alias("side"),
            *[F.col(f"{give}_{f}").alias(f"gives_{f}") for f in fields],
            *[F.col(f"{get}_{f}").alias(f"gets_{f}") for f in fields],
            (F.col(f"{get}_trade_value") - F.col(f"{give}_trade_value")).alias("net_trade_value"),
        )

    rows = F.array(side("side_a", "a", "b"), side("side_b", "b", "a"))
    return both.select(F.explode(rows).alias("r")).select("r.*")


def player_z_with_last10(z_avg: DataFrame, avg_current: DataFrame, z_last: DataFrame) -> DataFrame:
    """Season z-scores with the last-ten total, best first, for players whose dates agree in all three.

    The join has no season key, as in the query it answers for; a player's dates
    determine the season.
    """
    last = z_last.select("personId", "gameDate", F.col("totalZ").alias("last_10_z"))
    dates = avg_current.select("personId", "gameDate")
    out = z_avg.join(dates, ["personId", "gameDate"]).join(last, ["personId", "gameDate"])
    return out.orderBy(F.col("totalZ").desc_nulls_last(), "personId")
