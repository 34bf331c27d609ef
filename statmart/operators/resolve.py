"""Name matching across sources: exact on normalised names, then closest by similarity.

No pair is formed that cannot reach the wanted score. Both scores tolerate few edits
near the threshold, so if a name is cut into one more segment than the edits allowed,
some segment must occur unchanged, and hardly shifted, in the other name. Left names
emit their segments, right names emit the substrings that could equal one, and an
equality join finds the candidates. The filter is lossless: it never drops a pair
that would have been accepted.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from statmart.functions.casts import col_of
from statmart.functions.text import normalize_name, normalize_name_basic
from statmart.session import materialise

from .closest import EPS, closest, edit_score
from .series import latest_per


def _ratio_udf():
    # A local function travels to the workers whole, so they need no copy of this package.
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        matcher, last, out = SequenceMatcher(), None, []
        for x, y in zip(a, b):
            if x is None or y is None:
                out.append(None)
                continue
            if y != last:
                matcher.set_seq2(y)
                last = y
            matcher.set_seq1(x)
            out.append(matcher.ratio())
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(ratio, T.DoubleType())


def similarity(a: str | Column, b: str | Column) -> Column:
    """Ratcliff-Obershelp ratio; not symmetric, ``a`` is the query and ``b`` the candidate."""
    return _ratio_udf()(col_of(a), col_of(b))


@dataclass(frozen=True)
class Metric:
    """A score with the bounds that make candidate search lossless, as SQL text.

    ``shortest``: least length of one name over the other's at score ``t``.
    ``edits``: most edits two names of lengths la, lb can differ by at ``t``.
    ``worst``: the same for a name of length la against any admissible partner.
    """

    name: str
    shortest: str
    edits: str
    worst: str
    lowest: float

    def score(self, a: str, b: str) -> Column:
        return similarity(a, b) if self.name == "ratio" else edit_score(a, b)


# ratio = 2M/(la+lb) with M matched letters, so la + lb - 2M letters are added or removed.
RATIO = Metric("ratio", "{t} / (2 - {t})", "(1 - {t}) * (la + {lb})", "(1 - {t}) * 2 * {la} / {t}", 2 / 3)
EDIT = Metric("edit", "{t}", "(1 - {t}) * greatest(la, {lb})", "(1 - {t}) * {la} / {t}", 0.5)


def _segment_keys(names: DataFrame, c: str, t: float, m: Metric) -> DataFrame:
    """Each name with its (length, position, segment) keys."""
    la = f"length({c})"
    parts = f"CAST(floor({m.worst.format(t=t, la=la)} + {EPS}) AS INT) + 1"
    start = f"CAST(floor(i * {la} / ({parts})) AS INT)"
    end = f"CAST(floor((i + 1) * {la} / ({parts})) AS INT)"
    keys = f"""transform(sequence(0, {parts} - 1), i -> named_struct(
        'la', {la}, 'i', i, 'seg', substr({c}, {start} + 1, {end} - {start})))"""
    return names.filter(F.length(c) > 0).select(c, F.explode(F.expr(keys)).alias("k")).select(c, "k.*")


def _substring_keys(names: DataFrame, c: str, t: float, m: Metric) -> DataFrame:
    """Each name with every key a partner's segment could equal."""
    lb = f"length({c})"
    share = m.shortest.format(t=t)
    low = f"CAST(ceil({lb} * ({share}) - {EPS}) AS INT)"
    high = f"CAST(floor({lb} / ({share}) + {EPS}) AS INT)"
    edits = f"CAST(floor({m.edits.format(t=t, lb=lb)} + {EPS}) AS INT)"
    parts = f"(CAST(floor({m.worst.format(t=t, la='la')} + {EPS}) AS INT) + 1)"
    start = f"CAST(floor(i * la / {parts}) AS INT)"
    end = f"CAST(floor((i + 1) * la / {parts}) AS INT)"
    keys = f"""array_distinct(flatten(transform(sequence(greatest(1, {low}), {high}), la ->
        flatten(transform(sequence(0, {parts} - 1), i ->
            transform(
                filter(sequence(-{edits}, {edits}),
                       s -> {start} + s >= 0 AND {end} + s <= {lb}),
                s -> named_struct('la', la, 'i', i,
                                  'seg', substr({c}, {start} + s + 1, {end} - {start}))))))))"""
    return names.filter(F.length(c) > 0).select(c, F.explode(F.expr(keys)).alias("k")).select(c, "k.*")


# Any fixed order keeps the letter filter lossless; rare letters first makes it selective.
_RARITY = "zqxjkvbpygfwmucldrhsnioate "


def _letter_keys(names: DataFrame, c: str, t: float) -> DataFrame:
    """Rarest numbered letters of each name; two names at ratio ``t`` share one.

    At ratio ``t`` a name keeps at least ``t/(2-t)`` of its letters, so of its sorted
    letters the first (length - kept + 1) must meet those of the partner.
    """
    n = f"length({c})"
    kept = f"CAST(ceil({n} * {t / (2 - t)!r} - {EPS}) AS INT)"
    letters = f"""flatten(transform(array_distinct(split({c}, '')), x ->
        transform(sequence(1, {n} - length(replace({c}, x, ''))), k ->
            named_struct('k', -k, 'r', instr('{_RARITY}', x), 'x', x))))"""
    prefix = f"slice(sort_array({letters}), 1, least({n}, {n} - {kept} + 1))"
    return names.filter(F.length(c) > 0).select(c, F.explode(F.expr(prefix)).alias("key"))


def candidates(left: DataFrame, right: DataFrame, l: str, r: str, t: float, m: Metric = RATIO) -> DataFrame:
    """Distinct (left name, right name) pairs that may score ``t`` or more.

    ``left`` and ``right`` hold distinct names. A frequent segment only makes one join
    key heavy, which adaptive execution splits.
    """
    if t > m.lowest:
        pairs = _segment_keys(left, l, t, m).join(_substring_keys(right, r, t, m), ["la", "i", "seg"])
    elif m.name == "ratio":
        pairs = _letter_keys(left, l, t).join(_letter_keys(right, r, t), "key")
    else:
        raise ValueError(f"edit score needs a threshold above {m.lowest}")
    shorter = F.least(F.length(l), F.length(r))
    longer = F.greatest(F.length(l), F.length(r))
    share = F.expr(m.shortest.format(t=t))
    return pairs.select(l, r).filter(shorter >= longer * share - EPS).distinct()


def best_candidates(left: DataFrame, right: DataFrame, t: float, m: Metric) -> DataFrame:
    """Best-scoring right name per left name at ``t`` or above; ties to the smallest right id.

    ``left``: ``norm``; ``right``: ``r_norm``, ``right_id``, ``right_name``.
    """
    pairs = candidates(left, right.select("r_norm"), "norm", "r_norm", t, m)
    scored = pairs.withColumn("score", m.score("norm", "r_norm")).filter(F.col("score") >= t - EPS)
    named = scored.join(right, "r_norm")
    best = F.min(F.struct((-F.col("score")).alias("s"), "right_id", "right_name"))
    return named.groupBy("norm").agg(best.alias("b")).select(
        "norm", (-F.col("b.s")).alias("score"), "b.right_id", "b.right_name"
    )


def _down_to(open_names: DataFrame, rights: DataFrame, min_score: float, floor: float, m: Metric) -> DataFrame:
    """The best right name of each name by falling thresholds; only what one leaves open meets the next."""
    rounds = [min_score] + [t for t in (0.75,) if floor < t < min_score]
    rounds += [floor] if floor < rounds[-1] else []
    found = None
    for i, t in enumerate(rounds):
        best = best_candidates(open_names, rights, t, m)
        if i + 1 < len(rounds):
            best = materialise(best, "name-round")
            open_names = open_names.join(best.select("norm"), "norm", "left_anti")
        found = best if found is None else found.unionByName(best)
    return found


def fuzzy_match(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    left_name: str,
    right_id: str,
    right_name: str,
    min_score: float = 0.92,
    metric: Metric = RATIO,
    score_floor: float | None = None,
) -> DataFrame:
    """One row per left row: exact on the normalised name, else the best at ``min_score`` or above.

    Every unmatched row carries its best score. With the edit score it comes from
    :func:`closest.closest`; a ``score_floor`` leaves out scores below it and takes equal segments.
    The ratio has no bound that falls with every probe, so it forms candidate pairs down
    to ``score_floor``: by default 0.0, which looks at every pair with a letter in common.
    """
    lefts = materialise(
        left.select(F.col(left_id).alias("left_id"), F.col(left_name).alias("left_name"), normalize_name(left_name).alias("norm")),
        "match-left",
    )
    first = F.min(F.struct(F.col(right_id).alias("i"), F.col(right_name).alias("n"))).alias("f")
    # Rows are normalised once; every round reads the distinct names.
    rights = materialise(
        right.groupBy(normalize_name(right_name).alias("r_norm")).agg(first)
        .select("r_norm", F.col("f.i").alias("right_id"), F.col("f.n").alias("right_name")),
        "match-right",
    )
    names = materialise(lefts.select("norm").distinct(), "match-names")
    exact = names.join(rights, names["norm"] == rights["r_norm"]).select(
        "norm", F.lit(1.0).alias("score"), "right_id", "right_name"
    )
    open_names = names.join(rights.select(F.col("r_norm").alias("norm")), "norm", "left_anti")

    if score_floor is None and metric.name == "edit":
        # Equal segments would be quadratic where names share words; pieces are cut by how few names hold them.
        found, floor = closest(open_names, rights, min_score).select("norm", "score", "right_id", "right_name"), 0.0
    else:
        floor = score_floor or 0.0
        found = _down_to(open_names, rights, min_score, floor, metric)

    accepted = F.col("score") >= F.lit(min_score) - EPS
    hits = exact.withColumn("match_type", F.lit("exact_norm")).unionByName(
        found.withColumn("match_type", F.when(accepted, "fuzzy_norm").otherwise("unmatched"))
    )
    taken = F.col("match_type") != "unmatched"
    missing = F.lit(0.0) if floor <= 0 else F.lit(None).cast("double")
    return lefts.join(hits, "norm", "left").select(
        "left_id",
        F.when(taken, F.col("right_id")).alias("right_id"),
        F.coalesce("match_type", F.lit("unmatched")).alias("match_type"),
        F.coalesce("score", missing).alias("match_score"),
        "left_name",
        F.when(taken, F.col("right_name")).alias("right_name"),
    )


def with_review_flag(df: DataFrame, review_below: float = 0.92) -> DataFrame:
    """Mark accepted fuzzy matches that score below ``review_below``."""
    unsure = (F.col("match_type") == "fuzzy_norm") & (F.col("match_score") < review_below)
    return df.withColumn("needs_review", F.coalesce(unsure, F.lit(False)))


def name_index(df: DataFrame, ident: str, name: Column, total: str, carry: list[str] = ()) -> DataFrame:
    """Best id per normalised name: the highest total, NULL totals last, then the smallest id."""
    rows = df.select(
        F.col(ident).cast("string").alias("personid"), name.alias("name"),
        normalize_name_basic(name).alias("name_norm"), F.col(total).alias("total"), *carry,
    )
    per_person = latest_per(rows, ["personid"], ["total"], ["name"])
    return latest_per(per_person, ["name_norm"], ["total"], ["personid"])


def search_candidates(index: DataFrame, queries: list[str], k: int = 7) -> DataFrame:
    """The ``k`` closest names for each query string the caller typed.

    Names are shortlisted with the candidate as first argument of the ratio (later
    names win ties) and then ordered with the query first. Every name is scored where
    it lies; only ``k`` rows per query leave a task.
    """
    literal = F.array(*[F.lit(q) for q in dict.fromkeys(queries)])
    asked = index.select("*", F.explode(literal).alias("query")).withColumn(
        "query_norm", normalize_name_basic("query")
    )
    shortlisted = asked.withColumn("short_score", similarity("name_norm", "query_norm"))
    short = latest_per(shortlisted, ["query"], ["short_score", "name_norm"], k=k)
    scored = short.withColumn("score", similarity("query_norm", "name_norm"))
    place = W.partitionBy("query").orderBy(
        F.col("score").desc(), F.col("short_score").desc(), F.col("name_norm").desc()
    )
    return scored.withColumn("pos", F.row_number().over(place).cast("bigint"))
