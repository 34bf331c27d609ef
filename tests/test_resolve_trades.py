"""Name matching against brute force, and the trade search on tiny rosters."""

import random
from difflib import SequenceMatcher, get_close_matches
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from statmart.operators import closest, resolve, trades
from statmart.plans import rosters

RIGHT = [
    "luka doncic", "lebron james", "jalen brunson", "jalen johnson", "jaylen brown", "jaylin brown", "nikola jokic", "nikola jovic",
    "shai gilgeous alexander", "tide", "diet", "ab", "a", "stephen curry", "seth curry", "stephon castle", "bam", "anthony davis",
    "anthony black", "keegan murray", "kris murray", "dejounte murray", "trey murphy", "ivica zubac", "jakob poeltl",
]
LEFT = [
    "Luka Dončić", "Lebron Jams", "Jalen Brunsen", "Jaylen Brow", "Nikola Jokc", "Shai Gilgeous-Alexandr", "tide", "teid", "b", "",
    "Stephn Curry", "zzzz", "Antony Davis Jr.", "Keegan Muray", "Trey Murphy III", "Ivica Zubacc", "xq", "Stephen Curry Jr", "JAKOB PÖLTL",
]


def brute(lefts, rights, score):
    out = {}
    for i, (norm, _) in enumerate(lefts):
        best = max(((score(norm, r), r) for r in rights), key=lambda t: t[0], default=None)
        out[i] = best
    return out


def frames(spark):
    left = spark.createDataFrame([(i, n) for i, n in enumerate(LEFT)], "lid int, lname string")
    right = spark.createDataFrame([(f"{i:03d}", n) for i, n in enumerate(RIGHT)], "rid string, rname string")
    return left, right


@pytest.mark.parametrize("floor,threshold", [(None, 0.92), (0.0, 0.92), (0.7, 0.85), (0.5, 0.8)])
def test_fuzzy_ratio_equals_brute_force(spark, floor, threshold):
    left, right = frames(spark)
    got = {r.left_id: r for r in resolve.fuzzy_match(left, right, "lid", "lname", "rid", "rname", threshold, score_floor=floor).collect()}
    norms = [r[0] for r in left.orderBy("lid").select(resolve.normalize_name("lname")).collect()]
    ids = {n: f"{i:03d}" for i, n in enumerate(RIGHT)}
    for i, norm in enumerate(norms):
        row = got[i]
        if norm in ids:
            assert (row.match_type, row.right_id, row.match_score) == ("exact_norm", ids[norm], 1.0)
            continue
        scores = {r: SequenceMatcher(a=norm, b=r).ratio() for r in RIGHT}
        best = max(scores.values())
        if best >= threshold:
            assert row.match_type == "fuzzy_norm" and row.match_score == pytest.approx(best)
            assert row.right_id == min(ids[r] for r, v in scores.items() if v == best)
        else:
            assert row.match_type == "unmatched" and row.right_id is None
            assert row.match_score == (pytest.approx(best) if best >= (floor or 0.0) else None)
    assert len(got) == len(LEFT)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, above = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(above[j] + (x != y), above[j + 1] + 1, row[-1] + 1))
    return row[-1]


def edit_of(a, b):
    return 1 - edits(a, b) / max(len(a), len(b), 1)


@pytest.mark.parametrize("strict,alphabet,seed", [(0.0, "abc", 1), (0.0, "abcdefghijklmnop", 2), (0.6, "abcdef", 3)])
def test_closest_equals_brute_force(spark, strict, alphabet, seed):
    """Best score of every name and, where ties matter, the least id; short, repeated and foreign letters included."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14)))
    rights = sorted({word() for _ in range(150)} | {"a", "aaaaaaaaaaaa", "ab"})
    lefts = sorted({word() for _ in range(120)} | {"", "z", "zzzz", "aaaa", "a" * 40, "ab"})
    left = spark.createDataFrame([(w,) for w in [*lefts, *lefts[:5], None]], "norm string")
    right = spark.createDataFrame([(w, f"{i:04d}", w.upper()) for i, w in enumerate(rights)], "r_norm string, right_id string, right_name string")
    got = {r.norm: r for r in closest.closest(left, right, strict).collect()}
    assert set(got) == set(lefts)
    for w in lefts:
        scores = [(-edit_of(w, r), f"{i:04d}", r.upper()) for i, r in enumerate(rights)]
        best = min(scores)
        assert got[w].score == pytest.approx(-best[0]), w
        if -best[0] >= strict and best[0] < 0:
            assert (got[w].right_id, got[w].right_name) == best[1:], w


def test_closest_of_nothing(spark):
    empty = spark.createDataFrame([], "r_norm string, right_id string, right_name string")
    one = spark.createDataFrame([("abc",)], "norm string")
    assert closest.closest(one, empty).collect()[0][:] == ("abc", 0.0, None, None)
    assert closest.closest(one.limit(0), empty).count() == 0


def test_matching_looks_at_few_pairs(spark, monkeypatch):
    """On varied names the pairs compared grow in proportion to the names, with every best score found."""
    rng = random.Random(9)
    syllables = [a + b for a in "bcdfghjklmnprstvz" for b in "aeiou"]
    name = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(3, 5))) + " " + "".join(rng.choice(syllables) for _ in range(4))
    pairs = []
    for module, one in ((closest, "_candidates"), (resolve, "candidates")):
        keep = getattr(module, one)
        monkeypatch.setattr(module, one, lambda *a, keep=keep: (pairs.append(keep(*a).count()), keep(*a))[1])
    seen = {}
    for n in (1000, 10_000):
        pairs.clear()
        rights = sorted({name() for _ in range(n)})
        lefts = [w[:i] + rng.choice("aeiou") + w[i + 1 :] for w in rights for i in [rng.randrange(len(w))]]
        right = spark.createDataFrame([(w,) for w in rights], "rid string").withColumn("rname", F.col("rid"))
        left = spark.createDataFrame(list(enumerate(lefts)), "lid int, lname string")
        found = resolve.fuzzy_match(left, right, "lid", "lname", "rid", "rname", 0.9, resolve.EDIT)
        assert found.count() == len(lefts) and found.filter("match_type = 'unmatched'").isEmpty()
        seen[n] = sum(pairs)
    assert seen[10_000] < 20 * 10_000 and seen[10_000] < 15 * seen[1000]


def test_names_with_shared_words_meet_few(spark, monkeypatch):
    """Words that every name has bring no pairs, also where the best score is far below the wanted one."""
    rng = random.Random(4)
    part = lambda n: "".join(rng.choice("abdefgilno") for _ in range(n))
    pairs = []
    for module, one in ((closest, "_candidates"), (resolve, "candidates")):
        keep = getattr(module, one)
        monkeypatch.setattr(module, one, lambda *a, keep=keep: (pairs.append(keep(*a).count()), keep(*a))[1])
    rights = sorted({f"pla{part(7)}ck fam{part(5)}" for _ in range(1500)})
    lefts = [f"guest {w}" if i % 5 == 0 else w[:-1] for i, w in enumerate(rights)]
    right = spark.createDataFrame([(w,) for w in rights], "rid string").withColumn("rname", F.col("rid"))
    left = spark.createDataFrame(list(enumerate(lefts)), "lid int, lname string")
    found = resolve.fuzzy_match(left, right, "lid", "lname", "rid", "rname", 0.85, resolve.EDIT)
    got = {r.left_id: (r.match_type, r.match_score) for r in found.select("left_id", "match_type", "match_score").collect()}
    for i in range(0, 1500, 50):
        best = max(edit_of(lefts[i], w) for w in rights)
        assert got[i] == ("fuzzy_norm" if best >= 0.85 else "unmatched", pytest.approx(best))
    assert sum(pairs) < 100 * len(lefts)


def test_names_without_a_counterpart_meet_few(spark, monkeypatch):
    """The best score of a name that no other resembles is found without comparing it with most of them."""
    rng = random.Random(6)
    part = lambda n: "".join(rng.choice("abdefgilno") for _ in range(n))
    pairs, keep = [], closest._candidates
    monkeypatch.setattr(closest, "_candidates", lambda *a: (pairs.append(keep(*a).count()), keep(*a))[1])
    rights = sorted({f"pla{part(7)}ck fam{part(5)}" for _ in range(2000)})
    lefts = sorted({f"guest pla{part(7)}ck fam{part(5)}" for _ in range(100)})
    right = spark.createDataFrame([(w, w, w) for w in rights], "r_norm string, right_id string, right_name string")
    found = closest.closest(spark.createDataFrame([(w,) for w in lefts], "norm string"), right, 0.85)
    got = {r.norm: r.score for r in found.select("norm", "score").collect()}
    assert set(got) == set(lefts)
    for w in lefts[::10]:
        assert got[w] == pytest.approx(max(edit_of(w, x) for x in rights)), w
    assert sum(pairs) < 20 * len(lefts)


@pytest.mark.parametrize("strict", [0.0, 0.7])
def test_closest_over_several_blocks(spark, monkeypatch, strict):
    """Blocks of few letters and chunks of few names give what one gives; names of any letters and lengths."""
    if hasattr(closest, "BLOCK"):
        monkeypatch.setattr(closest, "BLOCK", 150)
        monkeypatch.setattr(closest, "CHUNK", 20)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcé😀 ") for _ in range(rng.randint(0, 9)))
    rights = sorted({word() for _ in range(120)} | {"", "abcabcabcabcabcabcabc"})
    lefts = sorted({word() for _ in range(60)} | {"", "zz", "a" * 30})
    left = spark.createDataFrame([(w,) for w in lefts], "norm string")
    right = spark.createDataFrame([(w, len(rights) - i) for i, w in enumerate(rights)], "r_norm string, right_id long").withColumn("right_name", F.upper("r_norm"))
    got = {r.norm: r for r in closest.closest(left, right, strict).collect()}
    assert set(got) == set(lefts)
    for w in lefts:
        best = min((-edit_of(w, r), len(rights) - i) for i, r in enumerate(rights))
        assert got[w].score == pytest.approx(-best[0]), w
        if -best[0] >= strict and best[0] < 0:
            assert got[w].right_id == best[1], w


@pytest.mark.parametrize("threshold", [0.95, 0.85, 0.75, 0.6])
def test_candidates_lose_no_pair(spark, threshold):
    """Every pair at or above the threshold is among the candidates, in both metrics."""
    names = RIGHT + ["jalen brunsn", "jaylenn browm", "nikola", "stephen curri", "murray", "ddavis anthony", "tides", "abc", "lebronn jamess"]
    df = spark.createDataFrame([(n,) for n in names], "a string")
    other = df.withColumnRenamed("a", "b")
    got = {tuple(r) for r in resolve.candidates(df, other, "a", "b", threshold).collect()}
    want = {(a, b) for a in names for b in names if SequenceMatcher(a=a, b=b).ratio() >= threshold}
    assert want <= got
    assert len(got) < len(names) ** 2 or threshold <= 0.6
    edit = {tuple(r) for r in resolve.candidates(df, other, "a", "b", threshold, resolve.EDIT).collect()}
    lev = df.crossJoin(other).withColumn("s", resolve.edit_score("a", "b")).filter(F.col("s") >= threshold)
    assert {(r.a, r.b) for r in lev.collect()} <= edit


def test_ratio_is_asymmetric(spark):
    df = spark.createDataFrame([("tide", "diet")], "a string, b string")
    assert df.select(resolve.similarity("a", "b"), resolve.similarity("b", "a")).first()[:] == (0.25, 0.5)


def test_no_cross_join(spark):
    left, right = frames(spark)
    df = resolve.fuzzy_match(left, right, "lid", "lname", "rid", "rname")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_review_flag(spark, rows):
    df = spark.createDataFrame([("fuzzy_norm", 0.93), ("fuzzy_norm", 0.95), ("unmatched", None)], "match_type string, match_score double")
    assert not any(r[0] for r in resolve.with_review_flag(df).select("needs_review").collect())
    assert rows(resolve.with_review_flag(df, 0.94), "needs_review") == [(False,), (False,), (True,)]


def test_name_index_and_search(spark):
    people = [(1, "Ann", "Lee", 3.0), (2, "ann", "lee", 5.0), (3, "Bob", "Ray", None), (3, "Bob", "Ray", 1.0), (4, "Bo", "Ray", 0.0), (5, "Bo", "Ray", -1.0)]
    df = spark.createDataFrame(people, "id int, f string, l string, t double")
    index = resolve.name_index(df, "id", F.concat_ws(" ", "f", "l"), "t")
    assert {r.name_norm: (r.personid, r.total) for r in index.collect()} == {"ann lee": ("2", 5.0), "bob ray": ("3", 1.0), "bo ray": ("4", 0.0)}
    names = spark.createDataFrame([(n,) for n in RIGHT], "n string")
    wide = resolve.name_index(names.withColumn("id", F.xxhash64("n")).withColumn("t", F.lit(1.0)), "id", F.col("n"), "t")
    for query in ["jalen brow", "murry", "q"]:
        got = [r.name_norm for r in resolve.search_candidates(wide, [query], k=7).orderBy("pos").collect()]
        close = get_close_matches(query, RIGHT, n=7, cutoff=0.0)
        want = sorted(close, key=lambda n: SequenceMatcher(a=query, b=n).ratio(), reverse=True)
        assert got == want


def test_player_map(spark, rows):
    from datetime import date
    players = spark.createDataFrame(
        [(1, "Luka", "Doncic", date(2024, 1, 1), "a"), (1, "Luka", "Dončić", date(2024, 1, 2), "b"), (2, "Seth", "Curry", date(2024, 1, 1), "a"), (None, "X", "Y", None, "c")],
        "personId bigint, firstName string, familyName string, gameDate date, gameId string")
    roster = spark.createDataFrame([(10, "Luka Doncic"), (11, "Seth Cury"), (12, "Nobody Else"), (None, "Z")], "playerId bigint, name string")
    got = rosters.player_map(roster, players)
    assert rows(got, "espn_player_id", "personid", "match_type", "nba_name", "needs_review") == [
        ("10", "1", "exact_norm", "Luka Dončić", False), ("11", "2", "fuzzy_norm", "Seth Curry", False), ("12", None, "unmatched", None, False)]


PLAYERS = [(1, "A", "a", 4.0, 2.0, 0.0), (2, "B", "b", 3.0, 3.0, 0.0), (3, "C", "c", 2.0, 1.0, None), (4, "D", "d", 1.0, 1.0, -2.0)]
SCHEMA = "personid bigint, firstname string, familyname string, totalz double, last_10_z double, minuteszscore double"


def valued(spark, people=PLAYERS):
    return trades.add_trade_value(spark.createDataFrame(people, SCHEMA))


def test_pool_swaps_in_both_directions(spark):
    got = trades.suggest_2for2(valued(spark)).collect()
    value = {p[1] + " " + p[2]: 0.6 * p[3] + 0.4 * p[4] for p in PLAYERS}
    want = [(a, b) for a in combinations(value, 2) for b in combinations(value, 2) if not set(a) & set(b)]
    assert sorted((r.side_a, r.side_b) for r in got) == sorted((", ".join(a), ", ".join(b)) for a, b in want) and len(got) == 6
    diffs = [r.abs_diff for r in got]
    assert diffs == sorted(diffs)
    assert trades.suggest_2for2(valued(spark, PLAYERS[:3])).count() == 0


def test_roster_trades(spark):
    df = valued(spark)
    got = trades.suggest_trades(df, [1, 3], [2, 4], top_n=50).collect()
    assert len(got) == 5 and [r.type for r in got].count("2for2") == 1
    assert [r.abs_diff for r in got] == sorted(r.abs_diff for r in got)
    best = trades.suggest_trades(df, [1, 3], [2, 4], mode="win_for_me", types=("1for1",), top_n=1).first()
    assert (best.i_send, best.i_get) == ("C c", "B b")
    # unknown minutes count as -999, so C drops out too
    assert trades.suggest_trades(df, [1, 3], [2, 4], min_minutes_z=-0.5).count() == 1
    assert trades.suggest_trades(df, [1, 3], [2, 4], cap=1, types=("1for1",)).count() == 1
    with pytest.raises(Exception, match="Their roster"):
        trades.suggest_trades(df, [1], [99]).collect()


def test_evaluate(spark):
    a, b = trades.evaluate_trade(valued(spark), [1], [2, "4"]).orderBy("side").collect()
    assert a.gives_players == ["A a"] and a.gets_players == ["B b", "D d"]
    assert a.net_trade_value == pytest.approx(-b.net_trade_value) == pytest.approx(4.0 - 3.2)
    empty = trades.evaluate_trade(valued(spark), [1], [99]).orderBy("side").first()
    assert empty.gets_trade_value == 0.0 and empty.gets_players == []
