"""The chain of player tables on one layout, with the rows of plain left joins; the newest versions of a stream."""

from pyspark.sql import functions as F

from statmart.operators.joins import combine_chain, link_columns


def _frames(spark):
    log = spark.createDataFrame([("1", "A"), ("1", "B"), ("2", "A"), ("x", "A"), ("3", None), ("1", "A")], "game_id string, team string")
    t = spark.createDataFrame(
        [("1", "10", "A", 1), ("1", "11", "A", 2), ("1", "12", "B", 3), ("1", None, "B", 4), ("1", "n/a", "B", 5), ("2", "10", "A", 6), (None, "10", "A", 7), ("1", "10", "A", 8)],
        "gameid string, personid string, team string, v int",
    )
    side = lambda rows: spark.createDataFrame(rows, "gameid string, personid string, v int")
    a = side([("1", "10", 1), ("1", "12", 2), ("01", "10", 3), ("1", None, 4)])
    f = side([("1", "10", 1), ("1", "11", 2), ("2", "10", 3), ("1", "12.0", 4)])
    return log, [("t", t), ("a", a), ("f", f)]


def _chain(spark, **kw):
    log, tables = _frames(spark)
    firsts = ({"game": F.expr("try_cast(game_id AS bigint)"), "team": F.col("team")}, {"game": F.expr("try_cast(t_gameid AS bigint)"), "team": F.col("t_team")})
    links = {"game": "gameid", "person": "personid"}
    return combine_chain(log, tables, firsts, links, **kw), link_columns(tables, links)


def test_chain_equals_plain_left_joins(spark):
    log, tables = _frames(spark)
    log.createOrReplaceTempView("chain_log")
    for name, df in tables:
        df.createOrReplaceTempView(f"chain_{name}")
    on = lambda p, n: " AND ".join(f"CAST(try_cast({p}.{c} AS decimal(38, 4)) AS bigint) = CAST(try_cast({n}.{c} AS decimal(38, 4)) AS bigint)" for c in ("gameid", "personid"))
    want = spark.sql(
        f"""SELECT l.game_id, l.team, t.gameid, t.personid, t.team, t.v, a.gameid, a.personid, a.v, f.gameid, f.personid, f.v FROM chain_log l
        LEFT JOIN chain_t t ON try_cast(l.game_id AS bigint) = try_cast(t.gameid AS bigint) AND l.team = t.team
        LEFT JOIN chain_a a ON {on('t', 'a')} LEFT JOIN chain_f f ON {on('a', 'f')}"""
    )
    key = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert key(_chain(spark)[0].collect()) == key(want.collect())


def test_chain_is_dealt_out_once(spark):
    """One exchange for the growing row and one for each later table; a distinct over the rows adds none."""
    wide, laid = _chain(spark, keep_links=True)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = wide.distinct().drop(*laid)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    by_link = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "__person" in x.split("hashpartitioning(")[1]]
    assert len(by_link) == 3 and not any("game_id" in x for x in by_link)


def test_newest_versions_are_kept_without_python(spark, tmp_path):
    """The stream's state is an aggregation of Spark, not a Python call for each key of each batch."""
    from statmart.streaming.ingest import latest_versions

    arriving = spark.readStream.schema("id string, version string, v string").option("header", True).csv(str(tmp_path))
    plan = latest_versions(arriving, ["id"], "version")._jdf.queryExecution().analyzed().toString()
    assert "Pandas" not in plan and "Aggregate" in plan


def _player_tables(spark):
    from statmart.sources.schemas import ENDPOINTS, raw_columns

    def rows(endpoint, *given):
        names = raw_columns(endpoint, False)
        return spark.createDataFrame([tuple(g.get(c) for c in names) for g in given], ", ".join(f"`{c}` string" for c in names))

    one = {"gameid": "1", "personid": "10", "teamtricode": "A", "firstname": "F", "familyname": "L", "points": "5", "minutes": "9:00"}
    two, alone = {**one, "personid": "11"}, {**one, "personid": "n/a"}
    given = {e: [{**one, "pace": "1"}, two] for e in ENDPOINTS}
    # Twins, and rows that differ only in a measure, in a text, or in which of two measures is missing.
    given["traditional"] = [one, one, {**one, "assists": "7"}, {**one, "position": "G"}, two, alone, {**alone, "comment": "x"}]
    given["scoring"] = [{**one, "percentagepoints2pt": "1"}, {**one, "percentagepoints3pt": "1"}, {**one, "percentagepoints3pt": "n/a"}, one]
    given["misc"] = [{**one, "firstname": None, "foulsdrawn": "0"}, {**one, "foulsdrawn": "-0.0"}]
    log = spark.createDataFrame(
        [("22024", "1001", "A", "Team", "1", "2024-01-01", "A vs. B", "W"), ("22024", "1001", "A", "Team", "2", "2024-01-02", "A vs. B", None)] * 2,
        "season_id string, team_id string, team_abbreviation string, team_name string, game_id string, game_date string, matchup string, wl string",
    )
    return log, {e: rows(e, *g) for e, g in given.items()}


def test_chosen_columns_keep_the_rows_of_the_whole_facts(spark):
    from statmart.plans import combined as cb
    from statmart.plans import fantasy as fa

    log, tables = _player_tables(spark)
    key = lambda df: sorted(map(repr, map(tuple, df.collect())))
    whole = cb.players_combined(log, tables)
    assert whole.count() > whole.select(*fa.BASE_INPUT).distinct().count()
    for columns in (fa.BASE_INPUT, ["personId", "position"]):
        assert key(cb.players_combined(log, tables, columns)) == key(whole.select(*columns))


def test_columns_left_out_are_not_dealt_out(spark):
    """What the base statistics do not read goes through no exchange: only a hash of it."""
    from statmart.plans import combined as cb
    from statmart.plans import fantasy as fa

    log, tables = _player_tables(spark)
    narrow = cb.players_combined(log, tables, fa.BASE_INPUT)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = narrow._jdf.queryExecution().sparkPlan()
        joins = [x for x in plan.toString().splitlines() if "HashAggregate(keys=[" in x and "points" in x]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert joins and all("__rest" in x and "pace" not in x and "turnovers" not in x for x in joins)


def test_wide_typing_runs_in_methods_that_the_jvm_compiles(spark):
    """A session without a limit on the size of fused methods gets one with the facts; its own is kept. Rows do not depend on it."""
    from statmart.plans import combined as cb
    from statmart.session import METHOD_LIMIT

    session = spark.newSession()
    session.conf.unset(METHOD_LIMIT)
    log, tables = _player_tables(session)
    key = lambda df: sorted(map(repr, map(tuple, df.collect())))
    split = key(cb.players_combined(log, tables))
    assert session.conf.get(METHOD_LIMIT) == "8000"
    session.conf.set(METHOD_LIMIT, "65535")
    assert key(cb.players_combined(log, tables)) == split and session.conf.get(METHOD_LIMIT) == "65535"
