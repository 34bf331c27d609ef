"""Measure names of the typed facts, where each comes from, and how its average is named."""

from __future__ import annotations

# --- fixed values: typed measure -> raw text columns, first known one wins --------
# Source letters: l log, t traditional, a advanced, f four factors, m misc, s scoring.

TEAM_CORE = {
    "points": ["l.pts", "t.points"],
    "fieldGoalsMade": ["l.fgm", "t.fieldgoalsmade"],
    "fieldGoalsAttempted": ["l.fga", "t.fieldgoalsattempted"],
    "fieldGoalsPercentage": ["l.fg_pct", "t.fieldgoalspercentage"],
    "threePointersMade": ["l.fg3m", "t.threepointersmade"],
    "threePointersAttempted": ["l.fg3a", "t.threepointersattempted"],
    "threePointersPercentage": ["l.fg3_pct", "t.threepointerspercentage"],
    "freeThrowsMade": ["l.ftm", "t.freethrowsmade"],
    "freeThrowsAttempted": ["l.fta", "t.freethrowsattempted"],
    "freeThrowsPercentage": ["l.ft_pct", "t.freethrowspercentage"],
    "reboundsOffensive": ["l.oreb", "t.reboundsoffensive"],
    "reboundsDefensive": ["l.dreb", "t.reboundsdefensive"],
    "reboundsTotal": ["l.reb", "t.reboundstotal"],
    "assists": ["l.ast", "t.assists"],
    "steals": ["l.stl", "t.steals"],
    "blocks": ["l.blk", "m.blocks", "t.blocks"],
    "turnovers": ["l.tov", "t.turnovers"],
    "foulsPersonal": ["l.pf", "m.foulspersonal", "t.foulspersonal"],
}
# Measures read from one endpoint under their own lower-case name.
ADVANCED = (
    "estimatedOffensiveRating offensiveRating estimatedDefensiveRating defensiveRating "
    "estimatedNetRating netRating assistPercentage assistToTurnover assistRatio "
    "offensiveReboundPercentage defensiveReboundPercentage reboundPercentage "
    "teamTurnoverPercentage effectiveFieldGoalPercentage trueShootingPercentage "
    "usagePercentage estimatedUsagePercentage estimatedPace pace pacePer40 possessions PIE"
).split()
FACTORS = (
    "freeThrowAttemptRate oppEffectiveFieldGoalPercentage oppFreeThrowAttemptRate "
    "oppTeamTurnoverPercentage oppOffensiveReboundPercentage"
).split()
MISC = (
    "pointsOffTurnovers pointsSecondChance pointsFastBreak pointsPaint oppPointsOffTurnovers "
    "oppPointsSecondChance oppPointsFastBreak oppPointsPaint blocksAgainst foulsDrawn"
).split()
SCORING = (
    "percentageFieldGoalsAttempted2pt percentageFieldGoalsAttempted3pt percentagePoints2pt "
    "percentagePointsMidrange2pt percentagePoints3pt percentagePointsFastBreak "
    "percentagePointsFreeThrow percentagePointsOffTurnovers percentagePointsPaint "
    "percentageAssisted2pt percentageUnassisted2pt percentageAssisted3pt "
    "percentageUnassisted3pt percentageAssistedFGM percentageUnassistedFGM"
).split()
# Advanced measures for which the four-factors table is asked first, or alone.
FACTORS_FIRST = ["offensiveReboundPercentage", "effectiveFieldGoalPercentage"]
FACTORS_ONLY = ["teamTurnoverPercentage"]

# Typed measure -> name of its season-to-date average, where it is not plain.
AVERAGE_NAMES = {
    "scoreDiff": "score_difference",
    "fieldGoalsPercentage": "field_goal_percentage",
    "freeThrowsPercentage": "free_throw_percentage",
    "reboundsOffensive": "offensive_rebounds",
    "reboundsDefensive": "defensive_rebounds",
    "reboundsTotal": "total_rebounds",
    "foulsPersonal": "personal_fouls",
    "assistToTurnover": "assist_to_turnover_ratio",
    "reboundPercentage": "total_rebound_percentage",
    "pacePer40": "pace_per_40_minutes",
    "PIE": "player_impact_estimate",
    "oppEffectiveFieldGoalPercentage": "opponent_effective_field_goal_percentage",
    "oppFreeThrowAttemptRate": "opponent_free_throw_attempt_rate",
    "oppOffensiveReboundPercentage": "opponent_offensive_rebound_percentage",
    "pointsSecondChance": "second_chance_points",
    "pointsFastBreak": "fast_break_points",
    "pointsPaint": "points_in_the_paint",
    "oppPointsOffTurnovers": "opponent_points_off_turnovers",
    "oppPointsSecondChance": "opponent_second_chance_points",
    "oppPointsFastBreak": "opponent_fast_break_points",
    "oppPointsPaint": "opponent_points_in_the_paint",
    "percentagePointsFastBreak": "percentage_points_from_fast_breaks",
    "percentagePointsFreeThrow": "percentage_points_from_free_throws",
    "percentageAssistedFGM": "percentage_assisted_field_goals_made",
    "percentageUnassistedFGM": "percentage_unassisted_field_goals_made",
}
TEAM_AVERAGE_NAMES = {
    "threePointersPercentage": "three_point_percentage",
    "oppTeamTurnoverPercentage": "opponent_turnover_percentage",
    "percentageFieldGoalsAttempted2pt": "percentage_field_goals_attempted_2pt",
    "percentageFieldGoalsAttempted3pt": "percentage_field_goals_attempted_3pt",
    "percentagePoints2pt": "percentage_points_from_2pt",
    "percentagePointsMidrange2pt": "percentage_points_from_midrange_2pt",
    "percentagePoints3pt": "percentage_points_from_3pt",
    "percentagePointsPaint": "percentage_points_in_paint",
    "percentageAssisted2pt": "percentage_assisted_2pt",
    "percentageUnassisted2pt": "percentage_unassisted_2pt",
    "percentageAssisted3pt": "percentage_assisted_3pt",
    "percentageUnassisted3pt": "percentage_unassisted_3pt",
}
PLAYER_AVERAGE_NAMES = {
    "threePointersPercentage": "three_point_field_goal_percentage",
    "oppTeamTurnoverPercentage": "opponent_team_turnover_percentage",
    "percentageFieldGoalsAttempted2pt": "percentage_field_goals_attempted_two_point_field_goals",
    "percentageFieldGoalsAttempted3pt": "percentage_field_goals_attempted_three_point_field_goals",
    "percentagePoints2pt": "percentage_points_from_two_point_field_goals",
    "percentagePointsMidrange2pt": "percentage_points_from_midrange_two_point_field_goals",
    "percentagePoints3pt": "percentage_points_from_three_point_field_goals",
    "percentagePointsPaint": "percentage_points_in_the_paint",
    "percentageAssisted2pt": "percentage_assisted_two_point_field_goals",
    "percentageUnassisted2pt": "percentage_unassisted_two_point_field_goals",
    "percentageAssisted3pt": "percentage_assisted_three_point_field_goals",
    "percentageUnassisted3pt": "percentage_unassisted_three_point_field_goals",
}
# Measures the two wide averages leave out: only players have blocks against and fouls drawn.
TEAM_NOT_AVERAGED = ["blocksAgainst", "foulsDrawn"]

# Fantasy categories in ranking order: measure -> (short name, season-to-date average).
CATEGORIES = {
    "minutes": ("minutes", "average_minutes"),
    "points": ("points", "average_points"),
    "assists": ("assists", "average_assists"),
    "steals": ("steals", "average_steals"),
    "blocks": ("blocks", "average_blocks"),
    "reboundsTotal": ("rebounds", "average_total_rebounds"),
    "threePointersMade": ("threes", "average_three_pointers_made"),
    "doubleDouble": ("doubleDouble", "average_double_double_rate"),
    "effectiveFieldGoalPercentage": ("efgPct", "average_effective_field_goal_percentage"),
    "freeThrowsPercentage": ("ftPct", "average_free_throw_percentage"),
}
# Fantasy categories -> column of the last-ten averages.
LAST10_NAMES = {
    "minutes": "minutes_last10",
    "points": "points_last10",
    "assists": "assists_last10",
    "steals": "steals_last10",
    "blocks": "blocks_last10",
    "reboundsTotal": "rebounds_last10",
    "threePointersMade": "threePointersMade_last10",
    "doubleDouble": "doubleDouble_rate_last10",
    "effectiveFieldGoalPercentage": "effectiveFieldGoalPercentage_last10",
    "freeThrowsPercentage": "freeThrowsPercentage_last10",
}
# Weights of the pickup score over the (last three - season) differences.
PICKUP_WEIGHTS = {
    "minutes_delta": 0.40,
    "points_delta": 0.30,
    "assists_delta": 0.15,
    "rebounds_delta": 0.10,
    "steals_delta": 0.05,
    "blocks_delta": 0.05,
}

# ----------------------------------------------------------------------------------

_ENDPOINT = {"a": ADVANCED, "f": FACTORS, "m": MISC, "s": SCORING}


def _single(col: str, letter: str) -> list[str]:
    raw = col.lower()
    if col in FACTORS_ONLY:
        return [f"f.{raw}"]
    return [f"f.{raw}", f"a.{raw}"] if col in FACTORS_FIRST else [f"{letter}.{raw}"]


ENDPOINT_MEASURES = {c: _single(c, letter) for letter, cols in _ENDPOINT.items() for c in cols}
TEAM_MEASURES = {
    **TEAM_CORE,
    **ENDPOINT_MEASURES,
    "estimatedTeamTurnoverPercentage": ["a.estimatedteamturnoverpercentage"],
}
# Players have no log columns; blocks and fouls come from misc before traditional.
PLAYER_CORE = {
    **{c: [s for s in sources if not s.startswith("l.")] for c, sources in TEAM_CORE.items()},
    "plusMinusPoints": ["t.plusminuspoints"],
}
PLAYER_MEASURES = {**PLAYER_CORE, **ENDPOINT_MEASURES}

TEAM_OUTPUT = [c for c in TEAM_MEASURES if c not in ("points", "estimatedTeamTurnoverPercentage")]
PLAYER_OUTPUT = list(PLAYER_MEASURES)


def _snake(name: str) -> str:
    return "".join(f"_{x.lower()}" if x.isupper() else x for x in name)


def average_name(measure: str, team: bool) -> str:
    special = {**AVERAGE_NAMES, **(TEAM_AVERAGE_NAMES if team else PLAYER_AVERAGE_NAMES)}
    return f"average_{special.get(measure, _snake(measure))}"


TEAM_AVERAGED = ["points", "opponentPoints", "totalPoints", "scoreDiff"] + [
    c for c in TEAM_OUTPUT if c not in TEAM_NOT_AVERAGED
]
PLAYER_AVERAGED = ["minutes", *PLAYER_OUTPUT]
