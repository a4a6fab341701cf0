"""Player season totals: names, duplicates, types, gaps, derived figures and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalar import per_unit, rounded_even
from tallyhouse.operators.ranking import top_k
from tallyhouse.session import fresh_path
from tallyhouse.sources.files import staged, write
from tallyhouse.sources.player_columns import COUNTING, RATES, RENAMES, TOTAL_TEAM

# Plausible ages, points per game, and percentage range.
AGE_RANGE = (18, 50)
MOST_POINTS = 50
PERCENT_RANGE = (0, 100)

# Per-game figures: source column and decimals.
PER_GAME = {"pts_per_game": ("pts", 2), "trb_per_game": ("trb", 2), "ast_per_game": ("ast", 2), "mp_per_game": ("mp", 1)}


def player_standardize(raw: DataFrame) -> DataFrame:
    """Standard column names; names that are absent are ignored."""
    return raw.withColumnsRenamed(RENAMES)


def duplicate_entities(players: DataFrame, key: str = "player") -> DataFrame:
    """Every row of a key that occurs more than once.

    Counted by aggregation and met by a semi-join, so that no task collects one key's rows.
    """
    repeated = players.groupBy(key).count().filter("count > 1").select(key)
    return players.join(repeated, key, "left_semi")


def player_dedupe(
    players: DataFrame, key: str = "player", team: str = "team_id", position: str = "source_pos"
) -> DataFrame:
    """One entry per player: all the total rows of a player who has any, else the first row.

    Total rows pass straight through. For the others the first row by ``position`` is an
    aggregate, taken inside each task before the shuffle, so a name shared by very many rows
    is no heavier than any other. Rows without a name are dropped.
    """
    named = players.filter(F.col(key).isNotNull())
    is_total = F.col(team).eqNullSafe(TOTAL_TEAM)
    row = F.struct(position, *[c for c in players.columns if c != position])
    firsts = (
        named.groupBy(F.col(key).alias("_player"))
        .agg(F.bool_or(is_total).alias("_has_total"), F.min_by(row, position).alias("_row"))
        .filter("not _has_total")
        .select("_row.*")
    )
    return named.filter(is_total).unionByName(firsts)


def player_types(players: DataFrame) -> DataFrame:
    """Numbers out of text; what is not a number becomes NULL."""
    numeric = [c for c in [*COUNTING, *RATES] if c in players.columns]
    casts = {c: F.col(c).try_cast("double") for c in numeric}
    if "season_year" in players.columns:
        casts["season_year"] = F.col("season_year").try_cast("int")
    return players.withColumns(casts)


def player_fill(players: DataFrame) -> DataFrame:
    """Zero for missing counts; ages and percentages stay missing."""
    return players.fillna(0, subset=[c for c in COUNTING if c in players.columns])


def player_derived(players: DataFrame) -> DataFrame:
    """Per-game figures and true shooting; zero games or attempts divide by one.

    Ties round to even here, as in the records' usual tooling.
    """
    have = set(players.columns)
    figures = {
        name: rounded_even(per_unit(source, "g"), places)
        for name, (source, places) in PER_GAME.items()
        if {source, "g"} <= have
    }
    if {"pts", "fga", "fta"} <= have:
        attempts = (F.col("fga") + F.col("fta") * 0.44) * 2
        figures["ts_pct"] = rounded_even(per_unit("pts", attempts) * 100, 1)
    return players.withColumns(figures)


def clean_players(raw: DataFrame) -> DataFrame:
    """All steps in order; duplicates are judged on the raw text, gaps filled before dividing."""
    return (
        raw.transform(player_standardize)
        .transform(player_dedupe)
        .transform(player_types)
        .transform(player_fill)
        .transform(player_derived)
    )


def quality_report(players: DataFrame) -> DataFrame:
    """Number of doubtful values per check and column, every check in one pass; zeros left out."""
    numeric = [f.name for f in players.schema if isinstance(f.dataType, T.NumericType)]
    checks: list[tuple[str, str, Column]] = [("negative", c, F.col(c) < 0) for c in numeric]
    if "age" in players.columns:
        checks.append(("age out of range", "age", ~F.col("age").between(*AGE_RANGE)))
    if "pts_per_game" in players.columns:
        checks.append(("too many points", "pts_per_game", F.col("pts_per_game") > MOST_POINTS))
    checks += [
        ("percentage out of range", c, ~F.col(c).between(*PERCENT_RANGE)) for c in numeric if "pct" in c
    ]
    counted = players.agg(*[F.count_if(test).alias(f"_{i}") for i, (_, _, test) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.lit(c).alias("column_name"), F.col(f"_{i}").alias("hits"))
            for i, (name, c, _) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows)).filter("hits > 0")


def top_scorers(players: DataFrame, above: float | None = 25, k: int = 10) -> DataFrame:
    """Best scorers per game, over a threshold if one is given."""
    rows = players if above is None else players.filter(F.col("pts_per_game") > above)
    best = top_k(rows, "pts_per_game", k, "source_pos")
    return best.select("player", "team_id", "pts_per_game", "trb_per_game", "ast_per_game", "g")


def player_run_summary(spark: SparkSession, raw: DataFrame, season: int, target: str | None = None) -> DataFrame:
    """Run extract, clean and load; one row saying how far it got and how many rows passed.

    The extracted records are landed once and the clean ones written; the counts are read from
    these two tables. A stage without rows ends the run.
    """
    landed = staged(raw, "player-records")
    path = target or fresh_path(spark, "player-totals")
    clean = clean_players(landed)
    write(clean, path, "parquet", "overwrite")
    stored = spark.read.schema(clean.schema).parquet(path)
    extracted = landed.agg(F.count("*")).scalar()
    loaded = F.col("loaded")
    status = (
        F.when(extracted == 0, "nothing extracted").when(loaded == 0, "nothing transformed").otherwise("success")
    )
    return stored.agg(F.count("*").alias("loaded")).select(
        F.lit(season).alias("season_year"),
        status.alias("status"),
        extracted.alias("extracted"),
        loaded.alias("transformed"),
        F.when(extracted == 0, 0).otherwise(len(clean.columns)).alias("column_count"),
        "loaded",
    )
