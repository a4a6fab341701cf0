"""Column names of the player-totals records."""

# The fields of a scraped record, in page order.
RAW_COLUMNS = [
    "season_year", "player", "player_url", "age", "team_name_abbr", "pos", "games", "games_started", "mp",
    "fg", "fga", "fg_pct", "fg3", "fg3a", "fg3_pct", "fg2", "fg2a", "fg2_pct", "efg_pct",
    "ft", "fta", "ft_pct", "orb", "drb", "trb", "ast", "stl", "blk", "tov", "pf", "pts",
]

# Names to standardise.
RENAMES = {"games": "g", "games_started": "gs", "team_name_abbr": "team_id"}

# Counting columns, where a missing value means zero.
COUNTING = [
    "g", "gs", "mp", "fg", "fga", "fg3", "fg3a", "fg2", "fg2a", "ft", "fta",
    "orb", "drb", "trb", "ast", "stl", "blk", "tov", "pf", "pts",
]

# Other numeric columns; a missing one stays missing.
RATES = ["age", "fg_pct", "fg3_pct", "fg2_pct", "efg_pct", "ft_pct"]

TOTAL_TEAM = "TOT"
