"""Player steps and page parsing on hand-made records."""

import time

import pytest

from tallyhouse.plans import players
from tallyhouse.sources.html_tables import page_rows, read_page, stats_records

COLUMNS = ["player", "team_name_abbr", "games", "age", "pts", "fga", "fta", "fg3_pct", "stl", "source_pos"]
ROWS = [
    ("A", "LAL", "10", "25", "205", "150", "50", "0.4", "3", 1),
    ("B", "TOT", "20", "30", "300", "200", "50", "0.3", "5", 2),
    ("B", "BOS", "12", "30", "200", "130", "30", "0.3", "3", 3),
    ("B", "NYK", "8", "30", "100", "70", "20", "0.3", "2", 4),
    ("C", "MIA", "5", "22", "50", "40", "10", "0.5", "1", 6),
    ("C", "CHI", "6", "22", "60", "50", "12", "0.5", "1", 5),
    ("D", "TOT", "7", "28", "70", "60", "10", "0.2", "2", 7),
    ("D", "TOT", "9", "33", "90", "80", "10", "0.2", "2", 8),
    ("E", "DEN", "0", "24", "0", "0", "0", "", "0", 9),
    ("F", "UTA", "4", "n/a", "", "10", "", "", "1", 10),
    ("G", "SAS", "2", "55", "120", "60", "20", "120", "-4", 11),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, ", ".join(f"{c} {'bigint' if c == 'source_pos' else 'string'}" for c in COLUMNS))


def test_standard_names_ignore_absent_columns(raw):
    assert players.player_standardize(raw).columns[:3] == ["player", "team_id", "g"]


def test_dedupe_rules(raw):
    kept = players.player_dedupe(players.player_standardize(raw))
    rows = {(r.player, r.team_id, r.source_pos) for r in kept.collect()}
    assert rows == {
        ("A", "LAL", 1), ("B", "TOT", 2), ("C", "CHI", 5), ("D", "TOT", 7), ("D", "TOT", 8),
        ("E", "DEN", 9), ("F", "UTA", 10), ("G", "SAS", 11),
    }


def test_duplicates_are_reported(raw):
    found = players.duplicate_entities(raw).groupBy("player").count().collect()
    assert {r.player: r["count"] for r in found} == {"B": 3, "C": 2, "D": 2}


def test_one_name_with_very_many_rows(spark):
    many = spark.range(200_000).selectExpr(
        "if(id % 3 = 0, 'Hot', concat('P', id % 500)) as player", "'X' as team_id", "id as source_pos"
    )
    kept = players.player_dedupe(many)
    assert kept.count() == 501
    assert kept.filter("player = 'Hot'").first().source_pos == 0


def test_types_fill_and_derived(raw):
    clean = {(r.player, r.source_pos): r for r in players.clean_players(raw).collect()}
    a, e, f = clean["A", 1], clean["E", 9], clean["F", 10]
    assert a.pts_per_game == 20.5
    assert a.ts_pct == round(205 / (2 * (150 + 0.44 * 50)) * 100, 1)
    assert (e.pts_per_game, e.ts_pct) == (0, 0)
    assert (f.age, f.fg3_pct, f.pts, f.fta) == (None, None, 0, 0)
    assert "trb_per_game" not in clean["A", 1].asDict()


def test_ties_round_to_even(spark):
    rows = spark.createDataFrame([(1.0, 8.0), (3.0, 8.0), (161.0, 8.0)], "pts double, g double")
    figures = {r.pts: r.pts_per_game for r in players.player_derived(rows).collect()}
    assert figures == {1.0: 0.12, 3.0: 0.38, 161.0: 20.12}


def test_quality_report(raw):
    found = {(r.check_name, r.column_name): r.hits for r in players.quality_report(players.clean_players(raw)).collect()}
    assert found == {
        ("negative", "stl"): 1,
        ("age out of range", "age"): 1,
        ("too many points", "pts_per_game"): 1,
        ("percentage out of range", "fg3_pct"): 1,
    }


def test_top_scorers(raw):
    clean = players.clean_players(raw.selectExpr("*", "'1' as trb", "'1' as ast"))
    assert [r.player for r in players.top_scorers(clean, 19).collect()] == ["G", "A"]
    assert players.top_scorers(clean, None, 5).count() == 5


def test_run_summary(spark, raw):
    full = raw.selectExpr("*", "2025 as season_year")
    done = players.player_run_summary(spark, full, 2025).first()
    assert (done.status, done.extracted, done.transformed, done.loaded) == ("success", 11, 8, 8)
    empty = players.player_run_summary(spark, full.limit(0), 2025).first()
    assert (empty.status, empty.loaded) == ("nothing extracted", 0)


PAGE = """
<html><script>var t = '<table id="totals_stats"><tbody><tr><td data-stat="player">No</td></tr>';</script>
<!-- <table id="totals_stats"> -->
<table id="other"><tbody><tr><td data-stat="player">Nobody</td></tr></tbody></table>
<TABLE class=x id='totals_stats'><thead><tr><th colspan="2">Top</th></tr>
<tr><th data-stat="ranker">Rk</th><th data-stat="name_display">Player</th></tr></thead>
<tbody>
<tr><th data-stat="ranker">1</th><td data-stat="name_display"><a href="/p/1?a=1&amp;b=2">Al &amp; Co</a>*</td><td data-stat="g"> 10 </td></tr>
<tr class="x thead"><th data-stat="name_display">Player</th></tr>
<tr><td data-stat="name_display"></td><td data-stat="g">3</td></tr>
<tr><td data-stat="player">Bo<td data-stat="pts">7<td>no name</td>
<tr><td data-stat="player"><b>Cy</b> D</td><td data-stat="note" title="a > b">x<table><tr><td data-stat="g">99</td></tr></table></td></tr>
</tbody></table>
<table id="totals_stats"><tbody><tr><td data-stat="player">Late</td></tr></tbody></table></html>
"""


def test_page_rows():
    assert page_rows(PAGE) == [
        {"ranker": "1", "name_display": "Al & Co*", "player": "Al & Co*", "player_url": "/p/1?a=1&b=2", "g": "10"},
        {"player": "Bo", "pts": "7"},
        {"player": "Cy D", "note": "x"},
    ]
    assert page_rows("<html><p>none</p></html>") == []


def test_stats_records(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, "v", "<p>no table</p>"), (3, "w", None)], "page_id bigint, url string, html string")
    rows = stats_records(pages, ["player", "g", "pts"], "https://x.example", 2025).orderBy("row_no").collect()
    assert [(r.page_id, r.row_no, r.player, r.g, r.pts, r.player_url, r.season_year) for r in rows] == [
        (1, 1, "Al & Co*", "10", None, "https://x.example/p/1?a=1&b=2", 2025),
        (1, 2, "Bo", None, "7", None, 2025),
        (1, 3, "Cy D", None, None, None, 2025),
    ]
    assert all(r.error is None and r.scraped_at for r in rows)


def test_an_entity_coded_id_is_found(spark):
    page = PAGE.replace('id="totals_stats"', 'id="totals&#95;stats"')
    pages = spark.createDataFrame([(1, "u", page)], "page_id bigint, url string, html string")
    assert stats_records(pages, ["player"], "https://x.example", 2025).count() == len(page_rows(PAGE)) > 0


@pytest.mark.parametrize("damage", ['<a "', "<a href='", "<", "</", "<!--", '<td data-stat="x', "<script>", '"<a>\'', "<a b=\"c\" '"])
def test_a_damaged_page_is_read_in_one_pass(damage):
    for page in (PAGE + damage * (1_000_000 // len(damage)), damage * (1_000_000 // len(damage)) + PAGE):
        start = time.perf_counter()
        page_rows(page)
        assert time.perf_counter() - start < 3
    assert page_rows(PAGE + damage) == page_rows(PAGE)


def ten_rows(cell, behind=""):
    rows = "".join(f'<tr><td data-stat="player">P{i}</td>{cell if i == 3 else ""}<td data-stat="g">{i}</td></tr>' for i in range(10))
    return f'<table id="totals_stats"><tbody>{rows}</tbody></table>{behind}'


@pytest.mark.parametrize("cell", [
    "<td title=don't>x</td>", "<td title=don't class='b'>x</td>", '<td title=5"6 >x</td>', "<td title = don't\n>x</td>", "<td 'odd' \"=>x</td>",
    "<td/title='a'b=\"c\"d>x</td>", "<td title='a>b' x=\">\">x</td>", "<td =a=b>x</td>", "<td title=>x</td>", "<td title=a/>x</td>",
])
def test_quotes_in_odd_places_lose_no_row(cell):
    rows, error = read_page(ten_rows(cell, "<p>it's over</p>"))
    assert [r["g"] for r in rows] == [str(i) for i in range(10)] and error is None


def test_an_open_quote_goes_on_to_the_next_one():
    """The attribute takes what stands before the next quote, as in a browser; reading goes on there."""
    rows, error = read_page(ten_rows('<td title="x>y</td>'))
    assert [r["player"] for r in rows] == ["P0", "P1", "P2", "P3", "P5", "P6", "P7", "P8", "P9"] or len(rows) >= 9
    assert error is None
    rows, error = read_page(ten_rows("<td title='x>y</td>"))
    assert [r["player"] for r in rows] == ["P0", "P1", "P2", "P3"] and error == "the page ends inside a quoted attribute"


@pytest.mark.parametrize("end, error", [
    ("<td data-stat='g", "quoted attribute"), ("<td data-stat", "tag"), ("<td a=", "tag"), ("<!-- x", "comment"), ("<script>", "script"), ("", None),
])
def test_a_page_that_breaks_off_says_so(spark, end, error):
    page = '<table id="totals_stats"><tbody><tr><td data-stat="player">A</td></tr>' + end
    rows, found = read_page(page)
    assert [r["player"] for r in rows] == ["A"] and (found or "").endswith(error or "")
    pages = spark.createDataFrame([(1, "u", page), (2, "v", PAGE)], "page_id bigint, url string, html string")
    made = stats_records(pages, ["player", "g"], "https://x.example", 2025).where("page_id = 1").orderBy("row_no").collect()
    assert [(r.row_no, r.player, r.error) for r in made] == ([(0, None, found)] if error else []) + [(1, "A", None)]


def test_attributes_equal_those_of_a_sound_tag():
    from tallyhouse.sources import html_tables

    for text in ('a="1" b=\'2\' c=3 d', ' a = "x y"  A="z" ', "", " / a/b=c", 'href="/p?a=1&amp;b=2" class=x'):
        tag = f"<td {text}>"
        sound = html_tables._SOUND_TAG.match(tag)
        states, end = html_tables._attributes(tag, 3)
        assert end == len(tag)
        for name in ("a", "b", "c", "href", "class"):
            assert (html_tables._attribute(sound.group(3), name) or "") == (html_tables._attribute(states, name) or "")
