"""Plain cells are read in one step each, with the same records as tag by tag."""

from tallyhouse.sources import html_tables

ROWS = "".join(
    f'<tr><th scope="row" data-stat="ranker">{i}</th><td data-stat="player"><a href="/p/{i}">P{i} &amp; Co</a></td>'
    + "".join(f'<td class="right" data-stat="c{j}"> {i * j} </td>' for j in range(20)) + "</tr>\n"
    for i in range(50)
)
PAGE = f'<table id="totals_stats"><tbody>{ROWS}</tbody></table>'


def test_plain_cells_are_not_read_tag_by_tag(monkeypatch):
    slow = html_tables.page_rows(PAGE.replace('class="right"', "class='right'"))  # not quoted twice: tag by tag
    seen, tags = [], html_tables._tags

    def counted(*place):
        for tag in tags(*place):
            seen.append(tag)
            yield tag

    monkeypatch.setattr(html_tables, "_tags", counted)
    rows = html_tables.page_rows(PAGE)
    assert rows == slow and len(rows) == 50
    assert (rows[7]["player"], rows[7]["player_url"], rows[7]["c3"], rows[7]["ranker"]) == ("P7 & Co", "/p/7", "21", "7")
    assert len(seen) < 50 * 20


def test_cells_that_are_not_plain_end_a_run():
    page = PAGE.replace('data-stat="c5"> 15 </td>', 'data-stat="c5">1<!-- </td> -->5<b>!</b></td>')
    assert html_tables.page_rows(page)[3]["c5"] == "15!"
    assert html_tables.read_page(PAGE[: PAGE.index("P9") + 60])[0][-1]["player"] == "P9 & Co"
