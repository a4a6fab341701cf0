import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import mixing
from tallyhouse.llm.queries import queries


@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=12), st.lists(st.integers(1, 9), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_water_filling(sizes, cycle):
    sources = {f"s{i:02}": n for i, n in enumerate(sizes)}
    weights = mixing.cycled_weights(list(sources), cycle)
    total = sum(sizes)
    target = mixing.water_fill(sources, weights, total, 3)
    assert sum(target.values()) == pytest.approx(total)
    rates = []
    for s, n in sources.items():
        assert target[s] <= 3 * n + 1e-6
        if n and target[s] < 3 * n:
            rates.append(target[s] / weights[s])
    # Sources below their cap are filled to one level, and those at the cap would not exceed it.
    for rate in rates:
        assert rate == pytest.approx(rates[0])
        assert all(3 * n <= rate * weights[s] + 1e-6 for s, n in sources.items() if target[s] >= 3 * n)


def test_weights_go_by_code_point_and_null_last():
    assert mixing.cycled_weights([None, "é", "b", "B", "😀", "\uffff"], [1, 2, 3]) == {"B": 1, "b": 2, "é": 3, "\uffff": 1, "😀": 2, None: 3}


def words(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return len([w for w in text.split(" ") if w])


def check(rows, sizes_of):
    """Sizes, targets and taken words of result rows (doc_id, source, size, source_size, target, taken)."""
    total, seen, taken, largest = {}, {}, {}, {}
    for r in rows:
        assert r.size == sizes_of[r.doc_id]
        total[r.source] = total.get(r.source, 0) + r.size
        seen.setdefault(r.source, set()).add((r.source_size, r.target))
        taken[r.source] = taken.get(r.source, 0) + r.taken
        if r.size:
            assert r.taken % r.size == 0 and 0 <= r.taken <= 3 * r.size
            largest[r.source] = min(largest.get(r.source, r.size), r.size)
        else:
            assert r.taken == 0
    want = mixing.water_fill(total, mixing.cycled_weights(list(total), (1, 2, 3)), sum(total.values()), 3)
    for s in total:
        ((size, target),) = seen[s]
        assert size == total[s] and target == pytest.approx(want[s])
        epochs = target / size if size else 0
        for r in rows:
            if r.source == s and r.size:
                assert r.taken // r.size in (int(epochs), int(epochs) + 1)
    return taken, want


def test_query(spark, small):
    text = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries()["op9_mix_sources"](spark, small).collect()
    check(rows, text)
    again = queries()["op9_mix_sources"](spark, small).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_taken_words_come_near_the_target(spark):
    rows = [(i, "w " * (5 + i * i % 300), f"s{i % 4}" if i % 3 else "hot") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = mixing.mix(docs).select("row.doc_id", "row.source", "size", "source_size", "target", "taken").collect()
    taken, want = check(mixed, {i: 5 + i * i % 300 for i in range(6000)})
    for s in want:
        assert abs(taken[s] - want[s]) <= 0.005 * want[s]


def test_sampled_rows_are_the_copies(spark):
    docs = spark.createDataFrame([(i, "a b c", "x" if i < 3 else "y") for i in range(60)], "doc_id bigint, text string, source string")
    mixed = mixing.mix(docs, weights={"x": 5, "y": 1})
    copies = {r.doc_id: r.copies for r in mixed.select("row.doc_id", "copies").collect()}
    assert all(copies[i] == 3 for i in range(3))
    assert mixing.sampled(mixed).count() == sum(copies.values())


def test_edges(spark, edge_docs, no_docs):
    mixed = mixing.mix(edge_docs).collect()
    assert len(mixed) == edge_docs.count()
    assert all(r["size"] == words(r.row.text) for r in mixed)
    assert {r.taken for r in mixed if not r["size"]} == {0}
    # Repeated rows are taken alike.
    assert len({r.copies for r in mixed if r.row.doc_id == 6 and r.row.text != "another text under the same id"}) == 1
    assert mixing.mix(no_docs).count() == 0
