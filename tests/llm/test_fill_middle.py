import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import fill_middle as fim
from tallyhouse.llm.queries import queries
from tallyhouse.sources.tables import table

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    """The contract, step by step, with a plain loop over units."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def made(df):
    rows = fim.transform(df).select("row.doc_id", "row.text", "n", "form", "prefix_chars", "middle_chars", "output",
                                    fim.restored().alias("back")).collect()
    for r in rows:
        assert r.back == (r.text or "")
    return [((r.doc_id, r.text), (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in rows]


def test_all_documents_against_the_contract(spark, small):
    docs = table(spark, small, "documents")
    rows = made(docs)
    assert len(rows) == docs.count()
    assert all(found == expected(*key) for key, found in rows)
    assert {found[1] for _, found in rows} == {"plain", "spm", "psm"}


def test_query_restores_every_text(spark, small):
    rows = queries()["op11_fill_middle"](spark, small)
    texts = table(spark, small, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    assert rows.join(texts, "doc_id").where("restored_sha256 = sha").count() == texts.count()


@given(st.text(alphabet="ab<PSM> \t\n\x0b\x0c\r\x1c é日😀", max_size=60), st.integers(0, 2**32), st.integers(0, 2**32))
def test_units_are_those_of_a_loop(text, one, other):
    units = UNIT.findall(text)
    n, first, second = fim.cuts_of(text, one, other)
    low, high = sorted((one % (n + 1), other % (n + 1)))
    assert n == len(units)
    assert (first, second) == (len("".join(units[:low])), len("".join(units[:high])))


@given(st.text(alphabet="ab \n", max_size=80), st.integers(1, 9))
def test_blocks_do_not_move_borders(text, block):
    ends, at = [], 0
    for unit in UNIT.findall(text):
        at += len(unit)
        ends.append(at)
    assert fim.unit_ends(text, block) == ends


def test_very_long_text():
    text = "abc de " * 2_000_000
    ends = fim.unit_ends(text)
    assert len(ends) == 4_000_001 and ends[-1] == len(text) and ends[1] == 6


def test_awkward_documents(spark, edge_docs, no_docs):
    marks = ["a <P> b", "x<S>", "<M>", "<", "a <", "P> <P", "<S <S", "<P", "< P>"]
    docs = edge_docs.unionByName(
        spark.createDataFrame([(100 + i, m) for i, m in enumerate(marks * 12)], "doc_id bigint, text string"),
        allowMissingColumns=True,
    )
    for (doc_id, text), found in made(docs):
        assert found == expected(doc_id, text)
    nulls = fim.transform(docs).where("row.text is null").select("n", "form", "output").distinct().collect()
    assert [tuple(r) for r in nulls] == [(0, "plain", "")]
    assert fim.transform(no_docs).count() == 0


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_all_turned_one_way(spark, small, form):
    docs = table(spark, small, "documents").where("length(text) > 0")
    rows = fim.transform(docs, fim_percent=100, spm_percent=100 if form == "spm" else 0)
    assert rows.where(F.col("form") != form).where("not row.text rlike '<[PSM]>'").count() == 0
    assert rows.where(fim.restored() != F.col("row.text")).count() == 0
