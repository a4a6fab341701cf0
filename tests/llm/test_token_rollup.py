import base64
import random
from collections import Counter

import pytest
import regex
import tiktoken

from tallyhouse.llm import queries as registered
from tallyhouse.llm.queries import TOKENIZERS
from tallyhouse.llm.token_rollup import PATTERN, Rollup, Tokenizer, _encoding, token_count
from tallyhouse.session import fresh_path

WORDS = Tokenizer("words")
SCHEMA = "op string, id string, source string, lang string, text string"


def words(text):
    return len(regex.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture
def rollup(spark):
    return Rollup(spark, fresh_path(spark, "rollup"), [WORDS])


def totals(rollup):
    return {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def commit(rollup, batch, rows):
    return rollup.commit(batch, rollup.spark.createDataFrame(rows, SCHEMA))


def test_inserts_revisions_and_deletes(rollup):
    assert totals(rollup) == {}
    assert commit(rollup, "1", [("insert", "a", "s", "en", "one two"), ("insert", "b", "s", "en", "three"), ("insert", "c", None, None, None)])
    assert totals(rollup) == {("s", "en"): (2, 3), (None, None): (1, 0)}
    assert commit(rollup, "2", [("revise", "a", "s", "de", "one two four five"), ("delete", "c", None, None, None), ("delete", "zz", None, None, None)])
    assert totals(rollup) == {("s", "en"): (1, 1), ("s", "de"): (1, 4)}
    assert not commit(rollup, "2", [("insert", "d", "s", "en", "never counted")])
    assert totals(rollup) == {("s", "en"): (1, 1), ("s", "de"): (1, 4)}
    assert commit(rollup, "3", [("delete", "a", None, None, None), ("insert", "a", "s", "fr", "x"), ("revise", "new", "t", "fr", "y y")])
    assert totals(rollup) == {("s", "en"): (1, 1), ("s", "fr"): (1, 1), ("t", "fr"): (1, 2)}


def test_a_failed_attempt_is_written_over(rollup):
    """Entries and a delta without its marker do not count, and the batch can be committed again."""
    commit(rollup, "1", [("insert", "a", "s", "en", "one")])
    junk = rollup.spark.createDataFrame([("a", "s", "en", "words", 7, 700)], "id string, source string, lang string, tokenizer string, docs bigint, tokens bigint")
    for part in ("entries", "deltas"):
        junk.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(rollup._path(part, "2"))
    assert rollup.committed() == ["1"]
    assert totals(rollup) == {("s", "en"): (1, 1)}
    assert commit(rollup, "2", [("insert", "b", "s", "en", "two three")])
    assert totals(rollup) == {("s", "en"): (2, 3)}


def test_random_changes_equal_a_recount(rollup):
    dice = random.Random(8)
    state = {}
    for batch in range(5):
        rows, touched = [], set()
        for _ in range(40):
            i = str(dice.randrange(60))
            if i in touched:
                continue
            touched.add(i)
            doc = (dice.choice(["s", "t", None]), dice.choice(["en", "de"]), "w " * dice.randrange(9))
            if i not in state:
                rows.append(("insert", i, *doc))
                state[i] = doc
            elif dice.random() < 0.5:
                rows.append(("revise", i, *doc))
                state[i] = doc
            else:
                rows.append(("delete", i, None, None, None))
                del state[i]
        commit(rollup, str(batch), rows)
        want = Counter()
        for s, lang, text in state.values():
            want[(s, lang, "docs")] += 1
            want[(s, lang, "tokens")] += words(text)
        keys = {k[:2] for k in want}
        assert totals(rollup) == {k: (want[(*k, "docs")], want[(*k, "tokens")]) for k in keys}


def test_edges(spark, rollup, edge_docs, no_docs):
    pick = "'insert' as op, cast(doc_id as string) as id, source, lang, text"
    rollup.commit("1", edge_docs.selectExpr(*pick.split(", ")))
    rows = edge_docs.collect()
    assert sum(d for d, _ in totals(rollup).values()) == len(rows)
    assert sum(t for _, t in totals(rollup).values()) == sum(words(r.text) for r in rows)
    before = totals(rollup)
    rollup.commit("2", no_docs.selectExpr(*pick.split(", ")))
    commit(rollup, "3", [(None, "1", "s", "en", "x"), ("other", "1", "s", "en", "x"), ("delete", None, None, None, None)])
    assert totals(rollup) == before
    commit(rollup, "4", [("delete", "6", None, None, None)])  # all three rows with this id
    assert sum(d for d, _ in totals(rollup).values()) == len(rows) - 3


def test_query_equals_a_recount(spark, small):
    path = TOKENIZERS[1].path
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    bpe = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    toxic = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").where("toxic = 1").collect()}
    want = Counter()
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        if r.doc_id not in toxic:
            text = regex.sub("[0-9]{4,}", "0000", r.text)
            for version, n in (("words-1", words(text)), ("byte_bpe_50k-1", len(bpe.encode_ordinary(text)))):
                want[(r.source, r.lang, version, "docs")] += 1
                want[(r.source, r.lang, version, "tokens")] += n
    got = registered.queries()["op8_token_rollup"](spark, small).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in got} == {
        k[:3]: (want[(*k[:3], "docs")], want[(*k[:3], "tokens")]) for k in want
    }


def test_very_long_white_space():
    encoding = _encoding("t", open(TOKENIZERS[1].path, "rb").read())
    text = "a b  c\n\n d é" * 50 + " " * 1500 + "zz" + "\t\n" * 300
    assert token_count(encoding, text) == len(encoding.encode_ordinary(text))
    longer = text + " " * 3000 + "x"
    assert token_count(encoding, longer) == len(encoding.encode_ordinary(longer))
    assert token_count(encoding, " " * 1_000_000) == 1_000_000
