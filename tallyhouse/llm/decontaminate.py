"""Find benchmark questions and answers in documents with one Aho-Corasick automaton.

Texts are normalised to words of letters, digits and non-ASCII characters with A-Z lowered.
A window is 13 consecutive words of a benchmark item (a shorter item is one window). The
automaton reads words as symbols: each task scans a document's words once, whatever the number
of windows, and word numbers map back to character offsets of the original text.

The benchmark is the stated query set. Its texts go to the tasks in blocks of bounded size; all
blocks are scanned one after the other while a batch of documents is in memory, so a larger
benchmark costs time and not memory. Words are held for one document at a time. The documents
are neither shuffled nor collected.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import count

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import LOWER, UPPER, packed, text_udf

WINDOW = 13
BLOCK_CHARS = 8_000_000

_numbers = count()  # tells the blocks of one scan from those of another in a worker

# Word characters are 0-9, a-z and everything beyond ASCII; in UTF-8 those are bytes from 0x80.
_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TO_WORDS = bytes(
    b if b in _WORD_BYTES else ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER else 0x20 for b in range(256)
)
_WORD_SPAN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_FIELDS = [
    ("n_words", "bigint", pa.int64()), ("n_hit", "bigint", pa.int64()), ("n_items", "bigint", pa.int64()),
    ("items_sha256", "string", pa.string()), ("contaminated", "boolean", pa.bool_()),
    ("spans", "array<struct<first: bigint, last: bigint>>", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
]
SCHEMA = pa.schema([(name, kind) for name, _, kind in _FIELDS])
DDL = "struct<" + ", ".join(f"{name}: {kind}" for name, kind, _ in _FIELDS) + ">"


def words_of(text: bytes) -> list[bytes]:
    """Normalised words of UTF-8 text."""
    return text.translate(_TO_WORDS).split()


class Matcher:
    """The automaton of one block of benchmark items, reading word numbers as symbols."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.numbers: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            size = min(WINDOW, len(words))
            for start in range(len(words) - size + 1 if words else 0):
                windows.setdefault(tuple(words[start : start + size]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, owners in windows.items():
            self.automaton.add_word(window, (len(window), owners))
        self.empty = not windows
        if windows:
            self.automaton.make_automaton()

    def hits(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, last word, items) of every occurrence; unknown words are symbol 0."""
        if self.empty or not words:
            return
        numbers = self.numbers
        symbols = tuple([numbers.get(w, 0) for w in words])
        for end, (size, owners) in self.automaton.iter(symbols):
            yield end - size + 1, end, owners


_loaded: dict[int, Matcher] = {}


def _matcher(number: int, block: Broadcast) -> Matcher:
    """The matcher of a block; a worker holds one at a time."""
    if number not in _loaded:
        _loaded.clear()
        _loaded[number] = Matcher(block.value)
    return _loaded[number]


def _merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges (first, last) that touch or overlap as one."""
    runs: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if runs and first <= runs[-1][1] + 1:
            runs[-1] = (runs[-1][0], max(runs[-1][1], last))
        else:
            runs.append((first, last))
    return runs


def _scan(texts: list[bytes], blocks: list[tuple[int, Broadcast]]) -> dict[str, list]:
    sizes = [0] * len(texts)
    runs: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    for number, block in blocks:
        matcher = _matcher(number, block)
        for i, text in enumerate(texts):
            # A text's words take ten times its room, so they are held for one text at a time.
            words = words_of(text)
            sizes[i] = len(words)
            found = []
            for first, last, owners in matcher.hits(words):
                found.append((first, last))
                items[i] |= owners
            if found:
                runs[i] = _merged(runs[i] + found)
    made: dict[str, list] = {name: [] for name, _, _ in _FIELDS}
    for text, size, hit, owners in zip(texts, sizes, runs, items):
        n_hit = sum(last - first + 1 for first, last in hit)
        values = (
            size,
            n_hit,
            len(owners),
            hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest(),
            n_hit > 0 and 20 * n_hit >= size,
            _characters(text, hit),
        )
        for (name, _, _), value in zip(_FIELDS, values):
            made[name].append(value)
    return made


def _characters(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word runs as character offsets (first, behind the last) in the original text."""
    if not runs:
        return []
    places = [m.span() for m in _WORD_SPAN.finditer(text)]
    return [
        {
            "first": (first := len(text[: places[a][0]].decode("utf-8", "replace"))),
            "last": first + len(text[places[a][0] : places[b][1]].decode("utf-8", "replace")),
        }
        for a, b in runs
    ]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[tuple[int, Broadcast]]:
    """The benchmark's texts in broadcast blocks of about ``BLOCK_CHARS`` characters."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where(
        "item is not null and text is not null"
    )
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-total // BLOCK_CHARS))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n_blocks)))
    return [
        (
            next(_numbers),
            spark.sparkContext.broadcast(
                [(r["item"], r["text"].encode()) for r in dealt.where(F.col("block") == k).collect()]
            ),
        )
        for k in range(n_blocks)
    ]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` beside the struct ``hits``.

    ``hits.spans`` holds character offsets of the hit passages. NULL and empty texts have no
    words and no hits. Items without id or words have no windows; an id given twice counts as
    one item; an empty benchmark leaves every document clean. Repeated rows are judged alike; an
    empty table of documents gives an empty table. A very long text is scanned whole, and what is
    held for it grows with its words.
    """
    blocks = _blocks(benchmark, item_col, item_text_col)
    return packed(docs, hits=text_udf(lambda texts: _scan(texts, blocks), SCHEMA, DDL)(F.col(text_col)))


def clean(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    return scan(docs, benchmark, **columns).where("not hits.contaminated").select("row.*")
