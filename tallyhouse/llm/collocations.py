"""Phrase collocations: counts of all short phrases, and how far each exceeds its parts.

Every word occurrence is a suffix pointer: the word and those behind it in its piece, to a maximum
depth of ``max_words`` words. Counting takes three steps.

1. *Leading words* are counted in one pass, and with them the prefixes of two words or more that are
   frequent inside a task. Those of them that hold over ``PART_ROWS`` occurrences are heavy.
2. *Routing.* Suffixes that are alike in a task become one with a count, and go to a part by the hash
   of their leading word; behind a heavy prefix one word more decides, so a word or word pair that
   holds a third of all text is spread by what follows it. They travel as compressed blocks.
3. *Multikey three-way quicksort* in each part: pointers are dealt into less, equal and greater by
   their word at the depth reached. The equal ones go one word deeper, and their number is the count
   of the phrase so far. A partition of fewer occurrences than asked for is abandoned: no phrase in
   it can be frequent, as all suffixes with one prefix are in one part. All partitions of a part are
   dealt at once with numpy. Heavy prefixes are in several parts; their counts are added up after.

The frequent phrases then meet the counts of their parts. Everything is by language. There are at
most (all words / ``PART_ROWS``) heavy prefixes of each length, so the tasks are sent no more; text
and counts are never collected.

Edge cases: a NULL or empty text has no words; a NULL language is ``und`` and one with documents that
are called so; repeated documents count as often as they stand there; very long texts are read
whole; equal scores are ordered by count and phrase; an empty table gives an empty table; only the
text and the language are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import small_side, stored

MAX_WORDS = 3
LEAST_COUNT = 10
TOP = 2000
SCALE = 1_000_000
COVERED_PERCENT = 50  # a phrase goes if one longer candidate holds so many of its occurrences
PART_ROWS = 400_000
NO_LANGUAGE = "und"

_FLUSH_BYTES = 4 << 20
_WORD_BYTES = 6  # a cautious guess, used for the number of parts alone

# What ends a piece becomes a line feed, a tab a blank, and A-Z are lower-cased.
_MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * 9 + b" abcdefghijklmnopqrstuvwxyz")


def split_words(data: bytes) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of prepared text as a dictionary array, and the number of the line of each."""
    chars = np.frombuffer(data, np.uint8)
    line_end = chars == 10
    inside = ~(line_end | (chars == 32))
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(chars[inside].tobytes())]
    )
    return words.dictionary_encode(), np.searchsorted(np.flatnonzero(line_end), starts)


def _suffixes(data: bytes, depth: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different suffixes in prepared text: the dictionary, the word numbers by depth (-1 behind
    the end of a line), and how often each occurs."""
    words, lines = split_words(data)
    ids = words.indices.to_numpy()
    base = len(words.dictionary) + 1
    columns = [ids]
    for ahead in range(1, depth):
        later = np.full(len(ids), -1, np.int32)
        same = lines[ahead:] == lines[:-ahead]
        later[: len(same)][same] = ids[ahead:][same]
        columns.append(later)
    code, room = columns[0].astype(np.int64) + 1, base
    for column in columns[1:]:
        if room > (1 << 62) // base:  # codes are made small again before they leave 63 bits
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            room = len(code) + 1
        code, room = code * base + column + 1, room * base
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return words.dictionary, np.stack([c[first] for c in columns]), counts


def _by_language(batches: Iterator[pa.RecordBatch], size: int = _FLUSH_BYTES) -> Iterator[tuple[str, bytes]]:
    """Prepared text of the (lang, text) rows of a task, in blocks of about ``size`` bytes a language.

    A text longer than a block is a block alone.
    """
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = (text.cast(pa.binary()).as_py() or b"").translate(_MARKS)
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            if sizes[lang] > size or sum(sizes.values()) > 3 * size:
                lang = max(sizes, key=sizes.get)
                sizes.pop(lang)
                yield lang, b"\n".join(held.pop(lang))
    for lang, texts in held.items():
        yield lang, b"\n".join(texts)


def _joined(words: pa.Array, columns: np.ndarray) -> pa.Array:
    """The words of each row (down the columns), a blank between; -1 is no word."""
    parts = [words.take(pa.array(c, mask=c < 0)) for c in columns]
    if len(parts) == 1:
        return parts[0]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()), null_handling="skip")


def _repeat(value: str, n: int) -> pa.Array:
    return pa.array([value], pa.string()).take(pa.array(np.zeros(n, np.int32)))


def _leading(depth: int, parts: int):
    """Tasks of the first pass: (lang, words, phrase, n) for every word, and for the longer prefixes
    that hold a part's share of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in _by_language(batches):
            words, columns, counts = _suffixes(data, max(depth - 1, 1))
            for length in range(1, depth):
                code = columns[0].astype(np.int64)
                for column in columns[1:length]:
                    code = np.where((code < 0) | (column < 0), -1, code * (len(words) + 1) + column)
                    if length > 2:
                        code = np.where(code < 0, -1, np.unique(code, return_inverse=True)[1])
                _, first, place = np.unique(code, return_index=True, return_inverse=True)
                n = np.bincount(place, counts, len(first)).astype(np.int64)
                kept = code[first] >= 0
                if length > 1:
                    kept &= n * parts >= counts.sum()
                first, n = first[kept], n[kept]
                if len(first):
                    yield pa.RecordBatch.from_arrays(
                        [_repeat(lang, len(n)), pa.array(np.full(len(n), length, np.int32)),
                         _joined(words, columns[:length, first]).cast(pa.string()), pa.array(n)],
                        names=["lang", "words", "phrase", "n"],
                    )

    return run


class Heavy:
    """The heavy prefixes: language → number of words → phrases."""

    def __init__(self, rows):
        self.phrases: dict[str, dict[int, list[bytes]]] = {}
        for lang, words, phrase in rows:
            self.phrases.setdefault(lang, {}).setdefault(words, []).append(phrase.encode())

    def marks(self, lang: str, words: pa.Array, columns: np.ndarray) -> list[np.ndarray]:
        """For each number of words from 1 on: which rows begin with a heavy prefix of so many."""
        found = []
        for length in range(1, len(columns)):
            phrases = self.phrases.get(lang, {}).get(length, [])
            mark = np.zeros(columns.shape[1], bool)
            if phrases:
                split = [p.split(b" ") for p in phrases]
                known = [pc.index_in(pa.array([s[k] for s in split], pa.binary()), words).to_pylist() for k in range(length)]
                wanted = [ids for ids in zip(*known) if None not in ids]
                rows = np.flatnonzero(np.isin(columns[0], [ids[0] for ids in wanted]))
                wanted_rows = set(wanted)
                if length == 1:
                    mark[rows] = True
                else:
                    mark[rows] = [ids in wanted_rows for ids in zip(*columns[:length, rows].tolist())]
            found.append(mark)
        return found


def _routed(depth: int, parts: int, sent):
    """Tasks of the second pass: (part, lang, block), blocks of different suffixes and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, press = cloudpickle.loads(sent.value), zstandard.ZstdCompressor(level=1)
        for lang, data in _by_language(batches):
            words, columns, counts = _suffixes(data, depth)
            if not len(counts):
                continue
            hashes = np.fromiter((zlib.crc32(w) for w in words.to_pylist()), np.uint64, len(words))
            hashes = np.append(hashes, np.uint64(0))  # at -1: no word
            mixed = hashes[columns[0]] + np.uint64(zlib.crc32(lang.encode()))
            for column, mark in zip(columns[1:], heavy.marks(lang, words, columns)):
                deeper = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[column] + np.uint64(1)
                mixed = np.where(mark, deeper, mixed)
            part = ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)).astype(np.int64) % parts
            order = np.argsort(part, kind="stable")
            part, columns, counts = part[order], columns[:, order], counts[order].astype(np.uint32)
            lines = pc.binary_join_element_wise(_joined(words, columns), pa.scalar(b"", pa.binary()), pa.scalar(b"\n", pa.binary()))
            text, at = lines.buffers()[2], np.frombuffer(lines.buffers()[1], np.int32, len(lines) + 1)
            edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            made = [
                press.compress(int(high - low).to_bytes(8, "little") + counts[low:high].tobytes() + text[int(at[low]) : int(at[high])].to_pybytes())
                for low, high in zip(edges[:-1], edges[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[edges[:-1]].astype(np.int32)), _repeat(lang, len(made)), pa.array(made, pa.binary())],
                names=["part", "lang", "block"],
            )

    return run


def frequent_prefixes(columns: np.ndarray, weights: np.ndarray, least: int, seed: int = 1):
    """Multikey three-way quicksort of the suffixes given down the columns of ``columns``.

    Yields (depth, places, counts) in rounds: prefixes of ``depth`` words that occur ``least`` times or
    more, each by the place of one suffix that has it. -1 is the end of a suffix.
    """
    dice = np.random.default_rng(seed)
    depth_of = np.zeros(1, np.int64)  # of each partition
    rows = np.arange(columns.shape[1])  # the pointers, partition after partition
    sizes = np.array([len(rows)])
    while len(rows):
        starts = np.cumsum(sizes) - sizes
        totals = np.add.reduceat(weights[rows], starts)
        kept = totals >= least  # the others are abandoned
        if not kept.all():
            rows = rows[np.repeat(kept, sizes)]
            sizes, depth_of = sizes[kept], depth_of[kept]
            starts = np.cumsum(sizes) - sizes
            if not len(rows):
                return
        owner = np.repeat(np.arange(len(sizes)), sizes)
        keys = columns[depth_of[owner], rows]
        pivots = keys[starts + (dice.random(len(sizes)) * sizes).astype(np.int64)]
        side = np.sign(keys - pivots[owner]) + 1  # 0 less, 1 equal, 2 greater
        cell = owner * 3 + side
        new_sizes = np.bincount(cell, minlength=3 * len(sizes))
        placed = np.empty_like(rows)
        new_starts = np.cumsum(new_sizes) - new_sizes
        for which in range(3):  # pointers keep their order inside each third
            mine = np.flatnonzero(side == which)
            own_sizes = new_sizes[which::3]
            within = np.arange(len(mine)) - np.repeat(np.cumsum(own_sizes) - own_sizes, own_sizes)
            placed[np.repeat(new_starts[which::3], own_sizes) + within] = rows[mine]
        equal = np.zeros(len(new_sizes), bool)
        equal[1::3] = True
        new_depth = np.repeat(depth_of, 3) + equal
        word = np.repeat(pivots, 3)
        filled = new_sizes > 0
        sums = np.zeros(len(new_sizes), np.int64)
        sums[filled] = np.add.reduceat(weights[placed], new_starts[filled])
        found = equal & (word >= 0) & (sums >= least)
        for depth in np.unique(new_depth[found]):
            of_depth = found & (new_depth == depth)
            yield int(depth), placed[new_starts[of_depth]], sums[of_depth]
        goes_on = filled & (sums >= least) & ~(equal & ((word < 0) | (new_depth == len(columns))))
        rows = placed[np.repeat(goes_on, new_sizes)]
        sizes, depth_of = new_sizes[goes_on], new_depth[goes_on]


def _mined(depth: int, least: int, sent):
    """Tasks of the third pass: (lang, words, phrase, n) for the frequent phrases of two words or more
    in a part, and what the part holds of heavy prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, unpack = cloudpickle.loads(sent.value), zstandard.ZstdDecompressor()
        counts: dict[str, list] = {}
        texts: dict[str, list] = {}
        for batch in batches:
            for lang, block in zip(batch.column("lang").to_pylist(), batch.column("block").to_pylist()):
                block = unpack.decompress(block)
                n = int.from_bytes(block[:8], "little")
                counts.setdefault(lang, []).append(np.frombuffer(block, np.uint32, n, 8))
                texts.setdefault(lang, []).append(block[8 + 4 * n :])
        for lang in list(counts):
            weights = np.concatenate(counts.pop(lang)).astype(np.int64)
            encoded, line = split_words(b"".join(texts.pop(lang)))
            words, at = encoded.dictionary, np.arange(len(line)) - np.searchsorted(line, line)
            columns = np.full((depth, len(weights)), -1, np.int32)
            columns[at, line] = encoded.indices.to_numpy()
            marks = heavy.marks(lang, words, columns)

            def rows(length, places, n):
                return pa.RecordBatch.from_arrays(
                    [_repeat(lang, len(n)), pa.array(np.full(len(n), length, np.int32)),
                     _joined(words, columns[:length, places]).cast(pa.string()), pa.array(n)],
                    names=["lang", "words", "phrase", "n"],
                )

            for length in range(2, depth):
                places = np.flatnonzero(marks[length - 1])
                if len(places):
                    alike, place = np.unique(columns[:length, places], axis=1, return_inverse=True)
                    first = np.zeros(alike.shape[1], np.int64)
                    first[place[::-1]] = places[::-1]
                    yield rows(length, first, np.bincount(place, weights[places]).astype(np.int64))
            for length, places, n in frequent_prefixes(columns, weights, least):
                if length > 1:
                    if length < depth:
                        light = ~marks[length - 1][places]
                        places, n = places[light], n[light]
                    if len(n):
                        yield rows(length, places, n)

    return run


_COUNTED = "lang string, words int, phrase string, n bigint"


def phrase_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, max_words: int = MAX_WORDS,
    least_count: int = LEAST_COUNT, part_rows: int = PART_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, n) of all phrases that occur ``least_count`` times or more, and (lang, n),
    the words of each language."""
    spark = docs.sparkSession
    read = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).alias("text"))
    size = read.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // (_WORD_BYTES * part_rows)))
    leading = read.mapInArrow(_leading(max(max_words, 2), parts), _COUNTED).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    leading = stored(leading, "leading-words")
    totals = leading.where("words = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    # At most (all words / part_rows) prefixes of each length hold so many occurrences.
    heavy = leading.where(F.col("n") > part_rows).select("lang", "words", "phrase").collect()
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(Heavy(heavy)))
    routed = read.mapInArrow(_routed(max_words, parts, sent), "part int, lang string, block binary")
    mined = routed.repartitionById(parts, "part").mapInArrow(_mined(max_words, least_count, sent), _COUNTED)
    longer = mined.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    frequent = leading.where("words = 1").unionByName(longer).where(F.col("n") >= least_count)
    return stored(frequent, "phrases"), totals


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, max_words: int = MAX_WORDS,
    least_count: int = LEAST_COUNT, top: int = TOP, part_rows: int = PART_ROWS,
) -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    ``a`` is the count of the phrase, ``l`` and ``r`` those of the parts on both sides of its weakest cut,
    ``n`` the words of the language, and the score floor(10^6 a^2 / (l r)), in decimals that hold any
    product of counts up to 10^14.
    """
    counts, totals = phrase_counts(docs, text_col, lang_col, max_words=max_words, least_count=least_count, part_rows=part_rows)
    size = counts.count()
    candidates = counts.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns(
        {
            "first_part": F.concat_ws(" ", F.slice(F.split("phrase", " "), F.lit(1), F.col("k"))),
            "rest": F.concat_ws(" ", F.slice(F.split("phrase", " "), F.col("k") + 1, F.col("words") - F.col("k"))),
        }
    )
    part = lambda name, n: small_side(counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n)), size)
    met = cuts.join(part("first_part", "l"), ["lang", "first_part"]).join(part("rest", "r"), ["lang", "rest"])
    wide = {c: F.col(c).cast("decimal(14,0)") for c in ("a", "l", "r")}
    score = F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * (wide["a"] * wide["a"]), wide["l"] * wide["r"])
    weakest = (
        met.withColumn("score", score)
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    # Every shorter phrase inside a candidate, with the most that one candidate holds of it.
    inside = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda m: F.transform(
                F.sequence(F.lit(1), F.col("words") - m + 1),
                lambda i: F.concat_ws(" ", F.slice(F.split("phrase", " "), i, m)),
            ),
        )
    )
    held = (
        candidates.where("words > 2").select("lang", F.explode(inside).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    )
    kept = weakest.join(held, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("most") < COVERED_PERCENT * F.col("a"), F.lit(True))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
