"""Remove long strings that occur twice, by bucket-pointer refinement of sampled suffixes.

Sorting all suffixes of a corpus to a depth of 400 bytes is not needed to know which 400-byte
strings repeat. Buckets are refined only where they still hold different strings:

1. Initial buckets. Every 400-byte window is represented by one suffix that starts inside it: the
   position with the least hash of the 145 bytes behind it (the leftmost of equal ones). Equal
   windows have it at the same distance, so they meet in the bucket of that 145-gram. About one
   position in a hundred is a suffix; it stands for a run of neighbouring windows, its span. A
   bucket with one suffix is finished: nothing in its span repeats.
2. Refinement by context. Suffixes of a bucket are told apart by the bytes from the first to the
   last window of their span. Suffixes with equal spans and bytes form a sub-bucket: all its
   windows repeat. A bucket that is one sub-bucket is finished.
3. Refinement by offset. In the buckets that are left, one suffix per sub-bucket is cut by the
   distance of its windows into cells of 16. A cell's windows share a core of 385 bytes; cells are
   sorted into buckets by (bucket, distance, core), and a cell alone in its bucket is finished.
   Cells with equal cores and equal bytes on both sides form sub-buckets as before.
4. Only cells whose windows differ at the rim are refined to single windows, told apart by the rim
   bytes.

Each step is an aggregate over narrow rows (bucket identifiers and places), merged in the tasks
before the shuffle, so that a string in a third of all documents comes as one row per task. The
suffixes of large sub-buckets are told by a list of these, where they are. Texts are shuffled
twice: to cut the cells of step 3 and to write the result. No bucket is collected.

Buckets are identified by 64-bit hashes, told apart by a second 64-bit hash of the bytes within
each, and rims by their bytes. Documents are identified by a 64-bit hash of id and text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import checkpointed, packed, small_side, stored, text_udf

LENGTH = 400  # bytes of a string that must not occur twice
REACH = 256  # windows that a representative is the least of (a power of two)
GRAM = LENGTH - REACH + 1
CELL = 16
LARGE = 10_000  # suffixes of a sub-bucket that no task should get together

_WRAP = 1 << 64
_BASE = 0x9E3779B97F4A7C15
_STRETCH = 1 << 20  # positions hashed at a time; they fit into the low 20 bits of a key
_LOW = np.uint64(_STRETCH - 1)

SPAN = pa.struct([("bucket", pa.int64()), ("context", pa.int64()), ("place", pa.int64())])


def _powers(base: int, n: int) -> np.ndarray:
    made = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        made[done : done + more] = made[:more] * np.uint64(pow(base, done, _WRAP))
        done += more
    return made


class _Hasher:
    """Hashes of all 145-grams of a stretch of bytes, by prefix sums of a polynomial."""

    def __init__(self):
        n = _STRETCH + LENGTH
        self.powers, self.inverse = _powers(_BASE, n), _powers(pow(_BASE, -1, _WRAP), n)
        self.values = np.random.default_rng(3).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def grams(self, stretch: np.ndarray) -> np.ndarray:
        sums = np.empty(len(stretch) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.values[stretch] * self.powers[: len(stretch)], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * self.inverse[: len(stretch) - GRAM + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


_hasher: list[_Hasher] = []


def suffixes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, position, first and last window of the suffixes that represent a text's windows."""
    if not _hasher:
        _hasher.append(_Hasher())
    data = np.frombuffer(text, np.uint8)
    windows = len(data) - LENGTH + 1
    parts = []
    # Below the limit by a window's reach, so that all positions of a stretch fit into a key.
    step = _STRETCH - 2 * LENGTH
    for begin in range(0, max(windows, 0), step):
        hashes = _hasher[0].grams(data[begin : min(begin + step, windows) + LENGTH - 1])
        least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        reach = 1
        while reach < REACH:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        chosen = (least & _LOW).astype(np.int64)
        change = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
        first = np.concatenate(([0], change))
        last = np.concatenate((change, [len(chosen)])) - 1
        at = chosen[first]
        parts.append((hashes[at].view(np.int64), at + begin, first + begin, last + begin))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _signed(number: int) -> int:
    return number - _WRAP if number >= _WRAP >> 1 else number


def _packed_place(first: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """First window and the suffix's distance from first and last window, in one number."""
    return (first << 18) | (before << 9) | after


def _spans(texts: list[bytes]) -> dict[str, list]:
    made = []
    for text in texts:
        bucket, at, first, last = suffixes(text)
        before, after = at - first, at - last
        digest = xxhash.xxh3_64_intdigest
        context = [
            _signed(digest(text[a : b + LENGTH], seed))
            for a, b, seed in zip(first.tolist(), last.tolist(), (before * 512 + after).tolist())
        ]
        place = _packed_place(first, before, after)
        made.append(
            pa.StructArray.from_arrays(
                [pa.array(bucket), pa.array(context, pa.int64()), pa.array(place)], fields=list(SPAN)
            ).to_pylist()
        )
    return {"spans": made}


_CELL = pa.struct(
    [("bucket", pa.int64()), ("cell", pa.int32()), ("core", pa.int64()), ("left", pa.binary()), ("right", pa.binary()),
     ("low", pa.int32()), ("high", pa.int32()), ("base", pa.int64()), ("known", pa.bool_())]
)


def _cells_of(text: bytes, span: dict) -> list[dict]:
    """The cells of one suffix: windows by distance from it, CELL distances to a cell."""
    first, before, after = span["place"] >> 18, (span["place"] >> 9) & 511, span["place"] & 511
    at = first + before
    made = []
    for cell in range(after // CELL, before // CELL + 1):
        start = at - CELL * cell  # where the core begins
        until = start + LENGTH - CELL + 1
        made.append(
            {
                "bucket": span["bucket"],
                "cell": cell,
                "core": _signed(xxhash.xxh3_64_intdigest(text[start:until])),
                "left": text[max(0, start - CELL + 1) : start],
                "right": text[until : until + CELL - 1],
                "low": max(after - CELL * cell, 0),
                "high": min(before - CELL * cell, CELL - 1),
                "base": start,
                "known": span["known"],
            }
        )
    return made


def _cells(texts: pa.Array, spans: pa.Array) -> pa.Array:
    made = []
    for text, listed in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist()):
        made.append([cell for span in listed for cell in _cells_of(text or b"", span)])
    return pa.array(made, pa.list_(_CELL))


_cells.__annotations__ = {"texts": pa.Array, "spans": pa.Array, "return": pa.Array}

_RESULT = pa.struct(
    [("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())]
)


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Runs of bytes covered by windows, from (first window, last window) pairs."""
    runs: list[list[int]] = []
    for first, last in sorted(spans):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + LENGTH)
        else:
            runs.append([first, last + LENGTH])
    return runs


def _cut_out(texts: pa.Array, spans: pa.Array, *, with_text: bool) -> pa.Array:
    made = []
    for text, listed in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist()):
        text = text or b""
        runs = merged([(s["first"], s["last"]) for s in listed or []])
        kept, at = [], 0
        for begin, end in runs:
            kept.append(text[at:begin])
            at = end
        kept = b"".join([*kept, text[at:]])
        made.append(
            {
                "n_removed": len(text) - len(kept),
                "n_spans": len(runs),
                "kept": kept if with_text else None,
                "kept_sha256": hashlib.sha256(kept).hexdigest(),
            }
        )
    return pa.array(made, _RESULT)


def _ranges(df: DataFrame) -> DataFrame:
    """(document, first window, last window) of packed places."""
    first, before, after = (
        F.shiftright("place", 18), F.shiftright("place", 9).bitwiseAND(F.lit(511)), F.col("place").bitwiseAND(F.lit(511)),
    )
    return df.select("doc", first.alias("first"), (first + before - after).alias("last"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc, first, last): runs of windows of ``docs`` (doc, text) that also start elsewhere."""
    spans = text_udf(_spans, pa.schema([("spans", pa.list_(SPAN))]), "struct<spans: array<struct<bucket: bigint, context: bigint, place: bigint>>>")
    found = docs.where(F.octet_length("text") >= LENGTH).select("doc", spans("text")["spans"].alias("spans"))
    found = found.select("doc", F.inline("spans"))

    # Behind a checkpoint both sides of the join are plain exchanges, which Spark splits where a
    # bucket has very many suffixes.
    buckets = checkpointed(
        found.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), (F.min("context") == F.max("context")).alias("alike"))
        .where("n > 1").select("bucket", "alike")
    )
    shared = stored(found.join(buckets, "bucket"), "suffix-buckets")

    mixed = shared.where("not alike")
    contexts = checkpointed(
        mixed.groupBy("bucket", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "place")).alias("one"))
    )
    settled = shared.where("alike").select("doc", "place").union(_in_company(mixed, contexts))
    return _ranges(settled).union(_refined(docs, contexts))


def _in_company(mixed: DataFrame, contexts: DataFrame) -> DataFrame:
    """(doc, place) of the suffixes that are not alone in their sub-bucket.

    There is at most one large sub-bucket for every ``LARGE`` suffixes: their list is short. Their
    suffixes are found without a shuffle; the others meet their sub-buckets by one.
    """
    key = ["bucket", "context"]
    large = contexts.where(F.col("n") > LARGE).select(*key)
    large = small_side(large, large.count())
    some = contexts.where(F.col("n").between(2, LARGE)).select(*key)
    return (
        mixed.join(large, key, "left_semi").select("doc", "place")
        .union(mixed.join(large, key, "left_anti").join(some, key).select("doc", "place"))
    )


def _refined(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """Repeated windows of the suffixes that are alone in their sub-bucket."""
    listed = contexts.groupBy("one.doc").agg(
        F.collect_list(F.struct("bucket", "one.place", (F.col("n") > 1).alias("known"))).alias("spans")
    )
    cut = F.arrow_udf(
        _cells,
        "array<struct<bucket: bigint, cell: int, core: bigint, left: binary, right: binary, low: int, high: int, base: bigint, known: boolean>>",
    )
    cells = stored(
        docs.join(listed, "doc").select("doc", F.explode(cut("text", "spans")).alias("c")).select("doc", "c.*"), "suffix-cells"
    )
    core, rim = ["bucket", "cell", "core"], ["left", "right", "low", "high"]
    # One row for each different rim; cells that are alone with their core end here.
    rims = cells.groupBy(*core, *rim).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "base", "known")).alias("one")
    )
    cores = rims.groupBy(*core).agg(F.sum("n").alias("together"), F.count(F.lit(1)).alias("different"))
    met = checkpointed(rims.join(cores.where("together > 1"), core))

    first, last = F.col("base") - F.col("high"), F.col("base") - F.col("low")
    whole = (
        cells.where("not known").join(met.where("n > 1").select(*core, *rim), [*core, *rim])
        .select("doc", first.alias("first"), last.alias("last"))
    )
    windows = (
        met.where("different > 1")
        .select(*core, "left", "right", "n", "one", F.explode(F.sequence("low", "high")).alias("at"))
        .select(
            *core, "at", "n", "one",
            F.expr("substring(left, length(left) - at + 1, at)").alias("before"),
            F.expr(f"substring(right, 1, {CELL - 1} - at)").alias("behind"),
        )
    )
    key = [*core, "at", "before", "behind"]
    twice = windows.groupBy(*key).agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    place = F.col("one.base") - F.col("at")
    single = (
        windows.where("n = 1 and not one.known").join(twice, key)
        .select("one.doc", place.alias("first"), place.alias("last"))
    )
    return whole.union(single)


def without_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` with n_bytes, n_removed, n_spans, kept, kept_sha256.

    Removed is every byte covered by a 400-byte string that also starts anywhere else, in the same
    or another document; strings are judged on the input. ``kept`` holds the remaining bytes
    (NULL without ``with_text``). A NULL text counts as empty and keeps 0 bytes; a text below 400
    bytes stays whole. Repeated rows are texts that occur twice, and lose what is long enough. An
    empty table gives an empty result.
    """
    text = F.col(text_col)
    key = F.xxhash64(F.col(id_col).cast("string"), text)
    found = repeated_windows(docs.select(key.alias("doc"), text.cast("string").alias("text")))
    listed = found.groupBy("doc").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    rows = packed(docs, doc=key)

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return _cut_out(texts, spans, with_text=with_text)

    cut.__annotations__ = {"texts": pa.Array, "spans": pa.Array, "return": pa.Array}
    cut_udf = F.arrow_udf(cut, "struct<n_removed: bigint, n_spans: bigint, kept: binary, kept_sha256: string>")
    return (
        rows.join(listed, "doc", "left")
        .select("row", cut_udf(F.col("row")[text_col], F.col("spans")).alias("made"))
        .select("row", F.coalesce(F.octet_length(F.col("row")[text_col]), F.lit(0)).cast("bigint").alias("n_bytes"), "made.*")
    )
