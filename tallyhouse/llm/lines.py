"""Remove multi-line chunks that repeat across a corpus.

Lines with words are hashed, and a rolling hash over the last ``WINDOW`` of these hashes says whether
a line may end a chunk: it does unless the hash is divisible by ``DIVISOR``. A chunk begins at every
line with words and ends at the first line, the second at least, that may end one (the last line of
a text and the ``MOST_LINES``-th of a chunk always do). So both ends depend on the lines inside the
chunk alone: a passage that stands between other lines, or has moved, has the same chunks. All
passages of ``MOST_LINES`` lines hold one, and 63 in 64 of those of two lines.

A chunk that occurs a second time, in any document, is repeated; its first occurrence by (id, place in
the text) stays. A line goes if it lies in a later occurrence of a chunk and in no first one.

Steps, all of Spark functions: (1) chunk hashes without texts are counted, after partial sums in
the tasks, so a chunk that a third of all documents share arrives as one row per task; (2) hashes
found twice are joined back to the light rows and listed per document, a list never longer than
the document; (3) documents meet their lists in the one shuffle of the texts, and the outcome is
stored; (4) the bytes of all chunks under one hash are compared by their least and greatest text.
Chunks under a hash that stands for different bytes are grouped by their bytes instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import checkpointed, packed, stored

WINDOW = 2
BASE = 31
DIVISOR = 64
LEAST_LINES = 2
MOST_LINES = 16


def _fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns behind a generator, which keeps the optimizer from copying their
    expressions into the lambdas that use them."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline_outer(F.array(made)))


def line_hash(line: Column) -> Column:
    """32 bits of a line's MD5 as a number."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")


def _chunks(rows: DataFrame, text: Column) -> DataFrame:
    """Add the array ``chunks`` (first line, number of lines, text), lines counted from 1."""
    rows = _fixed(rows, lines=F.split(F.coalesce(text, F.lit("")), "\n", -1))
    filled = F.filter(
        F.transform("lines", lambda line, i: F.struct((i + 1).alias("at"), line_hash(line).alias("hash"), (F.trim(line) != "").alias("filled"))),
        lambda line: line["filled"],
    )
    rows = _fixed(rows, places=F.transform(filled, lambda x: x["at"]), hashes=F.transform(filled, lambda x: x["hash"]))
    last = F.size("places") - 1

    def may_end(k: Column) -> Column:
        rolling = sum((F.coalesce(F.get("hashes", k - back), F.lit(0)) * BASE**back for back in range(WINDOW)), F.lit(0).cast("bigint"))
        return (F.pmod(rolling, F.lit(DIVISOR)) != 0) | (k == last)

    rows = _fixed(rows, ends=F.transform("places", lambda _, k: may_end(k)))

    def chunk(start: Column) -> Column:
        latest = F.least(start + MOST_LINES - 1, last)
        ending = F.filter(F.sequence(start + LEAST_LINES - 1, latest), lambda k: F.get("ends", k))
        end = F.coalesce(F.get(ending, F.lit(0)), latest)
        first, until = F.get("places", start), F.get("places", end)
        return F.struct(first.alias("first"), (until - first + 1).alias("n"))

    starts = F.when(last >= LEAST_LINES - 1, F.sequence(F.lit(0), last - LEAST_LINES + 1))
    rows = _fixed(rows, spans=F.transform(starts, chunk))
    return rows.withColumn(
        "chunks",
        F.transform(
            "spans",
            lambda c: F.struct(c["first"].alias("first"), c["n"].alias("n"), F.array_join(F.slice("lines", c["first"], c["n"]), "\n").alias("text")),
        ),
    )


def _covered(found: Column) -> Column:
    """The numbers of all lines in listed chunks."""
    return F.flatten(F.transform(found, lambda c: F.sequence(c["first"], c["first"] + c["n"] - 1)))


def remove_repeated_chunks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row`` with kept_text, n_lines, n_removed_lines and n_removed_chunks,
    the number of removed runs of lines.

    A NULL text stays NULL and an empty one empty; one line alone is never found. Very long texts are
    cut whole; the work grows with their lines. Rows without
    an id come last in the order of occurrences, rows with the same id in that of a text hash;
    rows with the same id and text are treated alike, so repeated rows keep the same chunks. A
    text may end up empty. An empty table gives an empty result.
    """
    key = {"id": F.col(id_col), "text_hash": F.xxhash64(text_col)}
    cut = _chunks(docs.select(F.col(text_col).alias("text"), *[c.alias(n) for n, c in key.items()]), F.col("text"))
    places = cut.select("id", "text_hash", F.inline("chunks")).select(
        "id", "text_hash", F.col("first").cast("int"), F.col("n").cast("int"), F.xxhash64("text").alias("chunk")
    )
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "first")
    # Behind a checkpoint both sides of the join are plain exchanges, which Spark splits where a
    # chunk has very many rows.
    repeated = checkpointed(
        places.groupBy("chunk").agg(F.count(F.lit(1)).alias("times"), F.min(order).alias("keeper"))
        .where("times > 1").drop("times")
    )
    listed = (
        places.join(repeated, "chunk")
        .groupBy("id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.struct("first", "n", "chunk", (order == F.col("keeper")).alias("stays")))).alias("found"))
    )
    rows = packed(docs, **key)
    met = (rows["text_hash"] == listed["text_hash"]) & rows["id"].eqNullSafe(listed["id"])
    rows = stored(rows.join(listed, met, "left").select("row", rows["id"], rows["text_hash"], "found"), "line-chunks")

    text = F.col("row")[text_col]
    mixed = _unequal(rows, text)
    if not mixed.isEmpty():
        rows = _by_bytes(rows, text, mixed)
    later, first = F.filter("found", lambda c: ~c["stays"]), F.filter("found", lambda c: c["stays"])
    rows = _fixed(
        rows,
        lines=F.split(text, "\n", -1),
        gone=F.coalesce(F.sort_array(F.array_except(_covered(later), _covered(first))), F.array().cast("array<int>")),
    )
    left = F.array_except(F.sequence(F.lit(1), F.size("lines")), F.col("gone"))
    return rows.select(
        "row",
        F.when(F.size("gone") == 0, text)
        .otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i - 1)), "\n"))
        .alias("kept_text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.size("gone").cast("bigint").alias("n_removed_lines"),
        F.size(F.filter("gone", lambda line, k: (k == 0) | (F.get("gone", k - 1) != line - 1))).cast("bigint").alias("n_removed_chunks"),
    )


def _found_texts(rows: DataFrame, text: Column) -> DataFrame:
    """The bytes of every listed chunk."""
    rows = _fixed(rows.where("found is not null"), lines=F.split(text, "\n", -1))
    return rows.select("id", "text_hash", "lines", F.inline("found")).select(
        "id", "text_hash", "first", "n", "chunk", F.array_join(F.slice("lines", F.col("first"), F.col("n")), "\n").alias("bytes")
    )


def _unequal(rows: DataFrame, text: Column) -> DataFrame:
    """Chunk hashes that stand for different bytes; there should be none."""
    return (
        _found_texts(rows, text).groupBy("chunk").agg(F.min("bytes").alias("least"), F.max("bytes").alias("most"))
        .where("least <> most").select("chunk")
    )


def _by_bytes(rows: DataFrame, text: Column, mixed: DataFrame) -> DataFrame:
    """Decide chunks under ambiguous hashes again, by their bytes."""
    chunks = _found_texts(rows, text).join(mixed, "chunk")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "first")
    first = chunks.groupBy("chunk", "bytes").agg(F.min(order).alias("keeper"))
    stay = (
        chunks.join(first, ["chunk", "bytes"]).where(order == F.col("keeper"))
        .groupBy("id", "text_hash").agg(F.collect_set("first").alias("staying"))
    )
    again = chunks.groupBy("id", "text_hash").agg(F.collect_set("first").alias("judged")).join(
        stay.withColumnRenamed("id", "sid").withColumnRenamed("text_hash", "shash"),
        (F.col("text_hash") == F.col("shash")) & F.col("id").eqNullSafe(F.col("sid")), "left",
    ).select(F.col("id").alias("aid"), F.col("text_hash").alias("ahash"), "judged", F.coalesce("staying", F.array().cast("array<int>")).alias("staying"))
    joined = rows.join(again, (F.col("text_hash") == F.col("ahash")) & F.col("id").eqNullSafe(F.col("aid")), "left")
    decided = F.transform(
        "found",
        lambda c: F.struct(
            c["first"].alias("first"), c["n"].alias("n"), c["chunk"].alias("chunk"),
            F.when(F.coalesce(F.array_contains("judged", c["first"]), F.lit(False)), F.array_contains("staying", c["first"]))
            .otherwise(c["stays"]).alias("stays"),
        ),
    )
    return joined.select("row", "id", "text_hash", decided.alias("found"))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks taken out of the text; columns and rows stay."""
    made = remove_repeated_chunks(docs, id_col=id_col, text_col=text_col)
    return made.select(
        *[F.col("kept_text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    )
