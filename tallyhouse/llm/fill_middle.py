"""Fill-in-the-middle: a text is cut into prefix, middle and suffix, and set in another order.

A unit is a word with the white space before it, or the white space at the end of a text. One
pattern, ``(unit)*``, is matched against a whole text by a matcher that keeps every repetition of
a group; the list of their ends gives the number of units and the places of both cuts. Only these
numbers come back from Python. Texts are cut and put together by Spark functions, and so are
texts restored.

The draws h1 to h4 are parts of a SHA-256 of seed and id, so a document is always cut alike. The
cuts are drawn from all unit borders, so any part may be empty. There is no shuffle. The matcher
holds some 250 bytes a unit while it runs, so a text of over ``BLOCK`` characters is matched block
by block, each ending where a unit ends; the units and their ends are the same.

Edge cases: a NULL or empty text has no unit and stays plain, and its output is empty; a text of
white space alone is one unit; a text that contains a sentinel stays plain; rows with equal id and
text are cut alike; a NULL id counts as an empty one; an empty table gives an empty table; columns
of the input travel in the struct ``row`` and cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import packed

# The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SEED = 42
FIM_PERCENT = 50  # of texts that are transformed
SPM_PERCENT = 80  # of these, suffix first

BLOCK = 1 << 21

# Fixed value: the unit. Possessive inside, as no character given back is of any use.
_UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*")
_WORD_END = regex.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")

_CUTS = pa.struct([("n", pa.int64()), ("first", pa.int64()), ("second", pa.int64())])


def unit_ends(text: str, block: int = BLOCK) -> list[int]:
    """Where each unit of a text ends, in characters."""
    ends, start = [], 0
    while len(text) - start > block:
        border = _WORD_END.search(text, start + block)
        if not border:
            break
        ends += _UNITS.fullmatch(text, start, border.end()).ends(1)
        start = border.end()
    return ends + _UNITS.fullmatch(text, start).ends(1)


def cuts_of(text: str, one: int, other: int) -> tuple[int, int, int]:
    """Units of a text, and the characters before the lower and the higher of two drawn cuts."""
    ends = unit_ends(text)
    n = len(ends)
    low, high = sorted((one % (n + 1), other % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def _cut_texts(texts: pa.Array, ones: pa.Array, others: pa.Array) -> pa.Array:
    made = np.empty((len(texts), 3), np.int64)
    for i in range(len(texts)):  # one text at a time is held as a Python string
        made[i] = cuts_of(texts[i].as_py() or "", ones[i].as_py(), others[i].as_py())
    return pa.StructArray.from_arrays([pa.array(made[:, k]) for k in range(3)], fields=list(_CUTS))


_cut_texts.__annotations__ = {"texts": pa.Array, "ones": pa.Array, "others": pa.Array, "return": pa.Array}


def draws(id_column: Column | str, seed: int = SEED) -> list[Column]:
    """The first four groups of eight hex digits of the SHA-256 of ``seed:id``, as numbers."""
    name = F.col(id_column) if isinstance(id_column, str) else id_column
    name = F.coalesce(name.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def _part(text: str, first: Column, length: Column) -> Column:
    return F.substring(F.col(text), first.cast("int"), length.cast("int"))


def transform(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED,
    fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """Every document with ``n`` units, its ``form`` (plain, psm or spm), the characters of prefix and
    middle (NULL if plain) and the ``output`` text; the document itself is in ``row``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    h1, h2, h3, h4 = draws(id_column, seed)
    drawn = packed(docs, text=text, h1=h1, h2=h2, h3=h3, h4=h4)
    cut = F.arrow_udf(_cut_texts, "n bigint, first bigint, second bigint").asNondeterministic()
    cut = drawn.select("*", cut("text", "h1", "h2").alias("cut"))
    marked = (F.col("text") == "") | F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = (
        F.when(marked | (F.pmod("h3", F.lit(100)) >= fim_percent), "plain")
        .when(F.pmod("h4", F.lit(100)) < spm_percent, "spm")
        .otherwise("psm")
    )
    first, second = F.col("cut.first"), F.col("cut.second")
    prefix = _part("text", F.lit(1), first)
    middle = _part("text", first + 1, second - first)
    suffix = _part("text", second + 1, F.char_length("text") - second)
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.col("text"))
    )
    turned = F.col("form") != "plain"
    return cut.select("*", form.alias("form")).select(
        "row",
        F.col("cut.n").alias("n"),
        "form",
        F.when(turned, first).alias("prefix_chars"),
        F.when(turned, second - first).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output of this form was made of.

    A text with a sentinel is never turned, and a sentinel can neither begin inside a part and end
    in the next sentinel nor begin inside a sentinel, so the first of each is the one that was set.
    """
    text, size = F.col(output), len(PREFIX)
    at = {mark: F.locate(mark, text) for mark in (PREFIX, SUFFIX, MIDDLE)}

    def between(left: str, right: str | None) -> Column:
        start = at[left] + size
        end = at[right] if right else F.char_length(text) + 1
        return F.substring(text, start, end - start)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(text)
