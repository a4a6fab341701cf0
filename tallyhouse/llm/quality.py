"""Quality rules from compression: zstandard ratios over whole documents and fixed chunks.

Text that compresses far better than prose is repetitive, text that hardly compresses is
random. Both limits depend on length, since short texts give the compressor little to work
on: each ``Band`` holds the least and greatest ratio for texts below a length.

The bands are wide enough for any script. Inside them each language has a curve of its own: the
usual ratio at each length and how far ratios stray from it, taken from all documents. A text whose
ratio is more than ``MOST_SPREADS`` above the curve is repetitive, too. Documents are counted in
cells of length and ratio by language in one grouped pass, and the curve is fitted to the cells in
rounds that leave out what lies far off, so junk does not bend it. No label is used. Without
``LEAST_FIT`` texts of a language its curve is that of all, and without so many in all there is none.

Edge cases: NULL and empty texts have no words and fail the base rule; very long texts are
compressed whole, and the curve goes on beyond the longest ones as it ends; each text is judged by
itself and the curves, so repeated rows and ties get equal verdicts; an empty table gives an empty
table; columns of the input travel in the struct ``row`` and cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import BLANKS, packed, stored, text_udf

SYMBOLS = b"#*$%&|<>"
_ASCII = bytes(range(128))


@dataclass(frozen=True)
class Band:
    """Texts of fewer than ``below`` bytes need a ratio from ``least`` to ``most``."""

    below: float
    least: float
    most: float


# Prose in alphabetic scripts compresses 1.3 to 1.8 times at 300 bytes, 1.6 to 2.2 at 1.5 KB,
# 1.95 to 2.6 at 4 to 16 KB and 2.2 to 3.3 beyond. At any length from 4 KB base64 stays near 1.3,
# random letters of both cases near 1.4, lower-case letters with digits near 1.5 and lower-case
# letters alone near 1.68; below 4 KB the last two are not told from prose. Repeated phrases and
# boilerplate reach 5 to several hundred.
DOCUMENT_BANDS = (
    Band(256, 0.0, 3.0),
    Band(512, 1.1, 3.2),
    Band(1024, 1.25, 3.6),
    Band(4096, 1.4, 4.0),
    Band(16_384, 1.8, 4.5),
    Band(65_536, 1.8, 5.0),
    Band(float("inf"), 1.8, 6.0),
)
# Chunks of clean English, German, Spanish and French texts compress 1.74 times or more.
CHUNK_BAND = Band(4097, 1.7, 4.0)
# Scripts of several bytes a character hold more in a character and may compress less: texts in
# which over half of the bytes are not ASCII need no more than these ratios.
WIDE_SCRIPT_LEAST = 1.5
WIDE_SCRIPT_CHUNK_LEAST = 1.3
CHUNK_BYTES = 4096
LEAST_CHUNK = 1024
MOST_BAD_CHUNKS = 0.3

# The curve: straight pieces between lengths of 2^9, 2^10 ... bytes, in the logarithm of the ratio.
MOST_SPREADS = 3.5
LEAST_FIT = 50
LEAST_BYTES = 256  # shorter texts follow no curve
MOST_LANGUAGES = 100  # the largest ones; the others share the curve of all
_KNOTS = np.arange(9, 21)
_LEAST_SPREAD = 0.012
_BEND = 1.0  # what a bend of the curve costs, in texts
_LENGTH_CELLS, _RATIO_CELLS = 8, 100  # by doubling of the length, by unit of the logarithm
_MOST_LENGTH, _MOST_RATIO = 20.0, 2.0  # a bounded number of cells

_FIELDS = [
    ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
    ("n_repeat_words", "bigint"), ("ratio", "double"), ("excess", "double"), ("bad_chunk_share", "double"),
    ("base_failed", "boolean"), ("reason", "string"), ("kept", "boolean"),
]
_ARROW = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}
SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in _FIELDS])
DDL = "struct<" + ", ".join(f"{name}: {kind}" for name, kind in _FIELDS) + ">"


def repeated_words(words: Sequence[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text, first ones included."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    number = count()
    ids = np.fromiter((seen[w] if w in seen else seen.setdefault(w, next(number)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 2_000_000:  # three ids would not fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(seen) + ids[2:]
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = times[place] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _wide_script(text: bytes) -> bool:
    """Over half of the bytes are not ASCII."""
    return 2 * len(text.translate(None, _ASCII)) > len(text)


def compression(text: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, float]:
    """Ratio of the whole text, and the share of its bytes in chunks outside the chunk band.

    A last chunk below ``LEAST_CHUNK`` bytes says too little and is not judged alone.
    """
    if not text:
        return 0.0, 0.0
    least = min(CHUNK_BAND.least, WIDE_SCRIPT_CHUNK_LEAST) if _wide_script(text) else CHUNK_BAND.least
    whole = len(text) / len(compressor.compress(text))
    if len(text) <= CHUNK_BYTES:
        return whole, 0.0
    bad = judged = 0
    for start in range(0, len(text), CHUNK_BYTES):
        chunk = text[start : start + CHUNK_BYTES]
        if len(chunk) >= LEAST_CHUNK:
            judged += len(chunk)
            if not least <= len(chunk) / len(compressor.compress(chunk)) <= CHUNK_BAND.most:
                bad += len(chunk)
    return whole, bad / judged


def _basis(lengths: np.ndarray) -> np.ndarray:
    """The straight pieces at some lengths (as powers of two)."""
    lengths = lengths[:, None]
    return np.concatenate([np.ones_like(lengths), lengths - _KNOTS[0], np.maximum(lengths - _KNOTS[1:], 0)], axis=1)


@dataclass(frozen=True)
class Curve:
    """The usual logarithm of the ratio by length, and the usual distance from it."""

    pieces: np.ndarray
    spread: np.ndarray

    @classmethod
    def fit(cls, lengths: np.ndarray, ratios: np.ndarray, counts: np.ndarray) -> Curve:
        basis, line = _basis(lengths), np.stack([np.ones_like(lengths), lengths], axis=1)
        bends = np.diag([1e-9, 1e-9] + [_BEND] * (len(_KNOTS) - 1))
        weights = counts.astype(float)
        for _ in range(6):
            pieces = np.linalg.solve((basis * weights[:, None]).T @ basis + bends, (basis * weights[:, None]).T @ ratios)
            off = np.abs(ratios - basis @ pieces)
            root = np.sqrt(weights)
            made = cls(pieces, np.linalg.lstsq(line * root[:, None], off * root, rcond=None)[0])
            weights = counts * (off < 3 * made.spreads(lengths))
        return made

    def spreads(self, lengths: np.ndarray) -> np.ndarray:
        """The standard deviation of ratios at these lengths, from the mean distance."""
        return np.maximum(self.spread[0] + self.spread[1] * lengths, _LEAST_SPREAD) * np.sqrt(np.pi / 2)

    def excess(self, n_bytes: int, ratio: float) -> float:
        """How many spreads a ratio lies above the curve."""
        length = np.log2([n_bytes])
        return float(((np.log(ratio) - _basis(length) @ self.pieces) / self.spreads(length))[0])


def _sizes(texts: list[bytes]) -> dict[str, list]:
    compressor = zstandard.ZstdCompressor(level=3)
    return {"whole": [len(t) for t in texts], "packed": [len(compressor.compress(t)) for t in texts]}


def _language(lang_col: str | None) -> F.Column:
    return F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col else F.lit("")


def curves(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> dict[str | None, Curve]:
    """The curve of each language with enough texts, and that of all (None).

    A language has at most some 20,000 cells, however many texts it has, and ``MOST_LANGUAGES`` of
    them come to the driver.
    """
    schema = pa.schema([("whole", pa.int64()), ("packed", pa.int64())])
    sizes = docs.select(_language(lang_col).alias("lang"), F.col(text_col).alias("text")).select(
        "lang", text_udf(_sizes, schema, "struct<whole: bigint, packed: bigint>")("text").alias("size")
    )
    length, ratio = F.log2("size.whole"), F.log(F.col("size.whole") / F.col("size.packed"))
    cells = sizes.where(F.col("size.whole") >= LEAST_BYTES).groupBy(
        "lang",
        F.floor(F.least(length, F.lit(_MOST_LENGTH)) * _LENGTH_CELLS).alias("length"),
        F.floor(F.least(F.greatest(ratio, F.lit(0.0)), F.lit(_MOST_RATIO)) * _RATIO_CELLS).alias("ratio"),
    ).agg(F.count(F.lit(1)).alias("n"))
    cells = stored(cells, "ratio-cells")
    largest = cells.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    named = [r["lang"] for r in largest if r["n"] >= LEAST_FIT]
    groups = {None: cells.groupBy("length", "ratio").agg(F.sum("n").alias("n")).collect()}
    for r in cells.where(F.col("lang").isin(named)).collect() if named else []:
        groups.setdefault(r["lang"], []).append(r)
    return {lang: _fitted(rows) for lang, rows in groups.items() if sum(r["n"] for r in rows) >= LEAST_FIT}


def _fitted(rows: list) -> Curve:
    cells = np.array(sorted((r["length"], r["ratio"], r["n"]) for r in rows), float)
    return Curve.fit((cells[:, 0] + 0.5) / _LENGTH_CELLS, (cells[:, 1] + 0.5) / _RATIO_CELLS, cells[:, 2])


def _judge(texts: list[bytes], langs: list[str], known: dict[str | None, Curve]) -> dict[str, list]:
    compressor = zstandard.ZstdCompressor(level=3)
    made: dict[str, list] = {name: [] for name, _ in _FIELDS}
    for text, lang in zip(texts, langs):
        words = text.split()
        n = len(words)
        repeats = repeated_words(words)
        ratio, bad = compression(text, compressor)
        band = next(b for b in DOCUMENT_BANDS if len(text) < b.below)
        base_failed = n < 50 or 100 * repeats > 50 * n
        curve = known.get(lang, known.get(None)) if len(text) >= LEAST_BYTES else None
        excess = curve.excess(len(text), ratio) if curve else None
        if base_failed:
            reason = "base"
        elif ratio > band.most or excess is not None and excess > MOST_SPREADS:
            reason = "repetitive"
        elif ratio < (min(band.least, WIDE_SCRIPT_LEAST) if _wide_script(text) else band.least):
            reason = "incompressible"
        else:
            reason = "chunks" if bad > MOST_BAD_CHUNKS else None
        values = (
            n,
            len(text.translate(None, BLANKS).decode("utf-8", "replace")),
            len(text) - len(text.translate(None, SYMBOLS)),
            repeated_lines(text),
            repeats,
            ratio,
            excess,
            bad,
            base_failed,
            reason,
            reason is None,
        )
        for (name, _), value in zip(_FIELDS, values):
            made[name].append(value)
    return made


def judge(
    docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", known: dict[str | None, Curve] | None = None
) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` beside the struct ``quality``.

    Two passes without a shuffle of documents: the curves (unless they are given), then the verdicts.
    Without a column ``lang_col`` there is one curve for all.
    """
    lang_col = lang_col if lang_col in docs.columns else None
    known = curves(docs, text_col, lang_col) if known is None else known

    def run(texts: pa.Array, langs: pa.Array) -> pa.Array:
        made = _judge([x or b"" for x in texts.cast(pa.binary()).to_pylist()], langs.to_pylist(), known)
        return pa.StructArray.from_arrays([pa.array(made[f.name], f.type) for f in SCHEMA], fields=list(SCHEMA))

    run.__annotations__ = {"texts": pa.Array, "langs": pa.Array, "return": pa.Array}
    return packed(docs, quality=F.arrow_udf(run, DDL).asNondeterministic()(F.col(text_col), _language(lang_col)))


def passing(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """The rows of ``docs`` that pass the rules, with their own columns."""
    return judge(docs, text_col, lang_col).where("quality.kept").select("row.*")
