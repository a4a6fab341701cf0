"""Language identification by character language models, one for each language.

A text becomes a row of symbols: letters (lower-cased) and the marks on them, and one blank for
whatever else stands between. A symbol has 12 bits (code points beyond are folded), so a gram of
up to five symbols is one number: its low bits are the shorter grams that end it, its high bits
the context before its last symbol. Grams are kept as sorted arrays of these numbers and looked up
by binary search, all distinct grams of many texts at once.

Learning: Spark counts the five-symbol grams of every document that may be learned from, by
language; that table grows with the corpus and stays distributed. Up to ``MODEL_GRAMS`` of them, for
all languages together, are held in the driver and the tasks as models. If there are more, none is
left out: the probabilities are joins with the whole table, order by order. Those of the most
frequent grams are sent to the tasks; the other grams of the texts meet theirs by a shuffle.
From the counts come interpolated Kneser-Ney probabilities: absolute discounts by order (from the counts
of grams seen once and twice), and below the highest order the number of different symbols before
a gram in place of its count; the lowest order is mixed with an even distribution.

Choosing: the language with the least cross-entropy by symbol; ties go to the first by name. A
score is the softmax of the negative cross-entropies at a temperature, which is fitted, like the
limits of rejection, to at most ``CALIBRATION_DOCS`` documents of each language from one fold, under
models that have not counted that fold. A text is rejected if its cross-entropy is above what the
language's own texts reach, or its score below the least one that was right in 99 of 100 cases.

Edge cases: a text that is NULL, empty or without a letter is ``und`` with score 0, and rejected; so
is every text if nothing could be learned. Very long texts are read whole, in blocks of ``BLOCK``
characters that start afresh. Rows without id or language are predicted and not learned from
(without an id the fold is unknown). Repeated rows count as often as they stand there. An empty
table gives an empty table. Columns of the input travel in the struct ``row`` and cannot clash.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import packed, stored, text_udf

ORDER = 5
SYMBOL_BITS = 12
MODEL_GRAMS = 1_000_000
CALIBRATION_DOCS = 400
BLOCK = 1 << 21
FOLDS = 5
UNKNOWN = "und"

_SYMBOLS = 1 << SYMBOL_BITS
_KNOWN_POINTS = 0x20000  # code points up to here are looked up; beyond, letters are asked one by one
_MERGE_GRAMS = 1_000_000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The symbol of every code point (0: none), and which code points are letters."""
    symbols, letters = np.zeros(_KNOWN_POINTS, np.uint16), np.zeros(_KNOWN_POINTS, bool)
    for point in range(_KNOWN_POINTS):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LM":
            low = ord(chr(point).lower()[0])
            symbols[point] = low if low < _SYMBOLS else 1 + low % (_SYMBOLS - 1)
            letters[point] = kind == "L"
    return symbols, letters


class Reader:
    """Texts as rows of symbols and grams."""

    def __init__(self):
        self.symbols, self.letters = _tables()

    def _points(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        high = points >= _KNOWN_POINTS
        safe = np.where(high, 0, points)
        symbols, letters = self.symbols[safe], self.letters[safe]
        if high.any():
            asked = np.unique(points[high])
            known = np.array([chr(p).isalpha() for p in asked])
            far = known[np.searchsorted(asked, points[high])]
            symbols[high] = np.where(far, 1 + points[high] % (_SYMBOLS - 1), 0)
            letters[high] = far
        return symbols, letters

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The gram that ends at every symbol of the texts, the place of its text, and for each text
        whether it has a letter. Before a text stand blanks."""
        lengths = np.array([len(t) for t in texts], np.int64)
        symbols, letters = self._points("".join(texts))
        owner = np.repeat(np.arange(len(texts)), lengths)
        lettered = np.bincount(owner[letters], minlength=len(texts)) > 0
        before = np.empty_like(symbols)
        before[1:] = symbols[:-1]
        before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
        kept = (symbols != 0) | (before != 0)
        symbols, owner = symbols[kept], owner[kept]
        counts = np.bincount(owner, minlength=len(texts))
        place = np.arange(len(symbols)) - np.repeat(np.cumsum(counts) - counts, counts)
        grams = symbols.astype(np.uint64)
        for back in range(1, ORDER):
            earlier = np.zeros(len(symbols), np.uint64)
            earlier[back:] = symbols[:-back] if back < len(symbols) else 0
            earlier[place < back] = 0
            grams |= earlier << np.uint64(SYMBOL_BITS * back)
        return grams, owner, lettered


def _blocks(texts: Iterable[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts and parts of long ones in groups of about ``BLOCK`` characters, with their places."""
    places, parts, size = [], [], 0
    for place, text in enumerate(texts):
        for start in range(0, len(text) or 1, BLOCK):
            part = text[start : start + BLOCK]
            if parts and size + len(part) > BLOCK:
                yield places, parts
                places, parts, size = [], [], 0
            places.append(place)
            parts.append(part)
            size += len(part)
    if parts:
        yield places, parts


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys of several lists made one, with the sum of their counts."""
    both = np.concatenate(keys)
    unique, place = np.unique(both, return_inverse=True)
    return unique, np.bincount(place, np.concatenate(counts), len(unique)).astype(np.int64)


# Models


@dataclass
class Level:
    """One order: grams with their discounted share, contexts with the weight of the next order."""

    grams: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


@dataclass
class LanguageModel:
    """Interpolated Kneser-Ney over sorted arrays, lowest order first."""

    levels: list[Level]

    @classmethod
    def of(cls, grams: np.ndarray, counts: np.ndarray) -> LanguageModel:
        """From the sorted grams of the highest order and their counts."""
        levels = []
        for order in range(ORDER, 0, -1):
            levels.insert(0, _level(grams, counts))
            if order > 1:
                # Different symbols before a shorter gram: the longer grams that end in it.
                grams, counts = np.unique(grams & np.uint64((1 << SYMBOL_BITS * (order - 1)) - 1), return_counts=True)
        return cls(levels)

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Of the last symbol of each gram behind the symbols before it."""
        found = np.full(len(grams), 1.0 / _SYMBOLS)
        for order, level in enumerate(self.levels, 1):
            ends = grams & np.uint64((1 << SYMBOL_BITS * order) - 1)
            share = _looked_up(level.grams, level.shares, ends, 0.0)
            weight = _looked_up(level.contexts, level.weights, ends >> np.uint64(SYMBOL_BITS), 1.0)
            found = share + weight * found
        return np.log(found)


def _level(grams: np.ndarray, counts: np.ndarray) -> Level:
    once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
    discount = once / (once + 2 * twice) if once and twice else 0.75
    contexts, first, kinds = np.unique(grams >> np.uint64(SYMBOL_BITS), return_index=True, return_counts=True)
    totals = np.add.reduceat(counts, first)
    shares = (counts - discount) / np.repeat(totals, kinds)
    return Level(grams, shares.astype(np.float32), contexts, (discount * kinds / totals).astype(np.float32))


def _looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, default: float) -> np.ndarray:
    place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[place] == asked, values[place], default)


@dataclass
class Identifier:
    """The models by language (names in order) and the calibration of score and rejection."""

    models: dict[str, LanguageModel]
    sharpness: float = 10.0
    least_score: float = 0.0
    limits: dict[str, float] = field(default_factory=dict)
    counts: DataFrame | None = None  # (lang, gram, n) of all grams, if the models do not hold them all

    def entropies(self, texts: list[str], reader: Reader) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy by symbol of every text under every model, and which texts have a letter."""
        sums = np.zeros((len(texts), len(self.models)))
        sizes, lettered = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for places, parts in _blocks(texts):
            grams, owner, letters = reader.grams(parts)
            np.logical_or.at(lettered, places, letters)
            if not len(grams):
                continue
            unique, place = np.unique(grams, return_inverse=True)
            np.add.at(sizes, places, np.bincount(owner, minlength=len(parts)))
            for column, model in enumerate(self.models.values()):
                found = model.log_probabilities(unique)[place]
                np.add.at(sums[:, column], places, np.bincount(owner, found, len(parts)))
        return -sums / np.maximum(sizes, 1)[:, None], lettered

    def scores(self, entropies: np.ndarray) -> np.ndarray:
        """Softmax of the negative cross-entropies at the calibrated temperature."""
        raised = np.exp(-self.sharpness * (entropies - entropies.min(axis=1, keepdims=True)))
        return raised / raised.sum(axis=1, keepdims=True)

    def choose(self, texts: list[str], reader: Reader) -> dict[str, list]:
        if not self.models:
            nothing = [None] * len(texts)
            return {"lang": [UNKNOWN] * len(texts), "score": [0.0] * len(texts), "cross_entropy": nothing,
                    "rejected": [True] * len(texts)}
        return self.chosen(*self.entropies(texts, reader))

    def chosen(self, entropies: np.ndarray, lettered: np.ndarray) -> dict[str, list]:
        names, best = list(self.models), entropies.argmin(axis=1)
        least, score = entropies.min(axis=1), self.scores(entropies).max(axis=1)
        limits = np.array([self.limits.get(name, np.inf) for name in names])
        rejected = ~lettered | (least > limits[best]) | (score < self.least_score)
        return {
            "lang": [names[b] if x else UNKNOWN for b, x in zip(best, lettered)],
            "score": np.where(lettered, score, 0.0).tolist(),
            "cross_entropy": [float(e) if x else None for e, x in zip(least, lettered)],
            "rejected": rejected.tolist(),
        }


def calibrate(made: Identifier, entropies: np.ndarray, truth: np.ndarray) -> None:
    """Fit temperature and limits to cross-entropies of texts whose language (a place) is known."""
    if not len(truth):
        return
    # The temperature with the greatest likelihood, on a fixed grid; ties to the lower one.
    rows = np.arange(len(truth))

    def loss(sharpness: float) -> float:
        logits = -sharpness * (entropies - entropies.min(axis=1, keepdims=True))
        return float(np.mean(np.log(np.exp(logits).sum(axis=1)) - logits[rows, truth]))

    made.sharpness = min(np.geomspace(1, 200, 60), key=loss)
    for place, name in enumerate(made.models):
        own = entropies[truth == place, place]
        if len(own):
            high = np.quantile(own, 0.995)
            made.limits[name] = float(high + 0.1 * (high - own.mean()))
    score, right = made.scores(entropies).max(axis=1), entropies.argmin(axis=1) == truth
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= 0.99)
    made.least_score = float(score[order[good[-1]]]) if len(good) else 1.0


# Spark


def fold(id_column: str = "doc_id") -> F.Column:
    """CRC32 of the id as text, modulo ``FOLDS``; NULL without an id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(FOLDS))


def held_out(id_column: str = "doc_id") -> F.Column:
    """Whether a document is kept from learning; one without an id is not learned from either."""
    return F.coalesce(fold(id_column) == 0, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, counted, late): grams of the texts of one task by language; ``late`` are those
    from the fold that calibrates."""
    reader = Reader()
    held: dict[tuple[str, bool], list] = {}

    def out(key):
        lang, late = key
        grams, counts = _merged(*held.pop(key))
        n = len(grams)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))), pa.array(grams.astype(np.int64)),
             pa.array(counts), pa.array(counts if late else np.zeros(n, np.int64))],
            names=["lang", "gram", "counted", "late"],
        )

    for batch in batches:
        langs, lates, texts = (batch.column(i) for i in range(3))
        names = langs.to_pylist()
        late = lates.to_pylist()
        for key in sorted(set(zip(names, late))):
            own = [texts[i].as_py() or "" for i in range(len(batch)) if (names[i], late[i]) == key]
            for _, parts in _blocks(own):
                grams = np.unique(reader.grams(parts)[0], return_counts=True)
                keys, counts = held.setdefault(key, ([], []))
                keys.append(grams[0])
                counts.append(grams[1])
                if sum(map(len, keys)) > _MERGE_GRAMS:
                    merged = _merged(keys, counts)
                    held[key] = ([merged[0]], [merged[1]])
                    if len(merged[0]) > _MERGE_GRAMS // 2:
                        yield out(key)
    for key in list(held):
        if sum(map(len, held[key][0])):
            yield out(key)


def gram_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, counted, late) over all documents that may be learned from. Grams are summed in
    the tasks first, so a language that holds most rows is one partial count a task and gram."""
    known = docs.select(
        F.col(lang_col).cast("string").alias("lang"), (fold(id_col) == 1).alias("late"), F.col(text_col).alias("text")
    ).where(F.col("lang").isNotNull() & (fold(id_col) != 0))
    parts = known.mapInArrow(_counted, "lang string, gram bigint, counted bigint, late bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("counted").alias("counted"), F.sum("late").alias("late"))


def learn(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    model_grams: int = MODEL_GRAMS,
    calibration_docs: int = CALIBRATION_DOCS,
) -> Identifier:
    """Models of the languages of the documents that are not held out, with their calibration."""
    counts = stored(gram_counts(docs, id_col=id_col, text_col=text_col, lang_col=lang_col), "gram-counts")
    best = Window.partitionBy("lang").orderBy(F.desc("counted"), "gram")
    # An even share of the bound for each language: ranked within a language, dealt by rank.
    ranked = counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= model_grams)
    chosen = ranked.orderBy("place", "lang").limit(model_grams).toArrow()
    languages = sorted(set(chosen["lang"].to_pylist()))
    final, early = Identifier({}), Identifier({})
    names = np.array(chosen["lang"].to_pylist(), object)
    grams = chosen["gram"].to_numpy().astype(np.uint64)
    counted, late = chosen["counted"].to_numpy(), chosen["late"].to_numpy()
    for name in languages:
        own = np.flatnonzero(names == name)
        own = own[np.argsort(grams[own])]
        final.models[name] = LanguageModel.of(grams[own], counted[own])
        rest = own[counted[own] > late[own]]
        if len(rest):
            early.models[name] = LanguageModel.of(grams[rest], (counted - late)[rest])
    if counts.count() > model_grams:
        rest = counts.where("counted > late")
        final.counts = counts.select("lang", "gram", F.col("counted").alias("n"))
        early.counts = rest.select("lang", "gram", (F.col("counted") - F.col("late")).alias("n"))
    if early.models:
        entropies, truth = _calibration(docs, early, id_col, text_col, lang_col, calibration_docs)
        calibrate(early, entropies, truth)
        final.sharpness, final.least_score, final.limits = early.sharpness, early.least_score, early.limits
    return final


def _calibration(docs, early, id_col, text_col, lang_col, calibration_docs) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropies, under the early models, of a bounded number of documents of fold 1."""
    names = list(early.models)
    known = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), fold(id_col).alias("fold")
    ).where((F.col("fold") == 1) & F.col("lang").isin(names))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Each document has a number below 2^20 by its id; a language takes the share that its size asks
    # for. About calibration_docs rows of a language are fetched, and twice as many at most.
    share = F.lit(0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(-(-calibration_docs * (1 << 20) // n))).otherwise(share)
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share)
    rows = (
        _entropies(sample, early, "text").select("row.id", "row.lang", "made.*")
        .where("lettered").orderBy(F.xxhash64("id"), "id", "lang").limit(2 * calibration_docs * len(names)).collect()
    )
    entropies = np.array([r["entropies"] for r in rows]).reshape(len(rows), len(names))
    return entropies, np.array([names.index(r["lang"]) for r in rows], int)


def _applied(made: Identifier, schema: pa.Schema, ddl: str, run):
    """An Arrow function that applies a broadcast identifier to texts."""

    def over(spark, text_col):
        sent = spark.sparkContext.broadcast(cloudpickle.dumps(replace(made, counts=None)))  # bounded by MODEL_GRAMS
        loaded: list = []

        def texts_of(texts: list[bytes]) -> dict[str, list]:
            if not loaded:
                loaded.extend((cloudpickle.loads(sent.value), Reader()))
            return run(loaded[0], [t.decode() for t in texts], loaded[1])

        return text_udf(texts_of, schema, ddl)(F.col(text_col))

    return over


def _log_probabilities(counts: DataFrame, asked: DataFrame, names: list[str]) -> DataFrame:
    """(gram, logs): of every gram asked for, by language in the order of ``names``, from counts (lang, gram, n) of
    any number of grams. The recursion of ``LanguageModel``, each order a join."""
    ends = lambda order: F.col("gram").bitwiseAND(F.lit((1 << SYMBOL_BITS * order) - 1))
    level, tables = counts, []
    for order in range(ORDER, 0, -1):
        times = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
        share = F.when((F.col("once") > 0) & (F.col("twice") > 0), F.col("once") / (F.col("once") + 2 * F.col("twice")))
        discounts = times.select("lang", F.coalesce(share, F.lit(0.75)).alias("discount"))
        contexts = level.groupBy("lang", F.shiftright("gram", SYMBOL_BITS).alias("context")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
        )
        contexts = contexts.join(F.broadcast(discounts), "lang").withColumn("weight", F.expr("cast(discount * kinds / total as float)"))
        tables.insert(0, (level.withColumnRenamed("gram", "end"), contexts.drop("kinds")))
        level = level.groupBy("lang", ends(order - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    found = asked.select("gram", F.explode(F.array(*map(F.lit, names))).alias("lang"), F.lit(1.0 / _SYMBOLS).alias("p"))
    for order, (level, contexts) in enumerate(tables, 1):
        placed = found.select("gram", "lang", "p", ends(order).alias("end"), F.shiftright(ends(order), SYMBOL_BITS).alias("context"))
        met = placed.join(contexts, ["lang", "context"], "left").join(level, ["lang", "end"], "left")
        found = met.select("gram", "lang", F.expr(
            "coalesce(cast((n - discount) / total as float), 0D) + coalesce(cast(weight as double), 1D) * p").alias("p"))
    by_lang = found.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", F.log("p")))).alias("logs"))
    return by_lang.select("gram", F.array(*[F.col("logs")[F.lit(name)] for name in names]).alias("logs"))


def _parted(grams: np.ndarray, logs: np.ndarray):
    """What a text has of the grams held (sums of ``logs``), its other grams, its size, whether it has a letter."""
    rest = pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())]))
    schema = pa.schema([("sums", pa.list_(pa.float64())), ("rest", rest), ("size", pa.int64()), ("lettered", pa.bool_())])

    def run(reader: Reader, texts: list[str]) -> dict[str, list]:
        made: dict[str, list] = {name: [] for name in schema.names}
        for text in texts:
            sums, other, size, lettered = np.zeros(logs.shape[1]), {}, 0, False
            for _, parts in _blocks([text]):
                all_grams, _, letters = reader.grams(parts)
                unique, times = np.unique(all_grams.astype(np.int64), return_counts=True)
                place = np.minimum(np.searchsorted(grams, unique), len(grams) - 1)
                held = grams[place] == unique
                sums += times[held] @ logs[place[held]]
                for gram, n in zip(unique[~held].tolist(), times[~held].tolist()):
                    other[gram] = other.get(gram, 0) + n
                size, lettered = size + len(all_grams), lettered or bool(letters.any())
            for name, value in zip(made, (sums.tolist(), [{"gram": g, "n": n} for g, n in other.items()], size, lettered)):
                made[name].append(value)
        return made

    return schema, run


def _entropies_of_all(docs: DataFrame, made: Identifier, text_col: str) -> DataFrame:
    """``_entropies`` under models of more grams than a task holds. The most frequent grams, a number
    bounded by MODEL_GRAMS values, are sent to the tasks with their log probabilities; all others of the
    texts meet theirs in a join."""
    names, spark = list(made.models), docs.sparkSession
    many = max(1, sum(len(m.levels[-1].grams) for m in made.models.values()) // len(names))
    frequent = made.counts.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(many)
    held = _log_probabilities(made.counts, frequent.select("gram"), names).orderBy("gram").toArrow()
    logs = held["logs"].combine_chunks().flatten().to_numpy().reshape(-1, len(names))
    schema, run = _parted(held["gram"].to_numpy(), logs)
    sent, loaded = spark.sparkContext.broadcast(cloudpickle.dumps(run)), []

    def parted(texts: list[bytes]) -> dict[str, list]:
        if not loaded:
            loaded.extend((cloudpickle.loads(sent.value), Reader()))
        return loaded[0](loaded[1], [t.decode() for t in texts])

    ddl = "struct<sums: array<double>, rest: array<struct<gram: bigint, n: bigint>>, size: bigint, lettered: boolean>"
    # Texts are known by two hashes. Copies add to sums and sizes alike, so that the quotient is that of one.
    keys = [F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.xxhash64(F.lit(1), F.coalesce(F.col(text_col), F.lit("")))]
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    parts = stored(docs.select(key.alias("key"), text_udf(parted, schema, ddl)(F.col(text_col)).alias("made")).select("key", "made.*"), "gram-parts")
    rest = parts.select("key", F.inline("rest"))
    known = _log_probabilities(made.counts, rest.select("gram").distinct(), names)
    each = [F.col("logs")[i] * F.col("n") for i in range(len(names))]
    added = rest.join(known, "gram").select("key", F.lit(0).cast("bigint").alias("size"), F.lit(False).alias("lettered"), F.array(*each).alias("sums"))
    total = parts.select("key", "size", "lettered", "sums").union(added).groupBy("key").agg(
        F.array(*[-F.sum(F.col("sums")[i]) / F.greatest(F.sum("size"), F.lit(1)) for i in range(len(names))]).alias("entropies"),
        F.max("lettered").alias("lettered"),
    )
    return packed(docs, key=key).join(total, "key").select("row", F.struct("entropies", "lettered").alias("made"))


def _entropies(docs: DataFrame, made: Identifier, text_col: str) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` beside struct ``made``: ``entropies`` by language and ``lettered``."""
    if made.counts is not None:
        return _entropies_of_all(docs, made, text_col)
    schema = pa.schema([("entropies", pa.list_(pa.float64())), ("lettered", pa.bool_())])
    scored = _applied(made, schema, "struct<entropies: array<double>, lettered: boolean>", lambda made, texts, reader: dict(
        zip(("entropies", "lettered"), (x.tolist() for x in made.entropies(texts, reader)))))
    return packed(docs, made=scored(docs.sparkSession, text_col))


def _chosen(made: Identifier, schema: pa.Schema, ddl: str):
    """An Arrow function of entropies and ``lettered`` to the choice."""
    light = replace(made, counts=None, models=dict.fromkeys(made.models))

    def run(entropies: pa.Array, lettered: pa.Array) -> pa.Array:
        rows = np.array(entropies.to_pylist(), float).reshape(len(entropies), len(light.models))
        got = light.chosen(rows, np.array(lettered.to_pylist(), bool))
        return pa.StructArray.from_arrays([pa.array(got[f.name], f.type) for f in schema], fields=list(schema))

    run.__annotations__ = {"entropies": pa.Array, "lettered": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ddl).asNondeterministic()


def identify(docs: DataFrame, made: Identifier, *, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row`` beside ``lang``, ``score``, ``cross_entropy`` and ``rejected``.

    The answer depends on the text alone; documents are neither collected nor, where the models hold all
    grams, shuffled.
    """
    schema = pa.schema([("lang", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())])
    ddl = "struct<lang: string, score: double, cross_entropy: double, rejected: boolean>"
    if made.counts is not None:
        known = _entropies(docs, made, text_col)
        return known.select("row", _chosen(made, schema, ddl)("made.entropies", "made.lettered").alias("made")).select("row", "made.*")
    chosen = _applied(made, schema, ddl, Identifier.choose)(docs.sparkSession, text_col)
    return packed(docs, made=chosen).select("row", "made.*")
