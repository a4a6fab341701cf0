"""A convolutional text classifier, trained in numpy and applied by Spark.

Words are hashed into ``BUCKETS`` embeddings, and so are the first bytes of longer words (as many
as ``STEMS`` names), which lets inflected forms that no label shows share what is learned of their
stem; a word is the sum of these. Filters of one, two and three words slide over the whole text, the greatest value of
each filter is kept, and a logistic layer makes the score.

Training takes every labelled text. Up to ``ONE_PART`` of them are trained on at once. More are dealt
by a hash of the id into parts of about that size, which tasks train on side by side, each from the
same network; after every pass the networks are averaged (a word's embedding over the parts that hold
the word) and go into the next pass. Networks are averaged block by block in Spark, so the driver
meets the average alone. A fifth of the texts is kept out of the training to calibrate: it fits the
slope and offset of the score to the class sizes of all labels, and a threshold for each language.

For scoring, the words of many texts are laid in one row, so that a convolution is one matrix
product and a sum of shifted rows. The network's size is fixed. Documents are neither shuffled nor
collected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import packed, small_side, stored, text_udf
from tallyhouse.llm.decontaminate import words_of
from tallyhouse.operators.ordered import OrderedRows

BUCKETS = 1 << 17
STEMS = (4, 6)
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 12
ONE_PART = 16_000
EPOCHS = 6
PASSES = 3  # over texts in several parts
FEW_IDS = 1_000_000  # labelled ids that are broadcast; more are joined by shuffle, once
LEAST_STEPS = 600  # small samples are gone over more often
BATCH = 64
SEED = 11
PART_WORDS = 400_000

# Empty places before a text: as many as the widest filter reaches beyond one word.
PAD = max(WIDTHS) - 1


def word_numbers(text: bytes) -> np.ndarray:
    """Buckets 1 to ``BUCKETS - 1`` of every word (first row) and of its stems (further rows).

    0 is the empty place, and a stem of a word that is no longer than it.
    """
    words = words_of(text)
    n = len(words)
    made = np.empty((1 + len(STEMS), n), np.int64)
    made[0] = np.fromiter(map(zlib.crc32, words), np.int64, n)
    for i, length in enumerate(STEMS, 1):
        made[i] = np.fromiter((zlib.crc32(w[:length], length) if len(w) > length else -1 for w in words), np.int64, n)
    return np.where(made < 0, 0, made % (BUCKETS - 1) + 1).astype(np.int32)


def _laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one row, each behind empty places, and where these begin.

    A filter that starts at a text's last word reads the empty places of the next text and
    nothing of its words.
    """
    gap = np.zeros((1 + len(STEMS), PAD), np.int32)
    parts, starts, at = [], [], 0
    for numbers in texts:
        starts.append(at)
        parts += [gap, numbers]
        at += PAD + numbers.shape[1]
    return np.concatenate([*parts, gap], axis=1), np.array(starts)


@dataclass
class Network:
    """Embeddings, filters per width, and the logistic layer."""

    embedding: np.ndarray
    filters: list[np.ndarray]  # (width, dimensions, filters) for each width
    offsets: list[np.ndarray]
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, texts: list[np.ndarray]) -> tuple[np.ndarray, list[tuple], np.ndarray]:
        """Greatest filter values of each text, the answers they come from (per width), and the row
        of laid-out words."""
        row, starts = _laid_out(texts)
        vectors = self.embedding[row[0]]
        for stems in row[1:]:
            vectors += self.embedding[stems]
        parts = vectors @ np.concatenate([f[j] for f in self.filters for j in range(len(f))], axis=1)
        values, places, column = [], [], 0
        for width, offset in zip(WIDTHS, self.offsets):
            length = row.shape[1] - width + 1
            answers = np.zeros((length, FILTERS), np.float32)
            for j in range(width):
                answers += parts[j : j + length, column : column + FILTERS]
                column += FILTERS
            top = np.maximum.reduceat(answers, starts, axis=0)
            values.append(np.maximum(top + offset, 0))
            places.append((answers, starts, top))
        return np.concatenate(values, axis=1), places, row

    def raw(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log-odds before calibration."""
        if not texts:
            return np.zeros(0)
        made, part, held = [], [], 0
        for numbers in texts:
            part.append(numbers)
            held += numbers.shape[1]
            if held >= PART_WORDS:
                made.append(self.pooled(part)[0] @ self.weights + self.bias)
                part, held = [], 0
        if part:
            made.append(self.pooled(part)[0] @ self.weights + self.bias)
        return np.concatenate(made)

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Calibrated probability of the label."""
        return _sigmoid(self.slope * self.raw(texts).astype(np.float64) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Adam:
    """Adam steps for a list of arrays."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.step = arrays, rate, 0
        self.mean = [np.zeros_like(a) for a in arrays]
        self.square = [np.zeros_like(a) for a in arrays]

    def update(self, gradients: list[np.ndarray], rows: np.ndarray | None = None) -> None:
        """One step of all arrays, or of some rows of the first one."""
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        at = slice(None) if rows is None else rows
        for array, mean, square, gradient in zip(self.arrays, self.mean, self.square, gradients):
            mean[at] += 0.1 * (gradient - mean[at])
            square[at] += 0.001 * (gradient**2 - square[at])
            array[at] -= scale * mean[at] / (np.sqrt(square[at]) + 1e-8)


def _first_places(answers: np.ndarray, starts: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Row of the first greatest answer per text and filter."""
    ends = np.append(starts[1:], len(answers))
    found = np.empty(top.shape, np.int64)
    for i, (a, b) in enumerate(zip(starts, ends)):
        found[i] = a + answers[a:b].argmax(axis=0)
    return found


def _untrained(dice: np.random.Generator, words: int) -> Network:
    embedding = dice.normal(0, 0.1, (words, DIMENSIONS)).astype(np.float32)
    embedding[0] = 0
    filters = [dice.normal(0, (w * DIMENSIONS) ** -0.5, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    offsets = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    weights = dice.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
    return Network(embedding, filters, offsets, weights, 0.0)


def train(
    texts: list[np.ndarray], labels: np.ndarray, seed: int = SEED, start: Network | None = None, share: float | None = None
) -> Network:
    """A network fitted to word numbers and 0/1 labels; both classes count alike.

    With ``start``, one pass that goes on from that network; ``share`` is the share of label 1 in all
    parts then.
    """
    dice = np.random.default_rng(seed)
    # Work on the words that occur, renumbered; 0 stays the empty place.
    used = np.unique(np.concatenate([np.zeros((1 + len(STEMS), 1), np.int32), *texts], axis=1))
    texts = [np.searchsorted(used, t).astype(np.int32) for t in texts]
    net = _untrained(dice, len(used)) if start is None else Network(
        start.embedding[used], [f.copy() for f in start.filters], [o.copy() for o in start.offsets], start.weights.copy(), 0.0
    )
    embedding, filters, offsets, weights = net.embedding, net.filters, net.offsets, net.weights
    bias = np.full(1, 0 if start is None else start.bias, np.float32)
    words_adam, adam = _Adam([embedding], 0.01), _Adam([*filters, *offsets, weights, bias], 0.01)
    share = max(labels.mean() if share is None else share, 1e-3)
    emphasis = np.where(labels == 1, 0.5 / share, 0.5 / max(1 - share, 1e-3))
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(texts))) if start is None else 1):
        order = dice.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            top, places, row = net.pooled([texts[i] for i in chosen])
            kept = (dice.random(top.shape) > 0.2) / 0.8  # dropout
            error = (_sigmoid((top * kept) @ weights + bias[0]) - labels[chosen]) * emphasis[chosen] / len(chosen)
            back = error[:, None] * weights[None, :] * kept * (top > 0)
            g_filters, g_offsets, touched, moves = [], [], [], []
            for k, (width, (answers, starts, highest)) in enumerate(zip(WIDTHS, places)):
                part = back[:, k * FILTERS : (k + 1) * FILTERS].astype(np.float32)
                first = _first_places(answers, starts, highest)
                g_filter = np.zeros_like(filters[k])
                for j in range(width):
                    moved = (part[:, :, None] * filters[k][j].T[None]).reshape(-1, DIMENSIONS)
                    for numbers in row[:, first + j]:
                        g_filter[j] += np.einsum("bfd,bf->df", embedding[numbers], part)
                        touched.append(numbers.ravel())
                        moves.append(moved)
                g_filters.append(g_filter)
                g_offsets.append(part.sum(axis=0))
            # Only words at which a filter was greatest are moved, and the empty place never is.
            rows, place = np.unique(np.concatenate(touched), return_inverse=True)
            g_words = np.zeros((len(rows), DIMENSIONS), np.float32)
            np.add.at(g_words, place, np.concatenate(moves))
            words_adam.update([g_words[rows > 0]], rows[rows > 0])
            adam.update(
                [*g_filters, *g_offsets, ((top * kept).T @ error).astype(np.float32) + 1e-4 * weights,
                 np.array([error.sum()], np.float32)]
            )
    # A word that no training text holds is an empty place.
    full = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    full[used] = embedding
    net.embedding, net.bias = full, float(bias[0])
    return net


def calibrate(net: Network, texts: list[np.ndarray], labels: np.ndarray, counts: np.ndarray, langs: list[str]) -> None:
    """Fit slope and shift to texts that were not trained on, weighted to the class sizes of all
    labels, and a threshold of best F1 for each language that has both classes."""
    if len(texts) == 0 or labels.min() == labels.max():
        return
    raw = net.raw(texts)
    emphasis = np.where(labels == 1, counts[1] / (labels == 1).sum(), counts[0] / (labels == 0).sum())
    emphasis = emphasis / emphasis.sum()
    spread = raw.std() + 1e-6
    x = raw / spread

    def sums(slope: float, shift: float) -> list[float]:
        p = _sigmoid(slope * x + shift)
        d, h = (p - labels) * emphasis, p * (1 - p) * emphasis
        return [(d * x).sum(), d.sum(), (h * x * x).sum(), (h * x).sum(), h.sum()]

    _fit(net, sums, spread)
    scores = _sigmoid(net.slope * raw + net.shift)
    for lang in sorted(set(langs)):
        own = np.array([x == lang for x in langs])
        if 0 < labels[own].sum() < own.sum():
            net.thresholds[lang] = _best_threshold(scores[own], labels[own], emphasis[own])


def _fit(net: Network, sums, spread: float) -> None:
    """Slope and shift from the sums of gradient and curvature that ``sums`` gives at a point."""
    slope, shift = 1.0, 0.0
    for _ in range(400):  # Newton steps of a logistic fit, with a little shrinkage
        dx, d, hxx, hx, h = sums(slope, shift)
        gradient = np.array([dx + 1e-3 * slope, d])
        matrix = np.array([[hxx + 1e-3, hx], [hx, h + 1e-6]])
        move = np.linalg.solve(matrix, gradient)
        slope, shift = slope - np.clip(move[0], -1, 1), shift - np.clip(move[1], -1, 1)
        if np.abs(move).max() < 1e-7:
            break
    net.slope, net.shift = float(max(slope, 1e-3) / spread), float(shift)


def _best_threshold(scores: np.ndarray, labels: np.ndarray, emphasis: np.ndarray) -> float:
    """The middle of the gap between scores at which F1 is best."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum((labels * emphasis)[order])
    flagged = np.cumsum(emphasis[order])
    best = int(np.argmax(2 * right / (flagged + (labels * emphasis).sum())))
    below = scores[order[best + 1]] if best + 1 < len(order) else 0.0
    return float((scores[order[best]] + below) / 2)


def held_out(doc_id) -> F.Column:
    """Whether labels of a document are kept from learning: CRC32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "toxic",
    one_part: int = ONE_PART,
) -> Network:
    """Train and calibrate on the labelled rows that are not held out.

    Rows without id or label are not used; a document labelled both ways counts as 1, and one that
    is given twice is used once. With no labels, or one class alone, every score is the share of
    label 1 (0 without labels).
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = np.array([sizes.get(0, 0), sizes.get(1, 0)], float)
    if counts.min() == 0:
        return _constant(counts[1] / counts.sum() if counts.sum() else 0.0)
    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(lang_col, F.lit("")).alias("lang"))
        .join(small_side(known, int(counts.sum()), FEW_IDS), "id")
        .withColumn("order", F.xxhash64(F.lit(SEED), F.col("id").cast("string")))
    )
    if counts.sum() > one_part:
        return _learned_in_parts(rows, counts, -(-int(counts.sum()) // one_part))
    schema = pa.schema([("words", pa.binary())])
    numbers = text_udf(lambda texts: {"words": [word_numbers(t).tobytes() for t in texts]}, schema, "struct<words: binary>")
    # One part: its texts' word numbers are collected.
    rows = rows.select("id", "order", "label", "lang", numbers("text")["words"].alias("words")).collect()
    rows = sorted({r["id"]: r for r in sorted(rows, key=lambda r: (r["id"], r["lang"], r["words"]))}.values(), key=lambda r: (r["order"], r["id"]))
    label = np.array([r["label"] for r in rows])
    if len(rows) == 0 or label.min() == label.max():
        return _constant(counts[1] / counts.sum())
    texts = [np.frombuffer(r["words"], np.int32).reshape(1 + len(STEMS), -1) for r in rows]
    late = np.zeros(len(rows), bool)
    for value in (0, 1):
        late[np.flatnonzero(label == value)[4::5]] = True
    net = train([t for t, x in zip(texts, late) if not x], label[~late])
    calibrate(net, [t for t, x in zip(texts, late) if x], label[late], counts, [r["lang"] for r, x in zip(rows, late) if x])
    return net


_BLOCK = 1024  # embeddings that are averaged together
_PIECE = "block int, numbers binary"


def _pieces(net: Network, used: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A network in blocks of numbers, each row of numbers behind a 1 (used words) or a 0."""
    seen = np.zeros((BUCKETS, 1), np.float32)
    seen[used] = 1
    flat = np.hstack([seen, net.embedding * seen])
    for block in range(0, BUCKETS, _BLOCK):
        yield block // _BLOCK, flat[block : block + _BLOCK]
    rest = np.concatenate([a.ravel() for a in (*net.filters, *net.offsets, net.weights)] + [np.array([net.bias])])
    yield -1, np.concatenate([[1], rest]).astype(np.float32)


def _averaged(blocks: dict[int, np.ndarray], before: Network) -> tuple[Network, np.ndarray]:
    """The network of summed blocks, and which words any part held; other words are as before."""
    flat = np.concatenate([blocks[i].reshape(-1, 1 + DIMENSIONS) for i in range(BUCKETS // _BLOCK)])
    seen = flat[:, 0] > 0
    embedding = np.where(seen[:, None], flat[:, 1:] / np.maximum(flat[:, :1], 1), before.embedding).astype(np.float32)
    rest, arrays, at = (blocks[-1][1:] / blocks[-1][0]).astype(np.float32), [], 0
    for like in (*before.filters, *before.offsets, before.weights):
        arrays.append(rest[at : at + like.size].reshape(like.shape))
        at += like.size
    n = len(WIDTHS)
    return Network(embedding, arrays[:n], arrays[n : 2 * n], arrays[-1], float(rest[-1])), seen


def _learned_in_parts(rows: DataFrame, counts: np.ndarray, parts: int) -> Network:
    """Passes over ``parts`` parts side by side, then the calibration on the fifth kept out."""
    if counts.sum() > FEW_IDS:
        rows = stored(rows, "toxicity-labelled")
    late = F.pmod("order", F.lit(5)) == 4
    # Rows of one document are in one part, which holds about ``ONE_PART`` texts.
    early = rows.where(~late).withColumn("part", F.pmod(F.xxhash64("id", "order"), F.lit(parts)))
    net, share, context = _untrained(np.random.default_rng(SEED), BUCKETS), counts[1] / counts.sum(), rows.sparkSession.sparkContext
    for turn in range(PASSES):
        sent = context.broadcast(cloudpickle.dumps(net))

        def one(table: pa.Table) -> pa.Table:
            texts = [x or b"" for x in table["text"].cast(pa.binary()).to_pylist()]
            given = zip(table["id"].to_pylist(), table["lang"].to_pylist(), texts, table["label"].to_pylist(), table["order"].to_pylist())
            once = sorted({r[0]: r for r in sorted(given)}.values(), key=lambda r: (r[4], r[0]))
            numbers = [word_numbers(r[2]) for r in once]
            made = train(numbers, np.array([r[3] for r in once]), SEED + turn, cloudpickle.loads(sent.value), share)
            used = np.unique(np.concatenate(numbers, axis=1))
            pieces = list(_pieces(made, used[used > 0]))
            return pa.table({"block": pa.array([b for b, _ in pieces], pa.int32()), "numbers": pa.array([x.tobytes() for _, x in pieces], pa.binary())})

        def total(table: pa.Table) -> pa.Table:
            together = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in sorted(table["numbers"].to_pylist()))
            return pa.table({"block": table["block"][:1], "numbers": pa.array([together.tobytes()], pa.binary())})

        one.__annotations__ = total.__annotations__ = {"table": pa.Table, "return": pa.Table}
        trained = early.select("part", "id", "lang", "text", "label", "order").groupBy("part").applyInArrow(one, _PIECE)
        blocks = trained.groupBy("block").applyInArrow(total, _PIECE).collect()
        net, seen = _averaged({r["block"]: np.frombuffer(r["numbers"]) for r in blocks}, net)
    net.embedding[~seen] = 0  # a word that no training text holds is an empty place
    _calibrated_in_parts(net, rows.where(late), counts)
    return net


def _calibrated_in_parts(net: Network, rows: DataFrame, counts: np.ndarray) -> None:
    """``calibrate`` for any number of texts, which stay distributed."""
    sent = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(net))

    def run(texts: list[bytes]) -> dict[str, list]:
        return {"raw": cloudpickle.loads(sent.value).raw([word_numbers(t) for t in texts])}

    raw = text_udf(run, pa.schema([("raw", pa.float64())]), "struct<raw: double>")("text")["raw"]
    given = rows.select("id", "label", "lang", raw.alias("raw"))
    once = given.groupBy("id").agg(F.max(F.struct("lang", "raw", "label")).alias("r")).select("r.*")
    known = stored(once, "toxicity-calibration")
    found = {(r["lang"], r["label"]): r["n"] for r in known.groupBy("lang", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    late = [sum(n for (_, label), n in found.items() if label == x) for x in (0, 1)]
    if min(late) == 0:
        return
    weight = [float(counts[x] / late[x] / counts.sum()) for x in (0, 1)]
    spread = known.agg(F.stddev_pop("raw")).first()[0] + 1e-6
    emphasis = F.when(F.col("label") == 1, weight[1]).otherwise(weight[0])

    def sums(slope: float, shift: float) -> list[float]:
        x = F.col("raw") / spread
        z = F.greatest(F.least(x * float(slope) + float(shift), F.lit(30.0)), F.lit(-30.0))
        p = 1 / (1 + F.exp(-z))
        d, h = (p - F.col("label")) * emphasis, p * (1 - p) * emphasis
        return list(known.agg(F.sum(d * x), F.sum(d), F.sum(h * x * x), F.sum(h * x), F.sum(h)).first())

    _fit(net, sums, spread)
    # Best F1 by running counts of both labels, from the greatest score down in each language.
    ordered = OrderedRows(known, "lang", "-raw").with_columns(row_totals={"label": "ones"}, row_number="place")
    rows_before = ones_before = 0
    for lang in sorted({lang for lang, _ in found}, key=lambda x: x.encode()):
        zeros, ones = found.get((lang, 0), 0), found.get((lang, 1), 0)
        if zeros and ones:
            right = (F.col("ones") - ones_before) * weight[1]
            wrong = (F.col("place") - rows_before - F.col("ones") + ones_before) * weight[0]
            own = ordered.where(F.col("lang") == lang).select("place", "raw", (2 * right / (right + wrong + ones * weight[1])).alias("f1"))
            best = own.orderBy(F.desc("f1"), "place").first()
            below = own.where(F.col("place") == best["place"] + 1).first()
            scores = [float(_sigmoid(net.slope * r["raw"] + net.shift)) if r else 0.0 for r in (best, below)]
            net.thresholds[lang] = sum(scores) / 2
        rows_before, ones_before = rows_before + zeros + ones, ones_before + ones


def _constant(share: float) -> Network:
    """A network that scores everything alike."""
    odds = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    zeros = [np.zeros((w, DIMENSIONS, FILTERS), np.float32) for w in WIDTHS]
    return Network(
        np.zeros((BUCKETS, DIMENSIONS), np.float32), zeros, [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32), odds,
    )



def score(docs: DataFrame, net: Network, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Every row of ``docs`` as struct ``row`` beside ``score`` and ``flagged``.

    The score depends on the text alone. ``flagged`` holds it against the threshold of the row's
    language (0.5 where none was calibrated). NULL and empty texts get the score of no words; very
    long ones are read whole, repeated rows are scored alike, and an empty table gives an empty one.
    """
    spark = docs.sparkSession
    # A fixed size: BUCKETS * DIMENSIONS numbers and the filters.
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(net))
    loaded: list[Network] = []

    def run(texts: list[bytes]) -> dict[str, list]:
        if not loaded:
            loaded.append(cloudpickle.loads(sent.value))
        return {"score": loaded[0].scores([word_numbers(t) for t in texts])}

    made = text_udf(run, pa.schema([("score", pa.float64())]), "struct<score: double>")(F.col(text_col))["score"]
    threshold = F.lit(0.5)
    for lang, value in net.thresholds.items():
        threshold = F.when(F.coalesce(F.col("row")[lang_col], F.lit("")) == lang, F.lit(value)).otherwise(threshold)
    return packed(docs, score=made).select("row", "score", (F.col("score") >= threshold).alias("flagged"))
