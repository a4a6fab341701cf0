"""Near-duplicates by SimHash, found through an inverted index of fingerprint bytes.

A fingerprint is a row of bytes at fixed positions. Two fingerprints that differ in at most
``r`` bits differ in at most ``r`` bytes, so of ``n`` positional bytes at least ``n - r`` match:
the guaranteed minimum. The index is keyed by sets of positions with their byte values, so that
a posting list holds only fingerprints that share these bytes, and the count filter already holds
where a list is made.

``linked_within`` (64 bits, links at two or fewer) keys the index by all 28 sets of six of the
eight positions. A pair within two bits shares at least one key; members of a list share six
bytes, the minimum, and differ in 16 bits at most. So a list never holds more than 65,536
distinct fingerprints, and its links are found without forming all pairs. The result is exact.

``similar_groups`` (wide fingerprints) serves similarities at which no number of equal bytes of a
short fingerprint is certain. It keys the index by many small sets of positions and compares the
whole fingerprints of the members of each list until its groups are known, within a task; long
lists are dealt into blocks that meet each other. No member is left out, so the lists lose no link.

Equal fingerprints are one entry throughout, so a text with millions of copies costs one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations
from math import acos, ceil, comb, log2, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import checkpointed, packed, small_side, stored, text_udf
from tallyhouse.llm.components import connected_components

HASH_SEED = 42
MIN_MATCHES = 6  # of 8 positional bytes, for links at two or fewer bits
ALL_PAIRS_UP_TO = 256
FINGERPRINTS_A_TASK = 10_000

WIDE_BITS = 1024
INDEX_KEYS = 96
RECALL = 0.95
BLOCK = 1024
SET_BYTES = 4_000_000
SPARE_KEY_BITS = 4


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of every word shingle of a text, repeats included; fewer words: of all of them."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], HASH_SEED) for a, b in zip(starts, ends[size - 1 :])]


def _remixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """The hashes themselves for number 0, else another 64 bits derived from each."""
    if number == 0:
        return hashes
    x = hashes + np.uint64((0x9E3779B97F4A7C15 * number) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(texts: list[bytes], size: int, bits: int, even_ties: bool = False, once: bool = False) -> list[bytes]:
    """A bit is 1 if it is set in over half of the shingles' hashes; no words give zero.

    With ``even_ties`` a bit set in exactly half of them is that of the least hash. Otherwise it is
    0, which makes short texts alike that have nothing in common. With ``once`` a repeated shingle
    counts once.

    Bits are counted for all texts at once: eight bits of each hash are spread over the bytes of
    a 64-bit number and added up in stretches of at most 255, so that no byte overflows.
    """
    per_text = [np.array(shingle_hashes(t, size), np.uint64) for t in texts]
    per_text = [np.unique(h) for h in per_text] if once else per_text
    lengths = np.array([len(h) for h in per_text])
    made = np.zeros((len(texts), bits // 8), np.uint8)
    filled = np.flatnonzero(lengths)
    if not len(filled):
        return [bytes(x) for x in made]
    hashes, counts = np.concatenate(per_text), lengths[filled]
    del per_text
    pieces = -(-counts // 255)
    first_piece = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    first_hash = np.concatenate(([0], np.cumsum(counts)[:-1]))
    starts = np.repeat(first_hash, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first_piece, pieces))
    spread = np.uint64(0x0101010101010101)
    least = np.minimum.reduceat(hashes, first_hash)
    for word in range(bits // 64):
        mixed = _remixed(hashes, word)
        value = np.zeros((len(filled), 8), np.uint8)
        for k in range(8):
            sums = np.add.reduceat((mixed >> np.uint64(k)) & spread, starts)
            by_byte = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), first_piece, axis=0)
            ones = 2 * by_byte > counts[:, None]
            if even_ties:
                of_least = ((_remixed(least, word) >> np.uint64(k)) & spread).view(np.uint8).reshape(-1, 8)
                ones |= (2 * by_byte == counts[:, None]) & (of_least == 1)
            value |= ones.astype(np.uint8) << np.uint8(k)
        made[filled, 8 * word : 8 * word + 8] = value[:, ::-1]  # most significant byte first
    return [bytes(x) for x in made]


def fingerprint(text: Column | str, size: int, bits: int = 64, even_ties: bool = False, once: bool = False) -> Column:
    """Column of fingerprints as binary, most significant byte first."""
    schema = pa.schema([("bytes", pa.binary())])
    function = text_udf(lambda texts: {"bytes": _in_parts(texts, size, bits, even_ties, once)}, schema, "struct<bytes: binary>")
    return function(text)["bytes"]


def _in_parts(
    texts: list[bytes], size: int, bits: int, even_ties: bool, once: bool, part_bytes: int = 4_000_000
) -> list[bytes]:
    """Fingerprints of some megabytes of text at a time, to bound the memory of the hashes."""
    made, part, held = [], [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= part_bytes:
            made += fingerprints(part, size, bits, even_ties, once)
            part, held = [], 0
    return made + (fingerprints(part, size, bits, even_ties, once) if part else [])


# Links at two or fewer bits of 64 -------------------------------------------------------------


def _free_bits(values: np.ndarray) -> np.ndarray:
    """The 16 bits (two bytes) in which members of a list may differ, as one number."""
    differ = np.bitwise_or.reduce(values ^ values[0])
    places = [p for p in range(8) if (int(differ) >> (8 * p)) & 255]
    rest = np.zeros(len(values), np.int64)
    for p in places:
        rest = (rest << 8) | ((values >> np.uint64(8 * p)) & np.uint64(255)).astype(np.int64)
    return rest


def linked_members(values: np.ndarray, max_bits: int) -> np.ndarray:
    """For members of one posting list, the number of the first member of their linked group."""
    n = len(values)
    if n <= ALL_PAIRS_UP_TO:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= max_bits
        group = np.arange(n)
        while True:
            lower = np.where(near, group[None, :], n).min(axis=1)
            if (lower == group).all():
                return group
            group = lower
    # Many members: look their neighbours up in a table over the 65,536 free values.
    rest = _free_bits(values)
    masks = [sum(1 << b for b in bits) for k in range(1, max_bits + 1) for bits in combinations(range(16), k)]
    none = n
    table = np.full(1 << 16, none)
    group = np.arange(n)
    while True:
        table[rest] = group
        lower = reduce(lambda low, mask: np.minimum(low, table[rest ^ mask]), masks, group)
        lower = lower[lower]
        if (lower == group).all():
            return group
        group = lower


def _links_of_lists(max_bits: int):
    """Arrow function: members of posting lists to links (member, first member of its group)."""

    def run(lists: pa.Array) -> pa.Array:
        made = []
        for members in lists.to_pylist():
            values = np.sort(np.array(members, np.int64).view(np.uint64))
            group = linked_members(values, max_bits)
            own = np.flatnonzero(group != np.arange(len(values)))
            signed = values.view(np.int64)
            made.append([{"a": a, "b": b} for a, b in zip(signed[own].tolist(), signed[group[own]].tolist())])
        return pa.array(made, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    run.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<a: bigint, b: bigint>>")


def _links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) of distinct 64-bit numbers ``f`` that keep every linked group together."""
    keys = []
    for number, positions in enumerate(combinations(range(8), MIN_MATCHES)):
        mask = sum(255 << (8 * p) for p in positions)
        mask -= (mask >> 63) << 64  # as a signed 64-bit number
        keys.append(F.struct(F.lit(number).alias("at"), F.col("f").bitwiseAND(F.lit(mask)).alias("shared")))
    lists = (
        distinct.select("f", F.explode(F.array(*keys)).alias("key"))
        .groupBy("key.at", "key.shared")
        .agg(F.collect_list("f").alias("members"))
        .where(F.size("members") > 1)
    )
    first, second = F.col("members")[0], F.col("members")[1]
    twos = (
        lists.where((F.size("members") == 2) & (F.bit_count(first.bitwiseXOR(second)) <= max_bits))
        .select(first.alias("a"), second.alias("b"))
    )
    more = lists.where(F.size("members") > 2).select(F.inline(_links_of_lists(max_bits)("members")))
    return twos.union(more)


def linked_within(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2
) -> DataFrame:
    """Id, ``fingerprint`` (16 hex digits) and ``component_id`` of every document.

    Fingerprints link at ``max_bits`` (2 at most) or fewer differing bits; ``component_id`` is
    the least id reachable over links, the document's own included. Texts without words (NULL,
    empty) have fingerprint zero and link like any other. Rows without an id get the least id of
    their component, NULL only if nobody in it has one; repeated rows are all returned. An empty
    table gives an empty result; other columns of ``docs`` are not looked at.
    """
    if not 0 <= max_bits <= 8 - MIN_MATCHES:
        raise ValueError(f"max_bits must be 0 to {8 - MIN_MATCHES}")
    made = docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("bytes"))
    made = made.select("id", F.conv(F.hex("bytes"), 16, -10).cast("bigint").alias("f"))
    made = stored(made, "simhash")  # two numbers a document, read for the index and for the result
    # Each fingerprint becomes 28 index rows: tasks are made for these, not for the few bytes of one.
    tasks = max(1, made.count() // FINGERPRINTS_A_TASK)
    distinct = checkpointed(made.groupBy("f").agg(F.min("id").alias("first")).repartition(tasks, "f"))
    groups = connected_components(_links(distinct, max_bits))
    grouped = distinct.join(groups.withColumnRenamed("node", "f"), "f", "left").select(
        "f", "first", F.coalesce("component", "f").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    known = grouped.join(least, "component").select("f", "component_id")
    return made.join(known, "f", "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


# Groups at a similarity ------------------------------------------------------------------------


def bits_at(similarity: float, bits: int) -> int:
    """Bits in which fingerprints of sets with this Jaccard similarity differ on average."""
    return round(bits * acos(2 * similarity / (1 + similarity)) / pi)


def most_bits_at(similarity: float, bits: int) -> int:
    """The average of ``bits_at`` and three standard deviations, which one pair in 700 exceeds."""
    share = acos(2 * similarity / (1 + similarity)) / pi
    return ceil(bits * share + 3 * sqrt(bits * share * (1 - share)))


def key_recall(keys: int, width: int, similarity: float, n_bytes: int) -> float:
    """Probability that a pair at this similarity shares one of ``keys`` keys of ``width`` of the bytes.

    All keys of a pair depend on the number of its equal bytes, so it is taken over that number.
    """
    equal = (1 - acos(2 * similarity / (1 + similarity)) / pi) ** 8
    ways = comb(n_bytes, width)
    return sum(
        comb(n_bytes, m) * equal**m * (1 - equal) ** (n_bytes - m) * (1 - (1 - comb(m, width) / ways) ** keys)
        for m in range(n_bytes + 1)
    )


def keys_for(width: int, similarity: float, n_bytes: int = WIDE_BITS // 8) -> int:
    """The fewest keys of ``width`` bytes of which a pair at this similarity shares one with probability
    ``RECALL``."""
    low, high = INDEX_KEYS, 1 << 16
    while low < high:
        middle = (low + high) // 2
        if key_recall(middle, width, similarity, n_bytes) < RECALL:
            low = middle + 1
        else:
            high = middle
    return low


def _index_positions(n_bytes: int, width: int, keys: int) -> np.ndarray:
    """``keys`` sets of ``width`` positions, spread evenly and reproducibly over the bytes."""
    order = np.random.default_rng(7)
    rows = [order.permutation(n_bytes) for _ in range(ceil(keys * width / n_bytes))]
    return np.concatenate(rows)[: keys * width].reshape(keys, width)


def _index_keys(positions: np.ndarray):
    """Arrow function: fingerprint to its index keys (hash of set number and byte values)."""

    def run(prints: pa.Array) -> pa.Array:
        n = len(prints)
        table = np.frombuffer(b"".join(prints.to_pylist()), np.uint8).reshape(n, -1)
        keys = np.tile(np.arange(len(positions), dtype=np.int64), (n, 1))
        for column in positions.T:
            keys = (keys << 8) | table[:, column]
        offsets = np.arange(0, n * len(positions) + 1, len(positions), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))

    run.__annotations__ = {"prints": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<bigint>")


def _compare():
    """Arrow function: equal positional bytes and differing bits of two fingerprints."""
    kind = pa.struct([("matches", pa.int32()), ("bits", pa.int32())])

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        n = len(left)
        a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(n, -1) for x in (left, right))
        x = a ^ b
        matches, bits = (x == 0).sum(axis=1), np.bitwise_count(x).sum(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(matches, pa.int32()), pa.array(bits, pa.int32())], fields=list(kind)
        )

    run.__annotations__ = {"left": pa.Array, "right": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<matches: int, bits: int>").asNondeterministic()


def _verified(pairs: DataFrame, prints: DataFrame, least_matches: int, max_bits: int) -> DataFrame:
    """The pairs (a, b) of nodes whose fingerprints match in enough bytes and differ in few bits."""
    left = prints.select(F.col("node").alias("a"), F.col("print").alias("a_print"))
    right = prints.select(F.col("node").alias("b"), F.col("print").alias("b_print"))
    met = pairs.distinct().join(left, "a").join(right, "b").select("a", "b", _compare()("a_print", "b_print").alias("is"))
    return met.where((F.col("is.matches") >= least_matches) & (F.col("is.bits") <= max_bits)).select("a", "b", "is.bits")


def list_links(
    table: np.ndarray, linked: np.ndarray, least_matches: int, max_bits: int, most_bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (first, second, near, bits) of members of a posting list; near ones tie its groups together.

    ``table`` has a fingerprint in each row; ``linked`` members are known to be one group. A
    member that joined a group is compared with all that have not joined one, so two members stay
    uncompared only if they are in one group already, and chains are followed to their end. Pairs
    of different groups that differ in over ``max_bits`` and up to ``most_bits`` are not near.
    """
    prints = table.view(np.uint64)
    waiting, front = np.flatnonzero(~linked), np.flatnonzero(linked).tolist()
    group = np.arange(len(table))
    group[front] = front[0] if front else 0
    pairs, doubtful = [np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]
    while len(waiting):
        if not front:
            front, waiting = [waiting[0]], waiting[1:]
        at = front.pop()
        bits = np.bitwise_count(prints[waiting] ^ prints[at]).sum(axis=1)
        close = bits <= most_bits
        if not close.any():
            continue
        close[close] = (table[waiting[close]] == table[at]).sum(axis=1) >= least_matches
        near = close & (bits <= max_bits)
        for found, kept in ((near, pairs), (close & ~near, doubtful)):
            if found.any():
                members = waiting[found]
                kept.append(np.stack([members, np.full(len(members), at)], axis=1))
        met, waiting = waiting[near], waiting[~near]
        group[met] = group[at]
        front += met.tolist()
    near, unsure = np.concatenate(pairs), np.concatenate(doubtful)
    unsure = unsure[group[unsure[:, 0]] != group[unsure[:, 1]]]
    both = np.concatenate([near, unsure])
    bits = np.bitwise_count(prints[both[:, 0]] ^ prints[both[:, 1]]).sum(axis=1)
    return both[:, 0], both[:, 1], np.arange(len(both)) < len(near), bits


def _links_of_members(least_matches: int, max_bits: int, most_bits: int):
    """Arrow function: members (node, print, linked) of posting lists to pairs (a, b, near, bits)."""
    kind = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("near", pa.bool_()), ("bits", pa.int32())])

    def run(lists: pa.Array) -> pa.Array:
        offsets, members = lists.offsets.to_numpy(), lists.values
        nodes = members.field("node").to_numpy()
        known = members.field("linked").to_numpy(zero_copy_only=False)
        prints = members.field("print")
        ends, a, b, near, bits = [0], [], [], [], []
        for begin, end in zip(offsets[:-1], offsets[1:]):
            order = begin + np.argsort(nodes[begin:end])
            raw = b"".join(prints.slice(begin, end - begin).to_pylist())
            table = np.frombuffer(raw, np.uint8).reshape(end - begin, -1)[order - begin]
            first, second, sure, differ = list_links(table, known[order].astype(bool), least_matches, max_bits, most_bits)
            a.append(nodes[order[first]])
            b.append(nodes[order[second]])
            near.append(sure)
            bits.append(differ)
            ends.append(ends[-1] + len(first))
        none = [np.zeros(0, np.int64)]
        links = [pa.array(np.concatenate(x or none).astype(t), f.type) for x, t, f in zip((a, b, near, bits), (np.int64, np.int64, bool, np.int32), kind)]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(links, fields=list(kind)))

    run.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<a: bigint, b: bigint, near: boolean, bits: int>>").asNondeterministic()


def _blocks(members: DataFrame) -> DataFrame:
    """Members (list, node, linked) of blocks of long posting lists (key, node, linked).

    The members not linked to their star, and those that are, are dealt into blocks of about
    half of ``BLOCK`` by a hash. Each block of the former meets itself and every other block.
    """
    half = F.lit(BLOCK // 2)
    sizes = members.groupBy("key").agg(
        F.ceil(F.count_if(~F.col("linked")) / half).cast("int").alias("rest"),
        F.ceil(F.count_if("linked") / half).cast("int").alias("tied"),
    )
    sizes = checkpointed(sizes.where("rest > 0"))
    rest, blocks = F.col("rest"), F.col("rest") + F.col("tied")
    place = F.xxhash64("node")
    own = F.when(F.col("linked"), rest + F.pmod(place, "tied")).otherwise(F.pmod(place, "rest")).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("linked"), rest).otherwise(blocks) - 1)
    dealt = members.join(sizes, "key").select("key", "node", "linked", own.alias("own"), F.explode(others).alias("other"))
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    return dealt.select(pair.alias("list"), "node", "linked")


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node) in order, to (key, node, star, n) for keys of several rows: the first node of the
    key, and how many rows it has, where ``BLOCK + 1`` stands for any number above ``BLOCK``.

    A key's rows may go over many batches; no more than ``BLOCK`` are held back.
    """

    def out(key: int, nodes: np.ndarray, star: int, n: int) -> tuple[np.ndarray, ...]:
        size = len(nodes)
        return np.full(size, key), nodes, np.full(size, star), np.full(size, n, np.int32)

    held_key, held, star, long = None, np.zeros(0, np.int64), 0, False
    for batch in batches:
        keys, nodes = (batch.column(c).to_numpy() for c in ("key", "node"))
        if not len(keys):
            continue
        starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
        sizes = np.diff(np.append(starts, len(keys)))
        parts = []
        # The key that goes on from the batch before, and the last one, which may go on.
        if keys[0] == held_key:
            if long:
                parts.append(out(held_key, nodes[: sizes[0]], star, BLOCK + 1))
            else:
                held = np.concatenate((held, nodes[: sizes[0]]))
            starts, sizes = starts[1:], sizes[1:]
        if len(held) > BLOCK:
            parts.append(out(held_key, held, star, BLOCK + 1))
            held, long = held[:0], True
        if len(starts):
            if len(held) > 1:
                parts.append(out(held_key, held, star, len(held)))
            inner = np.repeat(np.where(sizes[:-1] > 1, np.arange(len(sizes) - 1), -1), sizes[:-1])
            rows = np.flatnonzero(inner >= 0)
            place = inner[rows]
            rows = rows + starts[0]
            n = np.minimum(sizes[place], BLOCK + 1).astype(np.int32) if len(rows) else np.zeros(0, np.int32)
            parts.append((keys[rows], nodes[rows], nodes[starts[place]] if len(rows) else nodes[:0], n))
            held_key, held, star, long = keys[starts[-1]], nodes[starts[-1] :].copy(), nodes[starts[-1]], False
            if len(held) > BLOCK:
                parts.append(out(held_key, held, star, BLOCK + 1))
                held, long = held[:0], True
        if parts:
            columns = [np.concatenate(c) for c in zip(*parts)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "star", "n"])
    if len(held) > 1:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out(held_key, held, star, len(held))], names=["key", "node", "star", "n"])


def _list_links(index: DataFrame, prints: DataFrame, least_matches: int, max_bits: int) -> DataFrame:
    """The links (a, b, near, bits) of ``_compared``."""
    return _compared(index, prints, least_matches, max_bits)[0]


def _compared(
    index: DataFrame, prints: DataFrame, least_matches: int, max_bits: int, most_bits: int | None = None, star_bits: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, near, bits); the near ones tie together the groups of every posting list (key, node).

    The others, if ``most_bits`` is given, are pairs of different groups of a list that differ in
    over ``max_bits`` and up to ``most_bits``.

    Lists of up to ``BLOCK`` members are compared as they are, equal ones once. Members of longer
    ones first meet the least of them, their star. Those that are not linked to it then meet each
    other and all that are, in blocks. With ``star_bits`` a member is linked to its star at so many bits
    only. The second result holds the members (list, node) as they were compared.
    """
    # One shuffle of the index; lists of one entry, nearly all of them, end in the task.
    sorted_keys = index.select("key", "node").repartition("key").sortWithinPartitions("key", "node")
    met = checkpointed(sorted_keys.mapInArrow(_repeated, "key bigint, node bigint, star bigint, n int"))
    short = met.where(F.col("n") <= BLOCK).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("members"))
    short = short.select("members").distinct()
    short = short.select(F.xxhash64("members").alias("list"), F.explode("members").alias("node"), F.lit(False).alias("linked"))
    long = met.where(F.col("n") > BLOCK)
    pairs = long.where("node <> star").select(F.col("node").alias("a"), F.col("star").alias("b"))
    tied = checkpointed(_verified(pairs, prints, least_matches, max_bits if star_bits is None else star_bits))
    known = tied.select(F.col("a").alias("node"), F.col("b").alias("star"), F.lit(True).alias("tied"))
    flagged = long.join(known, ["star", "node"], "left").select(
        "key", "node", (F.col("tied").isNotNull() | (F.col("node") == F.col("star"))).alias("linked")
    )
    members = checkpointed(short.union(_blocks(checkpointed(flagged))))
    lists = members.join(prints, "node").groupBy("list").agg(
        F.collect_list(F.struct("node", "print", "linked")).alias("members")
    )
    links = lists.select(F.inline(_links_of_members(least_matches, max_bits, most_bits or max_bits)("members")))
    ties = tied.select("a", "b", F.lit(True).alias("near"), "bits")
    return ties.union(checkpointed(links.distinct())), members.select("list", "node")


def _shingle_set(text: Column | str, words: int) -> Column:
    """The different shingle hashes of a text, in order, as binary."""

    def sets(texts: list[bytes]) -> dict[str, list]:
        return {"bytes": [np.unique(np.array(shingle_hashes(t, words), np.uint64)).tobytes() for t in texts]}

    return text_udf(sets, pa.schema([("bytes", pa.binary())]), "struct<bytes: binary>")(text)["bytes"]


def _as_alike(similarity: float):
    """Arrow function: pairs of nodes and the shingle sets of these nodes to (a, b, alike): are the sets alike
    to ``similarity`` or more?"""
    kind = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("alike", pa.bool_())])

    def run(pairs: pa.Array, sets: pa.Array) -> pa.Array:
        made = []
        for asked, given in zip(pairs.to_pylist(), sets):
            held = {s["node"]: np.frombuffer(s["set"], np.uint64) for s in given.as_py()}
            judged = []
            for pair in asked:
                x, y = held[pair["a"]], held[pair["b"]]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                judged.append(pair | {"alike": shared >= similarity * (len(x) + len(y) - shared) - 1e-9})
            made.append(judged)
        return pa.array(made, pa.list_(kind))

    run.__annotations__ = {"pairs": pa.Array, "sets": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<a: bigint, b: bigint, alike: boolean>>").asNondeterministic()


def _alike(pairs: DataFrame, made: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b, alike) for different pairs of nodes, by their shingle sets.

    ``texts`` is (text_hash, text); the least text hash stands for the texts of a node. Nodes are dealt
    into blocks of about half of ``BLOCK``, or ``SET_BYTES`` of sets. The pairs of two blocks are
    compared together, so a node sends its set once for each block that it meets, not for each pair.
    """
    pairs = checkpointed(pairs)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    chosen = checkpointed(made.join(nodes, "node").groupBy("node").agg(F.min("text_hash").alias("text_hash")))
    rows = texts.join(small_side(chosen, chosen.count()), "text_hash").select("node", "text").dropDuplicates(["node"])
    sets = checkpointed(rows.select("node", _shingle_set("text", words).alias("set")))
    size = sets.agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.octet_length("set").cast("bigint")).alias("bytes")).first()
    blocks = F.lit(max(1, ceil(size.nodes / (BLOCK // 2)), ceil((size.bytes or 0) / SET_BYTES)))
    met = pairs.withColumn("block", F.struct(*[F.pmod(F.xxhash64(x), blocks).alias(x) for x in "ab"]))
    asked = met.groupBy("block").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
    given = (
        met.select("block", F.explode(F.array("a", "b")).alias("node")).distinct().join(sets, "node")
        .groupBy("block").agg(F.collect_list(F.struct("node", "set")).alias("sets"))
    )
    return checkpointed(asked.join(given, "block").select(F.inline(_as_alike(similarity)("pairs", "sets"))))


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes are in different groups (node, component)."""
    a, b = (groups.select(F.col("node").alias(x), F.col("component").alias(f"{x}_group")) for x in "ab")
    known = pairs.join(a, "a", "left").join(b, "b", "left")
    return known.where(F.coalesce("a_group", "a") != F.coalesce("b_group", "b")).drop("a_group", "b_group")


def _parted(lists: DataFrame, loose: DataFrame, groups: DataFrame) -> DataFrame:
    """The lists (list) that may hold a tie which fell apart: both its ends are ``loose`` nodes, of different
    groups. In other lists all ties hold, so members that they led past each other are in one group."""
    placed = loose.join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    held = lists.join(placed, "node").groupBy("list").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return held.where("least < most").select("list")


def _across_groups(least_matches: int, most_bits: int):
    """Arrow function: members (node, print, component) of posting lists to all pairs (a, b) of different
    components that may be alike."""
    kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])

    def run(lists: pa.Array) -> pa.Array:
        made = []
        for members in lists.to_pylist():
            nodes = np.array([m["node"] for m in members])
            group = np.array([m["component"] for m in members])
            table = np.frombuffer(b"".join(m["print"] for m in members), np.uint8).reshape(len(nodes), -1)
            prints, pairs = table.view(np.uint64), []
            for at in range(len(nodes) - 1):
                rest = np.flatnonzero(group[at + 1 :] != group[at]) + at + 1
                close = rest[np.bitwise_count(prints[rest] ^ prints[at]).sum(axis=1) <= most_bits]
                close = close[(table[close] == table[at]).sum(axis=1) >= least_matches]
                pairs += [{"a": max(int(nodes[at]), int(nodes[x])), "b": min(int(nodes[at]), int(nodes[x]))} for x in close]
            made.append(pairs)
        return pa.array(made, pa.list_(kind))

    run.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<a: bigint, b: bigint>>").asNondeterministic()


def _groups_of_alike(
    met: DataFrame, lists: DataFrame, prints: DataFrame, made: DataFrame, texts: DataFrame, words: int, similarity: float,
    sure_bits: int, least_matches: int, most_bits: int,
) -> DataFrame:
    """Groups (node, component) by the met pairs (a, b, near, bits), all of them verified.

    A list's near pairs tie it together by the number of bits. Those with ``sure_bits`` or fewer are
    taken for that; the shingle sets decide on the others and on the doubtful pairs. Where a tie does
    not hold, the members that it led past each other are met again: all pairs of its list that are
    now in different groups are compared by their sets.
    """
    tied = lambda links: connected_components(links.select("a", "b"))
    sure = met.where(F.col("near") & (F.col("bits") <= sure_bits))
    groups = tied(sure)
    unsure = checkpointed(_apart(met.where(~(F.col("near") & (F.col("bits") <= sure_bits))), groups).select("a", "b", "near").distinct())
    if unsure.isEmpty():
        return groups
    judged = _alike(unsure.select("a", "b").distinct(), made, texts, words, similarity)
    held = judged.where("alike").select("a", "b")
    links = sure.select("a", "b").union(held)
    groups = tied(links)
    loose = _apart(unsure.where("near").join(judged.where("not alike"), ["a", "b"]).select("a", "b"), groups)
    loose = checkpointed(loose.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    if loose.isEmpty():
        return groups
    again = lists.join(_parted(lists, loose, groups), "list")
    members = again.join(prints, "node").join(groups, "node", "left").groupBy("list").agg(
        F.collect_list(F.struct("node", "print", F.coalesce("component", "node").alias("component"))).alias("members")
    )
    more = checkpointed(members.select(F.inline(_across_groups(least_matches, most_bits)("members"))).distinct())
    more = more.join(judged, ["a", "b"], "left_anti")
    held = _alike(more, made, texts, words, similarity).where("alike").select("a", "b")
    return groups if held.isEmpty() else tied(links.union(held))


def similar_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity: float = 0.8,
    bits: int = WIDE_BITS,
    keys: int | None = None,
    width: int | None = None,
) -> DataFrame:
    """Rows of ``docs`` as (id, text_hash, node, component): equal component, one group.

    Two texts link if their sets of ``words``-word shingles have this Jaccard similarity or more. Pairs
    that share an index key are candidates if their fingerprints differ in no more bits than those
    of such sets do on average and three standard deviations; the sets decide. Pairs with four
    standard deviations less than the average are taken without: one in 30,000 at the similarity
    has so few. The ``width`` of an index key is three bytes up to a million (2^20) different
    fingerprints, four up to 2^28 and five beyond, so that chance meetings stay in proportion to
    their number. The number of keys follows from the width and ``RECALL``: a pair at the similarity
    shares one with probability 0.95, at 0.85 with 0.997, at any width, before other members of its
    group help. Fingerprints are made of the different shingles, as the sets are. NULL and empty
    texts have equal fingerprints.
    """
    made = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
            fingerprint(F.col(text_col), words, bits, even_ties=True, once=True).alias("print"),
        ).withColumn("node", F.xxhash64("print")),
        "simhash-wide",
    )
    prints = checkpointed(made.select("node", "print").distinct())
    entries = prints.count()
    width = width or max(3, ceil((log2(max(entries, 2)) + SPARE_KEY_BITS) / 8))
    positions = _index_positions(bits // 8, width, keys or keys_for(width, similarity, bits // 8))
    index = prints.select("node", F.explode(_index_keys(positions)("print")).alias("key"))
    max_bits, most_bits = bits_at(similarity, bits), most_bits_at(similarity, bits)
    sure_bits = max(0, max_bits - 4 * (most_bits - max_bits) // 3)
    least_matches = max(width, bits // 8 - most_bits)
    met, lists = _compared(index, prints, least_matches, max_bits, most_bits, sure_bits)
    texts = docs.select(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.col(text_col).alias("text"))
    groups = _groups_of_alike(met, lists, prints, made, texts, words, similarity, sure_bits, least_matches, most_bits)
    return made.drop("print").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of each group of ``similar_groups``: the one with the least id, without copies.

    Rows without an id come last; among rows with the same id the least text hash decides, and of
    identical rows one stays. The columns are those of ``docs``.
    """
    groups = similar_groups(docs, id_col=id_col, text_col=text_col, **settings)
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("text_hash").alias("text_hash"))
    kept = groups.groupBy("component").agg(F.min(rank).alias("kept"))
    # As a struct, which equals another where both ids are NULL, the id serves the join and what
    # follows, so that the texts are shuffled once.
    key = ["text_hash", "at"]
    kept = kept.select("kept.text_hash", F.struct("kept.id").alias("at"))
    rows = packed(docs, text_hash=F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), at=F.struct(F.col(id_col).alias("id")))
    return rows.join(kept, key, "left_semi").dropDuplicates(key).select("row.*")
