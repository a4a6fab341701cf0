"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes becomes signed entries per document: an insert adds a document and its tokens,
a delete takes back what the entries so far add up to for its id, and a revision does both. Their
sums per (source, language, tokenizer version) are the batch's delta, and the totals are the sum
of the deltas. Nothing is counted a second time: a change costs its own text and a join of the
changed ids with the narrow entries.

Commits are idempotent. A batch is committed once the marker that Spark writes behind a finished
delta is there; a batch id that is committed is skipped, and what a failed attempt left is written
over. Totals and entries read committed batches only.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import text_udf, word_count

TOKENIZER_FOLDER = "/opt/tokenizers"

# Fixed value: how the byte-level vocabularies cut text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

GROUP = ["source", "lang", "tokenizer"]
_ENTRY = "id string, source string, lang string, tokenizer string, docs bigint, tokens bigint"


@dataclass(frozen=True)
class Tokenizer:
    """A version name and the vocabulary file of a byte-level BPE; without a file, words are counted."""

    version: str
    path: str | None = None

    def count(self, spark: SparkSession, text: Column) -> Column:
        """Number of tokens of a text; NULL has none."""
        if self.path is None:
            return word_count(text)
        with open(self.path, "rb") as file:  # some 50,000 entries; sent to the tasks once
            vocabulary = spark.sparkContext.broadcast(file.read())
        version = self.version

        def run(texts: list[bytes]) -> dict[str, list]:
            encoding = _encoding(version, vocabulary.value)
            return {"n": [token_count(encoding, t.decode("utf-8", "replace")) for t in texts]}

        return text_udf(run, pa.schema([("n", pa.int64())]), "struct<n: bigint>")(text)["n"]


_LONG_BLANKS = regex.compile(r"\s{2000}")
_PIECES = regex.compile(PATTERN)


def token_count(encoding: tiktoken.Encoding, text: str) -> int:
    """Number of tokens. The library's own pattern matcher runs out of stack on very long white
    space, so such texts are cut by the same pattern here and merged piece by piece."""
    if _LONG_BLANKS.search(text) is None:
        return len(encoding.encode_ordinary(text))
    return sum(len(encoding._encode_single_piece(piece)) for piece in _PIECES.findall(text))


_encodings: dict[str, tiktoken.Encoding] = {}


def _encoding(version: str, vocabulary: bytes) -> tiktoken.Encoding:
    if version not in _encodings:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        _encodings[version] = tiktoken.Encoding(version, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[version]


class Rollup:
    """The state of the totals in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str, tokenizers: Sequence[Tokenizer]):
        self.spark, self.folder, self.tokenizers = spark, folder.rstrip("/"), tokenizers

    def _path(self, part: str, batch: str) -> str:
        return f"{self.folder}/{part}/{batch}"

    def _system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """Ids of the committed batches, by name."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(self._path("deltas", "*/_SUCCESS"))
        return sorted(x.getPath().getParent().getName() for x in self._system().globStatus(pattern) or [])

    def entries(self) -> DataFrame:
        """Signed entries per document of the committed batches."""
        return self._read("entries", _ENTRY)

    def _read(self, part: str, schema: str) -> DataFrame:
        batches = self.committed()
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._path(part, b) for b in batches])

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply changes (op, id, source, lang, text) under a batch id; False if it was committed before.

        ``op`` is insert, revise or delete; rows with another op, or none, change nothing. Within a
        batch, deletes and the old side of revisions come before what is added. A revision of an
        unknown id adds it, a delete of one does nothing. Of several revisions of one id the longest
        text counts, then the greatest. Every insert row counts, also one with a known id; a later
        delete takes all of them back. Rows without an id can be inserted only. A NULL text has no
        tokens; NULL source and language are groups of their own.
        """
        if batch in self.committed():
            return False
        changes = changes.select(
            "op", F.col("id").cast("string").alias("id"), F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        )
        revised = (
            changes.where("op = 'revise' and id is not null").groupBy("id")
            .agg(F.max(F.struct(F.coalesce(F.length("text"), F.lit(0)).alias("n"), "text", "source", "lang")).alias("last"))
            .select("id", "last.source", "last.lang", "last.text")
        )
        added = self._counted(changes.where("op = 'insert'").select("id", "source", "lang", "text").union(revised))
        ids = changes.where("op in ('revise', 'delete') and id is not null").select("id").distinct()
        gone = (
            self.entries().join(ids, "id", "left_semi").groupBy("id", *GROUP)
            .agg((-F.sum("docs")).alias("docs"), (-F.sum("tokens")).alias("tokens"))
            .where("docs <> 0 or tokens <> 0").select("id", *GROUP, "docs", "tokens")
        )
        entries = self._path("entries", batch)
        added.union(gone).write.mode("overwrite").parquet(entries)
        delta = self.spark.read.schema(_ENTRY).parquet(entries).groupBy(*GROUP).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        delta.write.mode("overwrite").parquet(self._path("deltas", batch))
        return True

    def _counted(self, docs: DataFrame) -> DataFrame:
        """One entry per document and tokenizer version."""
        counts = F.array(
            *[
                F.struct(F.lit(t.version).alias("tokenizer"), F.lit(1).cast("bigint").alias("docs"), t.count(self.spark, F.col("text")).alias("tokens"))
                for t in self.tokenizers
            ]
        )
        return docs.select("id", "source", "lang", counts.alias("counts")).select("id", "source", "lang", F.inline("counts"))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) after the committed batches; groups with no
        documents are left out."""
        return (
            self._read("deltas", "source string, lang string, tokenizer string, docs bigint, tokens bigint")
            .groupBy(*GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
            .where("n_docs <> 0")
        )
