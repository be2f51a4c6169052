"""Delta-maintained token totals by source, language and tokenizer version.

A batch holds signed changes: documents inserted, deleted, or counted anew (the old count goes out, the new
one comes in).  It is summed by key before it is written, and takes effect when its row in the commit table
appears, so a batch that is replayed, or tried again after a crash, counts once.  Totals are the sum of what
committed batches hold; no document is read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, batch_id string"


def signed(counts: DataFrame, tokenizer: str, n_tokens: str | Column, sign: int) -> DataFrame:
    """Changes ``(source, lang, tokenizer, n_docs, n_tokens)`` that add (1) or take away (-1) counted documents.

    A null source, language or count is a key of its own, or zero tokens; repeated rows count each; an empty
    table changes nothing; other columns are ignored.
    """
    n = F.coalesce((F.col(n_tokens) if isinstance(n_tokens, str) else n_tokens).cast("bigint"), F.lit(0))
    return counts.select(
        F.col("source").cast("string"), F.col("lang").cast("string"), F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("bigint").alias("n_docs"), (sign * n).alias("n_tokens")
    )


def revised(counts: DataFrame, tokenizer: str, old: str, new: str) -> DataFrame:
    """Changes that put the ``new`` count of every document in place of the ``old`` one.

    Null counts are as in :func:`signed`; equal counts change nothing; repeated rows are revised each, and an
    empty table changes nothing.
    """
    changed = counts.where(~F.col(old).eqNullSafe(F.col(new)))
    return signed(changed, tokenizer, old, -1).unionByName(signed(changed, tokenizer, new, 1))


def _escaped(name: str) -> str:
    """A folder's name in which every ASCII character but letters, digits, - and _ is its code."""
    return "".join(c if c.isalnum() or c in "-_" or ord(c) > 127 else f"%{ord(c):02X}" for c in name)


class TokenTotals:
    """A totals table in a folder that driver and executors share; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        """``batch_id`` of every committed batch."""
        return self._read("commits", "n_keys bigint, batch_id string").select("batch_id")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch of changes; False, and nothing done, if a batch of that id is committed already.

        What an attempt that didn't get as far as the commit has left is overwritten.  A batch without rows
        commits too.  Any text but the empty one is a batch id.
        """
        if not batch_id:
            raise ValueError("a batch needs an id")
        folder = f"batch_id={_escaped(batch_id)}"  # Spark decodes it as it reads the folder's name
        if not self.commits().where(F.col("batch_id") == batch_id).isEmpty():
            return False
        summed = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        summed.write.mode("overwrite").parquet(f"{self.path}/deltas/{folder}")
        one = self.spark.range(1).select(F.lit(summed.sparkSession.read.parquet(f"{self.path}/deltas/{folder}").count()).cast("bigint").alias("n_keys"))
        one.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{folder}")
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` over all committed batches; keys that sum to nothing go."""
        deltas = self._read("deltas", DELTA).join(self.commits(), "batch_id", "left_semi")
        summed = deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0 OR n_tokens <> 0")


#: Tokenizer versions that are counted by a pattern: what one token is.
WORDS, LONG_WORDS, PIECES = r"[^\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]{2,}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def counted(docs: DataFrame, patterns: dict[str, str], text: str = "text") -> DataFrame:
    """``doc_id, source, lang``, the text's key ``h1, h2, h3`` and a count per pattern, a row per document.

    Null text counts as empty; empty texts have no tokens; very long ones are counted as a whole.  Repeated
    rows stay repeated, an empty table gives an empty one, and other columns are left out.  The key is two
    64-bit hashes and the length: equal texts have it in common.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = [F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2"), F.char_length(t).alias("h3")]
    return docs.select("doc_id", "source", "lang", *key, *[F.regexp_count(t, F.lit(p)).cast("bigint").alias(n) for n, p in patterns.items()])


def firsts(counts: DataFrame) -> DataFrame:
    """One counted row per text: that of the smallest id (null ids last; ties: the smallest source, then language).

    It is an aggregate that every task begins on its own rows, however many copies a text has.  An empty table
    gives an empty one; all columns of ``counts`` are kept.
    """
    others = [c for c in counts.columns if c not in ("doc_id", "source", "lang")]
    whole = F.struct(F.col("doc_id").isNull().alias("last"), *[F.col(f"`{c}`") for c in ("doc_id", "source", "lang", *others)])
    least = counts.groupBy("h1", "h2", "h3").agg(F.min(whole).alias("r"))
    return least.select(*[F.col(f"r.`{c}`").alias(c) for c in counts.columns])


def copies(counts: DataFrame) -> DataFrame:
    """The counted rows but for the first of every text; rows that repeat one are copies, too."""
    return counts.exceptAll(firsts(counts))


def copies_removed(counts: DataFrame, tokenizer: str, n_tokens: str) -> DataFrame:
    """Changes that take away all copies: every row goes and the first of its text comes back."""
    return signed(counts, tokenizer, n_tokens, -1).unionByName(signed(firsts(counts), tokenizer, n_tokens, 1))
