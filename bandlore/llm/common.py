"""Helpers shared by the text operators: byte-level words, stage tables, bounded labelled samples."""

import os

from pyspark.sql import functions as F

from bandlore.session import scratch_path, stable

#: A-Z to a-z, everything else as it is. In UTF-8 these bytes occur nowhere else.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

__all__ = ["LOWER", "binary_text", "rows_read", "sampled", "stable", "tokenizer_path", "written"]


def binary_text(docs, *keep):
    """The kept columns and the whole text as UTF-8 bytes (null stays null) in ``text``."""
    return docs.select(*keep, F.col("text").cast("binary").alias("text"))


def written(df, name):
    """``df`` as a Parquet table in the shared folder: later readers never recompute it, whatever executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled(rows, limit, key="doc_id"):
    """About ``limit`` rows of ``rows``, chosen by the hash of ``key``; all of them if there are fewer.

    The bound is for fitting models on labelled rows only.
    """
    total = rows.count()
    if total <= limit:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1_000_003)) < int(1_000_003 * limit / total))


def rows_read(batches, *columns):
    """The Arrow batches of a task as tuples of Python lists."""
    for batch in batches:
        yield tuple(batch.column(c).to_pylist() for c in columns)


def tokenizer_path(name="word_bpe_49k.json"):
    """Where the vocabulary file of a public tokenizer is installed on this machine."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
