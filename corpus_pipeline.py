"""A training corpus from raw documents, in five stages of the text operators."""

from bandlore.llm import bpe, decontaminate, language, personal, simhash
from bandlore.llm.common import written

#: No SQL states these stages; the tests hold them against brute-force versions.
ORACLE_SQL = None

#: Words of a shingle, and most bits in which the fingerprints of near copies differ.
NEAR_WORDS, NEAR_BITS = 3, 2


def language_id(spark, docs, sf_dir):
    """Documents in a recognisable language stay. Learns from the languages that the documents state."""
    return language.recognised(docs, language.train(docs))


def near_dedup(spark, docs, sf_dir):
    """One document of each group that links of fingerprints connect stays: the one with the smallest doc_id."""
    return simhash.one_per_group(docs, NEAR_WORDS, NEAR_BITS)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark, docs, sf_dir):
    """Personal data in the texts is replaced by the name of its kind."""
    return personal.masked(docs, personal.train(docs))


def encoding(spark, docs, sf_dir):
    """doc_id, token ids and their number."""
    return bpe.encode(docs)


STAGES = [
    ("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
    ("personal_data", personal_data), ("encoding", encoding),
]


def run(spark, sf_dir):
    """The stages applied to the table of documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
