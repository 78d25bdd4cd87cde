"""A training corpus from ``documents``, in stages; each stage is written as Parquet and read by the next.

Every stage but the last returns the columns of ``documents``; rows with nulls, repeated rows, empty tables and
extra columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import language
from gaugeline.llm.common import MADE, written
from gaugeline.llm.exact_dedup import drop_copies
from gaugeline.llm.mixing import mixed
from gaugeline.llm.near_dedup import drop_near_copies
from gaugeline.llm.packing import pack
from gaugeline.llm.queries import held_out
from gaugeline.session import drop_folder

# Folders in the shared folder that stages read to make their results.
LEFT: list[str] = []

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(build: Stage) -> Stage:
    """A stage first removes what earlier ones left: their results were written before it was called."""

    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        for folder in [x for x in LEFT if not any(x in file for file in read)]:
            drop_folder(spark, folder)
            LEFT.remove(folder)
        before = len(MADE)
        out = build(spark, docs, sf_dir)
        # The last stage's result is not written here, so what it reads stays.
        if build is not packing:
            LEFT.extend(MADE[before:])
        return out

    return run_stage


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language stay, those without a letter go. Without any labelled row no language is known, and all stay."""
    # Columns under numbers, so that none clashes with what the operator adds.
    plain = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    name = {c: f"c{n}" for n, c in enumerate(docs.columns)}
    model = language.fit(plain.filter(~held_out(name["doc_id"])), name["text"], name["lang"])
    if not model.languages:
        return docs
    labelled = language.label(plain, model, name["text"], keep=tuple(plain.columns))
    good = labelled.filter(F.col("lang_pred") != language.UNKNOWN)
    return good.select(*plain.columns).toDF(*docs.columns)


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that of the smallest id."""
    return drop_copies(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays, that of the smallest id."""
    return drop_near_copies(docs)


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources give words by weight; rows repeat where a source is taken more than once."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, token ids included, in sequences of at most 1024 tokens."""
    return pack(docs)


packing_stage = stage(packing)

STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing_stage),
]

# Language models, near duplicates and token ids have no SQL twin; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, build in STAGES[:-1]:
        docs = written(build(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
