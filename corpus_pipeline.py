"""The corpus pipeline: quality, line dedup, near-duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet and hands the reread table to the next. What a stage wrote
on its way goes when its result is written, the result when the next one is; if a stage fails,
all goes. All but the last return the columns of ``documents``. The mix repeats documents of
sources drawn more than once, so its doc_ids may occur twice and are packed
twice.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from carecast import storage
from carecast.llm import lines, mixing, near_duplicates, packing, quality_classifier
from carecast.llm.common import read
from carecast.session import job_scope, shared_dir, ship_package


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality_classifier.reject_low_quality(docs, read(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return lines.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_duplicates.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", classify_quality),
    ("line dedup", dedup_lines),
    ("minhash near-dedup", drop_near_duplicates),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Training, prefix doubling, sketches and token ids have no SQL form; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = read(spark, sf_dir, "documents"), []
    try:
        for name, stage in STAGES:
            with job_scope(spark):
                result = stage(spark, docs, sf_dir)
                written.append(os.path.join(shared_dir(spark), f"pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex[:12]}"))
                result.write.parquet(written[-1])
            docs = spark.read.parquet(written[-1])
            for path in written[:-1]:
                storage.delete(spark, path)
            del written[:-1]
    except BaseException:
        for path in written:
            storage.delete(spark, path)
        raise
    return docs
