"""From documents to token ids: quality rules, line dedup, near-dedup, decontamination, BPE.

Each stage takes the documents that the one before kept, and its decisions take effect in what it
returns: the columns of ``documents``, with ``n_chars`` counting the text as it is now. The last stage
returns ``doc_id``, ``lang``, ``source``, ``n_tokens``, ``ids`` and ``text``, the text being what the ids decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.byte_bpe import encode
from daybook.llm.decontamination import decontaminated
from daybook.llm.line_dedup import line_dedup
from daybook.llm.minhash_dedup import near_dedup
from daybook.llm.quality_rules import quality_rules
from daybook.llm.rows import mark, quoted, remove_since, stored

TOKENIZER = "byte_bpe_multi_50k.tiktoken"

_WORD = r"[^\x20\x09-\x0D]"


def _as_before(frame: DataFrame, docs: DataFrame) -> DataFrame:
    return frame.select(*[F.col(quoted(name)) for name in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _as_before(quality_rules(docs, labels).where("kept"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents whose words were all in them."""
    thinned = line_dedup(docs)
    left = thinned.where((F.col("n_removed") == 0) | F.col("text").rlike(_WORD))
    return _as_before(left.withColumn("n_chars", F.length("text").cast("long")), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    coded = encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    text = F.decode("decoded", "UTF-8").alias("text")
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", text)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_dedup", near),
    ("decontamination", benchmark),
    ("byte_bpe", tokens),
]

#: SQL cannot express the trained verdict, the latent search and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next.

    What a stage read and stored on its way is removed when its result is written.
    """
    start = mark()
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        frame = stored(stage(spark, frame, sf_dir))
        remove_since(start)
    return STAGES[-1][1](spark, frame, sf_dir)
