"""A training corpus from ``documents`` in five stages.

language ID      documents in none of the learned languages go
line dedup       runs of lines that occur before are deleted; documents of nothing else go
jaccard join     of each group of near copies the one with the least id stays
decontamination  documents with much text of the benchmark go
bpe              documents get their token ids, and a digest of what these decode to

A stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; what it
returns is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``docs``. Nulls in any column, empty and very long
texts, repeated rows and ids, further columns of any name and empty tables are
allowed: each operator's module says what it makes of them. Null and empty texts
have no language and go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.bpe import bpe_round_trip, default_model_path, without
from basketry.llm.common import SPACES, documents, quoted, stored
from basketry.llm.decontamination import decontaminate
from basketry.llm.jaccardjoin import jaccard_components
from basketry.llm.langid import fit, identify
from basketry.llm.linededup import dedup_lines
from basketry.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language isn't rejected; the models learn from the labelled rows of ``docs``."""
    return identify(docs, fit(docs)).where("not rejected").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without repeated runs of lines. ``text`` changes, and ``n_chars`` with it, where lines
    were deleted; rows of which no word is left go."""
    found = dedup_lines(docs)
    changed = F.size("deleted") > 0
    new = {"text": F.col("text"), "n_chars": F.length("text")}
    columns = [
        F.when(changed, new[c].cast(docs.schema[c].dataType)).otherwise(F.col("row")[c]).alias(c) if c in new else F.col("row").getField(c).alias(c)
        for c in docs.columns
    ]
    return found.where(~changed | (F.btrim("text", F.lit(SPACES)) != "")).select(*columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one of least id; of repeated ids, one row."""
    return jaccard_components(docs).where("first").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that aren't contaminated by the table ``benchmark``."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("not contaminated").select("row.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with ``ids``, ``n_tokens`` and ``decoded_sha256``; columns of these names are replaced."""
    out = bpe_round_trip(without(docs, "n_tokens", "decoded_sha256"), default_model_path())
    old = [quoted(c) for c in out.columns if c not in ("ids", "decoded")]
    return out.select(*old, "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("bpe", bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


#: SQL has neither the language models nor the tokenizer.
ORACLE_SQL = None
