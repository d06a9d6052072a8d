"""A corpus through five stages: language, repeated lines, near-duplicates, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of ``documents``.  ``run`` writes every stage's result to the shared folder and reads it back for the next one.

Defined results: a null text, an empty one and one without a letter have no language and go in the first stage; a text
whose lines are all repeated is empty after the second one, and all empty texts are one group in the third, of which the
smallest id stays.  Of a group of near copies the smallest id stays, with all rows that repeat it.  Rows without an id stay
in the third stage and pass the fourth one unread, and each has its row of tokens.  Very long texts are read whole.  An
empty table stays empty, and other columns are carried along to the last stage, which returns op2's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillflow.llm.op01_decontamination import without_leaks
from rillflow.llm.op02_bpe import op02_bpe
from rillflow.llm.op08_lines import without_repeated_lines
from rillflow.llm.op09_simhash import SIMILARITY, keep_one
from rillflow.llm.op10_language import keep_recognised
from rillflow.llm.util import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_recognised(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op02_bpe(docs)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("tokens", tokens)]

#: SQL can't express the language model, the components of near copies, the templates or the merges; tests/llm compares the operators
#: of lines, near copies and tokens with brute force, that of decontamination with plain windows, and the language with labels held out.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
