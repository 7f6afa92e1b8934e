"""The corpus pipeline: documents in, packed training batches out.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
All stages but the last return the columns of documents.

Defined results, for every stage: a null or empty text is rejected by the quality rules;
later stages, given one, keep it (no lines, no shingles, size 0) and packing gives it one
row of length 0. Very long texts are treated whole; packing cuts them into pieces. Repeated
rows are judged each by the quality rules; line and near dedup take rows of equal id and text as
one document; mixing and packing count each. Rows with a null id are neither
changed nor removed by the dedup stages. Ties go to the smaller id or hash, as the operators'
modules say. An empty table gives an empty result. Extra columns of any name pass through
all stages but the last, which returns its own columns.
"""

from __future__ import annotations

from verdant.llm import linedup, mixing, packing, quality, setsketch
from verdant.llm.common import written
from verdant.sources.tables import table


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules or the label model reject go."""
    return quality.keep_good(docs)


def line_dedup(spark, docs, sf_dir):
    """Blocks of lines that an earlier document holds go; documents left without a word go."""
    return linedup.dedup_lines(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates (five words, similarity 0.8) stays."""
    return setsketch.keep_one_each(docs)


def mix_sources(spark, docs, sf_dir):
    """Sources at their target weights; documents taken twice are two rows."""
    return mixing.mix_sources(docs)


def pack(spark, docs, sf_dir):
    """Every piece of every row with its length bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup),
          ("mixing", mix_sources), ("packing", pack)]

# Label models and alignments have no SQL form; tests hold run() against a plain-Python version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Rows of the last stage over the whole of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
