"""From raw documents to a training mix: stages over the operators of ``dossier.llm``.

Each stage is a function of (spark, docs, sf_dir). Its result is written as
Parquet in the shared folder and read again as the next stage's documents.
"""

from dossier.llm.decontamination import without_copies
from dossier.llm.lines import dedup_lines
from dossier.llm.mixing import mixed_documents
from dossier.llm.quality import keep_good
from dossier.llm.simhash import keep_one
from dossier.llm.tables import read_table
from dossier.operators.staging import scratch_dir, scratch_run, staged


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the quality rules."""
    return keep_good(docs)


def line_dedup(spark, docs, sf_dir):
    """Documents without the lines that nearly repeat an earlier line."""
    return dedup_lines(docs)


def simhash_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold no copy of a benchmark item."""
    return without_copies(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark, docs, sf_dir):
    """Documents with the number of times each goes into the mix."""
    return mixed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# Mixing draws by hashes that SQL does not have.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        # What a stage has written for itself goes once its result is stored.
        with scratch_run(spark):
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}", scratch_dir(spark))
    return docs
