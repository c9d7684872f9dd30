"""From raw documents to packed training sequences, each stage one operator of `streamcurate.llm`.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept.
"""

from streamcurate.llm import decontamination, language_id, ngram_join, packing, secret_scan
from streamcurate.llm.common import materialize, scrap, table


def identify_language(spark, docs, sf_dir):
    """Documents whose language is recognised, unchanged."""
    return language_id.recognised(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of copies and near copies, unchanged."""
    return ngram_join.deduplicate(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents that aren't contaminated with benchmark items, unchanged."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark, docs, sf_dir):
    """All documents, live-looking secrets replaced by a mark."""
    return secret_scan.redact(docs)


def pack_sequences(spark, docs, sf_dir):
    """The pieces of all documents and their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Language models and tokenisation have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        older, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        if i:
            scrap(older)
    return STAGES[-1][1](spark, docs, sf_dir)
