"""Documents through five text operators: language, quality, near-duplicates, mixing and packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor; all but the last return the
columns of documents. A stage's rows are written before the next one starts, which then deletes the intermediate
tables of those before. Defined cases are those of the operators: see mediaspark/llm. An empty table stays empty.
"""

from functools import wraps

from mediaspark.llm import language, minhash, mixing, op10, quality
from mediaspark.llm.common import discard, noted, saved
from mediaspark.llm.registry import table

_LEFT = []  # what the stage before has saved for its result


def stage(function):
    """A stage that first deletes what the one before, whose rows are written by now, has left."""

    @wraps(function)
    def staged(spark, docs, sf_dir):
        discard(*(t for t in _LEFT if t.sparkSession is spark))
        _LEFT.clear()
        with noted() as made:
            result = function(spark, docs, sf_dir)
        _LEFT.extend(made)
        return result

    return staged


@stage
def language_id(spark, docs, sf_dir):
    """Documents without a main language go."""
    return language.filtered(docs)


@stage
def quality_rules(spark, docs, sf_dir):
    """Documents that fail the limits or the trees go."""
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


@stage
def near_duplicates(spark, docs, sf_dir):
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return minhash.one_of_each(docs)


@stage
def source_mix(spark, docs, sf_dir):
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


@stage
def packed_sequences(spark, docs, sf_dir):
    """Pieces of token ids with their places in sequences of at most 1,024."""
    return op10.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

# The first stages learn models, which SQL cannot express; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = saved(step(spark, docs, sf_dir))
    return docs
