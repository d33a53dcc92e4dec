"""From raw documents to sharded training text: five operators, each a Spark job.

Every stage gets the rows its predecessor kept and decides on all of them.
`run` applies them to the documents table; between stages the rows are written
to the folder in spark.checkpoint.dir and read again, so a lost executor costs
one stage at most.
"""

from reachmap.llm.common import table
from reachmap.llm.decontam import decontaminate
from reachmap.llm.langid import with_language
from reachmap.llm.mixing import mixed
from reachmap.llm.ngram_join import one_of_each
from reachmap.llm.sharding import assign
from reachmap.session import cut


def language_id(spark, docs, sf_dir):
    """Documents whose language can be told; those without a letter go."""
    return with_language(docs)


def ngram_join(spark, docs, sf_dir):
    """One document of each group of near copies: that with the smallest id."""
    return one_of_each(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without a window of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark, docs, sf_dir):
    """Rows of each source as often as its target weight asks."""
    return mixed(docs)


def sharding(spark, docs, sf_dir):
    """A shard and slot for every row."""
    return assign(docs)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]
# Language models, similarity joins and capacities are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order over the documents table; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
