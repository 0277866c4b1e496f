"""spendloom: statement normalisation and spending analytics on Spark.

Every operator is a DataFrame -> DataFrame or Column -> Column function built
from Spark's own expressions, so Catalyst can prune, push down and codegen the
whole job. No Python row functions run in any query.

Layout
------
``functions``  scalar cleaners (amounts, dates, descriptions, keyword scans)
``operators``  statement normalisation, ordered scans, spending and quality
``sources``    readers and writers for sheets, extracted tables, statements
``plans``      the registered queries over the driver tables
"""

from spendloom.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
