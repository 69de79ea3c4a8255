"""All queries of the core, and the SQL that gives the same rows."""

from driftmill.plans import corpus, pages, problems

QUERIES = {**corpus.QUERIES, **pages.QUERIES, **problems.QUERIES}
SQL = {**corpus.SQL, **pages.SQL, **problems.SQL}
