"""Training-data operators: filtering, deduplication, tokenising, archives.

Nothing outside this package imports it; the queries over the harness tables
are in ``quarry.llm.queries``.
"""
