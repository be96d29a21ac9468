"""Jobs made of the operators, and the queries that check them."""

import importlib

MODULES = [
    "ticket_queries",
    "source_queries",
    "chunk_queries",
    "vector_queries",
    "retrieval_queries",
    "intake_queries",
    "evaluation_queries",
    "share_queries",
    "stream_queries",
    "rule_queries",
]


def load_queries():
    """(queries, SQL twins) of all modules."""
    from caselight.registry import ORACLE, QUERIES

    for name in MODULES:
        importlib.import_module(f"caselight.plans.{name}")
    return QUERIES, ORACLE
