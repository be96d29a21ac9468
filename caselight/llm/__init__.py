"""Operators for preparing training data: near-copies, extraction, scoring, tokens, packing, vectors, chats."""


def load_queries():
    """(queries, SQL twins) of this folder."""
    from caselight.llm import queries

    return dict(queries.QUERIES), dict(queries.ORACLE)
