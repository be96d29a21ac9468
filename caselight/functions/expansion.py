"""Query variants from a synonym table, and templates by key."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Synonyms in dictionary order.
SYNONYMS = [
    ("earphones", ["earbuds", "TWS earbuds", "in-ear headphones"]),
    ("earbuds", ["earphones", "TWS", "in-ear headphones"]),
    ("headphones", ["over-ear headphones", "headset"]),
    ("mobile", ["smartphone", "phone", "handset"]),
    ("kurtis", ["kurta", "ethnic wear", "Indian wear"]),
    ("kurta", ["kurti", "ethnic top"]),
    ("returns", ["refund", "exchange", "send back"]),
    ("refund", ["money back", "return"]),
    ("cheap", ["affordable", "budget", "low price"]),
    ("noise cancellation", ["ANC", "active noise cancelling"]),
    ("ANC", ["active noise cancellation", "noise cancelling"]),
]

# The same table for part names.
PART_SYNONYMS = [
    ("small", ["compact"]),
    ("bolt", ["screw"]),
    ("ring", ["washer"]),
    ("gear", ["cog"]),
    ("ANC", ["active noise cancellation"]),
    ("old", ["used"]),
    ("cold", ["cool"]),
]


def variants(query: Column, synonyms: list = SYNONYMS, per_term: int = 1, most: int = 3) -> Column:
    """The query, then one variant per matching term and synonym, distinct, in order, at most ``most``.

    Terms match anywhere, also inside words, and without regard to case.
    """
    low, tries = F.lower(query), [query]
    for term, others in synonyms:
        for other in others[:per_term]:
            swapped = F.regexp_replace(query, "(?iu)" + re.escape(term), other.replace("$", r"\$"))
            tries.append(F.when(F.contains(low, F.lit(term.lower())), swapped))
    return F.slice(F.array_distinct(F.array_compact(F.array(*tries))), 1, most)


# Prompt openings by persona; the first is the default.
PERSONAS = {
    "shopper": "Help the shopper with order {order}",
    "seller": "Advise the seller on order {order}",
    "support": "Help the agent with order {order}",
}


def template_for(key: Column, templates: dict[str, str] = PERSONAS) -> tuple[Column, Column]:
    """(key used, template); an unknown or null key takes the first entry."""
    first = next(iter(templates))
    used = F.when(key.isin(list(templates)), key).otherwise(F.lit(first))
    pairs = F.create_map(*[F.lit(x) for item in templates.items() for x in item])
    return used, F.element_at(pairs, used)
