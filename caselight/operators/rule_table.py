"""First matching rule of a large rule table, found by an index of required literals instead of every pattern on every text.

A rule is (priority, pattern, label, confidence); a text takes the rule of least priority whose pattern occurs in it.
Every pattern is split at its top-level ``|``; each alternative's required literal runs (text that every match holds,
outside groups, classes, escapes and optional parts) are read by ``required_runs``. An alternative's anchor is the
trigram of its runs that the fewest texts hold, counted over all texts. A text is a candidate for a rule when it holds
an anchor of one of the rule's alternatives: text trigrams meet anchors in one equi-join, and only candidates are
checked by the regular expression. A rule with an alternative without a run of three characters cannot be anchored;
such rules (at most ``MOST_OPEN`` of them, else a clear error) are one ordered CASE over every text, so nothing is missed.

Scale: trigrams are distinct per text; their counts are partial aggregates; the anchor table has one row per
alternative and is sent to the texts when the rules hold at most ``MOST_SENT`` trigrams, so that only matches are
exchanged; no text side is ever sent, and no pair of a text and a rule is formed without a shared anchor. A null text matches no rule and takes the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselight.session import cut_lineage, rows_if_bounded

GRAM = 3
MOST_OPEN = 512
MOST_SENT = 200_000  # trigrams of rules that are sent to the texts; with more, both meet in an exchange
_QUANTIFIERS = "?*{"


def alternatives(pattern: str) -> list[str]:
    """The top-level alternatives of a pattern."""
    parts, depth, start, i, in_class = [], 0, 0, 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 2
            continue
        if in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
            if pattern[i + 1 : i + 2] == "^":
                i += 1
            if pattern[i + 1 : i + 2] == "]":
                i += 1
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "|" and depth == 0:
            parts.append(pattern[start:i])
            start = i + 1
        i += 1
    return [*parts, pattern[start:]]


def _skip_class(text: str, i: int) -> int:
    """Index after the character class that starts at ``i``."""
    i += 1
    if text[i : i + 1] == "^":
        i += 1
    if text[i : i + 1] == "]":
        i += 1
    while i < len(text) and text[i] != "]":
        i += 2 if text[i] == "\\" else 1
    return i + 1


def _skip_group(text: str, i: int) -> int:
    """Index after the group or class that starts at ``i``."""
    if text[i] == "[":
        return _skip_class(text, i)
    depth = 0
    while i < len(text):
        c = text[i]
        if c == "\\":
            i += 2
            continue
        if c == "[":
            i = _skip_class(text, i)
            continue
        depth += {"(": 1, ")": -1}.get(c, 0)
        i += 1
        if depth == 0:
            return i
    return i


def _skip_quantifier(text: str, i: int) -> int:
    if i < len(text) and text[i] == "{":
        i = text.find("}", i) + 1 or len(text)
    elif i < len(text) and text[i] in "?*+":
        i += 1
    if i < len(text) and text[i] in "?+":  # lazy or possessive
        i += 1
    return i


def required_runs(alternative: str) -> list[str]:
    """Literal runs that every match of ``alternative`` (a pattern without top-level ``|``) holds."""
    runs, run, i = [], "", 0

    def close():
        nonlocal run
        if run:
            runs.append(run)
        run = ""

    while i < len(alternative):
        c = alternative[i]
        if c in "([":
            close()
            i = _skip_quantifier(alternative, _skip_group(alternative, i))
        elif c == "\\":
            close()
            i = _skip_quantifier(alternative, i + 2)
        elif c in _QUANTIFIERS:
            run = run[:-1]  # the last character may be absent
            close()
            i = _skip_quantifier(alternative, i)
        elif c == "+":
            close()
            i = _skip_quantifier(alternative, i)
        elif c in ".^$)":
            close()
            i += 1
        else:
            run += c
            i += 1
    close()
    return runs


def _trigrams_of_rule(pattern: str) -> list[list[str]] | None:
    """Per alternative, the trigrams of its required runs; None when one alternative has none."""
    found = []
    for alternative in alternatives(pattern):
        grams = sorted({run[k : k + GRAM] for run in required_runs(alternative) for k in range(len(run) - GRAM + 1)})
        if not grams:
            return None
        found.append(grams)
    return found


def text_trigrams(texts: DataFrame, kept: list[str], low: Column) -> DataFrame:
    """(*kept, gram): the distinct trigrams of every text."""
    grams = F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - GRAM + 1, F.lit(1))), lambda k: F.substring(low, k, GRAM))
    )
    return texts.select(*kept, F.explode(F.filter(grams, lambda g: F.length(g) == GRAM)).alias("gram"))


def first_rule(texts: DataFrame, key: str, text: str, rules: DataFrame) -> DataFrame:
    """(key, priority, label, confidence) of the first rule each text holds; texts without any have no row.

    ``rules``: priority (unique long), pattern (Java regular expression, matched against the lower-cased text with only
    a line feed ending a line), label, confidence.
    """
    low = F.lower(F.col(text))
    plain = texts.select(key, low.alias("low")).filter(F.col("low").isNotNull())

    def grams_of(pattern: str | None):
        found = _trigrams_of_rule(pattern or "")
        return [] if found is None else [[alt, g] for alt, grams in enumerate(found) for g in grams]

    shape = "array<struct<alt:int,gram:string>>"
    to_grams = F.udf(lambda p: [{"alt": a, "gram": g} for a, g in grams_of(p)], shape)
    marked = cut_lineage(rules.select("priority", "pattern", to_grams("pattern").alias("grams")))
    open_rules = rows_if_bounded(
        marked.filter(F.size("grams") == 0).select("priority", "pattern").orderBy("priority"), MOST_OPEN
    )
    if open_rules is None:
        raise ValueError(f"more than {MOST_OPEN} rules have an alternative without a literal of {GRAM} characters")

    # Of rules with one pattern only the first can be a text's first.
    first_of = marked.filter(F.size("grams") > 0).groupBy("pattern").agg(
        F.min("priority").alias("priority"), F.any_value("grams").alias("grams")
    )
    wanted = cut_lineage(first_of.select("priority", "pattern", F.explode("grams").alias("g")).select("priority", "pattern", "g.*"))
    # Sizes of exploded texts are estimated far too low, so that each join is told which side may be sent.
    sent = wanted.count() <= MOST_SENT
    meet = F.broadcast if sent else (lambda side: side.hint("merge"))
    anchored = plain.filter(F.col(key).isNotNull())
    in_texts = text_trigrams(anchored, [key], F.col("low"))
    counts = in_texts.join(meet(wanted.select("gram").distinct()), "gram").groupBy("gram").agg(F.count("*").alias("df"))
    rated = wanted.join(counts, "gram", "left").fillna(0, ["df"])
    anchors = cut_lineage(
        rated.groupBy("priority", "pattern", "alt").agg(F.min(F.struct("df", "gram"))["gram"].alias("gram"))
        .select("gram", "priority", "pattern").distinct()
    )
    if sent:  # texts stay where they are, from their trigrams to the check
        candidates = text_trigrams(anchored, [key, "low"], F.col("low")).join(F.broadcast(anchors), "gram")
    else:
        met = in_texts.join(anchors.hint("merge"), "gram").select(key, "priority", "pattern").distinct()
        candidates = met.join(anchored.hint("merge"), key)
    checked = candidates.filter(F.expr("low rlike concat('(?d)', pattern)")).select(key, "priority")
    if open_rules:
        chain = None
        for row in open_rules:
            hit = F.col("low").rlike("(?d)" + row.pattern)
            chain = F.when(hit, F.lit(row.priority)) if chain is None else chain.when(hit, F.lit(row.priority))
        checked = checked.unionByName(plain.select(key, chain.alias("priority")).filter(F.col("priority").isNotNull()))
    first = checked.groupBy(key).agg(F.min("priority").alias("priority"))
    told = rules.select("priority", "label", "confidence")
    return first.join(meet(told), "priority").select(key, "priority", "label", "confidence")
