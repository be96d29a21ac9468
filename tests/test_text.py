"""Text functions, chunkers and row chunks against plain Python."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caselight.functions import expansion, rules
from caselight.functions import text as tx
from caselight.operators import chunking, intake
from caselight.sources import rows as src

SAMPLES = [
    "",
    "one",
    "A sentence. Another one here.\nA line\n\nA paragraph " + "word " * 90 + "\n\nend",
    "x" * 700,
    "é ñ ç " * 200 + "\n" + "ß. " * 120,
    "\n\n".join("p" * n for n in (10, 250, 40, 900, 5, 5, 60, 120)),
]


def column(spark, texts, expr):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in frame.select("i", expr.alias("r")).orderBy("i").select("r").collect()]


def test_title_case_is_pythons(spark):
    texts = ["r&d team", "pv team", "o'neil's o-ring", "3rd line", "", "éclair team"]
    assert column(spark, texts, tx.title_case(F.col("text"))) == [t.title() for t in texts]


def test_tokens_keep_accents_and_drop_single_letters(spark):
    texts = ["Él a été là, x_1 y!", "", "a b c", "don't stop"]
    wanted = [re.findall(r"\b\w\w+\b", t.lower()) for t in texts]
    assert column(spark, texts, tx.tokens(F.col("text"))) == wanted


def test_recursive_chunks_cover_the_text(spark):
    size, overlap = 300, 40
    for text, chunks in zip(SAMPLES, column(spark, SAMPLES, chunking.recursive_chunks(F.col("text"), size, overlap))):
        rebuilt = "".join(c if i == 0 else c[overlap:] for i, c in enumerate(chunks))
        assert rebuilt == text
        assert all(0 < len(c) <= size for c in chunks)
        assert all(a[-overlap:] == b[:overlap] for a, b in zip(chunks, chunks[1:]))


def merge_paragraphs(text, size, overlap):
    pieces = [p.strip() for p in text.split("\n\n") if p.strip()]
    done, current = [], []
    for piece in pieces:
        if current and len("\n\n".join([*current, piece])) > size:
            done.append(current)
            while current and (len("\n\n".join(current)) > overlap or len("\n\n".join([*current, piece])) > size):
                current = current[1:]
        current = [*current, piece]
    return ["\n\n".join(g) for g in [*done, *([current] if current else [])]]


def test_paragraph_chunks_match_brute_force(spark):
    for size, overlap in ((300, 50), (1000, 100), (130, 64)):
        found = column(spark, SAMPLES, chunking.paragraph_chunks(F.col("text"), size, overlap))
        assert found == [merge_paragraphs(t, size, overlap) for t in SAMPLES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab .\n", max_size=120), min_size=3, max_size=6))
def test_chunkers_on_any_text(spark, texts):
    found = column(spark, texts, chunking.paragraph_chunks(F.col("text"), 30, 8))
    assert found == [merge_paragraphs(t, 30, 8) for t in texts]
    for text, chunks in zip(texts, column(spark, texts, chunking.recursive_chunks(F.col("text"), 20, 4))):
        assert "".join(c if i == 0 else c[4:] for i, c in enumerate(chunks)) == text


def test_word_and_char_windows(spark):
    words = [[" ".join(t.split()[i : i + 7]) for i in range(0, len(t.split()), 7)] for t in SAMPLES]
    assert column(spark, SAMPLES, chunking.word_windows(F.col("text"), 7)) == words
    for text, chunks in zip(SAMPLES, column(spark, SAMPLES, chunking.char_windows(F.col("text"), 100, 10))):
        assert "".join(c if i == 0 else c[10:] for i, c in enumerate(chunks)) == text


def test_sections_and_header_paths(spark):
    text = "# Title\nlead\n\n## One\nbody one\n### Deep\nx\n## Two\n\n### Deeper\ny\n# Next\n### Odd\nz"
    sections = column(spark, [text, "plain text"], chunking.md_sections(F.col("text")))
    assert [s.section for s in sections[0]] == ["One", "Two"]
    assert sections[0][0].text.startswith("## One\nbody one\n### Deep")
    assert [(s.section, s.text) for s in sections[1]] == [("Introduction", "plain text")]
    paths = column(spark, [text], chunking.md_header_paths(F.col("text")))[0]
    assert [(p.h1, p.section_heading, p.subsection_heading) for p in paths] == [
        ("Title", None, None), ("Title", "One", None), ("Title", "One", "Deep"), ("Title", "Two", None),
        ("Title", "Two", "Deeper"), ("Next", None, None), ("Next", None, "Odd"),
    ]
    assert paths[2].text == "### Deep\nx"


def test_html(spark):
    page = (
        "<html><style>p{}</style><script>var a='<p>no</p>';</script><body><!-- gone --><article>early &amp; bird"
        "</article><h2> Returns </h2><article id='faq-1'><h3>How?</h3>\n <p>Like   this.</p></article>"
        "<div>Please sign in to see this page now</div><p>short</p><p>A snippet that is long enough.</p></body></html>"
    )
    articles = column(spark, [page], src.faq_articles(F.col("text")))[0]
    assert [(a.question_number, a.section, a.text) for a in articles] == [
        ("faq-unknown", "General", "early & bird"), ("faq-1", "Returns", "How? Like this."),
    ]
    plain = column(spark, [page], tx.html_to_text(F.col("text")))[0]
    assert "gone" not in plain and "var a" not in plain and plain.splitlines()[0] == "early & bird"
    snippets = F.filter(tx.html_snippets(F.col("text")), lambda s: tx.not_boilerplate(s))
    assert column(spark, [page], snippets)[0] == ["A snippet that is long enough."]


def test_synonym_variants(spark):
    queries = ["cheap ANC Earbuds", "Finance news", "plain"]
    found = column(spark, queries, expansion.variants(F.col("text")))
    assert found == [
        ["cheap ANC Earbuds", "cheap ANC earphones", "affordable ANC Earbuds"],
        ["Finance news", "Finactive noise cancellatione news"],
        ["plain"],
    ]


# Team names and whether they may submit; a single word is taken for a person.
TEAMS = {
    "PV Team": True, "CMC Regulatory": True, "Pharmacovigilance": False, "Priya": False, "John": False,
    "": False, "   ": False,
}


def test_team_names_and_failing_fields(spark):
    assert dict(zip(TEAMS, column(spark, list(TEAMS), intake.team_is_valid(F.col("text"))))) == TEAMS
    record = spark.createDataFrame(
        [("safety_signal", "ICH_E2A", None, "soon", " pv team ")], ", ".join(f"{f} string" for f in rules.INTAKE_FIELDS)
    )
    checked = intake.validate(record).first()
    assert checked.failing == ["product_area", "urgency"] and checked.submitting_team == "Pv Team"
    valid, bad = intake.split_valid(intake.validate(record))
    assert (valid.count(), bad.count()) == (0, 1)


# Intake messages; only a stated number of days sets the urgency.
MESSAGES = {
    "PV team here. We have a serious unexpected SUSAR for study NCT-2244 and need to report to EMA within 15 days per ICH E2A.": "urgent",
    "Hi, we need to file a Type II variation for our cardiovascular product with the EMA.": None,
    "CMC Regulatory here. FDA issued a 483 observation on our manufacturing site in Pune. We have 15 business days to respond.": "urgent",
    "Can you check what the weather is like in Mumbai today?": None,
    "ASAP please, this is an urgent request!": None,
    "Answer within 3 days.": "critical",
}


def test_deadlines(spark):
    assert column(spark, list(MESSAGES), rules.deadline_urgency(F.col("text"))) == list(MESSAGES.values())


def test_fenced_json(spark):
    replies = ['```json\n{"k": 1}\n```', '{"k": 2}', '```{"k": 3}```', '{"k": 4} and', '{"k": 5}] [', "no", '{"k":']
    found = column(spark, replies, intake.parse_fenced(F.col("text"), "k long"))
    assert [r and r.k for r in found] == [1, 2, 3, None, None, None, None]


def test_log_safe_refuses_raw_text(spark):
    turns = spark.createDataFrame([(1, "t", *[None] * 5)], "id int, text string, " + ", ".join(f"{f} string" for f in rules.INTAKE_FIELDS))
    assert "text" not in intake.log_safe(turns, "id").columns
    with pytest.raises(ValueError):
        intake.log_safe(turns, "id", "text")


def test_character_references_as_the_standard_library_decodes_them(spark):
    import html
    from html.entities import html5

    names = sorted(n for n in html5 if n.endswith(";"))
    texts = [" ".join(f"&{n}" for n in names[i : i + 40]) for i in range(0, len(names), 40)]
    texts += ["caf&eacute; &#8217;x&#x2019;", "&#150;&#x80;&#129;", "&#0;&#xD800;&#1114112;", "&amp;lt; && &; &#; &bogus; a&b;", "", "none", "&#128512;", "&ngE;x"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    found = {r.id: r.t for r in frame.select("id", tx.decode_entities(F.col("t")).alias("t")).collect()}
    for i, t in enumerate(texts):
        if "&amp;lt;" not in t:
            assert found[i] == html.unescape(t), t
    assert found[len(texts) - 5] == "&lt; && &; &#; &bogus; a&b;"
