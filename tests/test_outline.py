"""Headings, skipping and hierarchy against a plain restatement, and golden cases."""

import random
import re

import pytest

from docloom.operators import chunking, outline

WORDS = ["alpha", "beta", "gamma", "delta", "omega"]


def docs(spark, *texts):
    return spark.createDataFrame(
        [(f"f{i}.json", t) for i, t in enumerate(texts)], "source_file string, md string"
    )


def headings(spark, text):
    rows = outline.parse_headings(docs(spark, text)).orderBy("pos").collect()
    return [(r.level, r.title, r.body) for r in rows]


def entries(spark, *texts):
    rows = outline.markdown_to_entries(docs(spark, *texts)).orderBy("source_file", "entry_pos")
    return [
        (r.source_file, r.entry_pos, r.metadata.title, r.metadata.hierarchy, r.content)
        for r in rows.collect()
    ]


BODY = "A body that is long enough."


@pytest.mark.parametrize(
    "text,expected",
    [
        # blanks after the hashes may span lines; the body then holds the title
        ("###\n\nTitle\nbody", [(3, "Title", "Title\nbody")]),
        # one heading whose title looks like a heading
        ("##\n# Foo\nrest", [(2, "# Foo", "# Foo\nrest")]),
        ("#\n#\n# Foo\nx", [(1, "#", "#"), (1, "Foo", "x")]),
        # code fences do not matter
        ("# A\n```\n# comment\n```", [(1, "A", "```"), (1, "comment", "```")]),
        # seven hashes, leading blanks, no blank after the hashes
        ("# A\n####### no\n # no\n#no", [(1, "A", "####### no\n # no\n#no")]),
        ("no heading at all", []),
        ("intro\n# A\nx", [(1, "A", "x")]),
        # a last line without line break: cut from inside the heading line
        ("# Last", [(1, "Last", "st")]),
        ("# A\nb\n## Last one", [(1, "A", "b"), (2, "Last one", "one")]),
        ("# \xa0A\t \nx\n", [(1, "A", "x")]),
        ("#  \n", [(1, "", "")]),
        ("# \n", []),
        ("#   ", [(1, "", "#")]),
        # only \n ends a line
        ("# A\x85B C\nx", [(1, "A\x85B C", "x")]),
        ("", []),
    ],
)
def test_parse(spark, text, expected):
    assert headings(spark, text) == expected


def test_last_heading_with_wide_gap_has_a_body(spark):
    title = "t" * 45
    assert headings(spark, "#" + " " * 30 + title) == [(1, title, "t" * 31)]


def plain_headings(text):
    found = list(re.finditer(r"^(#{1,6})\s+(.+)$", text, re.M))
    ends = [m.start() for m in found[1:]] + [len(text)]
    for m, end in zip(found, ends):
        line_end = text.find("\n", m.start())
        begin = line_end + 1 if line_end >= 0 else m.start() + len(m[2].strip())
        yield len(m[1]), m[2].strip(), text[begin:end].strip()


def random_markdown(rnd):
    parts = []
    for _ in range(rnd.randint(0, 14)):
        kind = rnd.random()
        if kind < 0.65:
            title = rnd.choice(WORDS + ["References", "Index", "***"])
            parts.append("#" * rnd.randint(1, 7) + rnd.choice([" ", "  ", "\t", "\n", "\xa0", ""]) + title)
        elif kind < 0.75:
            parts.append("#" * rnd.randint(1, 3))
        parts.append(rnd.choice(["", "short", BODY, BODY + "\n\nmore\x0b", " \x1c "]))
    return "\n".join(parts)


def test_parse_random(spark):
    rnd = random.Random(8)
    texts = [random_markdown(rnd) for _ in range(250)]
    got = {}
    for r in outline.parse_headings(docs(spark, *texts)).collect():
        got.setdefault(r.source_file, []).append((r.pos, r.level, r.title, r.body))
    for i, text in enumerate(texts):
        rows = sorted(got.get(f"f{i}.json", []))
        assert [r[1:] for r in rows] == list(plain_headings(text)), repr(text)


BOILERPLATE = {"References", "Index", "***"}


def plain_entries(text):
    """Kept sections with the titles above them."""
    hidden_below, path, out = 9, [], []
    for level, title, body in plain_headings(text):
        if level <= hidden_below:
            hidden_below = level if title in BOILERPLATE else 9
        if hidden_below == 9 and len(body) > 20:
            path = [p for p in path if p[0] < level]
            out.append((title, [p[1] for p in path], body))
            path.append((level, title))
    return out


def test_entries_random(spark):
    rnd = random.Random(9)
    texts = [t for t in (random_markdown(rnd) for _ in range(250))]
    # titles with hashes are no keywords, but their score is not what is tested here
    texts = [t for t in texts if not re.search(r"^#+\s+#", t, re.M)]
    got = {}
    for name, pos, title, hierarchy, content in entries(spark, *texts):
        got.setdefault(name, []).append((title, hierarchy, content))
    for i, text in enumerate(texts):
        assert got.get(f"f{i}.json", []) == plain_entries(text), repr(text)


def test_short_sections_stay_out_of_the_hierarchy(spark):
    text = f"# Zulu\n{BODY}\n# Kilo\nshort\n## Kilo 1\n{BODY}"
    assert [e[2:4] for e in entries(spark, text)] == [("Zulu", []), ("Kilo 1", ["Zulu"])]
    assert [e[2:4] for e in entries(spark, f"# Zulu\n## Kilo\n{BODY}")] == [("Kilo", [])]


def test_boilerplate_hides_its_subtree_only(spark):
    text = "\n".join(
        f"{h}\n{BODY}" for h in ["# Intro part", "## References", "### Deep", "## Next", "# Index", "## Under"]
    )
    assert [e[2] for e in entries(spark, text)] == ["Intro part", "Next"]


def test_metadata_and_summary(spark):
    text = f"# Top\n{BODY}\n## Sub\n{BODY} And more."
    rows = outline.markdown_to_entries(docs(spark, text))
    sub = rows.where("entry_pos = 1").first().metadata
    assert (sub.full_path, sub.level, sub.content_length, sub.word_count) == ("Top > Sub", 2, 37, 8)
    summary = outline.entry_summary(rows).first()
    assert (summary.entries, summary.total_words, summary.total_chars) == (2, 14, 64)
    assert summary.words_per_entry == 7.0


def test_no_documents(spark):
    empty = spark.createDataFrame([], "source_file string, md string")
    assert outline.markdown_to_entries(empty).count() == 0


def test_both_background_ways_agree(spark):
    rnd = random.Random(10)
    made = docs(spark, *[random_markdown(rnd) for _ in range(120)])
    sections = outline.markdown_to_sections(made).cache()
    for size, limit in [(600, None), (120, 40), (150, 5)]:
        carried = chunking.entries_with_background(sections, size, limit)
        looked_up = chunking.with_background(outline.entries(sections), size, limit)
        def key(df):
            return sorted(map(repr, df.select("source_file", "entry_pos", "content", "metadata", "background").collect()))

        assert key(carried) == key(looked_up)
    sections.unpersist()
