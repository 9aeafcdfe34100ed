from __future__ import annotations

import random

from larderline.llm import line_chunks

SCHEMA = "doc_id long, text string"
BLANKS = " \t\n\x0b\x0c\r"


def plain_lines(text):
    """Lines that are not blank, each with the blank ones after it."""
    lines = []
    for line in text.split("\n"):
        if lines and not line.strip(BLANKS):
            lines[-1] += "\n" + line
        else:
            lines.append(line)
    return lines


def plain_windows(lines):
    bare = [line.split("\n")[0] for line in lines]
    for place, line in enumerate(lines):
        if bare[place].strip(BLANKS) and place + 1 < len(lines):
            yield place, 2, f"{line}\n{bare[place + 1]}"
        if bare[place].count(" ") >= 49:
            yield place, 1, bare[place]


def plain_cleaned(rows):
    """By reading documents in order of id and keeping what stands first."""
    seen, cleaned = {}, {}
    for doc_id, text in sorted({row for row in rows if row[1] is not None}, key=lambda r: (r[0] is not None, r)):
        lines, gone = plain_lines(text), set()
        for place, span, content in plain_windows(lines):
            here = (doc_id, text, place)
            if seen.setdefault((span, content), here) != here:
                gone |= set(range(place, place + span))
        cleaned[doc_id, text] = "\n".join(line for place, line in enumerate(lines) if place not in gone)
    return cleaned


def documents():
    draw = random.Random(4)
    pool = [" ".join(f"w{draw.randrange(99)}" for _ in range(draw.choice((1, 5, 12, 55)))) for _ in range(60)]
    shared = pool[:14]
    rows = [(1000, None), (1001, ""), (1002, "\n\n"), (1003, "\n\n"), (1004, " ")]
    for n in range(40):
        lines = [draw.choice(pool) for _ in range(draw.randrange(1, 12))]
        at = draw.randrange(len(lines))
        rows.append((n, "\n".join([*lines[:at], *shared, *lines[at:]])))
    rows += [(n + 50, "\n".join(shared)) for n in range(100)]
    long = "\n".join(f"line {draw.random()}" for _ in range(5000))
    rows += [(2000, long), (2001, long + "\nend of it"), (2002, f"start of it\n{long}")]
    return rows


def test_same_as_reading_one_by_one(spark):
    rows = documents()
    wanted = plain_cleaned(rows)
    found = line_chunks.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    for row in found:
        key = (row.document.doc_id, row.document.text)
        assert row.cleaned == wanted.get(key)
        if row.cleaned is not None:
            assert row.n_chunks == len(plain_lines(row.document.text))
    by_id = {row.document.doc_id: row for row in found}
    assert (by_id[2001].cleaned, by_id[2002].cleaned) == ("end of it", "start of it")


def test_planted_passages_of_few_lines_go_whole(spark):
    """Passages of two to six lines, of 50 words and more, between other lines."""
    draw = random.Random(8)

    def line(words):
        return " ".join(f"w{draw.randrange(10**6)}" for _ in range(words))

    passages = [[line(60 // n) for _ in range(n)] for n in (2, 3, 4, 5, 6) for _ in range(10)]
    rows = []
    for number, passage in enumerate(passages):
        for copy in range(4):
            around = [line(draw.randrange(1, 20)) for _ in range(2)]
            gaps = [own + draw.choice(["", "\n", "\n \n"]) * (copy == 3) for own in passage]
            rows.append((10 * number + copy, "\n".join([around[0], *gaps, around[1]])))
    found = line_chunks.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.document.doc_id: r.cleaned for r in found} == {i: plain_cleaned(rows)[i, t] for i, t in rows}
    for row in found:
        number, copy = divmod(row.document.doc_id, 10)
        left = sum(own in row.cleaned for own in passages[number])
        assert copy == 3 or left == (0 if copy else len(passages[number]))
    clean = [(n, "\n".join(line(12) for _ in range(8))) for n in range(50)]
    assert all(r.n_removed == 0 for r in line_chunks.remove_repeats(spark.createDataFrame(clean, SCHEMA)).collect())


def test_a_passage_line_is_found_wherever_it_stands(spark):
    passage = " ".join(f"p{n}" for n in range(50))
    short = " ".join(f"p{n}" for n in range(49))
    rows = [(n, f"own {n}\n{passage}\nmiddle {n}\n{short}\nend {n}") for n in range(8)]
    cleaned = line_chunks.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = {row.document.doc_id: row.cleaned for row in cleaned}
    assert [passage in texts[n] for n in range(8)] == [True] + [False] * 7
    assert all(short in text and f"end {n}" in text for n, text in texts.items())


def test_within_a_document_and_unknown_ids(spark):
    passage = " ".join(f"p{n}" for n in range(60))
    rows = [(None, f"{passage}\na"), (7, f"b\n{passage}\nc\n{passage}"), (8, "d")]
    cleaned = {r.document.doc_id: r.cleaned for r in line_chunks.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert cleaned == {None: f"{passage}\na", 7: "b\nc", 8: "d"}
    rows = [(1, "\n \na\nb\n\nc\n"), (2, "a\nb\n\nc\nd\n\n"), (3, "a\nb\nc"), (4, "}\n}\n}")]
    cleaned = {r.document.doc_id: r.cleaned for r in line_chunks.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert cleaned == {1: rows[0][1], 2: "d\n\n", 3: "c", 4: "}"}


def test_equal_rows_are_one_document(spark):
    text = "\n".join(f"line number {n}" for n in range(30))
    rows = line_chunks.remove_repeats(spark.createDataFrame([(1, text)] * 3, SCHEMA)).collect()
    assert [row.n_removed for row in rows] == [0, 0, 0]


def test_documents_keep_their_columns(spark):
    passage = " ".join(f"p{n}" for n in range(60))
    rows = [(1, passage, "x", 5, "s"), (2, passage, "y", 5, "t"), (3, "", None, 0, None), (4, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", place string, n_chars long, chunk string")
    kept = line_chunks.without_repeats(docs)
    assert kept.columns == docs.columns
    found = {row.doc_id: row for row in kept.collect()}
    assert set(found) == {1, 3, 4}
    assert found[1].n_chars == len(passage) and found[4].text is None


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert line_chunks.remove_repeats(docs).count() == 0
    assert line_chunks.without_repeats(docs).columns == docs.columns
