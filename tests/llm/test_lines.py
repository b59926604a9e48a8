from __future__ import annotations

import random

from pyspark.sql import functions as F

from medallion.llm import line_dedup
from medallion.llm.queries import QUERIES
from tests.llm.brute import components_of, edits

DOCS = "doc_id bigint, text string, line_no string, _line string, _doc string, kept string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], DOCS)


def changed(draw, text, count):
    letters = list(text)
    for _ in range(count):
        if not letters:
            break
        at, kind = draw.randrange(len(letters)), draw.randrange(3)
        if kind == 0:
            letters.insert(at, draw.choice("xyzé"))
        elif kind == 1:
            del letters[at]
        else:
            letters[at] = draw.choice("xyz😀")
    return "".join(letters)


def by_hand(rows):
    """What near_duplicates returns for rows with ids of their own."""
    places = [
        (doc, n, line.strip(" "))
        for doc, text in rows
        for n, line in enumerate((text or "").split("\n"))
        if line.strip(" ")
    ]
    lines = sorted({line for _, _, line in places})
    long = [line for line in lines if len(line) >= line_dedup.MIN_CHARS]
    links = [
        (a, b)
        for i, a in enumerate(long)
        for b in long[i + 1 :]
        if abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2
    ]
    groups = components_of(lines, links)
    first = {}
    for doc, n, line in sorted(places):
        first.setdefault(groups[line], (doc, n))
    counts = {line: sum(line in link for link in links) for line in lines}
    return {(d, n, counts[x], *first[groups[x]], first[groups[x]] == (d, n)) for d, n, x in places}


def test_within_two_edits(spark):
    draw = random.Random(1)
    pairs = [("", ""), ("", "ab"), ("abc", ""), ("a", "abcd")]
    for _ in range(600):
        a = "".join(draw.choices("abé", k=draw.randrange(1, 14)))
        pairs.append((a, changed(draw, a + "q", draw.randrange(5))))
    df = spark.createDataFrame([(list(a), list(b)) for a, b in pairs], "a array<string>, b array<string>")
    for r in df.select("a", "b", line_dedup.within("a", "b").alias("near")).collect():
        assert r["near"] == (edits(r["a"], r["b"]) <= 2), (r["a"], r["b"])


def test_letters_are_code_points(spark):
    texts = ["", "aé", "😀 b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", line_dedup.letters("t").alias("l"))
    assert all(r["l"] == list(r["t"]) for r in df.collect())


def test_against_all_pairs(spark):
    draw = random.Random(2)
    base = ["".join(draw.choices("abcde fgh", k=draw.randrange(28, 60))).strip() for _ in range(40)]
    rows = []
    for doc in range(60):
        lines = [changed(draw, draw.choice(base), draw.randrange(4)) for _ in range(4)]
        lines += ["short", "", "  " + draw.choice(base) + " "]
        rows.append((doc, "\n".join(lines)))
    found = {tuple(r) for r in line_dedup.near_duplicates(docs_of(spark, rows)).collect()}
    want = by_hand(rows)
    assert any(r[2] > 1 for r in want)
    assert found == want


def test_short_lines_are_classed_by_equality(spark):
    rows = [(2, "Read more\nRead morn\n 词 "), (1, "Read more \n\nx"), (3, "词\nRead more\nRead more")]
    found = [tuple(r) for r in line_dedup.near_duplicates(docs_of(spark, rows)).collect()]
    assert set(found) == by_hand(rows) and len(found) == 8
    assert {r[:2] for r in found if not r[5]} == {(2, 0), (3, 0), (3, 1), (3, 2)}
    cleaned = line_dedup.without_repeats(docs_of(spark, rows))
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == {1: "Read more \n\nx", 2: "Read morn\n 词 ", 3: ""}


def test_sketches_rule_out_no_pair_within_reach(spark):
    draw = random.Random(8)
    pairs = []
    for _ in range(500):
        a = "".join(draw.choices("etaoinsr xyz", k=draw.randrange(30, 400)))
        pairs.append((a, changed(draw, a, 2)))
    df = spark.createDataFrame(pairs, "a string, b string")
    possible = line_dedup._possible(line_dedup.sketch(F.col("a")), line_dedup.sketch(F.col("b")))
    assert df.where(~possible).count() == 0
    others = spark.createDataFrame([(a, d) for (a, _), (_, d) in zip(pairs, pairs[1:])], "a string, b string")
    assert others.where(possible).count() < 50


def test_odd_documents(spark):
    line = "this is a line of more than thirty letters"
    long = "long " * 40_000
    rows = [(3, line), (1, None), (2, ""), (4, f"{line}!\nshort\n{line}"), (5, long), (6, long), (7, "\n\n"), (8, line), (8, line), (None, line)]
    docs = docs_of(spark, rows)
    found = [tuple(r) for r in line_dedup.near_duplicates(docs).collect()]
    assert len(found) == 9
    assert (4, 1, 0, 4, 1, True) in found
    assert (None, 0, 1, None, 0, True) in found
    assert (3, 0, 1, None, 0, False) in found and (4, 0, 1, None, 0, False) in found
    assert (5, 0, 0, 5, 0, True) in found and (6, 0, 0, 5, 0, False) in found
    assert found.count((8, 0, 1, None, 0, False)) == 2
    cleaned = line_dedup.without_repeats(docs)
    assert cleaned.columns == docs.columns
    texts = sorted((r["doc_id"] or 0, r["text"]) for r in cleaned.where("text is not null").collect())
    assert texts == [(0, line), (2, ""), (3, ""), (4, "short"), (5, long), (6, ""), (7, "\n\n"), (8, ""), (8, "")]
    assert cleaned.count() == len(rows)
    assert line_dedup.near_duplicates(docs.limit(0)).count() == 0
    assert line_dedup.without_repeats(docs.limit(0)).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted((r["doc_id"], r["text"]) for r in rows)
    found = QUERIES["op6_line_dedup"](spark, sf).collect()
    places = [(d, n) for d, t in rows for n, x in enumerate(t.split("\n")) if x.strip(" ")]
    assert sorted((r["doc_id"], r["line_no"]) for r in found) == sorted(places)
    some = rows[:40]
    near = line_dedup.near_duplicates(docs_of(spark, some))
    assert {tuple(r) for r in near.collect()} == by_hand(some)
