from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pytest

from medallion.llm import quality_model
from medallion.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, lang string, _sum string, threshold string, kept string"
LABELS = "doc_id bigint, quality int, toxic int, text string"
EN = "the cat sat on the mat, and the dog lay by the door. the weather was fine that day"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], DOCS)


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], LABELS)


def symbols(text, alphabet):
    codes = quality_model._codes(alphabet)
    return [int(codes[ord(c)]) for c in text]


def kneser_ney(texts, alphabet):
    """Cost of a symbol after three others, by the textbook's sums over dictionaries."""
    grams = Counter()
    for text in texts:
        found = [0, 0, 0, *symbols(text, alphabet)]
        grams.update(tuple(found[i : i + 4]) for i in range(len(found) - 3))
    orders = {4: grams}
    for n in (3, 2, 1):
        orders[n] = Counter(g[1:] for g in orders[n + 1])

    def discount(n, count):
        seen = Counter(orders[n].values())
        n1, n2, n3, n4 = (seen[k] for k in (1, 2, 3, 4))
        share = n1 / (n1 + 2 * n2) if n1 else 0.0
        here, above = [(n1, n2), (n2, n3), (n3, n4)][min(count, 3) - 1]
        k = min(count, 3)
        return min(max(k - (k + 1) * share * above / here, 0.0), k) if here else share

    def probability(gram):
        n = len(gram)
        if not n:
            return 1 / quality_model.SYMBOLS
        after = {g: c for g, c in orders[n].items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return probability(gram[1:])
        taken = sum(discount(n, c) for c in after.values())
        count = after.get(gram, 0)
        own = count - discount(n, count) if count else 0
        return own / total + taken / total * probability(gram[1:])

    return lambda gram: -math.log(probability(gram))


def test_costs_against_the_formula(spark):
    texts = [EN, EN[5:40], "xyz é 123", ""]
    docs = docs_of(spark, [(i, t, "en") for i, t in enumerate(texts)])
    alphabet = quality_model.frequent(docs)
    table = quality_model.costs(*quality_model.probabilities(quality_model.gram_counts(docs, alphabet)))
    cost = kneser_ney(texts, alphabet)
    for text in (EN[10:50], "cat xyz", "qqq ü 日本 Ω", "the"):
        found = [0, 0, 0, *symbols(text, alphabet)]
        numbers, lengths = quality_model.grams([text], alphabet)
        assert lengths.tolist() == [len(text)] == [len(numbers)]
        want = [cost(tuple(found[i : i + 4])) for i in range(len(text))]
        assert table[numbers].astype(float) == pytest.approx(want, rel=5e-3)
    sums = np.exp(-table.astype(float)).reshape(-1, quality_model.SYMBOLS).sum(axis=1)
    assert sums == pytest.approx(1, abs=5e-3)


def test_odd_documents(spark):
    rows = [(i, EN[i % 7 :] + EN[: i % 5], "en") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, EN, None), (None, EN, "en"), (103, "#§$%&/ " * 50, "en")]
    rows += [(104, EN, "xx"), (105, EN * 2000, "en"), (1, EN, "en"), (1, EN, "en")]
    docs = docs_of(spark, rows)
    labels = labels_of(spark, [(i, 1, 0) for i in range(60)] + [(1, 1, None), (None, 1, 0), (103, 0, 0), (7, None, None)])
    found = quality_model.classify(docs, labels).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    assert by[100]["perplexity"] is None and not by[100]["kept"] and not by[101]["kept"]
    assert by[102]["kept"] and by[104]["kept"] and by[105]["kept"] and by[None]["kept"]
    assert not by[103]["kept"] and by[103]["perplexity"] > 4 * by[102]["perplexity"]
    assert by[104]["threshold"] == by[102]["threshold"]
    again = quality_model.classify(docs, labels).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_nothing_to_learn_from(spark):
    docs, labels = docs_of(spark, [(1, EN, "en"), (2, None, "en")]), labels_of(spark, [])
    assert {r["doc_id"]: r["kept"] for r in quality_model.classify(docs, labels).collect()} == {1: True, 2: False}
    assert quality_model.classify(docs.limit(0), labels).count() == 0
    assert quality_model.classify(docs.limit(0), labels_of(spark, [(1, 1, 0)])).count() == 0


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    kept = {r["doc_id"]: r["kept"] for r in QUERIES["op9_quality_classifier"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0").collect()
    good = [kept[r["doc_id"]] for r in labels if r["quality"] == 1]
    bad = [kept[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.4 * len(bad)


def words_by_hand(texts, spelled):
    """Cost of a text after the textbook's sums over trigrams of words."""
    grams = Counter()
    for text in texts:
        found = [quality_model.START] * 2 + quality_model.WORD.findall(text) + [quality_model.END]
        grams.update(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    orders = {3: grams}
    for n in (2, 1):
        orders[n] = Counter(g[1:] for g in orders[n + 1])

    def discount(n, count):
        seen = Counter(orders[n].values())
        n1, n2, n3, n4 = (seen[k] for k in (1, 2, 3, 4))
        k = min(count, 3)
        here, above = [(n1, n2), (n2, n3), (n3, n4)][k - 1]
        share = n1 / (n1 + 2 * n2) if n1 else 0.0
        return min(max(k - (k + 1) * share * above / here, 0.0), k) if here else share

    def probability(gram):
        n = len(gram)
        if not n:
            return None
        after = {g: c for g, c in orders[n].items() if g[:-1] == gram[:-1]}
        lower = probability(gram[1:]) if n > 1 else math.exp(-spelled[gram[0]])
        if not after:
            return lower
        total = sum(after.values())
        weight = max(sum(discount(n, c) for c in after.values()) / total, quality_model.LEAST)
        count = after.get(gram, 0)
        return (count - discount(n, count) if count else 0) / total + weight * lower

    def cost(text):
        found = [quality_model.START] * 2 + quality_model.WORD.findall(text) + [quality_model.END]
        return sum(-math.log(probability(tuple(found[i : i + 3]))) for i in range(len(found) - 2))

    return cost


def speller_of(docs):
    counts = quality_model.characters(docs)
    alphabet = quality_model.frequent(docs)
    table = quality_model.costs(*quality_model.probabilities(quality_model.gram_counts(docs, alphabet)))
    return quality_model.Speller(docs.sparkSession, table, quality_model.shares_of_symbols(counts, alphabet), alphabet)


def test_words_against_the_formula(spark):
    texts = [EN, EN[5:40], "the cat sat on the dog, the cat lay", "xyz é 123"]
    docs = docs_of(spark, [(i, t, "en") for i, t in enumerate(texts)])
    speller = speller_of(docs)
    values = quality_model.word_values(quality_model.trigram_counts(docs, speller))
    asked = [EN[10:50], "the cat sat by qqq", "mat mat mat mat", "日本の 猫", EN, EN]
    rows = spark.createDataFrame([(hash(t) % 1000, t) for t in asked], "_text bigint, text string").repartition(3)
    costs = quality_model.text_costs(quality_model.text_grams(rows, speller), values)
    found = {r["_text"]: r["_sum"] for r in costs.collect()}
    words = sorted({w for t in texts + asked for w in [*quality_model.WORD.findall(t), quality_model.END]})
    spelled = dict(zip(words, quality_model._spelling(words, *speller.tables()) / quality_model.UNIT, strict=True))
    cost = words_by_hand(texts, spelled)
    assert len(found) == len(set(asked))
    for text in asked:
        assert found[hash(text) % 1000] == pytest.approx(cost(text), abs=1e-3)


def test_letters_beyond_the_symbols_are_told_apart(spark):
    """All 52 symbols are Latin ones; Cyrillic letters 11 code points apart share theirs."""
    latin = [("".join(chr(0x100 + 2 * ((i + k) % 56) + 1) for k in range(40)) + " ") * 20 for i in range(56)]
    good = "где мама мыла раму там папа пил чай "
    moved = "".join(c if c == " " else chr(ord("а") + (ord(c) - ord("а") + 11) % 32) if (ord(c) - ord("а")) < 21 else c for c in good)
    rows = [(i, t, "xx") for i, t in enumerate(latin)] + [(100 + i, good * (i + 3), "ru") for i in range(30)]
    rows += [(200, good * 5, "ru"), (201, moved * 5, "ru"), (202, "раму чай мама где пил папа там мыла " * 5, "ru")]
    labels = labels_of(spark, [(i, 1, 0) for i, _, _ in rows if i < 200])
    found = {r["doc_id"]: r for r in quality_model.classify(docs_of(spark, rows), labels).collect()}
    assert found[200]["kept"] and not found[201]["kept"] and not found[202]["kept"]


def test_repeated_words_cost(spark):
    rows = [(i, EN[i % 7 :] + EN[: i % 5], "en") for i in range(60)] + [(100, "the " * 100, "en")]
    found = quality_model.classify(docs_of(spark, rows), labels_of(spark, [(i, 1, 0) for i in range(60)]))
    assert {r["doc_id"]: r["kept"] for r in found.collect()}[100] is False


def test_held_out_bad_and_toxic_rows_are_caught(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = {r[0] for r in docs.where(f"pmod(xxhash64(text), {quality_model.HELD_OUT}) = 0").select("doc_id").collect()}
    kept = {r["doc_id"]: r["kept"] for r in QUERIES["op9_quality_classifier"](spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in held]
    good = [kept[r["doc_id"]] for r in labels if r["quality"] == 1 and r["toxic"] != 1]
    bad = [kept[r["doc_id"]] for r in labels if r["quality"] == 0]
    toxic = [kept[r["doc_id"]] for r in labels if r["toxic"] == 1]
    assert sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.22 * len(bad)
    assert sum(toxic) <= 0.12 * len(toxic)


def test_words_are_those_of_the_pattern():
    texts = [EN, "", "  ", "İstanbul'da ΟΔΟΣ x_y 3½", "日本の猫 ไทย　ab!!", "\ud800 a\nb\tc\x1f\x85d", "ß" * 500 + "…", "é \U0001f600‍"]
    numbers, hashes, distinct, of, place = quality_model._numbered(texts)
    assert len(set(hashes.tolist())) == len(hashes) == len(distinct)
    for i, text in enumerate(texts):
        found = [distinct[n] for n in numbers[of == i]]
        assert found[2:-1] == quality_model.WORD.findall(text.lower())
        assert place[of == i].tolist() == list(range(len(found)))
    starts = {numbers[(of == i) & (place < 2)].tolist()[k] for i in range(len(texts)) for k in (0, 1)}
    assert len(starts) == 1


def test_packed_numbers():
    for numbers in ([], [0, 0], [7], [1, 255, 256], [0, 2**64 - 1, 5]):
        numbers = np.array(numbers, np.uint64)
        assert quality_model.unpacked(quality_model.packed(numbers)).tolist() == numbers.tolist()
    signed = np.array([0, -1, 1, -(2**62), 2**62 - 1])
    assert quality_model._unsigned(quality_model._signed(signed)).tolist() == signed.tolist()


def test_rounds_give_the_same_rows_and_leave_little(spark, monkeypatch, tmp_path):
    rows = [(i, " ".join(f"w{(i * i + k * k) % 997}" for k in range(300)), "en") for i in range(90)]
    rows += [(100, rows[3][1], "en"), (101, None, "en"), (102, "a " * 50, "xx")]
    docs, labels = docs_of(spark, rows), labels_of(spark, [(i, int(i % 5 > 0), 0) for i in range(60)])
    columns = ("perplexity", "threshold", "fluent", "clear", "kept")
    once = {r["doc_id"]: [r[c] for c in columns] for r in quality_model.classify(docs, labels).collect()}
    for name in ("TEXT_CHARS", "VALUE_CHARS"):
        monkeypatch.setattr(quality_model, name, 1000)
    before = spark.conf.get(quality_model.CLEANUP)
    monkeypatch.setattr(quality_model, "work_folder", lambda _, name: f"{tmp_path}/{uuid.uuid4().hex}/{name}")
    many = {r["doc_id"]: [r[c] for c in columns] for r in quality_model.classify(docs, labels).collect()}
    for key, row in once.items():
        assert many[key][1:] == row[1:]
        assert many[key][0] == (row[0] and pytest.approx(row[0], rel=1e-6))
    assert many[100] == many[3]
    left = {x.relative_to(tmp_path).parts[1] for x in tmp_path.rglob("*.parquet")}
    assert left == {"costs"}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("values_")]
    assert spark.conf.get(quality_model.CLEANUP) == before
