"""Document operators on nulls, empty and long texts, ties, repeats, empty tables and clashing
columns."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medallion.llm import decontamination, language_id, mixing, simhash, token_blocks
from medallion.llm.components import components
from tests.llm.brute import components_of, fingerprint

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
EN = "the cat and the dog were with that other thing while the weather was rather nice and they went there"
DE = "der hund und die katze waren nicht auf der wiese und das wetter ist schön und sie gingen doch über die straße"


def docs_of(spark, rows, extra=True):
    """(id, text, lang, source) with two columns whose names operators use inside."""
    df = spark.createDataFrame([(*r, None) for r in rows], DOCS)
    if extra:
        names = ("_key", "_fp", "_hash", "_threshold", "component_id", "size", "_kept", "_rows", "score")
        df = df.withColumns({name: F.lit(name) for name in names})
    return df


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, EN, "en", "a"),
        (2, DE, "de", "a"),
        (3, None, "en", "b"),
        (4, "", "en", None),
        (5, " \t\n ", None, None),
        (6, "1234 %%% 56", "de", "b"),
        (7, EN, "en", "a"),
        (7, EN, "en", "a"),
        (None, EN + " again", "en", "a"),
        (8, " ".join([EN, DE] * 2000), "en", "c"),
        (9, "x" * 300_000, None, "c"),
        (10, EN.upper(), None, "b"),
    ]
    return docs_of(spark, rows).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


def test_language(odd):
    rows = {(r["doc_id"], r["lang_pred"]) for r in language_id.identify(odd).collect()}
    found = {i for i, lang in rows if lang == "und"}
    assert found == {3, 4, 5, 6}
    assert (1, "en") in rows and (2, "de") in rows and (10, "en") in rows
    kept = language_id.with_language(odd)
    assert kept.columns == odd.columns
    langs = sorted((r["doc_id"], r["lang"]) for r in kept.where("doc_id is not null").collect())
    assert [i for i, _ in langs] == [1, 2, 7, 7, 8, 9, 10]
    assert dict(langs)[10] == "en" and dict(langs)[8] == "en"
    assert kept.where("doc_id is null").count() == 1


def planted_run(n, groups, seed):
    """Fingerprints far from each other, and chains of some that are four bits apart."""
    draw = np.random.default_rng(seed)
    fps = draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
    for group in range(groups):
        at = draw.choice(n, 4, replace=False)
        for one, other in zip(at, at[1:]):
            flipped = draw.choice(64, 4, replace=False).astype(np.uint64)
            fps[other] = fps[one] ^ np.bitwise_or.reduce(np.uint64(1) << flipped)
    return np.unique(fps)


@pytest.mark.parametrize("hot, batch", [(500, 300), (500, 10_000), (10_000, 300)])
def test_keys_of_many_fingerprints_are_linked_in_blocks(spark, monkeypatch, hot, batch):
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "BLOCK", 400)
    rows, want = [], set()
    for key, n in ((-5, 20), (3, 3000), (4, 1), (9, 700), (11, 40)):
        fps = planted_run(n, n // 20, seed=n)
        nodes = {int(fp): 100_000 * (key + 5) + i for i, fp in enumerate(fps.tolist())}
        rows += [(key, int(np.uint64(fp).view(np.int64)), node) for fp, node in nodes.items()]
        near = np.bitwise_count(fps[:, None] ^ fps) <= 4
        edges = [(nodes[int(fps[i])], nodes[int(fps[j])]) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True)]
        want |= set(components_of(list(nodes.values()), edges).items())
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        keyed = spark.createDataFrame(rows, "_key long, _fp long, _node long").repartition(4)
        found = [tuple(r) for r in simhash.linked(keyed).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    assert set(components_of([node for _, _, node in rows], found).items()) == want
    assert len(found) < 3 * len(rows)


def test_a_hundred_thousand_fingerprints_of_one_key(spark, monkeypatch):
    most = []
    original = simhash.links

    def watched(fps, *rest):
        most.append(len(fps))
        return original(fps, *rest)

    fps = planted_run(100_000, 500, seed=1)
    held = np.stack([np.full(len(fps), 7), fps.view(np.int64), np.arange(len(fps))])
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in held[:, i : i + 1000]], ["_key", "_fp", "_node"]) for i in range(0, len(fps), 1000)]
    monkeypatch.setattr(simhash, "links", watched)
    passed = list(simhash._link_batches(iter(batches)))
    assert sum(b.num_rows for b in passed) == len(fps) and not most
    assert {b.column("_key").null_count for b in passed} == {0}


def test_language_learns_nothing_from_held_out_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    free = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2)
    rows = [(held, DE, "de", "a"), (free, EN, "en", "a")]
    assert set(language_id.learn(docs_of(spark, rows))) == {"en"}
    only = language_id.identify(docs_of(spark, rows[:1])).collect()
    assert [tuple(r) for r in only] == [(held, True, "und", 0.0)]


@pytest.mark.parametrize("common", [64, 2, 0])
def test_cross_parsing_counts_phrases(monkeypatch, common):
    monkeypatch.setattr(language_id, "COMMON", common)
    automata = language_id.Automata({"x": "abcabd", "y": "zzz"})
    texts = ["abcabd", "abdabc", "zz", "q", "ab" * 2000]
    for text in texts:
        codes = automata.encode(text)
        counts = automata.phrases(codes, np.array([0]), np.array([len(codes)]))
        assert counts[:, 0].tolist() == [_phrases(text, "abcabd"), _phrases(text, "zzz")]


def test_letters_without_a_column_change_no_verdict(monkeypatch):
    draw = random.Random(6)
    letters = "abcdefghij词語数据пр"
    samples = {k: "".join(draw.choices(letters[i:] + " ", k=400)) for i, k in enumerate("uvwxyz")}
    texts = ["".join(draw.choices(letters + " q", k=draw.randrange(0, 3000))) for _ in range(40)] + ["", None, "学"]
    verdicts = []
    for common in (64, 5, 1, 0):
        monkeypatch.setattr(language_id, "COMMON", common)
        verdicts.append(language_id.Automata(samples).classify(texts))
    assert all(v == verdicts[0] for v in verdicts)


def test_automata_of_ten_thousand_letters_stay_small():
    draw = random.Random(2)
    scripts = {"zh": 0x4E00, "ko": 0xAC00, "ja": 0x6A00, "yi": 0xA000}
    samples = {
        k: "".join(chr(first + int(2700 * draw.random() ** 2) % (1160 if k == "yi" else 2700)) for _ in range(20_000))
        for k, first in scripts.items()
    }
    automata = language_id.Automata(samples)
    assert len({c for t in samples.values() for c in t}) > 7_500 and automata.bytes < 60_000_000
    parts = [samples[k][4_000:6_000] for k in scripts]
    tracemalloc.start()
    predicted, _ = automata.classify(parts * 10)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert predicted == list(scripts) * 10 and most < 60_000_000


def _phrases(text, sample):
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


def test_simhash(odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert by[3] == by[4] == by[5] == {("0" * 16, 3)}
    assert by[1] == by[7] == by[10] == {(f"{fingerprint(EN):016x}", 1)}
    assert {c for _, c in by[None]} == {None}


def test_simhash_keeps_one_row_of_each_group(odd):
    kept = simhash.one_of_each_group(odd)
    assert kept.columns == odd.columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    assert ids == [1, 2, 3, 6, 8, 9]
    assert kept.where("doc_id is null").count() == 1


def test_simhash_repeated_rows_of_a_kept_document(spark):
    rows = [(1, EN, "en", "a"), (1, EN, "en", "a"), (2, EN, "en", "a"), (3, DE, "de", "a")]
    assert sorted(r["doc_id"] for r in simhash.one_of_each_group(docs_of(spark, rows)).collect()) == [1, 3]


def test_simhash_keys_meet_within_four_bits():
    draw = random.Random(3)
    for _ in range(300):
        one = draw.getrandbits(64)
        other = one
        for bit in draw.sample(range(64), 4):
            other ^= 1 << bit
        spread = one
        for segment in range(4):
            spread ^= 1 << (16 * segment + draw.randrange(16))
        for near in (other, spread):
            left, right = (set(simhash.keys(np.array([x], np.uint64))[0].tolist()) for x in (one, near))
            assert left & right


def test_simhash_links_in_long_runs():
    draw = random.Random(4)
    centres = [draw.getrandbits(64) for _ in range(3)]
    fps = [c ^ (1 << draw.randrange(64)) for c in centres for _ in range(40)]
    fps += [draw.getrandbits(64) for _ in range(30)]
    nodes = np.arange(len(fps))
    starts, ends = np.zeros(len(fps), int), np.full(len(fps), len(fps))
    a, b = simhash.links(np.array(fps, np.uint64), nodes, starts, ends)
    want = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    pairs = list(zip(a.tolist(), b.tolist(), strict=True))
    assert len(pairs) < len(fps)
    assert components_of(nodes.tolist(), pairs) == components_of(nodes.tolist(), want)


def test_components(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(60)]
    edges += [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(80)] + [(7, 7), (None, 1)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    real = [e for e in edges if None not in e and e[0] != e[1]]
    want = components_of({n for e in real for n in e}, real)
    assert {r["node"]: r["component"] for r in found} == want and len(found) == len(want)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.fixture(scope="module")
def benchmark(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [
        (1, " ".join(words)),
        (1, " ".join(words)),
        (2, None),
        (3, ""),
        (4, "only four short words"),
        (5, "Five words are just enough!"),
    ]
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, doc_id string")


def test_contained(spark, odd, benchmark):
    words = [f"w{i}" for i in range(40)]
    filler = " ".join(f"f{i}" for i in range(5000))
    texts = [
        f"{filler} {' '.join(words)} {filler}",
        " ".join(words[:33]).upper(),  # 29 of 36 shingles, where 28.8 are needed
        " ".join(words[:32]),
        " ".join(words[:20]) + " gap " + " ".join(words[20:]),
        "so five words, are JUST enough.",
        "only four short words",
    ]
    docs = docs_of(spark, [(100 + i, t, "en", "a") for i, t in enumerate(texts)]).unionByName(odd)
    rows = {(r["doc_id"], r["item_id"], r["shared"], r["shingles"]) for r in decontamination.contained(docs, benchmark).collect()}
    assert rows == {(100, 1, 36, 36), (101, 1, 29, 36), (103, 1, 32, 36), (104, 5, 1, 1), (105, 4, 1, 1)}
    kept = decontamination.clean(docs, benchmark)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert [i for i in ids if i and i >= 100] == [102] and len(ids) == odd.count() + 1


def test_contained_block_by_block(spark, monkeypatch, benchmark):
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 1)
    docs = docs_of(spark, [(1, " ".join(f"w{i}" for i in range(40)), "en", "a"), (2, "five words are just enough", "en", "a")])
    assert sorted((r[0], r[1]) for r in decontamination.contained(docs, benchmark).collect()) == [(1, 1), (2, 5)]
    assert decontamination.clean(docs, benchmark).count() == 0


def test_items_of_few_words_and_all_sizes_against_sql(spark):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([0, 1, 2, 3, 4, 5, 6, 9, 40, 200])))) for i in range(60)]
    items += [(99, "W1, w2!"), (99, "w1 w2"), (98, None), (97, "...")]
    docs = []
    for i in range(80):
        text = " ".join(draw.choices([*words, "other"], k=draw.choice([0, 1, 3, 60])))
        docs.append((i % 70, f"{text} {draw.choice(items)[1]} {text}"))
    docs += [(None, "w1 w2"), (500, None)]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    connection.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    want = connection.execute(decontamination.ORACLE).fetchall()
    found = decontamination.contained(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, want))
    assert len({shingles for _, _, _, shingles, _ in want}) > 4


def test_documents_probe_only_sizes_that_they_can_hold():
    rows = [(n, " ".join(f"w{i}" for i in range(n))) for n in (2, 5, 6, 20, 200)]
    block = decontamination.Block(rows)
    assert {w: [p.least for p in parts] for w, parts in block.partitions.items()} == {2: [1], 5: [1, 2, 13, 157]}
    probed = []
    original = decontamination.Partition.candidates
    decontamination.Partition.candidates = lambda self, found: probed.append(self.least) or original(self, found)
    try:
        found = [(item.item_id, shared) for _, item, shared in block.search([" ".join(f"w{i}" for i in range(18))])]
    finally:
        decontamination.Partition.candidates = original
    assert found == [(2, 1), (5, 1), (6, 2), (20, 14)] and probed == [1, 1, 2, 13]


def test_one_block_is_with_the_executors_at_a_time(spark, monkeypatch, benchmark):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 40)
    alive, most = [], []
    broadcast = type(spark.sparkContext).broadcast

    def counted(context, value):
        shared = broadcast(context, value)
        if isinstance(value, decontamination.Block):
            alive.append(shared)
            most.append(len(alive))
            destroy = shared.destroy
            shared.destroy = lambda *a: (alive.remove(shared), destroy(*a))
        return shared

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    docs = docs_of(spark, [(1, " ".join(f"w{i}" for i in range(40)), "en", "a"), (2, "five words are just enough", "en", "a")])
    assert decontamination.contained(docs, benchmark).count() == 2
    assert len(most) > 3 and set(most) == {1} and alive == []


def test_mix(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    total = sum(r["size"] for r in rows)
    targets = {(r["source_size"], r["target"]) for r in rows}
    assert sum(t for _, t in targets) == pytest.approx(total)
    for r in rows:
        assert r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"]
    taken = mixing.mixed(odd)
    assert taken.columns == odd.columns
    assert taken.count() >= sum(r["taken"] // r["size"] for r in rows if r["size"])


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 4}") for i in range(4000)]
    found = mixing.mix(docs_of(spark, rows)).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 4))
    for r in found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) <= 7


def test_excess_is_shared_again(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1), ("c", 100), (None, 0)], "source string, size bigint")
    found = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # b is held to 3 and the last source to 0; a and c, of weights 1 and 3, share the rest.
    assert found == {"a": pytest.approx(49.5), "b": 3, "c": pytest.approx(148.5), None: 0}


def test_tokens(spark, odd):
    rows = token_blocks.tokenized(odd, TOKENIZER).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    given = sorted(odd.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in given]
    at = 0
    for r, g in zip(rows, given, strict=True):
        ids = tokenizer.encode(g["text"] or "", add_special_tokens=False).ids + [1]
        assert tuple(r)[1:] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


TEXTS = [
    "a b　c ́x é e ́",
    "<|endoftext|> a<|startoftext|>b <|endoftext|>",
    "it's we'll 'S don't'VE rock'n'roll",
    "\x1c a\x1db \x85 c\x0bd\x0ce",
    "ΟΔΟΣ ΣΑΣ. İstanbul IĞDIR ŉ ǰ ﬁ ½ Ⅳ ²",
    "한글 한글 日本語。 ‮abc 🙂👍🏽",
    "Hello,, world!! (yes) [no] {x} a_b c-d e/f 12a b34 Straße ÉCOLE œuvre",
]


@pytest.mark.parametrize("text", TEXTS)
def test_encoding_by_words_is_that_of_the_text(text):
    ids = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids + [1]
    assert token_blocks.Encoder(TOKENIZER).encode([text])[0].tolist() == ids


def test_blocks_come_back():
    draw = np.random.default_rng(6)
    for _ in range(60):
        documents = [
            draw.integers(0, 2 ** draw.integers(1, 33), draw.integers(0, 500)).astype("<u4")
            for _ in range(draw.integers(0, 6))
        ]
        ids = [None if draw.random() < 0.2 else int(draw.integers(-9, 9)) for _ in documents]
        back_ids, back = token_blocks.unpack(token_blocks.pack(ids, documents))
        assert back_ids == ids and len(back) == len(documents)
        assert all(np.array_equal(a, b) for a, b in zip(back, documents, strict=True))


def test_outliers_are_exceptions_and_blocks_can_be_read_alone():
    ids = np.full(1280, 1000, "<u4")
    ids[::64] = 4_000_000_000
    segment = token_blocks.pack([1], [ids])
    assert len(segment) < 500
    starts = np.frombuffer(segment, "<u4", 11, 20 + 13).astype(np.int64)
    block = token_blocks._blocks(np.frombuffer(segment, np.uint8), starts[3:4])
    assert np.array_equal(block, ids[384:512])


def test_empty_tables(spark, nothing, benchmark):
    assert language_id.identify(nothing).count() == 0
    assert language_id.with_language(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each_group(nothing).count() == 0
    assert decontamination.contained(nothing, benchmark).count() == 0
    assert decontamination.clean(nothing, benchmark).count() == 0
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed(nothing).count() == 0
    assert token_blocks.tokenized(nothing, TOKENIZER).count() == 0
    docs = docs_of(spark, [(1, EN, "en", "a")])
    assert decontamination.contained(docs, benchmark.limit(0)).count() == 0
    assert decontamination.clean(docs, benchmark.limit(0)).count() == 1
