"""Benchmark decontamination beside brute force."""

import hashlib
import random
import re

import pytest

from laddermill.llm import decontamination

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, row string, window string, at array<int>, n int, item_id string"
ITEMS = "item_id bigint, text string, doc_id bigint, gram string"


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def want(docs, items, window):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[g]
        listed = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abé7") for _ in range(rnd.randint(1, 2)))
    text = lambda n: " ".join(word() for _ in range(n))
    common = text(12)
    items = [(i, f"{text(14)}. {common}") for i in range(12)]
    items += [(20, None), (21, ""), (22, "?!"), (23, "Word"), (24, "two Words"), (25, "one two, three four five"), (26, text(9)), (None, text(11)), (3, text(30)), (3, items[3][1]), (27, "a a a a a a a a a a"), (28, "a a a a a")]
    docs = [(0, None), (1, ""), (2, "  \n"), (3, "word"), (4, "WORD, two-words; two\0words"), (5, "one two three four five"), (6, "a " * 9000), (7, common.upper()), (7, common), (None, common), (None, None)]
    for i, (_, t) in enumerate(items * 3):
        w = (t or "").split()
        cut = rnd.randint(0, 6)
        docs.append((100 + i, "\t".join([text(rnd.randint(0, 30)), *w[cut:], text(rnd.randint(0, 30))])))
        if len(w) > 11:
            w[10] = "changed"
            docs.append((300 + i, "- ".join([*w, common])))
    return [*docs, docs[-1], (900, "日本 x" * 40), (901, f"{text(20_000)} {common} {text(400)}")], items


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"bits": 8}, {"window": 4, "shingle": 2}, {"window": 6, "shingle": 6}, {"window": 3, "shingle": 1}])
def test_contamination(spark, tables, options):
    docs, items = tables
    d = spark.createDataFrame([(*x, "r", "w", [1], 2, "c") for x in docs], DOCS).repartition(5)
    b = spark.createDataFrame([(*x, 7, "g") for x in items], ITEMS)
    got = sorted((tuple(r) for r in decontamination.contamination(d, b, **options).collect()), key=str)
    assert got == want(docs, items, options.get("window", 10))


def test_contamination_of_empty_tables(spark, tables):
    docs, items = tables
    d, b = spark.createDataFrame(docs[:20], "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert decontamination.contamination(d.limit(0), b).count() == 0
    for none in (b.limit(0), spark.createDataFrame([(1, None), (2, "...")], b.schema)):
        assert sorted((tuple(r) for r in decontamination.contamination(d, none).collect()), key=str) == want(docs[:20], [], 10)


def test_decontaminated(spark, tables):
    docs, items = tables
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    bad = {x[0] for x in want(docs, items, 10) if x[-1] and x[0] is not None}
    assert sorted((tuple(r) for r in decontamination.decontaminated(d, b).collect()), key=str) == sorted((x for x in docs if x[0] not in bad), key=str)


def test_places(spark):
    d = spark.createDataFrame([(5, "x y one two three four x one two three")], "doc_id bigint, text string")
    b = spark.createDataFrame([(1, "One two: THREE four"), (2, "two three four")], "item_id bigint, text string")
    rows, places, held = decontamination.occurrences(d, b, window=3)
    got = {(r.doc_id, r.start, r.n, r.item_id) for r in rows.join(places, "row").join(held.drop("n"), "window").collect()}
    assert got == {(5, 2, 3, "1"), (5, 3, 3, "1"), (5, 3, 3, "2"), (5, 7, 3, "1")}
