"""Periodic runs beside brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from laddermill.llm import periodic_runs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, runs string, start int, b string"


def runs_of(t, least=12):
    n, out = len(t), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and t[j] == t[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and j > i:
                seg = t[i : j + q]
                if not any(seg[d:] == seg[:-d] for d in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def want(doc_id, text, plant):
    w = WORDS.findall(text or "")
    if plant and doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = runs_of(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), s, n, q, 1000 * n // q if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(12)
    out = [None, "", " \n\t", "one", "a " * 11, "a " * 12, "a b " * 6, "a b c d e f " * 2, "a b c d e f g " * 2, "é € " * 400, ("x " * 40 + "y ") * 6]
    for k in (1, 2, 2, 3, 4, 9, 60, 400):
        for n in (13, 30, 77, 200, 900):
            w = [f"w{rnd.randrange(k)}" for _ in range(n)]
            out.append("  ".join(w))
            a, q = rnd.randrange(n), 1 + rnd.randrange(n // 3)
            w[a:] = [w[a + i % q] for i in range(n - a)]
            w[rnd.randrange(n)] = "other"
            out.append("\n".join(w))
    return [*enumerate(out), (3, out[20]), (3, out[20]), (None, out[21]), (-7, out[22])]


def test_transform_is_exact():
    rnd = np.random.default_rng(0)
    for n in (1, 2, 8, 256):
        a, b = (rnd.integers(0, periodic_runs.P, (n, 3)) for _ in range(2))
        assert (periodic_runs.inverse_ntt(periodic_runs.ntt(a)) == a).all()
        got = periodic_runs.inverse_ntt(periodic_runs.ntt(a) * periodic_runs.ntt(b) % periodic_runs.P)
        for c in range(3):
            assert got[:, c].tolist() == [sum(int(a[j, c]) * int(b[(i - j) % n, c]) for j in range(n)) % periodic_runs.P for i in range(n)]


def test_occurrences_of_blocks():
    rnd = np.random.default_rng(1)
    for top in (2, 3, periodic_runs.P - 1):  # codes whose squares pass the prime many times over
        codes = rnd.integers(0, 2, 400) * (top - 1)
        squares = np.append(0, np.cumsum(codes * codes % periodic_runs.P))
        blocks = np.arange(0, 300, 3)
        for size, lo, hi in ((4, 1, 7), (8, 15, 31), (5, 2, 40)):
            got = set(zip(*(x.tolist() for x in periodic_runs.occurrences(codes, squares, blocks, size, lo, hi)), strict=True))
            assert got == {(x, q) for x in blocks.tolist() for q in range(lo, hi) if (codes[x : x + size] == codes[x + q : x + q + size]).all()}


def test_runs_of_many_texts():
    """Documents side by side, so that no run crosses a border; texts of one word, powers of words and Fibonacci words."""
    rnd = random.Random(5)
    fib = ["b", "a"]
    while len(fib[-1]) < 500:
        fib.append(fib[-1] + fib[-2])
    shapes = [*fib, "a" * 600, ("a" * 50 + "b") * 12, *(("".join(rnd.choice("ab") for _ in range(rnd.randint(2, 40))) * 9)[: rnd.randint(13, 200)] for _ in range(150))]
    for _ in range(12):
        texts = rnd.sample(shapes, 30)
        borders = np.append(0, np.cumsum([*map(len, texts)]))
        got = [tuple(r) for r in periodic_runs.find(np.frombuffer("".join(texts).encode(), np.uint8).astype(np.int64), borders).tolist()]
        assert got == [(b + s, n, q) for b, t in zip(borders.tolist(), texts, strict=False) for s, n, q in runs_of(t)]


def test_query_on_fixture(spark, docs):
    table = spark.createDataFrame([(*d, "clash", 1, None) for d in docs], SCHEMA)
    for plant in (False, True):
        rows = periodic_runs.with_planted_runs(table) if plant else table
        got = sorted((tuple(r) for r in periodic_runs.digests(periodic_runs.find_runs(rows)).collect()), key=str)
        assert got == sorted((want(*d, plant) for d in docs), key=str)
    assert any(zlib.crc32(str(d[0]).encode()) % 10 == 0 for d in docs)
    assert periodic_runs.digests(periodic_runs.find_runs(table.limit(0))).count() == 0


def test_query_on_sf(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in periodic_runs.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    short = [r for r in source if len(r.text or "") < 9000]
    assert len(short) > 150 and all(got[r.doc_id] == want(r.doc_id, r.text, True) for r in short)
    assert any(got[r.doc_id][1] for r in short)


def test_long_text(spark):
    """A text of 60,000 words: one run over all, one deep inside, and nothing between."""
    text = " ".join([*(f"u{i}" for i in range(20_000)), *["x y z"] * 5_000, *(f"v{i % 12_500}" for i in range(25_000))])
    runs = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first().runs
    assert [tuple(r) for r in runs] == [(20_000, 15_000, 3), (35_000, 25_000, 12_500)]
