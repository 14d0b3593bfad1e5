"""Periodic runs of words by block convolution.

A run of smallest period q and length l has l - q places i at which word i equals word i + q. Scale B looks for periods
of 2B - 1 to 4B - 2: a run of such a period is so long that it holds an aligned block of B words together with its copy q
words on. The squared differences between a block and every place of the window that follows it, summed over the block,
are two sums of squares less twice a correlation, which a number-theoretic transform gives exactly modulo a prime; a
block occurs again where the sum is zero. Sums may exceed the prime, so the zeros, a few, are compared word by word. Each
distance found seeds an extension to both sides, which ends at the run's borders.

Blocks of which some word does not occur again at any distance of the scale can have no copy and are not transformed;
nor are those whose whole window lies in a run already known, where copies are multiples of its period only.
"""

from __future__ import annotations

import collections
import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.llm import textcore as tc
from laddermill.llm.common import let, ship, table, words

#: A run has two periods at least, and so many words.
LEAST = 12
#: A prime of which P - 1 is 119 * 2 ** 23, and a generator of its multiplicative group.
P, GENERATOR = 998_244_353, 3
#: Words of the transforms that are done at once.
BATCH = 1 << 20


@functools.lru_cache(64)
def _roots(half: int, inverse: bool) -> np.ndarray:
    """The first `half` powers of a root of unity of order 2 * half, as a column."""
    root = pow(GENERATOR, (P - 1) // (2 * half) * (2 * half - 1 if inverse else 1), P)
    out = np.ones(1, np.int64)
    while len(out) < half:
        out = np.concatenate((out, out * pow(root, len(out), P) % P))
    return out[:, None]


def ntt(x: np.ndarray) -> np.ndarray:
    """The transforms of the columns of x (a power of two rows, values below P), their rows in bit-reversed order."""
    n, k = x.shape
    half = n // 2
    while half:
        pairs = x.reshape(-1, 2, half, k)
        low, high = pairs[:, 0], pairs[:, 1]
        x = np.stack(((low + high) % P, (low - high) * _roots(half, False) % P), axis=1)
        half //= 2
    return x.reshape(n, k)


def inverse_ntt(x: np.ndarray) -> np.ndarray:
    """Undoes ntt."""
    n, k = x.shape
    half = 1
    while half < n:
        pairs = x.reshape(-1, 2, half, k)
        low, high = pairs[:, 0], pairs[:, 1] * _roots(half, True) % P
        x = np.stack(((low + high) % P, (low - high) % P), axis=1)
        half *= 2
    return x.reshape(n, k) * pow(n, P - 2, P) % P


def occurrences(codes: np.ndarray, squares: np.ndarray, blocks: np.ndarray, size: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks (their first places) and distances from lo to hi - 1 at which the `size` codes of a block occur again.

    squares: the sums of the squares of the codes before each place. codes must reach hi + size places beyond the blocks.
    """
    span = hi - lo + size - 1
    n = 1 << (span - 1).bit_length()
    starts, distances = [], []
    for first in range(0, len(blocks), max(1, BATCH // n)):
        at = blocks[first : first + max(1, BATCH // n)]
        window, block = np.zeros((n, len(at)), np.int64), np.zeros((n, len(at)), np.int64)
        window[:span] = codes[at + lo + np.arange(span)[:, None]]
        block[-np.arange(size) % n] = codes[at + np.arange(size)[:, None]]
        both = inverse_ntt(ntt(window) * ntt(block) % P)[: hi - lo]
        copy = at + np.arange(lo, hi)[:, None]
        zero = (squares[at + size] - squares[at] + squares[copy + size] - squares[copy] - 2 * both) % P == 0
        distance, which = np.nonzero(zero)
        starts.append(at[which])
        distances.append(distance + lo)
    x, q = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (starts, distances))
    same = np.ones(len(x), bool)
    for i in range(size):
        same[same] = codes[x[same] + i] == codes[x[same] + q[same] + i]
    return x[same], q[same]


def agree(codes: np.ndarray, at: int, distance: int) -> int:
    """How many places from `at` on have the code that is found `distance` further; codes that occur once end the search."""
    n, step = 0, 64
    while True:
        copy = codes[at + n + distance : at + n + distance + step]
        same = codes[at + n : at + n + len(copy)] == copy
        if not same.all():
            return n + int(same.argmin())
        n += step
        step *= 2


def primitive(period: np.ndarray, q: int) -> bool:
    """Is q the smallest period of what repeats these q codes? A smaller one would divide q."""
    left, prime = q, 2
    while left > 1:
        if prime * prime > left:
            prime = left
        if left % prime == 0:
            d = q // prime
            if (period[d:] == period[:-d]).all():
                return False
            while left % prime == 0:
                left //= prime
        prime += 1
    return True


def scales() -> Iterator[tuple[int, int, int, int]]:
    """Size of a block, steps between blocks, and the distances looked at. A run holds size + step - 1 places and more."""
    yield 4, 2, 1, 7
    for j in itertools.count(2):
        yield 1 << j, 1 << j, (2 << j) - 1, (4 << j) - 1


def find(codes: np.ndarray, borders: np.ndarray, least: int = LEAST) -> np.ndarray:
    """The runs of documents, as rows of start, length and period, ordered by start and period; starts count from codes[0].

    codes: the words of documents one after the other as numbers below P; borders: of documents among them.
    """
    sizes = np.diff(borders)
    longest = int(sizes.max(initial=0))
    # one code that occurs nowhere else before and after each document: no run crosses it
    ends = np.arange(len(borders)) + borders
    text = np.zeros(len(codes) + len(borders), np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = codes
    text[ends] = int(codes.max(initial=0)) + 1 + np.arange(len(borders))
    room = np.concatenate(([0], np.repeat(sizes, sizes + 1)))  # of the document that each place belongs to
    n = len(text)
    stride = 8 * n + 64
    order = np.argsort(text, kind="stable")
    keys = text[order] * stride + order
    padded = np.concatenate((text, np.full(4 * longest + 64, int(text.max()) + 1)))
    squares = np.concatenate(([0], np.cumsum(padded % P * (padded % P) % P)))
    reach, period = np.zeros(n, np.int64), np.zeros(n, np.int64)  # end and period of a known run at each place
    found = []
    for size, step, lo, hi in scales():
        need = max(least, 2 * lo)
        if need > longest:
            break
        alive = room >= need
        some = alive[order]
        keys, order = keys[some], order[some]
        next_at = np.searchsorted(keys, keys + lo)
        again = np.append(keys, np.iinfo(np.int64).max)[next_at] < keys + hi
        recurs = np.zeros(n + 1, np.int64)
        recurs[order + 1] = again
        recurs = np.cumsum(recurs)
        blocks = np.arange(0, n - size, step)
        blocks = blocks[recurs[blocks + size] - recurs[blocks] == size]
        known = (period[blocks] > 0) & (2 * period[blocks] <= size) & (blocks + hi - 1 + size <= reach[blocks])
        x, q = occurrences(padded, squares, blocks[~known], size, lo, hi)
        held = (period[x] > 0) & (x + q + size <= reach[x])
        held[held] = q[held] % period[x[held]] == 0  # a multiple of the period of a run known there
        x, q = x[~held], q[~held]
        by = np.lexsort((x, q))
        new, last, upto = [], 0, 0
        for at, d in zip(x[by].tolist(), q[by].tolist(), strict=True):
            if d == last and at < upto:
                continue
            last, upto = d, at + agree(padded, at, d)
            start = at - agree(text[::-1], n - at - d, d)
            length = upto + d - start
            if length >= max(least, 2 * d) and primitive(text[start : start + 2 * d - 1] if d > 1 else text[:0], d):
                new.append((start, length, d))
        for start, length, d in new:
            reach[start : start + length], period[start : start + length] = start + length, d
        found += new
    out = np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)
    out[:, 0] -= np.searchsorted(ends, out[:, 0])  # the separators before
    return out


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, runs (start, length, period; by start, then period), collapsed.

    collapsed: the words outside of runs, and of each run its first period unless another run drops it, joined by single
    blanks. A null text has no words. Rows are judged one by one, so null and repeated doc_ids are nothing special. Other
    columns are ignored; an empty table gives no rows. A document is held by one task with some 200 bytes a word.
    """
    ship(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk in tc.chunks(b.column(1)):
                whole, lo = chunk.data.tobytes(), chunk.rows[0]
                listed = [whole[i:j].split() for i, j in zip(chunk.borders[:-1].tolist(), chunk.borders[1:].tolist(), strict=True)]
                ids = collections.defaultdict(itertools.count().__next__)
                codes = np.fromiter(map(ids.__getitem__, itertools.chain.from_iterable(listed)), np.int64)
                borders = np.append(0, np.cumsum([*map(len, listed)]))
                runs = find(codes, borders, least)
                cuts = np.searchsorted(runs[:, 0], borders)
                out, texts = [], []
                for d, w in enumerate(listed):
                    own = runs[cuts[d] : cuts[d + 1]] - [borders[d], 0, 0]
                    if len(own):
                        kept = np.ones(len(w), bool)
                        for start, length, q in own.tolist():
                            kept[start + q : start + length] = False
                        w = itertools.compress(w, kept.tolist())
                    out.append([{"start": s, "length": n, "period": q} for s, n, q in own.tolist()])
                    texts.append(b" ".join(w).decode())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(out)), pa.array(out, kind), pa.array(texts, pa.string())], ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """Of find_runs: doc_id, n_runs, the longest run's start, length, period and exponent_milli, runs_sha256, collapsed_sha256."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "b.start", (-F.col("b.less")).alias("length"), "b.period", F.expr("-1000 * b.less div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """docs with the words of one document in ten, from a place on, repeated with a period; both follow from its doc_id."""
    h = F.crc32(F.col("doc_id").cast("string"))

    def planted(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = let(F.struct(a.alias("a"), p.alias("p")), lambda x: F.transform(F.sequence(F.lit(0), n - x["a"] - 1), lambda j: F.get(w, x["a"] + j % x["p"])))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")).otherwise(F.lit(""))

    return docs.withColumn("text", F.when(h % 10 == 0, let(words(F.col("text")), planted)).otherwise(F.col("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLE: dict[str, str] = {}
