"""Content-defined cuts: which windows of a text can occur elsewhere, found without moving the text.

A window is `length` symbols in a row. The least hash among the grams of `gram` symbols inside it is its anchor, so
equal windows have equal anchors at equal places. Windows in a row with one anchor form a run; a run's stretch is its
windows together, length - 1 symbols more than it has windows. A window can occur again only if its anchor does.

A document is a doc_id and a text: rows that repeat both are one document, and other texts with its doc_id are documents
of their own, told apart and ordered by `version`, a hash of the text that is 0 where the doc_id has one text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laddermill.llm import textcore as tc
from laddermill.llm.common import materialize, ship, small

_PLACE = np.uint64((1 << 28) - 1)
DOC = ["doc_id", "version"]


def runs(grams: np.ndarray, borders: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, first window, number of windows and anchor hash of each run; borders: of documents among symbols."""
    if len(grams) > int(_PLACE):
        raise ValueError(f"a text has {len(grams)} symbols; places reach to {int(_PLACE)}")
    least = tc.sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    windows = np.maximum(np.diff(borders) - length + 1, 0)
    first = np.repeat(borders[:-1], windows)
    at = np.arange(len(first)) - np.repeat(np.cumsum(windows) - windows, windows) + first
    doc = np.repeat(np.arange(len(windows)), windows)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    anchor = (least[at] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))))
    return doc[new], at[new], np.diff(np.append(new, len(at))), grams[anchor[new]]


def versioned(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of docs as doc_id, version, text, and those of them that stand for all documents: one row for each."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = rows.filter("doc_id is not null")
    several = materialize(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "repeated-ids")
    if several.isEmpty():
        rows = rows.select("doc_id", F.lit(0).cast("long").alias("version"), "text")
        return rows, rows.filter("doc_id is not null and text is not null")
    flagged = rows.join(small(several.withColumn("_several", F.lit(True))), "doc_id", "left")
    rows = flagged.select("doc_id", F.when(F.col("_several"), F.xxhash64("text")).otherwise(0).alias("version"), "text")
    return rows, rows.filter("doc_id is not null and text is not null").dropDuplicates(DOC)


def cut(docs: DataFrame, length: int, gram: int, of_bytes: bool) -> DataFrame:
    """The runs of documents (doc_id, version, text): doc_id, version, start, windows, anchor, stretch (a hash of the stretch).

    Symbols are words, or bytes. Texts shorter than a window give no runs.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, size = xxhash.xxh3_64_intdigest, 1 if of_bytes else 8
        for b in batches:
            ids, versions = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for chunk in tc.chunks(b.column(2)):
                if of_bytes:
                    symbols, borders = chunk.data, chunk.borders
                    grams = tc.byte_gram_hashes(symbols, gram)
                else:
                    starts, ends, borders = tc.word_bounds(chunk)
                    symbols = tc.word_hashes(chunk, starts, ends)
                    grams = tc.gram_hashes(symbols, gram)
                doc, at, windows, anchor = runs(grams, borders, length, gram)
                view = memoryview(np.ascontiguousarray(symbols)).cast("B") if len(symbols) else b""
                hashes = np.fromiter((digest(view[i:j]) for i, j in zip((at * size).tolist(), ((at + windows + length - 1) * size).tolist(), strict=True)), np.uint64, len(at))
                of = chunk.rows[0] + doc
                columns = [ids[of].astype(np.int64), versions[of].astype(np.int64), (at - borders[doc]).astype(np.int32), windows.astype(np.int32), anchor.view(np.int64), hashes.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*DOC, "start", "windows", "anchor", "stretch"])

    return docs.select(*DOC, "text").mapInArrow(run, "doc_id bigint, version bigint, start int, windows int, anchor bigint, stretch bigint")


def repeated_runs(docs: DataFrame, length: int, gram: int, of_bytes: bool) -> DataFrame:
    """The runs whose anchor occurs more than once in the corpus."""
    every = materialize(cut(docs, length, gram, of_bytes), "runs")
    # written, so that both sides of the join are plain shuffles and a hot anchor's runs are split among tasks
    again = materialize(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "repeated-anchors")
    return materialize(every.join(again, "anchor", "left_semi"), "repeated-runs")


def stretches(found: DataFrame) -> DataFrame:
    """One row for each different stretch: anchor, stretch, windows, seen, and its first occurrence doc_id, version, start."""
    first = F.min(F.struct(*DOC, "start"))
    by = found.groupBy("anchor", "stretch").agg(F.max("windows").alias("windows"), F.count(F.lit(1)).alias("seen"), first.alias("first"))
    return by.select("anchor", "stretch", "windows", "seen", "first.doc_id", "first.version", "first.start")


#: Stretches of one anchor beyond which its windows are grouped one by one, and symbols of stretches in a group.
HOT_ANCHOR = 16_384


def bodies(todo: DataFrame, docs: DataFrame, length: int, of_bytes: bool) -> DataFrame:
    """The text of each stretch of `todo` (stretches with a flag hot), cut from its first occurrence.

    docs: a row for each document. anchor, stretch, seen, doc_id, version, start, windows, body; hot ones have instead of a
    body the hashes of their windows (`each`).
    """
    ship(docs.sparkSession)
    where = todo.groupBy(*DOC).agg(F.collect_list(F.struct("anchor", "stretch", "seen", "start", "windows", "hot")).alias("cut"))
    rows = docs.join(where, DOC).select(*DOC, "text", *(F.col(f"cut.{c}").alias(c) for c in ("anchor", "stretch", "seen", "start", "windows", "hot")))
    names = ["anchor", "stretch", "seen", *DOC, "start", "windows", "body", "each"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            out: list[list] = [[] for _ in names]
            for i in range(b.num_rows):
                chunk = next(tc.chunks(b.column(2).slice(i, 1)))
                if of_bytes:
                    symbols, starts, ends = chunk.data, None, None
                else:
                    starts, ends, _ = tc.word_bounds(chunk)
                    symbols = tc.word_hashes(chunk, starts, ends)
                view, size = memoryview(np.ascontiguousarray(symbols)).cast("B"), symbols.itemsize
                whole = chunk.data.tobytes()
                for anchor, stretch, seen, at, n, hot in zip(*(b.column(c)[i].as_py() for c in range(3, 9)), strict=True):
                    last = at + n + length - 1
                    body = None if hot else whole[at:last] if of_bytes else whole[starts[at] : ends[last - 1]]
                    each = [digest(view[j * size : (j + length) * size]) - (1 << 63) for j in range(at, at + n)] if hot else None
                    for column, value in zip(out, (anchor, stretch, seen, b.column(0)[i].as_py(), b.column(1)[i].as_py(), at, n, body, each), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return rows.mapInArrow(run, "anchor bigint, stretch bigint, seen bigint, doc_id bigint, version bigint, start int, windows int, body binary, each array<bigint>")


def marked_one_by_one(cuts: DataFrame, flag) -> DataFrame:
    """anchor, stretch, marks of hot anchors: the prefix that a window is grouped by is as long as the window itself.

    The group of such a prefix is one node, of which only aggregates are needed: flag(first, n, own) gives the mark of a
    window at `own` (doc_id, version, start) from the node's first place and its number of leaves, repeated stretches counted.
    """
    windows = cuts.filter("each is not null").select("anchor", "stretch", "seen", *DOC, "start", F.posexplode("each").alias("nth", "window"))
    own = F.struct(*DOC, (F.col("start") + F.col("nth")).alias("start"))
    nodes = windows.groupBy("window").agg(F.min(own).alias("first"), F.sum("seen").alias("n"))
    marks = windows.join(nodes, "window").select("anchor", "stretch", F.struct("nth", F.when(flag(F.col("first"), F.col("n"), own), "1").otherwise("0").alias("mark")).alias("x"))
    return marks.groupBy("anchor", "stretch").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["mark"]), "").alias("marks"))


def marked(cuts: DataFrame, solve, per_group: int) -> DataFrame:
    """anchor, stretch, marks of all other anchors: groups of whole anchors, about per_group symbols each, are solved.

    solve(bodies, windows, seen, doc_ids, versions, starts) gets the stretches of a group and gives a bool array of all their windows.
    """
    rest = cuts.filter("body is not null")
    symbols = rest.agg(F.sum(F.length("body"))).first()[0] or 0
    groups = max(1, -(-symbols // per_group))

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        windows = group["windows"].to_numpy()
        marks = solve(group["body"].to_pylist(), windows, group["seen"].to_numpy(), *(group[c].to_numpy() for c in DOC), group["start"].to_numpy())
        text = (marks.astype(np.uint8) + 48).tobytes().decode()
        ends = np.cumsum(windows).tolist()
        return pa.table([group["anchor"], group["stretch"], pa.array([text[i:j] for i, j in zip([0, *ends], ends)], pa.string())], ["anchor", "stretch", "marks"])

    return rest.withColumn("group", F.pmod(F.xxhash64("anchor"), F.lit(groups))).groupBy("group").applyInArrow(run, "anchor bigint, stretch bigint, marks string")


def covered(docs: DataFrame, found: DataFrame, length: int, of_bytes: bool, schema: str, digest) -> DataFrame:
    """One row per row of docs, made by digest(data, borders, covered, starts, ends) from the chunk's covered symbols.

    docs: doc_id, version, text. found: doc_id, version, start, windows, marks (which of a run's windows count; null: all).
    """
    ship(docs.sparkSession)
    flags = found.groupBy(*DOC).agg(F.collect_list(F.struct("start", "windows", "marks")).alias("f"))
    rows = docs.join(flags, DOC, "left").select("doc_id", "text", *(F.col(f"f.{c}").alias(c) for c in ("start", "windows", "marks")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk in tc.chunks(b.column(1)):
                lo, hi = chunk.rows
                starts, ends, borders = (None, None, chunk.borders) if of_bytes else tc.word_bounds(chunk)
                lists = [b.column(c).slice(lo, hi - lo) for c in (2, 3, 4)]
                base = np.repeat(borders[:-1], lists[0].value_lengths().fill_null(0).to_numpy())
                at, n = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists[:2])
                at, marks = at + base, lists[2].flatten()
                whole = marks.is_null().to_numpy(zero_copy_only=False)
                step = np.zeros(int(borders[-1]) + 1, np.int32)
                np.add.at(step, at[whole], 1)
                np.add.at(step, at[whole] + n[whole] + length - 1, -1)
                for i in np.flatnonzero(~whole).tolist():
                    on = at[i] + np.flatnonzero(np.frombuffer(marks[i].as_buffer(), np.uint8) == 49)
                    np.add.at(step, on, 1)
                    np.add.at(step, on + length, -1)
                columns = digest(chunk.data, borders, np.cumsum(step[:-1]) > 0, starts, ends)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *columns.values()], ["doc_id", *columns])

    return rows.mapInArrow(run, f"doc_id bigint, {schema}")
