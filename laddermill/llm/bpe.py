"""Byte-level BPE encoding and decoding.

Encoding splits texts into pieces by the vocabulary's pattern and merges each piece on its own: the symbols form a
doubly linked list, a priority queue holds the mergeable neighbours by merge rank, and entries whose symbols have
changed since are skipped. Decoding concatenates the vocabulary's strings and reads the bytes as UTF-8.

Texts are split a chunk at a time by the classes of their characters, each different piece of a chunk is merged once,
and the ids of all pieces are gathered from those of the different ones.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.llm.common import ship, table

#: Classes of characters in the vocabulary's pattern 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
OTHER, LETTER, NUMBER, SPACE = range(4)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

#: Pieces of either generation that a worker remembers; the older one is forgotten as a whole. It changes no result.
REMEMBERED = 250_000
#: Characters of the texts of one batch of results; a longer text is a batch of its own.
CHUNK = 1 << 20


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The class of each code point; surrogates, which UTF-8 texts do not hold, count as others."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
    return out


def piece_starts(codes: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Where pieces start among the code points of some segments one after the other; borders: of the segments.

    A run of one class is a piece. A single blank goes to the run after it; of more white space before a run all but
    the last is a piece and the last, if a blank, goes to the run. A quote that starts a piece takes an ending along.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kinds = character_classes()[codes]
    edge = np.zeros(n + 1, bool)
    edge[borders] = True
    run = edge.copy()
    run[1:n] |= kinds[1:] != kinds[:-1]
    start = run[:n].copy()
    ends = np.flatnonzero(run[1:] & (kinds == SPACE)) + 1  # where a run of white space ends
    ends = ends[~edge[ends]]
    start[ends - 1] = True  # its last character is apart from the rest of it ...
    start[ends[codes[ends - 1] == 0x20]] = False  # ... and goes to what follows if it is a blank
    quotes = np.flatnonzero(start & (codes == 0x27))
    for ending in ENDINGS:
        k, found = len(ending), quotes[quotes + len(ending) < n]
        for j, c in enumerate(ending, 1):
            found = found[(codes[found + j] == ord(c)) & ~edge[found + j]]
        start[found + 1] = False
        after = found + k + 1
        start[after[(after < n)]] = True
    return np.flatnonzero(start)


@dataclass
class Encoded:
    """Tokens of some texts: pieces (an index into `of`) and their borders by text; `of` has each different piece's ids."""

    pieces: np.ndarray
    borders: np.ndarray
    of: list[tuple[bytes, bytes]]

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the borders of the texts among them."""
        listed = [x[0] for x in self.of]
        sizes, flat = np.array([*map(len, listed)], np.int64) // 4, np.frombuffer(b"".join(listed), np.int32)
        first, n = (np.cumsum(sizes) - sizes)[self.pieces], sizes[self.pieces]
        ends = np.cumsum(n)
        place = np.arange(int(n.sum())) + np.repeat(first - (ends - n), n)
        return flat[place], np.append(0, ends)[self.borders]

    def decimals(self) -> Iterator[memoryview]:
        """For each text its ids in decimal, joined by commas."""
        joined = pa.array([x[1] for x in self.of], pa.large_binary()).take(pa.array(self.pieces))
        offsets, data = joined.buffers()[1:]
        at = np.frombuffer(offsets, np.int64)[self.borders].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        return (view[i : max(i, j - 1)] for i, j in zip(at, at[1:], strict=False))


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: visible Latin-1 for itself, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        #: rank of (left id, right id), and the merged id of each rank
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        letters = byte_alphabet()
        self.of_byte = [vocab[c] for c in letters]
        byte_of = {c: b for b, c in enumerate(letters)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        strings = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if s not in self.special}
        strings |= {i: s.encode() for s, i in self.special.items()}
        #: the bytes of each id
        self.strings = pa.array([strings.get(i) for i in range(max(strings) + 1)], pa.large_binary())
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: tuple[dict, dict] = {}, {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        ids, n, rank_of = [self.of_byte[b] for b in data], len(data), self.ranks.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [rank * n + i for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if (rank := rank_of(pair)) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if j < 0 or rank_of((ids[i], ids[j])) != rank:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = self.merged[rank], -1
            after[i], after[j] = k, _ = after[j], -1
            if k >= 0:
                before[k] = i
                if (rank := rank_of((ids[i], ids[k]))) is not None:
                    heapq.heappush(queue, rank * n + i)
            if (h := before[i]) >= 0 and (rank := rank_of((ids[h], ids[i]))) is not None:
                heapq.heappush(queue, rank * n + h)
        return [x for x in ids if x >= 0]

    def piece(self, piece: bytes) -> tuple[bytes, bytes]:
        """Its ids as 32-bit integers, and the same in decimal with a comma after each."""
        young, old = self.known
        found = young.get(piece) or old.get(piece)
        if not found:
            ids = self.merge(piece)
            found = array("i", ids).tobytes(), (",".join(map(str, ids)) + ",").encode()
        if piece not in young:
            if len(young) >= REMEMBERED:
                self.known = young, _ = {}, young
            young[piece] = found
        return found

    def encoded(self, texts: list[str]) -> Encoded:
        segments, special, borders = [], [], [0]
        for text in texts:
            parts = self.split.split(text) if self.split and any(s in text for s in self.special) else [text]
            for part in filter(None, parts):
                special.append(part in self.special)
                segments.append(part)
            borders.append(len(segments))
        joined = "".join(segments)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        at = np.cumsum([0, *map(len, segments)])
        starts = piece_starts(codes, at)
        if any(special):  # one piece each
            own = np.flatnonzero(special)
            inside = np.repeat(at[own], at[own + 1] - at[own] - 1)
            inside += np.concatenate([np.arange(1, n) for n in (at[own + 1] - at[own]).tolist()])
            starts = np.setdiff1d(starts, inside, assume_unique=True)
        widths = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        data, bounds = joined.encode(), np.append(0, np.cumsum(widths))[np.append(starts, len(codes))]
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        different = pieces.dictionary_encode()
        names = different.dictionary.to_pylist()
        of = [self.piece(x) for x in names]
        for k in np.unique(different.indices.to_numpy()[np.searchsorted(starts, at[:-1][special])]) if any(special) else ():
            i = self.special[names[k].decode()]
            of[k] = array("i", [i]).tobytes(), b"%d," % i
        return Encoded(different.indices.to_numpy(), np.searchsorted(starts, at[borders]), of)

    def encode(self, text: str) -> list[int]:
        return self.encoded([text]).ids()[0].tolist()

    def decoded(self, ids: np.ndarray, borders: np.ndarray) -> list[str]:
        """For each text the strings of its ids one after the other, read as UTF-8."""
        joined = self.strings.take(pa.array(ids))
        offsets, data = joined.buffers()[1:]
        at = np.frombuffer(offsets, np.int64)[borders].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        return [str(view[i:j], "utf-8", "replace") for i, j in zip(at, at[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        return self.decoded(np.array(ids, np.int32), np.array([0, len(ids)]))[0]


@lru_cache(maxsize=2)
def loaded(path: str) -> Bpe:
    """The tokenizer of a file that every machine has at `path`, or else got through SparkContext.addFile."""
    try:
        return Bpe(path)
    except FileNotFoundError:
        return Bpe(SparkFiles.get(path.rpartition("/")[2]))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts in runs of about CHUNK characters; a null text is empty."""
    for b in batches:
        first, size, texts = 0, 0, []
        for i, t in enumerate(b.column(1)):
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK or i == b.num_rows - 1:
                yield b.column(0).slice(first, len(texts)), texts
                first, size, texts = i + 1, 0, []


def tokenize(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, ids array<int>, decoded string. A null text counts as empty: no ids, ''."""
    path = vocabulary or default_path()
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, ids array<int>, decoded string"

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for names, texts in chunks(batches):
            ids, borders = bpe.encoded(texts).ids()
            listed = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([names, listed, pa.array(bpe.decoded(ids, borders), pa.string())], [id_col, "ids", "decoded"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As tokenize, but with n_tokens and digests of the ids and of the decoded text in their place.

    A null text counts as empty; rows repeat as they do in docs; other columns are ignored.
    """
    path = vocabulary or default_path()
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, sha = loaded(path), hashlib.sha256
        for names, texts in chunks(batches):
            found = bpe.encoded(texts)
            ids, borders = found.ids()
            columns = np.diff(borders), [sha(x).hexdigest() for x in found.decimals()], [sha(t.encode()).hexdigest() for t in bpe.decoded(ids, borders)]
            yield pa.RecordBatch.from_arrays([names, *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True))], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op9_bpe": op9_bpe}
ORACLE: dict[str, str] = {}
