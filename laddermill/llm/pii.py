"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Kinds, in the order in which spans with the same start are listed. The first four are the base: their spans are those
of plain patterns and checks, whatever the score. iban (confirmed by mod 97), ssn and tel (both decided by the words
nearby) are what the method adds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.llm.common import ship, table

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "tel")
BASE = KINDS[:4]

# The local part and the labels hold no "@", so a search can go from one "@" to the next.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can't begin inside a run of digits: it would have to be a shorter end of a match from the run's first digit.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an IBAN by country.
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 "
    "IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 SV28 TL23 TN24 "
    "TR26 UA29 VA22 VG24 XK20"
).split()}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
TEL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
DIGIT = re.compile(r"[0-9]")

#: Characters before a span in which context words count, what a word adds to the score, and the least score.
REACH, LIFT, LEAST = 48, 0.4, 0.5
#: Score of a span by itself.
SCORE = {"iban": 0.9, "ssn": 0.3, "tel": 0.3}
CONTEXT = {
    "iban": re.compile(r"\b(?:iban|account|bank|konto|compte|cuenta)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security|taxpayer|tin)\b", re.I),
    "tel": re.compile(r"\b(?:tel|telephone|phone|call|mobile|cell|fax|telefon|téléphone|teléfono)\b", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans confirmed by mod 97: of a match's ends, which are at blanks, that of the country's length or else the last."""
    at = 0
    while m := IBAN.search(text, at):
        ends, at = [m.end(), *(i for i in range(m.end() - 1, m.start(), -1) if text[i] == " ")], m.start() + 1
        sized = [(len(c), e) for e in ends if 15 <= len(c := text[m.start() : e].replace(" ", "")) <= 34 and mod97(c)]
        if sized:
            own = IBAN_LENGTHS.get(m[0][:2])
            at = next((e for n, e in sized if n == own), sized[0][1])
            yield m.start(), at


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the email pattern, in time linear in the text."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        if at > free and (m := DOMAIN.match(text, at + 1)):
            # the run of local characters that ends at the "@", no further back than the last match
            start = at
            while start > free and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
                start -= 1
            if start < at:
                found.append((start, m.end()))
                free = m.end()
        at = text.find("@", at + 1)
    return found


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, end, index of the kind) by start, then kind; code points, end exclusive. Null or empty: none."""
    if not text:
        return []
    found = [(s, e, 0) for s, e in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return found
    found += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        found += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    base = sorted(found)
    of = lambda pattern: ((m.start(), m.end()) for m in pattern.finditer(text))
    for kind, proposed in (("iban", ibans(text)), ("ssn", of(SSN)), ("tel", of(TEL))):
        for start, end in proposed:
            near = text[max(0, start - REACH) : start]
            score = SCORE[kind] + LIFT * bool(CONTEXT[kind].search(near))
            if score >= LEAST and not any(s < end and start < e for s, e, _ in base):
                found.append((start, end, KINDS.index(kind)))
    return sorted(found, key=lambda x: (x[0], x[2]))


def listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in found)


def redacted(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with a tag in the place of each span; overlapping spans become one, tagged by the first."""
    out, at = [], 0
    for s, e, k in found:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, and spans array<struct<kind,start,end>> by start, then kind.

    A null or empty text has no spans. Rows repeat as they do in docs; other columns are ignored.
    """
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>"

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], [id_col, "spans"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with a tag such as [EMAIL] in the place of each span; n_chars, if there, follows the text.

    Columns, their order and rows stay; a null text stays null.
    """
    at = docs.columns.index(text_col)

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [t and redacted(t, spans(t)) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    name = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    of = lambda k: F.filter("spans", lambda x: x["kind"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"), F.array_join(F.transform("spans", name), ",").alias("spans"))


QUERIES = {"op4_pii": op4_pii}
ORACLE: dict[str, str] = {}
