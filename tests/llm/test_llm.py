"""The training-data operators beside brute force, on a fixture with nulls, empty, long, tied and repeated rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from laddermill.llm import bpe, chroma, common, components, licenses, mixing, near_dedup, pii, quality, substring_dedup, suffix_dedup, url_filters

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, anchor string, taken int, start string"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdeé€ñ") for _ in range(rnd.randint(1, 6)))
    base = [[word() for _ in range(rnd.randint(30, 140))] for _ in range(12)]
    out = [None, "", "   \n\t ", "one", "one two three", "x" * 5000, "a b " * 3000, "<|endoftext|> #*$", "Same LINE\nsame line\nSame LINE\n"]
    for b in base:
        out.append(" ".join(b))
        out.append("\n".join([" ".join(b[:40]), " ".join(b[40:])]))
        c = list(b)
        c[rnd.randrange(len(c))] = word()
        out.append("  ".join(c))
        out.append(" ".join([word() for _ in range(30)] + b[5:30] + [word() for _ in range(9)]))
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t) if t else None, "clash", "clash", 1, None) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[12]], SCHEMA)  # row 12 is there twice


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def want_substrings(texts, length):
    seen, out = set(), {}
    for i, t in enumerate(texts):
        w = WORDS.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            k = tuple(w[s : s + length])
            if k in seen:
                gone[s : s + length] = [True] * length
            seen.add(k)
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"group_bytes": 900, "hot": 3}, {"length": 9, "gram": 2}])
def test_substrings(docs, texts, options):
    assert by_id(substring_dedup.substring_dedup(docs, **options)) == want_substrings(texts, options.get("length", 20))


def want_bytes(texts, length):
    data = [(t or "").encode() for t in texts]
    n = collections.Counter(b[s : s + length] for b in data for s in range(len(b) - length + 1))
    out = {}
    for i, b in enumerate(data):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if n[b[s : s + length]] > 1:
                gone[s : s + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"group_bytes": 3000}, {"length": 37, "gram": 4}])
def test_bytes(docs, texts, options):
    # row 12 is there twice and is one document
    got = suffix_dedup.suffix_dedup(docs, **options)
    assert by_id(got) == want_bytes(texts, options.get("length", 200)) and got.count() == len(texts) + 1


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"group_bytes": 900}])
def test_repeated_ids_with_different_texts(spark, empty, options):
    """Each text is a document of its own: marks of one never lie on another."""
    say = lambda x, n: " ".join(f"{x}{i}" for i in range(n))
    x = say("x", 60)
    for second in ("short one", f"{say('y', 200)} {x}"):
        rows = [(1, x), (2, f"{say('y', 30)} {x}"), (2, second), (3, say("z", 30)), (4, say("q", 50)), (4, say("q", 50)), (5, None), (None, x)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        found = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(docs, **options).collect()}
        assert found >= {(1, 60, 0), (3, 30, 0), (4, 50, 0), (5, 0, 0), (None, 60, 0)} and len(found) == 7
        # of the two texts with the doc_id 2 the later one by its hash also repeats the y words of the other
        twos = {x[1:] for x in found if x[0] == 2}
        assert twos in ([{(90, 60), (2, 0)}] if second == "short one" else [{(90, 60), (260, 90)}, {(90, 90), (260, 60)}])
        data = {n: t.encode() for n, t in enumerate(t for k, t in dict.fromkeys(rows) if k is not None and t)}
        want = collections.Counter((r[0], r[1]) for r in want_bytes([b.decode() for b in data.values()], 200).values())
        got = suffix_dedup.suffix_dedup(docs, **options).collect()
        assert collections.Counter({(r.n_bytes, r.n_removed) for r in got if r.doc_id in (1, 2, 3, 4)}) == collections.Counter(want.keys())
    assert substring_dedup.substring_dedup(empty).count() == 0 and suffix_dedup.suffix_dedup(empty).count() == 0


def test_two_stage_orders_all_suffixes():
    rnd = random.Random(2)
    for _ in range(60):
        s = bytes(rnd.choice(b"aab\0z") for _ in range(rnd.randint(1, 70)))
        text = np.frombuffer(s, np.uint8)
        got = suffix_dedup.two_stage(text, suffix_dedup.eights(text, 200), 200).tolist()
        real = [i for i in got if i + 20 <= len(s)]
        assert sorted(got) == list(range(len(s)))
        assert [s[i : i + 20] for i in real] == sorted(s[i : i + 20] for i in real)


def test_quality_counts(docs, texts):
    got = by_id(quality.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))
    for i, t in enumerate(texts):
        w = WORDS.findall(t or "")
        n = collections.Counter(tuple(w[s : s + 8]) for s in range(len(w) - 7))
        inside = [False] * len(w)
        for s in range(len(w) - 7):
            if n[tuple(w[s : s + 8])] > 1:
                inside[s : s + 8] = [True] * 8
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if WORDS.search(line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 20 or 100 * sum(inside) > 30 * len(w)
        assert got[i][:6] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, sum(inside), failed)
        assert not (failed and got[i][6])


def plain_fit(voted, n_rules):
    """Expectation-maximisation over the documents one by one."""
    q, total = quality, len(voted)
    e = {"good": [q.PRIOR_GOOD] * n_rules, "bad": [q.PRIOR_BAD] * n_rules}
    pooled = [sum(v[i] == 0 for v in voted) / total for i in range(n_rules)]
    for _ in range(q.ITERATIONS):
        p = []
        for v in voted:
            a, z = q.GOOD, 1 - q.GOOD
            for i, x in enumerate(v):
                a, z = a * max(e["good"][i][x + 1], 1e-12), z * max(e["bad"][i][x + 1], 1e-12)
            p.append(a / (a + z))
        for c, prior in (("good", q.PRIOR_GOOD), ("bad", q.PRIOR_BAD)):
            w = p if c == "good" else [1 - x for x in p]
            for i in range(n_rules):
                no, none, yes = (sum(x for x, v in zip(w, voted) if v[i] == k) for k in (-1, 0, 1))
                none = (none / sum(w) + q.POOLED * pooled[i]) / (1 + q.POOLED)
                no, yes = no + q.PRIOR_WEIGHT * total * prior[0], yes + q.PRIOR_WEIGHT * total * prior[2]
                no = no / (no + yes) * (1 - none)
                no = min(no, q.MOST_FALSE) if c == "good" else no
                e[c][i] = (no, none, 1 - none - no)
    return e


def test_quality_expectation_maximisation(spark):
    """The aggregated iterations give what plain ones over the documents give."""
    voted = quality.votes(quality.counts(spark.read.parquet(f"{SF}/documents.parquet"))).select(*(f"v_{r}" for r in quality.RULES))
    got, want = quality.fit(voted), plain_fit([tuple(r) for r in voted.collect()], len(quality.RULES))
    for c in ("good", "bad"):
        assert [x for r in quality.RULES for x in got[c][r]] == pytest.approx([x for e in want[c] for x in e], abs=1e-9)


@pytest.mark.parametrize("share", [0.02, 0.1, 0.3])
def test_quality_rejects_each_kind_of_junk(spark, share):
    """Junk that one rule sees, none of which fails the base, be it rare or frequent; plain documents stay."""
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("aeioubcdfglmnprst") for _ in range(rnd.randint(2, 9))) for _ in range(900)]
    plain = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    twice = lambda x: f"{plain(72)} {x} {x}"
    lines = lambda x: "\n".join([*(plain(rnd.randint(12, 20)) for _ in range(11)), *[x] * 9])
    kinds = {
        "good": lambda: "\n".join(plain(rnd.randint(8, 30)) for _ in range(rnd.randint(2, 9))),
        "lines": lambda: lines(plain(5)),
        "words": lambda: twice(plain(10)),
        "symbols": lambda: " ".join(w + rnd.choice(["", "#", "|", "<", "$"]) for w in plain(80).split()),
        "short": lambda: "\n".join(plain(1) for _ in range(40)),
        "sizes": lambda: " ".join(plain(4).replace(" ", "") for _ in range(40)),
    }
    sizes = {k: int(1500 * (1 - share)) if k == "good" else int(1500 * share / 5) for k in kinds}
    rows = [(kind, kinds[kind]()) for kind, n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame([(i, kind, t) for i, (kind, t) in enumerate(rows)], "doc_id bigint, kind string, text string")
    judged = quality.judged(docs, more=("kind",)).groupBy("kind").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.avg(F.col("base_failed").cast("int")).alias("base"))
    found = {r.kind: (r.kept, r.base) for r in judged.collect()}
    assert found["good"][0] >= 0.95 and all(kept <= 0.1 for kind, (kept, _) in found.items() if kind != "good")
    assert all(found[kind][1] < 0.1 for kind in kinds)


def test_quality_judges_rows_not_ids(spark, empty):
    """A rejected text goes though another row with its id is good; repeated rows stay together; nulls and no rows work."""
    good = " ".join(f"plain word number {i} of many" for i in range(20))
    docs = spark.createDataFrame([(1, good), (1, "short"), (None, good + " x"), (None, None), (2, good), (2, good)], "doc_id bigint, text string")
    assert sorted((tuple(r) for r in quality.keep_good(docs).collect()), key=str) == sorted([(1, good), (None, good + " x"), (2, good), (2, good)], key=str)
    assert quality.judged(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_quality_keeps_labelled_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    judged = quality.judged(spark.read.parquet(f"{SF}/documents.parquet")).join(labels, "doc_id").filter("not base_failed")
    n, right = judged.agg(F.count(F.lit(1)), F.count_if(F.col("kept") == (F.col("quality") == 1))).first()
    assert right >= 0.95 * n


def plain_base(t):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_pii_base_is_the_plain_patterns():
    rnd = random.Random(5)
    for alphabet, n in (("aZ09.@-+_ %()é1234567890 .. 4", 3000), ("0123456789 -", 1000), ("1.@a", 1000)):
        for _ in range(n):
            t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80)))
            assert [x for x in pii.spans(t) if x[2] < 4] == plain_base(t)


def test_pii_adds_confirmed_spans(spark, docs, empty):
    t = "IBAN DE89 3704 0044 0532 0130 00 or DE89370400440532013001, my SSN: 123-45-6789, not 123-45-6789. " + "z" * 60 + " 219-09-9999"
    found = [(pii.KINDS[k], t[s:e]) for s, e, k in pii.spans(t)]
    assert ("iban", "DE89 3704 0044 0532 0130 00") in found and ("ssn", "123-45-6789") in found
    assert not any("219" in x or "013001" in x for _, x in found)
    assert pii.redact(spark.createDataFrame([(1, "a@b.cd x", 8)], "doc_id int, text string, n_chars int")).first()[1:] == ("[EMAIL] x", 9)
    assert pii.find_pii(docs).count() == docs.count() and pii.find_pii(empty).count() == 0
    assert pii.redact(docs).filter("text is null").count() == 1


def test_pii_scores_beside_brute_force():
    """Every stretch that has the form of a number, its own score and its context, one by one."""
    rnd = random.Random(9)
    near = {"ssn": {"ssn", "taxpayer", "tin"}, "tel": {"tel", "call", "fax", "phone"}}

    def ssn(x):
        a, b, c = x[:3], x[4:6], x[7:]
        return len(x) == 11 and x[3] == x[6] == "-" and (a + b + c).isdigit() and a not in ("000", "666") and a[0] != "9" and b != "00" and c != "0000"

    def tel(x):
        if x[0] == "(":
            x = x[1:4] + x[4:].replace(")", "", 1) if x[4:5] == ")" else "?"
            x = x if x[3:4] == " " else x[:3] + " " + x[3:]
        return len(x) == 12 and x[3] in " .-" and x[7] in " .-" and (x[:3] + x[4:7] + x[8:]).isdigit()

    for _ in range(3000):
        parts = [rnd.choice(["ssn", "call", "word", "TIN", "fax", "other", "y" * rnd.randint(1, 40), "123-45-6789", "000-12-3456", "912-34-5678", "219-09-9999x", "555-123-4567", "(555) 123-4567", "(555)123 4567", "555.123.4567", "1555-123-4567", "555-123-45678"]) for _ in range(rnd.randint(1, 7))]
        t = rnd.choice([" ", "  ", ", "]).join(parts)
        got = [x for x in pii.spans(t) if x[2] >= 4]
        base = [x for x in pii.spans(t) if x[2] < 4]
        want = []
        for kind, form, sizes, left, right in (("ssn", ssn, (11,), "0123456789-", "0123456789-"), ("tel", tel, (12, 13, 14), "0123456789+.-", "0123456789.-")):
            at = 0
            while at < len(t):
                fits = [n for n in sizes if at + n <= len(t) and form(t[at : at + n]) and not (at and t[at - 1] in left) and not (at + n < len(t) and t[at + n] in right)]
                if fits:
                    end = at + max(fits)
                    words = set(re.findall(r"\w+", t[max(0, at - pii.REACH) : at].lower()))
                    if words & near[kind] and not any(s < end and at < e for s, e, _ in base):
                        want.append((at, end, pii.KINDS.index(kind)))
                    at = end
                else:
                    at += 1
        assert got == sorted(want), t


def test_pii_finds_an_iban_before_capitals():
    for t, want in (
        ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", ["DE89 3704 0044 0532 0130 00"]),
        ("GB82 WEST 1234 5698 7654 32 DE89370400440532013000 12", ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]),
        ("AB12 DE89 3704 0044 0532 0130 00", ["DE89 3704 0044 0532 0130 00"]),
        ("DE89 3704 0044 0532 0130 01 BIC COBADEFFXXX", []),
    ):
        assert [t[s:e] for s, e, k in pii.spans(t) if pii.KINDS[k] == "iban"] == want


def test_bpe_is_the_library(spark, docs, texts, empty):
    t, own = Tokenizer.from_file(bpe.default_path()), bpe.Bpe(bpe.default_path())
    rnd = random.Random(3)
    pool = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070), 0x1F600, 0x4E2D, 0x661, 0xB2, 0x2160, 0xFEFF, 0xFFFD]]
    more = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    for x in [*(y or "" for y in texts), *more, "a<|endoftext|><|endoftext|> b", " " * 3000]:
        ids = t.encode(x, add_special_tokens=False).ids
        assert own.encode(x) == ids
        assert own.decode(ids) == t.decode(ids, skip_special_tokens=False)
    got = by_id(bpe.digests(docs))
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert got[i] == (len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))
    assert bpe.digests(empty).count() == 0
    assert {r.doc_id: r.decoded for r in bpe.tokenize(docs).collect()} == {i: x or "" for i, x in enumerate(texts)}


def shingles(t, k=4):
    w = WORDS.findall(t.translate({c: c + 32 for c in range(65, 91)})) if t else []
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near(texts, k=4):
    sets, parent = [shingles(t, k) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: (len(s), find(i), find(i) == i) for i, s in enumerate(sets)}


def test_near_duplicates(spark, docs, texts, empty):
    assert by_id(near_dedup.near_duplicates(docs)) == near(texts)
    assert near_dedup.near_duplicates(empty).count() == 0
    ids = {r.doc_id for r in near_dedup.drop_near_duplicates(docs, shingle=5).collect()}
    assert ids == {i for i, x in near(texts, 5).items() if x[2]}
    nulls = spark.createDataFrame([(None, texts[10]), (3, texts[10])], "doc_id bigint, text string")
    assert sorted(map(str, near_dedup.near_duplicates(nulls).select("component_id", "kept").collect())) == ["Row(component_id=3, kept=True)", "Row(component_id=None, kept=None)"]


def test_near_duplicates_with_repeated_ids(spark, texts):
    """A document with several texts holds their components together; reruns over other partitions agree."""
    a, b, c = texts[9], texts[13], texts[17]
    rows = [(5, a), (5, b), (7, b), (9, a), (3, c), (5, None), (8, c), (8, "x y z"), (2, "x y z"), (8, c), (11, "alone")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = [(2, 2), (3, 2), (5, 5), (5, 5), (5, 5), (7, 5), (8, 2), (8, 2), (8, 2), (9, 5), (11, 11)]
    for d in (docs, docs.repartition(3, "text")):
        assert sorted((r.doc_id, r.component_id) for r in near_dedup.near_duplicates(d).collect()) == want
    assert sorted(r.doc_id for r in near_dedup.drop_near_duplicates(docs).collect()) == [2, 5, 5, 5, 11]


def test_near_duplicates_of_dense_groups(spark):
    """Copies around the limit, with a passage that all share: hardly any is linked with a centre, and no link is lost."""
    rnd = random.Random(12)
    passage, out = [f"p{i}" for i in range(40)], []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(30)]
        for _ in range(25):
            t = list(base)
            for _ in range(rnd.randint(0, 3)):
                t[rnd.randrange(30)] = f"x{rnd.randrange(10**6)}"
            out.append(" ".join(t + passage))
    docs = spark.createDataFrame([*enumerate(out)], "doc_id bigint, text string")
    assert by_id(near_dedup.near_duplicates(docs)) == near(out)


def test_near_duplicates_of_a_crowded_bucket(spark):
    """Twelve pairs of near copies in one bucket with one centre."""
    rnd = random.Random(8)
    firsts = [[f"w{rnd.randrange(10**6)}" for _ in range(60)] for _ in range(12)]
    rows = [(2 * i + k, " ".join([*f[: 60 - k], *["other"] * k])) for i, f in enumerate(firsts) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    nodes = spark.createDataFrame([(i, 57, [1]) for i, _ in rows], "rep bigint, n_shingles bigint, bands array<bigint>")
    links = near_dedup.near_links(nodes, docs).collect()
    assert {tuple(sorted(x)) for x in links} == {(2 * i, 2 * i + 1) for i in range(12)}


def test_near_duplicates_of_sf(spark):
    got = by_id(near_dedup.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")))
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert got == near([rows[i] for i in range(len(rows))])


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (201, 200)]
    got = dict(components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect())
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100} and got[201] == 200 and 202 not in got


def test_mixing(spark, docs, texts, empty):
    plan = mixing.plan_mix(docs.dropDuplicates(["doc_id"]).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), rows_per_range=2)
    rows = plan.collect()
    sizes = collections.defaultdict(int)
    for r in rows:
        assert r["size"] == len(WORDS.findall(texts[r.doc_id] or "")) and 0 <= r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
    order = sorted(x for x in sizes if x) + [None]
    weight = {x: 1 + i % 3 for i, x in enumerate(order)}
    total, target = sum(sizes.values()), {}
    free = set(order)
    while True:
        left, w = total - sum(target.values()), sum(weight[x] for x in free)
        over = [x for x in free if left * weight[x] / w > 3 * sizes[x]]
        if not over:
            break
        for x in over:
            target[x] = 3 * sizes[x]
            free.discard(x)
    target |= {x: left * weight[x] / w for x in free}
    for x in order:
        mine = [r for r in rows if r.source == x]
        assert all(r.target == pytest.approx(target[x]) and r.source_size == sizes[x] for r in mine)
        assert sum(r.taken for r in mine) == int(target[x] + 1e-6)
    mixed = mixing.mix(docs.dropDuplicates(["doc_id"]))
    assert mixed.columns == docs.columns and mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.plan_mix(empty.select("doc_id", "source", F.lit(0).cast("long").alias("size"))).count() == 0


def test_mixing_takes_each_row_by_itself(spark):
    """Rows that repeat a doc_id or have none are mixed one by one: each source's words are its budget."""
    rows = [(None if i % 3 == 0 else i % 5, " ".join(f"{'abc'[i % 3 - i % 2]}{i}x{k}" for k in range(1 + i * 7 % 13)), "abc"[i * i % 7 % 3]) for i in range(60)]
    docs = spark.createDataFrame([*rows, *rows[:4]], "doc_id bigint, text string, source string")
    sizes = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    want = {r.source: int(r.target) for r in mixing.targets(sizes).collect()}
    mixed = mixing.mix(docs)
    got = mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    assert {r.source: r.n for r in got} == want
    again = mixing.mix(docs.repartition(3, "text")).collect()
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again))


def test_licences(spark):
    say = lambda n: " ".join(f"word{i}" for i in range(n))
    wrapped = licenses.TEMPLATES["MIT"].split("\n")[1].strip()
    wrapped = "\n".join(wrapped[i : i + 60] for i in range(0, 120, 60)) + wrapped[120:]
    files = [
        (1, "a/b/LICENSE", "Released under the MIT license."), (2, "a/b/c/d.txt", "words of a text"), (3, "a/x.txt", "Prose comes first.\nThis work\nis licensed under the GNU General Public License, version 3.\nmore"),
        (4, "a/y.txt", None), (5, None, ""), (6, "q/a/b/z.txt", "it is"), (7, "r/s.txt", f"{say(60)}. Licensed under the Apache License, Version 2.0. {say(60)}"),
        (8, "t/COPYING", f"A title\n\nCopyright 2019 someone\n\n{wrapped}\n\nmore"), (9, "t/u/v.c", "code"), (10, "t/w/x.c", "All rights reserved."), (11, "t/w/y.c", "x"),
    ]
    got = by_id(licenses.scan(spark.createDataFrame([(*f, "clash", 1.0) for f in files], "doc_id bigint, path string, text string, token string, score double")))
    assert got[1][1] == "MIT" and got[2][1] == "MIT" and got[2][3] == "a/b"
    assert got[3][1] == "GPL-3.0" and got[3][3] == "a/x.txt"  # does not begin the file, so not its directory's
    assert got[4][1] is None and got[5][1] is None and got[6][1] is None
    assert got[7][1] == "Apache-2.0" and got[8][1] == "MIT" and got[9][1:4:2] == ("MIT", "t") and got[11][1:4:2] == ("LicenseRef-reserved", "t/w")
    assert licenses.scan(spark.createDataFrame([], "doc_id bigint, path string, text string")).count() == 0


def plain_licences(files):
    """Own licences by the cosine of every unit with every template, without filters."""
    n, df = len(files), collections.Counter(t for f in files for t in set(licenses.tokens(f or "")))
    vector = lambda counts: {t: k * (np.log((n + 1) / (df[t] + 1)) + 1) for t, k in counts.items()}
    norm = lambda v: sum(x * x for x in v.values()) ** 0.5
    templates = [(name, vector(c)) for name, c in licenses.template_units()]
    versions = lambda ts: {t for t in ts if re.fullmatch(licenses.VERSION, t)}
    variants = lambda ts: set(ts) & set(licenses.VARIANTS)

    def nearest(unit, v):
        fit = [(round(sum(x * t.get(k, 0) for k, x in v.items()) / (norm(v) * norm(t) or 1), 9), name) for name, t in templates if versions(t) <= set(v) and variants(t) == variants(v)]
        top = max(fit, default=(0, ""))
        return top if {name for score, name in fit if score == top[0]} == {top[1]} else (0, "")

    out, memo = [], {}
    for f in files:
        pieces = [x for line in (f or "").split("\n") for x in (line, *re.split(licenses.SENTENCE, line))]
        pieces += [x for p in re.split(r"\n[ \t\r]*\n", f or "") for x in re.split(licenses.SENTENCE, re.sub(r"\s*\n\s*", " ", p))]
        best = (0, "")
        for unit in {" ".join(licenses.tokens(p)) for p in pieces}:
            if unit not in memo:
                v = vector(collections.Counter(unit.split()))
                memo[unit] = nearest(unit, v)
            best = max(best, memo[unit])
        out.append(best if best[0] >= licenses.LEAST else None)
    return out


HEADERS = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as\npublished by the Free Software Foundation, either version 3 of the\nLicense, or (at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "MPL-1.1": 'The contents of this file are subject to the Mozilla Public License Version\n1.1 (the "License"); you may not use this file except in compliance with\nthe License.',
    None: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-3-Clause": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
}


def test_near_kin_are_told_apart(spark):
    """Headers of licences that differ by a version or a variant have their own names; what several share has none."""
    said = [f"Copyright 2020 somebody\n\n{text}\n\nfirst of the words" for text in HEADERS.values()]
    said += ["This work is licensed under a Creative Commons Attribution 3.0 International License.", "This work is licensed under the GNU Library General Public License, version 3."]
    files = [(i, None, t) for i, t in enumerate([*said, *["this is the work of words, and the license of the public"] * 40])]
    got = by_id(licenses.scan(spark.createDataFrame(files, "doc_id bigint, path string, text string")))
    assert [got[i][1] for i in range(len(said))] == [*HEADERS, None, None]
    assert not any(got[i][1] for i in range(len(said), len(files)))


def test_words_are_found_by_their_beginnings():
    words = ["a", "ab", "abc.1", "b", "be", "c+"]
    found = re.compile(licenses.alternatives(words))
    assert all(found.fullmatch(w) for w in words) and not any(found.fullmatch(w) for w in ("", "abc", "abcx1", "cc", "bee"))


def test_licences_beside_every_cosine(spark):
    """On the given documents and on notices that are cut, mixed and diluted."""
    rows = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    rnd = random.Random(6)
    lines = [line.strip() for text in licenses.TEMPLATES.values() for line in text.split("\n")]
    pool = [w for line in lines for w in line.split()]
    for _ in range(400):
        w = rnd.choice(lines).split()
        for _ in range(rnd.randint(0, len(w))):
            w[rnd.randrange(len(w))] = rnd.choice([*pool, "other", "words"])
        rows.append(" ".join([*["more"] * rnd.randint(0, 3), *w]) + rnd.choice(["", ".", "\n", "\n\nend"]))
    want = plain_licences(rows)
    got = by_id(licenses.own_licenses(spark.createDataFrame([*enumerate(rows)], "doc_id bigint, text string")))
    assert sum(w is not None for w in want) > 100
    for i, w in enumerate(want):
        assert (w is None) == (i not in got) and (w is None or (got[i][0], got[i][1]) == (pytest.approx(w[0], abs=1e-8), w[1]))


def test_licences_count_all_tokens(spark):
    """The weight of a word outside the templates follows its documents, so a verdict doesn't change with the corpus's size."""
    for copies in (1, 40):
        files = ["This project is released under the MIT License.", *["this project is of words"] * 19] * copies
        got = by_id(licenses.scan(spark.createDataFrame([(i, None, f) for i, f in enumerate(files)], "doc_id bigint, path string, text string")))
        want = plain_licences(files)
        assert got[0][1] == "MIT" and got[0][2] == pytest.approx(want[0][0], abs=1e-6) and got[1][1] is None

def test_long_near_copies_are_not_compared_token_by_token(spark):
    """Long lines with a key token or a short notice in them can't be near a template: none of their tokens is joined."""
    rnd = random.Random(8)
    base = [rnd.choice(["the", "of", "is", "and", *(f"w{i}" for i in range(150))]) for _ in range(230)]
    copies = [" ".join(["Released under the MIT License" if i % 2 else "the license", *(x if rnd.random() < 0.9 else f"x{rnd.randrange(99)}" for x in base)]) for i in range(300)]
    rows = ["Released under the MIT License.", *copies, *["words of a text"] * 300]
    files = spark.createDataFrame([*enumerate(rows)], "doc_id bigint, text string")
    df, n = licenses.document_frequencies(files), len(rows)
    weights = licenses.template_weights(df, n)
    found = licenses.candidates(files, weights, licenses.LEAST, licenses.frequent_tokens(df, n)).collect()
    assert 0 in {r.doc_id for r in found} and len(found) < 10 and max(len(r.key) for r in found) <= 64
    got, want = by_id(licenses.own_licenses(files)), plain_licences(rows)
    assert {i: (got[i][1], round(got[i][0], 6)) for i in got} == {i: (w[1], round(w[0], 6)) for i, w in enumerate(want) if w}


def test_tokens_are_counted(spark):
    rows = spark.createDataFrame([(["b", "a", "b", "b"],), ([],), (["x"],)], "tokens array<string>").select(common.counted(F.col("tokens")).alias("c"))
    assert [[tuple(x) for x in r.c] for r in rows.collect()] == [[("a", 1), ("b", 3)], [], [("x", 1)]]


@pytest.mark.parametrize("slot", [7, 50, 1000])
def test_url_filters_are_an_as_of_join(spark, slot):
    """Beside plain look-ups in time, with ties, nulls, repeated rows and clashing columns."""
    rnd = random.Random(slot)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "b.org/p", "b.org/p/q"]
    entries = [(rnd.choice([*hosts, None]), rnd.choice([None, *range(400)]), rnd.choice(["block", "allow"]), 1) for _ in range(300)]
    urls = ["http://y.x.a.com/z", "https://x.a.com", "http://B.org/p/q/r", "http://b.org/p", "nothing", None]
    captures = [(i % 150, urls[i % 6], rnd.choice([None, *range(400)]), "clash") for i in range(160)]

    def active(url, at):
        m = re.match(r"[a-z]+://([^/:?#]+)((?:/[^/?#]+)?)((?:/[^/?#]+)?)", url or "", re.I)
        if not m or at is None:
            return (False, None, None)
        host = m[1].lower()
        labels = host.split(".")
        names = {".".join(labels[i:]) for i in range(max(1, len(labels) - 1))} | {host + m[2], host + m[2] + m[3]}
        best = (-1,)
        for name in names:
            held = max(((t, action) for p, t, action, _ in entries if p == name and t is not None and t <= at), default=None)
            if held:
                best = max(best, (len(name), name, held[1], held[0]))
        return (best[2] == "block", best[1], best[3]) if len(best) > 1 else (False, None, None)

    got = url_filters.filter_captures(spark.createDataFrame(captures, "page_id int, url string, fetched bigint, slot string"), spark.createDataFrame(entries, "pattern string, at bigint, action string, slot int"), slot)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == {c[:3]: active(c[1], c[2]) for c in captures}
    assert got.count() == len({c[:3] for c in captures})
    none = spark.createDataFrame([], "pattern string, at bigint, action string")
    assert url_filters.filter_captures(got, none).filter("blocked").count() == 0


def test_chroma(spark):
    rnd = np.random.default_rng(1)
    song, other = rnd.random((80, 12)) ** 3, rnd.random((80, 12)) ** 3
    rows = [(0, song), (1, song[20:]), (2, song + rnd.random(song.shape) * 0.005), (3, other), (4, song), (5, song[:10]), (6, None)]
    recordings = spark.createDataFrame([(i, None if f is None else f.ravel().tolist()) for i, f in rows], "rec_id bigint, frames array<double>")
    got = {r.rec_id: (r.class_id, r.query_id, r.offset) for r in chroma.align(recordings, recordings.filter("rec_id = 0")).collect()}
    assert got == {1: (1, 0, -20), 2: (2, 0, 0)}
    frames = rnd.random((30, 12))
    whole = [sum(frames[t][c] for t in range(i, i + 16) for c in range(6)) for i in range(15)]
    part = [sum(frames[t][c] for t in range(i, i + 16) for c in range(3)) for i in range(15)]
    level = np.digitize(np.log(part) - np.log(np.subtract(whole, part)), (-0.1, 0, 0.1))
    assert (chroma.fingerprint(frames) >> 30).tolist() == [(0, 1, 3, 2)[x] for x in level]


def test_chroma_matches_copies_of_a_query(spark):
    rnd = np.random.default_rng(1)
    song, other = rnd.random((80, 12)) ** 3, rnd.random((80, 12)) ** 3
    rows = [(0, song), (1, song[20:]), (3, other), (4, song), (7, other), (8, other)]
    recordings = spark.createDataFrame([(i, f.ravel().tolist()) for i, f in rows], "rec_id bigint, frames array<double>")
    got = {r.rec_id: tuple(r)[1:] for r in chroma.matches(recordings, recordings.filter("rec_id in (0, 7, 8)")).collect()}
    assert got.pop(1)[:4] == (1, 1, 0, -20)
    # 7 and 8 are queries and match each other; 0 is alone in its class but for 4, which is no query
    assert got == {4: (0, 1, 0, 0, 65, 65, 0.0), 3: (3, 1, 3, 0, 65, 65, 0.0), 7: (3, 1, 3, 0, 65, 65, 0.0), 8: (3, 1, 3, 0, 65, 65, 0.0)}


def test_chroma_is_an_exact_comparison(spark):
    """Beside every offset of every pair: on planted shifted and noisy copies and on vectors, hardly any is lost."""
    rnd = np.random.default_rng(3)
    songs = [rnd.random((70 + 3 * i, 12)) ** 2 for i in range(12)]
    noisy = lambda x, e: x * np.exp(rnd.normal(0, e, x.shape))
    rows = [*songs, *(noisy(x, 0.1) for x in songs), *(noisy(x[7 + i :], 0.05) for i, x in enumerate(songs)), *(np.concatenate((rnd.random((i + 1, 12)), noisy(x, 0.05))) for i, x in enumerate(songs))]
    planted = spark.createDataFrame([(i, f.ravel().tolist(), "clash") for i, f in enumerate(rows)], "rec_id bigint, frames array<double>, print string")
    vectors = chroma.as_recordings(spark.read.parquet(f"{SF}/embeddings.parquet"))
    for recordings, every in ((planted, 1), (vectors, 50)):
        prints = {r.rec_id: chroma.fingerprint(np.array(r.frames).reshape(-1, 12)) for r in recordings.collect()}
        want = set()
        for q in (x for x in prints if x % every == 0):
            for r in prints:
                for o in range(1 - len(prints[q]), len(prints[r])):
                    a, b = prints[q][max(0, -o) :], prints[r][max(0, o) :]
                    n = min(len(a), len(b))
                    if q != r and np.bitwise_count(a[:n] ^ b[:n]).sum() / (32 * n) <= min(chroma.MOST_ERROR, 0.5 - chroma.SURE * chroma.SPREAD / n**0.5):
                        want.add((q, r))
        got = {r.rec_id: r.n_queries for r in chroma.matches(recordings, recordings.filter(f"rec_id % {every} = 0")).collect()}
        n = collections.Counter(r for _, r in want)
        assert got.keys() <= n.keys() and all(got[r] <= n[r] for r in got)
        assert sum(got.values()) >= 0.95 * len(want)
        if every == 1:
            assert len(want) >= 12 * 12 and all(q % 12 == r % 12 for q, r in want)
    assert chroma.matches(planted.limit(0), planted).count() == 0


def test_chroma_near_copies_meet_a_block_of_queries_at_once(spark, monkeypatch):
    """Of near copies and silence the join makes a row for each integer and block, not for each query; votes are the same."""
    rnd = np.random.default_rng(5)
    prints = [[7] * 20 + [int(x) for x in np.where(rnd.random(30) < 0.9, np.arange(100, 130), rnd.integers(1000, 1010, 30))] for _ in range(60)]
    ones = spark.createDataFrame([*enumerate(prints)], "rec_id bigint, prints array<bigint>")
    asked = spark.createDataFrame([(i, p, [x for y in p for x in (y, y + 5000)]) for i, p in enumerate(prints[:40])], "query_id bigint, query_prints array<bigint>, probes array<bigint>")
    want = collections.Counter((q, r, j - i) for q in range(40) for r in range(60) for i, x in enumerate(prints[q]) for j, y in enumerate(prints[r]) if x == y)
    for block in (1000, 7):
        monkeypatch.setattr(chroma, "BLOCK", block)
        parts = chroma.dealt(asked)
        ids = {(r.block, r.nth): r.query_id for r in parts.collect()}
        assert chroma.meetings(parts, ones).count() <= 50 * 60 * -(-40 // block) < sum(want.values()) / 10
        assert {(ids[r.block, r.nth], r.rec_id, r.offset): r.votes for r in chroma.votes(parts, ones).collect()} == want


def test_chroma_tries_every_offset(spark, monkeypatch):
    """Votes at an offset with too little overlap don't hide those at one that is long enough."""
    query, rec = list(range(100, 130)), list(range(100, 130))
    query[25:30] = rec[:5] = range(1 << 20, (1 << 20) + 5)
    prints = spark.createDataFrame([(0, 0, query), (1, 1, rec)], "rec_id bigint, class_id bigint, prints array<bigint>")
    monkeypatch.setattr(chroma, "classes", lambda recordings: recordings)
    monkeypatch.setattr(chroma, "fingerprints", lambda recordings, unsure=None: recordings.select("rec_id", "prints"))
    got = chroma.align(prints, prints.filter("rec_id = 0")).select("rec_id", "offset", "votes", "overlap").collect()
    assert [tuple(r) for r in got] == [(1, 0, 20, 30)]


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept.append({r.doc_id: r.text for r in docs.collect()})
    good, unique, clean, mixed = kept
    sets = near([good[i] for i in sorted(good)], 5)
    assert sorted(unique) == [i for n, i in enumerate(sorted(good)) if sets[n][2]]
    assert clean.keys() == unique.keys() and not any("@mail" in t for t in clean.values())
    assert mixed.keys() <= clean.keys()
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert collections.Counter((r.doc_id, r.decoded) for r in final) == collections.Counter((r.doc_id, r.text) for r in docs.collect())


def test_queries_on_sf(spark):
    from laddermill.llm import registry

    for name in ("op5_license_scan", "op6_url_filter", "op8_chroma"):
        assert registry.QUERIES[name](spark, SF).columns
