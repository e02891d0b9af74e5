"""Known forms of secrets against their patterns, copies under one id, quality over all rows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rivulet.llm import jaccard, phrases, quality, queries, secrets, tokens

ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def known_forms(text):
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0]), s[2]))


def secret_texts():
    rng = random.Random(6)
    parts = [
        "password", "PassWD", "api_key", "APIKEY", "secret", "toKen", "Key", "paſsword", '"', "'",
        " ", "  ", ":", "=", "abc", "abcdef", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef" * 3, "0123456789abcdef",
        "é", "\n", "x.y-z_1/2+3", "🔑", "Zq8Rk2Lw9Xv4Tb7Np1Mc6",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(400)]
    sums = "\n".join(hashlib.sha1(str(i).encode()).hexdigest() + f"  f{i}.txt" for i in range(3000))
    return [None, "", *texts, texts[3], sums]


def test_known_forms_are_those_of_the_patterns(spark, monkeypatch):
    texts = secret_texts()
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, n_hex long"
    ).repartition(3)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    rows = {r.doc_id: r for r in queries.op2_secrets(spark, "").collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        base = known_forms(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = rows[i]
        counts = [sum(s[0] == kind for s in base) for kind in ("assign", "access", "hex")]
        assert [row.n_assign, row.n_access, row.n_hex] == counts, text
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        spans = row.spans.split(",") if row.spans else []
        assert set(listed.split(",")) - {""} <= set(spans)
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
    assert any("random" in r.spans for r in rows.values())


def test_no_secrets_in_an_empty_table(spark):
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# --- near duplicates ---------------------------------------------------------


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def plain_classes(rows):
    """Rows of one doc_id are one document, which links with what any of its texts links with."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return sorted(
        ((i, len(s), None if i is None else (top(i) if s else i)) for i, s in sets), key=repr
    )


def test_texts_that_share_an_id_keep_their_links(spark):
    rng = random.Random(12)
    prose = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]

    def near(ws):
        out = list(ws)
        out[len(out) // 2] = "other"
        return " ".join(out)

    a, b, c, d = prose(80), prose(80), prose(90), prose(70)
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, near(a)), (8, near(b)), (9, " ".join(c)), (3, near(c))]
    rows += [(3, " ".join(d)), (12, near(d)), (12, near(d)), (None, " ".join(a)), (20, None), (21, ""), (20, near(b))]
    rows += [(30, " ".join(prose(60))), (31, "few words"), (32, "Few  words"), (40, " ".join(prose(30_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, jaccard.classes(docs).collect()), key=repr)
    assert got == plain_classes(rows)


# --- tokens and quality ------------------------------------------------------


def test_pieces_are_those_of_the_pattern():
    import regex

    sure = [chr(c) for c in range(0x250) if not tokens._UNSURE.match(chr(c))]
    rng = random.Random(2)
    for pattern in (tokens.PATTERN, tokens.WORD_PATTERN):
        expected, spelled = regex.compile(pattern), tokens._spelled(pattern)
        for _ in range(2000):
            text = "".join(rng.choices(sure + [" ", "'", "s", "\n", "1"] * 40, k=rng.randint(0, 40)))
            for form in (text, text.lower()):
                assert spelled.findall(form) == expected.findall(form)


def test_quality_uses_every_unlabelled_row(spark):
    """The steps of the features, the shares and the risk follow rows beyond any sample."""
    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(200)]
    good = [" ".join(rng.choice(words, 60)) + "." for _ in range(300)]
    bad = ["!!! " * int(n) for n in rng.integers(5, 40, 900)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i in range(150)] + [(400, 0)], "doc_id long, quality int")
    everywhere = F.lit(True)
    model = quality.fit(docs, labels, everywhere, most=150)
    assert 0.17 < model.prior < 0.35  # a quarter, though the sample has 150 rows
    rows = quality.score(docs, model).toPandas().set_index("doc_id").sort_index()
    assert rows.score[:300].mean() > 0.7 and rows.score[300:].mean() < 0.1
    again = quality.fit(docs.repartition(7), labels, everywhere, most=150)
    assert np.allclose(again.weights, model.weights, atol=1e-6)
    copies = docs.unionAll(docs.where("doc_id >= 300")).unionAll(docs.where("doc_id >= 300"))
    assert quality.fit(copies, labels, everywhere, most=150).prior < 0.7 * model.prior


def test_quality_without_documents_or_positives(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    assert [r.score for r in quality.score(docs, model).collect()] == [0.5, 0.5]
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels, F.lit(True))).collect() == []


def test_encoder_keeps_the_first_pieces_and_little_else():
    """A process that meets ever new words forgets those, not the ones it meets all the time."""
    rng = random.Random(8)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        encoder = tokens.Encoder(tokens.path(name), most=200)
        common = [f"of the {word}," for word in ("house", "street", "größe")]
        kept = []
        whole = encoder.tokenizer
        for _ in range(30):
            new = "".join(rng.choices("abcdefghij", k=9))
            texts = [*common, *(f"x {new}{i} \n\n y" for i in range(20)), new * 3]
            for text, ids in zip(texts, encoder.encode(texts), strict=True):
                expected = whole.encode(text, add_special_tokens=False).ids
                assert np.frombuffer(ids, encoder.dtype).tolist() == expected
            kept.append(" street" in encoder.known or "street" in encoder.known)
            assert len(encoder.known) <= 200 + 100
        assert all(kept)
    few = tokens.Encoder(tokens.path("byte_bpe_50k.json"), chars=100)
    for i in range(20):
        few.encode([f"{i}a" * 30])
        assert few.held <= 100 + 30 * 3
    assert tokens.MOST <= 500_000  # three workers of an executor hold as many each


def test_a_task_sums_up_the_phrases_it_can_hold(monkeypatch):
    """Phrases of three words that come again and again leave a task as one row each."""
    monkeypatch.setattr(phrases, "PENDING", 100)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 50)

    class Level:
        def __init__(self, size):  # no unit has a rank, any may be frequent
            bits = np.full(1 << (phrases.BITS - 6), ~np.uint64(0))
            self.value = phrases.Units(np.empty((0, size), np.uint64), np.empty(0, np.uint64), bits)

    texts = [f"a{i} b{i} c{i}" for i in range(80)] * 5
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["en"] * len(texts)})
    rows = list(phrases._count_pairs([Level(1), Level(2)], 0)(iter([batch])))
    assert sum(r.num_rows for r in rows) == 80
    assert [n for r in rows for n in r.column("n").to_pylist()] == [5] * 80
