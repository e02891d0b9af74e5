"""Each operator against a plain version on small tables with awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivulet.llm import (
    contamination,
    counts,
    huffman,
    jaccard,
    neighbours,
    packing,
    quality,
    repeats,
    secrets,
    tokenfile,
    tokens,
    toxicity,
    words,
)
from rivulet.session import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, n_words string, signature long, text2 string"


def corpus():
    """Texts with copies, near copies, shared passages, odd characters and nothing."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage = prose(30)
    texts = [None, "", "  \n ", "one", "One two", "a b c d", "A b c d", "中文 текст İ x"]
    for _ in range(12):
        body = prose(rng.randint(10, 120))
        texts += [body, f"{body[:40]} {passage}\n{body[40:]}"]
    base = prose(100).split()
    for k in range(12):  # near copies: some words of each are other ones
        copy = list(base)
        for _ in range(k % 4):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [texts[10], texts[10].upper(), " ".join(["again"] * 60), prose(3000)]
    return texts


TEXTS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", -1, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(docs):
    return docs.where("doc_id < 0")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- words -------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["alphanumeric", "blank"])
def test_words_are_those_of_the_pattern(kind):
    import pyarrow as pa

    if kind == "alphanumeric":
        alphabet = words.alphanumeric()
        pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    else:
        alphabet = words.blank_separated(fold=True)
        pattern = re.compile(r"[^\x20\x09-\x0D]+")
    split = words.split(pa.array(TEXTS), alphabet)
    hashes = split.hashes(alphabet)
    known = {}
    for d, text in enumerate(TEXTS):
        expected = pattern.findall((text or "").translate(LOWER))
        got = range(split.first[d], split.first[d + 1])
        assert len(expected) == len(got)
        for word, i in zip(expected, got, strict=True):
            assert known.setdefault(word, hashes[i]) == hashes[i]
    assert len(set(known.values())) == len(known)


def test_long_words_are_hashed_by_piece(monkeypatch):
    import pyarrow as pa

    alphabet = words.alphanumeric()
    text = pa.array(["x" * 1000 + " y", "x" * 999 + " y", "x" * 1000])
    whole = words.split(text, alphabet).hashes(alphabet)
    monkeypatch.setattr(words, "PIECE_BYTES", 64)
    split = words.split(text, alphabet)
    pieces = split.hashes(alphabet)
    assert pieces[0] == pieces[4] != pieces[2] and pieces[1] == pieces[3] == whole[1]


# --- 1 -----------------------------------------------------------------------

ITEMS = [
    (1, " ".join(TEXTS[8].split()[:14])),
    (22, TEXTS[3]),
    (3, "not in there at all, by no means, ever or never again"),
    (4, None),
    (5, ""),
    (22, "One two"),
]


@pytest.mark.parametrize("block_words", [contamination.BLOCK_WORDS, 1])
def test_contamination(spark, docs, block_words):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: pattern.findall((t or "").translate(LOWER))
    found = by_id(contamination.find_matches(docs, benchmark, block_words=block_words))
    kept = by_id(contamination.decontaminate(docs, benchmark, block_words=block_words))
    for i, text in enumerate(TEXTS):
        mine, hit, items = split(text), set(), set()
        for item, other in ITEMS:
            theirs = split(other)
            n = min(10, len(theirs))
            windows = {tuple(theirs[k : k + n]) for k in range(len(theirs) - n + 1)} if n else set()
            for k in range(len(mine) - n + 1):
                if tuple(mine[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    items.add(item)
        row = found[i]
        assert (row.n_words, row.n_hit, set(row["items"])) == (len(mine), len(hit), items)
        assert sum(s.end - s.start for s in row.spans) == len(hit)
        assert (i in kept) == (not hit)
    assert set(next(iter(kept.values())).asDict()) == set(docs.columns)


def test_contamination_longest_match(spark, docs):
    benchmark = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    (match,) = by_id(contamination.find_matches(docs, benchmark))[8].matches
    assert (match.item_id, match.item_word, match.doc_word, match.length) == (1, 0, 0, 14)


def test_contamination_short_items_beside_a_long_one(spark):
    """Of the long item only the first words occur; short items are checked all the same."""
    tops, alike = {}, None
    for word in (f"w{i}" for i in range(5000)):  # two words with the same 16 bits
        top = int(words.split(pa.array([word]), words.alphanumeric()).hashes(words.alphanumeric())[0] >> 48)
        if top in tops:
            alike = tops[top], word
            break
        tops[top] = word
    items = [(1, "p q"), (2, "u v w a b c d e f g"), (3, alike[0]), (4, "s t")]
    texts = ["x p", "q u v z", f"y {alike[1]} y", "u v s t", "p q", f"{alike[0]}"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = by_id(contamination.find_matches(rows, benchmark))
    assert {i: (r.n_hit, r["items"]) for i, r in found.items()} == {
        0: (0, []), 1: (0, []), 2: (0, []), 3: (2, [4]), 4: (2, [1]), 5: (1, [3])
    }
    assert set(by_id(contamination.decontaminate(rows, benchmark))) == {0, 1, 2}


# --- 2 -----------------------------------------------------------------------


def test_secrets(spark):
    key = "AKIA" + "Z7" * 10
    texts = [
        None,
        "",
        f"é password: 'abcdef123' {key} end",
        "secret: token: abcdefg",
        "hex " + "0123456789abcdef" * 2,
        "Zk9qX2vB7mWp4RtY8sLd and thethethethethethe and 550e8400-e29b-41d4-a716-446655440000",
        "1234567890123456789012",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(secrets.scan(rows))
    kinds = {i: [s.kind for s in r.spans] for i, r in found.items()}
    assert kinds == {0: [], 1: [], 2: ["assign", "access"], 3: [], 4: ["hex"], 5: ["random"], 6: []}
    assert [(s.start, s.end) for s in found[2].base] == [(2, 22), (24, 24 + len(key))]
    masked = by_id(secrets.redact(rows))
    assert masked[0].text is None and masked[1].text == ""
    assert masked[2].text == "é [SECRET]' [SECRET] end"
    assert masked[5].text.startswith("[SECRET] and the")


def test_secrets_beside_known_forms(spark):
    access, hexes = "AKIA" + "Z7" * 8, "0123456789abcdef" * 2
    key = "wJalrXUtnFEMI/K7MDENG+bPxRfiCYzq9TkLm3Vd"
    texts = [
        f"{access}/{key}",
        f"{hexes}_{key} and {key}-{hexes}",
        f"{key}/{access}/{key[::-1]}==",
        f"{access}/documentation/introduction",
        f"sha-{hexes}==",
        f"my_api_key={key}",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    masked = {i: r.text for i, r in by_id(secrets.redact(rows)).items()}
    one = "[SECRET]"
    assert masked == {
        0: one * 2, 1: f"{one * 2} and {one * 2}", 2: one * 3, 3: f"{one}/documentation/introduction",
        4: f"sha-{one}==", 5: f"my_{one}",
    }
    spans = {i: [(s.kind, s.start, s.end) for s in r.spans] for i, r in by_id(secrets.scan(rows)).items()}
    assert spans[0] == [("access", 0, 20), ("random", 20, 61)]


def test_secrets_of_letters_only():
    scanner = secrets.Scanner(tokens.path("byte_bpe_50k.tiktoken"))
    kinds = lambda text: [kind for kind, _, _ in scanner.spans(text)[1]]
    for key in ("qZxWvKpLmRtYbNcDfGhJ", "KRSXGZBAMFZGKZLDOJSXQYLT", "vQpX/kLm+ZrTyWbNcGhJdSfE", "xkqzjvwpfhgtrbmcnd"):
        assert kinds(f"the key {key} is") == ["random"], key
    rng = random.Random(3)
    for letters in ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        found = [kinds("".join(rng.choices(letters, k=24))) for _ in range(500)]
        assert sum(kind == ["random"] for kind in found) >= 490
    ordinary = """
        internationalization antidisestablishmentarianism electroencephalograph RESPONSIBILITIES
        pneumonoultramicroscopicsilicovolcanoconiosis Geschwindigkeitsbegrenzung MISUNDERSTANDINGS
        Donaudampfschifffahrtsgesellschaft onafhankelijkheidsverklaring state-of-the-art-technology
        getElementsByClassName src/main/java/com/example/Application MAX_CONNECTION_TIMEOUT_SECONDS
        thethethethethethe ---------------- aaaaaaaaaaaaaaaaaaaa
    """
    assert kinds(ordinary) == []


# --- 3, 4, 6 -----------------------------------------------------------------


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_library(name):
    encoder = tokens.Encoder(tokens.path(name))
    library = Tokenizer.from_file(tokens.path(name))
    rng = random.Random(1)
    odd = "aB'stre ll 09 \n\t  éßµ²ª.!_-\x85\x1cİ中\U0001f600\x0bͅ"
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 25))) for _ in range(500)]
    texts += [f"{chr(c)} a{chr(c)}1{chr(c)}{chr(c)} x" for c in range(0x250)]
    texts += [t or "" for t in TEXTS] + ["a <|endoftext|> b", "'s " * 30]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, encoder.dtype).tolist() == expected, text


@pytest.mark.parametrize("scale", [{}, {"huge": 50, "chunk": 20, "overlap": 1}])
def test_token_counts(docs, scale):
    library = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    found = by_id(counts.count(docs, **scale))
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (found[i].n_tokens, found[i].n_bytes) == (len(ids), len((text or "").encode()))
    assert counts.count(empty(docs)).count() == 0


def test_huffman_round_trip():
    rng = np.random.default_rng(2)
    for n, limit in ((1, 20), (2, 20), (300, 9), (300, 20), (5000, 20)):
        ids = (rng.pareto(1, 4000) * 3).astype(int) % n
        times = np.bincount(ids, minlength=n + 3)
        sizes = huffman.lengths(times, limit)
        assert sizes.max() <= limit and ((sizes > 0) == (times > 0)).all()
        assert (0.5 ** sizes[sizes > 0].astype(float)).sum() <= 1
        stream, offsets = huffman.pack(ids, sizes, huffman.codes(sizes), 256)
        back = huffman.Decoder(sizes).unpack(stream, offsets, len(ids), 256)
        assert (back == ids).all()
    with pytest.raises(ValueError):
        huffman.lengths(np.ones(600), 9)


def test_token_file(spark, docs):
    library = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    path = scratch_path(spark, "file")
    tokenfile.write(docs, path, block=500)
    found, start = by_id(tokenfile.read(spark, path)), 0
    for i, text in enumerate(TEXTS):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (found[i].start, found[i].n_tokens, found[i].ids) == (start, len(ids), ids)
        start += len(ids)
    path = scratch_path(spark, "file")
    tokenfile.write(empty(docs), path)
    assert tokenfile.read(spark, path).count() == 0


@pytest.mark.parametrize("capacity", [2048, 16])
def test_packing(docs, capacity):
    library = Tokenizer.from_file(tokens.path("word_bpe_49k.json"))
    rows = packing.pack(docs, capacity=capacity).collect()
    expected, rooms = {}, []
    for i, text in enumerate(TEXTS):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            expected[i, k] = (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    for length in sorted((x[1] for x in expected.values()), reverse=True):  # plain best fit
        fits = [r for r in rooms if r >= length]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - length)
    assert len(sequences) == len(rooms)
    assert packing.pack(empty(docs)).count() == 0


# --- 5 -----------------------------------------------------------------------


def test_repeats(spark, docs):
    pattern, seen, expected = re.compile(r"[^\x20\x09-\x0D]+"), set(), {}
    for i, text in enumerate(TEXTS):
        mine, gone = pattern.findall(text or ""), set()
        for k in range(len(mine) - 19):
            window = tuple(mine[k : k + 20])
            if window in seen:
                gone |= set(range(k, k + 20))
            seen.add(window)
        kept = " ".join(w for k, w in enumerate(mine) if k not in gone)
        expected[i] = (len(mine), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    found = by_id(repeats.deduplicate(docs))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in found.items()} == expected
    assert any(r.factors for r in found.values())
    assert repeats.deduplicate(empty(docs)).count() == 0
    long = " ".join(f"w{k}" for k in range(30))
    odd = spark.createDataFrame([(None, long), (7, long), (7, long + " x"), (7, None)], "doc_id long, text string")
    removed = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in repeats.deduplicate(odd).collect())
    assert removed == [(0, 30, 0), (7, 0, 0), (7, 30, 30), (7, 31, 30)] or removed == [
        (0, 30, 0), (7, 0, 0), (7, 30, 30), (7, 31, 30),
    ]


# --- 7 -----------------------------------------------------------------------


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=40).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(400, None), (401, [float("nan")] * 40), (402, [None] * 40), (403, [1.0]), (None, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = neighbours.top_k(table, F.col("vec_id") % 20 == 0, wave=7, block=50, step=8, tile=4)
    got = collections.defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    whole = {i: np.floor(64 * np.array(v)) for i, v in rows[:330]}
    for q in range(0, 330, 20):
        scores = sorted((-int(v @ whole[q]), i) for i, v in whole.items() if i != q)
        assert got[q] == [(i, -s) for s, i in scores[:20]]
    assert set(got) == set(range(0, 330, 20))
    assert neighbours.top_k(table.where("vec_id < 0"), F.lit(True)).count() == 0


# --- 8 -----------------------------------------------------------------------


def plain_classes(texts):
    pattern, sets = re.compile(r"[^\x20\x09-\x0D]+"), []
    for text in texts:
        w = pattern.findall((text or "").translate(LOWER))
        grams = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        sets.append(grams or ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return {i: (len(s), x) for i, (s, x) in enumerate(zip(sets, label, strict=True))}


@pytest.mark.parametrize("often", [None, 1, 2])
def test_near_duplicates(docs, monkeypatch, often):
    if often:  # all shingles frequent, or every other bucket
        mask = np.arange(jaccard.SKETCH) % often == 0
        monkeypatch.setattr(jaccard, "frequent", lambda *a: mask)
    found = by_id(jaccard.classes(docs))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == plain_classes(TEXTS)
    if not often:
        kept = {r.doc_id for r in jaccard.one_of_each(docs).collect()}
        assert kept == {i for i, r in found.items() if r.component_id == i}
        assert jaccard.classes(empty(docs)).count() == 0


# --- 9, 10 -------------------------------------------------------------------


def test_toxicity(spark):
    rng = random.Random(8)
    plain = [f"word{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(300):
        text = rng.choices(plain, k=40)
        if i % 4 == 0:
            text[rng.randrange(40)] = rng.choice(["vileone", "viletwo"])
            text[rng.randrange(40)] = "nasty"
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (None, "nasty vileone vileone"), (902, "so vilethree nasty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    chain = toxicity.fit(docs, named)
    found = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    assert all((found[i].toxic >= 0.5) == bool(t) for i, t in labels)
    assert found[900].toxic < 0.5 and found[901].toxic < 0.5 and found[902].toxic >= 0.5
    kept = toxicity.clean(docs, chain)
    assert kept.where("doc_id is null").count() == 0 and kept.count() == 300 - 75 + 2
    nothing = toxicity.fit(docs, named.where("doc_id < 0"))
    assert toxicity.clean(docs, nothing).count() == len(rows)


def test_quality(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        text = [f"{rng.choice('abcdefg')}{k % 9}" if good else "BUY!!" for k in range(50)]
        rows.append((i, " ".join(text)))
        labels.append((i, int(good)))
    rows += [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(docs, named, F.col("doc_id") % 5 != 0)
    found = {r.doc_id: r for r in quality.score(docs, model).collect()}
    held = [(i, g) for i, g in labels if i % 5 == 0]
    assert sum(found[i].predicted == g for i, g in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values()) and len(found) == 402
