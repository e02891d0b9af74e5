"""Phrases, URL rules and hard negatives against plain versions on small awkward tables."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import negatives, phrases, urlrules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- phrases -----------------------------------------------------------------


def plain_phrases(rows, least, longest=4, cover=80, top=2000):
    counts, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for m in range(1, longest + 1):
                for i in range(len(ws) - m + 1):
                    counts[lang, tuple(ws[i : i + m])] += 1
    found = collections.defaultdict(list)
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, longer), a in candidates.items():
        for m in range(2, len(longer)):
            for i in range(len(longer) - m + 1):
                inner = lang, longer[i : i + m]
                if 100 * a >= cover * candidates[inner]:
                    covered.add(inner)
    for (lang, ws), a in candidates.items():
        if (lang, ws) in covered:
            continue
        cuts = []
        for k in range(1, len(ws)):
            left, right = counts[lang, ws[:k]], counts[lang, ws[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(ws).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def phrase_rows():
    rng = random.Random(3)
    vocabulary = ["the", "The", "of", "a", "é", "É", "中", "x-y", "n\u00a0b", "q"]
    rows = [(None, "en"), ("", "en"), (" \t ", None), ("one", None), ("a b c d", "empty")]
    for lang in ("en", None, "und", "fr"):
        for _ in range(40):
            ws = rng.choices(vocabulary, weights=range(10, 0, -1), k=rng.randint(1, 30))
            rows.append(("".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"]) for w in ws), lang))
    rows += [("Same row here, same row here", "en")] * 9
    rows.append((" ".join(rng.choices(vocabulary, k=20_000)), "long"))
    return rows


@pytest.mark.parametrize("least, top", [(3, 2000), (8, 7)])
def test_phrases_are_those_of_plain_counting(spark, least, top):
    rows = phrase_rows()
    docs = spark.createDataFrame(
        [(None if i % 9 else i, t, g, "w", 7) for i, (t, g) in enumerate(rows)],
        "doc_id long, text string, lang string, word string, n long",
    ).repartition(5)
    got = sorted(map(tuple, phrases.mine(docs, least=least, top=top).collect()))
    assert got == plain_phrases(rows, least, top=top)


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert phrases.mine(docs).collect() == []


@pytest.mark.parametrize("head, tile, dense, filled", [(0, 4, 2, 1), (7, 2, 3, 1), (40, 8, 99, 9), (50, 64, 1, 1)])
def test_tiles_count_like_a_counter(head, tile, dense, filled):
    rng = np.random.default_rng(head)
    ids = np.sort(rng.integers(0, 1 << 63, 50).astype(np.uint64))
    units = phrases.Units(ids[:head, None], ids[:head], np.zeros(1, np.uint64))
    tiles, expected = phrases.Tiles(units, 1, tile, dense, filled), collections.Counter()
    for _ in range(4):
        a, b = (ids[np.minimum(rng.geometric(0.1, 500), 50) - 1] for _ in range(2))
        tiles.add(units.ranks(a, [a]), units.ranks(b, [b]), [a, b])
        expected.update(zip(a.tolist(), b.tolist()))
        tiles.compress()
    got = collections.Counter()
    for batch in [*tiles.sparse_rows(), *tiles.dense_rows()]:
        columns = [batch.column(c).to_numpy().view(np.uint64).tolist() for c in ("w1", "w2")]
        for left, right, n in zip(*columns, batch.column("n").to_pylist()):
            got[left, right] += n
    assert got == expected
    assert (len(tiles.dense) > 0) == (head > 0)


# --- url rules ---------------------------------------------------------------


def plain_parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return rest, host.translate(LOWER), re.match(r"[^/?#]*([^?#]*)", rest)[1]


def plain_tokens(url):
    rest, host, path = plain_parts(url)
    fold = lambda x: re.sub("[0-9]+", "#", x.translate(LOWER))
    labels = fold(host).split(".")
    steps = [x for x in fold(path).split("/") if x]
    page = steps[-1] if steps else ""
    stem, _, extension = page.rpartition(".") if "." in page else (page, "", "")
    asked = re.match(r"[^?#]*[?]([^#]*)", rest)
    keys = {x.split("=")[0] for x in fold(asked[1] if asked else "").split("&")}
    pairs = [("name:", x) for label in labels[:-1] for x in label.split("-")]
    pairs += [("top:", labels[-1]), ("dir:", steps[0] if len(steps) > 1 else "")]
    pairs += [("mid:", "/".join(steps[1:-1])), ("page:", stem), ("ext:", extension)]
    pairs += [("query:", "&".join(sorted(keys)))]
    if rest:
        pairs.append(("scheme:", fold(url.split("://")[0])))
    found = {a + b for a, b in pairs if b}
    return found | ({"fragment"} if "#" in rest else set())


def plain_listed(url):
    _, host, path = plain_parts(url)
    fits = [
        (len(name + start), name + start, said)
        for said, name, start in urlrules.LISTED
        if (host == name or host.endswith("." + name)) and path.startswith(start)
    ]
    return max(fits)[1:] if fits else (None, None)


def plain_judge(urls, support, confidence, longest):
    labelled = [(plain_tokens(u), plain_listed(u)[1]) for u in urls if plain_listed(u)[1]]
    alone, together = collections.Counter(), collections.Counter()
    for tokens, said in labelled:
        for size in range(1, longest + 1):
            for items in itertools.combinations(sorted(tokens), size):
                alone[items] += 1
                together[items, said] += 1
    sure = {
        (items, said): n / alone[items]
        for (items, said), n in together.items()
        if n >= math.ceil(support * len(labelled)) and 100 * n >= confidence * alone[items]
    }
    rules = [
        (-c, -together[items, said], len(items), " ".join(items), said)
        for (items, said), c in sure.items()
        if not any(
            sure.get((part, said), 0) >= c
            for size in range(1, len(items))
            for part in itertools.combinations(items, size)
        )
    ]
    out = []
    for url in urls:
        _, host, path = plain_parts(url)
        rule, said = plain_listed(url)
        tokens = plain_tokens(url)
        best = min((r for r in rules if set(r[3].split(" ")) <= tokens), default=None)
        if said or best is None:
            out.append((host, path, rule, said or "allow", None))
        else:
            out.append((host, path, rule, best[4], best[3]))
    return out


def url_rows():
    rng = random.Random(8)
    urls = [None, "", "no scheme", "://", "http://", "http://com", "HTTP://COM/", "a://b://c/d"]
    urls += ["http://x.example.com/en/1#a?b=1", "http://WWW.Example.com/en/", "http://example.com?x=/en/"]
    urls += ["http://notexample.com/en/2", "https://a.b-c.net/fr/", "https://net/es/é", "x://q.net/fr"]
    for _ in range(300):
        host = rng.choice(["", "www.", "m.", "blog."]) + rng.choice(["a-b", "pills7", "x1"])
        top = rng.choice(["example.com", "example.net", "example.org", "com", "org"])
        path = rng.choice(["/en/", "/es/", "/fr/", "/de/x/y/", "/"]) + rng.choice(["", "12", "12.html", "p.x.htm"])
        urls.append(f"{rng.choice(['http', 'HTTPS'])}://{host}.{top}{path}" + rng.choice(["", "#t", "?b=1&a=2", "?q"]))
    return urls + urls[-20:]


@pytest.mark.parametrize("support, confidence, longest", [(0.01, 90, 3), (0.05, 60, 2)])
def test_urls_are_judged_as_by_plain_mining(spark, support, confidence, longest):
    urls = url_rows()
    pages = spark.createDataFrame(
        [(i if i % 5 else None, u, "x", "y") for i, u in enumerate(urls)],
        "page_id long, url string, tokens string, verdict string",
    ).repartition(3)
    got = urlrules.judge(pages, support=support, confidence=confidence, longest=longest)
    rows = [tuple(r) for r in got.collect()]
    expected = [
        (i if i % 5 else None, *row)
        for i, row in enumerate(plain_judge(urls, support, confidence, longest))
    ]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    assert sum(r[5] is not None for r in rows) > 20


def test_tokens_of_urls(spark):
    urls = url_rows()
    rows = spark.createDataFrame(list(enumerate(urls)), "i long, url string")
    got = dict(rows.select("i", urlrules.tokens(F.col("url"))).collect())
    assert [set(got[i]) for i in range(len(urls))] == [plain_tokens(u) for u in urls]


def test_urls_without_labels_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    got = sorted(map(tuple, urlrules.judge(pages).collect()))
    assert got == [(1, "a.org", "/x", None, "allow", None), (2, "", "", None, "allow", None)]
    assert urlrules.judge(pages.limit(0)).collect() == []


# --- hard negatives ----------------------------------------------------------


def plain_negatives(rows, anchor, k=5, low=80):
    sound = {
        (i, lab, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, lab, v in rows
        if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for own, label, q in sound:
        if not anchor(own):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, v)), i, lab)
            for i, lab, v in sound
            if i != own and len(v) == len(q)
        )
        for positive, name, _ in [x for x in scored if x[2] == label][:k]:
            fit = [x for x in scored if x[2] != label and 80 * -positive <= 100 * -x[0] <= 100 * -positive]
            for rank, (score, i, _) in enumerate(fit[:k], 1):
                out.append((own, name, rank, i, -positive, -score))
    return sorted(out)


def vector_rows():
    rng = random.Random(4)
    rows = []
    for i in range(400):
        size = 3 if i % 13 == 0 else 6
        rows.append((i, rng.randrange(3), [rng.choice([-0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(size)]))
    rows += [(400, 1, None), (401, None, [0.5] * 6), (402, 1, []), (403, 1, [float("nan")] * 6)]
    rows += [(404, 1, [None] * 6), (None, 1, [0.5] * 6), (405, 2, [float("inf")] * 6)]
    return rows + rows[:30] + [(10, 2, [1.0] * 6), (10, 2, [0.25] * 6)]


@pytest.mark.parametrize("block, leaf, fanout", [(65_536, 256, 8), (30, 4, 2), (100, 1, 3)])
def test_negatives_are_those_of_brute_force(spark, block, leaf, fanout):
    rows = vector_rows()
    table = spark.createDataFrame(
        [(i, lab, v, 1, 2) for i, lab, v in rows],
        "vec_id long, label int, embedding array<float>, score int, print int",
    ).repartition(4)
    got = negatives.mine(table, F.col("vec_id") % 10 == 0, block=block, leaf=leaf, fanout=fanout)
    expected = plain_negatives(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 100


def test_negatives_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.mine(table, F.col("vec_id") % 10 == 0).collect() == []


def test_forest_holds_each_row_once_inside_its_boxes():
    rng = np.random.default_rng(1)
    rows = rng.integers(-9, 9, (500, 5)).astype(float)
    forest = negatives.Forest(np.arange(500), rng.integers(0, 4, 500), rows, 7, 3)

    def leaves(node):
        if node < forest.leaves:
            return [node]
        return [x for child in range(forest.first[node], forest.last[node]) for x in leaves(child)]

    seen = []
    for root in forest.roots.values():
        seen += leaves(root)
    assert sorted(seen) == list(range(forest.leaves)) and len(forest.roots) == 4
    for node in range(len(forest.first)):
        own = np.concatenate([np.arange(forest.first[x], forest.last[x]) for x in leaves(node)])
        assert (forest.low[node] <= forest.rows[own].min(0)).all()
        assert (forest.high[node] >= forest.rows[own].max(0)).all()
    assert sorted(forest.ids.tolist()) == list(range(500))
