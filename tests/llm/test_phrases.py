import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import phrases
from crowdpulse.llm.phrases import Numbers, added_up, collocations, compact_paths, edges_of, phrase_counts

SCHEMA = "doc_id long, text string, lang string"


def plain_counts(rows, order=3):
    """(lang, words) -> count, () for all words."""
    out = Counter()
    for _, text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            out[lang or "und", ()] += len(words)
            for m in range(1, order + 1):
                for i in range(len(words) - m + 1):
                    out[lang or "und", tuple(words[i : i + m])] += 1
    return out


def plain(rows, order=3, least=10, absorbed=50, top=2000):
    f = plain_counts(rows, order)
    candidates = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= least}
    out = []
    for (lang, w), a in candidates.items():
        longer = [n for (other, v), n in candidates.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if any(100 * n >= absorbed * a for n in longer):
            continue
        score, k = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], f[lang, ()]))
    out.sort()
    rank, found = Counter(), []
    for lang, score, a, phrase, l, r, n in out:
        rank[lang] += 1
        if rank[lang] <= top:
            found.append((lang, rank[lang], phrase.decode(), -a, l, r, n, -score))
    return found


def texts(seed, n=120):
    rng = random.Random(seed)
    common = ["the", "of", "New", "york", "é", "Äther", "x\x1cy", "don't", "9"]
    sayings = ["once upon a time there lived", "the end of the story", "New York City hall", "a b a b a b a"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice(sayings) if rng.random() < 0.4 else " ".join(rng.choice(common) for _ in range(rng.randrange(6))))
            parts.append(rng.choice([" ", "\t", ". ", ",", "\n", "\r\n", "; ", "  ", "\x0b", " \x0c"]))
        rows.append((i, "".join(parts), rng.choice(["en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("block,slices", [(8 << 20, 8 << 20), (50, 40)])
def test_against_plain_code(crowd, monkeypatch, block, slices):
    # Functions that run in workers carry the module's values along.
    monkeypatch.setattr(phrases, "BLOCK", block)
    monkeypatch.setattr(phrases, "CHUNK", min(block, 1 << 20))
    monkeypatch.setattr(phrases, "SLICE", slices)
    rows = texts(1) + [(900, None, "en"), (901, "", None), (902, "...", "fr"), (None, "new york", "en"), (900, "new york", "en"),
                       (903, "word " * 20_000, "long"), (904, " ".join(f"u{i}" for i in range(5000)), "long")]
    df = crowd(rows, SCHEMA)
    counted = {(r["lang"], tuple(r["words"])): r["n"] for r in phrase_counts(df, least=3).collect()}
    assert counted == {k: n for k, n in plain_counts(rows).items() if (n >= 3 if k[1] else n)}
    assert [tuple(r) for r in collocations(df).orderBy("lang", "rank").collect()] == plain(rows)


@pytest.mark.parametrize("order,least,top", [(2, 2, 5), (4, 5, 2000)])
def test_other_orders(crowd, order, least, top):
    rows = texts(2, 60)
    got = collocations(crowd(rows, SCHEMA), order, least, 60, top).orderBy("lang", "rank").collect()
    assert [tuple(r) for r in got] == plain(rows, order, least, 60, top)


def test_unary_paths(crowd):
    # One passage wherever its words occur, one word that leads to several, one that ends pieces.
    rows = [(i, "alpha beta gamma delta epsilon zeta. big red house, big red barn, big red", "en") for i in range(12)]
    df = crowd(rows, SCHEMA)
    paths = {" ".join(r["words"]): r["n"] for r in compact_paths(phrase_counts(df), 3).collect()}
    assert paths == {"alpha beta gamma delta epsilon zeta": 12, "big red house": 12, "big red barn": 12}


def test_edges_of_words():
    numbers = Numbers()
    found = np.concatenate([numbers.read([b"A b\tc.d"]), numbers.read([b"e f"])])
    words = numbers.words()
    assert words[1:] == [b"a", b"b", b"c", b"d", b"e", b"f"]
    assert [[words[i] for i in edge] for edge in zip(*edges_of(found, 3))] == [
        [b"a", b"b", b"c"], [b"b", b"c", b""], [b"c", b"", b""], [b"d", b"", b""], [b"e", b"f", b""], [b"f", b"", b""]
    ]


def test_sums_of_rows_beyond_64_bits():
    rng = np.random.default_rng(1)
    size = 1 << 40
    columns = list(rng.choice(rng.integers(0, size, 5), (4, 1000)))
    weights = rng.integers(1, 9, 1000)
    got, sums = added_up(columns, size, weights)
    expected = Counter()
    for row, w in zip(zip(*map(list, columns)), weights.tolist()):
        expected[tuple(map(int, row))] += w
    assert dict(zip(zip(*(c.tolist() for c in got)), sums.tolist())) == dict(expected)


def test_scores_beyond_64_bits(spark):
    # 1000000 * a * a alone passes 64 bits; the division must be exact and rounded down.
    a = F.lit(3_000_000_007).cast("decimal(38,0)")
    q = F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(38,0)"), a * F.lit(3_000_000_008).cast("decimal(38,0)")).cast("long")
    assert spark.range(1).select(q.alias("q")).first()["q"] == 1_000_000 * 3_000_000_007**2 // (3_000_000_007 * 3_000_000_008)


def test_empty_tables_and_bytes_that_are_no_text(crowd):
    assert collocations(crowd([], SCHEMA)).collect() == []
    assert collocations(crowd([(1, None, None)], SCHEMA)).collect() == []
    df = crowd([(i, "some words here", "en") for i in range(12)], SCHEMA).withColumn("text", F.expr("cast(concat(x'ff20', cast(text as binary)) as string)"))
    assert [r["a"] for r in collocations(df).collect()] == [12, 12]  # a word of one byte, then three
    with pytest.raises(ValueError):
        phrase_counts(df, 1)
