import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from crowdpulse.llm import simhash
from crowdpulse.llm.simhash import fingerprint, fingerprint_links, simhash_components, simhash_dedup


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def plain_components(fps):
    """Smallest index reachable over links of at most 3 bits."""
    n = len(fps)
    links = [(i, j) for i in range(n) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    return classes(range(n), links)


def test_fingerprints_of_all_kinds_of_texts(spark, small):
    texts = [r[0] for r in spark.read.parquet(f"{small}/documents.parquet").select("text").limit(40).collect()]
    texts += [None, "", " \t\n", "One", "two words", "Three big words", "a\x0bb\x1cc d", "é É   x y", "w " * 200_000]
    for text in texts:
        assert fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def near(rng, base, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_links_against_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    fps = []
    for _ in range(40):
        base = rng.getrandbits(64)
        fps += [base] + [near(rng, base, k) for k in (1, 2, 3, 4, 5, 6)]
    crowd = rng.getrandbits(64)
    fps += [near(rng, crowd, rng.randrange(4)) for _ in range(300)]  # one key with very many
    fps = sorted(set(fps))
    expected = plain_components(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame(list(enumerate(signed)), "node long, fp long").repartition(3)
    for part in (4096, 16):  # whole keys, and keys cut into tiles
        monkeypatch.setattr(simhash, "PART", part)
        links = [tuple(r) for r in fingerprint_links(df).collect()]
        assert classes(range(len(fps)), links) == expected


def test_components_of_documents(crowd):
    text = "the quick brown fox jumps over the lazy dog and runs far away " * 20
    rows = [(5, text), (3, text), (9, text), (7, None), (8, ""), (4, " "), (None, text), (3, text), (1, "other words entirely here"), (None, "alone and nameless text")]
    got = simhash_components(crowd(rows, "doc_id long, text string")).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(5, 3), (3, 3), (9, 3), (7, 4), (8, 4), (4, 4), (None, 3), (3, 3), (1, 1), (None, None)], key=repr
    )


def test_one_row_of_each_group_stays(crowd):
    text = "some words that many pages share among them all " * 30
    other = "different words stand in this text"
    df = crowd([(2, text), (6, text), (4, other), (None, text)], "doc_id long, text string")
    out = simhash_dedup(df)
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 4] and out.columns == df.columns
    # Decided by row: null and repeated ids neither all stay nor save a row of another group.
    odd = [(None, text), (None, text), (7, other), (7, other), (7, "a third text of its own"), (None, None), (None, ""), (9, " \n")]
    got = sorted((tuple(r) for r in simhash_dedup(crowd(odd, "doc_id long, text string")).select("doc_id", "text").collect()), key=repr)
    assert got == sorted([(None, text), (7, other), (7, "a third text of its own"), (9, " \n")], key=repr)
    nameless = crowd([(None, None), (None, ""), (None, "")], "doc_id long, text string")
    assert simhash_dedup(nameless).count() == 1
    assert simhash_dedup(crowd([], "doc_id long, text string")).collect() == []


def test_empty_table(crowd):
    assert simhash_components(crowd([], "doc_id long, text string")).collect() == []


def test_whole_small_table(spark, small):
    from crowdpulse.llm.queries import QUERIES

    docs = sorted(tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    fps = [plain_fingerprint(t) for _, t in docs]
    component = plain_components(fps)
    expected = [(d, f"{fp:016x}", docs[component[i]][0]) for i, ((d, _), fp) in enumerate(zip(docs, fps))]
    got = QUERIES["op2_simhash_near_dedup"](spark, small).select("doc_id", "fingerprint", "component_id").orderBy("doc_id")
    assert [tuple(r) for r in got.collect()] == expected


def test_no_pairs_of_copies_are_made(spark):
    # 3000 copies are one fingerprint: there is nothing to link.
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same text for all of them").alias("text"))
    out = simhash_components(df)
    assert out.filter("component_id <> 0").count() == 0 and out.count() == 3000
