import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crowdpulse.llm.nnls_packing import combinations_filling, pack_by_least_squares, plan_packing, rounded, solve_repeats

SCHEMA = "doc_id long, text string"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_plan(counts, window):
    """The number of cuts, after every piece and sequence of the plan has been gone through."""
    sequences, cover = {}, {}
    for length, first, count, start, stop, each, sequence, offset in plan_packing(dict(counts), window).rows:
        for r in range(count):
            sequences.setdefault(sequence + r // each, []).append((offset + r % each * (stop - start), stop - start))
            cover.setdefault((length, first + r), []).append((start, stop))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window and end & (end - 1) == 0
    cuts = 0
    for length, n in counts.items():
        for r in range(n):
            parts = sorted(cover.pop((length, r)))
            assert [a for a, _ in parts] == [0, *(b for _, b in parts[:-1])] and parts[-1][1] == length
            cuts += len(parts) - 1
    assert not cover
    assert sum(len(p) > 0 for p in sequences.values()) <= sum(k * n for k, n in counts.items()) // window + window.bit_length()
    return cuts


def test_plans_of_random_histograms():
    rng = random.Random(1)
    for _ in range(150):
        check_plan(Counter(rng.randint(1, 16) for _ in range(rng.randrange(60))), 16)


def test_few_cuts_where_lengths_fit():
    assert check_plan(Counter({1024: 5, 512: 10, 600: 7, 424: 7, 300: 4, 700: 3, 24: 3}), 1024) <= 4
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1025, 3000)
    assert check_plan(Counter(lengths.tolist()), 1024) < 0.15 * len(lengths)


def test_odd_histograms():
    assert check_plan(Counter(), 1024) == 0
    assert check_plan(Counter({1: 3}), 1024) == 0
    check_plan(Counter({5: 20_000, 600: 99}), 1024)
    check_plan(Counter({700: 500, 900: 30}), 1024)


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_combinations(depth):
    lengths = np.array([1, 2, 3, 5, 8, 9, 13, 16])
    got = [tuple(c for c in row if c) for row in combinations_filling(lengths, 16, depth).tolist()]
    expected = [c for k in range(1, depth + 1) for c in itertools.combinations_with_replacement(lengths.tolist(), k) if sum(c) == 16]
    assert sorted(got) == sorted(expected)
    assert len(combinations_filling(np.zeros(0, np.int64), 16, depth)) == 0


def test_least_squares_solution():
    rng = np.random.default_rng(3)
    counts = np.concatenate([[0], rng.integers(0, 50, 32)])
    combos = combinations_filling(np.flatnonzero(counts), 32, 3)
    x = solve_repeats(combos, counts, 20_000, 1e-9)
    a = np.zeros((33, len(combos)))
    for k in range(3):
        np.add.at(a, (combos[:, k], np.arange(len(combos))), 1)
    a[0] = 0
    g = a.T @ (a @ x - counts)
    # The conditions of a solution: no gradient where x is positive, none that x could still follow.
    assert (x >= 0).all() and np.abs(g[x > 1e-6]).max() < 1e-3 and g.min() > -1e-3
    left = counts.copy()
    used = Counter()
    for combo, n in rounded(combos, x, left):
        for c in combo:
            used[c] += n
    assert all(used[k] + left[k] == counts[k] for k in range(33)) and (left >= 0).all()
    # Where lengths come from whole windows, nearly all go back into some.
    chosen = combos[rng.integers(0, len(combos), 400)]
    counts = np.bincount(chosen.ravel(), minlength=33)
    counts[0] = 0
    left = counts.copy()
    rounded(combos, solve_repeats(combos, counts), left)
    assert left.sum() < 0.1 * counts.sum()


def check_rows(rows, texts, full, window=1024):
    """All ids of every text lie in exactly one piece, sequences are gapless and full or a power of two."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= window and end & (end - 1) == 0
    for doc, text in texts:
        ids = np.array(full.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own, at = pieces[doc, len(ids)], 0
        while at < len(ids):
            part = next(p for p in own if p[0] == at and zlib.crc32(ids[at : at + p[1]].tobytes()) == p[2])
            own.remove(part)
            at += part[1]
        assert at == len(ids)
    assert not any(pieces.values())


def test_documents(crowd):
    rng = random.Random(4)
    words = "the quick brown fox jumps over a lazy dog and 12 more naïve cafés".split()
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(700)))) for i in range(60)]
    texts += [(100, None), (101, ""), (None, "no id"), (None, None), (7, "an id again"), (102, "word " * 30_000), (103, "same"), (103, "same"),
              (104, "<|endoftext|> in a text"), (105, "two  spaces")]
    full = Tokenizer.from_file(PATH)
    out = pack_by_least_squares(crowd(texts, SCHEMA)).collect()
    check_rows(out, texts, full)
    with_ids = pack_by_least_squares(crowd(texts, SCHEMA), with_ids=True).collect()
    check_rows(with_ids, texts, full)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in with_ids)


def test_whole_small_table(spark, small):
    from crowdpulse.llm.queries import QUERIES

    texts = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op11_nnls_packing"](spark, small).collect()
    check_rows(out, texts, Tokenizer.from_file(PATH))
    assert len({r["sequence_id"] for r in out}) <= sum(r["length"] for r in out) // 1024 + 10


def test_empty_table_and_bytes_that_are_no_text(crowd):
    assert pack_by_least_squares(crowd([], SCHEMA)).collect() == []
    df = crowd([(1, "abc")], SCHEMA).withColumn("text", F.expr("cast(x'ff41' as string)"))
    out = pack_by_least_squares(df).collect()
    check_rows(out, [(1, "�A")], Tokenizer.from_file(PATH))
    with pytest.raises(ValueError):
        pack_by_least_squares(df, window=1000)
