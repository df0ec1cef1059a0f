import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crowdpulse.llm import token_links as module
from crowdpulse.llm.token_links import Csr, TwoTokenizers, align, from_pairs, links, row_products, spans, token_links

SCHEMA = "doc_id long, text string"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "plain words of a text", "  two  spaces\n\nlines\tand tabs ", "naïve café — 東京 \U0001f600", "<|endoftext|> here",
       "▁ marks", "full　width Ａ", "\x00 null", "é combining", "<0x41> and <s> </s> <unk>", "word " * 3000, "​", "ﬁ ligature", "▁"]


def plain(rows):
    """The rows of the contract by plain code, with ``tokenizers`` and ``sentencepiece`` themselves."""
    a_of, b_of = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_of.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [n for n in range(256) if n not in shown]
    byte_of = {chr(n): n for n in shown} | {chr(256 + i): n for i, n in enumerate(hidden)}

    def bytes_b(i):
        return bytes([int(b_of.id_to_piece(i)[3:5], 16)]) if b_of.is_byte(i) else b_of.id_to_piece(i).replace("▁", " ").encode()

    found = []
    for doc, text in rows:
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        pa, pb = [bytes(byte_of[c] for c in a_of.id_to_token(i)) for i in a], [bytes_b(i) for i in b]
        if not text or b"".join(pa) != (" " + text).encode() or b"".join(pb) != (" " + text).encode():
            found.append((doc, [], [], [], []))
            continue
        ea, eb = np.cumsum([len(x) for x in pa]).tolist(), np.cumsum([len(x) for x in pb]).tolist()
        groups, ga, gb = [], [], []
        i = j = 0
        for end in sorted(set(ea) & set(eb)):
            while i < len(ea) and ea[i] <= end:
                ga.append(a[i]); i += 1
            while j < len(eb) and eb[j] <= end:
                gb.append(b[j]); j += 1
            groups.append((ga, gb))
            ga, gb = [], []
        found.append((doc, a, b, groups, [(x, y) for x, p in zip(a, ea) for y, q in zip(b, eb) if p == q] if len(a) < 2000 else [(g[0][-1], g[1][-1]) for g in groups]))
    count = Counter(p for row in found for p in row[4])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for doc, a, b, groups, pairs in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, len(a), len(b), len(groups), len(pairs), sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


@pytest.mark.parametrize("block", [4 << 20, 200])
def test_odd_texts(crowd, monkeypatch, block):
    monkeypatch.setattr(module, "BLOCK", block)
    rows = list(enumerate(ODD)) + [(3, "a"), (None, "plain words of a text"), (3, None)]
    got = sorted(map(tuple, token_links(crowd(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted(plain(rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 8 and sum(r[1] == 0 for r in got) >= 4


def test_whole_small_table(spark, small):
    from crowdpulse.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op12_token_links"](spark, small).collect()))
    assert got == sorted(plain(rows))


def test_empty_table_and_bytes_that_are_no_text(crowd):
    assert token_links(crowd([], SCHEMA)).collect() == []
    df = crowd([(1, "abc")], SCHEMA).withColumn("text", F.expr("cast(x'ff41' as string)"))
    assert [tuple(r) for r in token_links(df).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def dense(m):
    out = np.zeros((len(m.indptr) - 1, m.columns), np.int64)
    np.add.at(out, (m.rows(), m.indices), m.data)
    return out


@pytest.mark.parametrize("strip", [1, 7, 1 << 22])
def test_row_products(monkeypatch, strip):
    monkeypatch.setattr(module, "STRIP", strip)
    rng = np.random.default_rng(strip)
    for rows, inner, columns in [(0, 3, 4), (5, 0, 4), (6, 7, 8), (30, 20, 25)]:
        x, y = (rng.integers(0, 4, s) * (rng.random(s) < 0.3) for s in ((rows, inner), (inner, columns)))
        a, b = (from_pairs(*np.nonzero(m), m.shape, m[np.nonzero(m)]) for m in (x, y))
        assert (dense(row_products(a, b)) == x @ y).all()
        assert (dense(a.transposed()) == x.T).all()
        v = rng.integers(0, 9, inner)
        assert (a.times(v) == x @ v).all()


def test_kinds_of_links():
    ends_a, ends_b = np.array([2, 5, 6, 9]), np.array([1, 5, 9])
    start_a, start_b = [0, 2, 5, 6], [0, 1, 5]
    overlap = [[max(0, min(p, q) - max(s, t)) for t, q in zip(start_b, ends_b)] for s, p in zip(start_a, ends_a)]
    assert dense(links(ends_a, ends_b, "overlap")).tolist() == overlap
    assert dense(links(ends_a, ends_b, "end")).tolist() == [[int(p == q) for q in ends_b] for p in ends_a]
    assert dense(links(ends_a, ends_b, "group")).tolist() == [[1, 1, 0], [1, 1, 0], [0, 0, 1], [0, 0, 1]]
    none = np.zeros(0, np.int64)
    assert all(len(links(none, none, k).indices) == 0 for k in ("end", "overlap", "group"))
    assert dense(spans(np.array([0, 2]), np.array([2, 3]), 3)).tolist() == [[1, 1, 0], [0, 0, 1]]
    with pytest.raises(ValueError):
        links(ends_a, ends_b, "near")


def test_overlaps_of_texts():
    tokens = TwoTokenizers(A, B)
    texts = [b"unbelievable tokenization", None, "東京 tower".encode()]
    found = align(tokens, texts, "overlap")
    # Every byte of a text lies in one token of either side.
    ids = tokens.ids(texts)
    expected = Counter()
    for k, (a, b) in enumerate(zip(*ids)):
        owner = [[i for i in side for _ in range(len(table[i]))] for side, table in ((a, tokens.bytes_a), (b, tokens.bytes_b))]
        place = [[n for n, i in enumerate(side) for _ in range(len(table[i]))] for side, table in ((a, tokens.bytes_a), (b, tokens.bytes_b))]
        expected.update({(k, x, y) for (x, y, _, _) in set(zip(*owner, *place))})
    assert {(k, x, y) for k, x, y in zip(found.link_text.tolist(), found.link_a.tolist(), found.link_b.tolist())} == set(expected)


def test_csr_of_repeated_entries():
    m = from_pairs(np.array([1, 1, 0]), np.array([2, 2, 0]), (2, 3))
    assert isinstance(m, Csr) and dense(m).tolist() == [[1, 0, 0], [0, 0, 2]]
