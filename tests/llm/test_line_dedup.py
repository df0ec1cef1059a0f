import hashlib
import random

from pyspark.sql import functions as F

from crowdpulse.llm.line_dedup import LineRuns, dedup_lines

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows, least=10):
    """doc_id, kept text, lines, dropped; one entry per row."""
    rank = lambda d: float("inf") if d is None else d
    first = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= least:
                first[k] = min(first.get(k, float("inf")), rank(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or first[key(x)] >= rank(d)]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "_n_lines", "_n_dropped").collect()), key=repr)


def test_against_plain_code(crowd):
    rng = random.Random(1)
    pool = [f"{'Shared' if i % 2 else 'sHARED'} line number {i // 2}" for i in range(30)] + ["short", "", "  ", "Élan vital de l'été", "élan vital de l'été"]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\t\r"]) for _ in range(rng.randrange(8)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n"), (None, "shared line number 3\nonly here, no id"), (7, "a repeated id\nshared line number 1"), rows[5]]
    rows += [(200, "\n".join(f"very long text, line {i}" for i in range(5000))), (201, "\n".join(f"very long text, line {i}" for i in range(0, 5000, 3)))]
    df = crowd(rows, "doc_id long, text string")
    for batches, fanout in ((1, 2), (5, 2)):
        assert result(dedup_lines(df, n_batches=batches, fanout=fanout)) == plain(rows)


def test_repeated_line_in_one_document_stays(crowd):
    rows = [(1, "the same line\nthe same line"), (2, "x\nthe same line\nthe same line")]
    assert result(dedup_lines(crowd(rows, "doc_id long, text string"))) == [(1, rows[0][1], 2, 0), (2, "x", 3, 2)]


def test_empty_table(crowd):
    df = crowd([], "doc_id long, text string")
    assert dedup_lines(df).collect() == []


def test_other_columns_are_kept(crowd):
    out = dedup_lines(crowd([(1, "a")], "doc_id long, text string").withColumn("_n_lines", F.lit("old")))
    row = out.first()
    assert row["fp"] == -1 and row["rid"] == -1 and row["_n_lines"] == 1


def test_runs_are_compacted(spark):
    runs = LineRuns(spark, fanout=2, buckets=2)
    batch = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.col("id").alias("doc"))
    assert runs.add(batch(0, 10)).count() == 10
    assert runs.add(batch(5, 15)).count() == 5
    assert runs.add(batch(0, 15)).count() == 0
    assert runs.add(batch(14, 20)).count() == 5
    assert [len(names) for names in runs.levels] == [0, 0, 1]
    assert spark.table(runs.levels[2][0]).count() == 20
    runs.drop()
    assert not spark.catalog.tableExists(f"{runs.prefix}_0")


def test_hash_of_kept_text(spark, small):
    from crowdpulse.llm.queries import QUERIES

    texts = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    expected = sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, k in plain(texts))
    got = QUERIES["op9_line_dedup"](spark, small).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted(tuple(r) for r in got) == expected
