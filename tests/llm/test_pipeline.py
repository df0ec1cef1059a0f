import duckdb
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from crowdpulse.llm import quality
from crowdpulse.llm.common import written
from crowdpulse.llm.queries import ORACLE_SQL

from test_line_dedup import plain
from test_packing import check
from test_simhash import plain_components, plain_fingerprint

DIR = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.select(*pipeline.COLUMNS).orderBy("doc_id").collect()]


def test_every_stage_against_plain_code(spark):
    tables = [spark.read.parquet(f"{DIR}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], DIR), f"test-{name}"))
        if name != "best_fit_packing":
            assert tables[-1].dtypes == tables[0].dtypes
    docs, good, lines, unique, mixed, packed = tables

    model = quality.fit(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    before = rows(docs)
    score = model.score(quality.features([(r[1] or "").encode() for r in before]))
    assert rows(good) == [r for r, s in zip(before, score) if s >= 0.5]
    clean = {r[0] for r in spark.read.parquet(f"{DIR}/labels.parquet").filter("quality = 1").select("doc_id").collect()}
    assert len(clean & {r[0] for r in rows(good)}) >= 0.98 * len(clean)

    kept = {d: t for d, t, _, _ in plain([(r[0], r[1]) for r in rows(good)])}
    assert rows(lines) == [(r[0], kept[r[0]], r[2], r[3], len(kept[r[0]])) for r in rows(good)]

    before = rows(lines)
    component = plain_components([plain_fingerprint(r[1]) for r in before])
    assert rows(unique) == [r for i, r in enumerate(before) if component[i] == i]

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows(unique))
    copies = dict(con.execute(f"SELECT doc_id, copies FROM ({ORACLE_SQL['op5_pareto_mix']})").fetchall())
    assert rows(mixed) == [r for r in rows(unique) for _ in range(copies[r[0]])]

    out = packed.collect()
    assert check([(r["sequence_id"], r["offset"], r["length"]) for r in out], 1024)
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(full.encode(r[1], add_special_tokens=False).ids) + 1 for r in rows(mixed))
    assert sum(r["length"] for r in out) == tokens

    again = pipeline.run(spark, DIR)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, again.select(*columns).collect())) == sorted(tuple(r[c] for c in columns) for r in out)


def test_stages_take_odd_rows(spark):
    long = " ".join(f"long{i % 997}" for i in range(50_000))
    named = "a text without an id, of one whole line"
    odd = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, named, "en", "a", 20), (2, "", "en", "a", 0),
           (3, long, "en", None, None), (4, named, "en", "a", 20), (4, named, "en", "a", 20)]
    schema = spark.read.parquet(f"{DIR}/documents.parquet").schema
    docs = spark.createDataFrame(odd, schema).withColumn("copies", F.lit("other")).withColumn("fp", F.lit(1)).repartition(3)

    def ids(df):
        return sorted((r["doc_id"] for r in df.collect()), key=repr)

    # The classifier keeps what its scores say, row by row, and the columns of documents alone.
    good = pipeline.good_documents(spark, docs, DIR)
    model = quality.fit(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    passed = [r for r in odd if model is None or model.score(quality.features([(r[1] or "").encode()]))[0] >= 0.5]
    assert good.columns == list(pipeline.COLUMNS) and ids(good) == sorted((r[0] for r in passed), key=repr)

    lines = written(pipeline.unique_lines(spark, docs, DIR), "odd")
    assert ids(lines) == ids(docs) and lines.columns == list(pipeline.COLUMNS)
    assert {(r["doc_id"], r["text"]) for r in lines.collect()} == {(1, ""), (2, ""), (None, ""), (3, long), (4, named)}
    unique = written(pipeline.near_unique(spark, lines, DIR), "odd")
    assert ids(unique) == [1, 3, 4] and unique.columns == list(pipeline.COLUMNS)
    mixed = written(pipeline.mixed(spark, unique, DIR), "odd")
    assert mixed.columns == list(pipeline.COLUMNS) and set(ids(mixed)) <= {1, 3, 4}
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = pipeline.packed(spark, docs, DIR).collect()
    tokens = {d: 0 for d in (1, 2, None, 3, 4)}
    for d, text, *_ in odd:
        tokens[d] += len(full.encode(text or "", add_special_tokens=False).ids) + 1
    assert {d: sum(r["length"] for r in packed if r["doc_id"] == d) for d in tokens} == tokens
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, DIR).collect() == []
