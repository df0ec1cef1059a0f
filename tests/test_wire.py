import pytest
from pyspark.sql import functions as F

from crowdpulse.functions.text import parse_tags, tokens, unique_word_ratio
from crowdpulse.sources.files import read_event_files, read_events_with_arrival, read_static_tables
from crowdpulse.sources.wire import events_only, heartbeats, malformed, parse_events
from scenarios import A_LIKE, BOATS, SHORT, by, like, records


def parsed(spark, lines):
    return [r.asDict() for r in parse_events(records(spark, lines)).collect()]


def test_kinds_and_fields(spark):
    rows = parsed(spark, BOATS + [by(7, 640, "10:48:00", 880), "8|9|2021-06-15T10:48:00Z|a|b|c||7|3", "63|880|2021-06-17T05:40:00.000Z"])
    post, photo, comment, reply, like_ = rows
    assert (post["kind"], post["id"], post["person_id"], post["forum_id"]) == ("post", 880, 61, 77)
    assert post["tags"] == [31, 905] and post["language"] == "pt" and post["image_file"] is None
    assert photo["content"] == "" and photo["tags"] == [] and photo["image_file"] == "boat881.jpg"
    assert photo["language"] is None and photo["ts_s"] == 1623752446
    assert (comment["kind"], comment["parent_kind"], comment["parent_id"]) == ("comment", "post", 880)
    assert (reply["kind"], reply["id_kind"], reply["parent_kind"], reply["parent_id"]) == ("reply", "comment", "comment", 7)
    assert (like_["kind"], like_["id"], like_["ts_s"]) == ("like", None, 1623908400)


def test_quotes_separators_and_lines(spark):
    rows = parsed(spark, [
        '1|2|2021-06-15T10:48:00Z|a|b|"one | two ""three"" | four"|5||3',
        '1|2|2021-06-15T10:48:00Z|a|b|"""start"|5||3',
        '1|2|2021-06-15T10:48:00Z|a|b|"line\none\r\n| two"|5||3',
        '1|2|2021-06-15T10:48:00Z|a|b|half "quoted|5||3',
        '1|2|2021-06-15T10:48:00Z|a|b|""|5||3',
    ])
    assert [r["content"] for r in rows] == ['one | two "three" | four', '"start', "line\none\r\n| two", 'half "quoted', ""]
    assert {r["kind"] for r in rows} == {"comment"}


def test_bad_records_are_kept_aside(spark):
    df = spark.createDataFrame(
        [(b"WATERMARK|1554163500",), (b"x|y",), (b"1|2|yesterday",), (b"\xff\xfe|1|2021-06-15T10:48:00Z",),
         (b"1|2|2021-06-15T10:48:00Z|a|b|c|||3",), (like(1, 2, "00:01").encode(),), (b"",), (b"WATERMARK|soon",)],
        "value binary",
    )
    out = parse_events(df)
    assert [r.ts_s for r in heartbeats(out).collect()] == [1554163500]
    assert sorted(bytes(r.raw) for r in malformed(out).collect()) == sorted(
        [b"x|y", b"1|2|yesterday", b"\xff\xfe|1|2021-06-15T10:48:00Z", b"1|2|2021-06-15T10:48:00Z|a|b|c|||3", b"", b"WATERMARK|soon"]
    )
    assert [r.kind for r in events_only(out).collect()] == ["like"]


@pytest.mark.parametrize("text, ratio", [
    ("", 1.0), (" ,.!", 1.0), ("A a b", 2 / 3), ("one ONE", 0.5), ("x_y-x", 2 / 3), ("é É", 0.5), (None, 1.0),
])
def test_unique_word_ratio(spark, text, ratio):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(unique_word_ratio("t").alias("r")).first().r == ratio


def test_tokens_and_tags(spark):
    df = spark.createDataFrame([("Hello, wide World! 3 times", "[7001, 1667]"), ("", "[]"), ("", None)], "t string, g string")
    rows = df.select(tokens("t").alias("w"), parse_tags("g").alias("g")).collect()
    assert rows[0].w == ["hello", "wide", "world", "3", "times"] and rows[0].g == [7001, 1667]
    assert rows[1].w == [] and rows[1].g == [] and rows[2].g == []


def test_event_files(spark, tmp_path):
    kinds = {11: "posts", 9: "comments", 3: "likes"}
    files = {k: [f"{k}_header|with|text", ""] for k in kinds.values()}
    arrival = {k: ["processing_tim|id"] for k in kinds.values()}
    for i, line in enumerate(SHORT):
        name = kinds[line.count("|") + 1]
        files[name].append(line)
        arrival[name].append(f"2019-04-02T05:{i:02d}:00Z|{line}")
    for name in files:
        (tmp_path / f"{name}.csv").write_text("\n".join(files[name]) + "\n")
        (tmp_path / f"{name}_a.csv").write_text("\n".join(arrival[name]) + "\n")
    paths = [str(tmp_path / f"{n}.csv") for n in ("posts", "comments", "likes")]
    plain = read_event_files(spark, *paths)
    assert plain.count() == len(SHORT)
    timed = read_events_with_arrival(spark, *[p.replace(".csv", "_a.csv") for p in paths])
    got = [r.arrival_s - 1554163200 - 5 * 3600 for r in timed.orderBy("arrival_s").collect()]
    assert got == [60 * i for i in range(len(SHORT))]
    assert timed.drop("arrival_s").exceptAll(plain).count() == 0


def test_event_files_lose_no_line(spark, tmp_path):
    """Only first lines and blank ones are left out: not a quoted first field, not what is broken."""
    files = {
        "posts": ["1|looks|like|data", BOATS[0], '"882"' + BOATS[1][3:], " " + BOATS[1], "883|broken", ""],
        "comments": ["id|person", by(7, 640, "10:48:00", 880, '"a | quoted ""text"""'), "# not a record", "\\N|x"],
        "likes": ["header", A_LIKE[0], "63|880"],
    }
    for name, lines in files.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
        (tmp_path / f"{name}_a.csv").write_text("\n".join([lines[0]] + [x and f"2021-06-20T00:00:00Z|{x}" for x in lines[1:]] + ["no separator"]))
    paths = [str(tmp_path / f"{n}.csv") for n in files]
    rows = read_event_files(spark, *paths).collect()
    assert sorted(r.id for r in rows if r.kind == "post") == [880, 881, 882]
    assert [r.content for r in rows if r.kind == "comment"] == ['a | quoted "text"']
    assert sorted(bytes(r.raw) for r in rows if r.kind == "malformed") == [b"# not a record", b"63|880", b"883|broken", b"\\N|x"]
    assert len(rows) == 9
    timed = read_events_with_arrival(spark, *[p.replace(".csv", "_a.csv") for p in paths]).collect()
    assert len(timed) == 9 + 3 and sum(r.arrival_s is None for r in timed) == 3


def test_static_tables(spark, tmp_path):
    (tmp_path / "person_knows_person.csv").write_text("a|b\n1|2\n2|1\n")
    (tmp_path / "person_studyAt_organisation.csv").write_text("a|b|c\n1|10|2001\n2|10|\n")
    (tmp_path / "person_workAt_organisation.csv").write_text("a|b|c\n1|20|2010\n")
    (tmp_path / "forum_has_member.csv").write_text("a|b|c\n5|1|2021-06-15T10:48:00.123Z\n5|2|\n")
    tables = read_static_tables(spark, str(tmp_path))
    assert sorted(tuple(r) for r in tables["person_knows_person"].collect()) == [(1, 2), (2, 1)]
    assert [tuple(r) for r in tables["person_studyAt_organisation"].orderBy("person_id").collect()] == [(1, 10, 2001), (2, 10, None)]
    assert tables["forum_has_member"].filter("join_date is not null").count() == 1


def test_value_as_an_expression(spark):
    df = spark.createDataFrame([("x", "5|7|2019-04-02T00:06:00Z")], "head string, tail string")
    row = parse_events(df, F.concat(F.lit(""), F.col("tail")), keep=("head",)).first()
    assert (row["head"], row["kind"], row["person_id"], row["parent_id"]) == ("x", "like", 5, 7)


def test_options_of_the_kafka_source_and_sink(monkeypatch):
    """No broker here: what would be asked of the connector."""
    from crowdpulse.sources.wire import read_kafka
    from crowdpulse.streaming.sinks import write_stream

    class Recorder:
        def __init__(self):
            self.calls = []

        def __getattr__(self, name):
            def call(*args, **kwargs):
                self.calls.append((name, *args, *kwargs.items()))
                return self
            return call

    source = Recorder()
    read_kafka(type("Session", (), {"readStream": source})(), "host:9092", "events", maxOffsetsPerTrigger=5)
    assert source.calls == [
        ("format", "kafka"), ("option", "kafka.bootstrap.servers", "host:9092"), ("option", "subscribe", "events"),
        ("option", "startingOffsets", "earliest"), ("option", "maxOffsetsPerTrigger", 5), ("load",), ("select", "value"),
    ]
    monkeypatch.setattr("crowdpulse.streaming.sinks.F", Recorder())
    sink = Recorder()
    df = type("Frame", (), {"writeStream": sink, "select": lambda self, c: self})()
    write_stream(df, "kafka", "results", "cp", options={"kafka.bootstrap.servers": "host:9092"})
    assert sink.calls == [
        ("format", "kafka"), ("outputMode", "append"), ("trigger", ("availableNow", True)), ("option", "checkpointLocation", "cp"),
        ("option", "kafka.bootstrap.servers", "host:9092"), ("option", "topic", "results"), ("start",),
    ]
