import json

from pyspark.sql import functions as F

from granary.sources import files, records, remote, sinks
from granary.streaming.events import hourly_windows, ingest


def test_csv_with_decimal_comma_and_terms(spark, tmp_path):
    (tmp_path / "a.csv").write_text("zone;v\nA;1,5\nB;\nC;x\n", encoding="utf-8")
    got = files.read_csv(spark, f"file://{tmp_path}/a.csv", "zone string, v double", ";", ",").collect()
    assert [(r.zone, r.v) for r in got] == [("A", 1.5), ("B", None), ("C", None)]
    (tmp_path / "t.txt").write_text('\ufeff"Aire",\n\nAire\n  \'Gy\' ,\n', encoding="utf-8")
    assert [r.term for r in files.read_terms(spark, f"file://{tmp_path}/t.txt").orderBy("place").collect()] == ["Aire", "Gy"]
    assert files.read_optional_csv(spark, f"file://{tmp_path}/none.csv", "a string").count() == 0


def test_xlsx_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "a & b"), ("2", None)], "`Product Id` string, name string")
    sinks.write_xlsx(df, str(tmp_path / "b.xlsx"))
    got = files.read_xlsx(spark, f"file://{tmp_path}/b.xlsx", ["product id", "name", "none"]).orderBy("`product id`").collect()
    assert [tuple(r) for r in got] == [("1", "a & b", None), ("2", None, None)]


def test_json_answers(spark):
    hourly = json.dumps({"hourly": {"time": ["t1", "t2"], "temperature_2m": [1.0, None], "relative_humidity_2m": [5, 6], "wind_speed_10m": [7, 8]}})
    df = spark.createDataFrame([("Paris", hourly)], "city string, body string")
    assert [tuple(r) for r in files.hourly_rows(df).collect()] == [("Paris", "t1", 1.0, 5.0, 7.0), ("Paris", "t2", None, 6.0, 8.0)]
    graph = json.dumps({"results": {"bindings": [{"a": {"value": "x"}}, {"a": {"value": "y"}, "b": {"value": "z"}}]}})
    df = spark.createDataFrame([(graph,)], "body string")
    assert sorted(map(tuple, files.binding_rows(df, ["a", "b"]).collect())) == [("x", None), ("y", "z")]
    found = json.dumps({"response": {"numFound": 2, "docs": [{"p": "1", "n": ["A", "B"]}, {"p": ["2"]}]}})
    df = spark.createDataFrame([(found,)], "body string")
    assert sorted(map(tuple, files.search_rows(df, ["p", "n"]).collect())) == [("1", "A"), ("2", None)]


def test_remote_batches_halve_on_failure(spark):
    def transport(request):
        if "bad" in request["ids"].split(","):
            raise OSError("refused")
        return request["ids"]

    keys = spark.createDataFrame([(k,) for k in ["a", "b", "bad", "c", "a", None]], "k string")
    policy = remote.Policy(batch=4, retries=0, tasks=1)
    got = remote.fetch(keys, "k", lambda ks: {"ids": ",".join(ks)}, transport, policy).collect()
    assert sorted(k for r in got if r.body for k in r["keys"]) == ["a", "b", "c"]
    assert [r["keys"] for r in got if r.error] == [["bad"]]
    waits = []
    replies = iter([remote.RetryLater(2.0), OSError(), "ok"])

    def slow(_):
        r = next(replies)
        if isinstance(r, Exception):
            raise r
        return r

    assert remote.answered(slow, {}, remote.Policy(pause=0.5), waits.append) == "ok" and waits == [2.0, 1.0]
    totals = spark.createDataFrame([("q", 120), ("r", 50), ("s", 0)], "q string, n_records int")
    assert sorted((r.q, r.start) for r in remote.page_starts(totals, 50).collect()) == [("q", 51), ("q", 101)]


def test_records(spark):
    xml = '<record><controlfield tag="001">42</controlfield><datafield tag="020"><subfield code="a">1</subfield><subfield code="a">2</subfield></datafield><datafield tag="701"><subfield code="a">N</subfield></datafield></record>'
    df = records.parsed_records(spark.createDataFrame([(xml,)], "xml string"), "xml")
    row = df.select(records.control_value("001").alias("id"), records.field_values("020", "a").alias("n"), records.first_value(["700", "701"], "a").alias("w"), records.field_values("999", "a").alias("none")).first()
    assert tuple(row) == ("42", ["1", "2"], "N", [])


def test_upsert_is_idempotent(spark, tmp_path):
    path, schema = f"file://{tmp_path}/w", "city string, at int, v int"
    for batch in ([("a", 1, 1), ("b", 1, 2)], [("a", 1, 9), ("c", 1, 3)], [("a", 1, 9), ("c", 1, 3)]):
        sinks.upsert_parquet(spark, path, spark.createDataFrame(batch, schema), ["city", "at"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1, 9), ("b", 1, 2), ("c", 1, 3)]


def test_stream_of_events(spark, tmp_path):
    events = spark.createDataFrame([(1, "2024-01-01 00:10:00", "a", 1.0), (1, "2024-01-01 00:10:00", "a", 1.0), (2, "2024-01-01 00:50:00", "a", 2.0)], "event_id long, ts string, event_type string, value double")
    events.withColumn("ts", F.to_timestamp("ts")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    put = lambda df, _: df.write.mode("append").parquet(f"{tmp_path}/out")
    ingest(stream, ["event_id"], "ts", put, f"{tmp_path}/state").awaitTermination(60)
    kept = spark.read.parquet(f"{tmp_path}/out")
    assert kept.count() == 2
    assert [(r.n, r.total) for r in hourly_windows(kept).collect()] == [(2, 3.0)]


def test_tables_and_marked_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "é")], "a int, b string")
    sinks.write_csv_marked(df, f"file://{tmp_path}/m")
    (part,) = tmp_path.glob("m/part-*")
    assert part.read_bytes() == "\ufeffa,b\n1,é\n".encode()
    assert [tuple(r) for r in files.read_optional_csv(spark, f"file://{tmp_path}/m", "a int, b string").collect()] == [(1, "é")]
    for _ in range(2):
        sinks.create_table(spark, "weather_test", "city string, at string, v double", ["city"])
    assert spark.table("weather_test").count() == 0
    for rows in ([("p", 1)], [("q", 2), ("r", 3)]):
        sinks.replace_table(spark.createDataFrame(rows, "name string, n int"), "city_test")
    assert sorted(map(tuple, spark.table("city_test").collect())) == [("q", 2), ("r", 3)]
    spark.sql("DROP TABLE weather_test")
    spark.sql("DROP TABLE city_test")


def test_local_works_need_id_number_and_reason(spark):
    def record(name, *fields):
        inner = "".join(f'<datafield tag="{t}"><subfield code="{c}">{v}</subfield></datafield>' for t, c, v in fields)
        return f'<record><controlfield tag="001">{name}</controlfield>{inner}</record>'

    number = ("010", "a", "9782")
    rows = [
        record("a", number, ("541", "t", "À Genève"), ("701", "3", "p1"), ("700", "3", "p2")),
        record("b", ("200", "a", "Genève")),
        record("c", number, ("606", "3", "geneve"), ("606", "2", "geneve"), ("200", "b", "geneve")),
        record("d", number, ("605", "x", "GENEVE"), ("210", "c", "geneve"), ("214", "a", "geneve")),
        "no record",
    ]
    df = records.parsed_records(spark.createDataFrame([(r,) for r in rows], "xml string"), "xml")
    every = {k: ["geneve"] for k in ("title", "place_of_publication", "subject")}
    got = {r.id: (r.reasons, r.persons) for r in records.local_works(df, every).collect()}
    assert got == {"a": (["title"], ["p1", "p2"]), "d": (["place_of_publication", "subject"], [])}


def test_envelope_of_an_empty_answer(spark):
    df = spark.createDataFrame([("<r><numberOfRecords>0</numberOfRecords></r>",), ("<r/>",), ("<r><numberOfRecords>2</numberOfRecords></r>",)], "xml string")
    got = [(r.n_records, r.ids, r.unchecked, r.complete) for r in records.envelope(df, "xml").collect()]
    assert got == [(0, [], [], True), (None, [], [], None), (2, [], [], False)]
