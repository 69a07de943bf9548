import json
import tempfile

from conftest import rows

from streamlab import sources
from streamlab.config import JobSettings, work_dir
from streamlab.schemas import FLIGHT, KAFKA_ENVELOPE, PATIENT_BASE, POST, VOTE
from streamlab.sinks import encode_kafka
from streamlab.sinks.mongo import mongo_options


def test_json_lines_and_single_objects(spark, deliver):
    folder = deliver("posts", {"id": "1", "texto": "a"})
    deliver("posts", {"id": "2", "texto": "b"}, {"id": "3", "texto": "c", "criado_em": "t"})
    got = rows(sources.read_json(spark, folder, POST), "id")
    assert got == [("1", "a", None), ("2", "b", None), ("3", "c", "t")]


def test_missing_required_field_and_broken_line_flow_on_as_null(spark, deliver):
    folder = deliver("f", {"voo": "A1", "passageiros": 10}, "{broken", {"companhia": "GOL", "passageiros": "x"})
    df = sources.read_json(spark, folder, FLIGHT).select("voo", "companhia", "passageiros")
    assert sorted(rows(df), key=repr) == sorted([("A1", None, 10), (None, None, None), (None, "GOL", None)], key=repr)


def test_stream_pace_by_files(spark, deliver, tmp_path):
    for n in range(3):
        folder = deliver("paced", {"id": str(n), "texto": "x"})
    seen = []
    query = (
        sources.read_json_stream(spark, folder, POST, max_files=1)
        .writeStream.foreachBatch(lambda b, n: seen.append([r.id for r in b.collect()]))
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert seen == [["0"], ["1"], ["2"]]


def test_headerless_csv(spark, tmp_path):
    (tmp_path / "base.csv").write_text("6,148,72,35,0,33.6,0.627,50,1\n1,85,66,29,0,26.6,0.351,31,0\n")
    df = sources.read_csv_named(spark, str(tmp_path / "base.csv"), PATIENT_BASE)
    assert df.columns == PATIENT_BASE.names
    assert rows(df.select("glucose", "bmi", "outcome"), "glucose") == [(85.0, 26.6, 0), (148.0, 33.6, 1)]


def test_table_stream_reads_file_and_directory(spark, tmp_path):
    df = spark.range(10)
    df.coalesce(2).write.parquet(str(tmp_path / "d" / "t.parquet"))
    df.coalesce(1).write.parquet(str(tmp_path / "tmp"))
    (tmp_path / "f").mkdir()
    part = next((tmp_path / "tmp").glob("part-*.parquet"))
    (tmp_path / "f" / "t.parquet").write_bytes(part.read_bytes())
    for kind in ("d", "f"):
        stream = sources.read_table_stream(spark, str(tmp_path / kind), "t", df.schema)
        out = str(tmp_path / f"out_{kind}")
        q = stream.writeStream.format("parquet").option("checkpointLocation", out + "_ck")
        q.trigger(availableNow=True).start(out).awaitTermination()
        assert spark.read.parquet(out).count() == 10


def envelope(spark, *values):
    rows_ = [(b"SP", v if v is None else bytearray(v.encode()), "votos", 0, n, None, 0) for n, v in enumerate(values)]
    return spark.createDataFrame(rows_, KAFKA_ENVELOPE)


def test_decode_malformed_payloads(spark):
    good = json.dumps({"id_urna": 1, "estado": "SP", "candidato": "A", "event_time": "t"})
    mistyped = json.dumps({"id_urna": "x", "estado": "SP", "candidato": "A"})
    df = envelope(spark, good, "garbage", good[:20], mistyped, None)
    decoded = sources.decode_json(df, VOTE, keep=["offset"])
    got = [tuple(r)[:3] for r in decoded.orderBy("offset").collect()]
    nothing = (None, None, None)
    assert got == [(1, "SP", "A"), nothing, nothing, (None, "SP", "A"), nothing]


def test_encode_then_decode(spark):
    df = spark.createDataFrame([(1, "SP", "A", "t"), (2, None, "Ç", None)], VOTE.simpleString())
    messages = encode_kafka(df, "estado")
    assert [f.dataType.simpleString() for f in messages.schema] == ["binary", "binary"]
    assert [r.key for r in messages.collect()] == [bytearray(b"SP"), None]
    assert rows(sources.decode_json(messages, VOTE), "id_urna") == rows(df, "id_urna")


def test_connection_options():
    o = sources.kafka_options("h:9092", "votos", max_offsets=5, min_partitions=8)
    assert o == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "votos",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5",
        "minPartitions": "8",
    }
    j = sources.jdbc_options("mysql", "h", 3306, "bolsa", "u", "p", serverTimezone="UTC")
    assert j["url"] == "jdbc:mysql://h:3306/bolsa?serverTimezone=UTC"
    assert sources.jdbc_options("postgresql", "h", 5432, "d", "u", "p")["url"] == "jdbc:postgresql://h:5432/d"
    m = mongo_options("mongodb://h", "eleicao", "apuracao")
    assert m["operationType"] == "update" and m["upsertDocument"] == "true" and m["idFieldList"] == "_id"


def test_settings_from_environment():
    s = JobSettings.from_env({"KAFKA_TOPIC": "t2", "MAX_FILES": "7", "S3_ENDPOINT": "http://h:9000"}, trigger_seconds=8)
    assert (s.kafka_topic, s.max_files, s.trigger_seconds) == ("t2", 7, 8)
    assert s.object_store_conf()["spark.hadoop.fs.s3a.endpoint"] == "http://h:9000"
    assert JobSettings.from_env({}).object_store_conf() == {}


def test_work_dir_is_under_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(f"{base}/")
