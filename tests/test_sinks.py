from datetime import datetime

import duckdb
import pytest
from conftest import rows

from streamlab.plans import posts, quotes
from streamlab.config import JobSettings
from streamlab.schemas import FLIGHT_WINDOW_TABLE, QUOTE_TABLE, SENTIMENT_TABLE
from streamlab.sinks import JdbcAppender, append_batch, append_csv, read_csv_results, table_ddl
from streamlab.sinks.jdbc import staging_ddl
from streamlab.streaming import run_stream

RESULTS = [
    ("1", 'linha um\nlinha "dois", com vírgula\r\n', "POSITIVO", 5, 0.9),
    ("2", "  espaços  ", "NEUTRO", 3, 0.5),
    ("3", "", "NEGATIVO", 1, 0.123),
    ("4", None, None, None, None),
    ("5", "barra \\ e \\N", "NEUTRO", 3, 0.5),
]


def test_csv_round_trip_and_replay(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame(RESULTS, SENTIMENT_TABLE)
    append_csv(df, path, 0)
    append_csv(df.limit(1), path, 1)
    append_csv(df.limit(1), path, 1)
    got = read_csv_results(spark, path, SENTIMENT_TABLE)
    assert rows(got.where("lote = 0").drop("lote"), "id") == RESULTS
    assert got.where("lote = 1").count() == 1
    header = next((tmp_path / "csv" / "lote=0").glob("part-*.csv")).read_text().splitlines()[0]
    assert header.replace('"', "") == "id,texto,sentimento,estrelas,confianca"


def test_parquet_append_replay(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (0, 1, 1):
        append_batch(spark.range(3), path, n)
    assert spark.read.parquet(path).count() == 6


def test_empty_batches_leave_no_folder(spark, tmp_path):
    df = spark.createDataFrame(RESULTS, SENTIMENT_TABLE)
    for n, batch in enumerate((df, df.where("estrelas > 9"), df.limit(0))):
        append_batch(batch, str(tmp_path / "t"), n)
        append_csv(batch, str(tmp_path / "c"), n)
    append_batch(df.limit(0), str(tmp_path / "t"), 3)
    assert {p.name for p in (tmp_path / "t").iterdir()} == {p.name for p in (tmp_path / "c").iterdir()} == {"lote=0"}


class DuckAppender(JdbcAppender):
    """The appender with its two database calls pointed at a DuckDB connection."""

    def __init__(self, con, *args, fail_after_stage=False, duplicate=False):
        super().__init__({}, *args)
        self.con, self.fail, self.duplicate = con, fail_after_stage, duplicate

    def insert(self, staged):
        frame = staged.toPandas()  # noqa: F841 - read by DuckDB under this name
        self.con.execute(f"CREATE OR REPLACE TABLE {self.staging_table} AS SELECT * FROM frame")
        if self.duplicate:  # a task that ran twice
            self.con.execute(f"INSERT INTO {self.staging_table} SELECT * FROM {self.staging_table} LIMIT 2")

    def execute(self, spark, statements):
        if self.fail:
            raise RuntimeError("connection lost")
        self.con.execute("BEGIN")
        for sql in statements:
            self.con.execute(sql)
        self.con.execute("COMMIT")


@pytest.fixture
def con():
    c = duckdb.connect()
    c.execute(
        "CREATE TABLE evolucao_voos (companhia VARCHAR NOT NULL, janela_inicio TIMESTAMP, janela_fim TIMESTAMP,"
        " total_voos BIGINT, passageiros BIGINT, atraso_medio_min DOUBLE, lote_id BIGINT)"
    )
    return c


def windows(spark, *companies):
    t = datetime(2024, 1, 1)
    data = [(c, t, t, 1, None, 0.5) for c in companies]
    return spark.createDataFrame(data, "companhia string, janela_inicio timestamp, janela_fim timestamp, total_voos long, passageiros long, atraso_medio_min double")


def stored(con):
    return con.execute("SELECT lote_id, companhia FROM evolucao_voos ORDER BY ALL").fetchall()


def test_jdbc_publish_is_exactly_once(spark, con, tmp_path):
    args = ("evolucao_voos", FLIGHT_WINDOW_TABLE, str(tmp_path / "stage"))
    sink = DuckAppender(con, *args, duplicate=True)
    sink(windows(spark, "GOL", "GOL", "TAP", None), 0)  # equal rows are real rows
    want = [(0, "GOL"), (0, "GOL"), (0, "TAP")]
    assert stored(con) == want
    sink(windows(spark, "GOL", "GOL", "TAP", None), 0)  # replay
    assert stored(con) == want
    with pytest.raises(RuntimeError):
        DuckAppender(con, *args, fail_after_stage=True)(windows(spark, "AZUL"), 1)
    assert stored(con) == want
    sink(windows(spark, "AZUL"), 1)
    sink(windows(spark), 2)  # empty batch
    assert stored(con) == want + [(1, "AZUL")]
    rejected = spark.read.parquet(str(tmp_path / "stage" / "lote=0" / "valida=false"))
    assert [r.motivos for r in rejected.collect()] == [["companhia ausente"]]


def test_target_ddl():
    (create,) = table_ddl(QUOTE_TABLE, "cotacoes", "mysql", ("ticker", "coletado_em"))
    assert "ticker VARCHAR(255) NOT NULL" in create and "preco DECIMAL(18,4) NOT NULL" in create
    assert "abertura DECIMAL(18,4)," in create and "processado_em TIMESTAMP DEFAULT" in create
    assert "INDEX idx_cotacoes_lote (lote_id)" in create and "(ticker, coletado_em)" in create
    create, by_batch, index = table_ddl(
        FLIGHT_WINDOW_TABLE, "evolucao_voos", "postgresql", ("companhia", "janela_inicio")
    )
    assert "id BIGSERIAL PRIMARY KEY" in create and "atraso_medio_min DOUBLE PRECISION," in create
    assert by_batch.endswith("ON evolucao_voos (lote_id)") and index.endswith("(companhia, janela_inicio)")


def test_staging_table_has_the_types_of_the_target():
    drop, create = staging_ddl(FLIGHT_WINDOW_TABLE, "evolucao_voos_stage", "mysql")
    assert drop == "DROP TABLE IF EXISTS evolucao_voos_stage"
    assert "janela_inicio DATETIME(6)" in create and "companhia VARCHAR(255)" in create and "_linha BIGINT NOT NULL" in create
    _, create = staging_ddl(FLIGHT_WINDOW_TABLE, "evolucao_voos_stage", "postgresql")
    assert "janela_inicio TIMESTAMP," in create and "ZONE" not in create


def test_quote_flow_end_to_end(spark, deliver, tmp_path):
    folder = deliver("q", {"ticker": "A", "preco": 1.0, "coletado_em": "2024-01-01 00:00:01"})
    deliver("q", {"ticker": "B", "preco": 2.0, "coletado_em": "bad"})
    settings = JobSettings(stream_dir=folder, output_dir=str(tmp_path / "o"), trigger_seconds=0)
    out = str(tmp_path / "quotes")
    run_stream(quotes.start(spark, settings, handler=lambda b, n: append_batch(b, out, n)))
    assert rows(quotes.report(spark.read.parquet(out)).select("ticker", "coletado_em")) == [
        ("A", datetime(2024, 1, 1, 0, 0, 1)), ("B", None),
    ]


def test_post_flow_end_to_end(spark, deliver, tmp_path):
    folder = deliver("p", {"id": "1", "texto": "Time vence e bate recorde"})
    deliver("p", {"id": "2", "texto": "Acidente grave deixa feridos"})
    settings = JobSettings(stream_dir=folder, output_dir=str(tmp_path / "o"), trigger_seconds=0)
    run_stream(posts.start(spark, settings))
    got = read_csv_results(spark, str(tmp_path / "o" / "sentimentos"), SENTIMENT_TABLE)
    assert rows(got.select("lote", "id", "sentimento"), "id") == [(0, "1", "POSITIVO"), (0, "2", "NEGATIVO")]
