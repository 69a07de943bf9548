"""Record schemas of the five flows, sink contracts and the fixed value domains."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _DBL, _INT, _LONG, _TS = (
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.TimestampType(),
)
_MONEY = T.DecimalType(18, 4)


def _schema(*columns: tuple) -> T.StructType:
    """(name, type) is optional, (name, type, "required") must not be NULL."""
    return T.StructType([T.StructField(c[0], c[1], len(c) == 2) for c in columns])


# Input records.
QUOTE = _schema(
    ("ticker", _STR, "required"),
    ("preco", _DBL, "required"),
    ("abertura", _DBL),
    ("maxima", _DBL),
    ("minima", _DBL),
    ("volume", _LONG),
    ("moeda", _STR),
    ("bolsa", _STR),
    ("coletado_em", _STR, "required"),
)
FLIGHT = _schema(
    ("voo", _STR),
    ("companhia", _STR, "required"),
    ("origem", _STR),
    ("destino", _STR),
    ("status", _STR),
    ("passageiros", _INT),
    ("atraso_min", _DBL),
    ("event_time", _STR, "required"),
)
VOTE = _schema(
    ("id_urna", _INT),
    ("estado", _STR, "required"),
    ("candidato", _STR, "required"),
    ("event_time", _STR),
)
PATIENT = _schema(
    ("glucose", _DBL, "required"), ("bmi", _DBL, "required"), ("outcome", _INT, "required")
)
POST = _schema(("id", _STR), ("texto", _STR, "required"), ("criado_em", _STR))
PATIENT_BASE = _schema(
    ("preg", _INT),
    ("glucose", _DBL),
    ("bp", _DBL),
    ("skin", _DBL),
    ("insulin", _DBL),
    ("bmi", _DBL),
    ("pedigree", _DBL),
    ("age", _INT),
    ("outcome", _INT),
)

# The columns of Spark's Kafka source.
KAFKA_ENVELOPE = _schema(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", _STR),
    ("partition", _INT),
    ("offset", _LONG),
    ("timestamp", _TS),
    ("timestampType", _INT),
)

# Sink contracts.
QUOTE_TABLE = _schema(
    ("ticker", _STR, "required"),
    ("preco", _MONEY, "required"),
    ("abertura", _MONEY),
    ("maxima", _MONEY),
    ("minima", _MONEY),
    ("volume", _LONG),
    ("moeda", _STR),
    ("bolsa", _STR),
    ("coletado_em", _TS, "required"),
)
FLIGHT_WINDOW_TABLE = _schema(
    ("companhia", _STR, "required"),
    ("janela_inicio", _TS, "required"),
    ("janela_fim", _TS, "required"),
    ("total_voos", _LONG, "required"),
    ("passageiros", _LONG),
    ("atraso_medio_min", _DBL),
)
TALLY_TABLE = _schema(
    ("_id", _STR, "required"), ("estado", _STR), ("candidato", _STR), ("votos", _LONG),
    ("atualizado_em", _TS),
)
SENTIMENT_TABLE = _schema(
    ("id", _STR), ("texto", _STR), ("sentimento", _STR), ("estrelas", _INT), ("confianca", _DBL)
)

# Closed domains that reports list even when no row carries them.
CANDIDATES = ("HOMER SIMPSON", "SPOCK")
SENTIMENTS = ("POSITIVO", "NEUTRO", "NEGATIVO")
TIE = "EMPATE"


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
