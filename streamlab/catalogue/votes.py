"""Vote queries: events as votes (27 states from the user id, event type = candidate)."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamlab.catalogue import tables as t
from streamlab.config import work_dir
from streamlab.operators import tally
from streamlab.plans.votes import stamped, start_counts, tally_table
from streamlab.schemas import VOTE
from streamlab.sinks import encode_kafka
from streamlab.sources import decode_json, read_table_stream
from streamlab.streaming import run_stream

QUERIES, ORACLES, query = t.registry()

_A, _B = t.CANDIDATES
_BOARD_SQL = f"""
  SELECT estado, sum(CASE WHEN candidato = '{_A}' THEN votos ELSE 0 END)::BIGINT AS "{_A}",
         sum(CASE WHEN candidato = '{_B}' THEN votos ELSE 0 END)::BIGINT AS "{_B}"
  FROM ({t.VOTES_SQL}) GROUP BY estado"""
_WINNER_SQL = f"""
  SELECT *, CASE WHEN "{_A}" > "{_B}" THEN '{_A}' WHEN "{_B}" > "{_A}" THEN '{_B}'
                 ELSE 'EMPATE' END AS "VENCEDOR"
  FROM ({_BOARD_SQL})"""


def _tally(spark, sf_dir):
    return tally.running_count(t.votes(t.events(spark, sf_dir)), ["estado", "candidato"])


def _board(spark, sf_dir):
    return tally.winners_by_state(_tally(spark, sf_dir), t.CANDIDATES)


@query(
    """SELECT ((event_id - 1 + 500000) % 500000 + 1)::INTEGER AS id_urna, 'S' || (user_id % 27) AS estado, event_type AS candidato,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM events"""
)
def vote_decode(spark, sf_dir):
    """Votes encoded as keyed messages and decoded again."""
    return decode_json(encode_kafka(t.votes(t.events(spark, sf_dir)), "estado"), VOTE)


@query(
    """SELECT CASE WHEN event_type <> 'error' THEN 'S' || (user_id % 27) END AS estado,
    CASE WHEN event_type <> 'error' THEN event_type END AS candidato, count(*)::BIGINT AS votos
    FROM events GROUP BY 1, 2"""
)
def vote_malformed(spark, sf_dir):
    """Messages of error events are not JSON: they count under (NULL, NULL), none vanishes."""
    votes = t.votes(t.events(spark, sf_dir))
    text = F.to_json(F.struct(*votes.columns))
    broken = F.concat(F.lit("#"), text)
    value = F.when(F.col("candidato") == "error", broken).otherwise(text).cast("binary")
    messages = votes.select(value.alias("value"))
    return tally.running_count(decode_json(messages, VOTE), ["estado", "candidato"])


_DOCUMENTS_SQL = f"SELECT estado || '|' || candidato AS _id, estado, candidato, votos FROM ({t.VOTES_SQL})"


@query(_DOCUMENTS_SQL, stateful=True)
def vote_running_count(spark, sf_dir):
    """Stream of encoded messages: decoded, counted in update mode, upserted by key, read back."""
    base = work_dir(spark, "vote_count")
    table = tally_table(spark, f"{base}/apuracao")
    messages = encode_kafka(t.votes(t.events_stream(spark, sf_dir)), "estado")
    run_stream(start_counts(decode_json(messages, VOTE), table, f"{base}/checkpoint"))
    return table.read_current().drop("atualizado_em")


@query(_DOCUMENTS_SQL, stateful=True)
def vote_restart_count(spark, sf_dir):
    """The same count over three deliveries, the query stopped and restarted in between."""
    base = work_dir(spark, "vote_restart")
    ev = t.events(spark, sf_dir)
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    ev.withColumn("entrega", part).write.partitionBy("entrega").parquet(f"{base}/in")
    table = tally_table(spark, f"{base}/apuracao", compact_every=2)
    for n in range(3):
        stream = read_table_stream(spark, f"{base}/in/entrega=[0-{n}]", "*", t.EVENTS)
        run_stream(start_counts(t.votes(stream), table, f"{base}/checkpoint"))
    return table.read_current().drop("atualizado_em")


@query(
    """SELECT estado || '|' || candidato AS _id, estado, candidato, votos FROM (
      SELECT 'S' || (user_id % 27) AS estado, event_type AS candidato, count(*)::BIGINT AS votos
      FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2)"""
)
def vote_reset(spark, sf_dir):
    """A tally that is reset between two elections holds the second one only."""
    base = work_dir(spark, "vote_reset")
    table = tally_table(spark, f"{base}/apuracao")
    for n in (0, 1):
        table.reset()
        votes = t.votes(t.events(spark, sf_dir).where(F.col("event_id") % 2 == n))
        table.upsert(stamped(tally.running_count(votes, ["estado", "candidato"])), 0)
    return table.read_current().drop("atualizado_em")


@query(_DOCUMENTS_SQL)
def vote_documents(spark, sf_dir):
    return tally.tally_documents(_tally(spark, sf_dir))


@query(
    f"""SELECT coalesce(d.candidato, v.candidato) AS candidato, coalesce(sum(votos), 0)::BIGINT AS votos
    FROM ({t.VOTES_SQL}) v FULL OUTER JOIN (VALUES ('{_A}'), ('{_B}'), ('AUSENTE')) d(candidato)
    ON d.candidato = v.candidato GROUP BY 1"""
)
def vote_national_total(spark, sf_dir):
    """Listed candidates always appear (one of them has no vote), unknown ones stay."""
    return tally.national_total(_tally(spark, sf_dir), (*t.CANDIDATES, "AUSENTE"))


@query(
    f"""SELECT a AS votos_a, b AS votos_b,
    CASE WHEN a > b THEN '{_A}' WHEN b > a THEN '{_B}' ELSE 'EMPATE' END AS lider
    FROM (SELECT count(*) FILTER (WHERE event_type = '{_A}')::BIGINT AS a,
                 count(*) FILTER (WHERE event_type = '{_B}')::BIGINT AS b FROM events)"""
)
def vote_leader(spark, sf_dir):
    return tally.leader(tally.national_total(_tally(spark, sf_dir), t.CANDIDATES), t.CANDIDATES)


@query(f"SELECT candidato, sum(votos)::BIGINT AS votos FROM ({t.VOTES_SQL}) GROUP BY 1 ORDER BY votos DESC, candidato")
def vote_ranked_total(spark, sf_dir):
    return tally.ranked_total(_tally(spark, sf_dir))


@query(f"{_WINNER_SQL} ORDER BY estado")
def vote_pivot_winner(spark, sf_dir):
    return _board(spark, sf_dir).orderBy("estado")


@query(f'SELECT estado, "{_A}", "{_B}" FROM ({_BOARD_SQL}) ORDER BY "{_A}", estado')
def vote_pivot_sorted(spark, sf_dir):
    board = tally.pivot_sum(_tally(spark, sf_dir), "estado", "candidato", t.CANDIDATES, "votos")
    return board.orderBy(_A, "estado")


@query(
    f"""SELECT count(*) FILTER (WHERE "VENCEDOR" = '{_A}')::BIGINT AS estados_a,
    count(*) FILTER (WHERE "VENCEDOR" = '{_B}')::BIGINT AS estados_b,
    count(*) FILTER (WHERE "VENCEDOR" = 'EMPATE')::BIGINT AS empates FROM ({_WINNER_SQL})"""
)
def vote_states_won(spark, sf_dir):
    return tally.states_won(_board(spark, sf_dir), t.CANDIDATES)


@query(
    f"""SELECT a AS votos_a, b AS votos_b,
    CASE WHEN a > b THEN '{_A}' WHEN b > a THEN '{_B}' ELSE 'EMPATE' END AS campeao
    FROM (SELECT sum("{_A}")::BIGINT AS a, sum("{_B}")::BIGINT AS b FROM ({_WINNER_SQL}))"""
)
def vote_champion(spark, sf_dir):
    return tally.champion(_board(spark, sf_dir), t.CANDIDATES)
