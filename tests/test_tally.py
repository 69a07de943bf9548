import random
from collections import Counter

from conftest import rows

from streamlab.operators import tally

CANDS = ("HOMER SIMPSON", "SPOCK")
H, S = CANDS


def board(spark, data):
    return spark.createDataFrame(data, "estado string, candidato string, votos long")


def test_total_keeps_unknown_and_lists_absent(spark):
    df = board(spark, [("SP", H, 3), ("RJ", H, 2), ("SP", "OUTRO", 4), (None, None, 1)])
    got = {r.candidato: r.votos for r in tally.national_total(df).collect()}
    assert got == {H: 5, S: 0, "OUTRO": 4, None: 1}


def test_fill_domain_can_drop_unknown(spark):
    df = board(spark, [("SP", H, 3), ("SP", "OUTRO", 4), ("SP", None, 2)])
    got = tally.fill_domain(df, "candidato", CANDS, ["votos"], keep_unknown=False)
    assert rows(got, "candidato") == [(H, 3), (S, 0)]


def test_ranked_total(spark):
    df = board(spark, [("SP", H, 3), ("RJ", H, 2), ("SP", S, 5), ("SP", "OUTRO", 9)])
    assert rows(tally.ranked_total(df)) == [("OUTRO", 9), (H, 5), (S, 5)]


def test_pivot_drops_unknown_columns_keeps_rows(spark):
    df = board(
        spark,
        [("SP", H, 3), ("SP", H, 1), ("RJ", S, 2), ("MG", "OUTRO", 7), (None, H, 9), ("BA", None, 4)],
    )
    got = tally.pivot_sum(df, "estado", "candidato", CANDS, "votos")
    assert got.columns == ["estado", H, S]
    assert rows(got, "estado") == [("MG", 0, 0), ("RJ", 0, 2), ("SP", 4, 0)]


def test_winner_tie_states_and_champion(spark):
    df = board(spark, [("SP", H, 3), ("SP", S, 1), ("RJ", S, 2), ("MG", H, 2), ("MG", S, 2), ("AC", H, 1)])
    winners = tally.winners_by_state(df)
    assert {r.estado: r.VENCEDOR for r in winners.collect()} == {"SP": H, "RJ": S, "MG": "EMPATE", "AC": H}
    assert rows(tally.states_won(winners)) == [(2, 1, 1)]
    assert rows(tally.champion(winners)) == [(6, 5, H)]


def test_leader_counts_votes_without_a_state(spark):
    df = board(spark, [("SP", H, 3), ("SP", S, 2), (None, S, 2), ("SP", "OUTRO", 9)])
    assert rows(tally.leader(tally.national_total(df))) == [(3, 4, S)]
    assert rows(tally.champion(tally.winners_by_state(df))) == [(3, 2, H)]


def test_empty_tally(spark):
    df = board(spark, [])
    assert rows(tally.champion(tally.winners_by_state(df))) == [(0, 0, "EMPATE")]
    assert rows(tally.national_total(df), "candidato") == [(H, 0), (S, 0)]


def test_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(1)
    names, states = [H, S, "X", None], ["SP", "RJ", "AC", None]
    votes = [("SP", H) if rng.random() < 0.4 else (rng.choice(states), rng.choice(names)) for _ in range(3000)]
    df = spark.createDataFrame(votes, "estado string, candidato string").repartition(8)
    counts = tally.running_count(df, ["estado", "candidato"])
    assert {(r.estado, r.candidato): r.votos for r in counts.collect()} == dict(Counter(votes))
    want = Counter(c for _, c in votes)
    assert {r.candidato: r.votos for r in tally.national_total(counts).collect()} == dict(want)


def test_documents(spark):
    df = board(spark, [("SP", H, 3), (None, None, 1)])
    got = {r._id: r.votos for r in tally.tally_documents(df).collect()}
    assert got == {f"SP|{H}": 3, "None|None": 1}
