import random

from conftest import rows
from pyspark.sql import functions as F

from streamlab.operators import sentiment as s
from streamlab.plans.posts import sentiment
from streamlab.schemas import POST

TEXTS = {
    "5": "Vitória! Sucesso, recorde: cidade VENCE",
    "4": "bom bom triste bom, bom, pior",
    "3": "nada de novo",
    "3b": "bom e triste",
    "2": "bom dia triste pior",
    "1": "Acidente grave: feridos",
    "empty": "",
    "null": None,
    "inside": "bomba goodness",
}


def posts(spark, texts):
    return spark.createDataFrame([(k, t, None) for k, t in texts.items()], "id string, texto string, criado_em string")


def test_every_star_null_and_empty(spark):
    got = {r.id: (r.estrelas, r.sentimento, r.confianca) for r in sentiment(posts(spark, TEXTS)).collect()}
    assert got == {
        "5": (5, "POSITIVO", 0.833),
        "4": (4, "POSITIVO", 0.625),
        "3": (3, "NEUTRO", 0.5),
        "3b": (3, "NEUTRO", 0.5),
        "2": (2, "NEGATIVO", 0.6),
        "1": (1, "NEGATIVO", 0.8),
        "empty": (3, "NEUTRO", 0.5),
        "null": (None, None, None),
        "inside": (3, "NEUTRO", 0.5),
    }


def test_whole_text_counts_unless_a_bound_is_set(spark):
    late = {"a": "x " * 300 + "acidente", "b": "y" * 511 + " bom"}
    whole = {r.id: r.sentimento for r in sentiment(posts(spark, late)).collect()}
    cut = {r.id: r.sentimento for r in sentiment(posts(spark, late), max_chars=512).collect()}
    assert whole == {"a": "NEGATIVO", "b": "POSITIVO"} and cut == {"a": "NEUTRO", "b": "NEUTRO"}


def test_hosted_model_equals_column_scorer(spark):
    rng = random.Random(4)
    vocabulary = [*s.POSITIVE_WORDS, *s.NEGATIVE_WORDS, "casa", "É", "ação", "x1y", "São-Paulo"]
    texts = TEXTS | {f"r{n}": " ".join(rng.choices(vocabulary, k=rng.randrange(12))) for n in range(300)}
    df = posts(spark, texts).repartition(3)
    assert rows(sentiment(df), "id") == rows(sentiment(df, load_model=s.lexicon_model), "id")


def test_custom_model(spark):
    def load():
        return lambda texts: [("4 stars" if "ok" in t else "1 star", 0.98765) for t in texts]

    got = rows(sentiment(posts(spark, {"a": "ok", "b": "no", "c": None}), load_model=load).drop("texto"), "id")
    assert got == [("a", "POSITIVO", 4, 0.988), ("b", "NEGATIVO", 1, 0.988), ("c", None, None, None)]


def test_distribution_lists_all_labels_and_counts_all_rows(spark):
    df = sentiment(posts(spark, {"a": "bom", "b": "bom", "c": None}))
    got = {r.sentimento: r.total for r in s.label_distribution(df).collect()}
    assert got == {"POSITIVO": 2, "NEUTRO": 0, "NEGATIVO": 0, None: 1}


def test_share_skips_labels_without_rows(spark):
    df = sentiment(posts(spark, {"a": "bom", "b": "bom", "c": "triste"}))
    got = {r.sentimento: r.percentual for r in s.label_share(s.label_distribution(df)).collect()}
    assert got == {"POSITIVO": 67, "NEGATIVO": 33}


def test_post_shape_fills_the_time(spark):
    df = spark.createDataFrame([(1, "t", None), (2, "u", "2024")], "n long, body string, at string")
    got = s.shape_posts(df, "n", "body", "at")
    assert got.columns == POST.names
    assert got.where(F.col("criado_em").isNull()).count() == 0
    assert rows(got.where("id = '2'")) == [("2", "u", "2024")]
