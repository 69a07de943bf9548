"""Text sentiment: a column-only lexicon scorer, a host for user models, and label reports."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.functions import head_chars, round_decimal, star_count, star_label
from streamlab.operators.tally import fill_domain
from streamlab.schemas import SENTIMENTS

# Opinion words of the built-in scorer (Portuguese, English, Spanish, French,
# German), lower case.
POSITIVE_WORDS = (
    "amplia", "avança", "bom", "boa", "conquista", "conquistam", "cresce", "excelente", "feliz",
    "ganha", "lidera", "melhor", "ótimo", "recorde", "sucesso", "vence", "vitória",
    "best", "better", "excellent", "good", "great", "happy", "love", "success", "win", "wonderful",
    "bueno", "buena", "éxito", "mejor", "feliz", "gana",
    "bon", "bonne", "excellent", "heureux", "meilleur", "succès",
    "beste", "besser", "erfolg", "glücklich", "gut", "schön",
)
NEGATIVE_WORDS = (
    "acidente", "alagamentos", "assalto", "crise", "destrói", "falta", "feridos", "grave", "incêndio",
    "morte", "pior", "queda", "reclama", "ruim", "triste", "violência",
    "awful", "bad", "crisis", "disgusting", "fail", "hate", "horrible", "idiot", "loser", "moron",
    "pathetic", "poor", "scum", "stupid", "terrible", "trash", "worst", "worthless",
    "accidente", "malo", "mala", "muerte", "peor",
    "accident", "mauvais", "mort", "pire",
    "schlecht", "schlimm", "tod", "unfall",
)
NOT_LETTERS = r"[^\p{L}]+"


def shape_posts(df: DataFrame, id_col: str, text_col: str, created_col: str, now: Column | None = None) -> DataFrame:
    """Raw records -> {id, texto, criado_em}; a missing creation time becomes ``now``."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if now is None else now
    return df.select(
        F.col(id_col).cast("string").alias("id"),
        F.col(text_col).alias("texto"),
        F.coalesce(F.col(created_col).cast("string"), now).alias("criado_em"),
    )


def _stars(pos: Column, neg: Column) -> Column:
    # balance (pos-neg)/(pos+neg) cut at -0.6, -0.2, 0.2, 0.6, multiplied out to integers
    diff, total = (pos - neg) * 5, pos + neg
    return (
        F.when(diff < -total, F.when(diff <= -3 * total, 1).otherwise(2))
        .when(diff <= total, 3)
        .when(diff < 3 * total, 4)
        .otherwise(5)
    )


def lexicon_score(
    df: DataFrame,
    text_col: str = "texto",
    max_chars: int | None = None,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> DataFrame:
    """Add ``rotulo_modelo`` ("4 stars") and ``score`` from counts of opinion words.

    No explode, join or UDF: a text is split, cut down to its opinion words and counted
    inside one row. NULL text gives NULL; text without opinion words is neutral.
    """
    text = head_chars(text_col, max_chars) if max_chars else F.col(text_col)
    positive, negative = sorted(set(positive)), sorted(set(negative))
    words = F.split(F.lower(text), NOT_LETTERS)
    opinion = df.withColumn("_w", F.filter(words, lambda w: w.isin(*positive, *negative)))
    counted = opinion.withColumn(
        "_p", F.size(F.filter("_w", lambda w: w.isin(*positive)))
    ).withColumn("_n", F.size("_w") - F.col("_p"))
    known = F.col(text_col).isNotNull()
    pos, neg = F.col("_p"), F.col("_n")
    share = (F.greatest(pos, neg) + 1) / (pos + neg + 2)
    return counted.withColumns(
        {
            "rotulo_modelo": F.when(known, F.concat(_stars(pos, neg).cast("string"), F.lit(" stars"))),
            "score": F.when(known, share),
        }
    ).drop("_w", "_p", "_n")


def lexicon_model() -> Callable[[Sequence[str]], list[tuple[str, float]]]:
    """The same rule as a model object, for hosts that load one per Python worker."""
    positive, negative = frozenset(POSITIVE_WORDS), frozenset(NEGATIVE_WORDS)
    letters = re.compile(r"[^\W\d_]+")

    def score(texts: Sequence[str]) -> list[tuple[str, float]]:
        out = []
        for text in texts:
            words = letters.findall(text.lower())
            pos = sum(w in positive for w in words)
            neg = sum(w in negative for w in words)
            diff, total = 5 * (pos - neg), pos + neg
            cuts = (diff > -3 * total, diff >= -total, diff > total, diff >= 3 * total)
            stars = 1 + sum(cuts) if total else 3
            out.append((f"{stars} stars", (max(pos, neg) + 1) / (total + 2)))
        return out

    return score


def model_score(
    df: DataFrame,
    load_model: Callable[[], Callable[[Sequence[str]], list[tuple[str, float]]]],
    text_col: str = "texto",
    max_chars: int | None = None,
) -> DataFrame:
    """Add ``rotulo_modelo`` and ``score`` from a user model, one Arrow batch at a time.

    ``load_model`` runs once per task; the object it returns maps a list of texts to
    (label, score) pairs. NULL texts are not passed to it and stay NULL.
    """

    @F.pandas_udf("label string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for texts in batches:
            out = pd.DataFrame({"label": None, "score": None}, index=texts.index)
            known = texts.dropna()
            if len(known):
                out.loc[known.index, ["label", "score"]] = model(known.tolist())
            yield out.astype({"label": "object", "score": "float64"})

    text = head_chars(text_col, max_chars) if max_chars else F.col(text_col)
    scored = df.withColumn("_m", run(text))
    return scored.withColumns(
        {"rotulo_modelo": F.col("_m.label"), "score": F.col("_m.score")}
    ).drop("_m")


def classify(scored: DataFrame) -> DataFrame:
    """Model label and score -> sentiment, stars and confidence (3 digits)."""
    return scored.withColumns(
        {
            "estrelas": star_count("rotulo_modelo"),
            "sentimento": star_label(star_count("rotulo_modelo")),
            "confianca": round_decimal("score", 3),
        }
    ).drop("rotulo_modelo", "score")


def label_distribution(df: DataFrame, label: str = "sentimento") -> DataFrame:
    """Rows per sentiment, every label listed; rows without a label are counted as NULL."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("total"))
    return fill_domain(counts, label, SENTIMENTS, ["total"])


def label_share(distribution: DataFrame, label: str = "sentimento") -> DataFrame:
    """Labels that occur, with their whole-percent share of all labelled rows."""
    everything = F.sum("total").over(Window.partitionBy())  # over one row per label
    share = (F.col("total") * 100).cast("decimal(28,6)") / everything
    return distribution.where(F.col("total") > 0).select(
        label, "total", F.round(share, 0).cast("bigint").alias("percentual")
    )
