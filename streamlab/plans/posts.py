"""Posts: watched JSON folder -> sentiment per post -> accumulated CSV."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from streamlab.config import JobSettings, build_session
from streamlab.operators.sentiment import classify, lexicon_score, model_score
from streamlab.schemas import POST, SENTIMENT_TABLE
from streamlab.sinks import append_csv
from streamlab.sources import read_json_stream
from streamlab.streaming import run_stream, start_batches

def sentiment(
    posts: DataFrame, load_model: Callable | None = None, max_chars: int | None = None
) -> DataFrame:
    """Score whole texts with the lexicon, or with a model loaded by ``load_model``.

    ``max_chars`` is for models with a bounded input (512 in the usual setting).
    """
    if load_model is None:
        scored = lexicon_score(posts, max_chars=max_chars)
    else:
        scored = model_score(posts, load_model, max_chars=max_chars)
    return classify(scored).select(*SENTIMENT_TABLE.names)


def start(
    spark: SparkSession, settings: JobSettings, load_model: Callable | None = None
) -> StreamingQuery:
    stream = read_json_stream(spark, settings.stream_dir, POST, *settings.pace())
    results = sentiment(stream, load_model, settings.max_chars or None)
    out = settings.output_dir
    return start_batches(
        results,
        lambda batch, n: append_csv(batch, f"{out}/sentimentos", n),
        settings.checkpoint_dir or f"{out}/checkpoint",
        seconds=settings.trigger_seconds or None,
    )


def main() -> None:
    settings = JobSettings.from_env(trigger_seconds=2)
    run_stream(start(build_session("sentimento", settings), settings))


if __name__ == "__main__":
    main()
