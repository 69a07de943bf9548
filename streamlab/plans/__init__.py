"""The five end-to-end flows, each runnable with ``spark-submit`` (``python -m``)."""
