from .scoring_stream import score_stream, drain_to_sink  # noqa: F401
