from tablefit.streaming.scoring import read_stream, running_confusion, score_stream, start_confusion

__all__ = ["read_stream", "running_confusion", "score_stream", "start_confusion"]
