"""Streams: the reference has no streaming operator.  Loads are functions of
two frames, so they run per micro-batch through ``foreachBatch``."""
