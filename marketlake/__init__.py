"""marketlake: a Spark-native market-data lake.

Landing files are normalised into typed tables, cleaned and de-duplicated by
the same DataFrame functions in batch and in Structured Streaming, prices are
back-adjusted for splits and bonuses, daily market breadth and put-call ratios
are aggregated, and parametrised serving queries run over the results.

Every public function takes and returns DataFrames; nothing is collected to
the driver except small, size-checked metadata.
"""

from marketlake.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
