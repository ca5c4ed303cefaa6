"""Adaptive execution for the batch jobs inside a micro-batch."""

from contextlib import contextmanager

_ENABLED = "spark.sql.adaptive.enabled"


@contextmanager
def adaptive(batch):
    """Streaming queries switch adaptive execution off for their session, batch jobs included.

    Those jobs only see the finished rows of the micro-batch, so skewed joins can be split, small
    partitions coalesced and writes rebalanced; the streaming plan itself is left as it is.
    """
    conf = batch.sparkSession.conf
    before = conf.get(_ENABLED)
    conf.set(_ENABLED, "true")
    try:
        yield
    finally:
        conf.set(_ENABLED, before)
