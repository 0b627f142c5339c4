"""Spark settings for the length of a block."""

from __future__ import annotations

from contextlib import contextmanager


@contextmanager
def conf(spark, **values):
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
