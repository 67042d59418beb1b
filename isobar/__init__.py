"""Spark-native analytics for timestamped sensor readings keyed by place.

Everything is a plain ``DataFrame -> DataFrame`` function, usable with
``df.transform``; writes live in :mod:`isobar.sinks`, streams in
:mod:`isobar.streaming` and whole jobs in :mod:`isobar.plans.jobs`.
"""
