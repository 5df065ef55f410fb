"""Streaming: intentionally empty.

The job is a monthly batch over whole tables: it has no stream source, event-
time window, watermark or stateful step, so there is nothing to express with
Structured Streaming. Month-keyed idempotent loads (``sources.snapshots``)
cover the incremental part: each run replaces exactly its month.
"""
