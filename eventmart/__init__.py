"""Raw shop events to a queryable star schema, as Spark jobs.

Entry points: :class:`eventmart.mart.Mart` (the stored star schema),
:func:`eventmart.plans.load.load_batch` (load a batch of events),
:mod:`eventmart.streaming.ingest` (the same load as a stream) and
:mod:`eventmart.plans.reports` (the reports).
"""
