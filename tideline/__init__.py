"""Layered retail warehouse on Spark: change events and page logs in, facts, metrics and profiles out.

Every transform is ``DataFrame -> DataFrame``. Batch forms are built from aggregates that combine before
the shuffle, so a single busy key never lands in one task; streaming forms use watermarks and keyed state.
"""

__version__ = "0.1.0"
