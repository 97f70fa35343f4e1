"""tempora: bitemporal CDC logs to immutable daily GMV snapshots, on Spark.

Layers:
  RAW    append-only create/update/delete events carrying ``event_ts`` (when it
         happened) and ``ingestion_ts`` (when it arrived);
  SILVER latest known state of each entity as of a cutoff;
  GOLD   append-only daily snapshots of GMV per subsidiary, with as-of and
         current views, contribution margin, comparison and incremental runs.
"""

from tempora.session import get_session, scratch_path  # noqa: F401

__version__ = "0.1.0"
