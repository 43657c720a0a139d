"""tessera: Spark-native operators for ML data tables and streams.

Every operator takes and returns a lazy ``DataFrame``; nothing is collected
on the driver except small metric tables at the very end of a job.
"""

from tessera.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
