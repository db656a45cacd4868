"""degraus: layered (Bronze, Silver, Gold) indicator analytics on Spark DataFrames."""

from degraus.session import get_session, scratch_dir, stored

__all__ = ["get_session", "scratch_dir", "stored"]
