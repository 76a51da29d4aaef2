"""lossgrid: loan-portfolio loss analytics as lazy Spark DataFrame operators."""

from lossgrid.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
