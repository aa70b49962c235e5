"""Edit-burst detection and news verification as Spark DataFrame operators."""

from burstwatch import functions, operators, plans, sources, streaming
from burstwatch.operators import detect, edits, features, news, report, verify
from burstwatch.session import session
from burstwatch.sources import sinks
from burstwatch.training import train

__all__ = [
    "detect", "edits", "features", "functions", "news", "operators", "plans",
    "report", "session", "sinks", "sources", "streaming", "train", "verify",
]
