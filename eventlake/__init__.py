"""eventlake: a Spark-native bronze / silver / gold event warehouse.

Raw JSON activity events land as text, are classified and deduplicated into
bronze, extracted and typed into silver, and conformed into a star schema in
gold (date, actor, repo and event-type dimensions plus an immutable fact
table) that is published all-or-nothing above an incremental high-water mark.

Everything is expressed with DataFrame / SQL operators; there are no UDFs.
"""

from eventlake.session import build_session, configure, scratch_root
from eventlake.plans.warehouse import Warehouse

__all__ = ["build_session", "configure", "scratch_root", "Warehouse"]
