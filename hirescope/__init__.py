"""hirescope: job-market analytics on the Spark DataFrame API.

Raw job-board feeds are cleaned, unified, enriched and aggregated into
market marts.  Every operator is a plain ``DataFrame -> DataFrame``
function; anything that depends on "today" takes an explicit ``as_of``
so a run can be reproduced.
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
