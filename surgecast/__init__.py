"""surgecast: network-congestion SMS campaign targeting on Spark.

The same DataFrame -> DataFrame stages serve batch jobs and Structured
Streaming queries:

    decode -> clean -> dedup -> aggregate -> enrich -> candidates -> decide -> alerts

Sub-packages:

* ``sources``   - event decoding/encoding, reference tables, stream sources, fixtures
* ``operators`` - cleaning, de-duplication, windows, joins, decisions, reports
* ``functions`` - fixed business values and reusable column expressions
* ``plans``     - the composed batch chain and the named query catalogue
* ``streaming`` - the micro-batch pipeline and its idempotent sinks
"""

from surgecast.config import CampaignConfig

__all__ = ["CampaignConfig"]
