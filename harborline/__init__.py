"""harborline: maritime-traffic statistics and vessel-message analytics on Spark.

Everything here builds lazy DataFrame plans; writers are separate functions so
that each plan can be inspected with ``explain`` before anything is written.
"""

__version__ = "0.1.0"
