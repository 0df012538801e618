"""fleetlake: medallion toolkit for vehicle-telemetry pipelines on Spark.

Every operator takes DataFrames and returns a DataFrame; actions happen only
in sinks, in ``dq_enforce`` and in the small scalar look-ups of job control.
Stored times are UTC ``timestamp_ntz`` so results never depend on the session
time zone.
"""

__version__ = "0.1.0"
