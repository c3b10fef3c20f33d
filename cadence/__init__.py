"""cadence: hourly-demand analytics and forecasting on Spark DataFrames.

Every operator takes and returns Spark DataFrames (or a fitted Spark ML model plus a
few driver-side scalars such as a learned mean). Sub-packages:

- ``sources``    table readers and writers, the F1-F4 fixture frames
- ``functions``  column expressions: features, target transforms, metrics
- ``operators``  splits, exact distributed ranks and quantiles, profiles, models,
                 validation, explanation, corrections and experiment harnesses
- ``plans``      the registered queries and their DuckDB oracle SQL
- ``streaming``  the stateless feature projection and hourly demand on a stream
"""

from cadence.session import get_session, scratch_path  # noqa: F401

__version__ = "0.1.0"
