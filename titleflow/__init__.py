"""titleflow: a catalogue-of-titles analytics and prediction pipeline on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a small set of
DataFrames).  Sources and sinks live in :mod:`titleflow.sources`, column
helpers in :mod:`titleflow.functions`, table operators in
:mod:`titleflow.operators`, end-to-end jobs and the query registry in
:mod:`titleflow.plans`, and the incremental landing ingest in
:mod:`titleflow.streaming`.
"""

__version__ = "0.1.0"
