"""scoreflow: lakehouse ETL and credit-risk scoring jobs as Spark DataFrame plans.

Sub-packages:

* ``sources``   — scans: Parquet (schema merging), SQL files over catalog
  tables, JDBC queries, generic table formats.
* ``sinks``     — date-partitioned lake writes, JDBC loads, load reports,
  metrics and model artifacts.
* ``functions`` — column-level helpers: text conversion, date windows, JSON
  envelopes, stable hashing.
* ``operators`` — DataFrame → DataFrame operators: filters, sampling,
  metrics, activity completion, feature building, ML stages.
* ``plans``     — the composite jobs (training run, loads, export, gate) and
  the derivation of job inputs from the test tables.
* ``streaming`` — the bronze ingestion stream.

``python -m scoreflow <job> ...`` runs a job from the command line
(``scoreflow.cli``); ``scoreflow.registry`` holds the registered queries.
"""

__version__ = "0.1.0"
