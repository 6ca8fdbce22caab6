"""Web-log behaviour analytics as Spark jobs.

Raw access and application logs are anonymised, generalised, loaded by key,
profiled, aggregated into fixed windows per client, scored by an isolation
forest, turned into threat scores with reasons, evaluated on synthetic
scenarios and read back as analyst views.
"""

__version__ = "0.1.0"
