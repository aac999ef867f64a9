"""tessera: labelled-image training and evaluation as Spark DataFrame operators.

Entry points: ``tessera.plans.job.run_job`` (the whole job),
``tessera.sources.images`` (image folders), ``tessera.operators`` (sampling,
batching, scoring, evaluation, averaging) and ``tessera.plans.models``
(network presets). ``__spark_entry__.py`` registers the checked queries.
"""
