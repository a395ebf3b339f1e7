"""dropgate: data preboarding on Spark.

Registries (file-name glob → rules) compile to lazy DataFrame plans that
validate, transform, route and deliver third-party data drops; every outcome
is a row of the ``findings`` table. See README.md.

Main entry points:

* ``dropgate.plans.stages.Preboarding`` — a run over a folder of files;
* ``dropgate.operators.checks.run_checks`` / ``@check`` — validators;
* ``dropgate.operators.transforms.apply_chain`` / ``@transform`` — transforms;
* ``dropgate.sources.files.read_drop`` and ``dropgate.sources.catalog.Catalog``.
"""

__version__ = "0.1.0"
