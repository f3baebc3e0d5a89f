"""veridq — data quality and personal-data governance as Spark DataFrame operators.

Every operator is a composition of built-in DataFrame / SQL expressions, so
Catalyst plans, fuses and distributes the work.  Entry points:

* :func:`veridq.operators.profile.profile`     — completeness, formats, issues
* :func:`veridq.operators.pii.detect_pii`      — PII classification / inventory
* :func:`veridq.operators.validate.validate`   — rule engine → ``failures``
* :func:`veridq.operators.clean.clean`         — normalise / fill / dedupe + audit
* :func:`veridq.operators.mask.mask`           — structure-preserving masking
* :func:`veridq.plans.pipeline.run_pipeline`   — all stages + run log + manifest
"""

__version__ = "0.1.0"
