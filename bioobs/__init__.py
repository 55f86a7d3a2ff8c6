"""bioobs: PySpark building blocks for biodiversity-observation tables.

Every public function takes and returns ``DataFrame`` or ``Column``; the plan
stays lazy, and Spark decides how it runs.
"""
