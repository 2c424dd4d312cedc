"""Query registry: every operator key with its Spark builder and SQL twin.

Importing the package loads every section so ``registry.QUERIES`` and
``registry.ORACLE`` are complete whatever module is imported first.
"""

from churnlab.plans import registry  # noqa: F401
from churnlab.plans import q_prepare  # noqa: F401
from churnlab.plans import q_evaluate  # noqa: F401
from churnlab.plans import q_drift  # noqa: F401
from churnlab.plans import q_cluster  # noqa: F401
from churnlab.plans import q_model  # noqa: F401
from churnlab.plans import q_stream  # noqa: F401
