"""Query registry used by ``__spark_entry__``.

Every builder reads the driver's tables under ``sf_dir`` through the views
in ``fixtures`` and runs the library's operators over the whole tables.
"""

from __future__ import annotations

from tripwx.plans import q_ingest, q_io, q_ml, q_profile  # noqa: F401  (registration)
from tripwx.plans.register import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
