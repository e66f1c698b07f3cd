"""cohortline: threshold-based audience selection on Spark DataFrames.

Typical use::

    from cohortline import build_session, load_sources, invitation_list
    spark = build_session()                     # or the platform's session on a cluster
    src = load_sources(spark, "/path/to/tables")
    people = invitation_list(src, "2024-01-21", 300, "bo_turnover_usd", 5, 1000)
"""

from cohortline.operators.thresholds import estimate_thresholds
from cohortline.params import Scope, SummarySpec
from cohortline.plans.invitations import (invitation_list, invitation_list_range,
                                          multi_metric_invitations)
from cohortline.plans.summary import (daily_summary, snapshot_summary, spec_v1, spec_v2, spec_v3,
                                      spec_v4, spec_v5)
from cohortline.session import build_session
from cohortline.sources import Sources, load_sources, register_view, save_table

__version__ = "0.1.0"

__all__ = [
    "Scope", "Sources", "SummarySpec", "build_session", "daily_summary", "estimate_thresholds",
    "invitation_list", "invitation_list_range", "load_sources", "multi_metric_invitations",
    "register_view", "save_table", "snapshot_summary", "spec_v1", "spec_v2", "spec_v3", "spec_v4",
    "spec_v5",
]
