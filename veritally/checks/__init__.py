"""Data-quality checks: functions from a DataFrame to the rows (or groups) that break a rule.

No rows means the check passed. A condition that is null passes unless the check says otherwise.
"""

from veritally.checks import (  # noqa: F401
    aggregates,
    distribution,
    multicolumn,
    shape,
    strings,
    values,
)
from veritally.checks.kernel import REGISTRY, register  # noqa: F401
from veritally.checks.suite import CheckSpec, run_suite  # noqa: F401
