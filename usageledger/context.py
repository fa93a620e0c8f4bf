"""Who asks, for which account, and what time it is.

Every operator takes the context as an argument instead of calling
``current_user()`` or ``current_timestamp()``, so that a report run twice with
the same context gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime

#: Role that may read organization-wide prices and usage.
REPORT_SERVICE_ROLE = "REPORT_SERVICE"


@dataclass(frozen=True)
class ReportContext:
    as_of: datetime
    user: str = "ANALYST"
    roles: tuple[str, ...] = ()
    account: str = "ACC_0"
    region: str = "R1"
    organization: str = "ORG"

    @property
    def today(self) -> date:
        return self.as_of.date()

    def has_role(self, role: str) -> bool:
        return role.lower() in {r.lower() for r in self.roles}

    def at(self, as_of: datetime) -> "ReportContext":
        return replace(self, as_of=as_of)
