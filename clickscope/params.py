"""Report parameters (the task condition the offline reports run under)."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field


@dataclass(frozen=True)
class VisitParams:
    """Bounds of the visit filter.

    ``None`` or an empty string means "no bound". ``as_written`` reproduces the
    original predicate where the upper age bound was also tested with ``>=``.
    """

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    as_written: bool = False


@dataclass(frozen=True)
class ReportParams:
    visits: VisitParams = field(default_factory=VisitParams)
    target_page_flow: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7)


def _blank(v):
    return v is None or (isinstance(v, str) and v.strip() == "")


def parse_flow(text: str) -> tuple[int, ...]:
    """``"1,2,3"`` -> ``(1, 2, 3)``; tokens are trimmed, empty ones skipped."""
    return tuple(int(t.strip()) for t in text.split(",") if t.strip())


def parse_condition(text: str) -> ReportParams:
    """Read the condition object (JSON whose keys may be unquoted)."""
    # strings first, so that nothing inside one is taken for a key
    token = re.compile(r'("(?:[^"\\]|\\.)*")|([A-Za-z_][A-Za-z0-9_]*)(?=\s*:)')
    raw = json.loads(token.sub(lambda m: m.group(1) or f'"{m.group(2)}"', text))

    def age(k):
        v = raw.get(k)
        return None if _blank(v) else int(v)

    def date(k):
        v = raw.get(k)
        return None if _blank(v) else str(v)

    flow = raw.get("targetPageFlow")
    return ReportParams(
        visits=VisitParams(date("startDate"), date("endDate"), age("startAge"), age("endAge")),
        target_page_flow=parse_flow(flow) if not _blank(flow) else (),
    )


def parse_properties(text: str) -> dict[str, str]:
    """Java-style ``.properties``: ``key=value`` or ``key: value`` lines, ``#``/``!``
    comments, a trailing backslash continues the value on the next line
    (leading blanks of the continuation dropped)."""
    out: dict[str, str] = {}
    logical, buf = [], ""
    for raw in text.splitlines():
        line = raw.lstrip() if buf else raw.strip()
        if not buf and (not line or line[0] in "#!"):
            continue
        if line.endswith("\\") and not line.endswith("\\\\"):
            buf += line[:-1]
            continue
        logical.append(buf + line)
        buf = ""
    if buf:
        logical.append(buf)
    for line in logical:
        m = re.match(r"\s*([^=:\s]+)\s*[=:]\s*(.*)$", line)
        if m:
            out[m.group(1)] = m.group(2).strip()
    return out


CONDITION_KEY = "condition.params.json"


def condition_from_properties(text: str) -> ReportParams:
    """Report parameters from the condition ``.properties`` file text."""
    return parse_condition(parse_properties(text)[CONDITION_KEY])


def flow_pairs(flow: tuple[int, ...]) -> list[tuple[int, int]]:
    """Consecutive page pairs of a flow, duplicates removed, order kept."""
    seen, out = set(), []
    for a, b in zip(flow[:-1], flow[1:]):
        if (a, b) not in seen:
            seen.add((a, b))
            out.append((a, b))
    return out


# Parameters the registered queries run under (the driver's tables hold
# January 2024 events; customer ages span 10..59).
FILTER_PARAMS = VisitParams("2024-01-05", "2024-01-25", 20, 50)
REPORT_PARAMS = ReportParams(VisitParams("2024-01-01", "2024-12-31", 20, 50), (1, 2, 3, 4, 5, 6, 7))
REPORT_TASK_ID = "task-1"     # stamped on the registered task report
TASKS = ["task-1", "task-2"]  # of the registered table with the reports of two tasks
BLACKLIST_THRESHOLD = 100     # clicks per user, ad and day
TEST_THRESHOLD = 3            # the driver's data never reaches 100
BATCH_MS = 5000               # micro-batch width
WINDOW_MS = 60 * 60 * 1000    # last-hour window length
SLIDE_MS = 10 * 1000          # window slide (pane width)
