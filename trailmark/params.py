"""Job parameters as stored in a task row's JSON."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

# The parameter names users put into a task's JSON.
PARAM_FIELDS = {
    "start_date": "startDate",
    "end_date": "endDate",
    "start_age": "startAge",
    "end_age": "endAge",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "category_ids": "categoryIds",
    "page_flow": "targetPageFlow",
}


_ID = re.compile(r"-?[0-9]+")


class ParamError(ValueError):
    """A task or one of its parameters is missing or unreadable."""


def _items(text: str | None) -> tuple[str, ...] | None:
    if text is None:
        return None
    return tuple(part for part in text.split(",") if part != "")


def _whole(text: str, name: str) -> int:
    try:
        return int(text)
    except ValueError:
        raise ParamError(f"{name} must be a whole number, got {text!r}") from None


@dataclass(frozen=True)
class JobParams:
    """``None`` means the parameter is absent; a criterion is applied only if present."""

    task_id: int = 0
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[int, ...] | None = None
    page_flow: tuple[int, ...] | None = None

    @classmethod
    def from_task_json(cls, text: str | None, task_id: int = 0) -> JobParams:
        """Each value is the first element of a JSON array; lists are comma text in it."""
        try:
            fields = json.loads(text) if text else None
        except ValueError:
            raise ParamError(f"task {task_id}: parameters are not JSON") from None
        if not isinstance(fields, dict):
            raise ParamError(f"task {task_id}: no parameters")
        values = {}
        for ours, theirs in PARAM_FIELDS.items():
            array = fields.get(theirs)
            if array is not None and not isinstance(array, list):
                raise ParamError(f"task {task_id}: {theirs} must be an array")
            first = array[0] if array else None
            values[ours] = None if first in (None, "") else str(first)
        return cls.from_text(task_id=task_id, **values)

    @classmethod
    def from_text(cls, task_id: int = 0, **values: str | None) -> JobParams:
        ages = {
            name: None if values.get(name) is None else _whole(values[name], name)
            for name in ("start_age", "end_age")
        }
        # An id that is no number cannot match anything, but the list still applies.
        ids = _items(values.get("category_ids"))
        if ids is not None:
            ids = tuple(int(i) for i in ids if _ID.fullmatch(i) and abs(int(i)) < 2**63)
        flow = _items(values.get("page_flow"))
        if flow is not None:
            flow = tuple(_whole(page, "page_flow") for page in flow)
        return cls(
            task_id=task_id,
            start_date=values.get("start_date"),
            end_date=values.get("end_date"),
            professionals=_items(values.get("professionals")),
            cities=_items(values.get("cities")),
            sex=values.get("sex"),
            keywords=_items(values.get("keywords")),
            category_ids=ids,
            page_flow=flow,
            **ages,
        )

    def required_page_flow(self) -> tuple[int, ...]:
        if not self.page_flow:
            raise ParamError(f"task {self.task_id}: targetPageFlow is missing")
        return self.page_flow
