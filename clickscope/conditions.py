"""Typed run condition: every field is optional and adds one conjunct.

Each field becomes a ``Column`` predicate (never pasted SQL text), split into
the predicates that read action columns and those that read the user
dimension, so Catalyst can push each to its own scan.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Condition:
    start_date: str | None = None          # yyyy-MM-dd, inclusive
    end_date: str | None = None            # yyyy-MM-dd, inclusive
    start_age: int | None = None           # inclusive
    end_age: int | None = None             # inclusive
    professionals: tuple[str, ...] = field(default_factory=tuple)
    city: int | None = None
    gender: str | None = None
    keywords: tuple[str, ...] = field(default_factory=tuple)
    category_ids: tuple[int, ...] = field(default_factory=tuple)
    target_page_flow: tuple[int, ...] = field(default_factory=tuple)

    def action_predicates(self, columns: list[str] | tuple[str, ...] = ()) -> list[Column]:
        """Predicates over action columns.

        Where the actions carry the zone-free timestamp ``ts`` that their
        ``date`` text is cut from, the date range is also given as the equal
        half-open range of ``ts``, which a scan can use to skip row groups.
        """
        preds = []
        if "ts" in columns and self.start_date:
            preds.append(F.col("ts") >= F.lit(self.start_date).cast("timestamp_ntz"))
        if "ts" in columns and self.end_date:
            day_after = date.fromisoformat(self.end_date) + timedelta(days=1)
            preds.append(F.col("ts") < F.lit(day_after.isoformat()).cast("timestamp_ntz"))
        if self.start_date:
            preds.append(F.col("date") >= F.lit(self.start_date))
        if self.end_date:
            preds.append(F.col("date") <= F.lit(self.end_date))
        if self.city is not None:
            preds.append(F.col("city_id") == F.lit(int(self.city)))
        if self.keywords:
            preds.append(F.col("search_keyword").isin(list(self.keywords)))
        if self.category_ids:
            preds.append(F.col("click_category_id").isin([int(c) for c in self.category_ids]))
        return preds

    def user_predicates(self) -> list[Column]:
        preds = []
        if self.start_age is not None:
            preds.append(F.col("age") >= F.lit(int(self.start_age)))
        if self.end_age is not None:
            preds.append(F.col("age") <= F.lit(int(self.end_age)))
        if self.professionals:
            preds.append(F.col("professional").isin(list(self.professionals)))
        if self.gender:
            preds.append(F.col("gender") == F.lit(self.gender))
        return preds

    def to_json(self) -> str:
        """Stable text of the set fields, stored next to results."""
        data = {k: (list(v) if isinstance(v, tuple) else v) for k, v in asdict(self).items()}
        data = {k: v for k, v in data.items() if v not in (None, [], "")}
        return json.dumps(data, sort_keys=True, ensure_ascii=False)


def conjunction(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds, F.lit(True))
