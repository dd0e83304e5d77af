"""Ordered rule lists: data in, one CASE expression out.  The first rule that holds wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A rule is (condition in SQL, label).  A NULL condition does not hold.
Rule = tuple[str, str]


def case_text(rules: Sequence[Rule], default: str | None) -> str:
    """The CASE expression of a rule list, for ``F.expr`` or for a SQL user."""
    whens = " ".join(f"WHEN {condition} THEN '{label}'" for condition, label in rules)
    tail = "NULL" if default is None else f"'{default}'"
    return f"CASE {whens} ELSE {tail} END"


def nested_case_text(
    selector: str, groups: Mapping[str, Sequence[Rule]], default: str | None
) -> str:
    """One rule list per value of ``selector``; values without a list get the default."""
    whens = " ".join(
        f"WHEN {selector} = '{name}' THEN {case_text(rules, default)}"
        for name, rules in groups.items()
    )
    tail = "NULL" if default is None else f"'{default}'"
    return f"CASE {whens} ELSE {tail} END"


def classify(rules: Sequence[Rule], default: str | None = None) -> Column:
    return F.expr(case_text(rules, default))


def in_list(column: str, ids: Sequence[int]) -> str:
    return f"{column} IN ({', '.join(str(i) for i in ids)})"
