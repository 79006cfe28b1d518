"""Rare-level recoding.

The rules are data; one engine turns each column's rules into a single
``CASE WHEN`` chain.  A rule is ``(kind, values, result)`` where ``kind`` is
``"in"`` (membership) or ``"prefix"`` (regex ``^value``) and ``result`` is a
level or ``KEEP`` (the input value).  ``default`` applies to everything no
rule matched, including NULL: ``KEEP`` leaves NULL as NULL (R ``ifelse`` /
``case_when(TRUE ~ as.character(x))``), a literal level replaces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP = object()

# The recode rules of the reference, column by column.
RECODE_RULES: dict[str, tuple[list[tuple], object]] = {
    "CODE_GENDER": ([("in", ["XNA"], "F")], KEEP),
    "NAME_TYPE_SUITE": ([("in", ["Other_A", "Other_B", "Group of people"], "Other")], KEEP),
    "NAME_INCOME_TYPE": ([("in", ["Businessman", "Maternity leave", "Student", "Unemployed"],
                           "Other")], KEEP),
    "NAME_EDUCATION_TYPE": ([
        ("in", ["Lower secondary"], KEEP),
        ("in", ["Secondary / secondary special"], KEEP),
        ("in", ["Incomplete higher"], KEEP),
        ("in", ["Higher education", "Academic degree"], "Academic / Bachelors or higher"),
    ], "Other"),
    "NAME_FAMILY_STATUS": ([("in", ["Unknown"], "Married")], KEEP),
    "NAME_HOUSING_TYPE": ([
        ("in", ["Co-op apartment", "Office apartment"], "Other"),
        ("in", ["Municipal apartment", "Rented apartment"], "Rented / Municipal"),
    ], KEEP),
    "OCCUPATION_TYPE": ([("in", ["Laborers", "Core staff", "Sales staff", "Managers", "Drivers"],
                          KEEP)], "Other"),
    "ORGANIZATION_TYPE": ([
        ("prefix", "Industry", "Industry"),
        ("prefix", "Trade", "Trade"),
        ("prefix", "Transport", "Transport"),
        ("in", ["Business Entity Type 3", "Government", "Construction", "Housing", "Medicine",
                "Self-employed", "School", "XNA"], KEEP),
    ], "Other"),
    "WALLSMATERIAL_MODE": ([("in", ["Monolithic", "Mixed", "Others"], "Other")], KEEP),
}


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def recode_sql(col_name: str, rules: list[tuple], default) -> str:
    """The rules of one column as a single SQL ``CASE`` expression."""
    col = f"`{col_name}`"
    res = lambda r: col if r is KEEP else _q(r)
    parts = []
    for kind, values, result in rules:
        if kind == "in":
            cond = f"{col} IN ({', '.join(_q(v) for v in values)})"
        elif kind == "prefix":
            cond = f"startswith({col}, {_q(values)})"
        else:  # pragma: no cover - programming error
            raise ValueError(kind)
        parts.append(f"WHEN {cond} THEN {res(result)}")
    return f"CASE {' '.join(parts)} ELSE {res(default)} END"


def recode_expr(col_name: str, rules: list[tuple], default) -> Column:
    return F.expr(recode_sql(col_name, rules, default))


def recode_levels(df: DataFrame, rules: dict = RECODE_RULES) -> DataFrame:
    """Apply every rule set whose column is present, in one projection."""
    return df.withColumns({c: recode_expr(c, r, d) for c, (r, d) in rules.items() if c in df.columns})
