"""Column expressions. Each stays inside code generation; none is a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what stands for a null part of a surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the parts as strings, joined by '-'; null parts are spelled out, so that they can't collide with text."""
    return F.md5(F.concat_ws("-", *(F.coalesce(col(c).cast("string"), F.lit(NULL_KEY)) for c in cols)))


def foreign_key(*cols: Column | str) -> Column:
    """surrogate_key(), but null where any part is null: a missing parent isn't a parent with a null name."""
    present = F.lit(True)
    for c in cols:
        present = present & col(c).isNotNull()
    return F.when(present, surrogate_key(*cols))


def grid_cell(x: Column | str, y: Column | str, size: float = 500) -> Column:
    """Square cell as 'column_row'; null if either coordinate is."""
    side = lambda c: F.floor(col(c) / F.lit(float(size))).cast("int").cast("string")
    return F.concat(side(x), F.lit("_"), side(y))


def shrink_rate(successes: Column | str, trials: Column | str, prior: Column | float, weight: float = 10) -> Column:
    """(successes + weight * prior) / (trials + weight); null if there is neither trial nor weight."""
    prior = prior if isinstance(prior, Column) else F.lit(float(prior))
    total = col(trials).cast("double") + F.lit(float(weight))
    return safe_div(col(successes).cast("double") + F.lit(float(weight)) * prior, total)


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b in double; null for a zero divisor."""
    b = col(b).cast("double")
    return col(a).cast("double") / F.when(b != 0, b)


def rate(condition: Column) -> Column:
    """Share of rows with the condition, as a double; null conditions count as false."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """Second boundaries passed from a to b."""
    return F.unix_seconds(col(b).cast("timestamp")) - F.unix_seconds(col(a).cast("timestamp"))


def metres(c: Column | str, per_metre: float = 100.0) -> Column:
    """Scale in double; a decimal literal would make the column a decimal."""
    return col(c).cast("double") / F.lit(float(per_metre))


def blank(c: Column | str, sentinel) -> Column:
    """Null where the column holds its sentinel."""
    return F.nullif(col(c), F.lit(sentinel))


def bucket(c: Column | str, edges: Sequence[float], labels: Sequence[str], null_label: str | None = None) -> Column:
    """Label of the half-open interval that holds the value; one label more than edges."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges")
    out = F.when(col(c).isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels, strict=False):
        out = out.when(col(c) < F.lit(float(edge)), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def classify(c: Column | str, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first pattern (ILIKE) that matches."""
    if not rules:
        return F.lit(default)
    out = None
    for pattern, label in rules:
        match = col(c).ilike(pattern)
        out = F.when(match, F.lit(label)) if out is None else out.when(match, F.lit(label))
    return out.otherwise(F.lit(default))


def lookup(c: Column | str, names: dict[str, str]) -> Column:
    """Value of a small literal map; null where the key is unknown."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col(c))


def size0(c: Column | str) -> Column:
    """Array size; a missing array has none."""
    return F.when(col(c).isNull(), F.lit(0)).otherwise(F.size(col(c)))


def is_bot(account: Column | str) -> Column:
    """Accounts of bots begin with 'ai.'; a missing account is no bot."""
    return F.coalesce(col(account).startswith("ai."), F.lit(False))


def region_of(title: Column | str) -> Column:
    """Last token of a dotted id of three tokens or more."""
    tokens = F.split(col(title), r"\.")
    return F.when(F.size(tokens) >= 3, F.element_at(tokens, -1))


def distance(x1, y1, x2, y2) -> Column:
    dx, dy = col(x1) - col(x2), col(y1) - col(y2)
    return F.sqrt(dx * dx + dy * dy)


def flatten(prefix: str, source: str, fields: dict[str, str]) -> list[Column]:
    """A struct's fields as columns: {'name': 'path.in.struct'} becomes prefix_name. Missing parents give null."""
    return [F.col(f"{source}.{path}").alias(f"{prefix}_{name}") for name, path in fields.items()]
