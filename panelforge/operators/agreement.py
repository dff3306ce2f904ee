"""Agreement of several tables on their keys, from one shuffle.

The keys of all sides are united with a mark of their side and counted per key and side in one aggregate. Every
difference between two sides, as sets or as multisets, every repeated key and every total is a function of these counts,
so more rules cost no more scans or joins. Counts are partial sums: a key with a third of the rows costs no more.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import row_rules, violations

#: A rule as ``contracts.row_rules`` takes it: name, condition, detail.
Rule = tuple[str, Column, Column]


def n(side: str) -> Column:
    """The number of rows of a side that have the key."""
    return F.col(f"n_{side}")


def balance(sides: dict[str, DataFrame], key: list[str], carried: dict[str, list[str]] | None = None, aggregates: dict[str, Column] | None = None) -> DataFrame:
    """(key, n_<side> for each side, aggregates) with keys as texts.

    ``carried`` names columns that a side brings along for ``aggregates``; they are null on the rows of other sides.
    """
    brought = {c: sides[s].schema[c].dataType for s, cs in (carried or {}).items() for c in cs}
    parts = []
    for number, (side, df) in enumerate(sides.items()):
        own = (carried or {}).get(side, [])
        more = [(F.col(c) if c in own else F.lit(None)).cast(kind).alias(f"__{c}") for c, kind in brought.items()]
        parts.append(df.select(*(F.col(k).cast("string").alias(k) for k in key), F.lit(number).alias("__side"), *more))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionAll(part)
    counts = [F.count_if(F.col("__side") == number).alias(f"n_{side}") for number, side in enumerate(sides)]
    return both.groupBy(*key).agg(*counts, *(a.alias(name) for name, a in (aggregates or {}).items()))


def unique(side: str, rule: str) -> Rule:
    """Keys that a side has more than once."""
    return rule, n(side) > 1, n(side)


def same(sides: list[str], rule: str = "keys differ") -> list[Rule]:
    """Keys that one of two sides lacks, for every two sides."""
    out = []
    for a, b in combinations(sides, 2):
        only = F.when(n(b) == 0, f"{a} without {b}").otherwise(f"{b} without {a}")
        out.append((rule, (n(a) > 0) != (n(b) > 0), only))
    return out


def within(side: str, whole: str, rule: str = "orphan") -> Rule:
    """Keys of ``side`` that ``whole`` lacks."""
    return rule, (n(side) > 0) & (n(whole) == 0), F.lit("")


def members(side: str, member: str, wanted: list, order: str, special: Column | None = None) -> tuple[dict[str, Column], Rule]:
    """Aggregates and the rule that a key of ``side`` holds each wanted member exactly once, in places of their own, and
    exactly one ``special`` row (a condition on the carried columns, which have ``__`` in front).

    All are counts and maxima of fixed number; nothing is collected."""
    found = {"specials": F.count_if(special) if special is not None else F.lit(1)}
    for k, m in enumerate(wanted):
        found[f"m{k}"] = F.count_if(F.col(f"__{member}") == m)
        found[f"o{k}"] = F.max(F.when(F.col(f"__{member}") == m, F.col(f"__{order}")))
    bad = (n(side) != len(wanted)) | (F.col("specials") != 1)
    for k in range(len(wanted)):
        bad |= F.col(f"m{k}") != 1
    places = F.array_compact(F.array(*(F.col(f"o{k}") for k in range(len(wanted)))))
    bad |= F.size(F.array_distinct(places)) != len(wanted)
    return found, ("group", (n(side) > 0) & bad, F.concat(F.lit("rows="), n(side).cast("string")))


def broken(balanced: DataFrame, key: list[str], rules: list[Rule]) -> DataFrame:
    """Violations of rules on the counts of a key."""
    return row_rules(balanced, key, rules)


def conserved(balanced: DataFrame, block: list[str], left: str, right: str, factor: int = 1, rule: str = "row conservation") -> DataFrame:
    """Blocks (parts of the key; none: all together) whose rows of ``left`` are not ``factor`` times those of ``right``.

    Block by block, since two wrong blocks can make up for each other."""
    sums = [F.coalesce(F.sum(n(s)), F.lit(0)).alias(s) for s in (left, right)]
    totals = balanced.groupBy(*block).agg(*sums)
    return violations(totals, rule, F.col(left) != F.col(right) * factor, [*block, left, right])
