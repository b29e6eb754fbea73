"""Data-quality checks.

Every check is a DataFrame of *violations* (empty = pass), so a check is an
ordinary distributed query: it can be shown, written, joined, or gated.
:func:`run_checks` evaluates any number of checks in one Spark job and
:func:`enforce` raises when one fails, before anything is written. Checks of
one table are counted together: the table is scanned once, all conditions on
rows are sums of one aggregate, and all checks of keys (repeated, missing
from a reference) are grouping sets of the same aggregate, so that they share
its shuffle; keys that must be in a reference then meet all references in
one anti join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.columns import any_null, any_null_or_blank, date_lit
from starfold.operators.scd2 import Scd2Spec, with_hash


class QualityError(ValueError):
    """A gate found violations."""


@dataclass(frozen=True)
class Rule:
    """How a check can be counted along with others of ``table``.

    One of: ``row``, a condition whose rows are violations; ``empty``, a table
    without rows is one; ``keys`` with ``value`` (an aggregate) and ``bad`` (a
    condition on it), groups that are; ``keys`` with ``reference``, a table of
    the same keys in the same order, groups that it lacks (those with a null
    among them count if ``nulls``).
    """

    table: DataFrame
    row: Column | None = None
    empty: bool = False
    keys: tuple[str, ...] = ()
    value: Column | None = None
    bad: Callable[[Column], Column] | None = None
    reference: DataFrame | None = None
    nulls: bool = True


@dataclass(frozen=True)
class Check:
    name: str
    violations: DataFrame
    rule: Rule | None = None


def empty_table(df: DataFrame, table: str) -> Check:
    """One violation row when ``df`` has no rows (reads at most one row)."""
    v = df.limit(1).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") == 0)
    return Check(f"{table} is empty", v.select(F.lit(table).alias("table_name")), Rule(df, empty=True))


def null_keys(df: DataFrame, keys: Sequence[str], table: str, blank: bool = False) -> Check:
    """Rows where any key is null (or blank, for string keys, when ``blank``)."""
    cond = any_null_or_blank(df, keys) if blank else any_null(keys)
    return Check(f"{table} rows with null keys ({', '.join(keys)})", df.filter(cond), Rule(df, row=cond))


def null_key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of nulls in each key column (``null_<key>s``)."""
    return df.agg(*[F.sum(F.col(k).isNull().cast("int")).alias(f"null_{k}s") for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str], table: str) -> Check:
    """Business keys that occur more than once."""
    v = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)
    return Check(f"{table} duplicate keys ({', '.join(keys)})", v,
                 Rule(df, keys=tuple(keys), value=F.count(F.lit(1)), bad=lambda n: n > 1))


def multiple_current_versions(dim: DataFrame, spec: Scd2Spec, table: str) -> Check:
    """Keys with more than one current version (counted over current rows)."""
    v = (
        dim.filter(F.col(spec.is_current))
        .groupBy(*spec.business_key)
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") != 1)
    )
    current = F.sum(F.when(F.col(spec.is_current), 1).otherwise(0))
    return Check(f"{table} keys with several current versions", v,
                 Rule(dim, keys=tuple(spec.business_key), value=current, bad=lambda n: n > 1))


def current_version_violations(dim: DataFrame, spec: Scd2Spec, table: str) -> Check:
    """Keys whose number of current versions is not exactly one (over all rows)."""
    v = (
        dim.groupBy(*spec.business_key)
        .agg(F.sum(F.col(spec.is_current).cast("int")).alias("current_versions"))
        .filter(F.coalesce(F.col("current_versions"), F.lit(0)) != 1)
    )
    current = F.sum(F.when(F.col(spec.is_current), 1).otherwise(0))
    return Check(f"{table} keys without exactly one current version", v,
                 Rule(dim, keys=tuple(spec.business_key), value=current, bad=lambda n: n != 1))


def reference_coverage(
    events: DataFrame, reference: DataFrame, code_col: str, ref_col: str | None = None,
    table: str = "events",
) -> Check:
    """Codes used by ``events`` that the reference lacks, with their row counts.

    Counting happens before the anti join (a partial aggregate), so only one
    row per code is shuffled; a null code never matches and is reported.
    """
    ref_col = ref_col or code_col
    counts = events.groupBy(code_col).agg(F.count(F.lit(1)).alias("count"))
    ref = reference.select(F.col(ref_col).alias(code_col))
    return Check(f"{table}.{code_col} missing from reference", counts.join(ref, code_col, "left_anti"),
                 Rule(events, keys=(code_col,), reference=ref))


def orphan_keys(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
    table: str = "fact", exclude_nulls: bool = True,
) -> Check:
    """Distinct fact foreign keys with no dimension row (nulls excluded by default)."""
    dim_key = dim_key or key
    keys = fact.select(key)
    if exclude_nulls:
        keys = keys.filter(F.col(key).isNotNull())
    ref = dim.select(F.col(dim_key).alias(key))
    return Check(f"{table}.{key} orphans", keys.distinct().join(ref, key, "left_anti"),
                 Rule(fact, keys=(key,), reference=ref, nulls=not exclude_nulls))


def orphan_counts(checks: Sequence[tuple[str, Check]]) -> DataFrame:
    """``dimension, missing_keys`` for several orphan checks, one job."""
    out = _counts([c for _, c in checks])
    names = F.create_map(*[x for i, (name, _) in enumerate(checks) for x in (F.lit(i), F.lit(name))])
    return out.select(names[F.col("position")].alias("dimension"), F.col("violations").alias("missing_keys"))


def late_batch(existing: DataFrame, incoming: DataFrame, spec: Scd2Spec, batch_date: str,
               table: str = "dimension") -> Check:
    """Changed keys whose current version does not start before ``batch_date``:
    merging them would close a version before it opens."""
    cur = existing.filter(F.col(spec.is_current)).select(
        *spec.business_key, F.col(spec.hash_col).alias("_cur_hash"), spec.valid_from
    )
    v = (
        with_hash(incoming, spec)
        .join(cur, list(spec.business_key))
        .filter((F.col(spec.hash_col) != F.col("_cur_hash")) & (F.col(spec.valid_from) >= date_lit(batch_date)))
        .select(*spec.business_key, spec.valid_from)
    )
    return Check(f"{table} batch {batch_date} is not after the current versions", v)


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """``check, violations`` for all checks, evaluated as one Spark job."""
    return _counts(checks).drop("position")


def _counts(checks: Sequence[Check]) -> DataFrame:
    """``position, check, violations`` for each check."""
    spark = checks[0].violations.sparkSession
    tables: dict[int, list[int]] = {}
    alone = []
    for i, c in enumerate(checks):
        if c.rule is None:
            alone.append(c.violations.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(i).alias("position"), "violations"))
        else:
            tables.setdefault(id(c.rule.table), []).append(i)
    parts = [_counted({i: checks[i].rule for i in held}) for held in tables.values()]
    found = reduce(DataFrame.unionByName, parts + alone)
    # A check without a row has no violations, but for one that asks whether there are rows at all.
    names = [(i, c.name, int(c.rule is not None and c.rule.empty)) for i, c in enumerate(checks)]
    names = spark.createDataFrame(names, "position int, check string, otherwise long")
    return names.join(found, "position", "left").select(
        "position", "check", F.coalesce("violations", "otherwise").alias("violations"))


def _counted(rules: dict[int, Rule]) -> DataFrame:
    """``position, violations`` of checks of one table, by one aggregate over one scan."""
    table = next(iter(rules.values())).table
    columns = list(dict.fromkeys(k for r in rules.values() for k in r.keys))
    sets = list(dict.fromkeys(tuple(sorted(set(r.keys))) for r in rules.values()))
    values = [F.count(F.lit(1)).alias("_n")]
    for i, r in rules.items():
        if r.row is not None:
            values.append(F.sum(F.when(r.row, 1).otherwise(0)).alias(f"_v{i}"))
        elif r.value is not None:
            values.append(r.value.alias(f"_v{i}"))
    if columns:
        groups = table.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in columns])
        found = groups.agg(F.grouping_id().alias("_set"), *values)
    else:
        found = table.agg(*values).withColumn("_set", F.lit(0).cast("long"))

    def number(keys: tuple[str, ...]) -> int:
        """Spark's number of a grouping set: a bit for each column that is not in it, the first one highest."""
        return sum(1 << (len(columns) - 1 - i) for i, k in enumerate(columns) if k not in keys)

    def text(keys: Sequence[str]) -> Column:
        return F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]))

    entries, references = [], []
    for i, r in rules.items():
        here = F.col("_set") == number(r.keys)
        if r.row is not None:
            entry, here = (F.col(f"_v{i}"), F.lit("")), here & (F.col(f"_v{i}") > 0)
        elif r.empty:
            entry = (F.when(F.col("_n") == 0, 1).otherwise(0), F.lit(""))
        elif r.reference is not None:
            whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in r.keys])
            entry, here = (F.lit(1), F.when(whole, text(r.keys)).otherwise(F.lit("null"))), here if r.nulls else here & whole
            known = r.reference.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in r.reference.columns]))
            references.append(known.select(F.lit(i).alias("position"), text(known.columns).alias("key")))
        else:
            entry, here = (F.lit(1), text(r.keys)), here & r.bad(F.col(f"_v{i}"))
        entries.append(F.when(here, F.struct(F.lit(i).alias("position"), entry[0].cast("long").alias("violations"),
                                             entry[1].alias("key"))))
    hits = found.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("_e")).select("_e.*")
    if references:
        hits = hits.join(reduce(DataFrame.unionByName, references), ["position", "key"], "left_anti")
    return hits.groupBy("position").agg(F.sum("violations").alias("violations"))


def worst_first(violations: DataFrame, count_col: str = "count", n: int | None = None) -> DataFrame:
    """Violations by descending count (ties: by the other columns), all or the first ``n``."""
    rest = [c for c in violations.columns if c != count_col]
    out = violations.orderBy(F.col(count_col).desc(), *rest)
    return out if n is None else out.limit(n)


def enforce(checks: Sequence[Check], sample: int = 20) -> dict[str, int]:
    """Raise :class:`QualityError` naming every failed check and its count.

    Returns the per-check counts when all pass; checks of one name are told
    apart by their position and their counts added. Only the small count
    table and at most ``sample`` rows of a failing check, those of the
    highest counts first where it has a ``count``, reach the driver.
    """
    if not checks:
        return {}
    found = {r["position"]: r["violations"] for r in _counts(checks).collect()}
    lines = []
    for i, c in enumerate(checks):
        if found[i]:
            v = c.violations
            rows = worst_first(v, n=sample) if "count" in v.columns else v.limit(sample)
            lines.append(f"{c.name}: {found[i]} violation(s); sample {[r.asDict() for r in rows.collect()]}")
    if lines:
        raise QualityError("\n".join(lines))
    counts: dict[str, int] = {}
    for i, c in enumerate(checks):
        counts[c.name] = counts.get(c.name, 0) + found[i]
    return counts
