"""Row-level cleansing: required fields, exact and keyed de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.columns import null_if_missing, title_case, typed, upper_code
from starfold.sources.tables import stored


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``columns`` is null (pushes ``IsNotNull`` down)."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def dedupe_exact(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove exact duplicates over all columns (or over ``subset``).

    Planned as a two-phase hash aggregate: duplicates collapse map-side before
    the shuffle, so a value repeated a billion times ships one row per task.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def dedupe_staged(df: DataFrame, telling: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicates over all columns removed, where most rows have none.

    ``telling`` names columns in which rows that differ nearly always differ
    (unless given, all); only these are hashed, so that looking for copies
    reads no others. Only rows' 64-bit hashes are shuffled to find those that occur more than
    once; they are stored, so that the planner knows their size. All other
    rows are distinct and stay where they are; rows of such a hash are
    compared by their columns (equal hashes alone drop nothing). With very
    many duplicates the planner shuffles the rows by hash, too.
    """
    h = F.xxhash64(*(telling or df.columns))
    twice = df.groupBy(h.alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    twice = stored(twice, "repeated-hashes")
    same = h == twice["_hash"]
    return df.join(twice, same, "left_anti").union(dedupe_exact(df.join(twice, same, "left_semi")))


def dedupe_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    keep: str = "first",
) -> DataFrame:
    """One row per business key with a deterministic survivor.

    The survivor is the row that is smallest (``keep='first'``) or largest
    (``keep='last'``) in the order ``order_by`` followed by every remaining
    column, nulls lowest. It is computed as ``min``/``max`` over a struct in a
    grouped aggregate rather than ``row_number()`` over a window: the
    aggregate is partial (combined per task before the shuffle), so a key that
    holds a third of the table never lands whole in one task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    keys = list(keys)
    order_by = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    payload = order_by + rest
    if not payload:
        return df.select(*keys).dropDuplicates()
    packed = F.struct(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(payload)])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    out = df.groupBy(*keys).agg(pick.alias("_survivor"))
    fields = {c: F.col(f"_survivor._f{i}").alias(c) for i, c in enumerate(payload)}
    return out.select(*[F.col(c) if c in keys else fields[c] for c in df.columns])


#: Type of the column of rejected values: one entry for each value of a row that its rule could not read.
REJECTED_TYPE = "array<struct<column_name:string,value:string,rule:string>>"


def clean_columns(df: DataFrame, spec: Sequence[tuple[str, str, str]], on_malformed: str = "fail",
                  keep: Sequence[str] = (), rejected: str | None = None) -> DataFrame:
    """Project raw string columns to typed, standardised ones.

    ``spec`` rows are ``(source, target, rule)`` where rule is one of
    ``text`` (trim + missing tokens to null), ``upper``, ``title``, ``raw``
    (no change) or a cast target such as ``long``, ``int``, ``double``
    (missing tokens to null first; ``id:long`` casts without the token
    step, as identifiers are expected to be present). ``keep`` columns pass
    through unchanged after the spec columns.

    ``rejected`` names one more column, of type ``REJECTED_TYPE``: with
    ``on_malformed="null"`` the values that are there but became null, as
    they were read, with the rule; empty where there are none. It is made in
    the same projection. A missing token is not malformed.
    """
    cols, bad = _cleaned(spec, on_malformed)
    if rejected:
        cols.append(bad.alias(rejected))
    return df.select(*cols, *[F.col(k) for k in keep])


def _cleaned(spec: Sequence[tuple[str, str, str]], on_malformed: str) -> tuple[list[Column], Column]:
    """The columns of :func:`clean_columns`, and the array of a row's rejected values."""
    cols: list[Column] = []
    bad: list[Column] = []
    for source, target, rule in spec:
        if rule == "text":
            c = null_if_missing(source)
        elif rule == "upper":
            c = upper_code(source)
        elif rule == "title":
            c = title_case(source)
        elif rule == "raw":
            c = F.col(source)
        else:
            kind = rule.removeprefix("id:")
            c = typed(F.col(source) if rule.startswith("id:") else null_if_missing(source), kind, on_malformed)
            if on_malformed == "null":
                entry = F.struct(F.lit(source).alias("column_name"), F.col(source).alias("value"), F.lit(rule).alias("rule"))
                bad.append(F.when(null_if_missing(source).isNotNull() & c.isNull(), entry))
        cols.append(c.alias(target))
    found = F.filter(F.array(*bad), lambda e: e.isNotNull()) if bad else F.array()
    return cols, found.cast(REJECTED_TYPE)


def rejected_values(df: DataFrame, spec: Sequence[tuple[str, str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and ``column_name, value, rule`` for each value of ``df`` that its rule cannot read, one row each."""
    _, bad = _cleaned(spec, "null")
    return df.select(*keep, F.explode(bad).alias("_rejected")).select(*keep, "_rejected.*")
