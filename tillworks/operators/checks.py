"""Data-quality check templates.

A check is a declaration. Checks are evaluated together, those of several runs (a snapshot and its
days) too: one aggregate over all stacked tables serves every row rule, emptiness check and
reconciliation, and the references whose keys can be packed (each table is read once), one grouping
serves every uniqueness check, and each other reference check is one chain of joins.
All batches are checked at once: a table is reduced to one row per group of its own grain (a day,
a week, or the whole), and only these rows are given to the batches that the group belongs to.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillworks.operators.lookup import fits_bigint, packed_members, probe_keys, with_membership
from tillworks.schema import RATE, ROWS
from tillworks.session import at_the_same_time, materialise

# Categories and severities.
RECONCILIATION = "RECONCILIATION"
UNIQUENESS = "UNIQUENESS"
REFERENTIAL = "REFERENTIAL_INTEGRITY"
BUSINESS_RULE = "BUSINESS_RULE"
CRITICAL = "CRITICAL"
ERROR = "ERROR"
WARNING = "WARNING"

AMOUNT_TOLERANCE = "0.01"


@dataclass(frozen=True)
class Check:
    id: str  # suffix of the log id
    layer: str
    table: str  # qualified name shown in the log
    name: str
    category: str
    severity: str
    description: str
    where: str | None = None  # scope within the table
    on_failure: str = "FAIL"


@dataclass(frozen=True)
class NotEmpty(Check):
    at_least: int = 1


@dataclass(frozen=True)
class Unique(Check):
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class RowRule(Check):
    bad: str = "false"  # condition of a row that breaks the rule
    empty_fails: bool = False


@dataclass(frozen=True)
class References(Check):
    links: tuple[tuple[str, str, str], ...] = ()  # (column here, other table, its key)
    other_where: str | None = None  # scope within the other tables, in which their keys are unique


@dataclass(frozen=True)
class SameValue(Check):
    """A sum over `source` equals one over `table`: a row count, or an amount within 0.01."""

    source: str = ""
    source_where: str | None = None
    source_value: str = "1"  # per row, summed
    value: str = "1"
    amount: bool = False


def _scoped(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(where) if where else df


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


_VALUE = T.DecimalType(18, 4)
_METRIC = T.DecimalType(28, 4)
_ROWS, _BAD, _EXPECTED = "_rows", "_value", "_expected"  # what a value is to its check


# --- batches ------------------------------------------------------------------------------------
#: Rows of a table belong to all batches, or to those of a day or a week: its grain is the column of
#: the table, and of the batches, that says which.
WHOLE = ""


@dataclass(frozen=True)
class Run:
    """Checks of some batches (one row each) over the tables that they load. `grain` names, for each table
    that a batch has only a part of, the column (of the table and of the batches) by which its rows belong to
    batches; the other tables are every batch's as a whole."""

    checks: list[Check]
    tables: dict[str, DataFrame]
    batches: DataFrame
    grain: dict[str, str]


def _group(grain: str) -> Column:
    return (F.col(grain) if grain else F.lit(0)).cast("bigint").alias("_group")


def _wanted(batches: DataFrame, uses: list[tuple[int, str, str, str]]) -> DataFrame:
    """Every batch times every use (a short declared list): which value, of which check, as what, and the
    group that it reads."""
    names = ("_place", "CheckID", "_role", "_grain")
    each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, use, strict=True)]) for use in uses]))
    rows = batches.select(*batches.columns, each.alias("_use")).select(*batches.columns, "_use.*")
    group = F.lit(0).cast("bigint")
    for grain in sorted({use[-1] for use in uses} - {WHOLE}):
        group = F.when(F.col("_grain") == grain, F.col(grain).cast("bigint")).otherwise(group)
    return rows.withColumn("_group", group)


# --- one pass per table ---------------------------------------------------------------------------
@dataclass
class _Scan:
    """One pass over a table for every check of every run that reads it. Its slots are conditions whose rows
    are counted, and amounts that are summed."""

    df: DataFrame
    grain: str = WHOLE
    counts: list[str] = field(default_factory=list)
    amounts: list[str] = field(default_factory=list)


@dataclass
class _Keys:
    """Keys to be unique in each group of a table, in the whole, or in both."""

    df: DataFrame
    grain: str
    where: str | None
    keys: tuple[str, ...]
    wholes: set[bool] = field(default_factory=set)

    @property
    def apart(self) -> str:
        """The grain by which equal keys are told apart, if they need not be unique in the whole."""
        return WHOLE if True in self.wholes else self.grain


def _both(where: str | None, condition: str) -> str:
    return f"({where}) AND ({condition})" if where else condition


class _Plan:
    """Which passes the checks of all runs need, and the values that each check reads: (place, check, role,
    grain) for every run. A table that several runs read (the same DataFrame) is read once for all of them."""

    def __init__(self, runs: list[Run], packed: bool):
        self.scans: dict[int, _Scan] = {}
        self.places: dict[tuple, int] = {}
        self.keys: dict[tuple, _Keys] = {}
        self.references: dict[tuple, tuple[_Scan, References, list[tuple[str, DataFrame, str]]]] = {}
        self.uses: list[list[tuple[int, str, str, str]]] = [[] for _ in runs]
        for run in runs:
            for name in {t for c in run.checks for t in (c.table, getattr(c, "source", "")) if t}:
                scan = self.scans.setdefault(id(run.tables[name]), _Scan(run.tables[name]))
                if scan.grain not in (WHOLE, run.grain.get(name, scan.grain)):
                    raise ValueError(f"{name} has two grains")
                scan.grain = scan.grain or run.grain.get(name, WHOLE)
        self.members = _packed_links(runs) if packed else {}
        for number, run in enumerate(runs):
            for check in run.checks:
                self._add(number, run, check)

    def _use(self, number: int, run: Run, check: Check, role: str, place: tuple, table: str) -> None:
        self.uses[number].append((self.places.setdefault(place, len(self.places)), check.id, role, run.grain.get(table, WHOLE)))

    def _count(self, number: int, run: Run, check: Check, role: str, table: str, condition: str | None) -> None:
        key, condition = id(run.tables[table]), condition or "true"
        counts = self.scans[key].counts
        if condition not in counts:
            counts.append(condition)
        self._use(number, run, check, role, ("count", key, counts.index(condition)), table)

    def _sum(self, number: int, run: Run, check: Check, role: str, table: str, where: str | None, value: str) -> None:
        if value == "1":
            return self._count(number, run, check, role, table, where)
        key, amount = id(run.tables[table]), f"CASE WHEN {where} THEN {value} END" if where else value
        amounts = self.scans[key].amounts
        if amount not in amounts:
            amounts.append(amount)
        return self._use(number, run, check, role, ("amount", key, amounts.index(amount)), table)

    def _add(self, number: int, run: Run, c: Check) -> None:
        df, grain = run.tables[c.table], run.grain.get(c.table, WHOLE)
        self._count(number, run, c, _ROWS, c.table, c.where)
        if isinstance(c, RowRule):
            self._count(number, run, c, _BAD, c.table, _both(c.where, c.bad))
        elif isinstance(c, SameValue):
            self._sum(number, run, c, _BAD, c.table, c.where, c.value)
            self._sum(number, run, c, _EXPECTED, c.source, c.source_where, c.source_value)
        elif isinstance(c, Unique):
            place = ("keys", id(df), c.where, c.keys)
            keys = self.keys.setdefault(place, _Keys(df, self.scans[id(df)].grain, c.where, c.keys))
            keys.wholes.add(not grain)
            self._use(number, run, c, _BAD, place, c.table)
        elif isinstance(c, References):
            members = [(id(run.tables[t]), c.other_where, k) for _, t, k in c.links]
            place = ("missing", id(df), c.where, tuple((column, *m) for (column, _, _), m in zip(c.links, members, strict=True)))
            if all(m in self.members and fits_bigint(df.schema[column].dataType) for m, (column, _, _) in zip(members, c.links, strict=True)):
                scan = self.scans[id(df)]
                found = [f"_found{list(self.members).index(m)}_{column}" for (column, _, _), m in zip(c.links, members, strict=True)]
                for (column, _, _), m, flag in zip(c.links, members, found, strict=True):
                    if flag not in scan.df.columns:
                        scan.df = with_membership(scan.df, column, self.members[m], flag)
                missing = " OR ".join(f"NOT {flag}" for flag in found)
                self._count(number, run, c, _BAD, c.table, _both(c.where, missing))
            else:
                links = [(column, _scoped(run.tables[t], c.other_where), k) for column, t, k in c.links]
                self.references.setdefault(place, (self.scans[id(df)], c, links))
                self._use(number, run, c, _BAD, place, c.table)


def _packed_links(runs: list[Run]) -> dict[tuple, DataFrame]:
    """Of the keys that the checks refer to, those that can be packed: by table, scope and key."""
    links = {
        (id(run.tables[t]), c.other_where, k): run.tables[t]
        for run in runs for c in run.checks if isinstance(c, References) for _, t, k in c.links
    }
    packed = at_the_same_time([partial(packed_members, _scoped(df, where), key) for (_, where, key), df in links.items()])
    return {link: df for link, df in zip(links, packed, strict=True) if df is not None}


def _total() -> list[Column]:
    return [F.lit(WHOLE).alias("_grain"), F.lit(0).cast("bigint").alias("_group")]


def _scanned(plan: _Plan) -> DataFrame:
    """(_place, _grain, _group, _metric): all counts and sums, from one aggregate over the stacked tables. A table
    is summed per group of its own grain; its groups add up to the whole."""
    scans = plan.scans
    wide = [max(len(s.counts) for s in scans.values()), max(len(s.amounts) for s in scans.values())]
    counts, amounts = ([f"_{kind}{i}" for i in range(n)] for kind, n in zip(("count", "amount"), wide, strict=True))

    def rows(number: int, scan: _Scan) -> DataFrame:
        flags = [F.expr(f"CASE WHEN {c} THEN 1 ELSE 0 END") for c in scan.counts]
        sums = [F.expr(e).cast(_VALUE) for e in scan.amounts]
        nothing = [F.lit(None)] * (wide[0] - len(flags)), [F.lit(None).cast(_VALUE)] * (wide[1] - len(sums))
        slots = [*flags, *nothing[0]], [*sums, *nothing[1]]
        return scan.df.select(
            F.lit(number).alias("_scan"),
            _group(scan.grain),
            *[c.cast("int").alias(v) for c, v in zip(slots[0], counts, strict=True)],
            *[c.alias(v) for c, v in zip(slots[1], amounts, strict=True)],
        )

    stacked = _union([rows(i, scan) for i, scan in enumerate(scans.values())])
    summed = materialise(
        stacked.groupBy("_scan", "_group").agg(*[F.sum(v).alias(v) for v in (*counts, *amounts)]), "check-sums"
    )
    grains = F.array(*[F.lit(s.grain) for s in scans.values()])
    places = {key: {} for key in scans}
    for place, number in plan.places.items():
        if place[0] in ("count", "amount"):
            places[place[1]][place[2] + (wide[0] if place[0] == "amount" else 0)] = number
    numbers = F.array(*[F.array(*[F.lit(places[key].get(i, -1)) for i in range(sum(wide))]) for key in scans])
    slots = F.posexplode(F.array(*[F.col(v).cast(_METRIC) for v in (*counts, *amounts)])).alias("_slot", "_metric")
    each = (
        summed.select("_scan", "_group", slots)
        .filter(F.col("_metric").isNotNull())
        .select(numbers[F.col("_scan")][F.col("_slot")].alias("_place"), grains[F.col("_scan")].alias("_grain"), "_group", "_metric")
    )
    parted = each.filter(F.col("_grain") != WHOLE)
    total = each.groupBy("_place").agg(F.sum("_metric").cast(_METRIC).alias("_metric")).select("_place", *_total(), "_metric")
    return parted.unionByName(total)


def _hashed(number: int, keys: _Keys) -> list[Column]:
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("\x02")) for k in keys.keys]
    group = _group(keys.apart)
    return [F.lit(number).alias("_check"), group, F.xxhash64(F.lit(number), group, *texts).alias("_hash"), F.concat_ws("\x01", *texts).alias("_key")]


def _repeated(units: dict[int, _Keys]) -> DataFrame:
    """(_place, _grain, _group, _metric): how many keys occur more than once, per group, in the whole, or in both.

    Two stages. First every row is counted by one 8-byte hash of its check, group and key, so nothing
    else of a row goes through a shuffle, and copies of a hot key are combined early. Only the rows of
    repeated hashes, of the tables that have any, are then counted by the key itself, so keys that merely
    share a hash are told apart. Keys that must be unique per group and in the whole are hashed without the group:
    one stage serves both."""
    first = {n: _scoped(keys.df, keys.where).select(*_hashed(n, keys)[:3]) for n, keys in units.items()}
    by = ["_check", "_group", "_hash"] if len(units) > 1 else ["_hash"]
    several = _union(list(first.values())).groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    (only,) = units if len(units) == 1 else (None,)
    of_check = F.col("_check") if only is None else F.lit(only).alias("_check")
    each = next(iter(first.values())).sparkSession.range(1).select(F.explode(F.array(*map(F.lit, units))).alias("_check"))
    # written as one row per repeated hash, and one (without a hash) per check
    counted = materialise(several.select(of_check, "_hash").unionByName(each, allowMissingColumns=True), "key-hashes")
    suspects = {r["_check"] for r in counted.groupBy("_check").agg(F.count("_hash").alias("_n")).filter("_n > 0").collect()}
    parts = [counted.limit(0).select(F.lit(0).alias("_place"), *_total(), F.lit(0).cast(_METRIC).alias("_metric"))]
    for number in sorted(suspects):
        keys = units[number]
        hashes = counted.filter((F.col("_check") == number) & F.col("_hash").isNotNull()).select("_hash").distinct()
        rows = _scoped(keys.df, keys.where).select(*_hashed(number, keys)[2:], _group(keys.grain))
        again = rows.join(hashes, "_hash", "left_semi").groupBy("_group", "_hash", "_key").agg(F.count("*").alias("_n"))
        bad = F.count_if(F.col("_n") > 1).cast(_METRIC).alias("_metric")
        if False in keys.wholes:
            parts.append(again.groupBy("_group").agg(bad).select(F.lit(number).alias("_place"), F.lit(keys.grain).alias("_grain"), "_group", "_metric"))
        if True in keys.wholes:
            whole = again.groupBy("_hash", "_key").agg(F.sum("_n").alias("_n")) if keys.grain else again
            parts.append(whole.agg(bad).select(F.lit(number).alias("_place"), *_total(), "_metric"))
    return _union(parts)


def key_counts(checks: list[Unique], tables: dict[str, DataFrame], grain: dict[str, str]) -> DataFrame:
    """(_check, _group, _rows, _bad): rows and repeated keys of uniqueness checks, per group."""
    units = {i: _Keys(tables[c.table], grain.get(c.table, WHOLE), c.where, c.keys, {c.table not in grain}) for i, c in enumerate(checks)}
    bad = _repeated(units).select(F.col("_place").alias("_check"), "_group", F.col("_metric").cast("bigint").alias("_bad"))
    each = [_scoped(u.df, u.where).select(F.lit(i).alias("_check"), _group(u.grain)) for i, u in units.items()]
    rows = _union(each).groupBy("_check", "_group").agg(F.count("*").alias("_rows"))
    counted = rows.join(bad, ["_check", "_group"], "left").na.fill(0, ["_bad"])
    ids = F.array(*[F.lit(c.id) for c in checks])
    return counted.select(ids[F.col("_check")].alias("_check"), "_group", "_rows", "_bad")


def _missing(number: int, scan: _Scan, check: References, links: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """(_place, _grain, _group, _metric): rows with a key that is nowhere to be found."""
    fact = _scoped(scan.df, check.where).select(_group(scan.grain), *[c for c, _, _ in check.links])
    probed, missing = probe_keys(fact, links, "_group")
    totals = probed.groupBy("_group").agg(F.count_if(missing).cast(_METRIC).alias("_metric"))
    return totals.select(F.lit(number).alias("_place"), F.lit(scan.grain).alias("_grain"), "_group", "_metric")


def _all_missing(plan: _Plan) -> DataFrame | None:
    if not plan.references:
        return None
    parts = materialise(_union([_missing(plan.places[p], *found) for p, found in plan.references.items()]), "missing-keys")
    total = parts.groupBy("_place").agg(F.sum("_metric").cast(_METRIC).alias("_metric")).select("_place", *_total(), "_metric")
    return parts.filter(F.col("_grain") != WHOLE).unionByName(total)


def _metrics(runs: list[Run], packed: bool) -> list[DataFrame]:
    """For each run, (_rows, _value, _expected) of every check and batch, 0 where a batch has no rows."""
    plan = _Plan(runs, packed)
    units = {plan.places[place]: keys for place, keys in plan.keys.items()}
    parts = [_scanned(plan), _repeated(units) if units else None, _all_missing(plan)]
    values = _union([p for p in parts if p is not None])
    metric = F.coalesce("_metric", F.lit(0).cast(_METRIC))

    def of(run: Run, uses: list[tuple[int, str, str, str]]) -> DataFrame:
        return (
            _wanted(run.batches, uses)
            .join(values, ["_place", "_grain", "_group"], "left")
            .groupBy(*run.batches.columns, "CheckID")
            .agg(
                F.max(F.when(F.col("_role") == _ROWS, metric)).cast("bigint").alias(_ROWS),
                F.coalesce(F.max(F.when(F.col("_role") == _BAD, metric)), F.lit(0)).cast(_METRIC).alias(_BAD),
                F.max(F.when(F.col("_role") == _EXPECTED, metric)).alias(_EXPECTED),
            )
        )

    return [of(run, uses) for run, uses in zip(runs, plan.uses, strict=True)]


_SPEC = (
    "CheckID string, LayerName string, TableName string, CheckName string, CheckCategory string, "
    "SeverityLevel string, CheckDescription string, _on_failure string, _kind string, "
    "_at_least int, _empty_fails boolean, _amount boolean"
)


def _spec(c: Check) -> tuple:
    return (
        c.id, c.layer, c.table, c.name, c.category, c.severity, c.description, c.on_failure, type(c).__name__,
        getattr(c, "at_least", 0), getattr(c, "empty_fails", False), getattr(c, "amount", False),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0).cast(RATE)).otherwise((part.cast(ROWS) / whole.cast(ROWS)).cast(RATE))


def _verdicts(metrics: DataFrame, by: list[str]) -> DataFrame:
    """Counts, rate and status of each check from its metrics, by the check's template."""
    kind, rows, value, expected = (F.col(c) for c in ("_kind", "_rows", "_value", "_expected"))
    gap = F.abs(expected - value)
    per_row = kind.isin("RowRule", "References")
    not_empty, unique, same = kind == "NotEmpty", kind == "Unique", kind == "SameValue"
    missing_rows = F.col("_empty_fails") & (rows == 0)
    failed = (
        F.when(not_empty, (rows < F.col("_at_least")).cast("int"))
        .when(unique, value)
        .when(same & F.col("_amount"), (gap >= F.lit(AMOUNT_TOLERANCE).cast(_VALUE)).cast("int"))
        .when(same, gap)
        .when(missing_rows, 1)
        .otherwise(value)
    )
    metrics = metrics.withColumn("_failed", failed.cast(ROWS))
    failed, ok = F.col("_failed"), F.col("_failed") == 0
    checked = F.when(same & F.col("_amount"), 1).when(same, expected).otherwise(rows).cast(ROWS)
    passed = (
        F.when(per_row, rows - value)
        .when(~unique & ok, checked)
        .when(not_empty | same, F.lit(0))
    )
    rate = (
        F.when(not_empty | (same & F.col("_amount")) | missing_rows, failed.cast(RATE))
        .when(same, _share(gap, expected))
        .when(per_row, _share(value, rows))
    )
    return metrics.select(
        *by,
        "CheckID", "LayerName", "TableName", "CheckName", "CheckCategory", "SeverityLevel",
        checked.alias("CheckedRowCount"),
        passed.cast(ROWS).alias("PassedRowCount"),
        failed.alias("FailedRowCount"),
        rate.cast(RATE).alias("FailureRate"),
        F.when(ok, "PASS").otherwise(F.col("_on_failure")).alias("CheckStatus"),
        "CheckDescription",
    )


def evaluate_runs(runs: list[Run], packed: bool = False) -> DataFrame:
    """One row per check and batch of all runs: counts, failure rate and status. Batches have the same columns,
    which stay. Reconciliations may compare tables of different grain. `packed`: keys that checks refer to are
    looked up in broadcast blocks where they can be packed, so that a large table is neither joined nor shuffled."""
    found = []
    for run, metrics in zip(runs, _metrics(runs, packed), strict=True):
        specs = metrics.sparkSession.createDataFrame([_spec(c) for c in run.checks], _SPEC)
        found.append(_verdicts(metrics.join(F.broadcast(specs), "CheckID"), run.batches.columns))
    return _union(found)


def evaluate(
    checks: Iterable[Check],
    tables: dict[str, DataFrame],
    batches: DataFrame | None = None,
    grain: dict[str, str] | None = None,
    packed: bool = False,
) -> DataFrame:
    """`evaluate_runs` of one run. Without batches the tables are checked as they are."""
    one = next(iter(tables.values())).sparkSession.range(1).select(F.lit(0).alias("_batch"))
    found = evaluate_runs([Run(list(checks), tables, one if batches is None else batches, grain or {})], packed)
    return found.drop("_batch") if batches is None else found
