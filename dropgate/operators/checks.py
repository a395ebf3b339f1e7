"""Checks (validators) compiled to lazy Spark plans.

A check's findings are lazy; the only jobs run while compiling are the size
proofs of reference tables (``joins.bounded_size``), as they pick the join.
A check declares, through a ``CheckContext``:

* static findings decided on the driver from the schema (no job at all);
* named aggregate expressions over the dataset's rows plus the findings that
  read them. All aggregates of all checks of one step are evaluated in ONE
  ``groupBy(<source key>).agg(...)`` (map-side combined, so a file holding a
  third of all rows is pre-aggregated in every task before the shuffle);
* key-level counts (hierarchy, referential, duplicates) built from ``distinct``
  / ``groupBy`` plans, which also pre-aggregate before shuffling; they are
  joined to the per-key row, so a key has one verdict per check;
* detail frames: one finding per violation (whole, never cut);
* bounded samples: at most ``k`` example rows per key and check, chosen with
  ``row_number() <= k`` which Spark plans as a partial WindowGroupLimit
  before the exchange (no group is ever collected whole).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any, Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropgate.errors import RegistryError
from dropgate.functions.names import col as named, quoted
from dropgate.functions.strings import is_null_or_marker
from dropgate.operators import joins
from dropgate.operators.messages import msg
from dropgate.plans.findings import FINDING_FIELDS, finding_struct, union_all

CHECKS: dict[str, Callable] = {}

SAMPLE_SIZE = 5  # examples of a check that names no number
CORRUPT = f"{joins.HIDDEN}corrupt"  # the text of a CSV row that did not parse
RECORD = f"{joins.HIDDEN}record"  # number of a row in its file, from 1
OFFSET = f"{joins.HIDDEN}offset"  # byte at which a CSV record starts
HIT = f"{joins.HIDDEN}hit"
N_SAME = f"{joins.HIDDEN}same"
_OFFSETS = Decimal(1 << 63)  # more than any byte offset


def check(name: str | Callable | None = None):
    """Register a check: ``fn(ctx: CheckContext, params) -> None``."""
    def deco(fn, _name=None):
        CHECKS[_name or fn.__name__] = fn
        return fn
    if callable(name):
        return deco(name)
    return lambda fn: deco(fn, name)


@dataclass
class _Sample:
    check: str
    column: str | None
    mask: Column
    k: int


@dataclass
class CheckContext:
    """What one check sees: the rows, their schema, and the sinks it writes to."""

    df: DataFrame
    key: str
    catalog: Any = None
    check_name: str = ""
    sample_cols: list[str] | None = None
    _aggs: list[Column] = field(default_factory=list)
    _findings: list[Column] = field(default_factory=list)
    _static: list[tuple] = field(default_factory=list)
    _frames: list[DataFrame] = field(default_factory=list)
    _counts: list[DataFrame] = field(default_factory=list)
    _samples: list[_Sample] = field(default_factory=list)
    _examples: list[tuple] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.df.columns if not c.startswith(joins.HIDDEN) and c != self.key]

    def agg(self, expr: Column) -> Column:
        """Register an aggregate; returns a column that reads its value."""
        name = f"__a{len(self._aggs)}"
        self._aggs.append(expr.alias(name))
        return F.col(name)

    def finding(self, column: str | None, passed: Column, n_bad: Column, message: Column,
                severity: str = "fail", check_name: str | None = None, samples: Column | None = None) -> None:
        self._findings.append(finding_struct(check_name or self.check_name, column, severity,
                                             passed, n_bad, message, samples))

    def static(self, column: str | None, passed: bool, message: str | None,
               severity: str = "fail", n_bad: int = 0) -> None:
        self._static.append((self.check_name, column, severity, passed, n_bad, message))

    def present(self, col: str) -> Column:
        """True where the key's own schema (file header) has ``col``."""
        return F.array_contains(F.col("__columns"), col)

    def has_columns(self, cols: list[str]) -> Column:
        """True where the key's own schema has all of ``cols``."""
        out = F.lit(True)
        for c in cols:
            out = out & self.present(c)
        return out

    def absent(self, cols: list[str]) -> bool:
        """Report ``cols`` that no key has; true if there are any."""
        gone = [c for c in cols if c not in self.columns]
        for c in gone:
            self.static(c, False, msg("column_absent", col=c))
        return bool(gone)

    def count(self, df: DataFrame) -> list[Column]:
        """Register per-key counts (``key`` + value columns); returns columns that read them (0 where a key has none)."""
        names = [c for c in df.columns if c != self.key]
        own = [f"__c{len(self._counts)}_{i}" for i in range(len(names))]
        self._counts.append(df.select(self.key, *[F.col(c).alias(a) for c, a in zip(names, own)]))
        return [F.col(a) if isinstance(df.schema[c].dataType, T.ArrayType) else F.coalesce(F.col(a), F.lit(0))
                for c, a in zip(names, own)]

    def key_verdict(self, column: str | None, cols: list[str], n_bad: Column, message: Column, passed: Column | None = None,
                    samples: Column | None = None) -> None:
        """One verdict per key of a key-level check that needs ``cols`` in the key's own schema."""
        here = self.has_columns(cols)
        ok = n_bad == 0 if passed is None else passed
        gone = F.array_join(F.array_except(F.array(*[F.lit(c) for c in cols]).cast("array<string>"), F.col("__columns")), "', '")
        self.finding(column, passed=here & ok, n_bad=n_bad,
                     message=F.when(~here, F.concat(F.lit("column '"), gone, F.lit("' is not in this file"))).when(~ok, message), samples=samples)

    def frame(self, df: DataFrame) -> None:
        """Detail findings: columns ``key`` + FINDING_FIELDS, one row per violation."""
        self._frames.append(df)

    def sample(self, column: str | None, mask: Column, k: int = SAMPLE_SIZE) -> None:
        self._samples.append(_Sample(self.check_name, column, mask, k))

    def examples(self, column: str | None, mask: Column, cols: list[str], k: int = 3,
                 check_name: str | None = None, names: list[str] | None = None) -> None:
        """Up to k DISTINCT values of ``cols`` (shown as ``names``) per key where ``mask`` holds."""
        self._examples.append((check_name or self.check_name, column, mask, list(cols), k, names or list(cols)))


def _struct_or_literal(ctx: CheckContext, t: tuple) -> Column:
    check_name, column, severity, passed, n_bad, message = t
    return finding_struct(check_name, column, severity, F.lit(passed), F.lit(n_bad), F.lit(message))


def compile_checks(df: DataFrame, spec: dict[str, Any] | list, key: str = "_source_file",
                   catalog: Any = None, sample_cols: list[str] | None = None) -> CheckContext:
    """Let every check of ``spec`` declare its work; no Spark job runs here.

    Unknown check names raise ``RegistryError`` before any data is read.
    """
    items = list(spec.items()) if isinstance(spec, dict) else list(spec or [])
    unknown = [n for n, _ in items if n not in CHECKS]
    if unknown:
        raise RegistryError(f"Missing validator(s): {unknown}")
    ctx = CheckContext(df=df, key=key, catalog=catalog, sample_cols=sample_cols)
    for name, params in items:
        ctx.check_name = name
        CHECKS[name](ctx, params)
    return ctx


def evaluate(ctx: CheckContext, keys_df: DataFrame | None = None) -> DataFrame:
    """Per-key findings of a compiled context.

    Output columns: ``key`` + check, column, severity, passed, n_bad, message, samples.
    """
    df, key = ctx.df, ctx.key
    frames = []
    row_findings = ctx._findings + [_struct_or_literal(ctx, t) for t in ctx._static]
    if row_findings:
        # one fused pass over the rows; the row count is always computed so
        # keys with rows exist even when no check needs an aggregate
        n_rows = F.count(F.lit(1)).alias("__n_rows")
        fused = df.groupBy(key).agg(n_rows, *ctx._aggs)
        all_cols = F.array(*[F.lit(c) for c in ctx.columns]).cast("array<string>")
        if keys_df is not None:
            # keys without rows (empty files) still get a row of null aggregates;
            # each key brings its own column list when it has one
            cols = F.col("__columns") if "__columns" in keys_df.columns else all_cols
            fused = keys_df.select(key, cols.alias("__columns")).join(fused, key, "left")
        else:
            fused = fused.withColumn("__columns", all_cols)
        for counts in ctx._counts:
            fused = fused.join(counts, key, "left")
        frames.append(fused.select(key, F.inline(F.array(*row_findings))).select(key, *FINDING_FIELDS))
    frames.extend(f.select(key, *FINDING_FIELDS) for f in ctx._frames)
    findings = union_all(frames)
    if findings is None:
        return df.sparkSession.createDataFrame(
            [], f"{key} string, check string, column string, severity string, passed boolean, "
                "n_bad long, message string, samples array<string>")
    parts = []
    if ctx._samples:
        parts.append(_sample_frame(ctx, df, key))
    parts.extend(_example_frame(df, key, *e) for e in ctx._examples)
    if parts:
        findings = _join_samples(findings, union_all(parts), key)
    return findings


def run_checks(df: DataFrame, spec: dict[str, Any] | list, key: str = "_source_file",
               keys_df: DataFrame | None = None, catalog: Any = None,
               sample_cols: list[str] | None = None) -> DataFrame:
    """Evaluate a registry's validators over ``df``; return per-key findings.

    ``spec`` is ``{check_name: params}`` (YAML order) or a list of
    ``(check_name, params)``. ``keys_df`` lists every key that must get a
    verdict even with zero rows (e.g. empty files).
    """
    return evaluate(compile_checks(df, spec, key, catalog, sample_cols), keys_df)


def _sample_cols(df: DataFrame, key: str, sample_cols: list[str] | None) -> list[str]:
    return (sample_cols or [c for c in df.columns if c == RECORD]
            or [c for c in df.columns if not c.startswith(joins.HIDDEN) and c != key])


def _sample_frame(ctx: CheckContext, df: DataFrame, key: str) -> DataFrame:
    """Up to k example rows per (key, check, column), all sampling checks at once.

    One scan: rows where any sample mask holds are tagged with the checks
    they fail (``explode`` of the matching tags); ``row_number() <= k`` is
    planned as a partial WindowGroupLimit before the exchange, so each task
    ships at most k rows per group, and only those rows are rendered as text.
    """
    cols = _sample_cols(df, key, ctx.sample_cols)
    order = [f"__o{i}" for i in range(len(cols))]
    any_bad = ctx._samples[0].mask
    for s in ctx._samples[1:]:
        any_bad = any_bad | s.mask
    tags = F.array(*[F.when(s.mask, F.struct(F.lit(s.check).alias("check"),
                                             F.lit(s.column).cast("string").alias("column"),
                                             F.lit(s.k).alias("k")))
                     for s in ctx._samples])
    cand = (df.filter(any_bad)
            .select(key, *[named(c).alias(o) for c, o in zip(cols, order)],
                    F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("__t"))
            .select(key, "__t.check", "__t.column", F.col("__t.k").alias("__k"), *order))
    w = Window.partitionBy(key, "check", "column").orderBy(*order)
    # the largest k of all checks bounds what a task ships, each check's own k what stays
    most = max(s.k for s in ctx._samples)
    top = (cand.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= F.lit(most))
           .filter(F.col("__rn") <= F.col("__k")))
    return _collect_samples(top, key, cols, order)


def _example_frame(df: DataFrame, key: str, check: str, column: str | None, mask: Column,
                   cols: list[str], k: int, names: list[str]) -> DataFrame:
    """Up to k distinct values of ``cols`` per key where ``mask`` holds.

    ``distinct`` is combined map-side (a task ships each distinct value once),
    then the same partial WindowGroupLimit bounds what reaches each group.
    """
    order = [f"__o{i}" for i in range(len(cols))]
    d = df.filter(mask).select(key, *[named(c).alias(o) for c, o in zip(cols, order)]).distinct()
    w = Window.partitionBy(key).orderBy(*order)
    top = (d.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
           .withColumn("check", F.lit(check)).withColumn("column", F.lit(column).cast("string")))
    return _collect_samples(top, key, names, order)


def _collect_samples(top: DataFrame, key: str, cols: list[str], order: list[str]) -> DataFrame:
    rep = F.col(order[0]).cast("string") if len(order) == 1 else \
        F.to_json(F.struct(*[F.col(o).alias(c) for c, o in zip(cols, order)]))
    return top.groupBy(key, "check", "column").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__rn", rep.alias("s")))), lambda x: x["s"])
        .alias("__samples"))


def _join_samples(findings: DataFrame, samples: DataFrame, key: str) -> DataFrame:
    cond = ((findings[key].eqNullSafe(samples[key])) & (findings["check"] == samples["check"])
            & (findings["column"].eqNullSafe(samples["column"])))
    return (findings.join(samples, cond, "left")
            .select(findings[key], findings["check"], findings["column"], "severity", "passed", "n_bad",
                    "message", F.coalesce(findings["samples"], F.col("__samples")).alias("samples")))


# --------------------------------------------------------------------------
# V1, V2: constants
# --------------------------------------------------------------------------

@check
def always_true_validator(ctx: CheckContext, params=None):
    ctx.static(None, True, None, severity="info")


@check
def always_false_validator(ctx: CheckContext, params=None):
    ctx.static(None, False, msg("always_false"))


# --------------------------------------------------------------------------
# V3, V4: schema checks, decided on the driver
# --------------------------------------------------------------------------

@check
def required_columns(ctx: CheckContext, params):
    cols = list(params or [])
    missing = F.array_except(F.array(*[F.lit(c) for c in cols]).cast("array<string>"), F.col("__columns"))
    n = F.size(missing)
    ctx.finding(None, passed=n == 0, n_bad=n, severity="fatal",
                message=F.when(n > 0, F.concat(F.lit(msg("missing_columns")), F.array_join(missing, ", "))))


@check
def additional_columns(ctx: CheckContext, params):
    allowed = F.array(*[F.lit(c) for c in (params or [])]).cast("array<string>")
    # the per-file column lists hold only the file's own columns
    extra = F.array_except(F.col("__columns"), allowed)
    n = F.size(extra)
    ctx.finding(None, passed=n == 0, n_bad=n,
                message=F.when(n > 0, F.concat(F.lit(msg("extra_columns")), F.array_join(extra, ", "))))


# --------------------------------------------------------------------------
# V5-V7: row-level counts, fused into one aggregation
# --------------------------------------------------------------------------

@check
def is_empty_dataframe(ctx: CheckContext, params=None):
    n = F.coalesce(F.col("__n_rows"), F.lit(0))
    ctx.finding(None, passed=n > 0, n_bad=F.when(n == 0, 1).otherwise(0),
                message=F.when(n == 0, F.lit(msg("empty"))),
                severity="fatal")


@check
def value_range(ctx: CheckContext, params):
    if not isinstance(params, dict):
        raise RegistryError("value_range expects {column: {min:, max:}}")
    for col, rng in params.items():
        rng = rng or {}
        if col not in ctx.columns:
            ctx.static(col, False, msg("column_absent", col=col))
            continue
        c = named(col)
        numeric_bounds = all(isinstance(rng.get(b), (int, float)) for b in ("min", "max") if rng.get(b) is not None)
        if isinstance(ctx.df.schema[col].dataType, T.StringType) and numeric_bounds:
            # raw (CSV) text with numeric bounds: compare as numbers; text
            # that is no number lies in no range and fails.
            # Text bounds (e.g. ISO dates) compare as text.
            c = c.try_cast("double")
            no_number = F.coalesce(ctx.agg(F.count_if(named(col).isNotNull() & c.isNull())), F.lit(0))
            ctx.finding(col, passed=(~ctx.present(col) | (no_number == 0)), n_bad=no_number,
                        message=F.when(no_number > 0, F.format_string(msg("not_type", col=col, typ="a number"), no_number)),
                        check_name="value_range.number")
        for bound, op, word in (("min", c.__lt__, "below_min"), ("max", c.__gt__, "above_max")):
            if rng.get(bound) is None:
                continue
            v = rng[bound]
            # nulls pass: a comparison with null is null, which count_if skips
            n = F.coalesce(ctx.agg(F.count_if(op(F.lit(v)))), F.lit(0))
            here = ctx.present(col)
            ctx.finding(col, passed=here & (n == 0), n_bad=n,
                        message=F.when(~here, F.lit(msg("column_absent", col=col)))
                        .when(n > 0, F.format_string(msg(word, col=col, bound=v), n)),
                        check_name=f"value_range.{bound}")


@check
def check_null_values(ctx: CheckContext, params):
    markers = None
    cols = params
    if isinstance(params, dict):
        # `columns` is the documented key; `check_null_values` the legacy one
        cols = params.get("columns", params.get("check_null_values", []))
        markers = params.get("custom_null_values")
    for col in cols or []:
        if col not in ctx.columns:
            ctx.static(col, False, msg("column_absent", col=col))
            continue
        mask = is_null_or_marker(named(col), markers, ctx.df.schema[col].dataType)
        n = F.coalesce(ctx.agg(F.count_if(mask)), F.lit(0))
        here = ctx.present(col)
        ctx.finding(col, passed=here & (n == 0), n_bad=n,
                    message=F.when(~here, F.lit(msg("column_absent", col=col)))
                    .when(n > 0, F.format_string(msg("nulls", col=col), n)))
        ctx.sample(col, mask)


@check
def column_types(ctx: CheckContext, params):
    """Values that do not cast to the declared type (non-null in, null out)."""
    for col, typ in (params or {}).items():
        if col not in ctx.columns:
            ctx.static(col, False, msg("column_absent", col=col))
            continue
        v = named(col)
        bad = v.isNotNull() & v.try_cast(typ).isNull()
        n = F.coalesce(ctx.agg(F.count_if(bad)), F.lit(0))
        here = ctx.present(col)
        ctx.finding(col, passed=~here | (n == 0), n_bad=n,
                    message=F.when(here & (n > 0), F.format_string(msg("not_type", col=col, typ=typ), n)))
        ctx.sample(col, bad)


@check
def malformed_rows(ctx: CheckContext, params=None):
    """(S5) CSV rows that did not parse (kept whole in the corrupt-record column).

    Needs ``spark.sql.csv.parser.columnPruning.enabled=false`` (set by
    ``get_spark`` and the runner): with parser-level pruning a row with the
    wrong number of fields is not flagged.
    """
    if CORRUPT not in ctx.df.columns:
        ctx.static(None, True, None)
        return
    n = F.coalesce(ctx.agg(F.count_if(F.col(CORRUPT).isNotNull())), F.lit(0))
    data_cols = ctx.columns
    # Spark refuses scans that reference only the corrupt-record column; the
    # parsed-value count of a data column keeps the scan a real one
    parsed = F.coalesce(ctx.agg(F.count(named(data_cols[0]))), F.lit(0)) if data_cols else F.lit(0)
    text = F.format_string(msg("malformed"), n, parsed, F.lit(data_cols[0] if data_cols else ""))
    if RECORD in ctx.df.columns and OFFSET in ctx.df.columns:
        bad = F.col(CORRUPT).isNotNull()
        # the least (record, offset) as one number: a minimum of structs would have every row sorted by its file
        both = F.col(RECORD).cast("decimal(19,0)") * F.lit(_OFFSETS) + F.col(OFFSET).cast("decimal(19,0)")
        first = ctx.agg(F.min(F.when(bad, both.cast("decimal(38,0)"))))
        offset = (first % F.lit(_OFFSETS)).cast("long")
        record = ((first - offset) / F.lit(_OFFSETS)).cast("long")
        text = F.concat(text, F.format_string(msg("malformed_at"), record, offset))
        ctx.sample(None, bad)
    ctx.finding(None, passed=n == 0, n_bad=n, message=F.when(n > 0, text))


# --------------------------------------------------------------------------
# V8: hierarchy (functional dependency lower -> higher)
# --------------------------------------------------------------------------

def hierarchy_violations(df: DataFrame, higher: list[str], lower: list[str],
                         key: str | None = None) -> DataFrame:
    """Lower-level combinations mapped to more than one higher-level combination.

    Null counts as a value. ``distinct`` first collapses each (lower, higher)
    combination map-side, so a hot lower key costs one row per distinct
    higher value, not one row per input row.
    Output: [key] + lower + ``n_higher``.
    """
    g = [quoted(c) for c in ([key] if key else []) + lower]
    combos = df.select(*g, *map(quoted, higher)).distinct()
    return combos.groupBy(*g).agg(F.count(F.lit(1)).alias("n_higher")).filter(F.col("n_higher") > 1)


@check
def check_hierarchy(ctx: CheckContext, params):
    higher = list(params.get("higher_level_columns", []))
    lower = list(params.get("lower_level_columns", []))
    if ctx.absent(higher + lower):
        return
    v = hierarchy_violations(ctx.df, higher, lower, ctx.key)
    label = F.concat_ws(" - ", *[F.concat(F.lit(f"{c}="), F.coalesce(named(c).cast("string"), F.lit("null")))
                                 for c in lower])
    # a file lacking a column is judged on its own columns, not on the union's nulls
    (n,) = ctx.count(v.groupBy(ctx.key).agg(F.count(F.lit(1)).alias("n")))
    ctx.key_verdict(",".join(lower), higher + lower, n, F.format_string(msg("hierarchy_count"), n))
    ctx.frame(v.select(
        ctx.key, F.lit(f"{ctx.check_name}.violation").alias("check"), F.lit(",".join(lower)).alias("column"),
        F.lit("fail").alias("severity"), F.lit(False).alias("passed"), F.col("n_higher").cast("long").alias("n_bad"),
        F.format_string(msg("hierarchy"),
                        F.col("n_higher"), label).alias("message"),
        F.lit(None).cast("array<string>").alias("samples")))


# --------------------------------------------------------------------------
# V9: referential check against a master table
# --------------------------------------------------------------------------

def missing_ids(df: DataFrame, id_col: str, master: DataFrame, master_col: str,
                key: str | None = None, max_broadcast_rows: int = joins.BROADCAST_MAX_ROWS) -> DataFrame:
    """Distinct non-null ids of ``df`` absent from ``master`` (anti-join).

    Null ids pass (they are filtered first: Spark's left_anti keeps null keys).
    Both sides are de-duplicated before the join, which removes any key skew. A
    master too large to broadcast is reduced by a bit filter of the ids first.
    """
    g = ([key] if key else [])
    ids = df.select(*g, named(id_col).alias("missing_id")).filter(F.col("missing_id").isNotNull()).distinct()
    m = joins.distinct_for(master.select(named(master_col).alias("missing_id")).filter(F.col("missing_id").isNotNull()),
                           ids, ["missing_id"], max_broadcast_rows)
    return ids.join(m, "missing_id", "left_anti")


@check
def validate_product_ids(ctx: CheckContext, params):
    id_col = params.get("product_id_column")
    master_col = params.get("product_id_master_column")
    table = params.get("master_table", "static.mappings.product_mapping")
    if ctx.catalog is None or not ctx.catalog.exists(table):
        ctx.static(id_col, False, msg("table_missing", table=table))
        return
    master = ctx.catalog.read(table)
    if master_col not in master.columns:
        ctx.static(id_col, False, msg("table_column_missing", col=master_col))
        return
    if ctx.absent([id_col]):
        return
    miss = missing_ids(ctx.df, id_col, master, master_col, ctx.key)
    w = Window.partitionBy(ctx.key).orderBy("missing_id")
    top = (miss.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= SAMPLE_SIZE)
           .groupBy(ctx.key).agg(F.array_sort(F.collect_list(F.col("missing_id").cast("string"))).alias("some")))
    n, some = ctx.count(miss.groupBy(ctx.key).agg(F.count(F.lit(1)).alias("n")).join(top, ctx.key, "left"))
    ctx.key_verdict(id_col, [id_col], n, F.format_string(msg("missing_ids"), n), samples=some)
    # every missing id is a finding of its own
    ctx.frame(miss.select(
        ctx.key, F.lit(f"{ctx.check_name}.id").alias("check"), F.lit(id_col).alias("column"),
        F.lit("fail").alias("severity"), F.lit(False).alias("passed"), F.lit(1).cast("long").alias("n_bad"),
        F.format_string(msg("missing_id"), F.col("missing_id").cast("string")).alias("message"),
        F.lit(None).cast("array<string>").alias("samples")))


# --------------------------------------------------------------------------
# Cross-dataset key consistency
# --------------------------------------------------------------------------

def key_overlap(left: DataFrame, right: DataFrame, key_columns: list[str],
                key: str | None = None, max_broadcast_rows: int = joins.BROADCAST_MAX_ROWS) -> DataFrame:
    """Distinct key combinations of ``left``: how many exist in ``right``.

    Output: [key] + n_keys, n_matched, n_unmatched. Both sides are
    de-duplicated before the join; the right side is broadcast when its
    distinct key set is proven small, else reduced by a bit filter of the
    left's keys before it is shuffled.
    """
    g = [key] if key else []
    lk = left.select(*g, *map(quoted, key_columns)).distinct()
    rk = joins.distinct_for(right.select(*map(quoted, key_columns)), lk, key_columns, max_broadcast_rows).withColumn(HIT, F.lit(True))
    j = lk.join(rk, key_columns, "left")
    agg = [F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col(HIT)).alias("n_matched"),
           F.count_if(F.col(HIT).isNull()).alias("n_unmatched")]
    return j.groupBy(*g).agg(*agg) if g else j.agg(*agg)


@check
def sales_inventory_consistency(ctx: CheckContext, params):
    if isinstance(params, dict):
        keys = params.get("key_columns", [])
        table = params.get("snapshot_table", "static.mappings.inventory_snapshot")
    elif isinstance(params, list):
        keys, table = params, "static.mappings.inventory_snapshot"
    else:
        ctx.static(None, False, msg("bad_key_params"))
        return
    if not keys:
        ctx.static(None, False, msg("no_keys"))
        return
    if ctx.catalog is None or not ctx.catalog.exists(table):
        ctx.static(None, False, msg("table_missing", table=table))
        return
    inv = ctx.catalog.read(table)
    miss_l = [c for c in keys if c not in ctx.columns]
    miss_r = [c for c in keys if c not in inv.columns]
    if miss_l:
        ctx.static(None, False, msg("keys_absent_here", cols=", ".join(miss_l)))
        return
    if miss_r:
        ctx.static(None, False, msg("keys_absent_there", cols=", ".join(miss_r)))
        return
    n_keys, matched, unmatched = ctx.count(key_overlap(ctx.df, inv, keys, ctx.key))
    ctx.key_verdict(",".join(keys), keys, unmatched, passed=(matched > 0) & (unmatched == 0) | (n_keys == 0),
                    message=F.when(matched == 0, F.lit(msg("no_key_matches"))).otherwise(F.format_string(msg("some_key_misses"), unmatched)))


# --------------------------------------------------------------------------
# Duplicate rows
# --------------------------------------------------------------------------

def duplicate_row_count(df: DataFrame, columns: list[str], key: str | None = None) -> DataFrame:
    """Rows that belong to a duplicated group (every member counted).

    groupBy is combined map-side, so a hot duplicated value is pre-counted in
    each task. Output: [key] + dup_count.
    """
    g = [key] if key else []
    groups = df.groupBy(*g, *map(quoted, columns)).agg(F.count(F.lit(1)).alias(N_SAME)).filter(F.col(N_SAME) > 1)
    agg = F.coalesce(F.sum(N_SAME), F.lit(0)).cast("long").alias("dup_count")
    return groups.groupBy(*g).agg(agg) if g else groups.agg(agg)


@check
def no_duplicate_rows(ctx: CheckContext, params=None):
    cols = list(params) if params else ctx.columns
    if ctx.absent(cols):
        return
    (n,) = ctx.count(duplicate_row_count(ctx.df, [c for c in cols if c != ctx.key], ctx.key))
    ctx.key_verdict(None, list(params or []), n, F.format_string(msg("duplicates", cols=", ".join(cols)), n))
