"""Transforms compiled to lazy DataFrame projections / joins.

A transform is ``fn(df, ctx, **params) -> DataFrame``. It checks the schema
on the driver (missing columns, non-numeric operands) and raises
``TransformError``. The only job it may start is the size proof of a mapping
table. Reports of a transform (unmatched mapping keys) are declared in
``ctx.enrichments`` and evaluated later. Side effects (the snapshot append)
are declared in ``ctx.snapshots`` / ``ctx.after`` and run only once the step's
output exists.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropgate.errors import RegistryError, TransformError
from dropgate.functions import arithmetic
from dropgate.functions.names import col as named, quoted
from dropgate.functions.strings import strip_whitespace as strip_ws
from dropgate.operators import joins
from dropgate.operators.messages import msg
from dropgate.operators.checks import SAMPLE_SIZE, CheckContext

TRANSFORMS: dict[str, Callable] = {}

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
SMALL_INT = (T.ByteType, T.ShortType, T.IntegerType)


def transform(name: str | Callable | None = None):
    """Register a transform: ``fn(df, ctx, **params) -> DataFrame``."""
    def deco(fn, _name=None):
        TRANSFORMS[_name or fn.__name__] = fn
        return fn
    if callable(name):
        return deco(name)
    return lambda fn: deco(fn, name)


@dataclass
class TransformContext:
    catalog: Any = None
    key: str = "_source_file"
    name: str = ""
    run_id: str | None = None
    report: CheckContext | None = None
    actions: list[Callable[[DataFrame], Any]] = field(default_factory=list)
    # (table, id column, its copy in the output, the rows right after the step) of the snapshots
    snapshots: list[tuple[str, str, str, DataFrame]] = field(default_factory=list)
    # the report of each enrichment alone, over the rows right after its join
    enrichments: list[CheckContext] = field(default_factory=list)
    all_rows: bool = True  # whether the whole chain keeps every row
    _seq: int = 0

    def hidden(self, stem: str) -> str:
        self._seq += 1
        return f"{joins.HIDDEN}{stem}{self._seq}"

    def after(self, action: Callable[[DataFrame], Any]) -> None:
        """Run ``action(output_df)`` after the step output is written."""
        self.actions.append(action)


def _as_list(v) -> list[str]:
    if v is None:
        return []
    return [v] if isinstance(v, str) else list(v)


def _require(df: DataFrame, cols: list[str], what: str = "") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise TransformError(what + msg("need_columns", cols=missing))


def _numeric(df: DataFrame, cols: list[str]) -> None:
    types = {f.name: f.dataType for f in df.schema.fields}
    bad = [c for c in cols if not isinstance(types[c], NUMERIC)]
    if bad:
        raise TransformError(msg("need_numbers", cols=[f"{c} ({types[c].simpleString()})" for c in bad]))


# --------------------------------------------------------------------------
# Mapping enrichment (left join)
# --------------------------------------------------------------------------

def enrich(df: DataFrame, mapping: DataFrame, df_join_column, mapping_key_column,
           columns_to_add: list[str], hit_column: str | None = None,
           max_broadcast_rows: int = joins.BROADCAST_MAX_ROWS,
           mapping_ops: list[tuple[str, dict]] | None = None) -> DataFrame:
    """Left join ``df`` to a mapping, adding ``columns_to_add``.

    Only the key and listed columns of the mapping are read (column pruning
    reaches the scan). The mapping is broadcast when its row count is proven
    small; otherwise a sort-merge join with hot-key salting is used. An added
    column whose name already exists in ``df`` gets a ``_right`` suffix.
    ``hit_column`` (optional) is true on matched rows, null otherwise.
    ``mapping_ops`` are row-wise transforms ``(function, params)`` applied to
    the (small) mapping side before the join instead of to every joined row.
    """
    lk, rk = _as_list(df_join_column), _as_list(mapping_key_column)
    if len(lk) != len(rk) or not lk:
        raise TransformError("df_join_column and mapping_key_column must have the same, non-zero length")
    if not columns_to_add:
        raise TransformError("columns_to_add must name at least one column")
    _require(df, lk, "join key: ")
    _require(mapping, rk + list(columns_to_add), "mapping: ")
    out_names = {c: (f"{c}_right" if c in df.columns else c) for c in columns_to_add}
    sel = [named(c) for c in rk] + [named(c).alias(out_names[c]) for c in columns_to_add if c not in rk]
    if hit_column:
        sel.append(F.lit(True).alias(hit_column))
    right = mapping.select(*sel)
    for fn, params in mapping_ops or []:
        right = TRANSFORMS[fn](right, TransformContext(), **params)
    return joins.left_join(df, right, lk, rk, max_broadcast_rows=max_broadcast_rows)


@transform
def enrich_with_mapping(df: DataFrame, ctx: TransformContext, mapping_file: str, df_join_column,
                        mapping_key_column, columns_to_add: list[str],
                        _mapping_ops: list | None = None) -> DataFrame:
    if ctx.catalog is None or not ctx.catalog.exists(mapping_file):
        raise TransformError(msg("no_table", table=mapping_file))
    mapping = ctx.catalog.read(mapping_file)
    hit = ctx.hidden("hit")
    out = enrich(df, mapping, df_join_column, mapping_key_column, list(columns_to_add), hit_column=hit,
                 mapping_ops=_mapping_ops)
    if ctx.report is not None:
        # own copies of what the report reads: later steps may rename or drop the columns
        keys = _as_list(df_join_column)
        first = columns_to_add[0] if columns_to_add[0] not in df.columns else f"{columns_to_add[0]}_right"
        copies = {k: ctx.hidden("key") for k in keys}
        empty = ctx.hidden("empty")
        out = out.withColumns({c: named(k) for k, c in copies.items()} | {empty: named(first).isNull()})
        name = ctx.name

        def declare(r: CheckContext) -> None:
            unmatched = F.coalesce(r.agg(F.count_if(F.col(hit).isNull())), F.lit(0))
            null_first = F.coalesce(r.agg(F.count_if(F.col(empty))), F.lit(0))
            total = F.coalesce(F.col("__n_rows"), F.lit(0))
            r.finding(",".join(keys), passed=F.lit(True), n_bad=unmatched,
                      message=F.when(unmatched > 0, F.format_string(
                          msg("enrich_unmatched", table=mapping_file, first=first), unmatched, total, null_first))
                      .otherwise(F.lit(msg("enrich_ok", table=mapping_file))),
                      severity="info", check_name=name)
            # up to 3 distinct example keys per source file
            r.examples(",".join(keys), F.col(hit).isNull(), list(copies.values()), k=3, check_name=name, names=keys)

        declare(ctx.report)
        own = CheckContext(df=out, key=ctx.key, catalog=ctx.catalog)
        declare(own)
        ctx.enrichments.append(own)
    return out


# --------------------------------------------------------------------------
# String cleaning, case, identity
# --------------------------------------------------------------------------

@transform
def strings_strip_whitespace(df: DataFrame, ctx: TransformContext, columns: list[str],
                             strip_whitespace: bool = True) -> DataFrame:
    if not strip_whitespace:
        return df
    present = [c for c in _as_list(columns) if c in df.columns]  # absent columns skipped
    return df.withColumns({c: strip_ws(named(c)) for c in present}) if present else df


@transform
def case_transform(df: DataFrame, ctx: TransformContext, columns: list[str],
                   to_uppercase: bool = False, to_lowercase: bool = False) -> DataFrame:
    if to_uppercase and to_lowercase:
        raise TransformError(msg("one_case"))
    if not (to_uppercase or to_lowercase):
        raise TransformError(msg("no_case"))
    fn = F.upper if to_uppercase else F.lower
    present = [c for c in _as_list(columns) if c in df.columns]
    return df.withColumns({c: fn(named(c)) for c in present}) if present else df


@transform
def blank(df: DataFrame, ctx: TransformContext) -> DataFrame:
    return df


# --------------------------------------------------------------------------
# Column arithmetic
# --------------------------------------------------------------------------

@transform
def multiply_columns(df: DataFrame, ctx: TransformContext, columns_to_multiply: list[str],
                     output_column: str) -> DataFrame:
    cols = _as_list(columns_to_multiply)
    _require(df, cols)
    _numeric(df, cols)
    terms = _ints_as_long(df, cols)
    expr = terms[0]
    for t in terms[1:]:
        expr = expr * t
    return df.withColumn(output_column, expr)


def _ints_as_long(df: DataFrame, cols: list[str]) -> list:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [named(c).cast("long") if isinstance(types[c], SMALL_INT) else named(c) for c in cols]


@transform
def sum_columns(df: DataFrame, ctx: TransformContext, columns_to_sum: list[str], output_column: str) -> DataFrame:
    cols = _as_list(columns_to_sum)
    _require(df, cols)
    _numeric(df, cols)
    terms = _ints_as_long(df, cols)
    expr = terms[0]
    for t in terms[1:]:
        expr = expr + t
    return df.withColumn(output_column, expr)


@transform
def subtract_columns(df: DataFrame, ctx: TransformContext, minuend_column: str,
                     subtrahend_columns: list[str], output_column: str) -> DataFrame:
    cols = [minuend_column] + _as_list(subtrahend_columns)
    _require(df, cols)
    _numeric(df, cols)
    terms = _ints_as_long(df, cols)
    expr = terms[0]
    for t in terms[1:]:
        expr = expr - t
    return df.withColumn(output_column, expr)


@transform
def divide_columns(df: DataFrame, ctx: TransformContext, numerator_column: str,
                   denominator_column: str, output_column: str) -> DataFrame:
    _require(df, [numerator_column, denominator_column])
    _numeric(df, [numerator_column, denominator_column])
    return df.withColumn(output_column, arithmetic.safe_divide(quoted(numerator_column), quoted(denominator_column)))


# --------------------------------------------------------------------------
# Projections and filters
# --------------------------------------------------------------------------

@transform
def drop_columns(df: DataFrame, ctx: TransformContext, columns: list[str]) -> DataFrame:
    cols = _as_list(columns)
    _require(df, cols)  # Spark's drop ignores unknown names; the rule is strict
    return df.select(*[named(c) for c in df.columns if c not in cols])


@transform
def rename_columns(df: DataFrame, ctx: TransformContext, column_mapping: dict[str, str]) -> DataFrame:
    _require(df, list(column_mapping))
    return df.withColumnsRenamed(dict(column_mapping))


# The comparison operators a registry may use in filter_rows.
FILTER_OPERATORS = {
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v,
    "in": lambda c, v: c.isin(list(v)), "not_in": lambda c, v: ~c.isin(list(v)),
    "is_null": lambda c, v: c.isNull(), "is_not_null": lambda c, v: c.isNotNull(),
}


@transform
def filter_rows(df: DataFrame, ctx: TransformContext, column: str, operator: str, value=None) -> DataFrame:
    _require(df, [column])
    op = FILTER_OPERATORS.get(operator)
    if op is None:
        raise TransformError(f"unsupported operator '{operator}'; use one of {sorted(FILTER_OPERATORS)}")
    return df.filter(op(named(column), value))


@transform
def drop_nulls(df: DataFrame, ctx: TransformContext, subset: list[str] | None = None) -> DataFrame:
    cols = _as_list(subset) or [c for c in df.columns if not c.startswith(joins.HIDDEN) and c != ctx.key]
    _require(df, cols)
    return df.filter(joins.all_not_null([quoted(c) for c in cols])) if cols else df


# --------------------------------------------------------------------------
# Snapshot of distinct ids (side effect after the step output exists)
# --------------------------------------------------------------------------

@transform
def save_inventory_snapshot(df: DataFrame, ctx: TransformContext, snapshot_file: str,
                            product_id_column: str) -> DataFrame:
    _require(df, [product_id_column])
    if ctx.catalog is None:
        raise TransformError("save_inventory_snapshot needs a catalog")
    # written once per table and run, when all patterns' outputs exist; the
    # ids are copied, as later steps may rename or drop the column
    ids = ctx.hidden("id")
    out = df.withColumn(ids, named(product_id_column))
    ctx.snapshots.append((snapshot_file, product_id_column, ids, out))
    return out


# --------------------------------------------------------------------------
# Ordered chain
# --------------------------------------------------------------------------

def compile_chain(spec: list[dict]) -> list[dict]:
    """Validate a transform list before any data is read (X3) and sort it.

    Every unknown function is reported at once. ``order`` and ``params`` are
    optional; ties keep registry order.
    """
    if not isinstance(spec, list):
        raise RegistryError("transforms must be a list")
    missing = [t.get("function") for t in spec if t.get("function") not in TRANSFORMS]
    if missing:
        raise RegistryError(f"Missing transformer function(s): {missing}")
    indexed = list(enumerate(spec))
    indexed.sort(key=lambda it: (it[1].get("order", float("inf")), it[0]))
    return [dict(t, name=t.get("name", t["function"]), params=t.get("params") or {}) for _, t in indexed]


# Transforms that keep every row; after any other one a report of an earlier
# join, or the ids of an earlier snapshot, must be taken from the rows right
# after that join or snapshot.
KEEPS_ROWS = frozenset({"enrich_with_mapping", "strings_strip_whitespace", "case_transform", "blank", "multiply_columns",
                        "sum_columns", "subtract_columns", "divide_columns", "drop_columns", "rename_columns",
                        "save_inventory_snapshot"})


def keeps_rows(spec: list[dict]) -> bool:
    return all(t.get("function") in KEEPS_ROWS for t in spec or [])


# Row-wise, null-preserving string transforms that may run on the mapping side.
_PUSHABLE = ("strings_strip_whitespace", "case_transform")
_ARITHMETIC_IO = {
    "multiply_columns": (("columns_to_multiply",), "output_column"),
    "sum_columns": (("columns_to_sum",), "output_column"),
    "subtract_columns": (("minuend_column", "subtrahend_columns"), "output_column"),
    "divide_columns": (("numerator_column", "denominator_column"), "output_column"),
}


def _valid_pushable(t: dict) -> bool:
    p = t["params"]
    if t["function"] == "case_transform":
        return bool(p.get("to_uppercase")) != bool(p.get("to_lowercase"))
    return bool(p.get("strip_whitespace", True))


def _mapping_cleaning(columns: list[str], steps: list[dict], i: int) -> tuple[list, dict]:
    """Later strip / case transforms on columns that only the mapping of the
    enrich at ``i`` provides: run them on the mapping side instead.

    Scans forward while the transforms in between provably commute with them
    (they neither read nor write those columns); stops at any other kind of
    transform. Returns (mapping ops in chain order, {index: reduced params}).
    """
    p = steps[i]["params"]
    keys = set(_as_list(p.get("mapping_key_column")))
    added = {(c if c not in columns else f"{c}_right") for c in p.get("columns_to_add", []) if c not in keys}
    ops, rewrites = [], {}
    for j in range(i + 1, len(steps)):
        t, fn = steps[j], steps[j]["function"]
        tp = t["params"]
        if fn in _PUSHABLE and _valid_pushable(t):
            cols = _as_list(tp.get("columns"))
            push = [c for c in cols if c in added]
            if push:
                ops.append((fn, dict(tp, columns=push)))
                rewrites[j] = dict(tp, columns=[c for c in cols if c not in push])
        elif fn == "blank":
            continue
        elif fn in _ARITHMETIC_IO:
            ins, out = _ARITHMETIC_IO[fn]
            touched = {tp.get(out)} | {c for k in ins for c in _as_list(tp.get(k))}
            added -= touched
        elif fn == "filter_rows":
            added.discard(tp.get("column"))
        elif fn == "save_inventory_snapshot":
            added.discard(tp.get("product_id_column"))
        else:
            break
        if not added:
            break
    return ops, rewrites


def apply_chain(df: DataFrame, spec: list[dict], ctx: TransformContext) -> tuple[DataFrame, list[tuple]]:
    """Apply transforms in order. Returns (df, [(name, ok, error)]).

    A transform that cannot apply to the schema is recorded as failed and the
    chain continues on the unmodified frame; the step then delivers nothing
    for this dataset (all transforms must succeed).
    """
    log = []
    steps = compile_chain(spec)
    rewritten: dict[int, dict] = {}
    for i, t in enumerate(steps):
        ctx.name = t["name"]
        params = rewritten.get(i, t["params"])
        pending = {}
        if t["function"] == "enrich_with_mapping":
            ops, pending = _mapping_cleaning(df.columns, steps, i)
            if ops:
                params = dict(params, _mapping_ops=ops)
        try:
            df = TRANSFORMS[t["function"]](df, ctx, **params)
            rewritten.update(pending)
            log.append((t["name"], True, None))
        except (TransformError, TypeError, ValueError) as e:
            log.append((t["name"], False, msg("transform_failed", name=t["name"], err=e)))
    return df, log


def distinct_examples(df: DataFrame, key: str, cols: list[str], mask, k: int = SAMPLE_SIZE) -> DataFrame:
    """Up to k distinct example values of ``cols`` per key where ``mask`` holds."""
    d = df.filter(mask).select(key, *map(quoted, cols)).distinct()
    w = Window.partitionBy(key).orderBy(*map(quoted, cols))
    rn = f"{joins.HIDDEN}rn"
    return d.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k).drop(rn)
